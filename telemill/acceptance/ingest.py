"""Decoding, quarantine, ports, coercion, validity and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.acceptance.inputs import M1_SQL, M2_SQL, m1, m2, m2_of, table
from telemill.acceptance.registry import query
from telemill.functions import values as V
from telemill.operators.clean import explode_ports, has_invalid_port
from telemill.operators.metrics import message_metrics
from telemill.sources.messages import accepted, decode, quarantined, to_wire


def wire_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 as JSON text (`seq, value`), with a fault or a peculiarity by seq % 10."""
    turn = F.col("seq") % 10
    messages = (
        m2(spark, sf_dir)
        .withColumn("app", F.when(turn != 1, F.col("app")))
        .withColumn("portnum", F.when(turn == 2, F.lit(3)).otherwise(F.col("portnum")))
        .withColumn("ptimestamp", F.when(turn != 3, F.col("ptimestamp")))
        .withColumn(
            "extra", F.when(turn == 4, F.to_json(F.struct((F.col("seq") % 7).alias("site"))))
        )
    )
    text = to_wire(messages)
    return text.withColumn(
        "value", F.when(turn == 0, F.expr("left(value, 20)")).otherwise(F.col("value"))
    )


@query(
    "decode_messages",
    f"""WITH {M2_SQL}
    SELECT seq, app, id, portnum, dtimestamp, ptimestamp, dtype, "desc", value, valid,
           CASE WHEN seq % 10 = 4 THEN '{{"site":' || seq % 7 || '}}' END AS extra
    FROM m2 WHERE seq % 10 >= 4""",
)
def decode_messages(spark, sf_dir):
    good = accepted(decode(wire_with_faults(spark, sf_dir)))
    port = F.get("values", F.lit(0))
    return good.select(
        "seq", "app", "id", "portnum", "dtimestamp", "ptimestamp", "dtype", "desc",
        V.to_double(port["value"]).alias("value"), port["valid"].alias("valid"), "extra",
    )


@query(
    "quarantine_messages",
    """SELECT event_id AS seq,
              CASE event_id % 10 WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing_app'
                   WHEN 2 THEN 'portnum_exceeds_values' ELSE 'missing_ptimestamp' END AS reject,
              event_id % 10 = 0 AS is_cut
       FROM events WHERE event_id % 10 <= 3""",
)
def quarantine_messages(spark, sf_dir):
    bad = quarantined(decode(wire_with_faults(spark, sf_dir)))
    return bad.select("seq", "reject", (F.length("raw") == 20).alias("is_cut"))


@query(
    "explode_ports",
    f"""WITH {M1_SQL}
    SELECT seq, id, pidx, value, valid, unit, pidx < portnum - seq % 2 AS active
    FROM m1 JOIN ports ON l_orderkey = seq""",
)
def ports_of_orders(spark, sf_dir):
    # Odd orders leave their last line beyond portnum.
    messages = m1(spark, sf_dir).withColumn(
        "portnum", (F.col("portnum") - F.col("seq") % 2).cast("int")
    )
    return explode_ports(messages).select(
        "seq", "id", "pidx", V.to_double(F.col("value")).alias("value"), "valid", "unit", "active"
    )


@query(
    "coerce_value",
    f"""WITH {M2_SQL}
    SELECT seq,
           CASE seq % 7 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN 1.0::DOUBLE
                WHEN 3 THEN 0.0::DOUBLE END AS value,
           CASE WHEN seq % 7 IN (4, 5) THEN 'not_a_number' END AS error
    FROM m2""",
)
def coerce_value(spark, sf_dir):
    number = F.col("value").cast("string")
    quoted = F.concat(F.lit('"'), number, F.lit('"'))
    turn = F.col("event_id") % 7
    text = (
        F.when(turn == 0, number).when(turn == 1, quoted).when(turn == 2, F.lit("true"))
        .when(turn == 3, F.lit("false")).when(turn == 4, F.lit('"abc"'))
        .when(turn == 5, F.concat(F.lit("["), number, F.lit("]"))).otherwise(F.lit("null"))
    )
    messages = m2_of(table(spark, sf_dir, "events"), F.parse_json(text))
    value = F.get("values", F.lit(0))["value"]
    return messages.select(
        "seq", V.to_double(value).alias("value"), V.coerce_error(value).alias("error")
    )


@query(
    "invalid_messages",
    f"""WITH {M1_SQL}
    SELECT seq, id, bool_or(coalesce(NOT valid AND pidx < portnum - seq % 2, false)) AS invalid
    FROM m1 LEFT JOIN ports ON l_orderkey = seq GROUP BY seq, id""",
)
def invalid_messages(spark, sf_dir):
    portnum = (F.col("portnum") - F.col("seq") % 2).cast("int")
    return m1(spark, sf_dir).select(
        "seq", "id", has_invalid_port(F.col("values"), portnum).alias("invalid")
    )


@query(
    "message_metrics",
    f"""WITH {M1_SQL}
    SELECT count(*) AS valid_num,
           CAST(count(*) FILTER (WHERE seq IN (SELECT l_orderkey FROM ports WHERE NOT valid))
                AS BIGINT) AS invalid_num
    FROM m1""",
)
def metrics(spark, sf_dir):
    return message_metrics(m1(spark, sf_dir))
