"""Messages and rules derived from the given tables, in Spark and in SQL.

M2: one message per event, with one port. M1: one message per order, with its lines as ports.
R1 and R2 are rules for the devices of M2 and M1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.schemas import PORT
from telemill.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Events in a task that makes or reads messages, about: their text takes far longer than the events,
# so that the files of the events are too few tasks.
TASK_ROWS = 25_000


def tasks_of(rows: int) -> int:
    """Among how many tasks so many events are dealt out."""
    return max(1, -(-rows // TASK_ROWS))


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _port(value: Column, valid: Column, unit: Column) -> Column:
    return F.struct(
        value.cast("variant").alias("value"),
        valid.alias("valid"),
        unit.alias("unit"),
        F.lit(None).cast("string").alias("extra"),
    )


def _null() -> Column:
    return F.lit(None).cast("string")


def m2_of(events: DataFrame, value: Column | None = None) -> DataFrame:
    ms = _ms(F.col("ts"))
    port = _port(
        F.col("value") if value is None else value,
        F.col("event_type") != "error",
        _null(),
    )
    return events.select(
        F.col("event_type").alias("app"),
        F.concat(F.lit("dev"), F.col("user_id").cast("string")).alias("id"),
        F.lit(1).alias("portnum"),
        ms.alias("dtimestamp"),
        ms.alias("ptimestamp"),
        F.array(port).alias("values"),
        F.col("event_type").alias("dtype"),
        _null().alias("mtype"),
        F.col("props").alias("desc"),
        _null().alias("com"),
        _null().alias("loc"),
        _null().alias("extra"),
        F.col("event_id").alias("seq"),
    )


def m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m2_of(table(spark, sf_dir, "events"))


def m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    # Sorted by the first four fields, which tell the lines of an order apart.
    line = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    # Partitioned first: lists do not shrink by being collected before the shuffle.
    per_order = (
        lines.select(F.col("l_orderkey").alias("o_orderkey"), line.alias("line"))
        .repartition("o_orderkey")
        .groupBy("o_orderkey")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    ports = F.transform(
        "lines",
        lambda x: _port(x["l_extendedprice"], x["l_returnflag"] != "R", x["l_linestatus"]),
    )
    ms = _ms(F.col("o_orderdate"))
    # Both sides grow with the data, and the lines are already partitioned by order.
    joined = table(spark, sf_dir, "orders").join(per_order.hint("merge"), "o_orderkey", "left")
    return joined.select(
        F.col("o_orderstatus").alias("app"),
        F.concat(F.lit("cust"), F.col("o_custkey").cast("string")).alias("id"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("portnum"),
        ms.alias("dtimestamp"),
        (ms + (F.col("o_orderkey") % 86400) * 1000).alias("ptimestamp"),
        F.when(F.col("lines").isNotNull(), ports).otherwise(F.array().cast(f"array<{PORT}>")).alias(
            "values"
        ),
        F.col("o_orderpriority").alias("dtype"),
        _null().alias("mtype"),
        _null().alias("desc"),
        _null().alias("com"),
        _null().alias("loc"),
        _null().alias("extra"),
        F.col("o_orderkey").alias("seq"),
    )


def _choose(key: Column, choices: list[str | None]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in choices]), key.cast("int"))


# Commands by user_id % 8 and intervals by user_id % 5; no rule for remainder 7.
R1_COMMANDS = ["NEG", "ADD:10", "SUB:100", "MUL:2", "DIV:100", "RVS", "EXPR1:(X+1)*2-X/4"]
R1_INTERVALS = ["MIN", "HOUR", "DAY", "MIN&HOUR&DAY", None]


def r1(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.filter(user % 8 != 7).select(
        F.lit("all").alias("app"),
        (user + 1).alias("id"),
        F.concat(F.lit("dev"), user.cast("string")).alias("did"),
        F.when(user % 3 == 0, -1).otherwise(0).alias("pidx"),
        _choose(user % 8, R1_COMMANDS).alias("cmd"),
        _choose(user % 5, R1_INTERVALS).alias("avg"),
        F.when(user % 11 == 10, 0).otherwise(1).alias("used"),
    )


# How far the ids of later edits lie above those of R1.
EDIT = 1_000_000_000


def r1_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 followed by one later edit of every rule: a new command, an unsupported one, a wildcard
    with a negative port, or a malformed one, by id % 4."""
    old = r1(spark, sf_dir)
    turn = (F.col("id") - 1) % 4
    return old.unionByName(r1_edits(old, turn))


def r1_edits(old: DataFrame, turn: Column) -> DataFrame:
    return old.select(
        "app",
        (F.col("id") + EDIT).alias("id"),
        "did",
        F.when(turn == 2, F.lit(-5)).otherwise(F.col("pidx")).alias("pidx"),
        _choose(turn, ["MUL:3", "FOO:1", "ADD:1", "ADD"]).alias("cmd"),
        F.lit("HOUR").alias("avg"),
        F.lit(1).alias("used"),
    )


def r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey")
    customers = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    did = F.concat(F.lit("cust"), customer.cast("string")).alias("did")

    def rule(step: int, pidx: int, cmd: str, avg: str):
        return (
            F.lit("all").alias("app"), (customer * 2 + step).alias("id"), did,
            F.lit(pidx).alias("pidx"), F.lit(cmd).alias("cmd"), F.lit(avg).alias("avg"),
            F.lit(1).alias("used"),
        )

    wildcard = customers.filter((customer % 4).isin(0, 1)).select(
        *rule(0, -1, "SUB:100000", "DAY")
    )
    exact = customers.filter((customer % 4).isin(1, 2)).select(*rule(1, 0, "MUL:0.5", "HOUR&DAY"))
    return wildcard.unionByName(exact)


# The same in SQL, as common table expressions.

M2_SQL = """m2 AS (
  SELECT event_type AS app, 'dev' || user_id AS id, event_type AS dtype, props AS "desc",
         1 AS portnum, epoch_us(ts) // 1000 AS dtimestamp, epoch_us(ts) // 1000 AS ptimestamp,
         value, event_type <> 'error' AS valid, event_id AS seq, user_id
  FROM events)"""

M1_SQL = """ports AS (
  SELECT l_orderkey,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS INTEGER) AS pidx,
         l_extendedprice AS value, l_returnflag <> 'R' AS valid, l_linestatus AS unit
  FROM lineitem),
m1 AS (
  SELECT o_orderstatus AS app, 'cust' || o_custkey AS id, o_orderpriority AS dtype,
         epoch_us(o_orderdate) // 1000 AS dtimestamp,
         epoch_us(o_orderdate) // 1000 + (o_orderkey % 86400) * 1000 AS ptimestamp,
         CAST(coalesce(n, 0) AS INTEGER) AS portnum, o_orderkey AS seq, o_custkey
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
       ON l_orderkey = o_orderkey)"""

R1_SQL = """r1 AS (
  SELECT 'all' AS app, user_id + 1 AS id, 'dev' || user_id AS did,
         CASE WHEN user_id % 3 = 0 THEN -1 ELSE 0 END AS pidx,
         CASE user_id % 8 WHEN 0 THEN 'NEG' WHEN 1 THEN 'ADD:10' WHEN 2 THEN 'SUB:100'
              WHEN 3 THEN 'MUL:2' WHEN 4 THEN 'DIV:100' WHEN 5 THEN 'RVS'
              ELSE 'EXPR1:(X+1)*2-X/4' END AS cmd,
         CASE user_id % 5 WHEN 0 THEN 'MIN' WHEN 1 THEN 'HOUR' WHEN 2 THEN 'DAY'
              WHEN 3 THEN 'MIN&HOUR&DAY' END AS avg,
         CASE WHEN user_id % 11 = 10 THEN 0 ELSE 1 END AS used, user_id
  FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 8 <> 7)"""

R1_EDITED_SQL = (
    R1_SQL
    + f""",
edits AS (
  SELECT app, id + {EDIT} AS id, did,
         CASE WHEN user_id % 4 = 2 THEN -5 ELSE pidx END AS pidx,
         CASE user_id % 4 WHEN 0 THEN 'MUL:3' WHEN 1 THEN 'FOO:1' WHEN 2 THEN 'ADD:1'
              ELSE 'ADD' END AS cmd, 'HOUR' AS avg, 1 AS used, user_id
  FROM r1),
edited AS (SELECT * FROM r1 UNION ALL SELECT * FROM edits)"""
)

R2_SQL = """r2 AS (
  SELECT did, pidx, op, arg, intervals FROM (
    SELECT DISTINCT 'cust' || o_custkey AS did, -1 AS pidx, 'SUB' AS op, 100000.0 AS arg,
           'DAY' AS intervals FROM orders WHERE o_custkey % 4 IN (0, 1)
    UNION ALL
    SELECT DISTINCT 'cust' || o_custkey, 0, 'MUL', 0.5, 'HOUR&DAY'
    FROM orders WHERE o_custkey % 4 IN (1, 2)))"""

# Readings of M2 under R1: the transformed value `x` of every ruled message, null on error.
READ2_SQL = (
    M2_SQL
    + ",\n"
    + R1_SQL
    + """,
ruled2 AS (
  SELECT m2.*, r1.cmd, r1.avg AS spec,
         CASE split_part(cmd, ':', 1)
              WHEN 'NEG' THEN -value WHEN 'ADD' THEN 10.0::DOUBLE + value
              WHEN 'SUB' THEN 100.0::DOUBLE - value WHEN 'MUL' THEN value * 2.0::DOUBLE
              WHEN 'DIV' THEN CASE WHEN value <> 0 THEN 100.0::DOUBLE / value END
              WHEN 'RVS' THEN CASE WHEN value <> 0 THEN 1.0::DOUBLE / value END
              WHEN 'EXPR1' THEN (value + 1.0::DOUBLE) * 2.0::DOUBLE - value / 4.0::DOUBLE END AS x
  FROM m2 LEFT JOIN r1 ON r1.did = m2.id AND r1.used = 1),
grains(avg, "interval") AS (
  VALUES ('MIN', 60000::BIGINT), ('HOUR', 3600000::BIGINT), ('DAY', 86400000::BIGINT)),
read2 AS (
  SELECT id AS did, 0 AS pidx, grains.avg, grains."interval",
         ptimestamp // grains."interval" * grains."interval" AS bucket,
         x, dtimestamp, ptimestamp, seq, app
  FROM ruled2 JOIN grains ON list_contains(string_split(spec, '&'), grains.avg)
  WHERE x IS NOT NULL)"""
)
