"""Time buckets, tumbling sums, rollover records and eviction."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.acceptance.inputs import M2_SQL, READ2_SQL, m2, r1, table
from telemill.acceptance.registry import query
from telemill.functions import times
from telemill.operators import averages as A
from telemill.operators.rules import RuleBook

# Fixed value: the moment of the eviction, 2024-01-30 20:00 UTC.
EVICTION = 1706644800000


def readings2(spark, sf_dir, *keep, intervals=None):
    book = RuleBook.once(r1(spark, sf_dir))
    return A.readings(m2(spark, sf_dir), book, keep, intervals=intervals)


def delayed(rows):
    """Arrival times by which messages of one device overtake each other by up to 12 hours."""
    return rows.withColumn("arrival", F.col("ptimestamp") + (F.col("seq") % 13) * 3600000)


def _rollover_sql(order: str, having: str = "WHERE closer_pts IS NOT NULL") -> str:
    return f"""WITH {READ2_SQL},
    ordered AS (
      SELECT *, {order} AS arrival FROM read2),
    marked AS (
      SELECT *, row_number() OVER w AS rn,
             CASE WHEN lag(bucket) OVER w = bucket THEN 0 ELSE 1 END AS starts
      FROM ordered WINDOW w AS (PARTITION BY did, pidx, "interval" ORDER BY arrival, seq)),
    numbered AS (
      SELECT *, sum(starts) OVER (PARTITION BY did, pidx, "interval" ORDER BY rn) AS run
      FROM marked),
    runs AS (
      SELECT did, pidx, avg, "interval", run, bucket, sum(x) AS total, count(*) AS num,
             arg_min(dtimestamp, rn) AS own_dts, arg_min(ptimestamp, rn) AS own_pts
      FROM numbered GROUP BY ALL),
    closed AS (
      SELECT *, lead(own_dts) OVER w AS closer_dts, lead(own_pts) OVER w AS closer_pts
      FROM runs WINDOW w AS (PARTITION BY did, pidx, "interval" ORDER BY run))
    SELECT did AS id, pidx AS portid, avg, closer_dts AS dtimestamp, closer_pts AS ptimestamp,
           round(total, 4) AS sum, CAST(num AS INTEGER) AS num
    FROM closed {having}"""


def rounded(df):
    return df.withColumn("sum", F.round("sum", 4))


@query(
    "time_bucket",
    f"""WITH {M2_SQL}
    SELECT seq, ptimestamp // 60000 * 60000 AS minute, ptimestamp // 3600000 * 3600000 AS hour,
           ptimestamp // 86400000 * 86400000 AS day, ptimestamp // 7000 * 7000 AS seven_seconds
    FROM m2""",
)
def time_bucket(spark, sf_dir):
    lengths = {**times.NAMED_INTERVALS, "seven_seconds": 7000}
    names = {"MIN": "minute", "HOUR": "hour", "DAY": "day"}
    return m2(spark, sf_dir).select(
        "seq",
        *[
            times.bucket(F.col("ptimestamp"), F.lit(ms)).alias(names.get(name, name))
            for name, ms in lengths.items()
        ],
    )


@query(
    "avg_tumbling",
    f"""WITH {READ2_SQL}
    SELECT did, bucket, round(sum(x), 4) AS sum, count(x) AS num
    FROM read2 WHERE "interval" = 3600000 GROUP BY did, bucket""",
)
def avg_tumbling(spark, sf_dir):
    hours = readings2(spark, sf_dir, intervals=[times.NAMED_INTERVALS["HOUR"]])
    return rounded(A.tumbling(hours)).select("did", "bucket", "sum", "num")


@query(
    "avg_multi_granularity",
    f"""WITH {READ2_SQL}
    SELECT did, pidx, avg, "interval", bucket, round(sum(x), 4) AS sum, count(x) AS num
    FROM read2 GROUP BY did, pidx, avg, "interval", bucket""",
)
def avg_multi_granularity(spark, sf_dir):
    return rounded(A.rolled_up(m2(spark, sf_dir), RuleBook.once(r1(spark, sf_dir))))


# Rules with intervals that nest, and one that only shares a divisor with them.
ROLLED = ["MIN&HOUR&DAY", "HOUR&5400000", "90000&MIN", "DAY"]


@query(
    "avg_rollup",
    f"""WITH {M2_SQL},
    grains(turn, avg, "interval") AS (VALUES
      (0, 'MIN', 60000::BIGINT), (0, 'HOUR', 3600000), (0, 'DAY', 86400000), (1, 'HOUR', 3600000),
      (1, 'INTERVAL5400000', 5400000), (2, 'INTERVAL90000', 90000), (2, 'MIN', 60000),
      (3, 'DAY', 86400000))
    SELECT id AS did, avg, "interval", ptimestamp // "interval" * "interval" AS bucket,
           round(sum(value * 2.0::DOUBLE), 4) AS sum, count(*) AS num
    FROM m2 JOIN grains ON user_id % 4 = turn GROUP BY ALL""",
)
def avg_rollup(spark, sf_dir):
    """All intervals from sums at the grain of each rule."""
    user = F.col("user_id")
    rules = table(spark, sf_dir, "events").select("user_id").distinct().select(
        F.lit("all").alias("app"),
        user.alias("id"),
        F.concat(F.lit("dev"), user.cast("string")).alias("did"),
        F.lit(-1).alias("pidx"),
        F.lit("MUL:2").alias("cmd"),
        F.get(F.array(*map(F.lit, ROLLED)), (user % 4).cast("int")).alias("avg"),
        F.lit(1).alias("used"),
    )
    return rounded(A.rolled_up(m2(spark, sf_dir), RuleBook.once(rules))).drop("pidx")


@query("avg_rollover", _rollover_sql("ptimestamp"))
def avg_rollover(spark, sf_dir):
    runs = A.rollover_in_order(readings2(spark, sf_dir, "seq"), "seq")
    return rounded(A.avg_records(runs))


@query("avg_out_of_order", _rollover_sql("ptimestamp + (seq % 13) * 3600000"))
def avg_out_of_order(spark, sf_dir):
    messages = delayed(m2(spark, sf_dir))
    rows = A.readings(messages, RuleBook.once(r1(spark, sf_dir)), ("arrival", "seq"))
    order = ["arrival", "seq"]
    runs = A.rollover(rows, order, A.slice_cuts(messages, order))
    return rounded(A.avg_records(runs))


@query(
    "avg_evict_idle",
    f"""WITH {READ2_SQL},
    latest AS (
      SELECT did, pidx, avg, "interval", max(bucket) AS bucket FROM read2
      GROUP BY did, pidx, avg, "interval")
    SELECT did, pidx, avg, "interval", bucket, round(sum(x), 4) AS sum, count(x) AS num
    FROM read2 JOIN latest USING (did, pidx, avg, "interval", bucket)
    WHERE bucket >= {EVICTION} - 2 * "interval"
    GROUP BY did, pidx, avg, "interval", bucket""",
)
def avg_evict_idle(spark, sf_dir):
    runs = A.rollover_in_order(readings2(spark, sf_dir, "seq"), "seq")
    return rounded(A.evict_idle(A.still_open(runs), F.lit(EVICTION)))


@query(
    "avg_by_app",
    f"""WITH {READ2_SQL}
    SELECT app, did, avg, "interval", bucket, round(sum(x), 4) AS sum, count(x) AS num
    FROM read2 WHERE app IN ('click', 'view') GROUP BY ALL""",
)
def avg_by_app(spark, sf_dir):
    """Rules and averages of two apps that have the same devices."""
    rules = r1(spark, sf_dir).drop("app")
    apps = F.explode(F.array(F.lit("click"), F.lit("view"))).alias("app")
    book = RuleBook.once(rules.select("*", apps), ("app", "did"))
    rows = A.readings(m2(spark, sf_dir), book)
    return rounded(A.tumbling(rows, A.key_of(book.key))).drop("pidx")
