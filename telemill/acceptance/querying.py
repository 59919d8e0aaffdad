"""The flattened view, the filters of the sample job, and SQL over the view."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.acceptance.inputs import M1_SQL, M2_SQL, m1, m2
from telemill.acceptance.registry import query
from telemill.functions import times
from telemill.functions import values as V
from telemill.operators import filters
from telemill.plans import query as Q

DAY = times.DAY_MS
# 2024-01-10, 2024-01-12 and 2024-01-20 UTC.
BEGIN, SECOND, END = 1704844800000, 1705017600000, 1705708800000

M2_COLUMNS = ("seq", "app", "id", "ptimestamp")
M2_VALUE = M2_SQL + ",\ndeviceValue AS (SELECT id AS did, 0 AS pidx, dtimestamp, ptimestamp, " \
    "\"desc\", value, valid FROM m2)"


@query(
    "device_value",
    f"""WITH {M1_SQL}
    SELECT id AS did, 1 AS pidx, dtimestamp, ptimestamp, NULL::VARCHAR AS "desc",
           coalesce(value, 0.0::DOUBLE) AS value, coalesce(valid, false) AS valid
    FROM m1 LEFT JOIN (SELECT * FROM ports WHERE pidx = 1) ON l_orderkey = seq""",
)
def device_value(spark, sf_dir):
    return Q.device_value(m1(spark, sf_dir), 1)


@query(
    "render_rows",
    f"""WITH {M2_SQL}
    SELECT '[' || seq || ',' || id || ',' || ptimestamp || ','
           || CASE WHEN valid THEN app ELSE 'null' END || ']' AS row
    FROM m2""",
)
def render_rows(spark, sf_dir):
    named = m2(spark, sf_dir).select(
        "seq", "id", "ptimestamp", F.when(F.col("app") != "error", F.col("app")).alias("app")
    )
    return Q.render_rows(named)


def _filtered(name, where, condition):
    @query(name, f"WITH {M2_SQL} SELECT seq, app, id, ptimestamp FROM m2 WHERE {where}")
    def run(spark, sf_dir):
        return m2(spark, sf_dir).filter(condition()).select(*M2_COLUMNS)

    return run


_filtered(
    "filter_time_range",
    f"ptimestamp BETWEEN {BEGIN} AND {END}",
    lambda: filters.in_time_range(F.col("ptimestamp"), BEGIN, END),
)
_filtered(
    "filter_interval_sample",
    "ptimestamp % 60000 <= 1000",
    lambda: filters.sampled(F.col("ptimestamp"), 60000),
)
_filtered(
    "filter_properties",
    """dtype = 'click' AND "desc" LIKE '{"k": 7}'""",
    lambda: filters.property_equals("dtype", "click") & filters.property_equals("desc", '{"k": 7}'),
)


@query(
    "filter_extra_properties",
    f"""WITH {M2_SQL}
    SELECT seq, app, id, ptimestamp FROM m2 WHERE seq % 5 = 3 AND seq % 2 = 0""",
)
def filter_extra_properties(spark, sf_dir):
    # `site` is a number in even messages and text in odd ones; only the number is equal to 3.
    site = F.col("seq") % 5
    messages = m2(spark, sf_dir).withColumn(
        "extra",
        F.when(F.col("seq") % 2 == 0, F.to_json(F.struct(site.alias("site")))).otherwise(
            F.to_json(F.struct(site.cast("string").alias("site")))
        ),
    )
    return messages.filter(filters.property_equals("site", 3)).select(*M2_COLUMNS)


@query(
    "filter_missing_pts",
    f"""WITH {M2_SQL},
    gaps AS (SELECT seq, app, CASE WHEN seq % 3 <> 0 THEN ptimestamp END AS pts FROM m2)
    SELECT 'off' AS bounds, seq, app, pts AS ptimestamp FROM gaps
    UNION ALL SELECT 'on', seq, app, pts FROM gaps WHERE pts >= {BEGIN}""",
)
def filter_missing_pts(spark, sf_dir):
    gaps = m2(spark, sf_dir).select(
        "seq", "app", F.when(F.col("seq") % 3 != 0, F.col("ptimestamp")).alias("ptimestamp")
    )
    pts = F.col("ptimestamp")
    passes = F.array(
        F.when(filters.time_filter(pts), F.lit("off")),
        F.when(filters.time_filter(pts, btime=BEGIN), F.lit("on")),
    )
    return gaps.select(F.explode(passes).alias("bounds"), "*").filter("bounds IS NOT NULL")


@query(
    "day_keys",
    f"""WITH {M2_SQL}
    SELECT seq, strftime(make_timestamp(ptimestamp * 1000), '%Y%m%d') AS main_day,
           strftime(make_timestamp(ptimestamp * 1000), '%Y-%m-%d') AS backup_day,
           strftime(make_timestamp(ptimestamp * 1000), '%Y-%m-%d_%H') AS hour
    FROM m2""",
)
def day_keys(spark, sf_dir):
    pts = F.col("ptimestamp")
    return m2(spark, sf_dir).select(
        "seq",
        times.day_key(pts, "yyyyMMdd").alias("main_day"),
        times.day_key(pts).alias("backup_day"),
        times.hour_key(pts).alias("hour"),
    )


SAMPLE = {"btime": BEGIN, "etime": END, "interval": 3600000, "delta": 600000}
SAMPLE_WHERE = (
    f"ptimestamp BETWEEN {BEGIN} AND {END} AND ptimestamp % 3600000 <= 600000 AND dtype = 'view'"
)


@query(
    "sample_messages",
    f"""WITH {M2_SQL}
    SELECT seq, app, id, ptimestamp, value, valid FROM m2 WHERE {SAMPLE_WHERE}
    ORDER BY ptimestamp, dtimestamp, id""",
)
def sample_messages(spark, sf_dir):
    found = Q.sample_messages(m2(spark, sf_dir), **SAMPLE, properties={"dtype": "view"})
    port = F.get("values", F.lit(0))
    return found.select(
        *M2_COLUMNS, V.to_double(port["value"]).alias("value"), port["valid"].alias("valid")
    )


@query(
    "sample_messages_json",
    f"""WITH {M2_SQL}
    SELECT '{{"app":"' || app || '","id":"' || id || '","portnum":1,"dtimestamp":' || dtimestamp
           || ',"ptimestamp":' || ptimestamp || ',"values":[{{"value":' || value || ',"valid":'
           || valid || '}}],"dtype":"' || dtype || '","desc":"' || replace("desc", '"', '\\"')
           || '"}}' AS value
    FROM m2 WHERE {SAMPLE_WHERE}""",
)
def sample_messages_json(spark, sf_dir):
    found = Q.sample_messages(m2(spark, sf_dir), **SAMPLE, properties={"dtype": "view"})
    return Q.as_json(found.drop("seq"))


def _sql(name, text, oracle=None):
    """A query on the view, handed over as text; the same text runs on the view in SQL."""

    @query(name, f"WITH {M2_VALUE} " + (oracle or text))
    def run(spark, sf_dir):
        return Q.run_sql(m2(spark, sf_dir), text, port=0)

    return run


_DAILY = (
    f"(SELECT did, ptimestamp - ptimestamp % {DAY} AS day, count(*) AS n, "
    "count(CASE WHEN valid THEN 1 END) AS n_valid, "
    "CAST(max(value) AS DOUBLE) AS top FROM deviceValue GROUP BY 1, 2)"
)

_sql(
    "sql_filter_project",
    "SELECT did, ptimestamp, value * 2 AS twice FROM deviceValue WHERE valid AND value > 100",
)
_sql(
    "sql_group_having",
    "SELECT did, count(*) AS n, max(value) AS top FROM deviceValue GROUP BY did "
    "HAVING count(*) > 60",
)
_sql("sql_distinct", "SELECT DISTINCT did, valid FROM deviceValue")
_sql(
    "sql_rollup_cube",
    "SELECT day, valid, count(*) AS n, CAST(grouping(day) AS INTEGER) AS all_days, "
    "CAST(grouping(valid) AS INTEGER) AS all_flags "
    f"FROM (SELECT ptimestamp - ptimestamp % {DAY} AS day, valid FROM deviceValue) AS d "
    "GROUP BY CUBE (day, valid)",
)
_sql(
    "sql_self_join",
    f"SELECT a.did, a.day, a.n, b.n AS n_next FROM {_DAILY} AS a JOIN {_DAILY} AS b "
    f"ON a.did = b.did AND b.day = a.day + {DAY}",
)
# Devices are made distinct before they are joined, so that a hot one is one row.
_sql(
    "sql_semi_anti",
    "SELECT did FROM (SELECT DISTINCT did FROM deviceValue) AS d "
    "WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT did FROM deviceValue WHERE value > 150) AS h "
    "WHERE h.did = d.did) "
    "AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT did FROM deviceValue "
    f"WHERE NOT valid AND ptimestamp < {BEGIN - 7 * DAY}) AS b WHERE b.did = d.did)",
)
_sql(
    "sql_window",
    "SELECT did, day, n, CAST(rank() OVER (PARTITION BY did ORDER BY n DESC) AS INTEGER) AS rnk, "
    "CAST(sum(n) OVER (PARTITION BY did ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) "
    f"AS BIGINT) AS week FROM {_DAILY} AS d",
)
_sql(
    "sql_topk",
    f"SELECT did, day, n, top FROM {_DAILY} AS d ORDER BY n DESC, top DESC, did, day LIMIT 20",
)
_sql(
    "sql_set_ops",
    "SELECT DISTINCT did FROM deviceValue WHERE value > 120 "
    f"INTERSECT SELECT DISTINCT did FROM deviceValue WHERE ptimestamp < {SECOND} "
    "EXCEPT SELECT DISTINCT did FROM deviceValue WHERE value < 1",
)
_sql(
    "sql_scalar_functions",
    "SELECT upper(did) AS name, CAST(length(desc) AS BIGINT) AS n_chars, CAST(floor(value) AS BIGINT) AS whole, "
    "CASE WHEN valid THEN 'ok' ELSE 'bad' END AS flag, coalesce(nullif(did, 'dev1'), '-') AS other, "
    "ptimestamp % 1000 AS ms FROM deviceValue",
    "SELECT upper(did) AS name, length(\"desc\") AS n_chars, CAST(floor(value) AS BIGINT) AS whole, "
    "CASE WHEN valid THEN 'ok' ELSE 'bad' END AS flag, coalesce(nullif(did, 'dev1'), '-') AS other, "
    "ptimestamp % 1000 AS ms FROM deviceValue",
)
