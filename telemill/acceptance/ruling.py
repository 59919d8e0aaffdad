"""Rule tables, rule lookup, actions and cleaned messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.acceptance.inputs import (
    EDIT, M1_SQL, M2_SQL, R1_EDITED_SQL, R1_SQL, R2_SQL, m1, m2, m2_of, r1, r1_edited, r1_edits,
    r2, table, tasks_of,
)
from telemill.acceptance.registry import query
from telemill.functions import times
from telemill.functions import values as V
from telemill.functions.formula import to_column
from telemill.operators import rules as R
from telemill.operators.clean import clean_messages, explode_ports, rule_lookup
from telemill.plans.query import device_value
from telemill.sources.messages import accepted, decode, to_wire

# A rule id of R1, as a high-water mark.
MARK = 8


@query(
    "rules_incremental",
    f"""WITH {R1_SQL}
    SELECT did, pidx, id, cmd, avg FROM r1 WHERE id >= {MARK} + 1 AND used = 1""",
)
def rules_incremental(spark, sf_dir):
    return R.rules_after(r1(spark, sf_dir), MARK).select("did", "pidx", "id", "cmd", "avg")


@query(
    "rules_high_water",
    f"WITH {R1_SQL} SELECT app, max(id) AS last_id FROM r1 WHERE id > {MARK} AND used = 1 GROUP BY app",
)
def rules_high_water(spark, sf_dir):
    return R.high_water(r1(spark, sf_dir), MARK)


@query(
    "rules_apply_changes",
    # Old rules stay where the change is malformed (3), or where it sets another port (2).
    f"""WITH {R1_SQL}
    SELECT did, pidx, id, cmd, avg FROM r1
    WHERE used = 1 AND (user_id % 4 = 3 OR (user_id % 4 = 2 AND pidx <> -1))
    UNION ALL SELECT did, pidx, id + {EDIT}, 'MUL:3', 'HOUR' FROM r1 WHERE user_id % 4 = 0
    UNION ALL SELECT did, -1, id + {EDIT}, 'ADD:1', 'HOUR' FROM r1 WHERE user_id % 4 = 2""",
)
def rules_apply_changes(spark, sf_dir):
    # The re-read rows replace (turn 0), delete (turn 1, unsupported) or add a wildcard (turn 2);
    # malformed ones (turn 3) change nothing.
    old = r1(spark, sf_dir)
    changes = r1_edits(old, (F.col("id") - 1) % 4).withColumn("seq", F.col("id"))
    return R.apply_rule_changes(R.rules_after(old), changes).select(
        "did", "pidx", "id", "cmd", "avg"
    )


EFFECTIVE_SQL = f"""{R1_EDITED_SQL},
latest AS (
  SELECT *, row_number() OVER (PARTITION BY did, port ORDER BY id DESC) AS rn
  FROM (SELECT *, greatest(pidx, -1) AS port FROM edited WHERE used = 1 AND cmd <> 'ADD')),
effective AS (
  SELECT did, CAST(port AS INTEGER) AS pidx, id, split_part(cmd, ':', 1) AS op,
         CASE WHEN split_part(cmd, ':', 1) IN ('ADD', 'SUB', 'MUL', 'DIV')
              THEN TRY_CAST(split_part(cmd, ':', 2) AS DOUBLE) END AS arg,
         CASE WHEN cmd LIKE 'EXPR1:%' THEN split_part(cmd, ':', 2) END AS formula
  FROM latest WHERE rn = 1 AND cmd NOT LIKE 'FOO%')"""


@query(
    "rules_effective",
    f"WITH {EFFECTIVE_SQL} SELECT did, pidx, id, op, arg, formula FROM effective",
)
def rules_effective(spark, sf_dir):
    return R.effective_rules(r1_edited(spark, sf_dir)).select(
        "did", "pidx", "id", "op", "arg", "formula"
    )


@query(
    "rules_merge_keep",
    f"""WITH {R1_SQL}
    SELECT did, CASE WHEN user_id % 5 = 0 THEN pidx WHEN user_id % 4 = 2 THEN -5 ELSE pidx END
           AS pidx,
           CASE WHEN user_id % 5 = 0 THEN cmd ELSE
             CASE user_id % 4 WHEN 0 THEN 'MUL:3' WHEN 1 THEN 'FOO:1' WHEN 2 THEN 'ADD:1'
                  ELSE 'ADD' END END AS cmd
    FROM r1""",
)
def rules_merge_keep(spark, sf_dir):
    old = r1(spark, sf_dir)
    new = r1_edits(old, (F.col("id") - 1) % 4)
    keep = (
        table(spark, sf_dir, "events").filter(F.col("user_id") % 5 == 0)
        .select(F.concat(F.lit("dev"), F.col("user_id").cast("string")).alias("did")).distinct()
    )
    return R.merge_keeping(old, new, keep).select("did", "pidx", "cmd")


@query(
    "rules_remove_device",
    f"""WITH {R1_SQL}
    SELECT did, pidx, id, cmd FROM r1
    WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id
                          HAVING count(*) FILTER (WHERE event_type = 'error') >= 15)""",
)
def rules_remove_device(spark, sf_dir):
    failing = (
        m2(spark, sf_dir).groupBy(F.col("id").alias("did"))
        .agg(F.count_if(F.col("app") == "error").alias("errors")).filter("errors >= 15")
    )
    return R.remove_devices(r1(spark, sf_dir), failing).select("did", "pidx", "id", "cmd")


@query(
    "parse_rules",
    f"""WITH {R1_EDITED_SQL}
    SELECT id, did, split_part(cmd, ':', 1) AS op,
           CASE WHEN split_part(cmd, ':', 1) IN ('ADD', 'SUB', 'MUL', 'DIV')
                THEN TRY_CAST(nullif(split_part(cmd, ':', 2), '') AS DOUBLE) END AS arg,
           CASE WHEN cmd LIKE 'EXPR1:%' THEN split_part(cmd, ':', 2) END AS formula,
           cmd NOT LIKE 'FOO%' AS supported,
           CASE WHEN cmd = 'ADD' THEN 'missing_argument' END AS reject
    FROM edited""",
)
def parse_rules(spark, sf_dir):
    return R.parse_rules(r1_edited(spark, sf_dir)).select(
        "id", "did", "op", "arg", "formula", "supported", "reject"
    )


@query(
    "parse_avg_spec",
    f"""WITH {R1_SQL},
    named AS (
      SELECT id, did, 'MIN' AS avg, 60000 AS ms FROM r1 WHERE avg LIKE '%MIN%'
      UNION ALL SELECT id, did, 'HOUR', 3600000 FROM r1 WHERE avg LIKE '%HOUR%'
      UNION ALL SELECT id, did, 'DAY', 86400000 FROM r1 WHERE avg LIKE '%DAY%'),
    numbered AS (
      SELECT id, did, id * 1000 AS ms FROM r1 WHERE avg IS NOT NULL
      UNION SELECT id, did, 60000 FROM r1 WHERE avg IS NOT NULL)
    SELECT id, did, avg, CAST(ms AS BIGINT) AS ms FROM named
    UNION ALL
    SELECT id, did, 'INTERVAL' || ms, CAST(ms AS BIGINT) FROM numbered AS n
    WHERE NOT EXISTS (SELECT 1 FROM named WHERE named.id = n.id AND named.ms = n.ms)""",
)
def parse_avg_spec(spark, sf_dir):
    rules = r1(spark, sf_dir)
    spec = F.concat("avg", F.lit("&"), (F.col("id") * 1000).cast("string"), F.lit("&bogus&60000"))
    return rules.select("id", "did", F.inline(times.parse_intervals(spec)))


@query(
    "rule_lookup",
    f"""WITH {M1_SQL},
    {R2_SQL}
    SELECT seq, ports.pidx, coalesce(exact.op, anyport.op) AS op,
           CAST(coalesce(exact.arg, anyport.arg) AS DOUBLE) AS arg,
           CAST(coalesce(exact.pidx, anyport.pidx) AS INTEGER) AS rule_port
    FROM m1 JOIN ports ON l_orderkey = seq
    LEFT JOIN r2 AS exact ON exact.did = m1.id AND exact.pidx = ports.pidx
    LEFT JOIN r2 AS anyport ON anyport.did = m1.id AND anyport.pidx = -1""",
)
def lookup(spark, sf_dir):
    book = R.RuleBook.once(r2(spark, sf_dir))
    return rule_lookup(m1(spark, sf_dir), book).select(
        "seq", "pidx", F.col("rule.op").alias("op"), F.col("rule.arg").alias("arg"), "rule_port"
    )


@query(
    "cleaned_messages",
    f"""WITH {M1_SQL},
    {R2_SQL}
    SELECT seq, m1.app, m1.id, ports.pidx, valid, unit,
           CASE coalesce(exact.op, anyport.op)
                WHEN 'MUL' THEN value * 0.5::DOUBLE WHEN 'SUB' THEN 100000.0::DOUBLE - value
                ELSE value END AS value
    FROM m1 JOIN ports ON l_orderkey = seq
    LEFT JOIN r2 AS exact ON exact.did = m1.id AND exact.pidx = ports.pidx
    LEFT JOIN r2 AS anyport ON anyport.did = m1.id AND anyport.pidx = -1""",
)
def cleaned_messages(spark, sf_dir):
    book = R.RuleBook.once(r2(spark, sf_dir))
    cleaned = clean_messages(m1(spark, sf_dir), book)
    return explode_ports(cleaned).select(
        "seq", "app", "id", "pidx", "valid", "unit", V.to_double(F.col("value")).alias("value")
    )


# One user in a hundred has rules of their own for 5,000 ports, beside one rule for the others.
WIDE, WIDE_SHARE = 5000, 100


@query(
    "cleaned_wide_device",
    f"""WITH {M2_SQL}
    SELECT seq, value + (CASE WHEN user_id % {WIDE_SHARE} <> 0 THEN 3 WHEN user_id % 3 = 0 THEN 1
                         ELSE 7 END)::DOUBLE AS value
    FROM m2""",
)
def cleaned_wide_device(spark, sf_dir):
    """Every message, of wide devices and of those with one rule for any port. The port of the wide
    ones' messages has a rule of its own for a third of them."""
    user = F.col("user_id")
    is_wide = user % WIDE_SHARE == 0
    ports = F.when(user % 3 == 0, F.sequence(F.lit(0), F.lit(WIDE))).otherwise(
        F.sequence(F.lit(1), F.lit(WIDE))
    )
    every = F.array(F.lit(R.ANY_PORT))
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    rules = users.select(
        "user_id", F.explode(F.when(is_wide, F.concat(every, ports)).otherwise(every)).alias("pidx")
    ).select(
        F.lit("all").alias("app"),
        (user * 10_000 + F.col("pidx") + 2).alias("id"),
        F.concat(F.lit("dev"), user.cast("string")).alias("did"),
        "pidx",
        F.when(F.col("pidx") != R.ANY_PORT, F.lit("ADD:1"))
        .when(is_wide, F.lit("ADD:7"))
        .otherwise(F.lit("ADD:3"))
        .alias("cmd"),
        F.lit(None).cast("string").alias("avg"),
        F.lit(1).alias("used"),
    )
    cleaned = clean_messages(m2(spark, sf_dir), R.RuleBook.once(rules))
    return explode_ports(cleaned).select("seq", V.to_double(F.col("value")).alias("value"))


@query(
    "cleaned_by_formula",
    f"""WITH {M2_SQL}
    SELECT seq, CASE WHEN user_id % 7 = 6 THEN value
                ELSE (value + user_id::DOUBLE) * 2.0::DOUBLE - value / 4.0::DOUBLE END AS value
    FROM m2""",
)
def cleaned_by_formula(spark, sf_dir):
    """A formula of its own for each user; one in seven does not compile."""
    user = F.col("user_id").cast("string")
    text = F.when(
        F.col("user_id") % 7 == 6, F.concat(F.lit("EXPR1:(X+"), user)
    ).otherwise(F.concat(F.lit("EXPR1:(X+"), user, F.lit(")*2-X/4")))
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    rules = users.select(
        F.lit("all").alias("app"),
        F.col("user_id").alias("id"),
        F.concat(F.lit("dev"), user).alias("did"),
        F.lit(0).alias("pidx"),
        text.alias("cmd"),
        F.lit(None).cast("string").alias("avg"),
        F.lit(1).alias("used"),
    )
    cleaned = clean_messages(m2(spark, sf_dir), R.RuleBook.once(rules))
    return explode_ports(cleaned).select("seq", V.to_double(F.col("value")).alias("value"))


@query(
    "cleaned_wire_errors",
    f"""WITH {M2_SQL},
    small AS (SELECT *, CAST(floor(value) AS BIGINT) % 5 AS v FROM m2)
    SELECT seq, CASE WHEN v <> 0 THEN 100.0::DOUBLE / v::DOUBLE END AS value,
           CASE WHEN v = 0 THEN 'division_by_zero' END AS error,
           CASE WHEN v = 0 THEN 0.0::DOUBLE END AS original,
           CASE WHEN v <> 0 THEN 100.0::DOUBLE / v::DOUBLE END AS shown, valid AS shown_valid
    FROM small""",
)
def cleaned_wire_errors(spark, sf_dir):
    """A division of small numbers, over the wire and back, and as the query view shows it."""
    events = table(spark, sf_dir, "events")
    dealt = events.repartition(tasks_of(events.count()), "event_id")
    messages = m2_of(dealt, _small(F.col("value")))
    rules = events.select("user_id").distinct().select(
        F.lit("all").alias("app"),
        F.col("user_id").alias("id"),
        F.concat(F.lit("dev"), F.col("user_id").cast("string")).alias("did"),
        F.lit(R.ANY_PORT).alias("pidx"),
        F.lit("DIV:100").alias("cmd"),
        F.lit(None).cast("string").alias("avg"),
        F.lit(1).alias("used"),
    )
    sent = to_wire(clean_messages(messages, R.RuleBook.once(rules)))
    back = accepted(decode(sent))
    port = F.get("values", F.lit(0))
    # The view beside the messages it is made of, so that the text is read once.
    return device_value(back, 0, keep=("seq", "values")).select(
        "seq",
        V.to_double(port["value"]).alias("value"),
        F.get_json_object(port["extra"], "$.action_error").alias("error"),
        F.get_json_object(port["extra"], "$.original").cast("double").alias("original"),
        F.col("value").alias("shown"),
        F.col("valid").alias("shown_valid"),
    )


# The actions one by one, on the value of every M2 message. DIV and RVS act on small whole
# numbers, so that division by zero occurs.


def _x(messages):
    return messages.select("seq", V.to_double(F.get("values", F.lit(0))["value"]).alias("x"))


def _action(name, sql, column):
    @query(f"action_{name}", f"WITH {M2_SQL} SELECT seq, {sql} AS y FROM m2")
    def run(spark, sf_dir):
        return _x(m2(spark, sf_dir)).select("seq", column(F.col("x")).alias("y"))

    return run


def _small(x):
    return (F.floor(x) % 5).cast("double")


_SMALL_SQL = "(CAST(floor(value) AS BIGINT) % 5)"

_action("ass", "7.5::DOUBLE", lambda x: V.ass(x, F.lit(7.5)))
_action("add", "10.0::DOUBLE + value", lambda x: V.add(x, F.lit(10.0)))
_action("neg", "-value", V.neg)
_action("sub", "100.0::DOUBLE - value", lambda x: V.sub(x, F.lit(100.0)))
_action("mul", "value * 2.0::DOUBLE", lambda x: V.mul(x, F.lit(2.0)))
_action(
    "div",
    f"CASE WHEN {_SMALL_SQL} <> 0 THEN 100.0::DOUBLE / {_SMALL_SQL}::DOUBLE END",
    lambda x: V.div(_small(x), F.lit(100.0)),
)
_action(
    "rvs",
    f"CASE WHEN {_SMALL_SQL} <> 0 THEN 1.0::DOUBLE / {_SMALL_SQL}::DOUBLE END",
    lambda x: V.rvs(_small(x)),
)
_action(
    "chain",
    "-((10.0::DOUBLE + value) * 2.0::DOUBLE)",
    lambda x: V.chain(
        x, [lambda v: V.add(v, F.lit(10.0)), lambda v: V.mul(v, F.lit(2.0)), V.neg]
    ),
)
_action("fun", "floor(value) + 0.5::DOUBLE", lambda x: V.fun(x, lambda v: F.floor(v) + F.lit(0.5)))

# Formulas by seq % 6, the last two of which do not compile.
FORMULAS = ["(X+1)*2-X/4", "10-X-1", "8/X/2", "X2+", "2X", "(X+1"]


@query(
    "action_expr1",
    f"""WITH {M2_SQL}
    SELECT seq, CASE seq % 6 WHEN 0 THEN (value + 1.0::DOUBLE) * 2.0::DOUBLE - value / 4.0::DOUBLE
                WHEN 1 THEN 10.0::DOUBLE - value - 1.0::DOUBLE
                WHEN 2 THEN 8.0::DOUBLE / value / 2.0::DOUBLE
                WHEN 3 THEN value + 2.0::DOUBLE ELSE value END AS y
    FROM m2""",
)
def action_expr1(spark, sf_dir):
    rows = _x(m2(spark, sf_dir))
    y = F.lit(None).cast("double")
    for turn, text in enumerate(FORMULAS):
        y = F.when(F.col("seq") % 6 == turn, to_column(text, F.col("x"))).otherwise(y)
    return rows.select("seq", y.alias("y"))


@query(
    "action_sql_expr",
    f"WITH {M2_SQL} SELECT seq, CASE WHEN value > 50 THEN value * value ELSE -1.0::DOUBLE END AS y FROM m2",
)
def action_sql_expr(spark, sf_dir):
    rows = _x(m2(spark, sf_dir))
    return V.with_sql_action(rows, "CASE WHEN X > 50 THEN X * X ELSE -1D END", "x", "y").select(
        "seq", "y"
    )
