from pyspark.sql import functions as F

from telemill.operators import rules as R
from tests.helpers import RULE_TABLE, rules


def test_rejected_rules(spark):
    bad = [(20, "d", 0, "MUL:x", None, 1), (21, "d", 0, "NEG", "0", 1), (22, "d", 0, "NEG", "-5", 1),
           (23, "d", 0, "ADD:", None, 1), (24, "d", 0, ":", None, 1), (25, "d", 0, "", None, 1),
           (26, "d", 0, "EXPR1", None, 1), (27, "d", 0, "FOO", "0", 1)]
    found = R.rejected_rules(rules(spark, *RULE_TABLE, *bad))
    assert {r.id: r.reject for r in found.collect()} == {
        8: "missing_argument", 20: "bad_number", 21: "bad_interval", 22: "bad_interval",
        23: "missing_argument", 24: "no_command", 26: "missing_argument"}


def test_effective_rules(spark):
    found = R.effective_rules(rules(spark, *RULE_TABLE))
    assert sorted((r.did, r.pidx, r.id) for r in found.collect()) == [
        ("d1", -1, 2), ("d1", 0, 10), ("d2", -1, 4), ("d2", 1, 5), ("d3", 0, 6), ("d3", 1, 7)]


def test_incremental_scan(spark):
    table = rules(spark, *RULE_TABLE, (11, None, 0, "NEG", None, 1), (12, "d", 0, None, None, 1))
    assert sorted(r.id for r in R.rules_after(table, 5).collect()) == [6, 7, 8, 10]
    assert R.high_water(table, 5).first().last_id == 12
    assert R.high_water(table, 12).isEmpty()


def test_change_folding(spark):
    old = rules(spark, (1, "a", 0, "NEG", None, 1), (2, "b", 0, "NEG", None, 1),
                (3, "c", 0, "NEG", None, 1), (4, "d", -1, "NEG", None, 1))
    changes = rules(
        spark, (1, "a", 0, "MUL:2", None, 1), (2, "b", 0, "NEG", None, 0), (3, "c", 0, "FOO", None, 1),
        (4, "d", -9, None, None, 1), (1, "a", 0, "MUL:3", None, 1), (5, "e", 1, "RVS", None, 1),
        (6, "c", 0, "ADD", None, 1), (7, None, 0, "NEG", None, 1),
    ).withColumn("seq", F.monotonically_increasing_id()).coalesce(1)
    found = R.apply_rule_changes(old, changes)
    assert sorted((r.did, r.pidx, r.cmd) for r in found.collect()) == [("a", 0, "MUL:3"), ("e", 1, "RVS")]


def test_merge_keeping(spark):
    old = rules(spark, (1, "a", 0, "NEG", None, 1), (2, "b", 0, "NEG", None, 1))
    new = rules(spark, (3, "a", 0, "RVS", None, 1), (4, "c", 0, "RVS", None, 1), (5, "k", 0, "RVS", None, 1))
    keep = spark.createDataFrame([("a",), ("k",)], "did string")
    assert sorted(r.id for r in R.merge_keeping(old, new, keep).collect()) == [1, 4]
    assert sorted(r.id for r in R.merge_keeping(R.clear_rules(old), new, keep).collect()) == [3, 4, 5]


def test_remove_devices(spark):
    gone = spark.createDataFrame([("d1",), ("d3",)], "did string")
    left = R.remove_devices(rules(spark, *RULE_TABLE), gone)
    assert sorted(r.id for r in left.collect()) == [4, 5, 9]
