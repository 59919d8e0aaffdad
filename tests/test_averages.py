import random

import pytest
from pyspark.sql import functions as F

from telemill.operators import averages as A
from telemill.operators.clean import apply_rules
from telemill.operators.rules import RuleBook, effective_rules, grain_of
from tests.helpers import message, messages, rules

SCHEMA = ("seq bigint, ptimestamp bigint, x double, did string, pidx int, avg string, "
          "interval bigint, bucket bigint, dtimestamp bigint")


def rows(spark, items, interval=60000, did="d"):
    """Items of (seq, ptimestamp, value)."""
    data = [(s, p, float(x), did, 0, "MIN", interval, p - p % interval, p + 5) for s, p, x in items]
    return spark.createDataFrame(data, SCHEMA)


def cuts(frame, width):
    return A.slice_cuts(frame, ["seq"], "did", width)


CASE = [(1, 0, 1), (2, 30000, 2), (3, 60000, 4), (4, 59999, 8), (5, 61000, 16)]


def reference(items, interval):
    """Readings in order of arrival: a reading of another bucket closes the open one."""
    out, begin, total, count = [], None, 0.0, 0
    for _, pts, x in sorted(items):
        bucket = pts - pts % interval
        if begin is not None and bucket != begin:
            out.append((begin, total, count, pts))
            total, count = 0.0, 0
        begin, total, count = bucket, total + x, count + 1
    return sorted(out), (begin, total, count)


def closed(runs):
    return sorted((r.bucket, r["sum"], r.num, r.ptimestamp) for r in A.emitted(runs).collect())


@pytest.mark.parametrize("width", [1, 2, 3, 100])
def test_rollover_case(spark, width):
    runs = A.rollover(rows(spark, CASE), ["seq"], cuts(rows(spark, CASE), width)).cache()
    assert closed(runs) == [(0, 3.0, 2, 60000), (0, 8.0, 1, 61000), (60000, 4.0, 1, 59999)]
    assert [tuple(r)[4:] for r in A.still_open(runs).collect()] == [(60000, 16.0, 1)]
    assert sorted((r.bucket, r["sum"], r.num) for r in A.tumbling(rows(spark, CASE)).collect()) == [
        (0, 11.0, 3), (60000, 20.0, 2)]


@pytest.mark.parametrize("seed", range(4))
def test_rollover_of_a_hot_device(spark, seed):
    random.seed(seed)
    per_device, frames = {}, None
    for did, n in (("hot", 400), ("cold", 7), ("one", 1)):
        items = [(i, random.randrange(0, (2 + seed) * 10), random.randrange(9)) for i in range(n)]
        per_device[did] = items
        frame = rows(spark, items, 10, did)
        frames = frame if frames is None else frames.unionByName(frame)
    runs = A.rollover(frames.repartition(5), ["seq"], cuts(frames, 16)).cache()
    for did, items in per_device.items():
        expected, still = reference(items, 10)
        assert closed(runs.filter(F.col("did") == did)) == expected
        assert tuple(A.still_open(runs.filter(F.col("did") == did)).first())[4:] == still


def test_rollover_in_order(spark):
    random.seed(1)
    items = [(i, i * 7, random.randrange(9)) for i in range(300)]
    runs = A.rollover_in_order(rows(spark, items, 100), "seq")
    expected, still = reference(items, 100)
    assert closed(runs) == expected
    assert tuple(A.still_open(runs).first())[4:] == still
    first = A.emitted(runs).orderBy("bucket").first()
    assert first.dtimestamp == first.ptimestamp + 5
    with pytest.raises(Exception, match="not in order"):
        A.rollover_in_order(rows(spark, CASE), "seq").collect()


def test_carried_columns_are_those_of_the_closing_reading(spark):
    frame = rows(spark, CASE).withColumn("app", F.concat(F.lit("a"), F.col("seq")))
    records = A.avg_records(A.rollover(frame, ["seq"], cuts(frame, 2), carry=["app"]), carry=["app"])
    assert sorted((r.app, r["sum"]) for r in records.collect()) == [("a3", 3.0), ("a4", 4.0), ("a5", 8.0)]


def test_eviction(spark):
    state = spark.createDataFrame(
        [("d", 0, "MIN", 60000, b, 1.0, 1) for b in (60000, 79999, 80000, 120000)],
        "did string, pidx int, avg string, interval bigint, bucket bigint, sum double, num bigint")
    left = A.evict_idle(state, F.lit(200000)).collect()
    assert sorted(r.bucket for r in left) == [80000, 120000]


def test_readings(spark):
    book = RuleBook.of(rules(
        spark, (1, "d1", -1, "DIV:8", "MIN&HOUR", 1), (2, "d1", 1, "ADD:1", None, 1)))
    sent = messages(
        spark, message([{"value": 2, "valid": False}, {"value": 1}, {"value": 0}, {"value": None}, {}],
                       pts=61000),
        message([{"value": 2}], id="other"))
    found = A.readings(sent, book, ["app"]).collect()
    assert sorted((r.app, r.did, r.pidx, r.avg, r.interval, r.bucket, r.x) for r in found) == [
        ("app1", "d1", 0, "HOUR", 3600000, 0, 4.0), ("app1", "d1", 0, "MIN", 60000, 60000, 4.0)]


def test_rollover_in_order_over_many_slices(spark):
    random.seed(2)
    items = [(i, i * 40, random.randrange(9)) for i in range(200)]
    frame = rows(spark, items, 100)
    for width in (1, 3, 7, 1000):
        runs = A.rollover_in_order(frame, "seq", width)
        expected, still = reference(items, 100)
        assert closed(runs) == expected
        assert tuple(A.still_open(runs).first())[4:] == still
        with pytest.raises(Exception, match="not in order"):
            A.rollover_in_order(rows(spark, CASE), "seq", width).collect()


def test_a_burst_is_cut_like_any_other_time(spark):
    """Almost all readings of a hot device arrive in one moment, and one of them far off."""
    frame = spark.range(20_000).select(
        F.when(F.col("id") < 18_000, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id"))).alias("did"),
        F.when(F.col("id") == 17_999, F.lit(10**15)).otherwise(F.lit(5)).alias("arrival"),
        F.col("id").alias("seq"),
    )
    found = A.slice_cuts(frame, ["arrival", "seq"], "did", 1000)
    assert [row.did for row in found.collect()] == ["hot"]
    sizes = A._sliced(frame, ["arrival", "seq"], found).groupBy("did", "_slice").count()
    assert max(row["count"] for row in sizes.collect()) <= 2000
    assert A.slice_cuts(frame, ["arrival", "seq"], "did", 20_000) is None


def grains(spark, *specs):
    table = rules(spark, *[(i, f"d{i}", -1, "MUL:2", spec, 1) for i, spec in enumerate(specs)])
    return {row.did: row.grain for row in effective_rules(table).withColumn(
        "grain", grain_of(F.col("intervals"))).collect()}


def test_grains(spark):
    specs = ["MIN&HOUR&DAY", "90000&MIN", "7&11", "DAY", None, "9223372036854775807&9223372036854775806"]
    assert grains(spark, *specs) == {
        "d0": 60000, "d1": 30000, "d2": 1, "d3": 86400000, "d4": None, "d5": 1}


def test_rolled_up_sums_are_those_of_the_readings(spark):
    """Every reading goes into one partial sum, whatever the number of its intervals."""
    random.seed(7)
    book = RuleBook.once(rules(
        spark, (1, "d0", -1, "MUL:2", "MIN&HOUR&DAY", 1), (2, "d1", 0, "ADD:1", "90000&MIN&7000", 1),
        (3, "d2", -1, "RVS", "DAY", 1), (4, "d3", -1, "NEG", None, 1)))
    sent = messages(spark, *[
        message([{"value": random.randrange(4)}, {"value": "x"}, {}], id=f"d{random.randrange(5)}",
                pts=random.randrange(-10**7, 10**8)) for _ in range(400)])
    found = A.rolled_up(sent, book)
    expected = A.tumbling(A.readings(sent, book))
    values = lambda frame: sorted(
        (r.did, r.pidx, r.avg, r.bucket, round(r["sum"], 6), r.num) for r in frame.collect())
    assert values(found) == values(expected) == values(A.tumbling(A.readings_of(apply_rules(sent, book))))
    some = A.rolled_up(sent, book, [60000])
    assert values(some) == values(expected.filter("interval = 60000"))
    # A shuffle of partial sums, and one of what they add up to; none of readings per interval.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline(intervals") < plan.index("keys=[pidx")
