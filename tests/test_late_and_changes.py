"""Rules as changes, late readings, handed-over buckets, several sources."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from telemill.acceptance import streams
from telemill.acceptance.inputs import tasks_of
from telemill.operators import averages as A
from telemill.operators.clean import clean_messages
from telemill.streaming import averages as SA
from telemill.streaming.clean import clean_stream
from telemill.streaming.late import BucketStore, late_stream
from telemill.streaming.progress import ProgressLog, progress_rows
from telemill.streaming.rule_changes import CHANGE, RuleChanges
from telemill.sources.messages import read_text_stream, union_of_sources
from tests.helpers import message, messages
from tests.test_averages import rows

ONCE = {"availableNow": True}


class Feed:
    """A table of changes that notes what is read of it."""

    def __init__(self, spark):
        self.spark, self.rows, self.asked = spark, [], []

    def add(self, *changes):
        self.rows += [(did, pidx, "app1", i, cmd, None, used, seq)
                      for seq, did, pidx, i, cmd, used in changes]

    def __call__(self, after):
        self.asked.append(after)
        return self.spark.createDataFrame([r for r in self.rows if r[-1] > after], CHANGE)


def values(spark, book):
    sent = messages(spark, *[message([{"value": 1}, {"value": 2}], id=f"d{i}") for i in range(4)])
    cleaned = clean_messages(sent, book).select(
        "id", F.transform("values", lambda p: F.variant_get(p["value"], "$", "double")).alias("v"))
    return {row.id: row.v for row in cleaned.collect()}


def test_rule_changes(spark, tmp_path):
    feed = Feed(spark)
    rules = RuleChanges(spark, feed, str(tmp_path / "rules"))
    assert values(spark, rules.current()) == {f"d{i}": [1, 2] for i in range(4)}
    feed.add((1, "d0", -1, 1, "ADD:1", 1), (2, "d1", 0, 2, "MUL:5", 1), (3, "d1", 1, 3, "NEG", 1))
    first = rules.current()
    assert values(spark, first) == {"d0": [2, 3], "d1": [5, -2], "d2": [1, 2], "d3": [1, 2]}
    # Nothing new: the same book, and no table is read for it.
    assert rules.current() is first and feed.asked == [-1, -1, 3]
    plan = first.devices._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan.split("InMemoryRelation")[0]
    # An edit, a deletion, a malformed and an unsupported rule, and a device that loses its last one.
    feed.add((4, "d1", 0, 2, "MUL:7", 1), (5, "d1", 1, 3, "NEG", 0), (6, "d2", 0, 4, "ADD", 1),
             (7, "d0", -1, 1, "FOO", 1), (8, None, 0, 9, "NEG", 1))
    expected = {"d0": [1, 2], "d1": [7, 2], "d2": [1, 2], "d3": [1, 2]}
    assert values(spark, rules.current()) == expected and rules.high_water == 8
    # A version holds the devices it changes, and no others.
    feed.add((9, "d3", 0, 5, "SUB:9", 1))
    expected["d3"] = [8, 2]
    assert values(spark, rules.current()) == expected
    version = spark.read.parquet(str(tmp_path / "rules" / "versions" / str(rules.versions[-1])))
    assert {row.did for row in version.collect()} == {"d3"}
    # A new run goes on from the manifest.
    again = RuleChanges(spark, feed, str(tmp_path / "rules"), merge_after=2)
    assert values(spark, again.current()) == expected and feed.asked[-1] == 9
    feed.add((10, "d2", 1, 6, "RVS", 1))
    expected["d2"] = [1, 0.5]
    assert values(spark, again.current()) == expected
    assert len(again.versions) == 1 and again.high_water == 10
    third = RuleChanges(spark, feed, str(tmp_path / "rules"))
    assert values(spark, third.current()) == expected


def test_two_streams_cannot_make_one_version(spark, tmp_path):
    feed = Feed(spark)
    one, two = (RuleChanges(spark, feed, str(tmp_path / "rules")) for _ in range(2))
    feed.add((1, "d0", -1, 1, "ADD:1", 1))
    one.current(), two.current()
    assert values(spark, two.current())["d0"] == [2, 3]


def bucketed(store):
    return sorted((r.did, r.bucket, r["sum"], r.num) for r in store.closed().collect())


@pytest.mark.parametrize("delay", [0, 30])
def test_late_readings_are_counted_and_corrected(spark, tmp_path, delay):
    random.seed(delay)
    items = [(i, max(0, i * 3 + random.randrange(-120, 20)), random.randrange(9)) for i in range(240)]
    store = BucketStore(spark, str(tmp_path / "store"), delay)
    mark, late, corrected = None, 0, set()
    for turn in range(6):
        part = items[turn * 40 : turn * 40 + 40]
        frame = rows(spark, part, 50)
        store.add(frame, turn)
        if turn % 2:
            store.add(frame, turn)  # a replay
        behind = [p for _, p, _ in part if mark is not None and p - p % 50 + 50 <= mark]
        late += len(behind)
        corrected |= {(turn, p - p % 50) for p in behind}
        mark = max(m for m in (mark, max(p for _, p, _ in part) - delay) if m is not None)
        assert store.mark(turn) == mark
    assert late > 0
    sums = {}
    for _, p, x in items:
        total, n = sums.get(p - p % 50, (0, 0))
        sums[p - p % 50] = (total + x, n + 1)
    assert bucketed(store) == sorted(("d", b, *v) for b, v in sums.items() if b + 50 <= mark)
    totals = store.totals().collect()
    assert sorted((r.bucket, r["sum"], r.num) for r in totals) == sorted((b, *v) for b, v in sums.items())
    assert sum(r.late_num for r in totals) == late
    sent = [(r.turn, r.bucket) for r in store.records().filter("is_correction").collect()]
    assert sorted(sent) == sorted(corrected)


def test_late_stream_of_runs(spark, tmp_path):
    frame = rows(spark, [(i, i * 10, 1) for i in range(30)], 100)
    folder = str(tmp_path / "in")
    store = BucketStore(spark, str(tmp_path / "store"))
    runs = A.partial_runs(frame, "seq")
    for begin in (0, 20):
        runs.filter((F.col("arrival") >= begin) & (F.col("arrival") < begin + 20)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(runs.schema).parquet(folder)
        late_stream(stream, store, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    assert bucketed(store) == [("d", 0, 10.0, 10), ("d", 100, 10.0, 10)]
    store.add(frame.limit(0), 7)  # nothing, and after a micro-batch that is not there
    assert store.mark(7) is None


def run_rollover(spark, folder, checkpoint, out, frame, **more):
    frame.write.mode("append").parquet(folder)
    stream = spark.readStream.schema(frame.schema).parquet(folder)
    records = SA.rollover_stream(stream, "seq", **more)
    (records.writeStream.format("parquet").outputMode("append").option("path", out)
     .option("checkpointLocation", checkpoint).trigger(**ONCE).start().awaitTermination())
    return sorted((r.id, r["sum"], r.num, r.ptimestamp) for r in spark.read.schema(records.schema).parquet(out).collect())


@pytest.mark.parametrize("emits", [True, False])
def test_eviction_by_event_time(spark, tmp_path, emits):
    SA.use_state_store(spark)
    args = [str(tmp_path / name) for name in ("in", "c", "out")]
    more = {"evict": "event", "emit_on_evict": emits}
    frame = rows(spark, [(1, 1000, 3), (2, 1010, 4)], 100).unionByName(rows(spark, [(3, 1290, 5)], 100, "e"))
    frame = frame.withColumn("app", F.lit("a"))
    found = run_rollover(spark, *args, frame, **more)
    assert found == ([("d", 7.0, 2, 1000)] if emits else [])
    assert [(r.did, r.bucket) for r in SA.open_buckets(spark, args[1]).collect()] == [("e", 1200)]
    # The next reading of the evicted device opens a bucket anew and closes nothing.
    frame = rows(spark, [(4, 1295, 6)], 100).withColumn("app", F.lit("a"))
    assert run_rollover(spark, *args, frame, **more) == found
    frame = rows(spark, [(5, 1350, 1)], 100).withColumn("app", F.lit("a"))
    assert run_rollover(spark, *args, frame, **more) == sorted([*found, ("d", 6.0, 1, 1350)])


def test_a_stream_goes_on_from_open_buckets(spark, tmp_path):
    SA.use_state_store(spark)
    args = [str(tmp_path / name) for name in ("in", "c", "out")]
    history = rows(spark, [(1, 0, 1), (2, 30, 2), (3, 130, 4)], 100)
    runs = A.rollover(history, ["seq"])
    assert A.emitted(runs).count() == 1
    initial = SA.handed_over(A.still_open(runs))
    frame = rows(spark, [(4, 140, 8), (5, 210, 1)], 100).withColumn("app", F.lit("a"))
    assert run_rollover(spark, *args, frame, initial=initial) == [("d", 12.0, 2, 210)]
    held = SA.open_buckets(spark, args[1])
    assert [(r.did, r.bucket, r["sum"], r.app) for r in held.collect()] == [("d", 200, 1.0, "a")]
    # A restart has its own state; another stream can begin with it.
    frame = rows(spark, [(6, 300, 2)], 100).withColumn("app", F.lit("a"))
    assert run_rollover(spark, *args, frame, initial=initial)[-1] == ("d", 12.0, 2, 210)
    other = [str(tmp_path / name) for name in ("in2", "c2", "out2")]
    more = SA.handed_over(SA.open_buckets(spark, args[1]))
    frame = rows(spark, [(7, 400, 2)], 100).withColumn("app", F.lit("a"))
    assert run_rollover(spark, *other, frame, initial=more) == [("d", 2.0, 1, 400)]


def test_devices_share_one_state_value(spark, tmp_path, monkeypatch):
    """Devices of a shard in one value and with one timer, with the records of each for itself."""
    SA.use_state_store(spark)
    monkeypatch.setattr(SA, "SHARDS", 2)
    args = [str(tmp_path / name) for name in ("in", "c", "out")]
    more = {"evict": "event", "emit_on_evict": True}

    def of(*items):
        frames = [rows(spark, [(i, t, x)], 100 * (1 + n % 3), f"d{n}") for i, n, t, x in items]
        frame = frames[0]
        for other in frames[1:]:
            frame = frame.unionByName(other)
        return frame.withColumn("app", F.lit("a")).coalesce(1)

    # Buckets of 100, 200 and 300 ms that begin at 0, 600 or 1200; the newest reading is at 1250.
    first = [(n, n, 600 * (n // 5) + 10 * (n % 5) + 10, n) for n in range(15)]
    expected = []
    marks = {n: 600 * (n // 5) + 2 * 100 * (1 + n % 3) for n in range(15)}
    expected += [(f"d{n}", float(x), 1, t) for _, n, t, x in first if marks[n] < 1250]
    found = run_rollover(spark, *args, of(*first), **more)
    assert found == sorted(expected) and 0 < len(found) < 15
    state = spark.read.format("statestore").option("path", args[1]).option("stateVarName", "open").load()
    assert state.count() == 2
    still = {f"d{n}" for n in range(15) if marks[n] >= 1250}
    assert {r.did for r in SA.open_buckets(spark, args[1]).collect()} == still
    # Open buckets of two devices are closed, out of order within the file.
    second = [(21, 14, 1850, 2), (20, 14, 1290, 1), (22, 13, 1500, 5)]
    expected += [("d14", 15.0, 2, 1850), ("d13", 13.0, 1, 1500)]
    later = run_rollover(spark, *args, of(*second), **more)
    assert set(expected) <= set(later)


@pytest.mark.parametrize("policy, complete", [("min", True), ("max", False)])
def test_a_source_that_lags(spark, tmp_path, policy, complete):
    SA.use_state_store(spark)
    folders = [tmp_path / "one", tmp_path / "two"]
    for folder in folders:
        folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def put(source, number, *times):
        lines = [json.dumps(message([{"value": 1}], id=f"d{source}", pts=t)) for t in times]
        (folders[source] / f"{number}.txt").write_text("\n".join([*lines, "broken"]) + "\n")
        time.sleep(0.05)

    put(0, 1, 60000, 70000, 200000)
    put(1, 1, 61000)
    put(1, 2, 62000, 130000, 190000)
    put(1, 3, 63000, 195000)
    try:
        streams = [read_text_stream(spark, str(f), maxFilesPerTrigger="1") for f in folders]
        sent = union_of_sources(streams, policy=policy)
        each = sent.select(
            F.col("id").alias("did"), F.lit(0).alias("pidx"), F.lit("MIN").alias("avg"),
            F.lit(60000).cast("bigint").alias("interval"), (F.col("ptimestamp") - F.col("ptimestamp") % 60000).alias("bucket"),
            F.lit(1.0).alias("x"), "ptimestamp", "event_time")
        (SA.window_stream(each).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(**ONCE).start().awaitTermination())
        found = sorted((r.did, r.bucket, r.num) for r in spark.read.schema(
            "did string, bucket bigint, num bigint").parquet(out).collect())
        assert found == [("d0", 60000, 2), ("d1", 60000, 3 if complete else 2), ("d1", 120000, 1)]
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")


def test_a_late_reading_of_an_open_bucket_counts(spark, tmp_path):
    """The watermark has passed the reading, but not the end of its bucket."""
    SA.use_state_store(spark)
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "c"))
    for times in ((60, 150), (110, 260), (120,)):
        frame = rows(spark, [(i, t, 1) for i, t in enumerate(times)], 100)
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = SA.window_stream(spark.readStream.schema(frame.schema).parquet(folder))
        (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(**ONCE).start().awaitTermination())
    found = spark.read.schema(stream.schema).parquet(out).collect()
    assert sorted((r.bucket, r.num) for r in found) == [(0, 1), (100, 2)]


def test_streams_of_one_query_share_the_cleaning(spark, tmp_path, monkeypatch):
    started = []

    def counted(*args, **more):
        started.append(1)
        return clean_stream(*args, **more)

    monkeypatch.setattr(streams, "clean_stream", counted)
    events = [
        (i, f"2024-01-01 {i // 4:02d}:{i % 4}0:00", i % 2 + 1, "view", float(i), "{}") for i in range(60)
    ]
    spark.createDataFrame(
        events, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    found = streams.stream_evict_idle(spark, str(tmp_path)).collect()
    assert len(started) == streams.TURNS
    # Each hour of user 1 is closed by the next; the last stays open, as does the day of user 2.
    hours = [(r.emits, r.ptimestamp) for r in found if r.id == "dev1" and r.avg == "HOUR"]
    begin = 1704067200000
    assert sorted(hours) == sorted((e, begin + h * 3_600_000) for e in (True, False) for h in range(1, 15))


def test_events_are_dealt_out_by_their_number():
    assert [tasks_of(n) for n in (0, 1, 25_000, 25_001, 6_000_000)] == [1, 1, 1, 2, 240]


def test_reports_are_written_in_groups(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"), group=2)

    class Event:
        def __init__(self, n):
            report = {"name": "q", "batchId": n, "numInputRows": 1, "durationMs": {"triggerExecution": 5, "addBatch": 3}}
            self.progress = type("P", (), {"json": json.dumps(report)})

    for n in range(5):
        log.onQueryProgress(Event(n))
    assert progress_rows(spark, str(tmp_path / "log")).count() == 4
    log.onQueryTerminated(None)
    assert progress_rows(spark, str(tmp_path / "log")).agg(F.max("records_so_far")).first()[0] == 5
