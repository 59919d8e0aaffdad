import json
import time

import pytest
from pyspark.sql import functions as F

from telemill.acceptance.streams import run_to_table
from telemill.operators import averages as A
from telemill.streaming import averages as SA
from telemill.streaming.clean import Sinks, clean_stream, parquet_batches
from telemill.streaming.progress import ProgressLog, progress_rows
from telemill.sources import stores
from telemill.sources.stores import BackupStore, MainStore
from telemill.sources.messages import read_text_stream
from tests.helpers import message, rules
from tests.test_averages import CASE, cuts, reference, rows

ONCE = {"availableNow": True}


def put(folder, number, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{number}.txt").write_text("".join(json.dumps(m) + "\n" for m in lines))


def test_rules_are_read_again_and_batches_stored(spark, tmp_path):
    table, inbox = str(tmp_path / "rules"), tmp_path / "in"
    rules(spark, (1, "d1", 0, "ADD:10", "MIN", 1)).write.parquet(table)
    sinks = Sinks(
        forward=parquet_batches(str(tmp_path / "out")), main=MainStore(str(tmp_path / "main")),
        backup=BackupStore(str(tmp_path / "backup")), readings=parquet_batches(str(tmp_path / "readings")),
        quarantine=parquet_batches(str(tmp_path / "bad")))

    def run():
        query = clean_stream(
            read_text_stream(spark, str(inbox)), lambda: spark.read.parquet(table), sinks,
            str(tmp_path / "checkpoint"), trigger=ONCE)
        query.awaitTermination()

    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    put(inbox, 1, message([{"value": 1, "valid": False}]), {"app": "x"})
    run()
    rules(spark, (2, "d1", 0, "MUL:5", "HOUR", 1)).write.mode("overwrite").parquet(table)
    put(inbox, 2, message([{"value": 1}]))
    run()
    time.sleep(3)  # reports come in on a thread of their own
    spark.streams.removeListener(log)
    reports = progress_rows(spark, str(tmp_path / "progress")).filter("num_records > 0")
    first, second = reports.orderBy("batch_id").collect()
    assert (first.num_records, first.valid_num, first.invalid_num) == (2, 2, 1)
    assert (second.records_so_far, second.valid_so_far, second.invalid_so_far) == (3, 3, 1)
    assert first.total_ms >= first.processing_ms > 0
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(json.loads(r.value)["values"][0]["value"] for r in out) == [5.0, 11.0]
    assert sorted((r.avg, r.x) for r in spark.read.parquet(str(tmp_path / "readings")).collect()) == [
        ("HOUR", 5.0), ("MIN", 11.0)]
    assert [r.reject for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["missing_id"]
    assert stores.scan_main(spark, str(tmp_path / "main")).count() == 2
    assert not (tmp_path / "backup").exists()


def write_slices(frame, folder, size, arrival):
    """Files of `size` steps of arrival, oldest first."""
    last = frame.agg(F.max(arrival)).first()[0]
    for begin in range(0, last + 1, size):
        part = frame.filter((F.col(arrival) >= begin) & (F.col(arrival) < begin + size))
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)


@pytest.mark.parametrize("as_runs", [True, False])
def test_rollover_stream_equals_batch(spark, tmp_path, as_runs):
    SA.use_state_store(spark)
    frame = rows(spark, CASE).withColumn("app", F.lit("a"))
    other = [(i, (i * 37) % 90, i) for i in range(1, 12)]
    frame = frame.unionByName(rows(spark, other, 30, "e").withColumn("app", F.lit("b")))
    folder = str(tmp_path / "in")
    if as_runs:
        frame = A.partial_runs(frame, "seq", cuts(frame, 3), carry=["app"])
        assert frame.count() < 16
    arrival = "arrival" if as_runs else "seq"
    write_slices(frame, folder, 4, arrival)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    found = run_to_table(spark, SA.rollover_stream(stream, arrival), "rollover").collect()
    got = sorted((r.id, r["sum"], r.num, r.ptimestamp, r.dtimestamp) for r in found)
    expected = [("d", *e[1:], e[3] + 5) for e in reference(CASE, 60000)[0]]
    expected += [("e", *e[1:], e[3] + 5) for e in reference(other, 30)[0]]
    assert got == sorted(expected)
    assert {(r.id, r.app) for r in found} == {("d", "a"), ("e", "b")}


def test_window_stream_equals_batch_on_closed_windows(spark, tmp_path):
    SA.use_state_store(spark)
    # The watermark begins at 0, and what is not after it counts as late.
    items = [(i, 60000 + i * 11000, i) for i in range(30)]
    frame = rows(spark, items)
    frame = frame.unionByName(rows(spark, items, 70000, "e"))
    folder = str(tmp_path / "in")
    frame.write.parquet(folder)
    stream = spark.readStream.schema(frame.schema).parquet(folder)
    found = run_to_table(spark, SA.window_stream(stream), "windows").collect()
    ended = F.col("bucket") + F.col("interval") <= 60000 + 29 * 11000
    batch = A.tumbling(frame).filter(ended).collect()
    key = lambda r: (r.did, r.interval, r.bucket, r["sum"], r.num)
    assert sorted(map(key, found)) == sorted(map(key, batch))


def test_idle_buckets_are_evicted(spark, tmp_path):
    SA.use_state_store(spark)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    old = rows(spark, [(1, 1000, 3)], 100).withColumn("app", F.lit("a"))
    old.write.parquet(folder)
    stream = spark.readStream.schema(old.schema).parquet(folder)
    records = SA.rollover_stream(stream, "seq", evict=True, emit_on_evict=True)
    query = (records.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 90
        found = []
        while not found and time.time() < deadline:
            time.sleep(2)
            try:
                found = spark.read.schema(records.schema).parquet(out).collect()
            except Exception:
                found = []
    finally:
        query.stop()
    assert [(r.id, r["sum"], r.num) for r in found] == [("d", 3.0, 1)]


def test_average_records_are_forwarded_and_stored(spark, tmp_path):
    SA.use_state_store(spark)
    folder = str(tmp_path / "in")
    frame = rows(spark, CASE).withColumn("app", F.lit("a"))
    frame.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(frame.schema).parquet(folder)

    def broken(batch, number):
        raise OSError("main store is down")

    sinks = Sinks(forward=parquet_batches(str(tmp_path / "out")), main=broken,
                  backup=BackupStore(str(tmp_path / "backup")))
    SA.store_records(SA.rollover_stream(stream, "seq"), sinks, str(tmp_path / "c"),
                     trigger=ONCE).awaitTermination()
    expected = {"id": "d", "portid": 0, "avg": "MIN", "dtimestamp": 60005, "ptimestamp": 60000,
                "sum": 3.0, "num": 2}
    for path in ("out", "backup"):
        reader = spark.read.schema("value string")
        table = reader.parquet if path == "out" else reader.text
        found = [json.loads(r.value) for r in table(str(tmp_path / path)).collect()]
        assert len(found) == 3 and expected in found
    SA.store_records(
        SA.rollover_stream(stream, "seq"), Sinks(main=MainStore(str(tmp_path / "main"))),
        str(tmp_path / "c2"), trigger=ONCE).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "main")).filter("app = 'a'").count() == 3


def test_a_replayed_batch_is_averaged_once(spark, tmp_path):
    """A batch written, its commit lost: it is written again, and the reader sees it once."""
    path = str(tmp_path / "readings")
    frame = rows(spark, CASE).withColumn("app", F.lit("a"))
    write = parquet_batches(path)

    def read():
        stream = spark.readStream.schema(frame.schema).parquet(path)
        (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start().awaitTermination())

    write(frame, "b-0")
    read()
    write(frame.withColumn("x", F.col("x") + 1), "b-0")
    read()
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 4, 8, 16]


def test_averages_of_two_apps(spark, tmp_path):
    SA.use_state_store(spark)
    key = ("app", *A.KEY)
    one = rows(spark, CASE).withColumn("app", F.lit("a"))
    frame = one.unionByName(one.withColumns({"app": F.lit("b"), "x": F.col("x") * 2}))
    assert sorted((r.app, r["sum"]) for r in A.tumbling(frame, key).collect()) == [
        ("a", 11.0), ("a", 20.0), ("b", 22.0), ("b", 40.0)]
    folder = str(tmp_path / "in")
    frame.write.parquet(folder)
    stream = spark.readStream.schema(frame.schema).parquet(folder)
    found = run_to_table(spark, SA.rollover_stream(stream, "seq", key=key), "apps").collect()
    assert sorted((r.app, r["sum"]) for r in found) == [
        ("a", 3.0), ("a", 4.0), ("a", 8.0), ("b", 6.0), ("b", 8.0), ("b", 16.0)]
