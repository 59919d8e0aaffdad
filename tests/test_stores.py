"""Exactness over both stores: the ledger, compaction, pruned scans, absent stores, routing."""

import json
from functools import partial

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from telemill.acceptance import QUERIES, SQL
from telemill.plans import query as Q
from telemill.sources import stores
from telemill.sources.ledger import Ledger
from telemill.sources.stores import BackupStore, Level, MainStore
from tests.helpers import message, messages
from tests.oracle import DATA, compare

DAY = 86400000


def batch_of(spark, numbers, day=0, apps=2):
    sent = [message([{"value": i}], app=f"a{i % apps}", id=f"d{i:04}", pts=i * 1000) for i in numbers]
    return messages(spark, *sent).withColumn("stored_at", F.lit(day * DAY))


class Place:
    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.main, self.backup = MainStore(str(tmp_path / "main")), BackupStore(str(tmp_path / "backup"))
        self.ledger = Ledger(spark, str(tmp_path / "ledger"))

    def store(self, batch, batch_id, main=None, level=Level.BOTH, **more):
        return stores.store_batch(
            batch, batch_id, main or self.main, self.backup, level, ledger=self.ledger, **more)

    def read(self):
        return stores.union_stores(
            stores.scan_main(self.spark, self.main.path, narrow=False, ledger=self.ledger),
            stores.scan_backup(self.spark, self.backup.path, ledger=self.ledger))

    def ids(self):
        return sorted(row.id for row in self.read().collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def named(numbers):
    return [f"d{i:04}" for i in numbers]


def down(batch, batch_id):
    raise OSError("down")


def test_a_half_written_batch_counts_once(spark, place):
    def half(batch, batch_id):
        place.main(batch.filter(F.col("app") == "a0"), batch_id)
        raise OSError("broke down")

    failures = []
    assert place.store(batch_of(spark, range(6)), "1") == ["main"]
    written = place.store(batch_of(spark, range(6, 12)), "2", half, on_failure=lambda *x: failures.append(x))
    assert written == ["backup"] and failures[0][0] == "2"
    assert place.ids() == named(range(12))
    # The folders alone hold the half batch a second time.
    assert stores.scan_main(spark, place.main.path).count() == 9


def test_a_committed_batch_is_left_as_it_is(spark, place):
    assert place.store(batch_of(spark, range(4)), "x/1", down) == ["backup"]
    # Its replay finds main up again; a backup of another kind is asked by the ledger, too.
    assert place.store(batch_of(spark, range(4)), "x/1") == ["backup"]
    done = []
    again = stores.store_batch(batch_of(spark, range(4)), "x/1", place.main, lambda *x: done.append(x),
                               ledger=place.ledger)
    assert again == ["backup"] and not done
    assert place.ids() == named(range(4))
    # Written, but not committed: it is written again in place.
    place.main(batch_of(spark, range(4, 6)), "2")
    assert place.ids() == named(range(4))
    assert place.store(batch_of(spark, range(4, 6)), "2") == ["main"]
    assert place.ids() == named(range(6))


def test_a_writer_that_tells_no_files_can_be_committed(spark, place):
    done = []
    for _ in range(2):
        assert place.store(batch_of(spark, range(2)), "1", lambda *x: done.append(x)) == ["main"]
    assert len(done) == 1


def test_empty_batches(spark, place):
    assert place.ids() == []
    assert place.store(batch_of(spark, range(2)).limit(0), "1") == ["main"]
    assert place.ids() == [] and place.ledger.stores_of("1") == ["main"]


def test_mistakes_are_not_hidden(spark, place):
    with pytest.raises(AnalysisException):
        place.store(batch_of(spark, range(2)).drop("app"), "1")
    with pytest.raises(TypeError):
        place.store(batch_of(spark, range(2)), "1", lambda batch: None)
    assert place.ids() == []


def test_compaction_of_a_day(spark, place):
    for n in range(6):
        writer = down if n % 3 == 2 else None
        level = Level.BOTH_FORCE if n == 4 else Level.BOTH
        place.store(batch_of(spark, range(10 * n, 10 * n + 10), day=n // 5), str(n), writer, level)
    before = place.read()
    assert stores.compact(spark, place.ledger, place.main, "19700101") == 8
    assert stores.compact(spark, place.ledger, place.backup, "19700101") == 0  # one file to merge
    place.store(batch_of(spark, range(60, 70)), "6", down)
    assert stores.compact(spark, place.ledger, place.backup, "19700101") > 1
    assert stores.compact(spark, place.ledger, place.main, "19700103") == 0
    # A reader from before, one from after, and replays.
    assert sorted(row.id for row in before.collect()) == named(range(60))
    assert place.ids() == named(range(70))
    for n in range(7):
        place.store(batch_of(spark, range(10 * n, 10 * n + 10)), str(n))
    assert place.ids() == named(range(70))
    main = place.ledger.in_store("main").filter("day = '19700101'")
    assert main.count() == 2 and main.agg(F.sum("rows")).first()[0] == 40
    lines = [json.loads(row.value)["id"] for row in spark.read.text(
        place.ledger.choose("backup", ["19700101"], once=True)).collect()]
    assert len(lines) == 20
    for _ in range(2):  # a snapshot of entries, and one of a snapshot
        place.ledger.fold()
        assert place.ids() == named(range(70))
        assert place.store(batch_of(spark, range(3)), "0") == ["main"]
    assert place.ledger.vacuum() > 0
    assert place.ids() == named(range(70))
    assert stores.scan_main(spark, place.main.path).count() == 40


def test_a_compaction_that_was_not_committed_is_not_read(spark, place, monkeypatch):
    for n in range(3):
        place.store(batch_of(spark, range(5 * n, 5 * n + 5)), str(n))
    monkeypatch.setattr(Ledger, "replace", down)
    with pytest.raises(Exception):
        stores.compact(spark, place.ledger, place.main, "19700101")
    monkeypatch.undo()
    assert place.ids() == named(range(15))
    stores.compact(spark, place.ledger, place.main, "19700101")
    assert place.ids() == named(range(15))


def test_scans_open_files_of_the_device_and_time(spark, place):
    for n in range(4):
        place.store(batch_of(spark, range(n, 400, 4), apps=1), str(n))
    everything = place.ledger.files().count()
    # By the Bloom filter alone: each batch has devices from one end to the other.
    opened = place.ledger.choose("main", device="d0201")
    assert len(opened) < everything
    stores.compact(spark, place.ledger, place.main, "19700101", file_rows=40)
    files = place.ledger.files()
    assert files.count() >= 8
    request = {"id": "d0201", "btime": 200_000, "etime": 202_000}
    found = Q.run_job(spark, request, place.main.path, place.backup.path, now=0, ledger=place.ledger)
    assert [row.id for row in found.collect()] == ["d0201"]
    assert len(found.inputFiles()) == 1
    timed = place.ledger.choose("main", first_ms=200_000, last_ms=200_999)
    assert 1 <= len(timed) <= 2
    assert place.ledger.choose("main", days=["19990101"]) == place.ledger.choose("main", days=[]) == []
    assert len(place.ledger.choose("main", first="19700101", last="19700101")) == files.count()
    # Devices that are not there.
    assert sum(bool(place.ledger.choose("main", device=f"d{i:04}x")) for i in range(400)) < 400
    plain = Q.run_job(spark, request, place.main.path, place.backup.path, now=0)
    assert plain.count() == 2  # folders hold the small files too


def test_jobs_without_a_main_store(spark, tmp_path):
    main, backup = str(tmp_path / "main"), str(tmp_path / "backup")
    assert stores.scan_main(spark, main, ["19700101"]).count() == 0
    assert stores.scan_backup(spark, backup).count() == 0
    BackupStore(backup)(batch_of(spark, range(3)), "1")
    request = {"type": "sql", "query": "SELECT did FROM deviceValue", "dtime": 5}
    assert Q.run_job(spark, request, main, backup).count() == 3
    assert Q.run_job(spark, {"btime": 1, "etime": DAY - 1}, main, backup).count() == 2
    assert Q.run_job(spark, {"btime": 1, "etime": DAY - 1}, main, str(tmp_path / "none")).count() == 0


def test_a_store_that_cannot_be_read_is_no_empty_day(spark, tmp_path):
    (tmp_path / "main" / "day=19700101" / "app=a" / "batch=1").mkdir(parents=True)
    (tmp_path / "main" / "day=19700101" / "app=a" / "batch=1" / "x.parquet").write_text("broken")
    with pytest.raises(Exception):
        stores.scan_main(spark, str(tmp_path / "main"), ["19700101"]).collect()


def test_apps_with_stores_of_their_own(spark, tmp_path):
    table = spark.createDataFrame([("a0", "fast"), ("a1", "gone")], "app string, store string")
    own = {name: MainStore(str(tmp_path / name)) for name in ("fast", "device")}
    routed = stores.RoutedStore(lambda: table, own, "device")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert stores.store_batch(batch_of(spark, range(9), apps=3), "1", routed, None, ledger=ledger) == ["main"]
    assert stores.scan_main(spark, own["fast"].path).count() == 3
    assert stores.scan_main(spark, own["device"].path, apps=["a1", "a2"]).count() == 6
    assert ledger.files().agg(F.sum("rows")).first()[0] == 9


def test_odd_names_of_apps(spark, place):
    odd = batch_of(spark, range(2)).withColumn("app", F.lit("a b%2F:ü"))
    place.store(odd, "1")
    place.store(batch_of(spark, range(2, 4)).withColumn("app", F.lit("a+b")), "2")
    assert place.ids() == named(range(4))
    assert sorted({row.app for row in place.read().collect()}) == ["a b%2F:ü", "a+b"]


def _plan(frame, capsys):
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


def test_files_are_described_in_one_pass(spark, place, capsys):
    place.store(batch_of(spark, range(40)), "1")
    place.store(batch_of(spark, range(40, 60)), "2", down)
    for found in (place.main.files(spark, "1"), place.backup.files(spark, "2")):
        plan = _plan(found, capsys)
        assert plan.count("FileScan") == 1 and "Join" not in plan
        # Devices are summed before the shuffle, and not sent by it.
        before_shuffle = plan[plan.rindex("Exchange"):]
        assert "partial_bitmap_construct_agg" in before_shuffle and "keys=[file" not in before_shuffle
        assert plan.count("from_json") <= 1


def test_what_is_noted_of_files(spark, place):
    """Ranges and bits as counted in Python, for messages without device or time, too."""
    odd = [("a0", "d1", 5), ("a0", None, 7), ("a0", "d0", None), ("a0", "d1", 3), ("a1", None, None), ("a1", None, 9)]
    batch = spark.createDataFrame(odd, "app string, id string, ptimestamp bigint")
    place.main(batch.withColumn("stored_at", F.lit(0).cast("bigint")), "1")
    notes = {row.file.split("app=")[1][:2]: row for row in place.main.files(spark, "1").collect()}
    assert {app: tuple(row)[2:-1] for app, row in notes.items()} == {
        "a0": (4, "d0", "d1", 3, 7), "a1": (2, None, None, 9, 9)}
    assert notes["a1"].devices is None
    hashes = spark.range(1).select(
        *[F.pmod(F.xxhash64(F.lit(k), F.lit(d)), F.lit(32768)) for k in range(3) for d in ("d0", "d1")]).first()
    bits = {8 * place_ + bit for place_, byte in enumerate(notes["a0"].devices) for bit in range(8)
            if byte >> bit & 1}
    assert bits == set(hashes)


def test_lines_that_are_no_messages_are_noted(spark):
    lines = spark.createDataFrame(
        [('{"id":"d1","ptimestamp":4}', "2024-01-02"), ("broken", "2024-01-02"), ('{"id":7}', "2024-01-02")],
        "value string, day string").withColumn("_metadata", F.lit(0))
    assert sorted(map(tuple, stores._keys_of_lines(lines).collect()), key=str) == [
        ("20240102", "7", None, 0), ("20240102", "d1", 4, 0), ("20240102", None, None, 0)]


def test_a_large_day_may_stay_as_many_files(spark, monkeypatch):
    """As with 36 million messages, whose batches are written as full files."""
    events = spark.read.parquet(f"{DATA}/events.parquet").count()
    file_rows = events // 30
    monkeypatch.setattr(stores, "FILE_ROWS", file_rows)
    monkeypatch.setattr(stores, "compact", partial(stores.compact, file_rows=file_rows))
    assert compare(QUERIES["store_compacted"](spark, DATA), SQL["store_compacted"]) == 4 * events
