import json

import pytest
from pyspark.sql import functions as F

from telemill.functions import times
from telemill.operators import filters
from telemill.plans import query as Q
from telemill.sources import stores
from telemill.sources.stores import Level
from tests.helpers import DAY, message, messages


def whole_plan(spark, frame):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        return frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_device_value(spark):
    rows = messages(spark, message([{"value": 4, "valid": True}, {"value": 7}, {"valid": True}]))

    def port(p):
        row = Q.device_value(rows, p).first()
        return row.value, row.valid

    assert [port(p) for p in (0, 1, 2, 3, -1)] == [
        (4.0, True), (7.0, False), (0.0, True), (0.0, False), (0.0, False)]
    bare = spark.createDataFrame([(None,)], "id string").select(
        "id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("dtimestamp", "bigint"), ("ptimestamp", "bigint"), ("desc", "string"),
            ("values", rows.schema["values"].dataType.simpleString()))])
    assert tuple(Q.device_value(bare, 0).first()) == (None, 0, 0, 0, None, 0.0, False)


def test_sampling_and_range(spark):
    pts = spark.createDataFrame([(t,) for t in (120000, 121000, 121001, 119999)] + [(None,), (-1,)], "p bigint")

    def passing(**bounds):
        kept = pts.filter(filters.time_filter(F.col("p"), **bounds)).collect()
        return sorted(r.p if r.p is not None else -2 for r in kept)

    assert passing(interval=60000) == [120000, 121000]
    assert passing(btime=120000, etime=121000) == [120000, 121000]
    assert passing() == [-2, -1, 119999, 120000, 121000, 121001]
    assert passing(etime=121000) == [119999, 120000, 121000]


def test_properties_are_typed(spark):
    rows = messages(
        spark, *[message([], id=f"m{i}", **more) for i, more in enumerate([
            {"site": 7}, {"site": "7"}, {"site": 7.5}, {"site": True}, {"site": None}, {}, {"a.b": "q"}])])

    def ids(key, value):
        return sorted(r.id for r in rows.filter(filters.property_equals(key, value)).collect())

    assert ids("site", 7) == ["m0"]
    assert ids("site", "7") == ["m1"]
    assert ids("site", 7.5) == ["m2"]
    assert ids("site", True) == ["m3"]
    assert ids("a.b", "q") == ["m6"]
    assert ids("id", "m4") == ["m4"] and ids("id", 4) == []
    assert len(ids("portnum", 0)) == 7 and ids("portnum", "0") == []


def test_column_filters_reach_the_scan(spark, tmp_path):
    rows = messages(spark, message([{"value": 1}]))
    path = str(tmp_path / "t")
    rows.write.parquet(path)
    table = spark.read.parquet(path)
    found = Q.sample_messages(table, btime=5, etime=9, properties={"dtype": "x"}).select("id")
    plan = whole_plan(spark, found)
    assert "GreaterThanOrEqual(ptimestamp,5)" in plan and "EqualTo(dtype,x)" in plan
    assert "values" not in plan.split("ReadSchema")[1]


DAYS = [
    (10 * DAY, 10 * DAY + 5, (10, 10), (10, 10)),
    (10 * DAY, 12 * DAY, (20, 20), (10, 12)),
    (10 * DAY, -1, (10, 10), (10, 20)),
    (-1, 12 * DAY, (12, 12), (None, 12)),
    (-1, -1, (20, 20), (20, 20)),
]


@pytest.mark.parametrize("btime,etime,exact,whole", DAYS)
def test_day_selection(btime, etime, exact, whole):
    now = 20 * DAY + 3
    assert Q.days_to_read(btime, etime, now, "exact") == exact
    assert Q.days_to_read(btime, etime, now) == whole


LEVELS = [
    (Level.NONE, [], []), (Level.MAIN_ONLY, ["main"], None), (Level.BACK_ONLY, ["backup"], ["backup"]),
    (Level.BOTH, ["main"], ["backup"]), (Level.BOTH_FORCE, ["main", "backup"], ["backup"]),
]


@pytest.mark.parametrize("level,if_ok,if_failed", LEVELS)
def test_levels(spark, level, if_ok, if_failed):
    batch = spark.range(1)
    done = []

    def writer(name, fails=False):
        def write(_, batch_id):
            if fails:
                raise OSError("down")
            done.append((name, batch_id))
        return write

    assert stores.store_batch(batch, "b", writer("main"), writer("backup"), level) == if_ok
    assert done == [(name, "b") for name in if_ok]
    if if_failed is None:
        with pytest.raises(OSError):
            stores.store_batch(batch, "b", writer("main", True), writer("backup"), level)
    else:
        assert stores.store_batch(batch, "b", writer("main", True), writer("backup"), level) == if_failed


def test_no_main_store_counts_as_failed(spark):
    done = []
    written = stores.store_batch(spark.range(1), "b", None, lambda *_: done.append(1), Level.BOTH)
    assert written == ["backup"] and done == [1]


def store(spark, tmp_path):
    main, backup = str(tmp_path / "main"), str(tmp_path / "backup")
    sent = [message([{"value": i, "valid": True}], app=f"app{i % 2}", id=f"d{i}", pts=i * DAY + 5, site=i,
                    dtype="t") for i in range(4)]
    rows = messages(spark, *sent).withColumn("stored_at", F.col("ptimestamp"))
    stores.write_main(rows.filter("app = 'app0'"), main, "1")
    stores.write_backup(rows.filter("app = 'app1'"), backup, "1")
    return main, backup, rows, sent


def test_stores_round_trip_and_replay(spark, tmp_path):
    main, backup, rows, sent = store(spark, tmp_path)
    for _ in range(2):
        both = stores.union_stores(
            stores.scan_main(spark, main, narrow=False), stores.scan_backup(spark, backup))
        assert sorted(r.id for r in both.collect()) == ["d0", "d1", "d2", "d3"]
        assert sorted(r.extra for r in both.collect()) == [f'{{"site":{i}}}' for i in range(4)]
        # The same batch once more replaces its folders.
        stores.write_main(rows.filter("app = 'app0'"), main, "1")
        stores.write_backup(rows.filter("app = 'app1'"), backup, "1")
    assert stores.scan_main(spark, main, ["19700103"]).first().id == "d2"
    assert stores.scan_main(spark, main, apps=["app1"]).isEmpty()
    assert "app" not in stores.scan_main(spark, main).columns
    lines = spark.read.text(f"{backup}/day=1970-01-02/hour=1970-01-02_00/batch=1").collect()
    assert [json.loads(r.value) for r in lines] == [sent[1]]


def test_replayed_batch_stays_in_the_backup(spark, tmp_path):
    main, backup = stores.MainStore(str(tmp_path / "main")), stores.BackupStore(str(tmp_path / "backup"))
    batch = messages(spark, message([{"value": 1}])).withColumn("stored_at", F.col("ptimestamp"))

    def broken(_, batch_id):
        raise OSError("down")

    assert stores.store_batch(batch, "7", broken, backup, replayed=True) == ["backup"]
    assert stores.store_batch(batch, "7", main, backup, replayed=True) == ["backup"]
    assert stores.store_batch(batch, "8", main, backup, replayed=True) == ["main"]
    assert stores.scan_backup(spark, backup.path).count() == 1
    assert stores.scan_main(spark, main.path).count() == 1


def test_only_the_wanted_days_are_opened(spark, tmp_path):
    main, backup, rows, _ = store(spark, tmp_path)
    for frame, day in ((stores.scan_main(spark, main, ["19700103", "19990101"]), "19700103"),
                       (stores.scan_main(spark, main, first="19700103", last="19700104"), "19700103"),
                       (stores.scan_main(spark, main, first="19700102"), "19700103"),
                       (stores.scan_main(spark, main, last="19700102"), "19700101"),
                       (stores.scan_backup(spark, backup, ["1970-01-02"]), "1970-01-02")):
        files = frame.inputFiles()
        assert files and all(f"/day={day}/" in file for file in files)
    assert stores.scan_main(spark, main, ["19990101"]).count() == 0
    assert stores.scan_main(spark, main, []).count() == 0


def test_keys_and_scans_in_another_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        main, _, _, _ = store(spark, tmp_path)
        late = 23 * 3600 * 1000
        keys = spark.range(1).select(times.day_key(F.lit(late)), times.hour_key(F.lit(late)))
        assert tuple(keys.first()) == ("1970-01-01", "1970-01-01_23")
        request = {"btime": 1, "etime": DAY - 1}
        assert [r.id for r in Q.run_job(spark, request, main).collect()] == ["d0"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_messages_written_after_midnight_are_found(spark, tmp_path):
    main = str(tmp_path / "main")
    rows = messages(spark, message([{"value": 1}], pts=DAY - 1)).withColumn("stored_at", F.lit(DAY + 3000))
    stores.write_main(rows, main, "1")
    request = {"btime": 1, "etime": DAY - 1}
    assert Q.run_job(spark, request, main).count() == 1
    assert Q.run_job(spark, request, main, late_days=0).count() == 0


def test_plain_day_folders(spark, tmp_path):
    folder = tmp_path / "1970-01-02"
    folder.mkdir()
    for hour in ("00", "01"):
        (folder / f"1970-01-02_{hour}").write_text(json.dumps(message([], id=hour)) + "\n")
    found = stores.scan_backup_folders(spark, str(tmp_path), ["1970-01-02"], min_partitions=3)
    assert sorted(r.id for r in found.collect()) == ["00", "01"]
    assert found.rdd.getNumPartitions() == 3


def test_jobs(spark, tmp_path):
    main, backup, _, _ = store(spark, tmp_path)
    request = {"type": "sql", "query": "SELECT did, value, 'deviceValue' AS t FROM devicevalue", "port": 0,
               "dtime": DAY + 9}
    assert [tuple(r) for r in Q.run_job(spark, request, main, backup).collect()] == [("d1", 1.0, "deviceValue")]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("device_value_")]
    sample = {"type": "rdd", "btime": DAY, "etime": 3 * DAY, "dtype": "t"}
    assert [r.id for r in Q.run_job(spark, sample, main, backup).collect()] == ["d1", "d2"]
    assert Q.run_job(spark, sample, main, backup, now=3 * DAY, days="exact").isEmpty()
    with_site = Q.run_job(spark, {**sample, "site": 2}, main, backup)
    assert [r.id for r in with_site.collect()] == ["d2"]
    assert json.loads(Q.as_json(with_site).first().value)["site"] == 2
    # Without `type` a request is a sample request; the narrow main scan has no app to compare.
    assert Q.run_job(spark, {**sample, "app": "app0"}, main, backup).count() == 1
    with pytest.raises(Exception):
        Q.run_job(spark, {"type": "sql", "query": "SELECT nothing FROM deviceValue", "dtime": DAY}, main)


def test_rendered_rows(spark):
    frame = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert Q.render_rows(frame).first()[0] == "[1,null,x]"


def test_missing_times_sort_first(spark):
    rows = messages(spark, message([], id="b", pts=5), message([], id="a", pts=3))
    gap = rows.limit(1).withColumn("ptimestamp", F.lit(None).cast("bigint"))
    found = Q.sample_messages(rows.unionByName(gap)).collect()
    assert [r.ptimestamp for r in found] == [None, 3, 5]
