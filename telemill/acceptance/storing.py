"""Stores: layout, failover, routing, day scans and job requests over stored messages."""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from telemill.acceptance.inputs import M2_SQL, m2
from telemill.acceptance.querying import BEGIN, DAY, END, SAMPLE, SECOND
from telemill.acceptance.registry import query
from telemill.functions import values as V
from telemill.plans import query as Q
from telemill.session import shared_folder
from telemill.sources import stores
from telemill.sources.ledger import Ledger

STORED_DAY = "strftime(make_timestamp(ptimestamp * 1000), '%Y%m%d')"

# Apps whose main store is down, so that their messages are in the backup store.
FAILING = ("error", "signup")


def stored2(spark, sf_dir) -> tuple[str, str]:
    """M2 written to a main and a backup store, by the time of the message."""
    main, backup = shared_folder(spark, "main"), shared_folder(spark, "backup")
    messages = m2(spark, sf_dir).withColumn("stored_at", F.col("ptimestamp"))
    fails = F.col("app").isin(*FAILING)
    to_backup = stores.BackupStore(backup)

    def broken(batch, number):
        raise OSError("main store is down")

    stores.store_batch(messages.filter(~fails), "good", stores.MainStore(main), to_backup)
    stores.store_batch(messages.filter(fails), "failed", broken, to_backup)
    return main, backup


@query(
    "store_by_app_day",
    f"""WITH {M2_SQL}
    SELECT app, {STORED_DAY} AS day, count(*) AS n FROM m2
    WHERE app NOT IN {FAILING} GROUP BY ALL""",
)
def store_by_app_day(spark, sf_dir):
    main, _ = stored2(spark, sf_dir)
    table = spark.read.schema("id string, app string, day string, batch string").parquet(main)
    return table.groupBy("app", "day").agg(F.count("id").alias("n"))


@query(
    "backup_by_hour",
    f"""WITH {M2_SQL}
    SELECT strftime(make_timestamp(ptimestamp * 1000), '%Y-%m-%d') AS day,
           strftime(make_timestamp(ptimestamp * 1000), '%Y-%m-%d_%H') AS hour, count(*) AS n
    FROM m2 WHERE app IN {FAILING} GROUP BY ALL""",
)
def backup_by_hour(spark, sf_dir):
    _, backup = stored2(spark, sf_dir)
    lines = spark.read.schema("value string, day string, hour string, batch string").text(backup)
    return lines.groupBy("day", "hour").agg(F.count("value").alias("n"))


@query(
    "persist_levels",
    """WITH levels(level) AS (
      VALUES ('NONE'), ('MAIN_ONLY'), ('BACK_ONLY'), ('BOTH'), ('BOTH_FORCE')),
    batches AS (SELECT event_type AS app, event_type <> 'error' AS main_ok, count(*) AS n
                FROM events GROUP BY ALL)
    SELECT level, app, n,
           level IN ('MAIN_ONLY', 'BOTH', 'BOTH_FORCE') AND main_ok AS in_main,
           level IN ('BACK_ONLY', 'BOTH_FORCE') OR (level = 'BOTH' AND NOT main_ok) AS in_backup
    FROM batches, levels""",
)
def persist_levels(spark, sf_dir):
    """Each level writes two batches, one while the main store is down; what the stores then hold."""
    messages = m2(spark, sf_dir).withColumn("stored_at", F.col("ptimestamp"))
    down = F.col("app") == "error"

    def broken(batch, number):
        raise OSError("main store is down")

    rows = None
    for level in stores.Level:
        main, backup = shared_folder(spark, "level-main"), shared_folder(spark, "level-backup")
        to_main, to_backup = stores.MainStore(main), stores.BackupStore(backup)
        for batch_id, wanted, writer in (("up", ~down, to_main), ("down", down, broken)):
            try:
                stores.store_batch(messages.filter(wanted), batch_id, writer, to_backup, level)
            except OSError:
                assert not level.backup
        held = messages.select("app", F.lit(False).alias("in_main"), F.lit(False).alias("in_backup"))
        held = held.distinct()
        if _is_there(spark, main):
            apps = stores.scan_main(spark, main, narrow=False).select("app")
            held = held.unionByName(_held(apps.distinct(), True, False))
        if _is_there(spark, backup):
            apps = stores.scan_backup(spark, backup).select("app")
            held = held.unionByName(_held(apps.distinct(), False, True))
        found = held.groupBy("app").agg(
            F.bool_or("in_main").alias("in_main"), F.bool_or("in_backup").alias("in_backup")
        ).withColumn("level", F.lit(level.name))
        rows = found if rows is None else rows.unionByName(found)
    counts = messages.groupBy("app").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(rows, "app").select("level", "app", "n", "in_main", "in_backup")


def _is_there(spark, path):
    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
            path
        ).isEmpty()
    except AnalysisException:
        return False


def _held(apps, in_main, in_backup):
    return apps.withColumns({"in_main": F.lit(in_main), "in_backup": F.lit(in_backup)})


@query(
    "route_store",
    f"""WITH {M2_SQL}
    SELECT seq, app, CASE app WHEN 'click' THEN 'fast' WHEN 'view' THEN 'slow' ELSE 'device' END
           AS store
    FROM m2""",
)
def route_store(spark, sf_dir):
    known = spark.createDataFrame([("click", "fast"), ("view", "slow")], "app string, store string")
    return stores.route(m2(spark, sf_dir), known, "device").select("seq", "app", "store")


def _port_zero(messages):
    port = F.get("values", F.lit(0))
    return messages.select(
        "id", "ptimestamp", "dtype", "desc",
        V.to_double(port["value"]).alias("value"), port["valid"].alias("valid"),
    )


@query(
    "scan_main_day",
    f"""WITH {M2_SQL}
    SELECT id, ptimestamp, dtype, "desc", value, valid FROM m2
    WHERE app NOT IN {FAILING} AND {STORED_DAY} = '20240110'""",
)
def scan_main_day(spark, sf_dir):
    main, _ = stored2(spark, sf_dir)
    return _port_zero(stores.scan_main(spark, main, ["20240110"]))


@query(
    "scan_backup_day",
    f"""WITH {M2_SQL}
    SELECT id, ptimestamp, dtype, "desc", value, valid FROM m2
    WHERE app IN {FAILING} AND {STORED_DAY} = '20240110'""",
)
def scan_backup_day(spark, sf_dir):
    _, backup = stored2(spark, sf_dir)
    return _port_zero(stores.scan_backup(spark, backup, ["2024-01-10"]))


@query(
    "union_stores",
    f"""WITH {M2_SQL} SELECT id, ptimestamp, dtype, "desc", value, valid FROM m2""",
)
def union_stores(spark, sf_dir):
    main, backup = stored2(spark, sf_dir)
    return _port_zero(
        stores.union_stores(
            stores.scan_main(spark, main, narrow=False), stores.scan_backup(spark, backup)
        )
    )


@query(
    "job_sql",
    f"""WITH {M2_SQL}
    SELECT id AS did, count(*) AS n, max(value) AS top FROM m2
    WHERE ptimestamp // {DAY} = {BEGIN} // {DAY} GROUP BY id""",
)
def job_sql(spark, sf_dir):
    main, backup = stored2(spark, sf_dir)
    request = {
        "type": "sql",
        "query": "SELECT did, count(*) AS n, max(value) AS top FROM deviceValue GROUP BY did",
        "port": 0,
        "dtime": BEGIN,
    }
    return Q.run_job(spark, request, main, backup)


@query(
    "job_rdd",
    f"""WITH {M2_SQL}
    SELECT id, ptimestamp, dtype, "desc", value, valid FROM m2
    WHERE ptimestamp BETWEEN {BEGIN} AND {END} AND ptimestamp % 3600000 <= 600000
      AND app = 'signup'""",
)
def job_rdd(spark, sf_dir):
    main, backup = stored2(spark, sf_dir)
    request = {"type": "rdd", **SAMPLE, "app": "signup"}
    return _port_zero(Q.run_job(spark, request, main, backup))


LATE = 7_200_000


@query(
    "job_late_messages",
    f"""WITH {M2_SQL}
    SELECT id, ptimestamp, dtype, "desc", value, valid FROM m2
    WHERE ptimestamp // {DAY} = {BEGIN} // {DAY}""",
)
def job_late_messages(spark, sf_dir):
    """A day's messages, all written two hours after they were sent."""
    main = shared_folder(spark, "late")
    messages = m2(spark, sf_dir).withColumn("stored_at", F.col("ptimestamp") + LATE)
    stores.write_main(messages, main, "late")
    begin = BEGIN // DAY * DAY
    request = {"type": "rdd", "btime": begin, "etime": begin + DAY - 1}
    return _port_zero(Q.run_job(spark, request, main))


HOUR = 3_600_000

# Requests with exact days; the moment they are made is SECOND.
REQUESTS = {
    "one_day": {"btime": BEGIN + HOUR, "etime": BEGIN + 5 * HOUR},
    "two_days": {"btime": BEGIN, "etime": END},
    "from": {"btime": BEGIN + 9 * HOUR},
    "to": {"etime": BEGIN + 9 * HOUR},
    "open": {},
}


@query(
    "select_day",
    f"""WITH {M2_SQL},
    chosen(request, day, first, last) AS (VALUES
      ('one_day', {BEGIN}, {BEGIN + HOUR}, {BEGIN + 5 * HOUR}),
      ('two_days', {SECOND}, {BEGIN}, {END}),
      ('from', {BEGIN}, {BEGIN + 9 * HOUR}, {END + 10 * DAY}),
      ('to', {BEGIN}, 0, {BEGIN + 9 * HOUR}),
      ('open', {SECOND}, 0, {END + 10 * DAY}))
    SELECT request, id, ptimestamp FROM m2, chosen
    WHERE ptimestamp // {DAY} = day // {DAY} AND ptimestamp BETWEEN first AND last""",
)
def select_day(spark, sf_dir):
    """The one day that each request reads: that of its bounds, or the present one."""
    main, backup = stored2(spark, sf_dir)
    rows = None
    for name, bounds in REQUESTS.items():
        request = {"type": "rdd", **bounds}
        found = Q.run_job(spark, request, main, backup, now=SECOND, days="exact")
        found = found.select(F.lit(name).alias("request"), "id", "ptimestamp")
        rows = found if rows is None else rows.unionByName(found)
    return rows


class HalfWritten(stores.MainStore):
    """A main store that breaks down after it has written a part of a batch."""

    def __call__(self, batch, batch_id):
        super().__call__(batch.filter(F.col("seq") % 2 == 0), batch_id)
        raise OSError("main store broke down")


def kept(spark, name):
    """A main store, a backup store and their ledger."""
    main, backup, ledger = (shared_folder(spark, f"{name}-{part}") for part in ("main", "backup", "ledger"))
    return stores.MainStore(main), stores.BackupStore(backup), Ledger(spark, ledger)


def _both(spark, main, backup, ledger):
    return _port_zero(
        stores.union_stores(
            stores.scan_main(spark, main.path, narrow=False, ledger=ledger),
            stores.scan_backup(spark, backup.path, ledger=ledger),
        )
    )


@query(
    "store_ledger",
    f"""WITH {M2_SQL} SELECT id, ptimestamp, dtype, "desc", value, valid FROM m2""",
)
def store_ledger(spark, sf_dir):
    """Four batches: one in main, one that main held half of when it failed, one that is replayed
    while main is down, and one in both stores. Every message counts once."""
    main, backup, ledger = kept(spark, "ledger")
    messages = m2(spark, sf_dir).withColumn("stored_at", F.lit(BEGIN) + F.col("seq") % 7_200_000)
    turns = [messages.filter(F.col("seq") % 4 == turn) for turn in range(4)]

    def down(batch, batch_id):
        raise OSError("main store is down")

    def store(turn, writer, level=stores.Level.BOTH):
        return stores.store_batch(turns[turn], f"b{turn}", writer, backup, level, ledger=ledger)

    store(0, main)
    assert store(1, HalfWritten(main.path)) == ["backup"]
    store(2, main)
    assert store(2, down) == ["main"]
    assert store(3, main, stores.Level.BOTH_FORCE) == ["main", "backup"]
    return _both(spark, main, backup, ledger)


def full_files(ledger: Ledger) -> int:
    """How many files the messages in force may fill once compacted: a large day has batches with
    full files, of which a compaction leaves about as many. A range of messages can end within a
    folder or be cut in two, so these add to the files."""
    folder = F.regexp_replace("file", "/[^/]*$", "")
    rows, folders = ledger.files().agg(F.sum("rows"), F.count_distinct(folder)).first()
    return 2 * math.ceil((rows or 0) / stores.FILE_ROWS) + folders


@query(
    "store_compacted",
    f"""WITH {M2_SQL}
    SELECT stage, id, ptimestamp, dtype, "desc", value, valid
    FROM m2, (VALUES ('before'), ('during'), ('after'), ('folded')) AS stages(stage)""",
)
def store_compacted(spark, sf_dir):
    """A day of many batches in both stores, read before it is compacted, by a reader that began
    before, after it, with a replay in between, and from a snapshot of the ledger."""
    main, backup, ledger = kept(spark, "compacted")
    messages = m2(spark, sf_dir).withColumn("stored_at", F.lit(BEGIN) + F.col("seq") % 7_200_000)

    def down(batch, batch_id):
        raise OSError("main store is down")

    def store(turn):
        batch = messages.filter(F.col("seq") % 8 == turn)
        writer = down if turn % 4 == 3 else main
        stores.store_batch(batch, f"b{turn}", writer, backup, ledger=ledger)

    for turn in range(8):
        store(turn)
    before = stored(spark, _both(spark, main, backup, ledger))
    during = _both(spark, main, backup, ledger)
    day = DAY_OF_BEGIN
    small = stores.compact(spark, ledger, main, day) + stores.compact(spark, ledger, backup, day)
    store(0)
    store(3)
    after = _both(spark, main, backup, ledger)
    left, most = ledger.files().count(), full_files(ledger)
    assert left < small / 2 or left <= most, f"{left} files of {small}, at most {most} if they are full"
    stages = [("before", before), ("during", stored(spark, during)), ("after", stored(spark, after))]
    ledger.fold()
    ledger.vacuum()
    store(1)
    stages.append(("folded", _both(spark, main, backup, ledger)))
    rows = None
    for name, found in stages:
        named = found.withColumn("stage", F.lit(name))
        rows = named if rows is None else rows.unionByName(named)
    return rows


def stored(spark, frame):
    """What a reader finds at this moment."""
    path = shared_folder(spark, "read")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# A device that all tables have; requests for it and an hour of each day's messages.
DEVICE = "dev5"
DAY_OF_BEGIN = datetime.fromtimestamp(BEGIN / 1000, tz=timezone.utc).strftime("%Y%m%d")


@query(
    "job_pruned",
    f"""WITH {M2_SQL}
    SELECT id, ptimestamp, dtype, "desc", value, valid, true AS few_files FROM m2
    WHERE id = '{DEVICE}' AND ptimestamp BETWEEN {BEGIN} AND {BEGIN + 10 * DAY}""",
)
def job_pruned(spark, sf_dir):
    """One device and a third of the time of a day's table, clustered into some twenty files."""
    main, backup, ledger = kept(spark, "pruned")
    messages = m2(spark, sf_dir).withColumn("stored_at", F.lit(BEGIN))
    for turn in range(2):
        batch = messages.filter(F.col("seq") % 2 == turn)
        stores.store_batch(batch, f"b{turn}", main, backup, ledger=ledger)
    stores.compact(spark, ledger, main, DAY_OF_BEGIN, max(1, messages.count() // 20))
    request = {"type": "rdd", "id": DEVICE, "btime": BEGIN, "etime": BEGIN + 10 * DAY}
    found = Q.run_job(spark, request, main.path, backup.path, now=BEGIN + DAY, ledger=ledger)
    opened = ledger.choose("main", None, None, None, DEVICE, BEGIN, BEGIN + 10 * DAY)
    few = 3 * len(opened) <= ledger.files().count()
    return _port_zero(found).withColumn("few_files", F.lit(few))
