"""The main store and the backup store: layout, writing, failover and day scans.

Main store: Parquet below `day=<yyyyMMdd>/app=<app>/batch=<id>`. Backup store: JSON lines below
`day=<yyyy-MM-dd>/hour=<yyyy-MM-dd_HH>/batch=<id>`, all by UTC. A scan opens only the folders of the
days it wants. A batch replaces its own folders when it is
written again, so a replayed batch leaves no second copy.
"""

from __future__ import annotations

import enum
import logging
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkTypeError, PySparkValueError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.functions import times
from telemill.operators.joins import lookup_join
from telemill.schemas import MAIN_STORE_FIELDS, MESSAGE
from telemill.sources.folders import Folders, partition_name
from telemill.sources.ledger import Ledger, described
from telemill.sources.messages import decode, to_wire

log = logging.getLogger(__name__)

# Apps with a store of their own up to which the table of them is broadcast.
BROADCAST_APPS = 100_000


class Level(enum.Enum):
    """Which stores a batch goes to: (main, backup if main failed or is off, backup always)."""

    NONE = (False, False, False)
    MAIN_ONLY = (True, False, False)
    BACK_ONLY = (False, True, False)
    BOTH = (True, True, False)
    BOTH_FORCE = (True, True, True)

    @property
    def main(self) -> bool:
        return self.value[0]

    @property
    def backup(self) -> bool:
        return self.value[1]

    @property
    def always_backup(self) -> bool:
        return self.value[2]


def route(messages: DataFrame, stores: DataFrame, default: str) -> DataFrame:
    """Adds `store`: that of the app in `stores` (columns `app, store`), else the default.

    A job counts the apps: up to `BROADCAST_APPS` they are broadcast, more are joined by app.
    """
    known = stores.withColumnRenamed("store", "_store")
    few = known.limit(BROADCAST_APPS + 1).count() <= BROADCAST_APPS
    return lookup_join(messages, known, ["app"], few).withColumn(
        "store", F.coalesce("_store", F.lit(default))
    ).drop("_store")


def stamp(messages: DataFrame) -> DataFrame:
    """Adds `stored_at`, the write time in epoch ms.

    In a stream it is the time of the micro-batch, which a replay of that batch repeats.
    """
    return messages.withColumn("stored_at", F.unix_millis(F.current_timestamp()))


def _balanced(df: DataFrame, *folder: str) -> DataFrame:
    # Few files per folder; a folder that holds much of the batch is split over several tasks.
    return df.hint("rebalance", *[F.col(c) for c in folder])


def write_main(batch: DataFrame, path: str, batch_id: str, at: str = "stored_at") -> None:
    """Files a batch by day of writing and app."""
    filed = batch.withColumn("day", times.day_key(F.col(at), "yyyyMMdd")).withColumn(
        "batch", F.lit(batch_id)
    )
    (
        _balanced(filed, "day", "app")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "app", "batch")
        .parquet(path)
    )


def write_backup(
    batch: DataFrame,
    path: str | None,
    batch_id: str,
    at: str = "stored_at",
    day_pattern: str = "yyyy-MM-dd",
) -> None:
    """Appends a batch as JSON lines by day and hour of writing; without a path nothing happens.

    A batch of messages is written in wire format; average records without the app that files them.
    """
    if path is None:
        return
    day, hour = times.day_key(F.col(at)), times.hour_key(F.col(at), day_pattern)
    filed = batch.withColumns({"day": day, "hour": hour, "batch": F.lit(batch_id)})
    folder = ["day", "hour", "batch"]
    if "values" in batch.columns:
        lines = to_wire(filed)
    else:
        lines = filed.withColumn("value", F.to_json(F.struct(*batch.drop(at, "app").columns)))
    lines = lines.filter(F.col("value").isNotNull()).select("value", *folder)
    (
        _balanced(lines, "day", "hour")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folder)
        .text(path)
    )


@dataclass(frozen=True)
class MainStore:
    """Writes batches to the main store at `path`."""

    path: str

    def __call__(self, batch: DataFrame, batch_id: str) -> None:
        write_main(batch, self.path, batch_id)

    def files(self, spark: SparkSession, batch_id: str) -> DataFrame | None:
        """What the ledger notes of the files of a batch."""
        pattern = f"{self.path}/day=*/app=*/batch={partition_name(spark, batch_id)}"
        if not Folders(spark, self.path).matches(pattern):
            return None
        reader = spark.read.schema(MAIN_KEYS).option("basePath", self.path)
        return described(reader.parquet(pattern))


@dataclass(frozen=True)
class BackupStore:
    """Writes batches to the backup store at `path`."""

    path: str

    def __call__(self, batch: DataFrame, batch_id: str) -> None:
        write_backup(batch, self.path, batch_id)

    def files(self, spark: SparkSession, batch_id: str) -> DataFrame | None:
        """What the ledger notes of the files of a batch; days are written as in the main store."""
        pattern = f"{self.path}/day=*/hour=*/batch={partition_name(spark, batch_id)}"
        if not Folders(spark, self.path).matches(pattern):
            return None
        reader = spark.read.schema(BACKUP_LINES).option("basePath", self.path)
        return described(_keys_of_lines(reader.text(pattern)))

    def holds(self, spark: SparkSession, batch_id: str) -> bool:
        """Some rows of the batch are in the store."""
        pattern = f"{self.path}/day=*/hour=*/batch={partition_name(spark, batch_id)}"
        return Folders(spark, self.path).matches(pattern) and not spark.read.text(pattern).isEmpty()


@dataclass(frozen=True)
class RoutedStore:
    """A main store for each of some apps, and a default one for all others.

    `apps` reads the table of apps (`app, store`), `stores` has the writer of each store, `default`
    among them; an app whose store has no writer goes to the default, too.
    """

    apps: Callable[[], DataFrame]
    stores: Mapping[str, MainStore]
    default: str

    def __call__(self, batch: DataFrame, batch_id: str) -> None:
        known = self.apps().filter(F.col("store").isin(*self.stores))
        routed = route(batch, known, self.default)
        for name, write in self.stores.items():
            write(routed.filter(F.col("store") == name).drop("store"), batch_id)

    def files(self, spark: SparkSession, batch_id: str) -> DataFrame | None:
        found = [store.files(spark, batch_id) for store in self.stores.values()]
        found = [files for files in found if files is not None]
        whole = found[0] if found else None
        for files in found[1:]:
            whole = whole.unionByName(files)
        return whole


#: Errors of the program itself, which another store would not cure.
MISTAKES = (
    AnalysisException, PySparkTypeError, PySparkValueError, TypeError, NameError, AttributeError
)


def store_batch(
    batch: DataFrame,
    batch_id: str,
    main: Callable[[DataFrame, str], None] | None,
    backup: Callable[[DataFrame, str], None] | None,
    level: Level = Level.BOTH,
    replayed: bool = False,
    ledger: Ledger | None = None,
    on_failure: Callable[[str, Exception], None] | None = None,
) -> list[str]:
    """Writes a batch by its level and says where it went.

    The backup is written if main is off or failed, or always with BOTH_FORCE. A failure of main is
    logged and given to `on_failure`; a mistake of the program is no failure of the store. A failure
    nobody catches ends the micro-batch, which is then replayed. No main store at all counts as failed.

    With a ledger, the batch counts once it is committed there, whatever a failed store holds of it,
    and a batch that is committed is left as it is, whatever kind of writers there are. Without one,
    and with `replayed`, a batch that an earlier run left in the backup goes there again.
    """
    if ledger is not None and (held := ledger.stores_of(batch_id)):
        return held
    written = []
    to_main = level.main and main is not None
    if ledger is None and replayed and level is Level.BOTH and isinstance(backup, BackupStore):
        to_main = to_main and not backup.holds(batch.sparkSession, batch_id)
    if to_main:
        try:
            main(batch, batch_id)
            written.append("main")
        except MISTAKES:
            raise
        except Exception as failure:
            if not level.backup or backup is None:
                raise
            log.warning("batch %s goes to the backup, main failed: %r", batch_id, failure)
            if on_failure is not None:
                on_failure(batch_id, failure)
    if level.always_backup or (level.backup and not written):
        if backup is not None:
            backup(batch, batch_id)
            written.append("backup")
    if ledger is not None and written:
        writers = {"main": main, "backup": backup}
        noted = {
            name: writers[name].files(batch.sparkSession, batch_id)
            if hasattr(writers[name], "files") else None
            for name in written
        }
        ledger.commit(batch_id, noted)
    return written


# What is read of stored files for the ledger.
MAIN_KEYS = "id string, ptimestamp bigint, day string, app string, batch string"
BACKUP_LINES = "value string, day string, hour string, batch string"


def _keys_of_lines(lines: DataFrame) -> DataFrame:
    # By a generator: fields taken from the struct would each parse the line again.
    keys = F.from_json("value", "id string, ptimestamp bigint")
    day = F.regexp_replace("day", "-", "").alias("day")
    return lines.select(day, F.inline_outer(F.array(keys)), "_metadata")


def _open_days(
    spark: SparkSession,
    layout: str,
    kind: str,
    path: str,
    days: Sequence[str] | None,
    first: str | None,
    last: str | None,
) -> DataFrame:
    """The store with only the folders of the wanted days listed; none of them is an empty table, and
    so is a store that was never written."""
    path = path.rstrip("/")
    names = [name[4:] for name in Folders(spark, path).names(path) if name.startswith("day=")]
    wanted = [
        day
        for day in names
        if (days is None or day in days)
        and (first is None or day >= first)
        and (last is None or day <= last)
    ]
    return _open(spark, layout, kind, path, [f"{path}/day={day}" for day in wanted])


def _open(spark: SparkSession, layout: str, kind: str, path: str, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).option("basePath", path).format(kind).load(list(paths))


MAIN_LAYOUT = MESSAGE + ", day string, batch string"


def scan_main(
    spark: SparkSession,
    path: str,
    days: Sequence[str] | None = None,
    first: str | None = None,
    last: str | None = None,
    apps: Sequence[str] | None = None,
    narrow: bool = True,
    ledger: Ledger | None = None,
    device: str | None = None,
    first_ms: int | None = None,
    last_ms: int | None = None,
) -> DataFrame:
    """Messages of the given days (`yyyyMMdd`), or from `first` to `last`; other folders are not
    opened. `narrow` gives the eight fields of the query side, else the whole row.

    With a ledger, committed files alone are read, and of these only such as may have messages of the
    `device` and of the time from `first_ms` to `last_ms`; the messages themselves are not filtered.
    """
    if ledger is None:
        table = _open_days(spark, MAIN_LAYOUT, "parquet", path, days, first, last)
    else:
        files = ledger.choose("main", days, first, last, device, first_ms, last_ms)
        table = _open(spark, MAIN_LAYOUT, "parquet", path, files)
    if apps is not None:
        table = table.filter(F.col("app").isin(*apps))
    return table.select(*MAIN_STORE_FIELDS) if narrow else table.drop("day", "batch")


def scan_backup(
    spark: SparkSession,
    path: str,
    days: Sequence[str] | None = None,
    first: str | None = None,
    last: str | None = None,
    min_partitions: int | None = None,
    ledger: Ledger | None = None,
    device: str | None = None,
    first_ms: int | None = None,
    last_ms: int | None = None,
) -> DataFrame:
    """Messages of the given days (`yyyy-MM-dd`), or from `first` to `last`, of the backup store.

    With a ledger as in `scan_main`, and without the batches that are in the main store as well.
    """
    if ledger is None:
        lines = _open_days(spark, BACKUP_LINES, "text", path, days, first, last)
    else:
        plain = [day.replace("-", "") for day in days] if days is not None else None
        first, last = [day.replace("-", "") if day is not None else None for day in (first, last)]
        files = ledger.choose("backup", plain, first, last, device, first_ms, last_ms, once=True)
        lines = _open(spark, BACKUP_LINES, "text", path, files)
    return _read_lines(lines, min_partitions)


def scan_backup_folders(
    spark: SparkSession, path: str, days: Sequence[str], min_partitions: int | None = None
) -> DataFrame:
    """Messages from plain day folders `<path>/<yyyy-MM-dd>/*` with one JSON message per line."""
    lines = spark.read.text([f"{path.rstrip('/')}/{day}/*" for day in days])
    return _read_lines(lines.select("value"), min_partitions)


def _read_lines(lines: DataFrame, min_partitions: int | None) -> DataFrame:
    lines = lines.select("value")
    if min_partitions:
        lines = lines.repartition(min_partitions)
    return decode(lines).drop("reject", "raw")


def union_stores(main: DataFrame, backup: DataFrame) -> DataFrame:
    """All messages of both stores. The backup holds what main refused, so none counts twice; where
    a failed main may hold a part, read both by the ledger."""
    return main.unionByName(backup, allowMissingColumns=True)


#: Messages in a file of a compacted day, about.
FILE_ROWS = 1_000_000


def compact(
    spark: SparkSession,
    ledger: Ledger,
    store: MainStore | BackupStore,
    day: str,
    file_rows: int = FILE_ROWS,
) -> int:
    """Merges the committed files of a closed day (`yyyyMMdd`) into some with `file_rows` messages
    each, and says how many they were.

    Messages are sorted by device and time (in the backup by hour first, as it has a folder for each),
    so that each file has a range of devices. The new files replace the old ones by one ledger
    entry: readers see the day before or after it, and a replayed batch stays committed. Only one
    compaction of a day may run at a time. Files that a compaction left without an entry are never
    read. Readers of folders without the ledger see both, so use it for all reads of such a store.
    """
    is_main = isinstance(store, MainStore)
    name = "main" if is_main else "backup"
    # Backup copies of what is in the main store too keep their batch, by which scans leave them out.
    old = ledger.in_store(name, once=True).filter(F.col("day") == day)
    noted = old.select("file", "day", "rows").collect()  # one day's files
    if len(noted) <= 1:
        return 0
    paths = sorted(unquote(row.file) for row in noted)
    files = max(1, math.ceil(sum(row.rows for row in noted) / file_rows))
    batch_id = f"compact-{uuid.uuid4().hex}"
    if is_main:
        rows = _open(spark, MAIN_LAYOUT, "parquet", store.path, paths)
        order, folder = ["app", "id", "ptimestamp"], ["day", "app", "batch"]
    else:
        lines = _open(spark, BACKUP_LINES, "text", store.path, paths)
        rows = lines.withColumn("_id", F.get_json_object("value", "$.id"))
        order, folder = ["hour", "_id"], ["day", "hour", "batch"]
    sorted_rows = (
        rows.withColumn("batch", F.lit(batch_id))
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
    )
    writer = (
        (sorted_rows if is_main else sorted_rows.drop("_id"))
        .write.mode("append")
        .option("maxRecordsPerFile", 2 * file_rows)
        .partitionBy(*folder)
    )
    (writer.parquet if is_main else writer.text)(store.path)
    replaced = spark.createDataFrame([(row.file, row.day) for row in noted], "file string, day string")
    ledger.replace(batch_id, name, batch_id, replaced, store.files(spark, batch_id))
    return len(noted)
