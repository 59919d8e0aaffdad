"""The commit ledger of the main and the backup store.

A store's folders may hold anything: batches half written when a store failed, copies of a replay,
small files that a compaction has replaced. What counts is the ledger. A batch is written first and
then committed by one entry, which names its files in either store and appears by a rename, as a
whole or not at all. A batch with an entry is never written again, whichever store it went to. A
compaction is an entry too: it adds the merged files and drops the small ones, so a reader sees a day
before or after it, and never both. Dropped files stay until `vacuum`, for readers that began before.

An entry has for each file its rows, the least and greatest device and process time, and a Bloom
filter of its devices, from which a scan takes the files it has to open. Entries are folded into
snapshots, so that reading the ledger does not grow with the number of micro-batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.sources.folders import Folders

# `what` is add or drop for a file, batch for the fact that a batch is in a store, entry for the name
# of an entry that a snapshot holds.
ENTRY = (
    "entry string, what string, batch string, store string, day string, file string, rows bigint, "
    "first_id string, last_id string, first_ms bigint, last_ms bigint, devices binary"
)
NAMES = [field.split()[0] for field in ENTRY.split(", ")]

#: Bits of a file's Bloom filter, a Spark bitmap, and hashes of a device.
BITS, HASHES = 32768, 3


def _positions(device: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), device), F.lit(BITS)) for k in range(HASHES)]


def _may_hold(bitmap: Column, device: str) -> Column:
    """The bitmap has all bits of the device; a file without one may hold any."""

    def is_set(position: Column) -> Column:
        byte = F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return (F.call_function("shiftright", value, (position % 8).cast("int")) % 2) == 1

    return bitmap.isNull() | F.forall(F.array(*_positions(F.lit(device))), is_set)


def described(rows: DataFrame) -> DataFrame:
    """One row per file of `rows` (day, id, ptimestamp, read from files): its row of an entry.

    Files are read once, and a task sums what it reads of a file before the shuffle, so that this
    has a few rows per file and task, however many devices there are.
    """
    known, bits = F.col("id").isNotNull(), [f"_bits{k}" for k in range(HASHES)]
    of_file = rows.select(
        "day", "id", "ptimestamp", F.col("_metadata.file_path").alias("file"),
        *[F.when(known, bit).alias(name) for bit, name in zip(_positions(F.col("id")), bits)],
    )
    ranges = {
        "rows": F.count(F.lit(1)),
        "first_id": F.min("id"),
        "last_id": F.max("id"),
        "first_ms": F.min("ptimestamp"),
        "last_ms": F.max("ptimestamp"),
    }
    files = of_file.groupBy("day", "file").agg(
        *[value.alias(name) for name, value in ranges.items()],
        *[F.bitmap_construct_agg(name).alias(name) for name in bits],
    )
    # One row per hash, whose bitmaps are laid over each other.
    hashes = files.select("day", "file", *ranges, F.explode(F.array(*bits)).alias("_bits"))
    whole = hashes.groupBy("day", "file", *ranges).agg(F.bitmap_or_agg("_bits").alias("devices"))
    return whole.withColumn("devices", F.when(F.col("first_id").isNotNull(), F.col("devices")))


@dataclass(frozen=True)
class Ledger:
    """The ledger in the folder `path`."""

    spark: SparkSession
    path: str

    def _folders(self) -> Folders:
        return Folders(self.spark, self.path)

    def _entry(self, name: str) -> str:
        return f"{self.path}/entries/{quote(name, safe='')}"

    def _read(self, *folders: str) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(*folders)

    def _snapshot(self) -> str | None:
        names = [n for n in self._folders().names(f"{self.path}/snapshots") if n.isdigit()]
        return f"{self.path}/snapshots/{max(names, key=int)}" if names else None

    def rows(self) -> DataFrame:
        """All rows of the ledger: the last snapshot, and the entries that are not in it."""
        snapshot = self._snapshot()
        found = self.spark.createDataFrame([], ENTRY) if snapshot is None else self._read(snapshot)
        names = set(self._folders().names(f"{self.path}/entries"))
        if names and snapshot is not None:
            held = found.filter((F.col("what") == "entry") & F.col("entry").isin(*names))
            names -= {row.entry for row in held.select("entry").collect()}
        if names:
            found = found.unionByName(self._read(*[f"{self.path}/entries/{n}" for n in sorted(names)]))
        return found

    def stores_of(self, batch_id: str) -> list[str]:
        """The stores a batch is committed to; none if it is not committed."""
        if self._folders().exists(self._entry(batch_id)):
            rows = self._read(self._entry(batch_id))
        else:
            snapshot = self._snapshot()
            if snapshot is None:
                return []
            rows = self._read(snapshot)
        of_batch = rows.filter((F.col("what") == "batch") & (F.col("batch") == batch_id))
        return sorted(row.store for row in of_batch.select("store").distinct().collect())

    def _commit(self, name: str, rows: DataFrame) -> bool:
        """Puts an entry in place; false if there is one of that name."""
        staged = f"{self.path}/staging/{uuid.uuid4().hex}"
        whole = rows.withColumn("entry", F.lit(quote(name, safe="")))
        for column in NAMES:
            if column not in whole.columns:
                whole = whole.withColumn(column, F.lit(None))
        kinds = dict(field.split() for field in ENTRY.split(", "))
        # An entry has a row per file of one batch.
        whole.select(*[F.col(c).cast(kinds[c]) for c in NAMES]).coalesce(1).write.parquet(staged)
        return self._folders().rename(staged, self._entry(name))

    def commit(self, batch_id: str, files: Mapping[str, DataFrame | None]) -> None:
        """Commits a batch: the stores it was written to, with their files as `described`, or none
        where a store does not tell them."""
        rows = self.spark.createDataFrame(
            [("batch", batch_id, store) for store in files], "what string, batch string, store string"
        )
        for store, found in files.items():
            if found is not None:
                rows = rows.unionByName(
                    found.withColumns(
                        {"what": F.lit("add"), "batch": F.lit(batch_id), "store": F.lit(store)}
                    ),
                    allowMissingColumns=True,
                )
        if not self._commit(batch_id, rows) and not self.stores_of(batch_id):
            raise OSError(f"the entry of batch {batch_id} could not be put in place")

    def files(self) -> DataFrame:
        """The files in force: batch, store, day, file, rows and their ranges."""
        rows = self.rows()
        dropped = rows.filter(F.col("what") == "drop").select("store", "file")
        return rows.filter(F.col("what") == "add").join(dropped, ["store", "file"], "left_anti").drop(
            "what", "entry"
        )

    def in_store(self, store: str, once: bool = False) -> DataFrame:
        """The files in force of a store; `once` leaves out the backup's copy of a batch that is in
        the main store too."""
        found = self.files().filter(F.col("store") == store)
        if once and store == "backup":
            in_main = self.rows().filter((F.col("what") == "batch") & (F.col("store") == "main"))
            found = found.join(in_main.select("batch"), "batch", "left_anti")
        return found

    def choose(
        self,
        store: str,
        days: Sequence[str] | None = None,
        first: str | None = None,
        last: str | None = None,
        device: str | None = None,
        first_ms: int | None = None,
        last_ms: int | None = None,
        once: bool = False,
    ) -> list[str]:
        """Paths of the files of a store that a scan has to open.

        A device and bounds of the process time leave out the files that have nothing of them; files
        without any time go, as messages without one pass open bounds only. `once` as in `in_store`.
        """
        found = self.in_store(store, once)
        if days is not None:
            found = found.filter(F.col("day").isin(*days)) if days else found.limit(0)
        if first is not None:
            found = found.filter(F.col("day") >= first)
        if last is not None:
            found = found.filter(F.col("day") <= last)
        if device is not None:
            inside = (F.col("first_id") <= device) & (F.col("last_id") >= device)
            found = found.filter(inside & _may_hold(F.col("devices"), device))
        if first_ms is not None:
            found = found.filter(F.col("last_ms") >= first_ms)
        if last_ms is not None:
            found = found.filter(F.col("first_ms") <= last_ms)
        # As many as a scan of these days would list.
        return sorted(unquote(row.file) for row in found.select("file").collect())

    def replace(self, name: str, store: str, batch: str, old: DataFrame, new: DataFrame) -> bool:
        """One entry that adds the `new` files (as `described`) and drops the `old` ones (`file`)."""
        same = {"batch": F.lit(batch), "store": F.lit(store)}
        added = new.withColumns({"what": F.lit("add"), **same})
        gone = old.select("file", "day").withColumns({"what": F.lit("drop"), **same})
        return self._commit(name, added.unionByName(gone, allowMissingColumns=True))

    def fold(self) -> None:
        """Writes a snapshot of all entries: files in force, committed batches and dropped files.

        Entries that the snapshot before held already are removed; a reader that is under way may
        still read those folded now.
        """
        folders = self._folders()
        before, now = self._snapshot(), set(folders.names(f"{self.path}/entries"))
        rows = self.rows()
        drops = rows.filter(F.col("what") == "drop")
        kept = rows.filter(F.col("what").isin("add", "batch")).join(
            drops.select("store", "file").withColumn("what", F.lit("add")), ["store", "file", "what"], "left_anti"
        )
        names = self.spark.createDataFrame([("entry", name) for name in now], "what string, entry string")
        held = {
            row.entry
            for row in (self._read(before).filter((F.col("what") == "entry")).select("entry").collect() if before else [])
        }
        whole = kept.unionByName(drops).unionByName(names, allowMissingColumns=True)
        number = int(before.rsplit("/", 1)[1]) + 1 if before else 1
        staged = f"{self.path}/staging/{uuid.uuid4().hex}"
        whole.select(*NAMES).write.parquet(staged)
        if not folders.rename(staged, f"{self.path}/snapshots/{number}"):
            raise OSError("another snapshot was made meanwhile")
        for name in sorted(held & now):
            folders.remove(f"{self.path}/entries/{name}")

    def vacuum(self) -> int:
        """Removes dropped files, and says how many; call it when no reader is older than the
        compaction that dropped them."""
        dropped = self.rows().filter(F.col("what") == "drop").select("file").distinct().collect()
        folders = self._folders()
        for row in dropped:  # the small files of compacted days
            folders.remove(unquote(row.file))
        return len(dropped)
