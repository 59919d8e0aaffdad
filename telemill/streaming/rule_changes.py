"""Rules as a feed of changes: a stream folds what is new into versions of its own.

`RuleFeed` looks at the whole rule table for each micro-batch. Here the source is a table of changes,
each with a number `seq` that grows; only changes above the high-water mark are read. They are folded
into the rules of the devices they name, and these devices, and no others, are written as a new
version. Lookups use the rules held in memory by the executors, so a micro-batch without changes
reads no rule from any table. A manifest per version, put in place by a rename, names the mark and the
versions in force, so that a restart goes on from there; after some versions they are merged into one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemill.operators import rules as R
from telemill.sources.folders import Folders

RULE = "did string, pidx int, app string, id bigint, cmd string, avg string, used int"
NAMES = [field.split()[0] for field in RULE.split(", ")]
# A change also has a number; a version has the number of the version, and a row without a port for
# a device that has no rules left.
CHANGE = RULE + ", seq bigint"
VERSIONED = RULE + ", version int"


class RuleChanges:
    """The rule book of a stream from a feed of changes.

    `changes(after)` gives the changes (`CHANGE`) with a `seq` above `after`; it should read no others.
    A change is the row of a rule as it is now: in use it sets the rule of its device and port, else it
    deletes it (see `apply_rule_changes`). `path` is a shared folder that belongs to this feed. The
    book is by device.
    """

    def __init__(
        self,
        spark: SparkSession,
        changes: Callable[[int], DataFrame],
        path: str,
        merge_after: int = 20,
    ) -> None:
        self._spark = spark
        self._changes = changes
        self._path = path
        self._merge_after = merge_after
        self._high, self._versions = -1, []
        self._rules: DataFrame | None = None
        self._book: R.RuleBook | None = None

    @property
    def high_water(self) -> int:
        """The number of the last change that is in force."""
        return self._high

    @property
    def versions(self) -> list[int]:
        return list(self._versions)

    def current(self) -> R.RuleBook:
        """The book with all changes so far."""
        if self._book is None:
            self._open()
        new = self._changes(self._high).filter(F.col("seq") > self._high).select(*NAMES, "seq")
        # One row of totals; nothing else happens if nothing is new.
        highest = new.agg(F.max("seq")).first()[0]
        if highest is not None:
            # What comes in meanwhile is for the next time.
            self._fold(new.filter(F.col("seq") <= highest), highest)
            if len(self._versions) > self._merge_after:
                self._merge()
        return self._book

    def _folders(self) -> Folders:
        return Folders(self._spark, self._path)

    def _manifests(self) -> list[int]:
        return [int(n) for n in self._folders().names(f"{self._path}/manifests") if n.isdigit()]

    def _read(self, versions: list[int]) -> DataFrame:
        """The rules of devices as their last version has them."""
        if not versions:
            return self._spark.createDataFrame([], RULE)
        rows = self._spark.read.schema(VERSIONED).parquet(
            *[f"{self._path}/versions/{n}" for n in versions]
        )
        last = F.max("version").over(Window.partitionBy("did"))
        return rows.withColumn("_last", last).filter(
            (F.col("version") == F.col("_last")) & F.col("pidx").isNotNull()
        ).select(*NAMES)

    def _open(self) -> None:
        numbers = self._manifests()
        if numbers:
            text = self._spark.read.text(f"{self._path}/manifests/{max(numbers)}").first().value
            held = json.loads(text)
            self._high, self._versions = held["high"], held["versions"]
        self._hold(self._read(self._versions))

    def _hold(self, rules: DataFrame, kept: list[DataFrame] | None = None) -> None:
        """Keeps rules and lookup rows in the executors' memory; `kept` has both of the devices other
        than those of `rules`."""
        old = [frame for frame in (self._rules, self._book and self._book.devices) if frame is not None]
        whole = rules if kept is None else kept[0].unionByName(rules)
        whole = whole.persist()
        devices = R.folded_rules(R.effective_rules(rules), ("did",))
        if kept is not None:
            devices = kept[1].unionByName(devices)
        devices = devices.persist()
        total = devices.agg(F.sum("bytes")).first()[0] or 0
        whole.count()
        self._rules = whole
        self._book = R.RuleBook(devices, ("did",), total <= R.BROADCAST_BYTES)
        for frame in old:
            frame.unpersist()

    def _write(self, rules: DataFrame, number: int) -> None:
        rules.withColumn("version", F.lit(number)).write.mode("overwrite").parquet(
            f"{self._path}/versions/{number}"
        )

    def _commit(self, number: int, high: int, versions: list[int]) -> None:
        staged = f"{self._path}/staging/{uuid.uuid4().hex}"
        text = json.dumps({"high": high, "versions": versions})
        self._spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(staged)
        if not self._folders().rename(staged, f"{self._path}/manifests/{number}"):
            raise OSError(f"another stream has made version {number} of these rules")
        self._high, self._versions = high, versions

    def _fold(self, new: DataFrame, highest: int) -> None:
        number = max(self._manifests(), default=0) + 1
        folder = f"{self._path}/changes/{number}"
        new.write.mode("overwrite").parquet(folder)
        changes = self._spark.read.schema(CHANGE).parquet(folder)
        touched = changes.filter(F.col("did").isNotNull()).select("did").distinct()
        old = self._rules.join(touched, "did", "left_semi")
        folded = R.apply_rule_changes(old, changes).select(*NAMES)
        gone = touched.join(folded, "did", "left_anti").select(
            "did", *[F.lit(None).alias(c) for c in NAMES if c != "did"]
        )
        self._write(folded.unionByName(gone), number)
        written = self._spark.read.schema(VERSIONED).parquet(f"{self._path}/versions/{number}")
        others = [
            frame.join(touched, "did", "left_anti") for frame in (self._rules, self._book.devices)
        ]
        self._hold(written.filter(F.col("pidx").isNotNull()).select(*NAMES), others)
        self._commit(number, highest, [*self._versions, number])

    def _merge(self) -> None:
        """All versions as one, and the rules anew from it, which ends the lineage of what is held."""
        number = max(self._manifests()) + 1
        self._write(self._read(self._versions), number)
        self._commit(number, self._high, [number])
        self._hold(self._read(self._versions))
