"""Buckets by event time that lose no late reading.

Each micro-batch sums its readings per bucket and adds these sums to a store, in a folder of the day
in which the bucket ends. A mark follows the newest reading. A bucket whose end the mark passes is
closed: its record has all sums so far. Readings of a bucket that is closed already are late: their
sums are marked as such, and the bucket gets a corrected record. The last record of a bucket is right
whatever came late, and every late reading is counted in a row that says so.

All sums are DataFrame aggregates; no reading passes through a state process. A micro-batch reads the
days whose buckets it closes or corrects, and its folders are replaced as a whole by a replay, which
sees the sums and the mark of the micro-batches before it, and so writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemill.functions import times
from telemill.operators.averages import KEY
from telemill.sources.folders import Folders
from telemill.streaming.clean import TRIGGER

MARK = "mark bigint"


def _end() -> Column:
    return F.col("bucket") + F.col("interval")


@dataclass(frozen=True)
class BucketStore:
    """Sums, marks and records of buckets in the folder `path`; `schema` has the columns of `key`.

    `delay_ms` is how far the mark stays behind the newest reading.
    """

    spark: SparkSession
    path: str
    delay_ms: int = 0
    key: Sequence[str] = KEY
    schema: str = "did string, pidx int, avg string, interval bigint"

    def _sums_schema(self) -> str:
        return f"{self.schema}, bucket bigint, sum double, num bigint, is_late boolean, day string, turn int"

    def _records_schema(self) -> str:
        return f"{self.schema}, bucket bigint, sum double, num bigint, is_correction boolean, turn int"

    def _read(self, name: str, schema: str) -> DataFrame:
        if not Folders(self.spark, self.path).exists(f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _write(self, rows: DataFrame, name: str, turn: int, *folder: str) -> None:
        (
            rows.withColumn("turn", F.lit(turn))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folder, "turn")
            .parquet(f"{self.path}/{name}")
        )

    def mark(self, turn: int) -> int | None:
        """The mark after a micro-batch; none before there was any reading."""
        path = f"{self.path}/marks/turn={turn}"
        if not Folders(self.spark, self.path).exists(path):
            return None
        return self.spark.read.schema(MARK).parquet(path).first().mark

    def add(self, rows: DataFrame, turn: int) -> None:
        """Takes in the readings or runs of micro-batch number `turn`."""
        is_run = "num" in rows.columns
        value, count = ("sum", F.sum("num")) if is_run else ("x", F.count("x"))
        newest = F.max("newest" if "newest" in rows.columns else "ptimestamp")
        totals = (
            rows.groupBy(*self.key, "bucket")
            .agg(F.sum(value).alias("sum"), count.alias("num"), newest.alias("newest"))
            .persist()
        )
        try:
            before = self.mark(turn - 1)
            latest = totals.agg(F.max("newest")).first()[0]
            reached = [m for m in (before, None if latest is None else latest - self.delay_ms) if m is not None]
            now = max(reached, default=None)
            is_late = F.lit(False) if before is None else _end() <= before
            added = totals.drop("newest").withColumns(
                {"is_late": is_late, "day": times.day_key(_end())}
            )
            self._write(added, "sums", turn, "day")
            if now is not None:
                self._write(self._to_send(added, before, now, turn), "records", turn)
        finally:
            totals.unpersist()
        self.spark.createDataFrame([(now,)], MARK).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/marks/turn={turn}"
        )

    def _to_send(self, added: DataFrame, before: int | None, now: int, turn: int) -> DataFrame:
        """Records of the buckets that end between the two marks, and of those that late readings
        have changed."""
        so_far = self._read("sums", self._sums_schema()).filter(F.col("turn") <= turn)

        def whole(sums: DataFrame, is_correction: bool) -> DataFrame:
            return (
                sums.groupBy(*self.key, "bucket")
                .agg(F.sum("sum").alias("sum"), F.sum("num").alias("num"))
                .withColumn("is_correction", F.lit(is_correction))
            )

        ended = so_far.filter((_end() <= now) & (F.col("day") <= times.day_key(F.lit(now))))
        if before is None:
            return whole(ended, False)
        ended = ended.filter((_end() > before) & (F.col("day") >= times.day_key(F.lit(before))))
        late = added.filter("is_late").select(*self.key, "bucket", "day")
        days = [row.day for row in late.select("day").distinct().collect()]  # days that late ones end in
        changed = so_far.filter(F.col("day").isin(*days)) if days else so_far.limit(0)
        same = [changed[c].eqNullSafe(late[c]) for c in (*self.key, "bucket")]
        return whole(ended, False).unionByName(whole(changed.join(late, same, "left_semi"), True))

    def records(self) -> DataFrame:
        """All records, with `is_correction` and the micro-batch `turn` that made them."""
        return self._read("records", self._records_schema())

    def closed(self) -> DataFrame:
        """The last record of every closed bucket."""
        last = F.max_by(F.struct("sum", "num"), "turn").alias("last")
        return self.records().groupBy(*self.key, "bucket").agg(last).select(
            *self.key, "bucket", "last.sum", "last.num"
        )

    def totals(self) -> DataFrame:
        """The sums of all buckets, open ones too, with `late_num`, how many readings came late."""
        late = F.sum(F.when(F.col("is_late"), F.col("num")).otherwise(0))
        return self._read("sums", self._sums_schema()).groupBy(*self.key, "bucket").agg(
            F.sum("sum").alias("sum"), F.sum("num").alias("num"), late.alias("late_num")
        )


def late_stream(
    rows: DataFrame,
    store: BucketStore,
    checkpoint: str,
    name: str = "buckets",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts a query that keeps a stream of readings, or of runs, in a `BucketStore`."""
    return (
        rows.writeStream.queryName(name)
        .foreachBatch(lambda batch, number: store.add(batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
