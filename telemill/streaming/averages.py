"""Averages over a stream of readings, or of the runs that the cleaning stream makes of them."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from itertools import chain

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from telemill.operators.averages import KEY
from telemill.sources import stores
from telemill.streaming.clean import TRIGGER, Sinks, first_of_run

# Executors get the functions of this module with the task, without an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORD = (
    "app string, id string, portid int, avg string, dtimestamp bigint, ptimestamp bigint, "
    "sum double, num bigint"
)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark) -> None:
    """Keyed state lives in RocksDB, so it may be larger than the memory of an executor."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _as_runs(rows: DataFrame, arrival: str, key: Sequence[str]) -> DataFrame:
    """Runs as they are, or single readings as runs of one."""
    if "num" not in rows.columns:
        rows = rows.withColumnRenamed("x", "sum").withColumn("num", F.lit(1).cast("bigint"))
    app = [] if "app" in key else ["app"]
    newest = "newest" if "newest" in rows.columns else "ptimestamp"
    return rows.select(
        *app, *key, "bucket", "dtimestamp", "ptimestamp",
        F.col(arrival).cast("bigint").alias("arrival"), "sum", "num",
        F.timestamp_millis(newest).alias("event_time"),
    )


OPEN = "bucket bigint, sum double, num bigint, app string, dtimestamp bigint, ptimestamp bigint"

# Fixed value: open buckets are kept in so many shards of devices, each one value of the state.
SHARDS = 4096
# Records in a row that the state process sends, at most.
SENT_ROWS = 10_000


def _shard(key: Sequence[str]) -> Column:
    return F.pmod(F.hash(*key), F.lit(SHARDS)).alias("shard")


def _open_fields(key: Sequence[str]) -> dict[str, str]:
    """What is kept of an open bucket besides its key."""
    return {c: t for c, t in (field.split() for field in OPEN.split(", ")) if c not in key}


class Rollover(StatefulProcessor):
    """Holds the open buckets of a shard of devices, ports and intervals; `key` names the parts of
    their key, `types` has the types of these.

    Each call to the state has a price of its own, whatever it brings, so a shard is one value, with
    an array for each column, and has one timer, that of the bucket which is due first.

    `evict` is none, "clock" (two intervals of processing time) or "event" (the watermark).
    """

    def __init__(
        self, evict: str | None, emit_on_evict: bool, key: Sequence[str], types: Sequence[str]
    ) -> None:
        self.evict = evict
        self.emit_on_evict = emit_on_evict
        self.names = list(key)
        self.interval = self.names.index("interval")
        fields = {**dict(zip(key, types)), **_open_fields(key), "due": "bigint"}
        self.fields = list(fields)
        self.schema = ", ".join(f"{c} array<{t}>" for c, t in fields.items())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", self.schema)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        shard = {}
        for held in json.loads(initialState["open"].iloc[0]):  # one row, with the whole shard
            name = tuple([held[c] for c in self.names])
            held["sum"] = _number(held["sum"])
            held["due"] = self._due(name, held, timerValues) if self.evict else None
            shard[name] = held
        self._keep(shard, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        shard = self._held()
        first_due = _first_due(shard)
        arrived: dict[tuple, list[dict]] = {}
        for run in map(json.loads, chain.from_iterable(frame["run"] for frame in rows)):
            run["sum"] = _number(run["sum"])
            arrived.setdefault(tuple([run[c] for c in self.names]), []).append(run)
        records = []
        for name, runs in arrived.items():
            held = shard.get(name)
            begun = None if held is None else held["bucket"]
            # A micro-batch has one row per run of a bucket, so the rows of a device are few.
            for run in sorted(runs, key=lambda run: run["arrival"]):
                if held is not None and run["bucket"] == held["bucket"]:
                    held["sum"] += run["sum"]
                    held["num"] += run["num"]
                    continue
                if held is not None:
                    records.append(self._record(name, held, run))
                due = None if held is None else held["due"]
                held = {**{c: run[c] for c in self.fields if c != "due"}, "due": due}
            if self.evict and held["bucket"] != begun:
                held["due"] = self._due(name, held, timerValues)
            shard[name] = held
        self._keep(shard, first_due)
        yield from _frames(records)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        shard, now = self._held(), self._now(timerValues)
        is_due = [name for name, held in shard.items() if held["due"] <= now]
        if not is_due:
            # The buckets of that time were closed, or looked at for another timer.
            return
        records = []
        for name in is_due:
            held = shard[name]
            if held["bucket"] >= now - 2 * name[self.interval]:
                held["due"] = self._due(name, held, timerValues)
                continue
            del shard[name]
            if self.emit_on_evict:
                records.append(self._record(name, held, held))
        self._keep(shard, None)
        yield from _frames(records)

    def _held(self) -> dict[tuple, dict]:
        found, width = self.open.get(), len(self.names)
        rows = () if found is None else zip(*found)
        return {row[:width]: dict(zip(self.fields, row)) for row in rows}

    def _keep(self, shard: dict[tuple, dict], first_due: int | None) -> None:
        """Keeps the shard, with a timer if another than the one at `first_due` is the first now."""
        if not shard:
            self.open.clear()
            return
        self.open.update(tuple([held[c] for held in shard.values()] for c in self.fields))
        due = _first_due(shard)
        if due is not None and due != first_due:
            self.handle.registerTimer(due)

    def _now(self, timer_values) -> int:
        if self.evict == "event":
            return timer_values.getCurrentWatermarkInMs()
        return timer_values.getCurrentProcessingTimeInMs()

    def _due(self, name: tuple, held: dict, timer_values) -> int:
        """When the bucket will have been idle for two intervals, if nothing closes it before."""
        since = held["bucket"] + 1 if self.evict == "event" else self._now(timer_values)
        return since + 2 * name[self.interval]

    def _record(self, name: tuple, held: dict, closer: dict) -> tuple:
        """What is sent of a bucket, in the order of RECORD; `closer` is the run that closes it."""
        return (
            closer["app"], held["did"], held["pidx"], held["avg"],
            closer["dtimestamp"], closer["ptimestamp"], held["sum"], held["num"],
        )

    def close(self) -> None:
        pass


def _first_due(shard: dict[tuple, dict]) -> int | None:
    return min((held["due"] for held in shard.values() if held["due"] is not None), default=None)


def _number(value: float | str | None) -> float | None:
    """A sum as JSON has it, where infinity is a string."""
    return float(value) if isinstance(value, str) else value


# Sums go back as text: pandas would make a null of one that is no number.
SENT = {c: "string" if c == "sum" else t for c, t in (f.split() for f in RECORD.split(", "))}


def _frames(records: list[tuple]) -> Iterator[pd.DataFrame]:
    """Records as rows with an array for each column, so that integers beside nulls stay whole."""
    for begin in range(0, len(records), SENT_ROWS):
        columns = dict(zip(SENT, map(list, zip(*records[begin : begin + SENT_ROWS]))))
        columns["sum"] = [None if x is None else repr(x) for x in columns["sum"]]
        yield pd.DataFrame({c: [values] for c, values in columns.items()})


def rollover_stream(
    rows: DataFrame,
    arrival: str = "arrival",
    evict: bool | str = False,
    emit_on_evict: bool = False,
    key: Sequence[str] = KEY,
    delay: str = "0 seconds",
    initial: DataFrame | None = None,
) -> DataFrame:
    """Average records of a stream of runs or readings, each sent when its bucket is closed.

    `rows` come from `partial_runs` or `readings` with the column `app`; `arrival` orders them, and
    `key` tells averages apart, as there (`key_of` the rule book's).

    `evict="event"` drops a bucket, unsent unless `emit_on_evict`, when the watermark, `delay` behind
    the newest reading, is more than two intervals past its begin. This depends on the readings
    alone, so a run that is repeated evicts the same buckets; readings older than the watermark are
    left out (`late_stream` keeps them). `evict="clock"`, or true, goes by the time of processing.

    The state is kept in `SHARDS` shards, a number that holds for the life of a checkpoint.

    `initial` has the buckets that an earlier run or a batch left open (`handed_over`); the first
    micro-batch goes on from them, and a restart, which has its own state, does not read them. Needs
    `use_state_store`.
    """
    kind = "clock" if evict is True else evict or None
    runs = _as_runs(rows, arrival, key)
    runs = runs.withWatermark("event_time", delay) if kind == "event" else runs.drop("event_time")
    types = [runs.schema[c].dataType.simpleString() for c in key]
    # A run goes to Python as one text, which costs less there than a value for each column.
    fields = [c for c in runs.columns if c != "event_time"]
    marked = ["event_time"] if kind == "event" else []
    shards = runs.select(_shard(key), _text(F.struct(*fields)).alias("run"), *marked)
    sent = shards.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=Rollover(kind, emit_on_evict, key, types),
        outputStructType=", ".join(f"{c} array<{t}>" for c, t in SENT.items()),
        outputMode="Append",
        timeMode={None: "None", "clock": "ProcessingTime", "event": "EventTime"}[kind],
        initialState=None if initial is None else _in_shards(initial, key).groupBy("shard"),
    )
    sums = F.col("sum").cast("array<double>")
    return sent.withColumn("sum", sums).select(F.inline(F.arrays_zip(*SENT))).withColumn(
        "num", F.col("num").cast("int")
    )


def _text(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _in_shards(open_buckets: DataFrame, key: Sequence[str]) -> DataFrame:
    """A row per shard, with its open buckets as one text."""
    held = F.struct(*key, *_open_fields(key))
    return open_buckets.groupBy(_shard(key)).agg(_text(F.collect_list(held)).alias("open"))


def handed_over(open_buckets: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Open buckets, of `still_open` or of another stream's state, as the begin of a stream.

    Where it is not known when a bucket was opened, or by which app, this stays null.
    """
    known = open_buckets.columns
    return open_buckets.select(
        *key, "bucket", "sum", F.col("num").cast("bigint").alias("num"),
        *[
            (F.col(c) if c in known else F.lit(None)).cast(kind).alias(c)
            for c, kind in (("app", "string"), ("dtimestamp", "bigint"), ("ptimestamp", "bigint"))
            if c not in key
        ],
    )


def open_buckets(spark, checkpoint: str, key: Sequence[str] = KEY) -> DataFrame:
    """The buckets that a rollover stream holds open, from the state in its checkpoint."""
    state = (
        spark.read.format("statestore").option("path", checkpoint)
        .option("stateVarName", "open").load()
    )
    fields = [*key, *_open_fields(key)]
    shards = state.select(*[F.col(f"value.{c}").alias(c) for c in fields])
    return shards.select(F.inline(F.arrays_zip(*fields)))


def window_stream(
    rows: DataFrame, delay: str = "0 seconds", key: Sequence[str] = KEY
) -> DataFrame:
    """Complete buckets of all intervals by event time, each once the watermark has passed its end.

    `rows` come from `partial_runs` or `readings`. A reading is dropped if the watermark, `delay`
    behind the newest, had passed the end of its bucket before (`late_stream` keeps it). Rows with a
    column `event_time` bring a watermark of their own, as those of `union_of_sources` do. Sums are
    Spark's streaming aggregation; with `use_state_store` they may be larger than memory.
    """
    runs = rows if "num" in rows.columns else rows.withColumnRenamed("x", "sum").withColumn(
        "num", F.lit(1).cast("bigint")
    )
    if "event_time" not in rows.columns:
        newest = "newest" if "newest" in rows.columns else "ptimestamp"
        runs = runs.withColumn("event_time", F.timestamp_millis(newest)).withWatermark(
            "event_time", delay
        )
    # Buckets are closed by their ends, so what marks the event time as watched goes on to these.
    watched = runs.schema["event_time"].metadata
    ends = F.timestamp_millis(F.col("bucket") + F.col("interval")).alias("ends", metadata=watched)
    return (
        runs.select(*key, "bucket", ends, "sum", "num")
        .groupBy(*key, "bucket", "ends")
        .agg(F.sum("sum").alias("sum"), F.sum("num").alias("num"))
        .drop("ends")
    )


def store_records(
    records: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    name: str = "averages",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts a query that forwards average records as JSON and files them by app and day."""
    stamped, is_first = stores.stamp(records), first_of_run()

    def each(batch: DataFrame, number: int) -> None:
        batch_id = f"{name}-{number}"
        batch = batch.persist()
        try:
            if sinks.forward is not None:
                fields = batch.drop("app", "stored_at").columns
                sinks.forward(batch.select(F.to_json(F.struct(*fields)).alias("value")), batch_id)
            if sinks.main is not None or sinks.backup is not None:
                stores.store_batch(
                    batch, batch_id, sinks.main, sinks.backup, sinks.level, is_first(), sinks.ledger
                )
        finally:
            batch.unpersist()

    return (
        stamped.writeStream.queryName(name)
        .foreachBatch(each)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
