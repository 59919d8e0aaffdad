"""The cleaning stream: decode, apply the current rules, store, hand readings to the averages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemill.operators.averages import key_of, partial_runs, readings_of, slice_cuts
from telemill.operators.clean import apply_rules, cleaned
from telemill.operators.metrics import observed
from telemill.operators.rules import RuleBook, RuleFeed
from telemill.sources import stores
from telemill.sources.ledger import Ledger
from telemill.sources.messages import accepted, decode, quarantined, to_wire
from telemill.sources.stores import Level
from telemill.streaming.rule_changes import RuleChanges

# Fixed value: default length of a micro-batch.
TRIGGER = "10 seconds"

Writer = Callable[[DataFrame, str], None]


def parquet_batches(path: str) -> Writer:
    """A table with one folder per micro-batch.

    A batch is staged and its folder then renamed, so the folder is there as a whole or not at all. If
    it is there, a replay leaves it as it is: a stream that reads the table would take rewritten files
    for new ones.
    """

    def write(batch: DataFrame, batch_id: str) -> None:
        if _is_there(batch.sparkSession, f"{path}/batch={batch_id}"):
            return
        (
            batch.withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    return write


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException:
        return False
    return True


def topic(servers: str, name: str) -> Writer:
    """A Kafka topic; takes rows with a column `value`. Delivery is at least once."""

    def write(batch: DataFrame, _: str) -> None:
        (
            batch.select("value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", name)
            .save()
        )

    return write


@dataclass(frozen=True)
class Sinks:
    """Where a cleaning stream writes; an output without a writer is left out.

    `main` may be a `RoutedStore`, with stores of their own for some apps. With a `ledger` a batch
    counts in the stores once it is committed there.
    """

    forward: Writer | None = None
    main: Writer | None = None
    backup: Writer | None = None
    level: Level = Level.BOTH
    readings: Writer | None = None
    quarantine: Writer | None = None
    ledger: Ledger | None = None


def first_of_run() -> Callable[[], bool]:
    """True on the first call: only the first micro-batch of a run can be a replay."""
    calls = iter([True])
    return lambda: next(calls, False)


def process_batch(
    decoded: DataFrame,
    batch_id: str,
    book: RuleBook,
    sinks: Sinks,
    keep: tuple[str, ...] = (),
    arrival: str | None = None,
    strict: bool = False,
    replayed: bool = False,
) -> None:
    """One micro-batch: the rules of the book are applied once, and all outputs are made of that."""
    decoded = decoded.persist()
    messages = accepted(decoded)
    ruled = apply_rules(messages, book, strict).persist()
    try:
        clean = cleaned(ruled, messages.columns)
        if sinks.forward is not None:
            sinks.forward(to_wire(clean), batch_id)
        if sinks.main is not None or sinks.backup is not None:
            stores.store_batch(
                clean, batch_id, sinks.main, sinks.backup, sinks.level, replayed, sinks.ledger
            )
        if sinks.readings is not None:
            fed = readings_of(ruled, ("app", *keep), book.key)
            if arrival is not None:
                carry = [] if "app" in book.key else ["app"]
                cuts = slice_cuts(messages, [arrival])
                fed = partial_runs(fed, arrival, cuts, carry=carry, key=key_of(book.key))
            sinks.readings(fed, batch_id)
        if sinks.quarantine is not None:
            sinks.quarantine(quarantined(decoded), batch_id)
    finally:
        ruled.unpersist()
        decoded.unpersist()


def clean_stream(
    source: DataFrame,
    rules: Callable[[], DataFrame] | RuleChanges,
    sinks: Sinks,
    checkpoint: str,
    name: str = "clean",
    column: str = "value",
    key: tuple[str, ...] = ("did",),
    keep: tuple[str, ...] = (),
    arrival: str | None = None,
    strict: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the stream. `source` is any streaming DataFrame with message text in `column`; `rules`
    reads the rule table, which is looked at for each micro-batch, so that a change applies to all
    later messages, or is a feed of changes, of which only new ones are read. `keep` names further source columns that identify a message and travel with it. With `arrival`,
    the numeric one of them that orders messages, readings are written as runs of one bucket.

    The progress of the query carries the message counters (see `telemill.streaming.progress`).
    """
    decoded = observed(stores.stamp(decode(source, column)), "messages")

    is_first = first_of_run()
    feed = rules if isinstance(rules, RuleChanges) else RuleFeed(rules, key)

    def each(batch: DataFrame, number: int) -> None:
        batch_id = f"{name}-{number}"
        process_batch(batch, batch_id, feed.current(), sinks, keep, arrival, strict, is_first())

    return (
        decoded.writeStream.queryName(name)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
