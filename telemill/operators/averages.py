"""Sums and counts per device, port and interval: complete buckets and rollover records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.functions import times
from telemill.functions import values as V
from telemill.operators.clean import apply_rules, found_rule, transform_value
from telemill.operators.rules import RuleBook

KEY = ("did", "pidx", "avg", "interval")


# Messages in a slice of arrival, about.
SLICE_ROWS = 1_000_000


def key_of(book_key: Sequence[str]) -> tuple[str, ...]:
    """What tells averages apart: the key of the rules, the port and the interval."""
    return (*book_key, "pidx", "avg", "interval")


def _names(key: Sequence[str]) -> list[Column]:
    return [F.col("id").alias("did") if c == "did" else F.col(c) for c in key]


def _fed(
    messages: DataFrame, book: RuleBook, keep: Sequence[str], intervals: Sequence[int] | None
) -> DataFrame:
    """One row per port value that feeds averages: the key, `pidx`, times, `keep`, `x`, `intervals`
    (only those wanted) and `grain`.

    Rules are looked up within the message, so that only a port's own rule goes with it. Ports without
    intervals go before any value is transformed.
    """
    wanted = ["id", "portnum", "dtimestamp", "ptimestamp", "values", "app", *keep]
    slim = messages.select(*[c for c in messages.columns if c in wanted])

    def looked_up(port: Column, pidx: Column) -> Column:
        rule = F.when(pidx < F.col("portnum"), F.coalesce(*found_rule(pidx)))
        return F.struct(pidx.alias("pidx"), port["value"].alias("value"), rule.alias("rule"))

    def feeds(item: Column) -> Column:
        has_interval = F.coalesce(F.size(item["rule"]["intervals"]) > 0, F.lit(False))
        if intervals is not None:
            has_interval = has_interval & F.exists(
                item["rule"]["intervals"], lambda entry: entry["ms"].isin(*intervals)
            )
        return has_interval & V.is_present(item["value"])

    carried = [c for c in keep if c not in book.key]
    ports = F.filter(F.transform("values", looked_up), feeds)
    each = book.join(slim, "inner").select(
        *_names(book.key), "dtimestamp", "ptimestamp", *carried, F.inline_outer(ports)
    )
    result, _ = transform_value(F.col("rule"), V.to_double(F.col("value")))
    of_rule = F.col("rule.intervals")
    if intervals is not None:
        of_rule = F.filter(of_rule, lambda entry: entry["ms"].isin(*intervals))
    return each.select(
        *book.key, "pidx", "dtimestamp", "ptimestamp", *carried, result.alias("x"),
        of_rule.alias("intervals"), F.col("rule.grain").alias("grain"),
    ).filter(F.col("x").isNotNull())


def readings(
    messages: DataFrame,
    book: RuleBook,
    keep: Sequence[str] = (),
    strict: bool = False,
    intervals: Sequence[int] | None = None,
) -> DataFrame:
    """The values that feed averages, once per interval of their rule (see `readings_of`).

    `intervals` names the lengths wanted, if not all; others are left out before any value is
    transformed. With `strict` a failed action ends the job, whether or not it feeds an average.
    """
    if strict:
        rows = readings_of(apply_rules(messages, book, True), keep, book.key)
        return rows if intervals is None else rows.filter(F.col("interval").isin(*intervals))
    fed = _fed(messages, book, keep, intervals)
    others = [c for c in fed.columns if c not in ("intervals", "grain")]
    each = fed.select(*others, F.inline("intervals")).withColumnRenamed("ms", "interval")
    return each.withColumn("bucket", times.bucket(F.col("ptimestamp"), F.col("interval")))


def rolled_up(
    messages: DataFrame, book: RuleBook, intervals: Sequence[int] | None = None
) -> DataFrame:
    """Whole sums and counts of every bucket of every interval, as `tumbling` of `readings` gives.

    A reading is summed once, in a bucket of its rule's grain, the longest time that divides all
    intervals of the rule; only these partial sums are then given out to the intervals. Both sums
    combine before they are shuffled, so a hot device sends a few rows from each task.
    """
    key = ("pidx", *book.key)
    fed = _fed(messages, book, (), intervals)
    partial = (
        fed.withColumn("part", times.bucket(F.col("ptimestamp"), F.col("grain")))
        .groupBy(*key, "intervals", "part")
        .agg(F.sum("x").alias("sum"), F.count("x").alias("num"))
    )
    each = partial.select(*key, "part", "sum", "num", F.inline("intervals")).withColumnRenamed(
        "ms", "interval"
    )
    return (
        each.withColumn("bucket", times.bucket(F.col("part"), F.col("interval")))
        .groupBy(*key_of(book.key), "bucket")
        .agg(F.sum("sum").alias("sum"), F.sum("num").alias("num"))
    )


def readings_of(
    ruled: DataFrame, keep: Sequence[str] = (), key: Sequence[str] = ("did",)
) -> DataFrame:
    """Readings from messages with `ruled_ports` (see `apply_rules`).

    Columns: those of `key_of(key)`, `bucket, x, dtimestamp, ptimestamp` and those in `keep`. A
    reading needs a rule with intervals and a value; whether it is valid does not matter. A failed
    action feeds nothing.
    """
    carried = [c for c in keep if c not in key]
    each = ruled.select(
        *_names(key),
        "dtimestamp",
        "ptimestamp",
        *carried,
        # An outer generator: the plain one would also filter on the ports below it, and apply the
        # rules twice.
        F.posexplode_outer("ruled_ports").alias("pidx", "port"),
    )
    fed = each.filter(F.col("port.result").isNotNull()).select(
        *key,
        "pidx",
        "dtimestamp",
        "ptimestamp",
        *carried,
        F.col("port.result").alias("x"),
        F.inline("port.intervals"),
    )
    return fed.withColumnRenamed("ms", "interval").withColumn(
        "bucket", times.bucket(F.col("ptimestamp"), F.col("interval"))
    )


def tumbling(rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The whole sum and count of every bucket; partial sums keep a hot device balanced."""
    return rows.groupBy(*key, "bucket").agg(
        F.sum("x").alias("sum"), F.count("x").alias("num")
    )


def rollover_in_order(
    rows: DataFrame,
    arrival: str,
    slice_buckets: int = 100_000,
    carry: Sequence[str] = (),
    key: Sequence[str] = KEY,
) -> DataFrame:
    """`rollover` for readings whose buckets never go back along `arrival`, a numeric column.

    Then a run is a bucket, so readings are summed before they are shuffled, and only buckets are
    put in order, `slice_buckets` of a key at a time. Readings that break the order end the job.
    """
    order = F.col(arrival)
    trigger = ("dtimestamp", "ptimestamp", *carry)
    buckets = rows.groupBy(*key, "bucket").agg(
        F.sum("x").alias("sum"),
        F.count("x").alias("num"),
        F.min(order).alias("_own__first"),
        F.max(order).alias("_last"),
        *[F.min_by(c, order).alias(f"_own_{c}") for c in trigger],
    )
    slices = F.floor(F.col("bucket") / F.col("interval") / F.lit(slice_buckets))
    in_slice = Window.partitionBy(*key, "_slice").orderBy("bucket")
    runs = buckets.withColumn("_slice", slices).withColumn("_run", F.row_number().over(in_slice))
    checked = F.when(
        F.col("_first") < F.col("_last"), F.raise_error(F.lit("readings are not in order"))
    ).otherwise(F.col("dtimestamp"))
    closed = _stitch(runs, ("_first", *trigger), F.max("_last").alias("_last"), key=key)
    return closed.withColumn("dtimestamp", checked).drop("_first", "_last")


def _at(arrival: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(arrival)])


def slice_cuts(
    messages: DataFrame, arrival: Sequence[str], key: str = "id", rows: int | None = None
) -> DataFrame | None:
    """Where the readings of hot devices are cut: `key` and `cuts`, an ascending array of `arrival`
    tuples, for devices that reach over the end of a range; None if there is only one range.

    Ranges of (device, arrival) with about `rows` messages each are cut at quantiles that Spark
    samples, so a burst is cut as finely as any other time. Only these columns of the messages are
    read; no rule is applied. `arrival` orders the messages of a device without ties.
    """
    rows = SLICE_ROWS if rows is None else rows
    narrow = messages.select(F.col(key).alias("_key"), _at(arrival).alias("_at"))
    ranges = -(-narrow.count() // rows)
    if ranges <= 1:
        return None
    # A row per range and device at its begin; the first of each device needs no cut.
    begins = (
        narrow.repartitionByRange(ranges, "_key", "_at")
        .groupBy("_key", F.spark_partition_id().alias("_range"))
        .agg(F.min("_at").alias("_at"))
    )
    return (
        begins.groupBy("_key")
        .agg(F.sort_array(F.collect_list("_at")).alias("cuts"))
        .filter(F.size("cuts") > 1)
        .select(F.col("_key").alias(key), F.slice("cuts", 2, F.size("cuts")).alias("cuts"))
    )


def rollover(
    rows: DataFrame,
    arrival: Sequence[str],
    cuts: DataFrame | None = None,
    carry: Sequence[str] = (),
    key: Sequence[str] = KEY,
) -> DataFrame:
    """One open bucket per key: a reading of another bucket closes it, whether later or earlier.

    Gives every run of readings of one bucket in arrival order with `sum` and `num`, and with
    `dtimestamp`, `ptimestamp` and the `carry` columns of the reading that closed it; these are
    null for the run still open at the end. `arrival` names the order columns. With the `cuts` of
    the messages (`slice_cuts`, over the same columns) a hot device is put in order slice by slice,
    and only the first and last runs of slices meet per key; without, device by device.
    """
    trigger = ("dtimestamp", "ptimestamp", *carry)
    return _stitch(_slice_runs(rows, arrival, cuts, trigger, key), trigger, key=key)


def _sliced(rows: DataFrame, arrival: Sequence[str], cuts: DataFrame | None) -> DataFrame:
    """Adds `_slice`: how many cuts of its device a reading has behind it."""
    if cuts is None:
        return rows.withColumn("_slice", F.lit(0))
    before = F.size(F.filter("cuts", lambda cut: cut <= _at(arrival)))
    # Few devices are hot: at most one for each range.
    return (
        rows.join(F.broadcast(cuts.withColumnRenamed("id", "did")), "did", "left")
        .withColumn("_slice", F.when(F.col("cuts").isNull(), 0).otherwise(before))
        .drop("cuts")
    )


def _slice_runs(
    rows: DataFrame,
    arrival: Sequence[str],
    cuts: DataFrame | None,
    own: Sequence[str],
    key: Sequence[str],
) -> DataFrame:
    """Runs of one bucket within slices of arrival, with the `own` columns of the first reading."""
    sliced = _sliced(rows, arrival, cuts)
    in_slice = Window.partitionBy(*key, "_slice").orderBy(*arrival)
    previous = F.lag("bucket").over(in_slice)
    marked = sliced.withColumn(
        "_starts", previous.isNull() | (previous != F.col("bucket"))
    ).withColumn("_run", F.sum(F.col("_starts").cast("int")).over(in_slice))
    return marked.groupBy(*key, "_slice", "_run", "bucket").agg(
        F.sum("x").alias("sum"),
        F.count("x").alias("num"),
        F.max("ptimestamp").alias("newest"),
        *[F.max(F.when(F.col("_starts"), F.col(c))).alias(f"_own_{c}") for c in own],
    )


def partial_runs(
    rows: DataFrame,
    arrival: str,
    cuts: DataFrame | None = None,
    carry: Sequence[str] = (),
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Readings of a micro-batch summed as runs of one bucket, in place of single readings.

    Each run has `sum`, `num`, `newest`, its last `ptimestamp`, and `arrival`, `dtimestamp`, `ptimestamp`
    and the `carry` columns of its first reading. A hot device so sends few rows to the state that holds its open bucket.
    """
    own = ("dtimestamp", "ptimestamp", *carry)
    runs = _slice_runs(
        rows.withColumn("arrival", F.col(arrival)), [arrival], cuts, (*own, "arrival"), key
    )
    first = [F.col(f"_own_{c}").alias(c) for c in (*own, "arrival")]
    return runs.select(*key, "bucket", "sum", "num", "newest", *first)


def _stitch(
    runs: DataFrame, trigger: Sequence[str], *more: Column, key: Sequence[str] = KEY
) -> DataFrame:
    """Joins the runs of neighbouring slices and finds the reading that closed each.

    `runs` has `_slice`, `_run` (from 1 in each slice) and the `_own_` columns of the first reading
    of a run. `more` holds further aggregates over the parts of a run.
    """
    by_run = Window.partitionBy(*key, "_slice").orderBy("_run")
    whole_slice = Window.partitionBy(*key, "_slice")
    own = F.struct(*[F.col(f"_own_{c}").alias(c) for c in trigger])
    is_edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    # The edges of all slices of a key meet; inner runs stay with their slice.
    numbered = (
        runs.withColumn("_own", own)
        .withColumn("_next", F.lead("_own").over(by_run))
        .withColumn("_runs", F.max("_run").over(whole_slice))
        .withColumn("_part", F.when(~is_edge, F.col("_slice")))
    )
    # A run that reaches over the end of a slice continues as the first run of the next slice.
    along = Window.partitionBy(*key, "_part").orderBy("_slice", "_run")
    continues = (F.lag("_slice").over(along) != F.col("_slice")) & (
        F.lag("bucket").over(along) == F.col("bucket")
    )
    joined = (
        numbered.withColumn("_continues", F.coalesce(continues, F.lit(False)))
        .withColumn("_closer", F.coalesce("_next", F.lead("_own").over(along)))
        .withColumn("_joined", F.sum((~F.col("_continues")).cast("int")).over(along))
        .withColumn("_is_last", ~F.coalesce(F.lead("_continues").over(along), F.lit(False)))
    )
    return (
        joined.groupBy(*key, "_part", "_joined", "bucket")
        .agg(
            F.sum("sum").alias("sum"),
            F.sum("num").alias("num"),
            *more,
            *[F.max(F.when(F.col("_is_last"), F.col(f"_closer.{c}"))).alias(c) for c in trigger],
        )
        .drop("_part", "_joined")
    )


def emitted(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("ptimestamp").isNotNull())


def still_open(runs: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The last bucket of each key, which no reading has closed."""
    return runs.filter(F.col("ptimestamp").isNull()).select(*key, "bucket", "sum", "num")


def avg_records(runs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Closed runs as average records; the consumer divides `sum` by `num`."""
    return emitted(runs).select(
        *carry,
        F.col("did").alias("id"),
        F.col("pidx").alias("portid"),
        "avg",
        "dtimestamp",
        "ptimestamp",
        "sum",
        F.col("num").cast("int").alias("num"),
    )


def is_idle(begin: Column, interval: Column, now: Column) -> Column:
    """A bucket that began more than two intervals ago."""
    return begin < now - 2 * interval


def evict_idle(open_buckets: DataFrame, now: Column) -> DataFrame:
    """The open buckets that survive an eviction at `now`; the others are dropped unsent."""
    return open_buckets.filter(~is_idle(F.col("bucket"), F.col("interval"), now))
