"""Time buckets, interval lists, day and hour keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named intervals in milliseconds.
NAMED_INTERVALS = {"MIN": 60000, "HOUR": 3600000, "DAY": 86400000}
DAY_MS = 86400000


def bucket(ts: Column, interval: Column) -> Column:
    """Begin of the interval that holds `ts`, cut toward zero; days are UTC days."""
    return ts - ts % interval


def _interval(name: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in NAMED_INTERVALS.items() for x in pair])
    number = F.when(name.rlike("^[+-]?[0-9]+$"), name.try_cast("bigint"))
    return F.when(
        name.isin(*NAMED_INTERVALS),
        F.struct(name.alias("avg"), F.try_element_at(named, name).cast("bigint").alias("ms")),
    ).otherwise(
        F.struct(F.concat(F.lit("INTERVAL"), number.cast("string")).alias("avg"), number.alias("ms"))
    )


def _first_of_length(entries: Column) -> Column:
    lengths = F.transform(entries, lambda entry: entry["ms"])
    return F.filter(
        entries, lambda entry, i: F.array_position(lengths, entry["ms"]) == i + F.lit(1)
    )


def parse_intervals(spec: Column) -> Column:
    """`MIN&HOUR&300000` as (name, length) pairs; unknown parts are skipped, null gives none.

    One entry is kept for each length, the first one written.
    """
    entries = F.transform(F.split(F.coalesce(spec, F.lit("")), "&"), _interval)
    # Bound by a one-element array, so that the text is parsed once.
    bound = F.array(F.filter(entries, lambda entry: entry["ms"].isNotNull()))
    return F.element_at(F.transform(bound, _first_of_length), 1)


def has_bad_interval(intervals: Column) -> Column:
    return F.exists(intervals, lambda entry: entry["ms"] <= 0)


def _utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / F.lit(DAY_MS)).cast("int"))


def day_key(ms: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """The UTC day, whatever the zone of the session: `yyyy-MM-dd` names folders of the backup store,
    `yyyyMMdd` the tables of the main store."""
    return F.date_format(_utc_date(ms), pattern)


def hour_key(ms: Column, day_pattern: str = "yyyy-MM-dd") -> Column:
    """The UTC hour, as the day and `_HH`."""
    hour = F.floor(F.pmod(ms, F.lit(DAY_MS)) / F.lit(NAMED_INTERVALS["HOUR"]))
    return F.concat(day_key(ms, day_pattern), F.lit("_"), F.lpad(hour.cast("string"), 2, "0"))
