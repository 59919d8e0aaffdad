"""Queries over stored messages: SQL on the flattened view, and the sample job."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.functions import times
from telemill.functions import values as V
from telemill.operators import filters
from telemill.sources import stores
from telemill.sources.ledger import Ledger
from telemill.sources.messages import to_wire

VIEW = "deviceValue"


def device_value(messages: DataFrame, port: int = -1, keep: Sequence[str] = ()) -> DataFrame:
    """One row per message for one port. A missing port, value or flag gives 0.0 and false; a value
    that its action could not give is null. `keep` names further columns of the messages."""
    if port >= 0:
        entry = F.get("values", F.lit(port))
        present = V.is_present(entry["value"])
        error = F.get_json_object(entry["extra"], "$.action_error")
        value = F.when(present, V.to_double(entry["value"])).when(error.isNull(), F.lit(0.0))
        valid = F.coalesce(entry["valid"], F.lit(False))
    else:
        value, valid = F.lit(0.0), F.lit(False)
    return messages.select(
        F.col("id").alias("did"),
        F.lit(port).alias("pidx"),
        F.coalesce("dtimestamp", F.lit(0)).alias("dtimestamp"),
        F.coalesce("ptimestamp", F.lit(0)).alias("ptimestamp"),
        "desc",
        value.alias("value"),
        valid.alias("valid"),
        *keep,
    )


def run_sql(messages: DataFrame, query: str, port: int = -1, view: str = VIEW) -> DataFrame:
    """A SQL query in which `view` stands for the flattened messages; errors reach the caller."""
    spark = messages.sparkSession
    name = f"device_value_{uuid.uuid4().hex}"
    # Text literals are matched first and kept, so only the table name itself is replaced.
    pattern = rf"('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|\b{re.escape(view)}\b"
    text = re.sub(pattern, lambda m: m.group(1) or name, query, flags=re.IGNORECASE)
    device_value(messages, port).createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        spark.catalog.dropTempView(name)


def render_rows(df: DataFrame, column: str = "row") -> DataFrame:
    """Rows as text: `[a,b,null]`."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in df.columns]
    return df.select(
        F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")).alias(column)
    )


def sample_messages(
    messages: DataFrame,
    btime: int = -1,
    etime: int = -1,
    interval: int = -1,
    delta: int = filters.DEFAULT_DELTA,
    properties: Mapping[str, Any] | None = None,
    tie_break: Sequence[str] = ("dtimestamp", "id"),
) -> DataFrame:
    """Messages by time range, sampling and properties, sorted by `ptimestamp`, missing ones first."""
    condition: Column = filters.time_filter(F.col("ptimestamp"), btime, etime, interval, delta)
    for key, value in (properties or {}).items():
        condition = condition & filters.property_equals(key, value)
    return messages.filter(condition).orderBy(
        F.col("ptimestamp").asc_nulls_first(), *tie_break
    )


def days_to_read(btime: int, etime: int, now: int, days: str = "range") -> tuple[int | None, int]:
    """First and last UTC day number that a sample request reads; no first day means all before.

    `days="exact"` gives the single day a request selects, which for bounds on different days is
    the day of `now`; `days="range"` gives all days of the range.
    """
    day = times.DAY_MS
    if days == "exact":
        if btime > 0 and etime > 0:
            chosen = btime if btime // day == etime // day else now
        else:
            chosen = btime if btime > 0 else etime if etime > 0 else now
        return chosen // day, chosen // day
    if btime <= 0 and etime <= 0:
        return now // day, now // day
    return (btime // day if btime > 0 else None), (etime // day if etime > 0 else now // day)


def _day_name(number: int, pattern: str) -> str:
    return datetime.fromtimestamp(number * 86400, tz=timezone.utc).strftime(pattern)


def read_days(
    spark: SparkSession,
    main: str | None,
    backup: str | None,
    first: int | None,
    last: int,
    narrow: bool,
    apps: Sequence[str] | None = None,
    ledger: Ledger | None = None,
    **wanted: Any,
) -> DataFrame:
    """Both stores over a range of day numbers; the day conditions prune folders, and with a ledger
    the `device`, `first_ms` and `last_ms` that are `wanted` prune files."""
    def bounds(pattern: str) -> dict[str, str | None]:
        return {
            "first": None if first is None else _day_name(first, pattern),
            "last": _day_name(last, pattern),
        }

    parts = []
    if main is not None:
        parts.append(
            stores.scan_main(
                spark, main, apps=apps, narrow=narrow, ledger=ledger, **bounds("%Y%m%d"), **wanted
            )
        )
    if backup is not None:
        table = stores.scan_backup(spark, backup, ledger=ledger, **bounds("%Y-%m-%d"), **wanted)
        parts.append(table if apps is None else table.filter(F.col("app").isin(*apps)))
    if not parts:
        raise ValueError("name a main store or a backup store")
    return parts[0] if len(parts) == 1 else stores.union_stores(*parts)


def run_job(
    spark: SparkSession,
    request: Mapping[str, Any],
    main: str | None,
    backup: str | None = None,
    now: int | None = None,
    days: str = "range",
    narrow: bool = False,
    apps: Sequence[str] | None = None,
    late_days: int = 1,
    ledger: Ledger | None = None,
) -> DataFrame:
    """A job request: `type: sql` with `query, port, dtime`, or a sample request with `btime, etime,
    interval, delta` and any other keys as properties.

    Messages are filed by the day they are written. A sample request over a range of days also reads
    `late_days` further days for messages of the range that were written after it. With the ledger of
    the stores it opens only files that may have messages of its device (`id`) and time range.
    """
    now = int(time.time() * 1000) if now is None else now
    rest = dict(request)
    if rest.pop("type", None) == "sql":
        day = int(rest.get("dtime", now)) // times.DAY_MS
        messages = read_days(spark, main, backup, day, day, True, apps, ledger)
        return run_sql(messages, rest["query"], int(rest.get("port", -1)))
    btime, etime = int(rest.pop("btime", -1)), int(rest.pop("etime", -1))
    interval = int(rest.pop("interval", -1))
    delta = int(rest.pop("delta", filters.DEFAULT_DELTA))
    first, last = days_to_read(btime, etime, now, days)
    if days == "range":
        last += late_days
    wanted = {
        "device": rest["id"] if isinstance(rest.get("id"), str) else None,
        "first_ms": btime if btime > 0 else None,
        "last_ms": etime if etime > 0 else None,
    } if ledger is not None else {}
    messages = read_days(spark, main, backup, first, last, narrow, apps, ledger, **wanted)
    return sample_messages(messages, btime, etime, interval, delta, rest)


def as_json(messages: DataFrame) -> DataFrame:
    """Result messages as JSON text, in the order they have."""
    return to_wire(messages)
