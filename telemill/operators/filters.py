"""Filters of the sample job."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemill.schemas import KEY_TYPES

# Fixed value: tolerance of interval sampling in milliseconds.
DEFAULT_DELTA = 1000


def in_time_range(pts: Column, btime: int = -1, etime: int = -1) -> Column:
    """Both bounds belong to the range; a bound of 0 or less is off."""
    condition = F.lit(True)
    if btime > 0:
        condition = condition & (pts >= btime)
    if etime > 0:
        condition = condition & (pts <= etime)
    return condition


def sampled(pts: Column, interval: int = -1, delta: int = DEFAULT_DELTA) -> Column:
    """At most `delta` after a multiple of `interval`; an interval of 0 or less is off."""
    return pts % interval <= delta if interval > 0 else F.lit(True)


def time_filter(
    pts: Column, btime: int = -1, etime: int = -1, interval: int = -1, delta: int = DEFAULT_DELTA
) -> Column:
    """Range and sampling; a message without a time (or with -1) passes only if all are off."""
    if btime <= 0 and etime <= 0 and interval <= 0:
        return F.lit(True)
    conditions = in_time_range(pts, btime, etime) & sampled(pts, interval, delta)
    return pts.isNotNull() & (pts != -1) & conditions


def _typed_equal(variant: Column, value: Any) -> Column:
    """Same JSON type and same value."""
    kind = F.schema_of_variant(variant)
    if isinstance(value, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(variant, "$", "boolean") == value)
    if isinstance(value, int):
        return (kind == "BIGINT") & (F.try_variant_get(variant, "$", "bigint") == value)
    if isinstance(value, float):
        number = (kind == "DOUBLE") | kind.startswith("DECIMAL")
        return number & (F.try_variant_get(variant, "$", "double") == value)
    if isinstance(value, str):
        return (kind == "STRING") & (F.try_variant_get(variant, "$", "string") == value)
    raise TypeError(f"no property filter for a value of type {type(value).__name__}")


def property_equals(key: str, value: Any) -> Column:
    """The message has `key` at its top level and it equals `value`, type included.

    Keys with a column compare that column, so that the filter reaches the scan; the others are
    looked up in `extra`.
    """
    kind = KEY_TYPES.get(key)
    if kind == "string":
        return F.col(key) == value if isinstance(value, str) else F.lit(False)
    if kind is not None:
        whole = isinstance(value, int) and not isinstance(value, bool)
        return F.col(key) == value if whole else F.lit(False)
    if key == "values":
        raise TypeError("no property filter on the port list")
    others = F.try_variant_get(F.try_parse_json("extra"), "$", "map<string,variant>")
    found = F.try_element_at(others, F.lit(key))
    return F.coalesce(_typed_equal(found, value), F.lit(False))
