"""Left joins with a lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    left: DataFrame, table: DataFrame, on: Sequence[str], small: bool, how: str = "left"
) -> DataFrame:
    """`left` joined with at most one row of `table` per key; `how="inner"` drops what has none.

    `small` says that the size of `table` was measured and is fit for a broadcast. Otherwise both
    sides are shuffled, and adaptive execution splits the rows of a hot key, which all meet one row.
    """
    return left.join(F.broadcast(table) if small else table.hint("merge"), list(on), how)
