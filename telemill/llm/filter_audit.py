"""What filters remove together: an audit of every order in which they can be applied.

Each part of the corpus keeps, per filter, the sorted list of the rows that fail it, cut into ranges
of row numbers. What a filter removes behind others is its list without the union of theirs. Unions
and differences are made range by range, by merges that gallop: the place of each id of the shorter
list is searched in the longer one, so a short list costs little against a long one. Only sizes leave
a range, and they are summed. A range has at most `RANGE` rows, so a part with a third of all rows is
many ranges, and no list is longer than one.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import in_bytes, stored

#: Row numbers in a range.
RANGE = 1 << 16

#: The filters of `text_failures`, in the order of their letters.
LETTERS = "ABCDE"
MIN_WORDS = 200
# Fixed value: characters that fail filter D.
SYMBOLS = b"#$%&*|"

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _own_failures(text: bytes) -> int:
    """Bits 0 to 3 for filters A to D of one text in UTF-8.

    `split` without an argument cuts bytes at the characters 09 to 0D and 20 alone.
    """
    words = text.split()
    codes = np.frombuffer(text, dtype=np.uint8)
    upper = np.count_nonzero((codes >= 65) & (codes <= 90))
    points = np.count_nonzero((codes & 0xC0) != 0x80)
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | bool(100 * upper > 2 * points) << 2
        | bool(_IS_SYMBOL[codes].any()) << 3
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("row", "id", "part", "fails", "digest")
    for whole in batches:
        for batch in in_bytes(whole, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fails = pa.array([_own_failures(text) for text in texts], pa.int32())
            digests = pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary())
            kept = [batch.column(name) for name in names[:3]]
            yield pa.RecordBatch.from_arrays([*kept, fails, digests], names)


def text_failures(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> DataFrame:
    """One row per row of `docs`: row (a number of its own), part, fails (bit k set if it fails filter
    k of ABCDE), good and toxic.

    A: fewer than 200 words. B: under half of the words distinct. C: over 2 % of the characters in
    A-Z. D: any of `#$%&*|`. E: some row with a smaller id has the same text; the first of them is
    summed up in each task, so a text that a third of all rows have is no hot group. Null texts are
    empty, a null part is the empty part, a row without an id fails E never and has no labels. Of
    several labels of an id, one that is 1 is enough. Other columns are not read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    measured = stored(
        rows.mapInArrow(
            _measured, "row bigint, id bigint, part string, fails int, digest binary"
        ),
        "measured",
    )
    # Stored, so that both sides of the join below are plain shuffles, whose hot texts can be split.
    copied = stored(
        measured.groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .filter("first < last")
        .drop("last"),
        "copied",
    )
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    is_copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    # Each row meets one row of the other side at most; adaptive execution splits a hot text.
    return (
        measured.join(copied.hint("merge"), "digest", "left")
        .join(marked.hint("merge"), "id", "left")
        .select(
            "row",
            "part",
            F.when(is_copy, F.col("fails") + 16).otherwise(F.col("fails")).alias("fails"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def posting_lists(failures: DataFrame, filters: int) -> DataFrame:
    """One row per part and range: part, n (its rows), and sorted lists of row numbers: `lists`, one
    per filter, `good` and `toxic`."""

    def listed(condition: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.col("row"))))

    each = [listed(F.col("fails").bitwiseAND(1 << k) != 0) for k in range(filters)]
    return (
        failures.groupBy("part", F.floor(F.col("row") / F.lit(RANGE)).alias("range"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*each).alias("lists"),
            listed(F.col("good")).alias("good"),
            listed(F.col("toxic")).alias("toxic"),
        )
        .drop("range")
    )


def _found(ids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the sorted `ids` belongs among others, and whether it is there."""
    places = among.searchsorted(ids)
    there = np.zeros(len(ids), dtype=bool)
    inside = places < len(among)
    there[inside] = among[places[inside]] == ids[inside]
    return places, there


def without(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The ids that are not among the others. The shorter list gallops through the longer."""
    if len(ids) <= len(others):
        return ids[~_found(ids, others)[1]]
    places, there = _found(others, ids)
    left = np.ones(len(ids), dtype=bool)
    left[places[there]] = False
    return ids[left]


def union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """All ids of sorted lists, in order. The longest is kept, and the others gallop into it."""
    merged, *rest = sorted(lists, key=len, reverse=True)
    for ids in rest:
        places, there = _found(ids, merged)
        merged = np.insert(merged, places[~there], ids[~there])
    return merged


def _sizes(lists: list[np.ndarray], marks: list[np.ndarray]) -> Iterator[tuple[int, int, list[int]]]:
    """(filters before, filter, sizes): the size of what a filter adds to the union of those before
    it, and of what each mark has of that. Filter -1 stands for the union itself."""
    unions = {0: np.empty(0, dtype=np.int64)}
    for before in range(1 << len(lists)):
        if before:
            last = before.bit_length() - 1
            unions[before] = union([unions[before & ~(1 << last)], lists[last]])
        yield before, -1, [len(unions[before])] + [0] * len(marks)
        for k, own in enumerate(lists):
            if not before >> k & 1:
                added = without(own, unions[before])
                yield before, k, [len(added)] + [len(m) - len(without(m, added)) for m in marks]


def _range_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            lists = [np.asarray(x.values, dtype=np.int64) for x in row.column("lists")[0]]
            marks = [np.asarray(row.column(m)[0].values, dtype=np.int64) for m in ("good", "toxic")]
            found = [(b, k, *sizes) for b, k, sizes in _sizes(lists, marks)]
            before, k, n, good, toxic = map(list, zip(*found))
            part = [row.column("part")[0].as_py()] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array(before, pa.int32()), pa.array(k, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (n, good, toxic))],
                ["part", "before", "k", "n", "good", "toxic"],
            )


def audit(failures: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from rows like those of `text_failures`.

    Columns: part, filter_order, step (from 1), kept (rows after the step), removed (by it),
    redundant (rows that fail its filter and went before), unique_fails (rows that fail it alone),
    good_lost and toxic_lost (of the removed), shapley (what its filter removes, summed over all
    orders). `letters` names the filters by their bits in `fails`; with k filters there are k! orders.
    Rows that fail nothing count in `kept`; an empty table gives no rows.
    """
    filters = len(letters)
    lists = stored(posting_lists(failures, filters), "postings")
    sized = lists.select("part", "lists", "good", "toxic").mapInArrow(
        _range_sizes, "part string, before int, k int, n bigint, good bigint, toxic bigint"
    )
    totals = sized.groupBy("part", "before", "k").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    )
    # A part has a row for each set of filters and filter, so its map is small whatever its size.
    key, size = F.struct("before", "k"), F.struct("n", "good", "toxic")
    maps = totals.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(key, size))).alias("m"))
    parts = lists.groupBy("part").agg(F.sum("n").alias("n")).join(maps, "part")

    def at(before: Column | int, k: Column | int) -> Column:
        pair = [(x if isinstance(x, Column) else F.lit(x)).cast("int") for x in (before, k)]
        return F.try_element_at(F.col("m"), F.struct(pair[0].alias("before"), pair[1].alias("k")))

    everything = (1 << filters) - 1

    def shapley(k: int) -> Column:
        sets = [s for s in range(1 << filters) if not s >> k & 1]
        orders = [math.factorial(s.bit_count()) * math.factorial(filters - 1 - s.bit_count()) for s in sets]
        return sum((at(s, k)["n"] * n for s, n in zip(sets, orders)), F.lit(0).cast("bigint"))

    steps = [
        [order, step + 1, order[step], sum(1 << letters.index(x) for x in order[:step])]
        for order in map("".join, itertools.permutations(letters))
        for step in range(filters)
    ]
    columns = [F.array(*[F.lit(step[i]) for step in steps]) for i in range(4)]
    each = parts.select(
        "*",
        F.array(*[shapley(k) for k in range(filters)]).alias("values"),
        F.inline(F.arrays_zip(*[c.alias(n) for c, n in zip(columns, ("filter_order", "step", "letter", "before"))])),
    )
    k = F.instr(F.lit(letters), F.col("letter")) - 1
    bit = F.get(F.array(*[F.lit(1 << i) for i in range(filters)]), k)
    removed = at(F.col("before"), k)
    return each.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - at(F.col("before") + bit, -1)["n"]).alias("kept"),
        removed["n"].alias("removed"),
        (at(0, k)["n"] - removed["n"]).alias("redundant"),
        at(F.lit(everything) - bit, k)["n"].alias("unique_fails"),
        removed["good"].alias("good_lost"),
        removed["toxic"].alias("toxic_lost"),
        F.get("values", k).alias("shapley"),
    )
