"""Repeated passages across documents by a depth-limited radix sort of suffixes.

Two suffixes agree to a depth of `DEPTH` bytes exactly if their windows of that many bytes are equal,
so the sort stops there and its groups of equal suffixes are the repeated windows. A pass over every
suffix, one per byte, would move some thirty times the text. So digits are not bytes in a row but hashes that equal
windows must share, from the most significant on, and a row stands for a run of suffixes:

1. The first digit of a window is its smallest `SEED`-byte gram. Windows in a row share it.
2. The second digit of a window is the `DEPTH - STEP + 1` bytes that it shares with the other windows
   which have the gram at about the same distance (in steps of `STEP`).
3. The last digit is the whole window.

After each pass, runs that are alone in their group are dropped; runs whose bytes altogether equal
those of an earlier run are copies, suffix by suffix, and are done; the rest goes on to the next digit.

A task marks copies among its own runs before each shuffle, so that a passage which a third of all
documents share reaches its group as one row per task. A digit with many different runs in one task
sends only a few of them to its group, since these tell that the digit is shared; the others go on.

Documents are judged in order of id, and within a document by place. A copy is told by 128 bits of
hashes of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import in_bytes, stored

DEPTH = 100
SEED = 32
STEP = 8
#: Different runs of one digit that a task sends; two of them show that it is shared.
SENT_RUNS = 2
#: Bytes whose hashes are in memory at once; a longer text is taken in stretches.
AT_ONCE = 2 << 20
#: Runs among which a task looks for copies.
RUNS_TOGETHER = 1_000_000

# Odd multipliers of the two hash families.
_A = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_B = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xA0761D6478BD642F))
_SHIFT = np.uint64(31)


def _combined(x: np.ndarray, y: np.ndarray, family: int) -> np.ndarray:
    z = x * _A[family]
    z += y
    z ^= z >> _SHIFT
    z *= _B[family]
    z ^= z >> _SHIFT
    return z


def _rolled(data: np.ndarray, family: int, width: int) -> np.ndarray:
    """Hashes of all grams of `width` bytes, a power of two."""
    h = data.astype(np.uint64)
    h += np.uint64(1)
    size = 1
    while size < width:
        h = _combined(h[:-size], h[size:], family)
        size *= 2
    return h


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` keys in a row."""
    size = 1
    least = keys
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[i], begins[i] + 1, ... counts[i] times, end to end."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - ends + counts, counts)


def runs_of(parts: list[bytes]) -> dict[str, np.ndarray]:
    """Windows in a row with the same smallest gram: the part that they are in, where in it the gram
    is, its least and largest distance from the begin of a window, and the digits."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - DEPTH + 1, 0)
    if not windows.any():
        return {}
    grams = _rolled(data, 0, SEED)
    # The low bits make equal grams differ by place, the first being the smallest.
    place = np.uint64((1 << 24) - 1)
    keys = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    starts = _ranges(begins, windows)
    seed = (_smallest(keys, DEPTH - SEED + 1)[starts] & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
    n = np.diff(first, append=len(seed))
    lo, seed = starts[first], seed[first]
    # Three grams of 64 bytes cover the bytes of a run, which are DEPTH + n - 1, up to 168.
    wide = _rolled(data, 1, 64)
    far = n + DEPTH - 1 - 64
    whole = _combined(_combined(wide[lo], wide[lo + far // 2], 0), wide[lo + far], 1)
    whole = _combined(whole, n.astype(np.uint64), 0)
    part = np.searchsorted(begins, lo, side="right") - 1
    return {
        "part": part,
        "seed": seed - begins[part],
        "least": seed - lo - n + 1,
        "most": seed - lo,
        "digit": grams[seed].view(np.int64),
        "whole": whole.view(np.int64),
    }


#: Rows on their way to their group. kind: SENT to its digit's group, SHARED if the task knows already
#: that others have the digit, DONE if copies. seed, least and most are as in `runs_of`.
SENT, SHARED, DONE = 0, 1, 2
ROW = "kind int, digit bigint, whole bigint, id bigint, tag int, seed bigint, least int, most int"
NAMES = [field.split()[0] for field in ROW.split(", ")]


def _sent(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The runs of a task, each with its kind."""
    order = np.lexsort([columns[name] for name in ("seed", "tag", "id", "whole", "digit")])
    own = {name: column[order] for name, column in columns.items()}
    # A document given twice is no copy of itself.
    again = np.concatenate([[False], np.ones(len(order) - 1, dtype=bool)])
    for column in own.values():
        again[1:] &= column[1:] == column[:-1]
    own = {name: column[~again] for name, column in own.items()}
    new_digit = np.concatenate([[True], own["digit"][1:] != own["digit"][:-1]])
    new_whole = new_digit | np.concatenate([[True], own["whole"][1:] != own["whole"][:-1]])
    # Which of a digit's different runs this is, from 1.
    nth = np.cumsum(new_whole)
    nth -= np.maximum.accumulate(np.where(new_digit, nth - 1, 0))
    kind = np.where(new_whole, np.where(nth <= SENT_RUNS, SENT, SHARED), DONE)
    own["kind"] = kind
    done = kind == DONE
    for name in ("digit", "whole"):
        own[name] = np.where(done, 0, own[name])
    return _batch(own)


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    types = [kinds[field.split()[1]] for field in ROW.split(", ")]
    arrays = [pa.array(columns[name], kind) for name, kind in zip(NAMES, types)]
    return pa.RecordBatch.from_arrays(arrays, NAMES)


class _Sender:
    """Collects runs and gives them as batches, copies among them marked."""

    def __init__(self) -> None:
        self._held: list[dict[str, np.ndarray]] = []
        self._rows = 0

    def add(self, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        self._held.append(columns)
        self._rows += len(columns["digit"])
        if self._rows >= RUNS_TOGETHER:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            names = self._held[0]
            whole = {name: np.concatenate([held[name] for held in self._held]) for name in names}
            self._held, self._rows = [], 0
            batch = _sent(whole)
            for begin in range(0, len(batch), 100_000):
                yield batch.slice(begin, 100_000)


def _first_digit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of all windows of texts, from columns id, tag and data."""
    sender = _Sender()

    def found(parts: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            runs = runs_of([data for *_, data in parts])
        if runs:
            part = runs.pop("part")
            ids, tags, bases = (
                np.array([p[k] for p in parts], dtype=np.int64) for k in range(3)
            )
            runs["seed"] += bases[part]
            yield from sender.add(runs | {"id": ids[part], "tag": tags[part]})

    parts, held = [], 0
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("id", "tag", "data"))
        for row, tag, data in zip(*columns):
            for base in range(0, max(1, len(data) - DEPTH + 1), AT_ONCE):
                # Stretches of a long text overlap, so that each window is in one of them.
                parts.append((row, tag, base, data[base : base + AT_ONCE + DEPTH - 1]))
                held += len(parts[-1][3])
                if held >= AT_ONCE:
                    yield from found(parts)
                    parts, held = [], 0
    yield from found(parts)
    yield from sender.rest()


def _next_digit(step: int):
    """Runs of windows with the gram at a distance within one step, from texts and longer runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender()
        names = ("digit", "whole", "id", "tag", "seed", "least", "most")
        rows: list[tuple[int, ...]] = []
        for batch in batches:
            for slice_ in in_bytes(batch, "packed", 1 << 20):
                columns = (slice_.column(n).to_pylist() for n in ("id", "tag", "packed", "runs"))
                for row, tag, packed, runs in zip(*columns):
                    data = zstandard.decompress(packed)
                    for own in runs:
                        seed = own["seed"]
                        for k in range(own["least"] // step, own["most"] // step + 1):
                            least = max(own["least"], k * step)
                            most = min(own["most"], k * step + step - 1)
                            shared = data[seed - k * step : seed - k * step - step + 1 + DEPTH]
                            whole = data[seed - most : seed - least + DEPTH]
                            digit = xxhash.xxh3_64_intdigest(shared, k) >> 1
                            rest = xxhash.xxh3_64_intdigest(whole, 1000 + k) >> 1
                            rows.append((digit, rest, row, tag, seed, least, most))
                if len(rows) >= 100_000:
                    yield from sender.add(_columns(rows, names))
                    rows = []
        if rows:
            yield from sender.add(_columns(rows, names))
        yield from sender.rest()

    return run


def _columns(rows: list[tuple[int, ...]], names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return dict(zip(names, np.array(rows, dtype=np.int64).T))


def _judged(rows: DataFrame) -> DataFrame:
    """The runs that are done, and those whose digit others share: id, tag, seed, least, most, done."""
    alone = F.when(F.col("kind") == SENT, F.col("digit")).otherwise(F.xxhash64("id", "seed", "most"))
    group = Window.partitionBy("kind", "group")
    in_order = group.orderBy("whole", "id", "tag", "seed")
    sent = F.col("kind") == SENT

    def as_before(*names: str) -> Column:
        return reduce(Column.__and__, [F.col(n).eqNullSafe(F.lag(n).over(in_order)) for n in names])

    # A document given twice is no copy of itself, but both are of a third.
    copy = sent & as_before("whole") & ~as_before("id", "tag", "seed")
    different = F.min("whole").over(group) != F.max("whole").over(group)
    return (
        rows.withColumn("group", alone)
        .withColumns({"copy": copy, "different": different})
        .withColumn("done", (F.col("kind") == DONE) | F.col("copy"))
        .filter(F.col("done") | (F.col("kind") == SHARED) | F.col("different"))
        .select("id", "tag", "seed", "least", "most", "done")
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, since they are shuffled."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data = [packer.compress(text) for text in batch.column("data").to_pylist()]
        names = ["id", "tag", "packed"]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tag"), pa.array(data, pa.binary())], names
        )


def _spans(starts: np.ndarray, counts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that lie in a window that starts in one of the ranges given."""
    edges = np.zeros(length + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + counts + DEPTH - 1, -1)
    inside = np.concatenate([[0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(inside))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def _on_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters at their ends."""
    whole = []
    for begin, end in spans:
        while begin < end and data[begin] & 0xC0 == 0x80:
            begin += 1
        while begin < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if begin < end:
            whole.append((begin, end))
    return whole


def _cut(characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_bytes(batch, "packed", 1 << 20):
                found, kept, sizes = [], [], []
                for packed, runs in zip(part["packed"].to_pylist(), part["runs"].to_pylist()):
                    data = zstandard.decompress(packed)
                    spans = []
                    if runs:
                        columns = ([run[name] for run in runs] for name in ("seed", "least", "most"))
                        seed, least, most = (np.array(c, dtype=np.int64) for c in columns)
                        spans = _spans(seed - most, most - least + 1, len(data))
                    if characters:
                        spans = _on_characters(data, spans)
                    sizes.append(len(data))
                    found.append([{"begin": a, "end": b} for a, b in spans])
                    at = [0, *(x for span in spans for x in span), len(data)]
                    kept.append(b"".join(data[a:b] for a, b in zip(at[::2], at[1::2])))
                span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("tag"),
                        pa.array(sizes, pa.int64()),
                        pa.array(found, span_type),
                        pa.array(kept, pa.binary()),
                    ],
                    ["id", "tag", "n_bytes", "spans", "kept"],
                )

    return run


def tag_of(text: Column) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(text).bitwiseAND(0x7FFF).cast("int")


def id_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(-(2**63)))


def cut_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    characters: bool = False,
) -> DataFrame:
    """One row per row of `docs`: id, tag, n_bytes, spans and kept.

    `spans` are the maximal runs of bytes (of the text in UTF-8) that lie in a window of `DEPTH` bytes
    which also starts earlier: in a document with a smaller id, or before in the same one. `kept` has
    the bytes outside of them; with `characters`, a character that is only partly in a span is kept.
    A null text counts as empty; an empty text, or one shorter than a window, keeps all. Ids are integers, a null id counts as the smallest. Rows with the same id and
    text are one document given more than once, and judged alike; rows with the same id and different
    texts are different documents, told apart by `tag` and in its order. An empty table gives no rows.
    Other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(
        id_of(id_column).alias("id"), tag_of(text).alias("tag"), text.cast("binary").alias("data")
    )
    by_gram = stored(_judged(texts.mapInArrow(_first_digit, ROW)), "repeats")
    # Both further passes and the end read the texts by document, from one and the same shuffle.
    packed = texts.mapInArrow(_packed, "id bigint, tag int, packed binary").repartition("id", "tag")

    def by_document(runs: DataFrame) -> DataFrame:
        return runs.groupBy("id", "tag").agg(
            F.collect_list(F.struct("seed", "least", "most")).alias("runs")
        )

    def narrowed(runs: DataFrame, step: int) -> DataFrame:
        own = by_document(runs.filter(~F.col("done")))
        joined = packed.join(own.hint("merge"), ["id", "tag"])
        return _judged(joined.mapInArrow(_next_digit(step), ROW))

    by_step = narrowed(by_gram, STEP)
    by_window = narrowed(by_step, 1)
    done = by_gram.unionByName(by_step).unionByName(by_window).filter("done")
    ended = packed.join(by_document(done).hint("merge"), ["id", "tag"], "left")
    schema = (
        "id bigint, tag int, n_bytes bigint, spans array<struct<begin: bigint, end: bigint>>, "
        "kept binary"
    )
    return ended.mapInArrow(_cut(characters), schema)


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with what `cut_repeats` keeps as texts, and n_chars, if there, as their new lengths. Rows
    without anything left go. Of rows with the same id and text, one's other columns count for all."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    others = docs.select(
        id_of(id_column).alias("__id"),
        tag_of(text).alias("__tag"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("__others"),
    ).dropDuplicates(["__id", "__tag"])
    cut = cut_repeats(docs, id_column, text_column, characters=True).select(
        F.col("id").alias("__id"),
        F.col("tag").alias("__tag"),
        F.decode("kept", "UTF-8").alias("__text"),
    )
    joined = cut.filter(F.length("__text") > 0).join(others.hint("merge"), ["__id", "__tag"])

    def column(name: str) -> Column:
        if name == text_column:
            return F.col("__text").alias(name)
        if name == "n_chars":
            return F.length("__text").cast(docs.schema[name].dataType).alias(name)
        return F.col("__others")[name].alias(name)

    return joined.select(*[column(name) for name in docs.columns])
