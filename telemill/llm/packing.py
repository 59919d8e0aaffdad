"""Best-fit packing of token pieces into sequences by minimum bin slack.

Only lengths matter for packing, and there are at most `capacity` of them: Spark counts the pieces
per length, and the driver plans on these counts, which are bounded however large the input is. A
bin starts with the longest length left; a subset-sum over the available lengths (a bitset of
reachable sums per length) finds the fullest feasible rest. The combination is then removed, as many
times at once as the counts allow, so the plan has a few thousand patterns at any scale. Pieces find
their place by their rank among those of equal length; ranks are made in groups of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from telemill.llm.common import extended, in_bytes, stored

CAPACITY = 2048
#: Pieces of one length that are ranked together; a length with more has more groups.
RANKED_TOGETHER = 500
#: Ends each document.
END = 0
# Fixed value: how the byte-level tokenizer cuts texts before it merges bytes.
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: Texts on whose letters, digits and white space all versions of Unicode agree.
PLAIN = r"^[\x{00}-\x{24F}\x{2010}-\x{2027}\x{20AC}]*$"
#: What the tokenizer's special tokens begin with.
SPECIAL = "<|"


def _encoders(tokenizer_path: str, ranks_path: str | None):
    """Two functions from a list of texts to arrays of ids: by the tokenizer, and, for plain texts
    without special tokens, by the same vocabulary as ranks, which takes a quarter of the time."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)

    def whole(texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            yield np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if ranks_path is None:
        return whole, whole

    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    ranked_ = tiktoken.Encoding(
        "ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}
    )

    def plain(texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            yield ranked_.encode_to_numpy(text, disallowed_special=())

    return whole, plain


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of up to `capacity` tokens: id, piece, start, length, tokens (little-endian uint32).

    A document's tokens are the ids of its text and the end token, so a null or empty text has one.
    Only a document longer than `capacity` is cut; then its first piece may be shorter. Repeated
    rows give repeated pieces, an empty table none. Other columns are not read. `ranks_path` has the
    tokenizer's vocabulary as ranks, if there is such a file.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, plain = _encoders(tokenizer_path, ranks_path)
        for batch in batches:
            for part in in_bytes(batch, "text"):
                texts = part.column("text")
                fast = pc.and_not(
                    pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, SPECIAL)
                )
                for encode, own in ((plain, fast), (whole, pc.invert(fast))):
                    taken = part.filter(own)
                    ids = encode(taken.column("text").to_pylist())
                    yield _pieces(taken.column("id"), ids, capacity)

    schema = f"id {id_type}, piece int, start bigint, length bigint, tokens binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def _pieces(ids: pa.Array, tokens_of: Iterator[np.ndarray], capacity: int) -> pa.RecordBatch:
    at, piece, start, length, tokens = [], [], [], [], []
    for row, own in enumerate(tokens_of):
        own = np.append(own, END).astype("<u4")
        cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            at.append(row)
            piece.append(k)
            start.append(a)
            length.append(b - a)
            tokens.append(own[a:b].tobytes())
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(at, pa.int64())),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(tokens, pa.binary()),
        ],
        ["id", "piece", "start", "length", "tokens"],
    )


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """Available lengths with the largest sum up to `room`, longest first."""
    reachable = [1]  # bit s: sum s can be reached; one more bitset for each copy of a length
    used: list[int] = []
    mask = (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        for _ in range(min(int(counts[length]), room // length)):
            more = reachable[-1] | (reachable[-1] << length) & mask
            if more == reachable[-1]:
                break
            reachable.append(more)
            used.append(length)
        if reachable[-1] >> room & 1:
            break
    total = reachable[-1].bit_length() - 1
    chosen = []
    for k in range(len(used), 0, -1):
        if not reachable[k - 1] >> total & 1:
            chosen.append(used[k - 1])
            total -= used[k - 1]
    return sorted(chosen, reverse=True)


@dataclass(frozen=True)
class Plan:
    """Slots of equal lengths: pieces of `length` with ranks from `rank` on go `each` to a sequence,
    from sequence `first` on, beginning at `offset`."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    first: np.ndarray
    offset: np.ndarray


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Places for `counts[n]` pieces of each length n."""
    left = counts.copy()
    taken = np.zeros_like(left)
    slots: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    longest = capacity
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            break
        left[longest] -= 1
        pattern = [longest, *fullest(left, capacity - longest)]
        left[longest] += 1
        lengths, copies = np.unique(pattern, return_counts=True)
        times = int((left[lengths] // copies).min())
        offset = 0
        for length, each in zip(lengths.tolist(), copies.tolist()):
            slots.append((length, int(taken[length]), each, sequence, offset))
            offset += length * each
        left[lengths] -= copies * times
        taken[lengths] += copies * times
        sequence += times
    columns = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns)


def ranked(pieces: DataFrame, counts: np.ndarray, order: list[str]) -> DataFrame:
    """Adds `rank`, the place of a piece among those of its length, from 0. Columns named group, own,
    n, before and rank are the operator's.

    Pieces of a length are dealt into groups by a hash; a piece's rank is its row number in its group
    after the sizes of the groups before it.
    """
    groups = F.lit(np.maximum(1, -(-counts // RANKED_TOGETHER)).tolist())
    own_groups = F.get(groups, F.col("length").cast("int"))
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64(*order), own_groups))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        grouped.groupBy("length", "group")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    own = F.row_number().over(Window.partitionBy("length", "group").orderBy(*order))
    return (
        grouped.withColumn("own", own)
        .join(sizes, ["length", "group"])
        .withColumn("rank", F.col("before") + F.col("own") - 1)
        .drop("group", "own", "before")
    )


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` from 1 to `capacity`.

    Pieces with equal values in `order` may take each other's places. The pieces are read twice, so
    they should be stored. Columns named length, rank, sequence_id and offset are the operator's.
    """
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in counted:  # at most `capacity` rows
        if not 1 <= row["length"] <= capacity:
            raise ValueError(f"a piece of {row['length']} tokens does not fit {capacity}")
        counts[row["length"]] = row["n"]
    slots = plan(counts, capacity)
    keys = slots.length << 44 | slots.rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank"))
            slot = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            within = rank - slots.rank[slot]
            sequence = slots.first[slot] + within // slots.each[slot]
            offset = slots.offset[slot] + within % slots.each[slot] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    rows = ranked(pieces, counts, order)
    schema = extended(rows.schema, sequence_id=LongType(), offset=LongType())
    return rows.mapInArrow(place, schema).drop("rank")


def packed_documents(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Where each piece of each document goes: id, piece, start, length, ids_crc32, sequence_id and
    offset. Nulls, empty texts and repeated rows as in `token_pieces`."""
    pieces = token_pieces(docs, tokenizer_path, ranks_path, capacity, id_column, text_column)
    digests = pieces.select(
        id_column, "piece", "start", "length", F.crc32("tokens").alias("ids_crc32")
    )
    return pack(stored(digests, "pieces"), [id_column, "piece"], capacity)
