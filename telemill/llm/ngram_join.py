"""N-gram Jaccard self-join of documents by MinHash banding.

A document's set holds the hashes of its runs of five words. Documents with equal sets are one class,
which only its representative stands for. Band and row counts follow from the recall wanted at the
threshold. Classes are shuffled by band hash; those that meet in a bucket are tied to its smallest
class, not to each other, and the connected parts of these ties hold all candidate pairs.

A part is cut into blocks of bounded size. Two blocks are compared if a bucket reaches into both: the
texts of the two blocks come together in one task, which verifies all pairs between them on the full
sets and gives one row per class: how many links it has there and the smallest class that it is
connected with. So the classes of a large group of near copies are compared by blocks, no pair of them
is ever a row, and no link among them is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import in_bytes, stored
from telemill.llm.components import components
from telemill.llm.multi_index import Groups

WORDS = 5
THRESHOLD = 0.8
#: Share of the pairs right at the threshold that meet in a band; more similar ones meet more surely.
RECALL = 0.9999
#: Hashes per signature at most.
SIGNATURE = 128
#: N-grams of the classes of a block.
BLOCK = 60_000
#: Sets with an n-gram up to which it is counted pair by pair: a share of the sets, within bounds.
LIGHT_SHARE, LIGHT_FROM, LIGHT_TO = 128, 8, 64
#: Sets by sets of a matrix of common n-grams.
STRIP, WIDTH = 256, 4096

# Odd multipliers that mix 64-bit hashes.
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(31)


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """The most rows per band, so the fewest false candidates, with which a signature of at most
    `SIGNATURE` hashes has enough bands for the recall."""
    best = None
    for rows in range(1, SIGNATURE + 1):
        miss = 1 - threshold**rows
        if miss == 1:
            break
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
        if bands * rows <= SIGNATURE:
            best = bands, rows
    if best is None:
        raise ValueError("no signature of this size has the recall")
    return best


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> _SHIFT
    h *= _B
    h ^= h >> _SHIFT
    return h


def ngram_sets(texts: pa.StringArray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of `WORDS` words, words being what stands between
    white space. A text with fewer words has one run, one without words none."""
    split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
    counts = np.asarray(pc.list_value_length(split), dtype=np.int64)
    coded = split.flatten().dictionary_encode()
    distinct = [xxhash.xxh3_64_intdigest(word) for word in coded.dictionary.to_pylist()]
    words = np.array(distinct, dtype=np.uint64)[np.asarray(coded.indices)]
    blank = np.asarray(pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(texts)), 0))
    sets, begin = [], 0
    with np.errstate(over="ignore"):
        for n, empty in zip(counts.tolist(), blank.tolist()):
            own = words[begin : begin + n]
            begin += n
            if empty:
                sets.append(np.empty(0, dtype=np.uint64))
                continue
            width = min(WORDS, n)
            h = own[: n - width + 1].copy()
            for k in range(1, width):
                h *= _A
                h += own[k : n - width + 1 + k]
                h = _mixed(h)
            sets.append(np.unique(h))
    return sets


def _bands(own: np.ndarray, bands: int, rows: int) -> list[int]:
    """One hash per band of a set."""
    salts = _mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * _A)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(own), 4096):
        hashed = (own[begin : begin + 4096, None] ^ salts) * _A
        np.minimum(least, (hashed ^ (hashed >> _SHIFT)).min(axis=0), out=least)
    least = least.reshape(bands, rows)
    h = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        h = _mixed(h * _A + least[:, k])
    return h.view(np.int64).tolist()


def signatures(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """id, tag, n (size of the set), set_a and set_b (its 128-bit hash) and bands, from id, tag and
    text."""
    bands, rows = bands_and_rows(threshold, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_bytes(batch, "text", 4 << 20):
                sets = ngram_sets(part.column("text"))
                hashes = [xxhash.xxh3_128_intdigest(own.tobytes()) for own in sets]
                with np.errstate(over="ignore"):
                    banded = [_bands(own, bands, rows) if len(own) else [] for own in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("tag"),
                        pa.array([len(own) for own in sets], pa.int64()),
                        pa.array([h >> 65 for h in hashes], pa.int64()),
                        pa.array([h & (1 << 63) - 1 for h in hashes], pa.int64()),
                        pa.array(banded, pa.list_(pa.int64())),
                    ],
                    ["id", "tag", "n", "set_a", "set_b", "bands"],
                )

    schema = "id bigint, tag bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>"
    return docs.mapInArrow(run, schema)


def _light_pairs(columns: np.ndarray, owners: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets as `one * count + two`, ascending, and how many n-grams they have in common, from
    the owners of n-grams with few of them, in order of `columns`."""
    if not len(columns):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    begins = np.flatnonzero(np.r_[True, np.diff(columns) != 0])
    lengths = np.diff(np.r_[begins, len(columns)])
    pairs = []
    for length in np.unique(lengths).tolist():
        # All n-grams with this many owners at once.
        places = begins[lengths == length][:, None] + np.arange(length)
        of_gram = np.sort(owners[places], axis=1)
        one, two = np.triu_indices(length, 1)
        pairs.append((of_gram[:, one] * count + of_gram[:, two]).ravel())
    return np.unique(np.concatenate(pairs), return_counts=True)


def linked_pairs(
    sets: list[np.ndarray], split: int | None, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of sets that are alike, the lower one first, strip by strip: all pairs of a
    block (`split` is None) or those between the first `split` sets and the rest.

    N-grams of few sets are counted pair by pair, those of many as a matrix of `STRIP` sets by some
    more, so that memory follows the n-grams of the block and not the square of its sets.
    """
    count = len(sets)
    sizes = np.array([len(own) for own in sets], dtype=np.int64)
    owners = np.repeat(np.arange(count), sizes)
    _, columns, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(columns, kind="stable")
    columns, owners = columns[order], owners[order]
    # An n-gram that only one set has is common to no pair.
    of_column = times[columns]
    few = min(LIGHT_TO, max(LIGHT_FROM, count // LIGHT_SHARE))
    light = (of_column > 1) & (of_column <= few)
    keys, counts = _light_pairs(columns[light], owners[light], count)

    def alike(one: np.ndarray, two: np.ndarray, common: np.ndarray) -> np.ndarray:
        either = sizes[one] + sizes[two] - common
        found = common >= threshold * either - 1e-6 * either
        if split is not None:
            found &= (one < split) & (two >= split)
        return found

    many = of_column > few
    if not many.any():
        one, two = keys // count, keys % count
        found = alike(one, two, counts)
        yield one[found], two[found]
        return
    number = np.unique(columns[many], return_inverse=True)[1]
    held = np.zeros((count, int(number.max()) + 1), dtype=bool)
    held[owners[many], number] = True
    for a in range(0, count if split is None else split, STRIP):
        rows = np.arange(a, min(a + STRIP, count if split is None else split))
        strip = held[rows].astype(np.float32)
        for b in range(a if split is None else split, count, WIDTH):
            others = np.arange(b, min(b + WIDTH, count))
            common = strip @ held[others].astype(np.float32).T
            begin, end = np.searchsorted(keys, [rows[0] * count, (rows[-1] + 1) * count])
            one, two = keys[begin:end] // count, keys[begin:end] % count
            here = (two >= others[0]) & (two <= others[-1])
            common[one[here] - rows[0], two[here] - others[0]] += counts[begin:end][here]
            # A pair is alike only if it shares this part of the larger set.
            least = threshold * np.maximum(sizes[rows][:, None], sizes[others]) * (1 - 1e-5)
            i, j = np.nonzero((common >= least) & (rows[:, None] < others))
            found = alike(rows[i], others[j], common[i, j].astype(np.int64))
            yield rows[i][found], others[j][found]


def _verify(threshold: float):
    """Of rows sorted by part, pair of blocks, block and class: one row per class with links, its
    smallest connected class there and the number of its links there."""

    def of_pair(rows: list[tuple[int, int, bytes]], pair: tuple) -> pa.RecordBatch:
        classes = np.array([row[1] for row in rows], dtype=np.int64)
        texts = pa.array([zstandard.decompress(row[2]).decode() for row in rows], pa.string())
        split = sum(row[0] == pair[1] for row in rows) if pair[1] != pair[2] else None
        groups, links = Groups(len(rows)), np.zeros(len(rows), dtype=np.int64)
        for one, two in linked_pairs(ngram_sets(texts), split, threshold):
            links += np.bincount(one, minlength=len(rows)) + np.bincount(two, minlength=len(rows))
            groups.join(one, two)
        roots = groups.roots()
        least = np.full(len(rows), np.iinfo(np.int64).max)
        np.minimum.at(least, roots, classes)
        linked = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(classes[linked]), pa.array(least[roots[linked]]), pa.array(links[linked])],
            ["class", "hub", "links"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        current = None
        for batch in batches:
            names = ("part", "i", "j", "block", "class", "packed")
            for part, i, j, block, own, packed in zip(
                *(batch.column(name).to_pylist() for name in names)
            ):
                if (part, i, j) != current:
                    if len(rows) > 1:
                        yield of_pair(rows, current)
                    rows, current = [], (part, i, j)
                # A row given twice has its class here twice.
                if not rows or (block, own) != rows[-1][:2]:
                    rows.append((block, own, packed))
        if len(rows) > 1:
            yield of_pair(rows, current)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data = [packer.compress(text.encode()) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tag"), pa.array(data, pa.binary())],
            ["id", "tag", "packed"],
        )


def _blocks(classes: DataFrame, parts: DataFrame, block: int) -> DataFrame:
    """class, id, tag, part, blocks (of the part) and block: blocks of about `block` n-grams."""
    sized = parts.join(classes.select("class", "id", "tag", "n"), "class")
    weights = sized.groupBy("part").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    number = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    return sized.join(weights, "part").select(
        "class", "id", "tag", "part", "blocks", number.alias("block")
    )


def links_of(
    docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """class, group (the smallest class that it is connected with) and n_links, for classes with links.

    `classes` has class (a number), n, bands, and id and tag of a row of `docs` with its text.
    """
    banded = classes.select("class", F.explode("bands").alias("band"))
    buckets = (
        banded.groupBy("band")
        .agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("met"))
        .filter("met > 1")
        .select("band", "hub")
    )
    met = stored(banded.join(buckets, "band"), "met")
    ties = met.filter("class <> hub").select(F.col("class").alias("u"), F.col("hub").alias("v"))
    parts = components(ties.distinct()).withColumnsRenamed({"node": "class", "component": "part"})
    placed = stored(_blocks(classes, parts, block), "blocks")

    # Pairs of blocks that a bucket reaches into, of parts with more than one.
    reached = (
        met.join(placed.filter("blocks > 1"), "class").select("band", "part", "block").distinct()
    )
    pairs = (
        reached.withColumnRenamed("block", "i")
        .join(reached.withColumnRenamed("block", "j"), ["band", "part"])
        .filter("i <= j")
        .select("part", "i", "j")
        .distinct()
    )
    several = pairs.select(
        "part", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block")
    )
    texts = docs.mapInArrow(_packed, "id bigint, tag bigint, packed binary")
    members = placed.join(texts.hint("merge"), ["id", "tag"])
    single = members.filter("blocks = 1").select(
        "part", F.lit(0).alias("i"), F.lit(0).alias("j"), "block", "class", "packed"
    )
    paired = (
        members.filter("blocks > 1")
        .join(several, ["part", "block"])
        .select("part", "i", "j", "block", "class", "packed")
    )
    found = (
        single.unionByName(paired)
        .repartition("part", "i", "j")
        .sortWithinPartitions("part", "i", "j", "block", "class")
        .mapInArrow(_verify(threshold), "class bigint, hub bigint, links bigint")
    )
    found = stored(found, "links")
    groups = components(
        found.filter("class <> hub").select(F.col("class").alias("u"), F.col("hub").alias("v"))
    )
    return (
        found.groupBy("class")
        .agg(F.sum("links").alias("n_links"))
        .join(groups.withColumnsRenamed({"node": "class", "component": "group"}), "class")
    )


def ngram_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, class_id, copy_id, n_copies and n_links.

    Two documents are linked if the Jaccard similarity of their sets is `threshold` or more. class_id
    is the smallest id of the documents that links connect with this one, copy_id the smallest id with
    the same set, n_copies the number of rows with that set, and n_links the number of different other
    sets that are linked with it.

    A null, empty or blank text has no set and no links: its class_id and copy_id are its id, n_copies
    is 1. Ids are integers, a null id counts as the smallest. Repeated rows are copies of each other;
    rows with one id and different texts are different documents. An empty table gives no rows. Other
    columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(2**63))).alias("id"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
    )
    signed = stored(signatures(texts, threshold, recall), "signatures")
    sets = (
        signed.filter("n > 0")
        .groupBy("set_a", "set_b", "n")
        .agg(
            F.min(F.struct("id", "tag")).alias("first"),
            F.count(F.lit(1)).alias("n_copies"),
            F.first("bands").alias("bands"),
        )
        .select("set_a", "set_b", "n", "first.id", "first.tag", "n_copies", "bands")
    )
    # A class has the number of its smallest id; where an id has several texts, the further classes
    # have numbers made of their sets.
    nth = F.row_number().over(Window.partitionBy("id").orderBy("set_a", "set_b"))
    made = F.lit(1 << 62) + F.shiftright("set_a", 2)
    sets = stored(
        sets.withColumn("nth", nth)
        .withColumn("class", F.when(F.col("nth") == 1, F.col("id")).otherwise(made))
        .drop("nth"),
        "classes",
    )
    links = stored(links_of(texts, sets.drop("set_a", "set_b", "n_copies"), threshold), "groups")
    smallest = (
        links.join(sets.select("class", "id"), "class").groupBy("group").agg(F.min("id").alias("least"))
    )
    judged = sets.join(links.join(smallest, "group"), "class", "left").select(
        "set_a",
        "set_b",
        F.col("id").alias("copy_id"),
        "n_copies",
        F.coalesce("least", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    own = signed.select("id", "n", "set_a", "set_b")
    return (
        own.filter("n > 0")
        .join(judged.hint("merge"), ["set_a", "set_b"])
        .select("id", "class_id", "copy_id", "n_copies", "n_links")
        .unionByName(
            own.filter("n = 0").select(
                "id",
                F.col("id").alias("class_id"),
                F.col("id").alias("copy_id"),
                F.lit(1).cast("bigint").alias("n_copies"),
                F.lit(0).cast("bigint").alias("n_links"),
            )
        )
        .withColumnRenamed("id", id_column)
    )


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each group of linked documents that
    with the smallest id, and all documents without links. Null ids are one document's. Rows that
    repeat a row which stays, or its id, stay with it: drop exact copies first. An empty table stays
    empty. A column named `__id` is the operator's."""
    kept = ngram_join(docs, id_column=id_column, text_column=text_column)
    kept = kept.filter(F.col(id_column) == F.col("class_id")).select(F.col("class_id").alias("__id"))
    own = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(2**63)))
    return (
        docs.withColumn("__id", own)
        .join(kept.distinct().hint("merge"), "__id", "left_semi")
        .drop("__id")
    )
