"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts per language and bucket over all labelled texts in Spark. The model is a
matrix of log probabilities, buckets by languages; its size is fixed by the parameters, not by the
data, and it goes to every task. Scoring adds up, for a batch of texts, the matrix rows of the
n-grams that they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import in_bytes

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
#: More languages than these would make a matrix of more than 64 MB.
MAX_LANGUAGES = 500
#: Characters whose n-grams are in memory at once.
STRETCH = 1 << 19
UNDETERMINED = "und"

# Odd multipliers that spread code points and orders over 64 bits.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def features(texts: list[str], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all n-grams of the texts, with the text that each belongs to, a part at a time.

    A text is taken in lower case, with a space on both sides and other white space as spaces. An
    n-gram lies within one text. Texts are read in stretches of `STRETCH` characters, which bounds
    memory for the longest ones; a stretch begins with the characters before it that its first n-grams
    need, so that a seam changes none.
    """
    stretches, owners, carried, held = [], [], [], 0
    for owner, text in enumerate(texts):
        whole = f" {text.lower()} "
        for begin in range(0, len(whole), STRETCH):
            before = min(begin, max(ORDERS) - 1)
            stretches.append(whole[begin - before : begin + STRETCH])
            owners.append(owner)
            carried.append(before)
            held += len(stretches[-1])
            if held >= STRETCH:
                yield from _of_stretches(stretches, np.array(owners), np.array(carried), buckets)
                stretches, owners, carried, held = [], [], [], 0
    if stretches:
        yield from _of_stretches(stretches, np.array(owners), np.array(carried), buckets)


def _of_stretches(
    stretches: list[str], owners: np.ndarray, carried: np.ndarray, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams that end behind the first `carried` characters of their stretch."""
    points = np.frombuffer("".join(stretches).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    points[(points >= 9) & (points <= 13)] = 32
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    stretch = np.repeat(np.arange(len(sizes)), sizes)
    is_new = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes) >= carried[stretch]
    rolled = points
    with np.errstate(over="ignore"):
        for order in range(1, max(ORDERS) + 1):
            if order > 1:
                rolled = rolled[:-1] * _STEP + points[order - 1 :]
            if order not in ORDERS:
                continue
            hashed = (rolled + np.uint64(order)) * _MIX
            hashed ^= hashed >> np.uint64(29)
            hashed *= _STEP
            last = stretch[order - 1 :]
            inside = (last == stretch[: len(stretch) - order + 1]) & is_new[order - 1 :]
            yield (hashed >> np.uint64(40)).astype(np.int64)[inside] % buckets, owners[last[inside]]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: log P(bucket | language), buckets by languages.
    weights: np.ndarray
    #: log P(language).
    priors: np.ndarray


def train(labelled: DataFrame, text_column: str = "text", label_column: str = "lang") -> Model:
    """A model of all rows with text and label. Each language weighs by its number of texts.

    Counts are exact over all rows: each task sums its own, and Spark sums those of the tasks. What
    reaches the driver has one row per language and bucket that occurs.
    """
    rows = labelled.select(
        F.col(text_column).alias("text"), F.col(label_column).cast("string").alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    texts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(texts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the model would have no size bound")
    languages = sorted(row["lang"] for row in texts)
    numbers = {row["lang"]: row["n"] for row in texts}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {lang: i for i, lang in enumerate(languages)}
        sums = np.zeros(len(languages) * BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in in_bytes(batch, "text"):
                own = np.array([place[x] for x in part.column("lang").to_pylist()], dtype=np.int64)
                for found, owners in features(part.column("text").to_pylist()):
                    sums += np.bincount(own[owners] * BUCKETS + found, minlength=len(sums))
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], ["cell", "n"])

    cells = (
        rows.mapInArrow(count, "cell bigint, n bigint")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.ones(len(languages) * BUCKETS)  # one more of each, so that no n-gram is impossible
    counts[np.asarray(cells.column("cell"))] += np.asarray(cells.column("n"))
    counts = counts.reshape(len(languages), BUCKETS)
    weights = np.log(counts / counts.sum(axis=1, keepdims=True)).T
    shares = np.array([numbers[lang] for lang in languages], dtype=float)
    priors = np.log(shares / max(1.0, shares.sum()))
    return Model(languages, np.ascontiguousarray(weights, dtype=np.float32), priors)


def score(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The place of the likeliest language of each text, and a probability.

    The probability is that of a text of at most 100 n-grams with the same average weights; the
    product over a long text's n-grams would say 1 whatever the text.
    """
    rows, languages = len(texts), len(model.languages)
    sums, n = np.zeros((rows, languages)), np.zeros((rows, 1))
    for found, owners in features(texts):
        weights = model.weights[found]
        for k in range(languages):
            sums[:, k] += np.bincount(owners, weights=weights[:, k], minlength=rows)
        n[:, 0] += np.bincount(owners, minlength=rows)
    best = (sums + model.priors).argmax(axis=1)
    scaled = sums * (np.minimum(n, 100) / np.maximum(n, 1)) + model.priors
    scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return best, scaled[np.arange(rows), best] / scaled.sum(axis=1)


def identify(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, lang_pred and score (0 to 1).

    A null text, or one without a letter, is `und` with score 0, as is any text where the model has
    no language. Of languages that are as likely the first by name is taken. Equal texts give equal
    rows, an empty table none. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.priors))
    id_type = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), _lettered(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            for part in in_bytes(batch, "text"):
                if own.languages:
                    best, scores = score(part.column("text").to_pylist(), own)
                    names = pa.array(own.languages).take(pa.array(best))
                else:
                    names, scores = pa.nulls(len(part), pa.string()), np.zeros(len(part))
                known = pc.and_(part.column("lettered"), pc.is_valid(names))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pc.if_else(known, names, UNDETERMINED),
                        pc.if_else(known, pa.array(scores, pa.float64()), 0.0),
                    ],
                    ["id", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double").withColumnRenamed(
        "id", id_column
    )


def _lettered(text: Column) -> Column:
    return text.rlike(r"\p{L}").alias("lettered")
