"""The n-gram join against all pairs of documents."""

import random
import tracemalloc

import numpy as np
import pyarrow.parquet as pq
import pytest

from telemill.llm import ngram_join
from telemill.llm.components import components
from telemill.llm.queries import QUERIES
from tests.oracle import DATA


def set_of(text):
    words = (text or "").split()
    width = min(5, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else None


def by_force(docs, threshold=0.8):
    """id -> (class_id, copy_id, n_copies, n_links)"""
    owners = {}
    for doc_id, text in docs:
        owners.setdefault(set_of(text), []).append(doc_id)
    blank = owners.pop(None, [])
    classes = sorted((min(ids), own, ids) for own, ids in owners.items())
    group = {c[0]: c[0] for c in classes}
    links = dict.fromkeys(group, 0)

    def root(c):
        while group[c] != c:
            c = group[c]
        return c

    holders = {}
    for c, own, _ in classes:
        for gram in own:
            holders.setdefault(gram, []).append(c)
    sets = {c: own for c, own, _ in classes}
    pairs = {(a, b) for cs in holders.values() for i, a in enumerate(cs) for b in cs[i + 1 :]}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    found = {i: (i, i, 1, 0) for i in blank}
    for c, _, ids in classes:
        found |= {i: (root(c), c, len(ids), links[c]) for i in ids}
    return found


def rows_of(frame):
    return {row["doc_id"]: (row["class_id"], row["copy_id"], row["n_copies"], row["n_links"])
            for row in frame.collect()}


def test_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{DATA}/documents.parquet").to_pylist()]
    found = rows_of(QUERIES["op3_ngram_join"](spark, DATA))
    assert found == by_force(docs)
    assert any(row[3] for row in found.values())


def variants(base, n, step):
    """Texts that differ from the base in one place each, or in a stretch that moves on."""
    words = base.split()
    for k in range(n):
        own = list(words)
        own[(k * step) % len(own)] = f"new{k}"
        yield " ".join(own)


BASE = " ".join(f"word{k * k % 211}x{k % 13}" for k in range(120))


def test_large_group_in_blocks(spark, monkeypatch):
    texts = [*variants(BASE, 90, 7), *variants(BASE[200:], 30, 5), BASE, BASE, "word1 word2 word3"]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, "clash", 0) for i, t in docs],
                                  "doc_id bigint, text string, class string, part int")
    links_of = ngram_join.links_of
    monkeypatch.setattr(ngram_join, "links_of", lambda *args: links_of(*args, block=1500))
    assert rows_of(ngram_join.ngram_join(frame.repartition(4))) == by_force(docs)


@pytest.mark.parametrize("seed", range(12))
def test_linked_pairs(seed, monkeypatch):
    """Light and heavy n-grams, in strips, within a block and between two."""
    monkeypatch.setattr(ngram_join, "STRIP", 7)
    monkeypatch.setattr(ngram_join, "WIDTH", 11)
    monkeypatch.setattr(ngram_join, "LIGHT_FROM", [1, 3, 8][seed % 3])
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(rng.integers(2, 60)):
        base = np.arange(rng.integers(1, 4) * 1000, 0, -1)[: rng.integers(1, 40)]
        own = np.where(rng.random(len(base)) < 0.05, rng.integers(0, 10**6, len(base)), base)
        sets.append(np.unique(own.astype(np.uint64)))
    as_sets = [set(own.tolist()) for own in sets]
    for split in (None, len(sets) // 2):
        expected = {
            (a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
            if (split is None or a < split <= b)
            and len(as_sets[a] & as_sets[b]) >= 0.8 * len(as_sets[a] | as_sets[b])
        }
        found = [p for one, two in ngram_join.linked_pairs(sets, split, 0.8) for p in zip(one.tolist(), two.tolist())]
        assert len(found) == len(set(found)) and set(found) == expected


def test_many_short_texts_with_one_beginning():
    """30,000 texts of six words in one block, all with their first five words in common."""
    sets = [np.array(sorted([1, 10 + k]), dtype=np.uint64) for k in range(30_000)]
    tracemalloc.start()
    assert sum(len(one) for one, _ in ngram_join.linked_pairs(sets, None, 0.8)) == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6


def test_recall_on_planted_pairs(spark):
    """Pairs at or a little above the threshold."""
    rng = random.Random(1)
    docs = []
    for k in range(0, 600, 2):
        words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        docs += [(k, " ".join(words)), (k + 1, " ".join(words[:-1] + ["z"] + [f"y{i}" for i in range(rng.randint(6, 10))]))]
    found = rows_of(ngram_join.ngram_join(spark.createDataFrame(docs, "doc_id bigint, text string")))
    expected = by_force(docs)
    linked = [i for i, row in expected.items() if row[3]]
    assert len(linked) > 300
    assert sum(found[i] == expected[i] for i in linked) >= 0.995 * len(linked)


def test_odd_texts(spark):
    texts = [None, "", " \n ", "one", "one", "one two", "a b c d e", "a  b\tc\nd e", "a b c d e f",
             "x " * 20_000, "x x x x x", "é ü ñ ß ø å", BASE, BASE + " tail", BASE.replace(" ", "  ")]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows_of(ngram_join.ngram_join(frame)) == by_force(docs)
    assert ngram_join.ngram_join(frame.limit(0)).count() == 0


def test_repeated_rows(spark):
    rows = [(1, BASE), (1, BASE), (1, "other text of five words"), (None, BASE + " tail"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(tuple(row) for row in ngram_join.ngram_join(frame).collect())
    least = -(2**63)
    assert found == sorted([
        (1, least, 1, 2, 1), (1, least, 1, 2, 1), (1, 1, 1, 1, 0),
        (least, least, least, 1, 1), (least, least, least, 1, 0)])


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= ngram_join.SIGNATURE
    with pytest.raises(ValueError):
        ngram_join.bands_and_rows(0.01, 0.9999)


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 3), (200, 200)]
    edges = spark.createDataFrame(chain, "u bigint, v bigint")
    found = {row["node"]: row["component"] for row in components(edges).collect()}
    assert found == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200}
    assert components(edges.limit(0)).count() == 0
