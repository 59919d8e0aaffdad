"""The Merkle manifest against a tree built in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from telemill.llm import merkle as M

DOCS = ("doc_id bigint, source string, lang string, n_chars bigint, text string, "
        "tree string, node string, row string, at string, n string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in doc))


def build(nodes):
    """The root, and the siblings of each node as (text, is left)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    proofs = []
    for place in range(len(nodes)):
        steps = []
        for level in levels[:-1]:
            other = place ^ 1
            steps.append((level[other] if other < len(level) else "", place % 2 == 1))
            place //= 2
        proofs.append(steps)
    return levels[-1][0], proofs


def by_force(docs):
    groups = {}
    for doc in docs:
        groups.setdefault(doc[2], []).append(doc)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda d: (d[0] is not None, d[0] or 0, leaf(d))
    trees = []
    for name in names:
        rows = sorted(groups[name], key=order)
        trees.append((rows, *build([leaf(d) for d in rows])))
    root, tops = build([tree[1] for tree in trees])
    found = []
    for (rows, subroot, proofs), top in zip(trees, tops):
        for doc, proof in zip(rows, proofs):
            altered = list(doc)
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 7 == 0 and doc[3] is not None:
                altered[3] += 1
            node = leaf(altered)
            for text, is_left in proof + top:
                node = sha(text + node if is_left else node + text)
            digest = sha("".join(text for text, _ in proof + top))
            found.append((doc[0], leaf(doc), subroot, root, digest, node, node == root))
    return sorted(found, key=str)


def found(spark, docs):
    frame = spark.createDataFrame([(*d, "a", "b", "c", "d", "e") for d in docs], DOCS)
    rows = M.manifest(frame, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return sorted((tuple(row) for row in rows.collect()), key=str)


def docs_of(rng, n, langs):
    texts = [None, "", "é", "text", "x" * 50_000, "a:b-"]
    return [(i, rng.choice(["s", None, ""]), rng.choice(langs), rng.choice([None, 0, 5, 2**63 - 1]),
             rng.choice(texts)) for i in rng.sample(range(10 * n + 1), n)]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 300])
def test_trees(spark, n):
    docs = docs_of(random.Random(n), n, ["en", "de", None, "", "zz", "é"])
    assert found(spark, docs) == by_force(docs)


@pytest.mark.parametrize("stride", [1, 3])
def test_several_checkpoints(spark, monkeypatch, stride):
    """With few levels between checkpoints, small trees meet many of them and uneven ends."""
    monkeypatch.setattr(M, "STRIDE", stride)
    docs = docs_of(random.Random(9), 150, ["hot"] * 12 + ["a", "b", "c", "d", "e", None])
    assert found(spark, docs) == by_force(docs)


def test_two_checkpoints_of_the_usual_stride(spark):
    docs = docs_of(random.Random(4), 1500, ["en"] * 5 + ["de"])
    assert found(spark, docs) == by_force(docs)


def test_repeated_rows_and_null_ids(spark):
    docs = [(1, "s", "en", 3, "t")] * 5 + [(None, None, None, None, None)] * 3 + [(7, "s", "en", 1, "u")]
    assert found(spark, docs) == by_force(docs)


def test_no_rows(spark):
    assert found(spark, []) == []


def test_tampering_shows(spark):
    docs = [(i, "s", "en", i, "t") for i in range(200)]
    rows = found(spark, docs)
    assert {row[0] for row in rows if not row[-1]} == {
        i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0
    }
