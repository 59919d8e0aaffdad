"""The filter audit against brute force over every order, and its merges against sets."""

import itertools
import random

import numpy as np
import pytest

from telemill.llm import filter_audit as A
from tests.llm.test_documents import WORD

DOCS = "doc_id bigint, source string, text string, part string, row string, fails int"
LABELS = "doc_id bigint, quality int, toxic int"


def failing(text, earlier):
    words = WORD.findall(text)
    upper = sum("A" <= c <= "Z" for c in text)
    return {
        letter
        for letter, fails in zip(
            "ABCDE",
            (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * len(text),
             any(c in "#$%&*|" for c in text), earlier),
        )
        if fails
    }


def by_force(docs, labels):
    texts = [(i, source or "", text or "") for i, source, text, *_ in docs]
    ids = {}
    for i, _, text in texts:
        if i is not None:
            ids.setdefault(text, []).append(i)
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, toxic in labels if toxic == 1 and i is not None}
    rows = [
        (part, failing(text, i is not None and i > min(ids[text])), i in good, i in toxic)
        for i, part, text in texts
    ]
    found = {}
    for part in {row[0] for row in rows}:
        own = [row for row in rows if row[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(own)
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if letter in row[1]]
                left = [row for row in left if letter not in row[1]]
                fails = [row for row in own if letter in row[1]]
                shapley[letter] += len(gone)
                found[part, order, step] = [
                    len(left), len(gone), len(fails) - len(gone),
                    sum(row[1] == {letter} for row in own),
                    sum(row[2] for row in gone), sum(row[3] for row in gone),
                ]
        for (of, order, step), numbers in found.items():
            if of == part:
                numbers.append(shapley[order[step - 1]])
    return {key: tuple(numbers) for key, numbers in found.items()}


def audited(spark, docs, labels):
    # Columns named like the operator's own must not matter.
    docs = spark.createDataFrame([(*d, "x", "y", 7) for d in docs], DOCS)
    rows = A.audit(A.text_failures(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert len({row[:3] for row in rows}) == len(rows)
    return {tuple(row[:3]): tuple(row[3:]) for row in rows}


def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    long = " ".join(words[:250])
    odd = [None, "", " ", "\x1c\xa0", "#", "é" * 300, "ABC", long, long.upper(), long + " $",
           "x " * 60_000, "a\x0bb\x0cc\rd " * 60, " ".join(words[:100] * 2), " ".join(words[:99] * 2 + ["z"] * 2)]
    for _ in range(60):
        body = [rng.choice(words[: rng.choice([20, 400])]) for _ in range(rng.choice([5, 199, 200, 300]))]
        odd.append(" ".join(body) + rng.choice(["", " & more", "A" * 40, ""]))
    return odd


def test_all_orders(spark, monkeypatch):
    rng = random.Random(6)
    bodies = texts()
    docs = [(i, rng.choice(["a", "b", None, ""]), rng.choice(bodies)) for i in range(250)]
    docs += [(3, "a", bodies[7]), (3, "a", bodies[7]), (None, "a", bodies[7]), (None, None, None),
             (500, "only", bodies[8])]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)]
    labels += [(2, 1, 0), (2, 0, 1), (None, 1, 1)]
    expected = by_force(docs, labels)
    assert audited(spark, docs, labels) == expected
    monkeypatch.setattr(A, "RANGE", 7)  # many ranges give the same sums
    assert audited(spark, docs, labels) == expected


def test_a_third_of_all_rows_with_one_text(spark):
    docs = [(i, "hot", "one common text") for i in range(300)] + [(i, "s", f"text {i}") for i in range(300, 900)]
    assert audited(spark, docs, []) == by_force(docs, [])


def test_no_rows(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}


@pytest.mark.parametrize("seed", range(20))
def test_merges(seed):
    rng = np.random.default_rng(seed)
    lists = [np.unique(rng.integers(0, 200, rng.integers(0, 120))) for _ in range(4)]
    sets = [set(x.tolist()) for x in lists]
    assert A.union(lists).tolist() == sorted(set().union(*sets))
    for a, b in itertools.permutations(range(4), 2):
        assert A.without(lists[a], lists[b]).tolist() == sorted(sets[a] - sets[b])
