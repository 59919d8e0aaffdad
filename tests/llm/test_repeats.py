"""Repeated passages against brute force over all windows."""

import hashlib

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from telemill.llm import repeats
from telemill.llm.queries import QUERIES
from tests.oracle import DATA

DEPTH = 100


def by_force(docs):
    """Spans to remove for each of (id, text), in order of ids."""
    seen = set()
    found = {}
    for doc_id, text in sorted(docs):
        covered = bytearray(len(text))
        for at in range(len(text) - DEPTH + 1):
            window = text[at : at + DEPTH]
            if window in seen:
                covered[at : at + DEPTH] = b"\x01" * DEPTH
            seen.add(window)
        spans, at = [], 0
        while (begin := covered.find(1, at)) >= 0:
            end = covered.find(0, begin)
            at = end if end >= 0 else len(text)
            spans.append((begin, at))
        found[doc_id] = spans
    return found


def kept(text, spans):
    at = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(at[::2], at[1::2]))


def check(spark, docs, given_ids=None):
    rows = [(i, text, "clash", 0) for i, text in docs]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, seed string, tag int")
    texts = {i: (text or "").encode() for i, text in docs}
    expected = by_force(texts.items())
    found = repeats.cut_repeats(frame.repartition(5)).collect()
    assert sorted(row["id"] for row in found) == sorted(texts)
    for row in found:
        spans = [(span["begin"], span["end"]) for span in row["spans"]]
        assert spans == expected[row["id"]], row["id"]
        assert row["n_bytes"] == len(texts[row["id"]])
        assert bytes(row["kept"]) == kept(texts[row["id"]], spans)


def test_query(spark):
    docs = {d["doc_id"]: (d["text"] or "").encode()
            for d in pq.read_table(f"{DATA}/documents.parquet").to_pylist()}
    expected = by_force(docs.items())
    rows = QUERIES["op4_suffix_dedup"](spark, DATA).collect()
    assert len(rows) == len(docs)
    for row in rows:
        text, spans = docs[row["doc_id"]], expected[row["doc_id"]]
        rest = kept(text, spans)
        assert row["n_bytes"] == len(text) and row["n_removed"] == len(text) - len(rest)
        assert row["n_spans"] == len(spans)
        assert row["kept_sha256"] == hashlib.sha256(rest).hexdigest()


WORDS = [f"w{i * 7919 % 1000}x" for i in range(300)]


def prose(begin, n):
    return " ".join(WORDS[(begin * 37 + k * k) % 300] for k in range(n))


def test_odd_texts(spark):
    long = prose(1, 40)
    check(spark, [
        (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, "x" * 350),
        (7, long), (8, long), (9, "é" + long + "é"), (10, long[:120] + "!" + long[120:]),
        (11, prose(2, 30) + long[50:175]), (12, long[20:121]), (13, long[20:119]),
        (-5, prose(3, 60)), (14, prose(3, 60)), (15, prose(4, 30) * 3), (16, "ab" * 400),
        (17, "é" * 300), (18, long + prose(5, 40)), (19, prose(5, 40) + long),
    ])


def test_a_line_that_many_documents_have(spark):
    line = prose(9, 12)
    passage = prose(11, 40)
    assert len(line) < DEPTH < len(passage)
    check(spark, [(i, f"{prose(i, 9)}\n{line}\n{prose(i + 50, 9)} {passage[i:]}") for i in range(60)])


def test_stretches_of_long_texts(spark, monkeypatch):
    # Workers are forked before, so the limit is tried on the function itself.
    monkeypatch.setattr(repeats, "AT_ONCE", 300)
    text = (prose(1, 150) + prose(2, 100)).encode()
    whole = repeats.runs_of([text])
    batch = repeats.pa.RecordBatch.from_pydict({"id": [1], "tag": [0], "data": [text]})
    found = [row for out in repeats._first_digit(iter([batch])) for row in out.to_pylist()]
    starts = sorted(s for r in found for s in range(r["seed"] - r["most"], r["seed"] - r["least"] + 1))
    assert starts == list(range(len(text) - DEPTH + 1))
    assert (whole["most"] - whole["least"] + 1).sum() == len(starts)


def test_repeated_rows_and_ids(spark):
    long = prose(1, 40)
    rows = [(1, long), (1, long), (1, prose(2, 40)), (2, long), (None, prose(2, 40)), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [(r["id"], r["n_bytes"], len(r["kept"])) for r in repeats.cut_repeats(frame).collect()]
    a, b, least = len(long), len(prose(2, 40)), -(2**63)
    assert sorted(found) == sorted(
        [(1, a, a), (1, a, a), (1, b, 0), (2, a, 0), (least, b, b), (least, 0, 0)])
    assert repeats.cut_repeats(frame.limit(0)).count() == 0


PARTS = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 150), st.integers(1, 260)), max_size=4)


@settings(max_examples=12, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=10))
def test_pieces_of_passages(spark, docs):
    passages = [prose(20 + k, 80) for k in range(4)] + ["ab" * 200]
    texts = ["|".join(passages[k][a : a + n] for k, a, n in parts) for parts in docs]
    check(spark, list(enumerate(texts)))
