"""Packing and piece encoding against the libraries and against brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from telemill.llm import packing, pieces
from telemill.llm.queries import QUERIES
from tests.oracle import DATA

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = packing._encoders(BYTES, RANKS)
ODD = [
    "", " ", "  ", "   ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "▁", "▁ a", "a▁ b", "é  x",
    "<|endoftext|>", "a <|endoftext|> b", "<s> </s>", "\x00 a", "\t", "don't stop", "x\r\n y",
    "1 234 5,6", "a　b  c", "​ ﻿", "😀 😀", "!? !?", "  two  spaces  ", "ﬁ Ａ ",
]
TEXTS = st.lists(st.sampled_from([*ODD, "the", "Thon", " ", "\n", "☃"]), max_size=9).map("".join)


def documents(spark, texts):
    rows = [(i, text, "clash", 0) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, id string, length int")


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_chunks_give_what_the_library_gives(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = [i for chunk in pieces.chunks_of(text) for i in library.encode(chunk)]
    assert found == library.encode(text)


def test_pieces_cross_white_space():
    assert pieces.crosses(["a", "▁a", "a▁b"])
    assert not pieces.crosses(["a", "▁a", "▁▁", "▁▁a"])


def test_encoding_of_odd_texts(spark):
    texts = [*ODD, None, "word " * 50_000, ODD[3], ODD[3]]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = pieces.encode_decode(documents(spark, texts), MODEL).collect()
    assert sorted(row["doc_id"] for row in rows) == list(range(len(texts)))
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "")
        assert (row["ids"], row["decoded"]) == (ids, library.decode(ids))
    assert pieces.encode_decode(documents(spark, []), MODEL).count() == 0


def test_encoding_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = pq.read_table(f"{DATA}/documents.parquet").to_pylist()
    rows = {row["doc_id"]: row for row in QUERIES["op10_sentencepiece"](spark, DATA).collect()}
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "")
        row = rows[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def check_packing(rows, texts, capacity=2048):
    """Pieces are cut as they should be, carry the right ids, and fill sequences without gaps."""
    tokenizer = Tokenizer.from_file(BYTES)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc_id], key=lambda row: row["piece"])
        assert [row["piece"] for row in own] == list(range(-(-len(ids) // capacity)))
        assert all(row["length"] == capacity for row in own[1:])
        at = 0
        for row in own:
            assert row["start"] == at
            at += row["length"]
            cut = np.array(ids[row["start"] : at], dtype="<u4").tobytes()
            assert row["ids_crc32"] == zlib.crc32(cut)
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_ranks_give_what_the_tokenizer_gives():
    whole, plain = ENCODERS
    characters = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028), 0x20AC)]
    texts = [f"a{c}b {c} {c}{c}1\n{c}'s{c} \t{c}" for c in characters]
    texts += [a + b for a in " \n\t\xa0\x85a1!'" for b in characters]
    for text, a, b in zip(texts, whole(texts), plain(texts)):
        assert (a == b).all(), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F), max_size=40))
def test_ranks_on_plain_texts(text):
    assert [list(x) for x in ENCODERS[0]([text])] == [list(x) for x in ENCODERS[1]([text])]


def test_packing_query(spark):
    docs = pq.read_table(f"{DATA}/documents.parquet").to_pylist()
    rows = QUERIES["op7_best_fit_packing"](spark, DATA).collect()
    sequences = check_packing(rows, {doc["doc_id"]: doc["text"] for doc in docs})
    fewest = -(-sum(row["length"] for row in rows) // 2048)
    assert sequences <= fewest + 1


def test_packing_of_odd_texts(spark):
    texts = [*ODD, None, "word " * 5_000, "a  b " * 3_000, ODD[3], ODD[3]]
    for ranks in (RANKS, None):
        rows = packing.packed_documents(documents(spark, texts), BYTES, ranks).collect()
        check_packing(rows, dict(enumerate(texts)))
    assert packing.packed_documents(documents(spark, []), BYTES).count() == 0


def test_repeated_rows_are_packed_each(spark):
    docs = documents(spark, ["a b c"] * 5).selectExpr("1L AS doc_id", "text")
    rows = packing.packed_documents(docs, BYTES).collect()
    assert sorted(row["offset"] for row in rows) == [0, 4, 8, 12, 16]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_places_every_length(lengths):
    counts = np.bincount(lengths, minlength=41).astype(np.int64)
    slots = packing.plan(counts, 40)
    filled = defaultdict(list)
    for length in range(1, 41):
        own = [k for k in range(len(slots.length)) if slots.length[k] == length]
        for rank in range(int(counts[length])):
            k = max(k for k in own if slots.rank[k] <= rank)
            within = rank - slots.rank[k]
            place = slots.offset[k] + within % slots.each[k] * length
            filled[slots.first[k] + within // slots.each[k]].append((place, length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 40
    assert sum(map(len, filled.values())) == len(lengths)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12), st.integers(0, 60))
def test_fullest_is_the_best_sum(lengths, room):
    counts = np.bincount(lengths, minlength=31).astype(np.int64)
    chosen = packing.fullest(counts, room)
    sums = {0}
    for length in lengths:
        sums |= {s + length for s in sums if s + length <= room}
    assert sum(chosen) == max(sums)
    assert (np.bincount(chosen, minlength=31) <= counts).all()


def test_a_piece_that_does_not_fit(spark):
    pieces_ = spark.createDataFrame([(1, 0, 50)], "doc_id bigint, piece int, length bigint")
    with pytest.raises(ValueError):
        packing.pack(pieces_, ["doc_id", "piece"], 40)
