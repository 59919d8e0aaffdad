"""The pipeline, stage by stage, against brute force."""

import corpus_pipeline
from telemill.llm import queries
from tests.llm.test_ngram_join import by_force as near_by_force
from tests.llm.test_repeats import by_force as repeats_by_force
from tests.llm.test_repeats import kept
from tests.llm.test_tokens import check_packing
from tests.oracle import DATA, duck_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def whole_characters(text, spans):
    """What stays of a text if only whole characters go."""
    out, at = [], 0
    for char in text:
        size = len(char.encode())
        if not any(begin <= at and at + size <= end for begin, end in spans):
            out.append(char)
        at += size
    return "".join(out)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert docs.columns == COLUMNS
    names, _, rows = duck_rows(queries.SQL["op2_quality_rules"])
    fit = {row[names.index("doc_id")] for row in rows if row[names.index("kept")]}
    expected = {row["doc_id"]: row.asDict() for row in docs.collect() if row["doc_id"] in fit}
    steps = [expected]
    last = {}
    for row in expected.values():
        last[row["text"]] = max(row["doc_id"], last.get(row["text"], row["doc_id"]))
    steps.append({i: row for i, row in expected.items() if last[row["text"]] == i})
    groups = near_by_force([(i, row["text"]) for i, row in steps[-1].items()])
    steps.append({i: row for i, row in steps[-1].items() if groups[i][0] == i})
    spans = repeats_by_force((i, row["text"].encode()) for i, row in steps[-1].items())
    cut = {}
    for i, row in steps[-1].items():
        text = whole_characters(row["text"], spans[i])
        assert len(text.encode()) >= len(kept(row["text"].encode(), spans[i]))
        if text:
            cut[i] = row | {"text": text, "n_chars": len(text)}
    steps.append(cut)
    assert [len(step) for step in steps] == sorted((len(step) for step in steps), reverse=True)
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        docs = corpus_pipeline.stored(stage(spark, docs, DATA), "step")
        assert docs.columns == COLUMNS
        assert sorted(docs.collect(), key=lambda row: row["doc_id"]) == [
            tuple(step[i][c] for c in COLUMNS) for i in sorted(step)], name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    check_packing(packed, {i: row["text"] for i, row in steps[-1].items()})


def test_pipeline_of_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x " * 30, None, None, 1),
            (3, "a b " * 50_000, "en", "s", 2), (4, "one two three", "en", "s", 3)]
    rows += [(5, " ".join(f"word{k}" for k in range(60)), "en", "s", 4)] * 3
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame, ids in ((docs, {5}), (docs.limit(0), set())):
        for _, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.stored(stage(spark, frame, DATA), "odd")
        assert [row["doc_id"] for row in frame.collect()] == sorted(ids)


def test_run(spark):
    assert len(corpus_pipeline.STAGES) == 5
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert rows and all(row["offset"] + row["length"] <= 2048 for row in rows)
