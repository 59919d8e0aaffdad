"""Quality rules and exact copies on odd inputs and against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from telemill.llm import exact_dedup, quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = {}
    for window in windows:
        times[window] = times.get(window, 0) + 1
    covered = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, chars = len(words), sum(map(len, words))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    twice = len(lines) - len(set(lines))
    shouted = sum(bool(re.search("[A-ZÀ-ÖØ-Þ]{2}", word)) for word in words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    rejected = (4 * symbols > n or chars < 2 * n or chars > 15 * n or 2 * twice > len(lines)
                or 2 * shouted > n)
    return n, chars, symbols, twice, len(covered), failed, not (failed or rejected)


def texts():
    rng = random.Random(3)
    prose = " ".join(f"word{k}" for k in range(40))
    odd = [
        None, "", " ", "\n\n", "\x0b\x0c\r\t", "\xa0", "a\x0bb\x0cc\rd\te", "é " * 25, prose,
        prose.upper(), prose + "\n" + prose, "x " * 30_000, "a b c d e f g h " * 2, "a b c d e f g h",
        "a b c d e f g h a", "line one\nline one\n line one\nline one", "### " * 30, prose + " #$%",
        "abcdefghijklmnopqrst " * 3 + prose, "one\n\none\n \none", "ÉÈ " * 30, "1 2 3 " * 10,
    ]
    for _ in range(150):
        letters = rng.choice(["ab", "abcdef", "aB#\n"])
        parts = [rng.choice(letters) * rng.randint(1, 3) for _ in range(rng.randint(1, 60))]
        odd.append(rng.choice([" ", "  ", "\n", " \n "]).join(parts))
    return odd


def frame_of(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    rows = [(i, text, "x", 1) for i, text in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, n_words int")


def test_measures_and_verdicts(spark):
    rows = list(enumerate(texts()))
    docs = frame_of(spark, rows)
    found = {row[0]: tuple(row)[1:] for row in quality.quality_report(docs).collect()}
    assert found == {i: measured(text) for i, text in rows}
    stay = quality.quality_filter(docs)
    assert stay.columns == docs.columns
    assert {row.doc_id for row in stay.collect()} == {i for i, text in rows if measured(text)[-1]}
    assert quality.quality_report(docs.limit(0)).count() == 0


def test_order_changes_no_verdict(spark):
    docs = frame_of(spark, enumerate(texts()))
    rules = quality.BASE_RULES + quality.MORE_RULES
    text = F.coalesce(F.col("text"), F.lit(""))
    verdicts = [
        {row.doc_id for row in docs.filter(quality.cascade([r.rejects(text) for r in order])).collect()}
        for order in (rules, rules[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_plan_is_native(spark):
    docs = frame_of(spark, enumerate(texts()))
    for frame in (quality.quality_report(docs), exact_dedup.exact_dedup(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def judged(rows):
    """For each row: id, keep_id, group_size, text_sha256, and how many of a text are kept: one."""
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = [True] + [False] * (ids.count(keep) - 1)
        found += [(i, keep, len(ids), kept.pop() if i == keep else False, sha) for i in ids]
    return sorted(map(repr, found))


ROWS = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "a "), (6, "A"), (7, "é"), (None, "n"),
        (None, "n"), (None, "a"), (8, "é"), (9, "x" * 300_000), (10, "x" * 300_000), (2, "other")]


def test_exact_copies(spark):
    docs = frame_of(spark, ROWS)
    found = exact_dedup.exact_dedup(docs).collect()
    assert sorted(repr(tuple(row)) for row in found) == judged(ROWS)
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    expected = {}
    for i, text in ROWS:
        old = expected.get(text or "", (None, 0))
        expected[text or ""] = max(old, (i, 0), key=lambda pair: -1 if pair[0] is None else pair[0])
    assert sorted((str(row.doc_id), row.text or "") for row in stay.collect()) == sorted(
        (str(i), text) for text, (i, _) in expected.items())
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_one_text_in_most_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_dedup.exact_dedup(docs.repartition(9), capacity=50).filter("text_sha256 = sha2('hot', 256)")
    row = found.agg(F.count("*"), F.min("keep_id"), F.max("keep_id"), F.min("group_size"),
                    F.count_if("kept")).first()
    assert tuple(row) == (2000, 2999, 2999, 2000, 1)


def test_directory_doubles_until_buckets_fit(spark, monkeypatch):
    """Buckets shallower and deeper than the cells, over several passes; hot keys count once."""
    rows = spark.range(2000).select("id", F.col("id").cast("string").alias("text"))
    rows = rows.union(spark.range(900).select("id", F.lit("hot").alias("text")))
    for bits, a_pass, capacity in ((16, 8, 100), (2, 2, 100), (2, 8, 1)):
        monkeypatch.setattr(exact_dedup, "CELL_BITS", bits)
        monkeypatch.setattr(exact_dedup, "BITS_A_PASS", a_pass)
        index, directory = exact_dedup.build_index(rows, capacity)
        index = index.collect()
        assert len(index) == 2001
        sizes = {}
        for row in index:
            # A bucket holds the keys that begin with its bits.
            assert (row["key"] % 2**64) >> (64 - row["depth"]) == row["bucket"]
            sizes[row["depth"], row["bucket"]] = sizes.get((row["depth"], row["bucket"]), 0) + 1
        assert max(sizes.values()) <= capacity and len(sizes) >= 2000 // capacity
        depths = {row["cell"]: row["depth"] for row in directory.collect()}
        assert len(depths) <= 2**bits
        assert all(depths[(row["key"] % 2**64) >> (64 - bits)] == row["depth"] for row in index)


def test_texts_go_to_owners_of_buckets(spark):
    """One shuffle of texts by bucket; only hot keys are summed before one by text."""
    rows = frame_of(spark, ROWS).selectExpr("doc_id AS id", "coalesce(text, '') AS text")
    keys = exact_dedup.keys_of(rows)
    hot = exact_dedup.hot_keys(keys, 2)
    assert hot.count() == 1
    directory = exact_dedup.directory_of(keys, hot, 2)
    plan = exact_dedup.entries_of(rows, hot, directory)._jdf.queryExecution().executedPlan().toString()
    by = [re.sub(r"#\d+L?", "", one) for one in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert any(re.match(r"depth, bucket, \d", one) for one in by)
    assert sum("text" in one for one in by) == 1


def test_collisions_are_chained(spark, monkeypatch):
    """With one key for all texts, texts are still told apart by their bytes."""
    monkeypatch.setattr(exact_dedup, "key_of", lambda text: F.length(text).cast("bigint") % 2)
    docs = frame_of(spark, ROWS)
    found = exact_dedup.exact_dedup(docs, capacity=1).collect()
    assert sorted(repr(tuple(row)) for row in found) == judged(ROWS)
    rows = docs.selectExpr("doc_id AS id", "coalesce(text, '') AS text")
    index = exact_dedup.build_index(rows, 1)[0].collect()
    assert sorted(row["chain"] for row in index if row["key"] == 1) == list(
        range(1, 1 + sum(row["key"] == 1 for row in index)))
