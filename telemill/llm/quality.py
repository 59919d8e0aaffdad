"""Quality rules as a short-circuit cascade.

A rule is a condition that rejects a text. A text is rejected if any rule rejects it, so the order
of the rules changes no result, only the work: the cascade measures each rule's cost (seconds) and
selectivity (share rejected) on a bounded sample and evaluates rules by rejections per second, each
only on texts that no earlier rule rejected. Everything is DataFrame functions; no row is shuffled.

Words are runs of characters other than space and \\t \\n \\v \\f \\r. A null text has none.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import let, stored

# White space, symbols and window of the base measures.
WHITE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rows, and characters of each, on which rules are measured. This decides their order, no result.
SAMPLE_ROWS = 500
SAMPLE_CHARS = 20_000


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPLIT)).otherwise(none)


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a window of 8 words that the text has twice or more.

    Windows are compared by a 64-bit hash of the hashes of their words: two different windows of a text
    pass for one with a chance of 2^-64 a pair, under one in a billion for a text of 100,000 words. Only
    a text with an equal pair of windows sorts its windows by (hash, place).
    """

    def place_by_place(windows: Column) -> Column:
        pairs = F.array_sort(
            F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        )

        def repeated(p: Column) -> Column:
            def starts(i: Column) -> Column:
                own = F.get(p, i)["x"]
                twin = own.eqNullSafe(F.get(p, i - 1)["x"]) | own.eqNullSafe(F.get(p, i + 1)["x"])
                return F.when(twin, F.get(p, i)["i"])

            return F.array_sort(
                F.filter(
                    F.transform(F.sequence(F.lit(0), F.size(p) - 1), starts),
                    lambda s: s.isNotNull(),
                )
            )

        # (words covered so far, end of the last window)
        def cover(so_far: Column, start: Column) -> Column:
            end = start + WINDOW
            return F.struct(
                (so_far["n"] + end - F.greatest(start, so_far["end"])).alias("n"),
                end.alias("end"),
            )

        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(let(pairs, repeated), zero, cover, lambda a: a["n"])

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
        )

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(place_by_place(w))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = let(let(hashes, windows), count)
    return F.when(F.size(words) <= WINDOW, 0).otherwise(found).cast("bigint")


def n_symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def lines_of(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)


def n_dup_lines(lines: Column) -> Column:
    return F.size(lines) - F.size(F.array_distinct(lines))


def n_shouted(text: Column, words: Column) -> Column:
    """Words with two capitals in a row; most texts have none, which one look at the text tells."""
    capitals = r"\p{Lu}{2}"
    found = F.size(F.filter(words, lambda x: x.rlike(capitals)))
    return F.when(text.rlike(capitals), found).otherwise(0)


def judged(text: Column, rules: Sequence[Rule]) -> Column:
    """A struct of the base measures of a text, base_failed, and kept, the verdict of the rules.

    What further rules measure beside the base is worked out in the cascade, where no rule before has
    rejected the text.
    """

    def of_parts(p: Column) -> Column:
        w, lines = p["words"], p["lines"]
        base = F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.translate(text, WHITE, "")).cast("bigint").alias("word_chars"),
            n_symbols(text).cast("bigint").alias("n_symbols"),
            n_dup_lines(lines).cast("bigint").alias("n_dup_lines"),
            n_repeat_words(w).alias("n_repeat_words"),
        )

        def verdict(m: Column) -> Column:
            failed = [rule.by_parts(text, p, m) for rule in BASE_RULES]
            more = [rule.by_parts(text, p, m) for rule in rules]
            return F.struct(
                m.alias("m"),
                (failed[0] | failed[1]).alias("base_failed"),
                cascade([*failed, *more]).alias("kept"),
            )

        return let(base, verdict)

    return let(F.struct(words_of(text).alias("words"), lines_of(text).alias("lines")), of_parts)


@dataclass(frozen=True)
class Rule:
    """`rejects` is a condition on the text alone; `by_parts` the same on the text, its words and lines,
    and its base measures."""

    name: str
    rejects: Callable[[Column], Column]
    by_parts: Callable[[Column, Column, Column], Column]


def _too_few(text: Column) -> Column:
    return F.size(words_of(text)) < 20


def _repeats(text: Column) -> Column:
    return let(words_of(text), lambda w: 100 * n_repeat_words(w) > 30 * F.size(w))


def _symbols(text: Column) -> Column:
    return 4 * n_symbols(text) > F.size(words_of(text))


def _word_length(text: Column) -> Column:
    chars = F.length(F.translate(text, WHITE, ""))
    return let(F.size(words_of(text)), lambda n: (chars < 2 * n) | (chars > 15 * n))


def _lines(text: Column) -> Column:
    return let(lines_of(text), lambda lines: 2 * n_dup_lines(lines) > F.size(lines))


def _shouting(text: Column) -> Column:
    return let(words_of(text), lambda w: 2 * n_shouted(text, w) > F.size(w))


#: Rejected are texts of under 20 words, and those where more than 30 % of the words lie in repeated
#: windows.
BASE_RULES = (
    Rule("too_few_words", _too_few, lambda text, p, m: m["n_words"] < 20),
    Rule("repeats", _repeats, lambda text, p, m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
)
#: And those with a symbol for every four words, words of under 2 or over 15 characters on average,
#: more than half of the lines repeated, or more than half of the words in capitals.
MORE_RULES = (
    Rule("symbols", _symbols, lambda text, p, m: 4 * m["n_symbols"] > m["n_words"]),
    Rule(
        "word_length",
        _word_length,
        lambda text, p, m: (m["word_chars"] < 2 * m["n_words"])
        | (m["word_chars"] > 15 * m["n_words"]),
    ),
    Rule(
        "repeated_lines", _lines, lambda text, p, m: 2 * m["n_dup_lines"] > F.size(p["lines"])
    ),
    Rule("shouting", _shouting, lambda text, p, m: 2 * n_shouted(text, p["words"]) > m["n_words"]),
)


def ordered(docs: DataFrame, rules: tuple[Rule, ...], text_column: str) -> list[Rule]:
    """The rules by rejections per second on a sample of `SAMPLE_ROWS` texts, most first."""
    text = F.substring(F.coalesce(F.col(text_column), F.lit("")), 1, SAMPLE_CHARS).alias("text")
    # Taken to the driver, a limit reads only the files it needs; its size is bounded.
    rows = docs.select(text).limit(SAMPLE_ROWS).collect()
    sample = stored(docs.sparkSession.createDataFrame(rows, "text string"), "quality-sample")
    worth = {}
    for rule in rules:
        # The first run compiles the plan, which is not the rule's cost.
        for _ in range(2):
            begin = time.perf_counter()
            rejected = sample.select(F.count_if(rule.rejects(F.col("text"))).alias("n")).first()["n"]
            worth[rule.name] = rejected / (time.perf_counter() - begin)
    return sorted(rules, key=lambda rule: -worth[rule.name])


def cascade(conditions: list[Column]) -> Column:
    """Whether no condition holds; a condition is evaluated only if all before it are false."""
    first, *others = conditions
    chain = F.when(first, False)
    for condition in others:
        chain = chain.when(condition, False)
    return chain.otherwise(True)


def quality_filter(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that no rule rejects, with all their columns.

    A null, empty or blank text has too few words and is rejected. Repeated rows are judged alike.
    An empty table stays empty.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rules = ordered(docs, BASE_RULES + MORE_RULES, text_column)
    return docs.filter(cascade([rule.rejects(text) for rule in rules]))


def quality_report(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, measures, base_failed and kept. Nulls as in the filter."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    # The base rules come first here: their measures are results of their own.
    rules = ordered(docs, MORE_RULES, text_column)
    return docs.select(F.col(id_column), judged(text, rules).alias("j")).select(
        id_column, "j.m.*", "j.base_failed", "j.kept"
    )
