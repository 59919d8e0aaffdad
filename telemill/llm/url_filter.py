"""URL rules by a sort-merge range join.

A host turns into its labels in reverse, each closed by a comma: `www.example.com` becomes
`com,example,www,`. All subdomains of a host then form one interval of keys, that of its prefix, and
any two such intervals nest or are apart. URLs and the starts of rule intervals are sorted together;
one sweep keeps the stack of rule hosts whose interval the current key is in, and looks at their
paths only.

The sorted order is cut into ranges at quantiles of a bounded sample of (key, tie-break) pairs, so
that a host with a third of all URLs spans many ranges. A rule goes to each range that its interval
touches: rules of many hosts are few, and a rule of one host touches few ranges. The sample decides
the balance of the ranges, no result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from telemill.llm.common import extended, shuffle_partitions

#: Sampled URLs per range.
SAMPLE_PER_RANGE = 40
#: Greater than any character of a key, so that prefix + LAST ends the interval of a prefix.
LAST = "\U0010ffff"
#: Stands for a comma inside a label.
COMMA = "\U0010fffe"


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, with A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def key_of(host: Column) -> Column:
    """The labels of a host in reverse, each closed by a comma."""
    safe = F.translate(host, ",", COMMA)
    return F.concat(F.array_join(F.reverse(F.split(safe, r"\.")), ","), F.lit(","))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per row of `pages`: id, host, path, rule and verdict.

    `rules` has string columns host, path and verdict. A rule fits its host and all subdomains if the
    URL's path starts with the rule's path. The longest rule (host and path together) wins; of equally
    long ones the one with the longer host, of the same rule given twice the smallest verdict. Where
    none fits, rule is null and the verdict `default`. A null URL, or one without `://`, has an empty
    host and path, and no rule with a host fits it. Rules with a null host or path are ignored.
    Repeated rows give repeated rows, an empty table none. Other columns are not read.
    """
    spark = pages.sparkSession
    id_type = pages.schema[id_column].dataType.simpleString()
    url = F.coalesce(F.col(url_column), F.lit(""))
    urls = pages.select(
        F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    ).withColumn("key", key_of(F.col("host")))
    # A hash spreads the URLs of one host; their order within the host does not matter.
    urls = urls.withColumn("tie", F.xxhash64("path", "id"))
    cuts = _cuts(urls, shuffle_partitions(spark))

    starts = (
        rules.filter("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("key", key_of(F.col("host")))
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("key").to_pylist(), batch.column("tie").to_pylist())
            numbers = [bisect_right(cuts, pair) for pair in pairs]
            yield batch.append_column("range", pa.array(numbers, pa.int32()))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each rule once for every range that its interval touches."""
        for batch in batches:
            rows, numbers = [], []
            for row, key in enumerate(batch.column("key").to_pylist()):
                first = bisect_right(cuts, (key, -(2**63)))
                last = bisect_left(cuts, (key + LAST, 0))
                rows += [row] * (last - first + 1)
                numbers += range(first, last + 1)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield taken.append_column("range", pa.array(numbers, pa.int32()))

    placed = urls.mapInArrow(number, extended(urls.schema, range=IntegerType()))
    events = starts.mapInArrow(
        touched, extended(starts.schema, range=IntegerType())
    ).unionByName(placed, allowMissingColumns=True)
    swept = events.withColumn("is_url", F.col("tie").isNotNull())
    swept = swept.repartitionById(len(cuts) + 1, F.col("range"))
    swept = swept.sortWithinPartitions("range", "key", "is_url")
    return swept.mapInArrow(
        lambda batches: _sweep(batches, default),
        f"id {id_type}, host string, path string, rule string, verdict string",
    ).withColumnRenamed("id", id_column)


def _cuts(urls: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """Where one range ends and the next begins: at most `ranges` - 1 pairs of key and tie."""
    wanted = SAMPLE_PER_RANGE * ranges
    count = urls.count()
    share = min(1.0, 1.2 * wanted / max(1, count))
    # Which rows these are depends on their own values only, so a lost task samples the same again.
    sampled = urls.filter(F.pmod(F.xxhash64("id", "tie"), F.lit(1 << 40)) < int(share * (1 << 40)))
    pairs = sorted((row["key"], row["tie"]) for row in sampled.limit(2 * wanted).collect())
    step = max(1, len(pairs) // ranges)
    return sorted(set(pairs[step::step]))


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """The rows of each range in the order of keys, rule starts before the URLs of their key.

    The stack has the key of each active rule host with its rules by path, subdomains on top. A path
    is looked up at the lengths that its host's rules have.
    """
    stack: list[tuple[str, dict[int, dict[str, tuple[str, str]]]]] = []
    current = None
    for batch in batches:
        columns = batch.to_pydict()
        rules, verdicts = [], []
        for number, key, is_url, host, path, verdict in zip(
            *(columns[name] for name in ("range", "key", "is_url", "host", "path", "verdict"))
        ):
            if number != current:
                stack, current = [], number
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}))
                stack[-1][1].setdefault(len(path), {})[path] = (host, verdict)
                continue
            best = None
            for _, by_length in stack:
                for length, by_path in by_length.items():
                    found = by_path.get(path[:length]) if length <= len(path) else None
                    if found:
                        size = (len(found[0]) + length, len(found[0]))
                        best = max(best or (size,), (size, found[0] + path[:length], found[1]))
            rules.append(best and best[1])
            verdicts.append(best[2] if best else default)
        urls = batch.filter(batch.column("is_url"))
        if len(urls):
            yield pa.RecordBatch.from_arrays(
                [
                    *(urls.column(name) for name in ("id", "host", "path")),
                    pa.array(rules, pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                ["id", "host", "path", "rule", "verdict"],
            )
