"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash. Rows are counted per key, and the directory starts as one bucket and
doubles: a bucket that holds more than `capacity` rows is split on the next leading bit of the key,
as often as it takes, so a bucket is a range of keys. The directory has one row for each of at most
2^16 cells of keys, the depth of the buckets in it, and is broadcast at any size of the input.

The directory sends every text to the owner of its bucket. The owner compares bytes: texts of a
bucket are put together only if key and all bytes agree, and texts that collide on a key are chained.
Rows to be judged then look their text up by bucket, key and digest.

A hot key, one that alone holds more rows than a bucket and than one of 2^16 equal shares of the
table, would fill its owner. Its texts are summed in each task before they are sent, so that a text
that makes up a third of all rows reaches its owner as one row per task. There are fewer than 2^16
such keys.

Everything is DataFrame functions. Shuffled are the texts once, else only keys and digests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import stored

#: Bits of a cell of the directory. Buckets may be deeper or shallower than cells.
CELL_BITS = 16
#: Bits that one pass over the keys of overfull cells may add to their depth.
BITS_A_PASS = 4
KEY_BITS = 64
#: Rows per bucket before it is split. Only the size of buckets depends on it, no result.
CAPACITY = 2_000


def key_of(text: Column) -> Column:
    return F.xxhash64(text)


def _leading(key: Column, bits: Column) -> Column:
    """The leading 1 to 64 bits of a key as a number; a shift by no bits leaves it as it is."""
    return F.call_function("shiftrightunsigned", key, F.lit(KEY_BITS) - bits)


def _cell(key: Column) -> Column:
    return _leading(key, F.lit(CELL_BITS)).cast("int")


def keys_of(rows: DataFrame) -> DataFrame:
    """How many of the rows (id, text) each key has: key, n."""
    return rows.groupBy(key_of(F.col("text")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The keys with more rows than a bucket and than one of 2^16 shares: fewer than 2^16."""
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return keys.filter(F.col("n") > max(capacity, total >> CELL_BITS)).select("key")


def _first_fit(levels: DataFrame, capacity: int) -> DataFrame:
    """cell and the least depth at which all buckets that meet it fit, null without one.

    `levels` has depth, bucket, cells, rows and keys. A bucket of one key cannot be split.
    """
    fits = (F.col("rows") <= capacity) | (F.col("keys") == 1)
    return (
        levels.select(F.explode("cells").alias("cell"), "depth", fits.alias("fits"))
        .groupBy("cell", "depth")
        .agg(F.bool_and("fits").alias("fits"))
        .groupBy("cell")
        .agg(F.min(F.when(F.col("fits"), F.col("depth"))).alias("depth"))
    )


def directory_of(keys: DataFrame, hot: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The directory after all doublings: cell, and the depth of its buckets in bits.

    A hot key counts as one row, as its texts come summed. Depths up to that of the cells are found
    from the sizes of the cells; cells that are overfull then are counted by more bits of their keys.
    """
    loads = keys.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "key", "left").select(
        "key",
        _cell(F.col("key")).alias("cell"),
        F.when(F.col("hot"), F.lit(1)).otherwise(F.col("n")).alias("rows"),
    )
    sized = (F.sum("rows").alias("rows"), F.sum("keys").alias("keys"))
    cells = loads.groupBy("cell").agg(F.sum("rows").alias("rows"), F.count("*").alias("keys"))
    levels = (
        cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(CELL_BITS))))
        .withColumn("bucket", F.expr(f"shiftright(cell, {CELL_BITS} - depth)"))
        .groupBy("depth", "bucket")
        .agg(*sized, F.collect_list("cell").alias("cells"))
    )
    found = [stored(_first_fit(levels, capacity), "exact-directory")]
    depth = CELL_BITS
    # Ends, as at 64 bits every bucket has one key.
    while not (over := found[-1].filter("depth IS NULL").select("cell")).isEmpty():
        deepest = min(KEY_BITS, depth + BITS_A_PASS)
        levels = (
            loads.join(F.broadcast(over), "cell", "left_semi")
            .groupBy("cell", _leading(F.col("key"), F.lit(deepest)).alias("bits"))
            .agg(F.sum("rows").alias("rows"), F.count("*").alias("keys"))
            .withColumn("depth", F.explode(F.sequence(F.lit(depth + 1), F.lit(deepest))))
            .withColumn("bucket", F.expr(f"shiftrightunsigned(bits, {deepest} - depth)"))
            .groupBy("cell", "depth", "bucket")
            .agg(*sized)
            .withColumn("cells", F.array("cell"))
        )
        found.append(stored(_first_fit(levels, capacity), "exact-directory"))
        depth = deepest
    return reduce(DataFrame.unionByName, found).filter("depth IS NOT NULL")


def addressed(keyed: DataFrame, directory: DataFrame) -> DataFrame:
    """Rows with a key, and depth and bucket (the leading bits of the key) from the directory."""
    bucket = F.when(F.col("depth") == 0, F.lit(0)).otherwise(_leading(F.col("key"), F.col("depth")))
    return (
        keyed.withColumn("cell", _cell(F.col("key")))
        .join(F.broadcast(directory), "cell")
        .withColumn("bucket", bucket)
        .drop("cell")
    )


def entries_of(rows: DataFrame, hot: DataFrame, directory: DataFrame) -> DataFrame:
    """The index, one row per distinct text: depth, bucket, key, chain (place among the texts with
    its key, from 1), text_sha256, keep_id, group_size."""
    sent = addressed(rows.withColumn("key", key_of(F.col("text"))), directory)
    hot = F.broadcast(hot)
    bucket = ["depth", "bucket"]

    def compared(own: DataFrame) -> DataFrame:
        chain = F.row_number().over(Window.partitionBy(*bucket, "key").orderBy("text_sha256"))
        return (
            own.groupBy(*bucket, "key", "text")
            .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select(*bucket, "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
            .withColumn("chain", chain)
        )

    # Sent by bucket, texts need no further shuffle to be compared and chained.
    owned = compared(sent.join(hot, "key", "left_anti").repartition(*bucket))
    return owned.unionByName(compared(sent.join(hot, "key", "left_semi")))


def build_index(rows: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The index of the texts of rows (id, text), and its directory, both files in the shared folder."""
    keys = stored(keys_of(rows), "exact-keys")
    hot = hot_keys(keys, capacity)
    directory = directory_of(keys, hot, capacity)
    return stored(entries_of(rows, hot, directory), "exact-index"), directory


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty, and all empty texts are copies of each other. Of equal texts the
    row with the largest id stays; of repeated rows with that id, one. A null id is smaller than any
    other: it stays only if all rows of its text have none, and then one of them. An empty table
    gives no rows. Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    index, directory = build_index(rows, capacity)
    keyed = rows.select(
        "id", key_of(F.col("text")).alias("key"), F.sha2("text", 256).alias("text_sha256")
    )
    # Rows with the same id and text are alike, so any order among them gives the same result.
    repeat = F.row_number().over(Window.partitionBy("id", "text_sha256").orderBy("key"))
    return (
        addressed(keyed, directory)
        .join(index.drop("chain").hint("merge"), ["depth", "bucket", "key", "text_sha256"])
        .withColumn("repeat", repeat)
        .select(
            F.col("id").alias(id_column),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Nulls and repeated rows as in `exact_dedup`: of each text one row stays. Of rows that have the id
    and the text that stay and differ in other columns, any one does. An empty table stays empty.
    Columns named `__place` or `__sha` are the operator's.
    """

    def keyed(frame: DataFrame, sha: Column) -> DataFrame:
        # Columns named so that none of the table's can clash; null ids compare as equal.
        place = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
        return frame.withColumns({"__place": place, "__sha": sha})

    kept = keyed(exact_dedup(docs, id_column, text_column).filter("kept"), F.col("text_sha256"))
    sha = F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)
    # The join leaves rows partitioned and sorted by these two, so repeated rows need no shuffle.
    return (
        keyed(docs, sha)
        .join(kept.select("__place", "__sha").hint("merge"), ["__place", "__sha"], "left_semi")
        .dropDuplicates(["__place", "__sha"])
        .drop("__place", "__sha")
    )
