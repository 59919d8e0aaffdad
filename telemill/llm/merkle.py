"""A Merkle manifest of a dataset: one root over all rows, and a proof for each of them.

Rows are leaves of a binary tree per group, and the groups' roots are leaves of a tree of their own.
Only every `STRIDE`-th level is persisted (a checkpoint level). Between two of them lie aligned
subtrees of up to 2 ** STRIDE stored descendants; a subtree is one array in one row, so building and
proving are column expressions over bounded arrays. A proof is put together from the top: each
subtree regenerates its missing interior nodes from the descendants that are stored, emits the
siblings on the way of each descendant, puts them before those of its own root, and lets the nodes
go. Texts are read once, and only digests are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import let, stored

#: Levels between two that are persisted.
STRIDE = 8

# Rows of a tree: `tree` names it, `n` is its number of leaves, `at` the place of a node on its level.
Levels = list[DataFrame]


def written(value: Column) -> Column:
    """`-` for null, else the byte count of the value, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(written, fields)), 256)


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds `at`, the place of a leaf in its tree by `order`, and `n`, the leaves of the tree.

    Ranges of (tree, order) are counted per tree, and a leaf's place is its row number in its range
    after the counts of the ranges before it, so a tree of any size has no task of its own. The
    ranges also cut rows that are alike, by `row`.
    """
    ranges = stored(
        leaves.repartitionByRange("tree", *order, "row").withColumn("range", F.spark_partition_id()),
        "leaf-ranges",
    )
    before = Window.partitionBy("tree").orderBy("range")
    # As many rows as there are ranges and trees in them; each is the work of one task before.
    counts = (
        ranges.groupBy("tree", "range")
        .agg(F.count(F.lit(1)).alias("own"))
        .withColumn("before", F.sum("own").over(before) - F.col("own"))
        .withColumn("n", F.sum("own").over(Window.partitionBy("tree")))
        .drop("own")
    )
    own = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order, "row"))
    both = ["range", "tree"]
    same = [ranges[c].eqNullSafe(counts[c]) for c in both]
    return (
        ranges.withColumn("own", own)
        .alias("l")
        .join(counts.alias("c").hint("merge"), [F.col(f"l.{c}").eqNullSafe(F.col(f"c.{c}")) for c in both])
        .select("l.*", F.col("c.n"), (F.col("c.before") + F.col("own") - 1).alias("at"))
        .drop("range", "own", "row")
    )


def _pairs(nodes: Column) -> Column:
    """The level above: every two consecutive nodes, or the last one alone, become their digest."""
    firsts = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(2))
    return F.transform(
        firsts, lambda i: F.sha2(F.concat(F.get(nodes, i), F.coalesce(F.get(nodes, i + 1), F.lit(""))), 256)
    )


def _counted(levels: Column) -> Column:
    """1 to `levels`, or nothing."""
    return F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))


def _height(n: Column, done: int) -> Column:
    """Levels that a subtree spans above level `done` in a tree of n leaves."""
    # Exact for any count: the bits of n - 1 are the levels of a tree.
    bits = F.when(n > 1, F.length(F.regexp_replace(F.bin(n - 1), "^0+", ""))).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(STRIDE), bits - F.lit(done)))


def _subtrees(level: DataFrame, kept: Column) -> DataFrame:
    """One row per aligned subtree: tree, n, at (of its root) and its stored descendants in order."""
    member = F.struct(F.col("at").alias("place"), kept.alias("kept"))
    return level.groupBy(
        "tree", "n", F.shiftright("at", STRIDE).alias("at")
    ).agg(F.sort_array(F.collect_list(member)).alias("members"))


def _nodes(members: Column) -> Column:
    return F.transform(members, lambda m: m["kept"]["node"])


def build(leaves: DataFrame) -> Levels:
    """The persisted levels of all trees, from the leaves (tree, n, at, node) to the roots.

    A tree that is done keeps its root at place 0 of the further levels.
    """
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    done = 0
    while 1 << done < most:
        rows = _subtrees(levels[-1], F.struct("node"))
        top = F.aggregate(
            _counted(_height(F.col("n"), done)), _nodes(F.col("members")), lambda nodes, _: _pairs(nodes)
        )
        rows = rows.select("tree", "n", "at", F.get(top, F.lit(0)).alias("node"))
        levels.append(stored(rows, "merkle-level"))
        done += STRIDE
    return levels


STEPS = "array<struct<sibling:string,is_left:boolean>>"


def _steps(all_nodes: Column, place: Column, height: Column) -> Column:
    """The siblings on the way up from a place; where there is none, an empty one to the right."""

    def step(k: Column) -> Column:
        own = F.call_function("shiftright", place, (k - 1).cast("int"))
        sibling = F.get(F.get(all_nodes, (k - 1).cast("int")), own.bitwiseXOR(F.lit(1)))
        return F.struct(
            F.coalesce(sibling, F.lit("")).alias("sibling"), (own % 2 == 1).alias("is_left")
        )

    return F.transform(_counted(height), step)


def prove(levels: Levels, above: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves with `steps`, the siblings from each up to the root of all.

    `above` has `tree`, `steps` from a tree's root on, and columns that its leaves are to have;
    `carried` names columns of the leaves to keep.
    """
    proofs = None
    for number in range(len(levels) - 1, -1, -1):
        names = carried if number == 0 else []
        if number == len(levels) - 1:
            # The roots of all trees, or their only leaves.
            proofs = levels[number].alias("l").join(
                above.alias("a").hint("merge"), F.col("l.tree").eqNullSafe(F.col("a.tree"))
            ).select("l.*", *[F.col(f"a.{c}") for c in above.columns if c != "tree"])
        else:
            height = _height(F.col("n"), number * STRIDE)
            rows = _subtrees(levels[number], F.struct("node", *names)).withColumn("height", height)
            more = [c for c in above.columns if c != "tree"]
            joined = rows.alias("l").join(
                proofs.select("tree", "at", *more).alias("a").hint("merge"),
                F.col("l.tree").eqNullSafe(F.col("a.tree")) & (F.col("l.at") == F.col("a.at")),
            ).select("l.*", *[F.col(f"a.{c}") for c in more])
            # The interior nodes of the subtree, level by level, for as long as this expression lasts.
            regenerated = F.aggregate(
                _counted(F.col("height") - 1),
                F.array(_nodes(F.col("members"))),
                lambda found, _: F.concat(found, F.array(_pairs(F.element_at(found, -1)))),
            )
            first = F.shiftleft(F.col("at"), STRIDE)
            members = let(
                regenerated,
                lambda nodes: F.transform(
                    F.col("members"),
                    lambda m: F.struct(
                        m["place"].alias("at"),
                        m["kept"].alias("kept"),
                        F.concat(_steps(nodes, (m["place"] - first).cast("int"), F.col("height")), F.col("steps")).alias("steps"),
                    ),
                ),
            )
            others = [c for c in more if c != "steps"]
            proofs = joined.select("tree", "n", *others, F.inline(members)).select(
                "tree", "n", "at", "kept.*", *others, "steps"
            )
        if 0 < number < len(levels) - 1:
            proofs = stored(proofs, "merkle-proofs")
    return proofs


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""

    def up(node: Column, step: Column) -> Column:
        left = F.when(step["is_left"], step["sibling"]).otherwise(node)
        right = F.when(step["is_left"], node).otherwise(step["sibling"])
        return F.sha2(F.concat(left, right), 256)

    return F.aggregate(steps, leaf, up)


def siblings(steps: Column) -> Column:
    return F.array_join(F.transform(steps, lambda step: step["sibling"]), "")


@dataclass(frozen=True)
class Manifest:
    """Persisted levels of the trees of all groups and of the tree over them."""

    leaves: Levels
    groups: Levels

    def root(self) -> DataFrame:
        """The root of all, one row `root`; none for an empty table."""
        return self.groups[-1].select(F.col("node").alias("root"))

    def proofs(self, carried: list[str]) -> DataFrame:
        """Every leaf with `subroot`, `root`, `steps` and the `carried` columns."""
        top = self.root().select(
            F.lit(0).alias("tree"), F.array().cast(STEPS).alias("steps"), "root"
        )
        of_groups = prove(self.groups, top, ["group"]).select(
            F.col("group").alias("tree"), F.col("node").alias("subroot"), "root", "steps"
        )
        return prove(self.leaves, stored(of_groups, "merkle-groups"), carried)


def manifest_of(leaves: DataFrame, order: list[str]) -> Manifest:
    """The manifest of leaves with the columns tree, node, row (a number of its own) and others.

    Leaves of a tree stand in the `order` of these columns, nulls first; leaves that tie take their
    place by `node`, so that only rows with equal digests are interchangeable. Trees stand in the
    order of their names, null first, as UTF-8.
    """
    levels = build(stored(placed(leaves, [*order, "node"]), "merkle-leaves"))
    roots = levels[-1].select(
        F.lit(0).alias("tree"), F.col("tree").alias("group"), "node", F.lit(0).alias("row")
    )
    groups = placed(stored(roots, "merkle-roots"), ["group"])
    return Manifest(levels, build(stored(groups, "merkle-groups")))


def manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_column: str = "doc_id",
    group_column: str = "lang",
    changed_column: str = "n_chars",
) -> DataFrame:
    """One row per row of `docs`: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    Where `tampered` holds, folded_root starts from the leaf of a row whose `changed_column` is
    larger by 1 (null stays null), else from the leaf itself; siblings are those of the untampered
    rows. Any column can be null; rows with one id each are a leaf; an empty table gives no rows.
    Other columns are not read.
    """
    fields = {c: F.col(c) for c in columns}
    more = {**fields, changed_column: F.col(changed_column).cast("decimal(38,0)") + 1}
    is_tampered = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    leaves = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(group_column).alias("tree"),
        F.col(id_column).alias("id"),
        leaf_of(*fields.values()).alias("node"),
        F.when(is_tampered, leaf_of(*more.values())).alias("altered"),
    )
    found = manifest_of(stored(leaves, "leaves"), ["id"]).proofs(["id", "altered"])
    return found.select(
        F.col("id").alias(id_column),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        folded(F.coalesce("altered", "node"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
