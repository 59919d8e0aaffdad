"""Rule tables: scanning, change folding, the effective rules and their lookup form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.functions import formula as formulas
from telemill.functions import times
from telemill.operators.joins import lookup_join
from telemill.session import shared_folder

# The commands a rule can hold.
COMMANDS_WITH_NUMBER = ("ADD", "SUB", "MUL", "DIV")
COMMANDS = ("NEG", "RVS", "EXPR1") + COMMANDS_WITH_NUMBER

ANY_PORT = -1

# Rules are broadcast up to this size, estimated from the snapshot that is joined.
BROADCAST_BYTES = 128 * 1024 * 1024
# Ports of a device whose rules are in one inner map.
PAGE_BITS = 6


def read_rules_jdbc(spark: SparkSession, url: str, apps: list[str], **options: str) -> DataFrame:
    """The rule tables `dc_<app>` of a database, with the app as a column.

    `options` reach the reader; `partitionColumn` with its bounds reads a table in several tasks.
    """
    if not apps:
        raise ValueError("name at least one app")
    tables = [
        spark.read.format("jdbc")
        .options(url=url, dbtable=f"dc_{app}", **options)
        .load()
        .withColumn("app", F.lit(app))
        for app in apps
    ]
    rules = tables[0]
    for table in tables[1:]:
        rules = rules.unionByName(table)
    return rules


def rules_after(rules: DataFrame, last_id: int = -1) -> DataFrame:
    """Rules in use that are newer than `last_id`; the filters reach the source."""
    return rules.filter(
        (F.col("id") >= last_id + 1)
        & (F.col("used") == 1)
        & F.col("did").isNotNull()
        & F.col("cmd").isNotNull()
    )


def high_water(rules: DataFrame, last_id: int = -1) -> DataFrame:
    """The highest id read per app; rows without a device or command count as read."""
    return (
        rules.filter((F.col("id") >= last_id + 1) & (F.col("used") == 1))
        .groupBy("app")
        .agg(F.max("id").alias("last_id"))
    )


def parse_rules(rules: DataFrame) -> DataFrame:
    """Adds `op, arg, formula, intervals, supported` and `reject`, the reason of a malformed rule."""
    words = F.split("cmd", ":")
    op = F.get(words, F.lit(0))
    # An empty word at the end counts as absent.
    word = F.when(F.col("cmd").rlike("^[^:]*:+$"), F.lit(None).cast("string")).otherwise(
        F.get(words, F.lit(1))
    )
    number = word.try_cast("double")
    parsed = F.struct(
        op.alias("op"),
        F.when(op.isin(*COMMANDS_WITH_NUMBER), number).alias("arg"),
        F.when(op == "EXPR1", word).alias("formula"),
        times.parse_intervals(F.col("avg")).alias("intervals"),
        op.isin(*COMMANDS).alias("supported"),
        F.when(F.col("cmd").rlike("^:+$"), F.lit("no_command"))
        .when(op.isin("EXPR1", *COMMANDS_WITH_NUMBER) & word.isNull(), F.lit("missing_argument"))
        .when(op.isin(*COMMANDS_WITH_NUMBER) & number.isNull(), F.lit("bad_number"))
        .alias("reject"),
    )
    # The generator keeps filters on parsed columns above it, so that each rule is parsed once.
    rows = rules.select("*", F.inline(F.array(parsed)))
    bad_interval = F.col("supported") & times.has_bad_interval(F.col("intervals"))
    return rows.withColumn(
        "reject", F.coalesce("reject", F.when(bad_interval, F.lit("bad_interval")))
    )


def rejected_rules(rules: DataFrame) -> DataFrame:
    """Malformed rules with the reason; one bad rule does not keep the others from loading."""
    return parse_rules(rules_after(rules)).filter(F.col("reject").isNotNull()).select(
        *rules.columns, "reject"
    )


def _port(pidx: Column) -> Column:
    return F.greatest(F.coalesce(pidx, F.lit(0)), F.lit(ANY_PORT)).cast("int")


def _usable_rules(rules: DataFrame) -> DataFrame:
    return parse_rules(rules_after(rules)).filter(F.col("reject").isNull())


def effective_rules(rules: DataFrame, key: tuple[str, ...] = ("did",)) -> DataFrame:
    """The rule in force per device and port; port -1 stands for any port.

    The highest id wins. An unsupported command that wins hides the older rule and is no rule
    itself. `key=("app", "did")` keeps the devices of different apps apart.
    """
    parsed = _usable_rules(rules)
    columns = ("id", "op", "arg", "formula", "intervals", "supported")
    latest = (
        parsed.withColumn("pidx", _port(F.col("pidx")))
        .groupBy(*key, "pidx")
        .agg(F.max_by(F.struct(*columns), F.struct("id", "app")).alias("rule"))
    )
    return latest.filter("rule.supported").select(
        *key, "pidx", *[F.col(f"rule.{c}").alias(c) for c in columns[:-1]]
    )


def apply_rule_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """A snapshot after single-row re-reads, given in the order of their `seq`.

    The last change of a device and port replaces its rule, or deletes it if the row is out of
    use, has no command or an unsupported one. Malformed changes are left out (see
    `rejected_rules`). Both inputs have the rule columns; `changes` also has `seq`.
    """
    columns = ("app", "id", "cmd", "avg", "used")
    rows = ("did", "pidx", *columns)
    old = snapshot.withColumn("pidx", _port(F.col("pidx"))).select(
        *rows, F.lit(0).alias("turn"), F.col("id").cast("bigint").alias("seq")
    )
    new = (
        parse_rules(changes)
        .filter(F.col("did").isNotNull() & F.col("reject").isNull())
        .withColumn("pidx", _port(F.col("pidx")))
        .withColumn("used", F.when(F.col("supported"), F.col("used")).otherwise(F.lit(0)))
        .select(*rows, F.lit(1).alias("turn"), F.col("seq").cast("bigint").alias("seq"))
    )
    last = (
        old.unionByName(new)
        .groupBy("did", "pidx")
        .agg(F.max_by(F.struct(*columns), F.struct("turn", "seq")).alias("rule"))
    )
    return last.filter((F.col("rule.used") == 1) & F.col("rule.cmd").isNotNull()).select(
        "did", "pidx", "rule.*"
    )


def merge_keeping(current: DataFrame, new: DataFrame, keep: DataFrame) -> DataFrame:
    """The new rules, but for the devices in `keep` (column `did`) the current ones.

    With no current rule at all the new rules are taken as they are.
    """
    kept = current.join(keep, "did", "left_semi")
    # One row if there is a current rule, none otherwise.
    some = current.select(F.lit(1).alias("_some")).limit(1)
    held = keep.withColumn("_some", F.lit(1)).join(F.broadcast(some), "_some", "left_semi")
    return new.join(held, "did", "left_anti").unionByName(kept)


def remove_devices(rules: DataFrame, devices: DataFrame) -> DataFrame:
    """The rules without those of the given devices (column `did`)."""
    return rules.join(devices, "did", "left_anti")


def clear_rules(rules: DataFrame) -> DataFrame:
    return rules.limit(0)


def _gcd(a: Column, b: Column) -> Column:
    """Of two bigints that are not negative; Euclid's steps for 63 bits are below 92."""
    pair = F.struct(a.alias("a"), b.alias("b"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(92)),
        pair,
        lambda p, _: F.when(p["b"] == 0, p).otherwise(
            F.struct(p["b"].alias("a"), (p["a"] % F.nullif(p["b"], F.lit(0))).alias("b"))
        ),
        lambda p: p["a"],
    )


def grain_of(intervals: Column) -> Column:
    """The longest time that divides all intervals of a rule; null if it has none."""
    first = F.get(intervals, F.lit(0))["ms"]
    shared = F.aggregate(intervals, first, lambda grain, entry: _gcd(grain, entry["ms"]))
    return F.when(F.size(intervals) > 1, shared).otherwise(first)


def folded_rules(effective: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per device: `any_rule`, that of any port, `pages`, a map from `pidx div 64` to a map
    from port to rule, and `bytes`, their estimated size.

    A device has one rule per port, so its row is no larger than a message with all its ports.
    """
    rule = F.struct(
        "op",
        "arg",
        formulas.postfix_column(F.col("formula")).alias("postfix"),
        "intervals",
        grain_of(F.col("intervals")).alias("grain"),
    )
    # Partitioned by device first, which serves both foldings.
    rows = effective.repartition(*key).select(*key, "pidx", rule.alias("rule"))
    size = (
        F.lit(160)
        + 24 * F.coalesce(F.size("rule.postfix"), F.lit(0))
        + 40 * F.size("rule.intervals")
        + sum((F.octet_length(k) for k in key), F.lit(0))
    )
    pages = rows.groupBy(*key, F.shiftright("pidx", PAGE_BITS).alias("page")).agg(
        F.map_from_entries(F.collect_list(F.struct("pidx", "rule"))).alias("rules"),
        F.sum(size).alias("bytes"),
    )
    of_ports = F.when(F.col("page") >= 0, F.struct("page", "rules"))
    of_any = F.try_element_at("rules", F.lit(ANY_PORT))
    return pages.groupBy(*key).agg(
        F.first(of_any, ignorenulls=True).alias("any_rule"),
        F.map_from_entries(F.collect_list(of_ports)).alias("pages"),
        F.sum("bytes").alias("bytes"),
    )


@dataclass(frozen=True)
class RuleBook:
    """A snapshot of the rules in force, one row per device (see `folded_rules`).

    What is measured, looked up and applied is this snapshot, whatever becomes of the rule table.
    """

    devices: DataFrame
    key: tuple[str, ...]
    small: bool

    @staticmethod
    def of(rules: DataFrame, key: tuple[str, ...] = ("did",)) -> RuleBook:
        """Takes the snapshot of a rule table, as a table in the shared folder, and measures it."""
        folded = folded_rules(effective_rules(rules, key), key)
        spark = rules.sparkSession
        path = shared_folder(spark, "rules")
        folded.write.parquet(path)
        devices = spark.read.schema(folded.schema).parquet(path)
        total = devices.agg(F.sum("bytes").alias("bytes")).first().bytes or 0
        return RuleBook(devices, key, total <= BROADCAST_BYTES)

    @staticmethod
    def once(rules: DataFrame, key: tuple[str, ...] = ("did",)) -> RuleBook:
        """The book of a rule table that is read by one query only, without writing a snapshot.

        The size of the lookup form is bounded by one pass over the rules as they are; they are folded
        where the query joins them. The rule table must not change meanwhile (see `of`).
        """
        bound = (
            F.lit(200)
            + 24 * F.octet_length("cmd")
            + 40 * F.coalesce(F.octet_length("avg"), F.lit(0))
            + sum((F.coalesce(F.octet_length(k), F.lit(0)) for k in key), F.lit(0))
        )
        total = rules_after(rules).agg(F.sum(bound.cast("bigint"))).first()[0] or 0
        devices = folded_rules(effective_rules(rules, key), key)
        return RuleBook(devices, key, total <= BROADCAST_BYTES)

    def join(self, messages: DataFrame, how: str = "left") -> DataFrame:
        """Messages with `any_rule` and `pages` of their device, null where it has no rules."""
        names = {k: "id" for k in self.key if k == "did"}
        key = [names.get(k, k) for k in self.key]
        devices = self.devices.drop("bytes").withColumnsRenamed(names)
        return lookup_join(messages, devices, key, self.small, how)

    @staticmethod
    def port_rule(pidx: Column) -> Column:
        """The rule written for this port, of the device joined."""
        return F.try_element_at(
            F.try_element_at(F.col("pages"), F.shiftright(pidx, PAGE_BITS)), pidx
        )

    @staticmethod
    def formula_value(rule: Column, x: Column) -> Column:
        """The value of an EXPR1 rule at `x`."""
        return formulas.evaluate_postfix(rule["postfix"], x)


class RuleFeed:
    """The rule book for the micro-batches of a stream, taken anew when the rules have changed.

    Changes show in the number, the highest id and a hash of the usable rules, so edits and deletions
    show as well as new rules.
    """

    def __init__(self, rules: Callable[[], DataFrame], key: tuple[str, ...] = ("did",)) -> None:
        self._rules = rules
        self._key = key
        self._seen: tuple | None = None
        self._book: RuleBook | None = None

    def current(self) -> RuleBook:
        rules = self._rules()
        usable = rules_after(rules)
        columns = ("app", "id", "did", "pidx", "cmd", "avg")
        row = usable.agg(
            F.count(F.lit(1)),
            F.max("id"),
            F.sum(F.xxhash64(*columns).cast("decimal(38,0)")),
            F.sum(F.xxhash64(F.lit("again"), *columns).cast("decimal(38,0)")),
        ).first()
        if self._book is None or tuple(row) != self._seen:
            self._book, self._seen = RuleBook.of(rules, self._key), tuple(row)
        return self._book
