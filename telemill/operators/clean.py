"""Port expansion, rule application and the invalid-message test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.functions import values as V
from telemill.operators.rules import ANY_PORT, RuleBook
from telemill.sources.messages import as_map


def explode_ports(messages: DataFrame) -> DataFrame:
    """One row per port: `pidx`, the port columns, and `active`, whether it is below `portnum`."""
    others = [c for c in messages.columns if c != "values"]
    # An outer explode: the plain one would also filter on the size of `values` below it, and
    # compute a cleaned `values` twice.
    ports = messages.select(*others, F.posexplode_outer("values").alias("pidx", "port")).filter(
        F.col("pidx").isNotNull()
    )
    return ports.select(
        *others,
        "pidx",
        *[F.col(f"port.{c}").alias(c) for c in ("value", "valid", "unit")],
        (F.col("pidx") < F.col("portnum")).alias("active"),
    )


def has_invalid_port(values: Column, portnum: Column) -> Column:
    """Any of the first `portnum` ports says `valid: false`; a missing `valid` counts as valid."""
    used = F.slice(values, F.lit(1), F.greatest(portnum, F.lit(0)))
    return F.coalesce(
        F.exists(used, lambda port: F.coalesce(~port["valid"], F.lit(False))), F.lit(False)
    )


def transform_value(
    rule: Column, x: Column, strict: bool = False
) -> tuple[Column, Column]:
    """The new value under `rule` of a present port value, and the error if there is none; `x` is
    that value as a double. A failed action has no value, whatever its formula."""
    error = V.action_error(rule["op"], x)
    result = V.apply_command(rule["op"], rule["arg"], x, RuleBook.formula_value(rule, x))
    checked = V.strictly(result, error) if strict else F.when(error.isNull(), result)
    return checked, error


def found_rule(pidx: Column) -> tuple[Column, Column]:
    """The rule of a port and that of any port, of a message joined with the rules of its device."""
    return RuleBook.port_rule(pidx), F.col("any_rule")


def _with_rule(port: Column, pidx: Column) -> Column:
    own, any_rule = found_rule(pidx)
    active = pidx < F.col("portnum")
    found = F.coalesce(own, any_rule)
    return F.struct(
        port.alias("port"),
        F.when(active, found).alias("rule"),
        F.when(active & own.isNotNull(), pidx)
        .when(active & any_rule.isNotNull(), F.lit(ANY_PORT))
        .alias("rule_port"),
        V.to_double(port["value"]).alias("x"),
    )


def _ruled_ports() -> Column:
    """Each port with its rule, of messages joined with the rules of their device."""
    return F.transform("values", _with_rule)


def rule_lookup(messages: DataFrame, book: RuleBook) -> DataFrame:
    """Active ports with `rule` and `rule_port`, the port number the rule was written for."""
    others = [c for c in messages.columns if c != "values"]
    # Rules are looked up in the message, so that only a port's own rule goes with the port.
    ports = book.join(messages).select(*others, F.posexplode_outer(_ruled_ports()).alias("pidx", "r"))
    return ports.filter(F.col("pidx") < F.col("portnum")).select(
        *others,
        "pidx",
        *[F.col(f"r.port.{c}").alias(c) for c in ("value", "valid", "unit")],
        "r.rule",
        "r.rule_port",
    )


def _applied(item: Column, strict: bool) -> Column:
    port, rule = item["port"], item["rule"]
    result, error = transform_value(rule, item["x"], strict)
    ruled = rule.isNotNull() & V.is_present(port["value"])
    return F.struct(
        *[port[c].alias(c) for c in ("value", "valid", "unit", "extra")],
        ruled.alias("ruled"),
        F.when(ruled, result).alias("result"),
        F.when(ruled, error).alias("action_error"),
        F.when(ruled, rule["intervals"]).alias("intervals"),
    )


def apply_rules(messages: DataFrame, book: RuleBook, strict: bool = False) -> DataFrame:
    """Messages with `ruled_ports` in place of `values`: each port as it came, with the result of its
    rule. Both cleaned messages and readings are made of these.

    One join by device; messages are not put together again, so they need no identity.
    """
    applied = F.transform(_ruled_ports(), lambda item: _applied(item, strict))
    others = [c for c in messages.columns if c != "values"]
    return book.join(messages).select(*others, applied.alias("ruled_ports"))


def _kept_error(port: Column) -> Column:
    """The further keys of a port whose action failed, with the error and the original value."""
    failure = F.to_json(
        F.struct(port["action_error"].alias("action_error"), port["value"].alias("original"))
    )
    merged = F.map_concat(
        F.map_filter(as_map(port["extra"]), lambda key, _: ~key.isin("action_error", "original")),
        as_map(failure),
    )
    return F.when(port["extra"].isNull(), failure).otherwise(F.to_json(merged))


def _cleaned_port(port: Column) -> Column:
    failed = port["action_error"].isNotNull()
    return F.struct(
        F.when(port["ruled"], port["result"].cast("variant")).otherwise(port["value"]).alias("value"),
        port["valid"].alias("valid"),
        port["unit"].alias("unit"),
        F.when(failed, _kept_error(port)).otherwise(port["extra"]).alias("extra"),
        port["action_error"].alias("action_error"),
    )


def cleaned(ruled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What `apply_rules` gives as cleaned messages with these columns."""
    values = F.transform("ruled_ports", _cleaned_port)
    return ruled.select(*[values.alias(c) if c == "values" else F.col(c) for c in columns])


def clean_messages(messages: DataFrame, book: RuleBook, strict: bool = False) -> DataFrame:
    """Messages with the values of ruled ports replaced; all other values keep their JSON type.

    A failed action leaves null, the reason in the port column `action_error`, and the reason and
    the original value among the further keys (`extra`), which the wire format and the stores keep.
    With `strict` it ends the job.
    """
    return cleaned(apply_rules(messages, book, strict), messages.columns)
