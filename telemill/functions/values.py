"""Value coercion and the arithmetic actions, as Column functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COERCE_ERROR = "not_a_number"
ZERO_ERROR = "division_by_zero"


def is_present(value: Column) -> Column:
    """The key is there and is not JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def to_double(value: Column) -> Column:
    """Booleans become 1 and 0, numbers widen, text is parsed; anything else gives null."""
    return F.try_variant_get(value, "$", "double")


def coerce_error(value: Column) -> Column:
    return F.when(is_present(value) & to_double(value).isNull(), F.lit(COERCE_ERROR))


# The operand order of `sub` and `div` is constant first: c - x and c / x.


def ass(x: Column, c: Column) -> Column:
    return F.when(x.isNotNull(), c)


def add(x: Column, c: Column) -> Column:
    return c + x


def neg(x: Column) -> Column:
    return -x


def sub(x: Column, c: Column) -> Column:
    return c - x


def mul(x: Column, c: Column) -> Column:
    return x * c


def div(x: Column, c: Column) -> Column:
    """c / x; null where x is zero (see `action_error`)."""
    return F.try_divide(c, x)


def rvs(x: Column) -> Column:
    return F.try_divide(F.lit(1.0), x)


def chain(x: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    """Applies the steps from left to right, each to the result of the one before."""
    return reduce(lambda value, step: step(value), steps, x)


def fun(x: Column, function: Callable[[Column], Column]) -> Column:
    """A caller-supplied Column function as an action."""
    return function(x)


def with_sql_action(df: DataFrame, text: str, source: str, target: str) -> DataFrame:
    """A SQL expression over `X` as an action; `X` is the value of column `source`, and the only
    name the expression can use."""
    hidden = {name: f"_column_{i}" for i, name in enumerate(df.columns)}
    bound = df.select(
        *[F.col(name).alias(h) for name, h in hidden.items()], F.col(source).alias("X")
    )
    kept = [F.col(h).alias(name) for name, h in hidden.items() if name != target]
    return bound.select(*kept, F.expr(text).alias(target))


def apply_command(op: Column, arg: Column, x: Column, formula: Column) -> Column:
    """The transformed value of `x` for a parsed command."""
    return (
        F.when(op == "NEG", neg(x))
        .when(op == "ADD", add(x, arg))
        .when(op == "SUB", sub(x, arg))
        .when(op == "MUL", mul(x, arg))
        .when(op == "DIV", div(x, arg))
        .when(op == "RVS", rvs(x))
        .when(op == "EXPR1", formula)
    )


def action_error(op: Column, x: Column) -> Column:
    """Why an action gave no number; `x` is the coerced value of a present port value."""
    return F.when(x.isNull(), F.lit(COERCE_ERROR)).when(
        op.isin("DIV", "RVS") & (x == 0), F.lit(ZERO_ERROR)
    )


def strictly(result: Column, error: Column) -> Column:
    """`result`, or a failing task where there is an error."""
    return F.when(error.isNotNull(), F.raise_error(error).cast("double")).otherwise(result)
