"""Infix formulas over X: compiled to Columns, or to postfix data for rules in large numbers.

Blanks are ignored, also inside numbers. The digits of an operand form one number even when an X
stands between them, and the X counts as written before that number; with an operator behind them
(`X2+`) this makes a postfix formula. Whatever does not compile leaves values as they are.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Executors get the functions of this module with the task, without an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VARIABLE = "X"
PRECEDENCE = {"+": 1, "-": 1, "*": 2, "/": 2}
POSTFIX = "array<struct<op:string,num:double>>"

_PIECE = re.compile(r"[-+*/()]|[0-9.X]+")


def _operands(piece: str):
    yield from ((VARIABLE, None) for _ in range(piece.count(VARIABLE)))
    digits = piece.replace(VARIABLE, "")
    if digits:
        yield ("#", float(digits))


def _reorder(pieces: list[str]):
    """Operands at once, operators once nothing that binds at least as tightly follows."""
    waiting: list[str] = []
    for piece in pieces:
        if piece == "(":
            waiting.append(piece)
        elif piece == ")":
            while waiting[-1] != "(":
                yield (waiting.pop(), None)
            waiting.pop()
        elif piece in PRECEDENCE:
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[piece]:
                yield (waiting.pop(), None)
            waiting.append(piece)
        else:
            yield from _operands(piece)
    if "(" in waiting:
        raise ValueError("unclosed parenthesis")
    yield from ((op, None) for op in reversed(waiting))


def to_postfix(formula: str) -> list[tuple[str, float | None]] | None:
    """Steps (`X`, `#` with a number, or an operator); None if the formula does not compile."""
    text = formula.replace(" ", "")
    pieces = _PIECE.findall(text)
    if "".join(pieces) != text:
        return None
    try:
        steps = list(_reorder(pieces))
    except (ValueError, IndexError):
        return None
    depth = 0
    for op, _ in steps:
        if op in PRECEDENCE:
            if depth < 2:
                return None
            depth -= 1
        else:
            depth += 1
    return steps if depth == 1 else None


def ieee_divide(n: Column, d: Column) -> Column:
    """Floating point division without an error: x/0 is an infinity, 0/0 is NaN."""
    infinity = F.when(d.cast("string").startswith("-"), F.lit(float("-inf"))).otherwise(
        F.lit(float("inf"))
    )
    return F.when(d == 0, n * infinity).otherwise(n / d)


def _combine(op: str, left: Column, right: Column) -> Column:
    if op == "+":
        return left + right
    if op == "-":
        return left - right
    if op == "*":
        return left * right
    return ieee_divide(left, right)


def to_column(formula: str, x: Column) -> Column:
    """The formula as a native expression of `x`."""
    steps = to_postfix(formula)
    if steps is None:
        return x
    stack: list[Column] = []
    for op, number in steps:
        if op in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append(_combine(op, left, right))
        else:
            stack.append(x if op == VARIABLE else F.lit(number))
    return stack.pop()


def _compile_all(formulas: pd.Series) -> pd.Series:
    def steps(formula):
        compiled = to_postfix(formula) if formula is not None else None
        return None if compiled is None else [{"op": op, "num": num} for op, num in compiled]

    return pd.Series([steps(formula) for formula in formulas], dtype=object)


def postfix_column(formula: Column) -> Column:
    """Compiles the formulas of a rule table; null where one does not compile."""
    return F.pandas_udf(_compile_all, POSTFIX)(formula)


def evaluate_postfix(steps: Column, x: Column) -> Column:
    """Evaluates postfix data; `x` itself where there is none."""

    def step(stack: Column, token: Column) -> Column:
        op = token["op"]
        right, left = F.get(stack, F.lit(0)), F.get(stack, F.lit(1))
        combined = F.when(op == "+", left + right).when(op == "-", left - right).when(
            op == "*", left * right
        ).otherwise(ieee_divide(left, right))
        push = F.concat(F.array(F.when(op == VARIABLE, x).otherwise(token["num"])), stack)
        reduce = F.concat(F.array(combined), F.slice(stack, F.lit(3), F.size(stack)))
        return F.when(op.isin(*PRECEDENCE), reduce).otherwise(push)

    empty = F.array().cast("array<double>")
    return F.when(steps.isNull(), x).otherwise(
        F.aggregate(steps, empty, step, lambda stack: F.get(stack, F.lit(0)))
    )
