import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemill.functions import formula as fm
from telemill.functions import times
from telemill.functions import values as V

IDENTITY = [(text, 3.0, 3.0) for text in ("-X", "2X", "1e5", "(X+1", "X+1)", "1.2.3", "2*X+", "", ".")]
CASES = [
    ("X", 5.0, 5.0), ("10-X-1", 4.0, 5.0), ("8/X/2", 2.0, 2.0), ("(X+1)*2-X/4", 3.0, 7.25),
    ("1/X", 0.0, math.inf), ("X/0", 0.0, math.nan), ("1 2 + X", 1.0, 13.0), ("X()", 4.0, 4.0),
    ("X2+", 3.0, 5.0), ("2X+", 3.0, 5.0), ("2X3+", 1.0, 24.0), ("(X)2+", 3.0, 5.0),
    ("1/X", -0.0, -math.inf), ("2+3*X", 4.0, 14.0), ("(2+3)*X", 4.0, 20.0), (".5*X", 4.0, 2.0),
    *IDENTITY,
]


def same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == b


def test_formulas_both_ways(spark):
    compiled = fm.F.array(*[fm.to_column(t, F.col("x").getItem(i)) for i, (t, _, _) in enumerate(CASES)])
    row = spark.range(1).select(F.array(*[F.lit(x) for _, x, _ in CASES]).alias("x")).select(compiled).first()
    as_data = (
        spark.createDataFrame([(i, t, x) for i, (t, x, _) in enumerate(CASES)], "i int, t string, x double")
        .select("i", fm.postfix_column(F.col("t")).alias("steps"), "x")
        .select("i", fm.evaluate_postfix(F.col("steps"), F.col("x")).alias("y"))
        .orderBy("i").collect()
    )
    for (text, _, expected), native, data in zip(CASES, row[0], as_data):
        assert same(native, expected), text
        assert same(data.y, expected), text


def infix():
    leaf = st.sampled_from(["X", "1", "2.5", "10", "0"])
    return st.recursive(
        leaf,
        lambda sub: st.tuples(sub, st.sampled_from("+-*/"), sub).map(lambda t: f"({t[0]}{t[1]}{t[2]})"),
        max_leaves=6,
    )


def python_value(text, x):
    class Ieee(float):
        def __truediv__(self, other):
            if other == 0:
                bad = math.isnan(self) or self == 0
                sign = math.copysign(1, other)
                return Ieee(math.nan if bad else math.copysign(math.inf, self) * sign)
            return Ieee(float(self) / float(other))

        def __add__(self, other):
            return Ieee(float(self) + float(other))

        def __sub__(self, other):
            return Ieee(float(self) - float(other))

        def __mul__(self, other):
            return Ieee(float(self) * float(other))

    import re

    return float(eval(re.sub(r"X|[0-9.]+", lambda m: "x" if m[0] == "X" else f"n({m[0]})", text),
                      {"x": Ieee(x), "n": Ieee}))


@settings(max_examples=200, deadline=None)
@given(infix(), st.sampled_from([0.0, 1.0, -2.0, 3.25]))
def test_postfix_against_python(text, x):
    stack = []
    for op, number in fm.to_postfix(text):
        if op in fm.PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append(f"({left}{op}{right})")
        else:
            stack.append("X" if op == "X" else str(number))
    assert same(python_value(stack[0], x), python_value(text, x))


def test_random_formulas_in_spark(spark):
    import random

    random.seed(7)

    def make(depth):
        if depth == 0 or random.random() < 0.2:
            return random.choice(["X", "2", "0.5", "7"])
        return f"({make(depth - 1)}{random.choice('+-*/')}{make(depth - 1)})"

    texts = [make(4) for _ in range(40)]
    native = spark.createDataFrame([(1.5,)], "x double").select(
        *[fm.to_column(t, F.col("x")).alias(f"y{i}") for i, t in enumerate(texts)]
    ).first()
    data = [r.y for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", fm.evaluate_postfix(fm.postfix_column(F.col("t")), F.lit(1.5)).alias("y")
    ).orderBy("i").collect()]
    for text, a, b in zip(texts, native, data):
        expected = python_value(text, 1.5)
        assert same(a, expected) and same(b, expected), text


@pytest.mark.parametrize("json,expected", [
    ("true", 1.0), ("false", 0.0), ("3", 3.0), ('"3.5"', 3.5), ('"abc"', None), ('"true"', None),
    ("[1]", None), ("null", None), ("1e3", 1000.0), ('" 1e3 "', 1000.0),
])
def test_coercion(spark, json, expected):
    value = F.parse_json(F.lit(json))
    x, error = spark.range(1).select(V.to_double(value), V.coerce_error(value)).first()
    assert x == expected
    assert (error is not None) == (expected is None and json != "null")


@pytest.mark.parametrize("spec,expected", [
    ("MIN&HOUR&DAY&300000&zzz",
     [("MIN", 60000), ("HOUR", 3600000), ("DAY", 86400000), ("INTERVAL300000", 300000)]),
    (None, []), ("MIN&60000", [("MIN", 60000)]), ("60000&MIN", [("INTERVAL60000", 60000)]),
    ("", []), ("&&", []), ("+5", [("INTERVAL5", 5)]), ("99999999999999999999", []),
])
def test_intervals(spark, spec, expected):
    column = times.parse_intervals(F.lit(spec).cast("string"))
    assert [tuple(e) for e in spark.range(1).select(column).first()[0]] == expected


def test_bucket_cuts_toward_zero(spark):
    assert spark.range(1).select(times.bucket(F.lit(-7), F.lit(5)), times.bucket(F.lit(7), F.lit(5))).first()[:] == (-5, 5)


def test_actions(spark):
    x, c = F.lit(4.0), F.lit(100.0)
    row = spark.range(1).select(
        V.ass(x, c), V.add(x, c), V.neg(x), V.sub(x, c), V.mul(x, c), V.div(x, c), V.rvs(x),
        V.div(F.lit(0.0), c), V.rvs(F.lit(-0.0)),
        V.chain(x, [V.neg, lambda v: V.add(v, F.lit(1.0))]), V.fun(x, F.sqrt),
    ).first()
    assert tuple(row) == (100.0, 104.0, -4.0, 96.0, 400.0, 25.0, 0.25, None, None, -3.0, 2.0)
