"""Conversion formulas: text with numbers, X, + - * / and brackets, compiled once per dictionary entry to a short program.

A program is an array of steps in postfix order; rows run it with one column expression, so any number of different formulas costs
no Python and no branch per formula on the rows.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\s*(\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|[Xx+\-*/()])")
_RANK = {"+": 1, "-": 1, "*": 2, "/": 2, "neg": 3}
PROGRAM = T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("value", T.DoubleType())]))


def compile_formula(text: str | None) -> list[tuple[str, float | None]] | None:
    """Postfix steps ("n" a number, "x" the value, "neg" a sign, + - * /); None for what isn't a formula.

    A comma in a number is a decimal one.  A plain number is the formula "number times X" and has no other form.
    """
    if text is None:
        return None
    text, at = text.strip().replace(",", "."), 0
    out: list[tuple[str, float | None]] = []
    waiting: list[str] = []
    operand = True  # whether a number, X or bracket must come next
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            return None
        t, at = m[1], m.end()
        if t == "(" and operand:
            waiting.append(t)
        elif t in "+-" and operand:
            if t == "-":
                waiting.append("neg")
        elif t in "Xx" and operand:
            out.append(("x", None))
            operand = False
        elif t[0] in "0123456789." and operand:
            out.append(("n", float(t)))
            operand = False
        elif t == ")" and not operand:
            while waiting and waiting[-1] != "(":
                out.append((waiting.pop(), None))
            if not waiting:
                return None
            waiting.pop()
        elif t in "+-*/" and not operand:
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[t]:
                out.append((waiting.pop(), None))
            waiting.append(t)
            operand = True
        else:
            return None
    if operand or "(" in waiting:
        return None
    out += [(t, None) for t in waiting[::-1]]
    return out if any(op == "x" for op, _ in out) else None


@F.pandas_udf(PROGRAM)
def programs(text: pd.Series) -> pd.Series:
    """Programs of a dictionary's formulas (one row per entry)."""
    return pd.Series([None if (p := compile_formula(t)) is None else [{"op": op, "value": v} for op, v in p] for t in text])


def run(program: Column, x: Column) -> Column:
    """The program's value at x; null where it divides by zero."""
    def step(stack: Column, t: Column) -> Column:
        b, a, rest = F.get(stack, F.lit(0)), F.get(stack, F.lit(1)), F.slice(stack, 3, F.greatest(F.size(stack), F.lit(1)))
        two = F.when(t["op"] == "+", a + b).when(t["op"] == "-", a - b).when(t["op"] == "*", a * b).otherwise(F.try_divide(a, b))
        return (
            F.when(t["op"] == "n", F.concat(F.array(t["value"]), stack)).when(t["op"] == "x", F.concat(F.array(x.cast("double")), stack))
            .when(t["op"] == "neg", F.concat(F.array(-b), F.slice(stack, 2, F.greatest(F.size(stack), F.lit(1))))).otherwise(F.concat(F.array(two), rest))
        )

    return F.get(F.aggregate(program, F.array().cast("array<double>"), step), F.lit(0))
