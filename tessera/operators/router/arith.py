"""Restricted arithmetic for the math handler's expression branch.

Only rows whose first digit/operator run contains an operator reach this step; the JVM
does that selection and passes NULL for every other row.  The expression is parsed with
Python's own parser and evaluated over numbers, unary +/- and + - * / // ** only (never
``eval``).  A power is guarded by the digits its value would have (``MAX_DIGITS``), never by
its exponent, so ``1 ** 1001`` is 1 and nested powers end.  ``status`` says what became of
a row: ``ok``, ``failed`` (syntax, division by zero) or ``guarded``; only ``ok`` rows have an
answer, the others take the word-problem branch like after an exception.
"""

from __future__ import annotations

import ast
import math
import operator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MAX_DIGITS = 100_000   # about twenty times what Python will print of an integer

RESULT_TYPE = T.StructType([
    T.StructField("answer", T.StringType()),   # str(round(result, 4))
    T.StructField("computed", T.StringType()),  # str(result)
    T.StructField("value", T.DoubleType()),
    T.StructField("status", T.StringType()),
])


class Guarded(Exception):
    """A value would have more than ``MAX_DIGITS`` digits."""

_BIN = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul,
        ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv}
_UN = {ast.UAdd: operator.pos, ast.USub: operator.neg}


def _eval(node):
    if isinstance(node, ast.Expression):
        return _eval(node.body)
    if isinstance(node, ast.Constant) and type(node.value) in (int, float):
        return node.value
    if isinstance(node, ast.UnaryOp) and type(node.op) in _UN:
        return _UN[type(node.op)](_eval(node.operand))
    if isinstance(node, ast.BinOp):
        left, right = _eval(node.left), _eval(node.right)
        if isinstance(node.op, ast.Pow):
            if (isinstance(left, int) and isinstance(right, int) and right > 0 and abs(left) > 1
                    and right * math.log10(abs(left)) > MAX_DIGITS):
                raise Guarded
            return left ** right
        if type(node.op) in _BIN:
            return _BIN[type(node.op)](left, right)
    raise ValueError("unsupported expression")


def evaluate(expr: str) -> tuple:
    """``(answer, computed, value, status)``."""
    try:
        result = _eval(ast.parse(expr, mode="eval"))
        if isinstance(result, complex):
            return None, None, None, "failed"
        computed, answer = str(result), str(round(result, 4))
        try:
            value = float(result)
        except OverflowError:
            value = None
        return answer, computed, value, "ok"
    except Guarded:
        return None, None, None, "guarded"
    except Exception:  # noqa: BLE001 - any failure falls through to the word problem
        return None, None, None, "failed"


def _arithmetic(exprs: pa.Array) -> pa.Array:
    """Each distinct expression of a batch is evaluated once; a row without one has no values."""
    coded = exprs.dictionary_encode()
    rows = [*map(evaluate, coded.dictionary.to_pylist()), (None,) * 4]
    kinds = to_arrow_type(RESULT_TYPE)
    found = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], fields=list(kinds))
    return found.take(pc.fill_null(coded.indices, len(rows) - 1))


# Marked non-deterministic so Catalyst neither duplicates the call (e.g. when a filter on
# the result is pushed below the projection) nor moves it: it runs once per row.
arithmetic = F.arrow_udf(_arithmetic, RESULT_TYPE).asNondeterministic()
