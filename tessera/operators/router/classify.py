"""Query classification (R1-R5) as Column expressions.

Per type: total count of non-overlapping pattern matches on the lower-cased query
(case-insensitive); structural signals (numbers + operator -> math, code fence -> code);
a question-word rule; the winner is the first maximal type among the non-fallback types,
or the fallback type when all of them score zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import constants as K


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit("(?i)" + pattern))


def flags(query: Column) -> dict[str, Column]:
    """R2: structural flags on the raw (not lower-cased) query."""
    has_code = None
    for marker in K.CODE_FENCE_MARKERS:
        c = F.instr(query, marker) > 0
        has_code = c if has_code is None else (has_code | c)
    return {
        "has_numbers": query.rlike(K.HAS_NUMBERS_PATTERN),
        "has_operator": query.rlike(K.HAS_OPERATOR_PATTERN),
        "has_code": has_code,
    }


def question_word(query: Column) -> Column:
    """Leading question word of the lower-cased query, or NULL."""
    w = F.regexp_extract(F.lower(query), K.QUESTION_WORD_PATTERN, 1)
    return F.when(w != "", w)


def signals(query: Column) -> dict[str, Column]:
    """What the scores are made of: the lower-cased query, its flags and its question word."""
    return {"lower": F.lower(query), "question_word": question_word(query), **flags(query)}


def scores(query: Column, rules=K.CLASSIFIER_RULES, fallback: str = "general",
           known: dict[str, Column] | None = None) -> dict[str, Column]:
    """R1 + R3 + R4: DOUBLE score per type, in rule order.  ``known``: the :func:`signals` where
    they are columns already."""
    fl = known or signals(query)
    lower, qw = fl["lower"], fl["question_word"]
    out: dict[str, Column] = {}
    for qtype, patterns in rules:
        s = F.lit(0.0)
        for pat in patterns:
            s = s + _count(lower, pat).cast("double") * F.lit(K.PATTERN_WEIGHT)
        out[qtype] = s
    if "math" in out:
        out["math"] = out["math"] + F.when(fl["has_numbers"] & fl["has_operator"],
                                           F.lit(2 * K.STRUCTURE_WEIGHT)).otherwise(0.0)
    if "code" in out:
        out["code"] = out["code"] + F.when(fl["has_code"], F.lit(2 * K.STRUCTURE_WEIGHT)).otherwise(0.0)
    how_math = qw.isNotNull() & (F.instr(lower, "how") > 0) & fl["has_numbers"]
    asks_general = qw.isNotNull() & ~how_math & qw.isin("who", "where", "when")
    if "math" in out:
        out["math"] = out["math"] + F.when(how_math, F.lit(1.0)).otherwise(0.0)
    if fallback in out:
        out[fallback] = out[fallback] + F.when(asks_general, F.lit(0.5)).otherwise(0.0)
    return out


def winner(score_cols: dict[str, Column], fallback: str = "general") -> Column:
    """First maximal non-fallback type, fallback when all are zero."""
    active = [(t, c) for t, c in score_cols.items() if t != fallback]
    best = F.greatest(*[c for _, c in active]) if len(active) > 1 else active[0][1]
    expr = F.when(best <= 0, F.lit(fallback))
    for t, c in active:
        expr = expr.when(c == best, F.lit(t))
    return expr.otherwise(F.lit(fallback))
