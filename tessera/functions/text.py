"""Column -> Column text functions.  All of them are built-in Spark expressions on the
executors; no Python worker is involved.  (Array lambdas are interpreted, not compiled.)"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """ARRAY<STRING>: lower-cased ``[a-z0-9]+`` runs, minus stopwords and 1-char tokens.

    Lower-casing happens first, then only ASCII letters and digits form tokens, so a
    non-ASCII letter splits a word (``naïve`` -> ``na``, ``ve``).
    """
    runs = F.regexp_extract_all(F.lower(_col(text)), F.lit("[a-z0-9]+"), 0)
    return F.filter(runs, lambda t: (F.length(t) > 1) & ~t.isin(K.STOPWORDS))


_SENTENCE_SPLIT = r"(?<=[.!?])\s+"
_EDGE_WS = r"^\s+|\s+$"
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text) -> Column:
    """Remove leading and trailing whitespace (space, tab, line feed, carriage return,
    vertical tab, form feed)."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def summarise(text, n_sentences: int = K.SUMMARY_SENTENCES) -> Column:
    """First ``n`` sentences: split after ``.``/``!``/``?`` followed by whitespace, drop
    blank pieces, join with one space.

    The split stops after ``n`` separators (the remainder stays one piece), so only the
    head of a long text is scanned.  Pieces of a stripped text are never blank (a
    whitespace run is consumed whole by one separator), so the first ``n`` pieces of the
    limited split are the first ``n`` non-blank pieces of a full split."""
    pieces = F.transform(F.split(strip(text), _SENTENCE_SPLIT, n_sentences + 1), strip)
    kept = F.filter(F.slice(pieces, 1, n_sentences), lambda s: s != "")
    return F.array_join(kept, " ")


def category_scores(text, rules=K.CATEGORY_RULES, lowered: bool = False) -> list[Column]:
    """Per category: number of distinct rule keywords occurring as substrings.
    ``lowered=True`` when ``text`` is already lower-cased (pass a column computed once:
    every keyword test reads it)."""
    lower = _col(text) if lowered else F.lower(_col(text))
    scores = []
    for _, keywords in rules:
        hits = [F.when(F.instr(lower, kw) > 0, 1).otherwise(0) for kw in keywords]
        total = hits[0]
        for h in hits[1:]:
            total = total + h
        scores.append(total)
    return scores


def with_categories(df, lowered: str, rules=K.CATEGORY_RULES, fallback: str = K.FALLBACK_CATEGORY):
    """``df`` with ``category``: the highest-scoring one of the lower-cased text column; ties
    go to the earlier rule; all zero -> fallback.  The scores are staged in a projection, so
    each keyword is looked for once."""
    scores = category_scores(lowered, rules, lowered=True)
    staged = df.select("*", F.array(*scores).alias("_scores"))
    named = first_max_label([(name, F.get("_scores", i)) for i, (name, _) in enumerate(rules)])
    return staged.select(*df.columns, F.when(F.array_max("_scores") > 0, named).otherwise(F.lit(fallback))
                         .alias("category"))


def first_max_label(scores: list[tuple[str, Column]], default: str | None = None) -> Column:
    """Label of the first maximal score (dictionary-order argmax)."""
    best = F.greatest(*[c for _, c in scores]) if len(scores) > 1 else scores[0][1]
    expr = None
    for name, c in scores:
        expr = F.when(c == best, F.lit(name)) if expr is None else expr.when(c == best, F.lit(name))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def extract_final_answer(text) -> Column:
    """Number after the first ``####`` (commas dropped, stripped); else the last
    ``\\b\\d[\\d,.]*\\b`` run without commas; else NULL."""
    t = _col(text)
    marked = F.regexp_extract(t, K.ANSWER_MARKER_PATTERN, 1)
    has_marker = t.rlike(K.ANSWER_MARKER_PATTERN)
    marked_clean = F.regexp_replace(F.regexp_replace(marked, ",", ""), _EDGE_WS, "")
    runs = F.regexp_extract_all(t, F.lit(K.ANSWER_FALLBACK_PATTERN), 0)
    last = F.try_element_at(runs, F.lit(-1))
    return F.when(t.isNull(), F.lit(None).cast("string")) \
        .when(has_marker, marked_clean) \
        .otherwise(F.regexp_replace(last, ",", ""))


def format_prompt(question, answer=None) -> Column:
    """Instruction prompt; the answer is appended when given (training form)."""
    head = F.concat(F.lit(K.PROMPT_TEMPLATE_HEAD + K.SYSTEM_PROMPT + K.PROMPT_TEMPLATE_QUESTION),
                    _col(question), F.lit(K.PROMPT_TEMPLATE_ANSWER))
    if answer is None:
        return head
    return F.concat(head, F.coalesce(_col(answer), F.lit("")))


def py_float_str(x) -> Column:
    """Render a DOUBLE the way Python's ``str(float)`` does: plain digits with at least one
    after the point for |x| in [1e-4, 1e16) and 0, else ``1.5e+16`` / ``1e-05``."""
    x = _col(x)
    plain = (x == 0) | ((F.abs(x) < F.lit(1e16)) & (F.abs(x) >= F.lit(1e-4)))
    dec = F.regexp_replace(F.when(plain, x).cast("decimal(38,18)").cast("string"), r"0+$", "")
    fixed = F.when(dec.endswith("."), F.concat(dec, F.lit("0"))).otherwise(dec)
    java = x.cast("string")  # 1.5E16, 1.0E-5
    power = F.regexp_extract(java, r"E(-?[0-9]+)$", 1)
    digits = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    size = F.lpad(F.regexp_replace(power, "-", ""), 2, "0")
    long = F.when(F.length(F.regexp_replace(power, "-", "")) > 2, F.regexp_replace(power, "-", "")).otherwise(size)
    scientific = F.concat(digits, F.when(power.startswith("-"), "e-").otherwise("e+"), long)
    return (F.when(x.isNull(), F.lit(None).cast("string")).when(plain, fixed)
            .when(power != "", scientific)
            .otherwise(F.lower(F.regexp_replace(F.regexp_replace(java, "Infinity", "inf"), "NaN", "nan"))))
