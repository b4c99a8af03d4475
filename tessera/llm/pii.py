"""Operator 1: personal data by bootstrapped contextual extraction, in DataFrame functions.

Seeds are the matches of four fixed rules (email, ip, card, phone), validated.  Tokens that
have a digit or an at sign are instances; the words left and right of an occurrence, alone
and together, are its lexical patterns.  Pattern and instance scores follow each other for
``ROUNDS`` rounds over the graph of distinct (pattern, value) pairs:

* a pattern's confidence for a kind is the sum of its values' scores over the number of its
  values plus ``SMOOTH``; it counts from ``MIN_SUPPORT`` trusted values and ``MIN_PATTERN``
  confidence on;
* a value's score is 1 for the kind of its seeds, else 1 - prod(1 - confidence) over its
  patterns; values that reach ``MIN_VALUE`` are trusted in the next round.

A trusted value's occurrences next to a trusted pattern become spans of that kind, unless
they overlap a seed.  Hot words (a left word that a third of all occurrences have) are
summed before they are shuffled.

Spans are code points, end exclusive.  A NULL or empty text has none.  Repeated rows and
ids are documents of their own (a row number is written with the scan); extra columns are
ignored by :func:`find` and kept by :func:`redact`.  Matches are never cut short: the rules
run over whole texts, in time linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

KINDS = ["email", "ip", "card", "phone"]
ROUNDS, MIN_SUPPORT, MIN_PATTERN, MIN_VALUE, SMOOTH = 3, 3, 0.8, 0.9, 0.5

# The rules.  Possessive quantifiers and the look-behinds leave the matches of the plain
# rules as they are (a run of one class is always taken whole, from its start or from the
# last match) but keep Java's matcher linear and off the stack.
_LOCAL = "[A-Za-z0-9._%+-]"
RULES = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "phone": "+"}
_WS = r"\x20\x09-\x0D"
_TOKEN = rf"(?<![^{_WS}])[^{_WS}0-9@]*+[0-9@][^{_WS}]*+"
_EDGE = "#"
_BLOCK = 64
_STRETCH = 256

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once (an expression inside a lambda is evaluated for
    every element)."""
    return F.get(F.transform(F.array(value), body), 0)


def _prefix_sums(lengths: Column) -> Column:
    """Sums of the items before each item, by blocks: n * n / 8192 steps for n beyond a million,
    about 32 for each item below that."""
    n = F.size(lengths)
    total = lambda items: F.aggregate(items, F.lit(0), lambda a, x: a + x)
    at = lambda i: F.floor(i / _BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), at(n - 1)),
                         lambda b: total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))
    before = _let(blocks, lambda bs: F.transform(bs, lambda _, b: total(F.slice(bs, F.lit(1), b))))
    each = _let(before, lambda sums: F.transform(lengths, lambda _, i: F.get(sums, at(i)) + total(
        F.slice(lengths, at(i) * _BLOCK + 1, i % _BLOCK))))
    return F.when(n > 0, each).otherwise(F.array().cast("array<int>"))


def _matches(text: Column, pattern: str, possible: Column) -> Column:
    """array<struct<start, end, value, before, after>> of all matches, with the gaps around."""
    def rows(found: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return _let(steps, lambda lengths: _let(_prefix_sums(lengths), lambda sums: F.transform(found, lambda m, i: _let(
            F.get(sums, i) + F.length(F.get(gaps, i)), lambda start: F.struct(
                start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"),
                F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"))))))

    return F.when(possible, _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                                 lambda found: _let(F.split(text, pattern, -1), lambda gaps: rows(found, gaps))))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(short(p)) <= 3)
                        & (F.coalesce(F.substring(short(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return _let(digits, lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False))


def base_spans(text: Column) -> Column:
    """Validated matches of the rules, by start, then kind."""
    def of(number: int, kind: str) -> Column:
        possible = F.contains(text, F.lit(_HINT[kind])) if kind in _HINT else text.rlike("[0-9]")
        good = F.filter(_matches(text, RULES[kind], possible), lambda m: _valid(kind, m["value"]))
        return F.coalesce(F.transform(good, lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"))), F.array().cast(_SPAN))

    return F.array_sort(F.concat(*[of(number, kind) for number, kind in enumerate(KINDS)]))


def candidates(text: Column) -> Column:
    """Identifier-like tokens with the lower-cased words left and right ('#': none, or
    another such token)."""
    word = rf"^[{_WS}]*+([^{_WS}]++)"
    left = lambda gap: F.reverse(F.regexp_extract(F.reverse(gap), word, 1))
    right = lambda gap: F.regexp_extract(gap, word, 1)
    named = lambda w: F.when(w == "", _EDGE).otherwise(F.lower(w))
    return F.transform(_matches(text, _TOKEN, text.rlike("[0-9@]")), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
        named(left(m["before"])).alias("left"), named(right(m["after"])).alias("right")))


def scan(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """One pass over the texts, written: row, doc_id, base spans and candidate tokens; with
    ``keep_rows`` also the input row, as a struct."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input")] if keep_rows else []),
        base_spans(text).alias("base"), F.coalesce(candidates(text), F.array().cast(
            "array<struct<start:int,end:int,value:string,left:string,right:string>>")).alias("tokens"))
    return written(found, "pii_scan")


def _patterns(left: Column, right: Column) -> Column:
    one = lambda tag, w: F.when(w != _EDGE, F.concat(F.lit(tag), w))
    both = F.when((left != _EDGE) & (right != _EDGE), F.concat_ws("\x01", F.lit("B"), left, right))
    return F.array_compact(F.array(one("L\x01", left), one("R\x01", right), both))


def _seeds(scanned: DataFrame) -> DataFrame:
    """(seed_row, seed_start, seed): tokens that overlap base spans, with the kind of the first one.
    Both meet in the stretches of ``_STRETCH`` code points that they reach into, so the work is in
    proportion to tokens and spans."""
    reach = lambda start, end: F.explode(F.sequence(
        F.floor(start / _STRETCH), F.floor((end - 1) / _STRETCH))).alias("stretch")
    of = lambda array: scanned.select("row", F.explode(array).alias("x")).select(
        "row", *[F.col(f"x.{c}").alias(f"{array}_{c}") for c in (("start", "end", "kind") if array == "base" else ("start", "end"))],
        reach(F.col("x.start"), F.col("x.end")))
    met = of("tokens").join(of("base"), ["row", "stretch"]).where("base_start < tokens_end AND tokens_start < base_end")
    return (met.groupBy(F.col("row").alias("seed_row"), F.col("tokens_start").alias("seed_start"))
            .agg(F.min(F.struct("base_start", "base_kind"))["base_kind"].alias("seed")))


def discover(scanned: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, start, kind, end) of tokens that trusted patterns find and no rule does."""
    tokens = scanned.select("row", F.explode("tokens").alias("t"))
    occurrences = written(
        tokens.join(_seeds(scanned), (F.col("row") == F.col("seed_row")) & (F.col("t.start") == F.col("seed_start")), "left")
        .select("row", "t.start", "t.end", "t.value", "seed", _patterns(F.col("t.left"), F.col("t.right")).alias("patterns")),
        "pii_tokens")
    graph = written(occurrences.select("value", F.explode("patterns").alias("pattern")).distinct(), "pii_graph")
    size = graph.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = (occurrences.where("seed is not null").groupBy("value").agg(F.min("seed").alias("kind"))
             .withColumn("score", F.lit(1.0)))
    trusted, good = seeds, None
    for _ in range(rounds):
        support = (graph.join(trusted, "value").groupBy("pattern", "kind")
                   .agg(F.sum("score").alias("weight"), F.count("*").alias("support")))
        good = written(support.join(size, "pattern")
                       .withColumn("confidence", F.col("weight") / (F.col("n") + SMOOTH))
                       .where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_PATTERN))
                       .select("pattern", "kind", "confidence"), "pii_patterns")
        missed = F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))
        new = (graph.join(good, "pattern").join(seeds.select("value"), "value", "left_anti")
               .groupBy("value", "kind").agg((1 - missed).alias("score")).where(F.col("score") >= MIN_VALUE)
               .groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("best"))
               .select("value", "best.kind", "best.score"))
        trusted = written(seeds.unionByName(new), "pii_values")
    return (occurrences.where("seed is null")
            .select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
            .join(good.select("pattern", "kind"), "pattern").join(trusted.select("value", "kind"), ["value", "kind"])
            .select("row", "start", "kind", "end").distinct())


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(scanned: DataFrame) -> DataFrame:
    """The scan with ``spans``: base spans and discovered ones, by start, then kind."""
    more = written(discover(scanned).groupBy("row").agg(
        F.collect_list(F.struct("start", "kind", "end")).cast(_SPAN).alias("more")), "pii_found")
    return (scanned.join(more, "row", "left")
            .withColumn("spans", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPAN))))))


def find(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    return with_spans(scan(docs)).select(
        "doc_id", *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; where spans overlap, what
    an earlier one covers is not written again."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def step(done: Column, s: Column) -> Column:
        inside = s["end"] <= done["at"]
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"),
                        F.when(inside, done["out"]).otherwise(
                            F.concat(done["out"], F.array(gap, F.get(names, s["kind"])))).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(spans, begin, step, lambda done: F.concat(
        F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span masked in ``text`` and ``n_chars``, if there is such a
    column, counted anew; rows without spans stay as they are."""
    found = with_spans(scan(docs, keep_rows=True))
    text = F.col("input.text")
    changed = F.when(F.size("spans") > 0, masked(text, F.col("spans"))).otherwise(text)
    out = found.withColumn("new", changed)
    return out.select(*[
        F.col("new").alias(c) if c == "text" else
        F.when(F.size("spans") > 0, F.length("new").cast(docs.schema[c].dataType))
        .otherwise(F.col(f"input.`{c}`")).alias(c) if c == "n_chars" else
        F.col(f"input.`{c}`").alias(c) for c in docs.columns])
