"""Four-layer pyramid per chunk (Q1): raw text, summary, category and keywords.

Every layer depends on one chunk row only, so all of them are projections of the chunk
table: terms are counted inside the row (a sorted array of (term, position) pairs, whose
runs are the terms), and nothing is shuffled.  The index explodes the counted terms once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions import text as X

CHUNK_KEY = ["doc_id", "chunk_no"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once per row (an expression that a lambda captures
    would be evaluated for every element)."""
    return F.get(F.transform(F.array(value), body), 0)


def count_terms(tokens: Column) -> Column:
    """``array<struct<first_pos, cnt, term>>`` of a token array, by first position: runs of
    the sorted (term, position) pairs."""
    def runs(pairs: Column) -> Column:
        starts = F.filter(F.transform(pairs, lambda _, i: i), lambda i: (i == 0) | (
            F.get(pairs, i - 1)["term"] != F.get(pairs, i)["term"]))
        return _let(starts, lambda at: F.transform(at, lambda i, n: F.struct(
            F.get(pairs, i)["pos"].alias("first_pos"),
            (F.coalesce(F.get(at, n + 1), F.size(pairs)) - i).cast("long").alias("cnt"),
            F.get(pairs, i)["term"].alias("term"))))

    return F.array_sort(_let(F.array_sort(F.transform(tokens, lambda t, i: F.struct(
        t.alias("term"), i.alias("pos")))), runs))


def top_terms(terms: Column, k: int) -> Column:
    """The ``k`` most frequent terms of :func:`count_terms`; equal counts keep the order of
    first occurrence."""
    ranked = F.array_sort(F.transform(terms, lambda t: F.struct(
        (-t["cnt"]).alias("c"), t["first_pos"].alias("p"), t["term"].alias("term"))))
    return F.transform(F.slice(ranked, 1, k), lambda t: t["term"])


class PyramidParts:
    """The pieces of the pyramid over one chunk table, as projections of it.

    ``base``: chunk key, chunk_id, start_char, end_char, raw_text, summary, category.
    ``pyramid``: the same with ``keywords``.
    ``terms``: chunk key and, for each level, its number of tokens and its counted terms.
    """

    def __init__(self, chunks: DataFrame, top_k: int = K.KEYWORDS_TOP_K, summariser=None,
                 rules=K.CATEGORY_RULES, n_sentences: int = K.SUMMARY_SENTENCES):
        self.chunks = chunks.select(*CHUNK_KEY, "chunk_id", "start_char", "end_char",
                                    F.col("text").alias("raw_text"))
        self.top_k, self.rules = top_k, rules
        self.summary = summariser or (lambda text: X.summarise(text, n_sentences))
        self._paged: tuple[DataFrame, DataFrame] | None = None

    def paged(self) -> tuple[DataFrame, DataFrame]:
        """Windows and term frequencies of these chunks, written once to the shared folder and
        read in place from then on (:mod:`tessera.operators.paged`)."""
        from tessera.operators import paged as P
        from tessera.session import shared_dir
        if self._paged is None:
            spark = self.chunks.sparkSession
            windows = P.write_windows(self, shared_dir(spark, "windows"))
            self._paged = windows, P.write_counts(windows, shared_dir(spark, "counts"), P.bucket_count(spark), self.top_k)
        return self._paged

    @property
    def base(self) -> DataFrame:
        return self.categorised(self.chunks.select("*", self.summary(F.col("raw_text")).alias("summary")))

    def categorised(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with raw_text) and ``category``.  The lower-cased text is a projection of its
        own: the category tests it many times."""
        scored = X.with_categories(rows.select("*", F.lower("raw_text").alias("_lower")), "_lower", self.rules)
        return scored.select(*rows.columns, "category")

    @property
    def pyramid(self) -> DataFrame:
        """One row per chunk with all four layers (chunks without tokens get ``[]``)."""
        counted = self.base.withColumn("_terms", count_terms(X.tokenize("raw_text")))
        return counted.withColumn("keywords", top_terms(F.col("_terms"), self.top_k)).drop("_terms")

    def terms(self, levels=K.LEVELS) -> DataFrame:
        """``(key.., level, n_tokens, term, cnt)`` of the requested levels: one pass over the
        chunks and one explode."""
        raw = count_terms(X.tokenize("raw_text"))
        short = count_terms(X.tokenize(self.summary(F.col("raw_text"))))
        out = self.chunks.select(*CHUNK_KEY, raw.alias("_raw"), *([short.alias("_short")] if "summary" in levels else []))
        total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, t: n + t["cnt"]).cast("int")
        pairs = lambda a: F.transform(a, lambda t: F.struct(t["term"].alias("term"), t["cnt"].alias("cnt")))
        parts = {"raw": lambda: (total(F.col("_raw")), pairs(F.col("_raw"))),
                 "summary": lambda: (total(F.col("_short")), pairs(F.col("_short"))),
                 "keywords": lambda: (F.size("_kw"), F.transform("_kw", lambda t: F.struct(
                     t.alias("term"), F.lit(1).cast("long").alias("cnt"))))}
        if "keywords" in levels:
            out = out.withColumn("_kw", top_terms(F.col("_raw"), self.top_k))
        rows = F.array(*[F.struct(F.lit(lv).alias("level"), parts[lv]()[0].alias("n_tokens"), parts[lv]()[1].alias("terms"))
                         for lv in K.LEVELS if lv in levels])
        return (out.select(*CHUNK_KEY, F.inline(rows))
                .select(*CHUNK_KEY, "level", "n_tokens", F.inline("terms")))


def build_pyramid(chunks: DataFrame, **kwargs) -> DataFrame:
    """``chunks`` -> pyramid: doc_id, chunk_no, chunk_id, start_char, end_char, raw_text,
    summary, category, keywords ARRAY<STRING>.  ``summariser`` (optional ``Column ->
    Column``), ``rules``, ``top_k`` and ``n_sentences`` are tunable."""
    return PyramidParts(chunks, **kwargs).pyramid
