"""TF-IDF statistics and the inverted index.

Long form throughout: one row per (chunk, level, term).  The three pyramid levels are one
``level`` column, so every aggregate is grouped by level; ``levels=`` restricts a build to
the levels a search needs (statistics are per level, so the result is the same).

``scope="corpus"``: N and document frequencies over all chunks.  ``scope="document"``:
per source document, which is what indexing one document at a time gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.operators import paged as P
from tessera.operators.pyramid import CHUNK_KEY, PyramidParts

SCOPES = ("corpus", "document")


def _scope_cols(scope: str) -> list[str]:
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    return ["doc_id"] if scope == "document" else []


def level_counts(parts: PyramidParts, levels=K.LEVELS) -> DataFrame:
    """Term counts of every requested level: ``(doc_id, chunk_no, level, n_tokens, term,
    cnt)``.  Keywords are distinct tokens already, so each counts once."""
    return parts.terms(levels)


def term_frequency(counts: DataFrame) -> DataFrame:
    """A1: tf = count / max(number of tokens, 1)."""
    return counts.select(*CHUNK_KEY, "level", "term",
                         (F.col("cnt") / F.greatest(F.col("n_tokens"), F.lit(1))).alias("tf"))


def chunk_totals(parts: PyramidParts, scope: str) -> DataFrame:
    """N per scope: number of chunks, counting chunks without any token."""
    cols = _scope_cols(scope)
    return parts.chunks.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_chunks"))


def document_frequency(tf: DataFrame, scope: str) -> DataFrame:
    """A2: number of chunks of the scope that contain the term (rows are distinct per
    chunk, so a plain count; partial aggregation collapses frequent terms map-side)."""
    return (tf.groupBy(*_scope_cols(scope), "level", "term")
            .agg(F.count(F.lit(1)).alias("df")))


def inverse_document_frequency(df: DataFrame, totals: DataFrame, scope: str) -> DataFrame:
    """A3: idf = ln((N + 1) / (df + 1)) + 1."""
    cols = _scope_cols(scope)
    if cols:
        joined = df.join(totals, cols, "inner")
    else:
        # one corpus-wide N: a scalar subquery, evaluated once and inlined as a value
        joined = df.withColumn("n_chunks", totals.select("n_chunks").scalar())
    return joined.select(*cols, "level", "term", "df", "n_chunks",
                         (F.log((F.col("n_chunks") + 1) / (F.col("df") + 1)) + 1.0).alias("idf"))


def build_postings(parts: PyramidParts, scope: str = "corpus", levels=K.LEVELS) -> DataFrame:
    """A4 + A5: ``postings(doc_id, chunk_no, level, term, tf, idf, weight, norm)``.

    ``norm`` (the chunk's vector length at that level) is carried on every posting so a
    search needs no second join to normalise.  Counts never leave their page: the idf goes to
    every page that has the term, and weights and norms are computed there, a page at a time.
    With ``scope="document"`` only terms of documents that lie in several pages travel.
    """
    windows, counts = parts.paged()
    if _scope_cols(scope):
        rows = P.document_weights(windows, counts, list(levels))
    else:
        dfs = counts.groupBy("term").agg(*[F.sum(f"df_{lv}").alias(f"df_{lv}") for lv in K.LEVELS])
        n = windows.agg(F.count(F.lit(1)).alias("n")).scalar()
        idf = dfs.withColumn("n", n).select(
            "term", *[P.idf_of(F.col(f"df_{lv}"), F.col("n")).alias(f"idf_{lv}") for lv in levels])
        rows = P.corpus_weights(counts, idf, list(levels))
    named = F.when(F.col("level_no") == 0, levels[0])
    for i, lv in enumerate(levels[1:], 1):
        named = named.when(F.col("level_no") == i, lv)
    return rows.select(*CHUNK_KEY, named.alias("level"), "term", "tf", "idf", "weight", "norm")


def vector_norms(postings: DataFrame) -> DataFrame:
    """A5 as a table: one row per (chunk, level) with its vector length."""
    return postings.groupBy(*CHUNK_KEY, "level").agg(F.max("norm").alias("norm"))
