"""Top-k search that scores only blocks of chunks that can reach the k-th score (Q3-Q8).

1. Query terms get their idf and their place in the index: folders of no query term are not read
   (the buckets in use are a broadcast of at most ``term_buckets`` rows, and prune the scans of
   terms, bounds and postings when the query runs).
2. Bound of a block: the sum over the query's terms and levels of the largest weight that any
   chunk of the block has for the term.  No chunk of the block has a larger composite.
3. The blocks with the largest bounds are scored first, as many as the hits that are wanted; the
   k-th composite among their chunks is one that the answer has to reach.
4. Blocks whose bound reaches it are scored, all others never.  Ties are kept: the threshold is
   lower by a margin far above the rounding of sums and equal to what ranking rounds away.

The result is that of scoring everything: same hits, scores, levels and order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.operators.pyramid import CHUNK_KEY
from tessera.operators.search import (BROADCAST_ROWS, composite_of, fill_and_rank, fits, query_vectors, rank_order,
                                      RANK_DIGITS)
from tessera.operators.segments import Version, term_bucket
from tessera.session import materialize

#: Blocks that are scored first for every hit that is wanted.
SEEDS = 8
MARGIN = 2 * 10.0 ** -RANK_DIGITS


def _levels(level: str | None) -> list[str]:
    if level is not None and level not in K.LEVELS:
        raise ValueError(f"level must be one of {K.LEVELS}")
    return [level] if level else list(K.LEVELS)


def in_used_folders(table: DataFrame, terms: DataFrame, term_buckets: int) -> DataFrame:
    """``table`` without the folders of buckets that no row of ``terms`` (bucket) has.  The filter
    on the bucket is always true; a scan is only pruned by a side that filters something."""
    # Spark would build Bloom filters for the query side from scans of the index that are not pruned
    table.sparkSession.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    used = terms.select("bucket").distinct().where((F.col("bucket") >= 0) & (F.col("bucket") < term_buckets))
    return table.join(F.broadcast(used), "bucket", "left_semi")


def _fits(rows: DataFrame) -> bool:
    """Whether ``rows`` (materialised) may be broadcast."""
    return fits(rows, BROADCAST_ROWS)


class BoundedSearch:
    """The steps of a search of ``queries`` (query_id, query) in a version."""

    def __init__(self, version: Version, queries: DataFrame, top_k: int = K.SEARCH_TOP_K, level: str | None = None,
                 weights: dict | None = None, id_col: str = "query_id", text_col: str = "query"):
        self.version, self.top_k, self.levels = version, top_k, _levels(level)
        self.weights = dict(K.LEVEL_WEIGHTS, **(weights or {}))
        self.qvec = materialize(query_vectors(queries, id_col, text_col)
                                .withColumn("bucket", term_bucket("term", version.term_buckets)))

    def _of_query_terms(self, table: DataFrame) -> DataFrame:
        """Rows of folders that a query term is in."""
        return in_used_folders(table, self.qvec, self.version.term_buckets)

    def _at_levels(self, rows: DataFrame, prefix: str) -> DataFrame:
        """``rows`` with the columns of the levels in use.  Rows without a value at any of them have
        no part in a search of some levels only."""
        if len(self.levels) < len(K.LEVELS):
            rows = rows.where(F.coalesce(*[F.col(f"{prefix}{lv}") for lv in self.levels]).isNotNull())
        return rows.drop(*[f"{prefix}{lv}" for lv in K.LEVELS if lv not in self.levels])

    def query_terms(self) -> DataFrame:
        """``(query_id, term, qnorm, factor_raw, ..)``; factor: query tf times idf."""
        known = self._at_levels(self._of_query_terms(self.version.terms), "df_")
        factors = [(F.col("qtf") * self.version.idf(F.col(f"df_{lv}"))).alias(f"factor_{lv}") for lv in self.levels]
        return materialize(self.qvec.join(known, "term").select("query_id", "term", "qnorm", *factors))

    def block_bounds(self, terms: DataFrame) -> DataFrame:
        """``(query_id, block, bound)`` of every block that has a term of the query.  A negative
        weight can only lower a composite."""
        share = sum((F.lit(max(0.0, self.weights[lv])) * F.coalesce(F.col(f"factor_{lv}") * F.col(f"top_{lv}"), F.lit(0.0))
                     for lv in self.levels), F.lit(0.0)) / F.col("qnorm")
        side = F.broadcast(terms) if _fits(terms) else terms
        of_pages = self._of_query_terms(self.version.bounds_by_page).join(side, "term")
        tops = self._at_levels(of_pages.select(*terms.columns, F.inline("entries")), "top_")
        return materialize(tops.groupBy("query_id", "block").agg(F.sum(share).alias("bound")))

    def matches(self, pairs: DataFrame, terms: DataFrame) -> DataFrame:
        """Postings of the query's terms in its ``pairs`` (query_id, block): the rows that enter
        the aggregation of scores.  Few pairs and terms go to the postings where they are read;
        otherwise both meet by term and block, so that no posting of another block is matched."""
        of_pages = reduce(DataFrame.unionByName, [self._of_query_terms(p) for p in self.version.postings_by_page])
        small = _fits(pairs) and _fits(terms)
        if small:
            of_pages = of_pages.join(F.broadcast(terms), "term")
        rows = of_pages.select(*(terms.columns if small else ["term"]), F.inline("entries")).drop("slot", "place")
        postings = self._at_levels(rows, "")
        if small:
            return postings.join(F.broadcast(pairs), ["query_id", "block"], "left_semi")
        return postings.join(terms.join(pairs, "query_id"), ["term", "block"])

    def scores(self, pairs: DataFrame, terms: DataFrame) -> DataFrame:
        """Cosines, composite and matched level of every live chunk of ``pairs`` that has a term."""
        dots = [F.sum(F.col(f"factor_{lv}") * F.col(lv)).alias(f"dot_{lv}") for lv in self.levels]
        grouped = (self.matches(pairs, terms).groupBy("query_id", *CHUNK_KEY, "block")
                   .agg(F.max("qnorm").alias("qnorm"), *dots))
        norms = self.version.live.select(*CHUNK_KEY, "block", *[f"norm_{lv}" for lv in self.levels])
        grouped = grouped.join(norms, [*CHUNK_KEY, "block"])
        if len(self.levels) < len(K.LEVELS):
            # a chunk is found by the levels that are searched
            none = F.lit(None).cast("double")
            grouped = grouped.where(F.coalesce(*[F.col(f"dot_{lv}") for lv in self.levels]).isNotNull()).select(
                "*", *[none.alias(f"{c}_{lv}") for lv in K.LEVELS if lv not in self.levels for c in ("dot", "norm")])
        return composite_of(grouped, self.weights)

    def surviving_blocks(self, bounds: DataFrame, terms: DataFrame) -> DataFrame:
        """``(query_id, block)`` of the blocks that can reach the k-th composite."""
        by_bound = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
        seeds = materialize(bounds.withColumn("n", F.row_number().over(by_bound)).where(F.col("n") <= SEEDS * self.top_k)
                            .select("query_id", "block"))
        place = F.row_number().over(rank_order())
        reached = (self.scores(seeds, terms).withColumn("place", place).where(F.col("place") <= self.top_k)
                   .groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("composite").alias("least"))
                   .where(F.col("n") == self.top_k).select("query_id", "least"))
        return materialize(bounds.join(reached, "query_id", "left")
                           .where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - MARGIN))
                           .select("query_id", "block"))

    def hits(self) -> DataFrame:
        terms = self.query_terms()
        bounds = self.block_bounds(terms)
        return fill_and_rank(self.qvec, self.scores(self.surviving_blocks(bounds, terms), terms),
                             self.version.live, self.top_k)


def search_version(version: Version, queries: DataFrame, top_k: int = K.SEARCH_TOP_K, level: str | None = None,
                   weights: dict | None = None, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    """Q6-Q8 from a version: ``query_id, rank, doc_id, chunk_no, chunk_id, score, level``."""
    return BoundedSearch(version, queries, top_k, level, weights, id_col, text_col).hits()
