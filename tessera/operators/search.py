"""Weighted multi-level cosine search of a query table against the postings (Q2-Q8).

Plan shape, for a whole table of queries at once:

1. query vectors: tokens -> TF (no IDF) and the query vector length, per query;
2. inverted-index lookup: equi-join of query terms with postings on ``term`` (only the
   postings of terms some query uses take part; up to ``BROADCAST_ROWS`` query terms, counted
   before, are broadcast, otherwise both sides shuffle on ``term``);
3. one aggregation per (query, chunk) gives the three per-level dot products and the
   carried vector lengths -> cosines -> weighted composite -> matched level;
   (:mod:`tessera.operators.topk` skips chunks that cannot be among the top k);
4. top-k per query with ``row_number`` (Spark inserts a partial ``WindowGroupLimit`` before
   the shuffle, so at most k rows per query and partition move);
5. zero-score fill: queries with fewer than k scored chunks take the highest-index chunks
   not already hit, as the reference order puts them next.  The k fill candidates come
   from a global top-k (a scalar subquery), so nothing grows with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions import text as X
from tessera.operators.pyramid import CHUNK_KEY

RANK_DIGITS = 10   # ranking uses the composite rounded here; see README "Deviations"
SCORE_DIGITS = 4
#: Query terms, and pairs of query and block, that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def fits(rows: DataFrame, most: int | None = None) -> bool:
    """Whether ``rows`` may be broadcast."""
    most = BROADCAST_ROWS if most is None else most
    return rows.limit(most + 1).count() <= most


def query_vectors(queries: DataFrame, id_col: str = "query_id",
                  text_col: str = "query") -> DataFrame:
    """Q2: ``(query_id, term, qtf, qnorm)``.  Queries without tokens have no rows."""
    q = (queries.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("_q"))
         .repartition("query_id"))
    arrays = q.select("query_id", X.tokenize("_q").alias("_toks")).select(
        "query_id", F.size("_toks").alias("n"), "_toks")
    counts = (arrays.select("query_id", "n", F.explode("_toks").alias("term"))
              .groupBy("query_id", "n", "term").agg(F.count(F.lit(1)).alias("cnt")))
    tf = counts.select("query_id", "term", (F.col("cnt") / F.col("n")).alias("qtf"))
    per_query = Window.partitionBy("query_id")
    return tf.withColumn("qnorm", F.sqrt(F.sum(F.col("qtf") * F.col("qtf")).over(per_query)))


def cosine_scores(qvec: DataFrame, postings: DataFrame, level: str | None = None,
                  weights: dict | None = None) -> DataFrame:
    """Q3 + Q4 + Q5 for every (query, chunk) pair sharing at least one term.

    ``(query_id, doc_id, chunk_no, raw_score, summary_score, keywords_score, composite,
    matched_level)``.  With ``level`` set, other levels score 0 but keep their weights.
    ``weights`` overrides the level weights of the composite.
    """
    if level is not None and level not in K.LEVELS:
        raise ValueError(f"level must be one of {K.LEVELS}")
    p = postings if level is None else postings.where(F.col("level") == level)
    side = F.broadcast(qvec) if fits(qvec) else qvec   # the postings do not move for a few query terms
    matches = p.select(*CHUNK_KEY, "level", "term", "weight", "norm").join(side, "term")
    prod = F.col("qtf") * F.col("weight")
    aggs = []
    for lv in K.LEVELS:
        at = F.col("level") == lv
        aggs.append(F.sum(F.when(at, prod)).alias(f"dot_{lv}"))
        aggs.append(F.max(F.when(at, F.col("norm"))).alias(f"norm_{lv}"))
    return composite_of(matches.groupBy("query_id", *CHUNK_KEY).agg(F.max("qnorm").alias("qnorm"), *aggs), weights)


def composite_of(grouped: DataFrame, weights: dict | None = None) -> DataFrame:
    """Cosines, composite and matched level from the dot products and vector lengths of each
    (query, chunk)."""
    cos = {lv: F.coalesce(F.col(f"dot_{lv}") /
                          (F.col("qnorm") * F.col(f"norm_{lv}") + F.lit(K.COSINE_EPSILON)),
                          F.lit(0.0))
           for lv in K.LEVELS}
    w = dict(K.LEVEL_WEIGHTS, **(weights or {}))
    scored = grouped.select("query_id", *CHUNK_KEY,
                            *[cos[lv].alias(f"{lv}_score") for lv in K.LEVELS])
    composite = (F.lit(w["raw"]) * F.col("raw_score")
                 + F.lit(w["summary"]) * F.col("summary_score")
                 + F.lit(w["keywords"]) * F.col("keywords_score"))
    # argmax on scores rounded like the ranking: equal vectors summed in another order
    # must still tie (and a tie goes to the earlier level)
    matched = X.first_max_label([(lv, F.round(f"{lv}_score", RANK_DIGITS)) for lv in K.LEVELS])
    return scored.select("*", composite.alias("composite"), matched.alias("matched_level"))


def rank_order():
    """Order of a query's hits: ties in the composite go to the higher index."""
    return Window.partitionBy("query_id").orderBy(
        F.round("composite", RANK_DIGITS).desc(), F.col("doc_id").desc(), F.col("chunk_no").desc())


def _top_k(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(rank_order())).where(F.col("rank") <= k)


def search(queries: DataFrame, postings: DataFrame, chunks: DataFrame, top_k: int = K.SEARCH_TOP_K,
           level: str | None = None, id_col: str = "query_id", text_col: str = "query",
           weights: dict | None = None) -> DataFrame:
    """Q6-Q8: top-k chunks per query.

    ``chunks`` supplies the chunk ids and the index order for zero-score fill
    (``doc_id, chunk_no, chunk_id``).  Output: ``query_id, rank, doc_id, chunk_no,
    chunk_id, score (4 dp), level``; ties in the composite go to the higher index.
    """
    qvec = query_vectors(queries, id_col, text_col)
    return fill_and_rank(qvec, cosine_scores(qvec, postings, level, weights), chunks, top_k)


def fill_and_rank(qvec: DataFrame, scores: DataFrame, chunks: DataFrame, top_k: int) -> DataFrame:
    """The ``top_k`` of each query's scored chunks, filled up with unscored ones."""
    hits = (_top_k(scores, top_k)
            .select("query_id", *CHUNK_KEY, "composite", "matched_level",
                    F.lit(1).alias("scored")))
    # Zero-score fill: the k highest-index chunks of the index, as one array value, offered
    # to every query that has tokens.  A chunk that is both a hit and a fill candidate keeps
    # its scored row; the collapse runs over at most 2k rows per query, and `hits` is
    # referenced once, so the scoring is not planned twice.
    fill_pool = (chunks.select(*CHUNK_KEY).orderBy(F.col("doc_id").desc(), F.col("chunk_no").desc())
                 .limit(top_k)
                 .agg(F.collect_list(F.struct(*CHUNK_KEY)).alias("pool")))
    with_tokens = qvec.select("query_id").distinct()
    fill = (with_tokens.select("query_id", F.explode(fill_pool.select("pool").scalar()).alias("c"))
            .select("query_id", "c.doc_id", "c.chunk_no", F.lit(0.0).alias("composite"),
                    F.lit("raw").alias("matched_level"), F.lit(0).alias("scored")))
    best = F.max_by(F.struct("composite", "matched_level"), "scored")
    candidates = (hits.unionByName(fill).groupBy("query_id", *CHUNK_KEY)
                  .agg(best.alias("b"))
                  .select("query_id", *CHUNK_KEY, "b.composite", "b.matched_level"))
    ranked = _top_k(candidates, top_k)
    ids = chunks.select(*CHUNK_KEY, "chunk_id")
    return (ranked.join(ids, CHUNK_KEY, "inner")
            .select("query_id", F.col("rank").cast("int").alias("rank"), *CHUNK_KEY, "chunk_id",
                    F.round("composite", SCORE_DIGITS).alias("score"),
                    F.col("matched_level").alias("level")))
