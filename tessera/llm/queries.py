"""Registered queries of the operators: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, dedup, exact, fingerprint, langid, lm, packing, pii, quality, spelling, urlfilter, warc,
                         whitening)
from tessera.llm.common import table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


@register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again (operator 10)."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                             public_tokenizers.PATTERN)


@register("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every whole text and the verdict of the trees (operator 8)."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the documents of three folds of four
    (operator 9)."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    return langid.predict(docs, langid.fit(docs.where(~F.col("held_out"))))


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens (operator 7)."""
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


@register("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of two-word shingles (operator 5)."""
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), dedup.Parameters(shingle=2))


@register("op2_lm_scores")
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a word unigram base and the attention model, both learned
    from six folds of seven (operator 2)."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(modulus=7))
    return lm.score(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op1_personal_data")
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: validated rules and what their contexts discover
    (operator 1)."""
    return pii.find(table(spark, sf_dir, "documents"))


@register("op3_lz_fingerprints")
def op3_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's fingerprint against its edited text's and the next document's
    (operator 3)."""
    return fingerprint.compare_neighbours(table(spark, sf_dir, "documents"))


@register("op4_warc_round_trip")
def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the archives (operator 4)."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def _captures(pages: DataFrame) -> DataFrame:
    """Stand-in captures: pages have no date of their own."""
    return pages.select("page_id", "url", F.expr("date_add(DATE '2020-01-01', CAST(page_id * 37 % 1000 AS INT))")
                        .alias("fetched_on"))


def _list_changes(pages: DataFrame) -> DataFrame:
    """Stand-in list: dated additions and removals of the domains, hosts and directories that
    the pages have."""
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    day = lambda n: f"date_add(DATE '2020-01-01', CAST(page_id * {n} % 997 AS INT))"
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).where("host <> ''").selectExpr(
        "*", "regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS parent", "regexp_extract(path, '^(/[^/]*/)', 1) AS folder")
    parts = [rows.selectExpr("'domain' AS scope", "parent AS value", "'block' AS action", "page_id % 3 = 0 AS added",
                             f"{day(53)} AS on"),
             rows.selectExpr("'host' AS scope", "host AS value", "'allow' AS action", "page_id % 5 < 2 AS added",
                             f"{day(71)} AS on"),
             rows.selectExpr("'prefix' AS scope", "concat(host, folder) AS value", "'block' AS action",
                             "page_id % 2 = 0 AS added", f"{day(29)} AS on").where("value LIKE '%/'")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_DUCK_HOST = "regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)"
_DUCK_PATH = "regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1)"
_URL_SQL = f"""
WITH parts AS (
  SELECT page_id, url, {_DUCK_HOST} AS host, {_DUCK_PATH} AS path,
         DATE '2020-01-01' + CAST(page_id * 37 % 1000 AS INT) AS fetched_on FROM pages),
named AS (
  SELECT *, regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS parent, regexp_extract(path, '^(/[^/]*/)', 1) AS folder
  FROM parts WHERE host <> ''),
changes AS (
  SELECT 'domain' AS scope, parent AS value, 'block' AS action, page_id % 3 = 0 AS added,
         DATE '2020-01-01' + CAST(page_id * 53 % 997 AS INT) AS d FROM named
  UNION ALL SELECT 'host', host, 'allow', page_id % 5 < 2, DATE '2020-01-01' + CAST(page_id * 71 % 997 AS INT) FROM named
  UNION ALL SELECT 'prefix', host || folder, 'block', page_id % 2 = 0, DATE '2020-01-01' + CAST(page_id * 29 % 997 AS INT)
  FROM named WHERE host || folder LIKE '%/'),
days AS (SELECT scope, value, action, d, bool_or(added) AS added FROM changes GROUP BY ALL),
keys AS (
  SELECT DISTINCT page_id, url, fetched_on, 'domain' AS scope,
         array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS value
  FROM named, unnest(range(1, len(string_split(host, '.')))) AS t(i)
  UNION ALL SELECT DISTINCT page_id, url, fetched_on, 'host', host FROM named
  UNION ALL SELECT DISTINCT page_id, url, fetched_on, 'prefix',
         host || array_to_string(list_slice(string_split(path, '/'), 1, i), '/') || '/'
  FROM named, unnest(range(1, len(string_split(path, '/')))) AS t(i) WHERE path <> ''),
latest AS (
  SELECT k.page_id, k.scope, k.value, y.action, max(y.d) AS d
  FROM keys k JOIN days y ON k.scope = y.scope AND k.value = y.value AND y.d <= k.fetched_on GROUP BY ALL),
active AS (
  SELECT l.page_id, l.scope, l.value, l.action,
         (SELECT min(z.d) FROM days z WHERE z.scope = l.scope AND z.value = l.value AND z.action = l.action
            AND z.added AND z.d <= l.d AND z.d > coalesce((SELECT max(r.d) FROM days r WHERE r.scope = l.scope
              AND r.value = l.value AND r.action = l.action AND NOT r.added AND r.d < l.d), DATE '1900-01-01')) AS since
  FROM latest l JOIN days y ON l.scope = y.scope AND l.value = y.value AND l.action = y.action AND l.d = y.d
  WHERE y.added),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY list_position(['domain', 'host', 'prefix'], scope) DESC,
                               length(value) DESC, action = 'block' DESC) AS best FROM active),
sums AS (
  SELECT page_id, count(*) FILTER (action = 'block') AS n_block, count(*) FILTER (action = 'allow') AS n_allow
  FROM active GROUP BY page_id)
SELECT p.page_id, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow, coalesce(r.action, 'none') AS verdict,
       coalesce(r.scope || ':' || r.value, '') AS entry, CAST(r.since AS VARCHAR) AS since
FROM pages p LEFT JOIN sums USING (page_id) LEFT JOIN (SELECT * FROM ranked WHERE best = 1) r USING (page_id)
"""


@register("op6_url_lists", _URL_SQL)
def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries in force when it was fetched (operator 6)."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.evaluate(_captures(pages), _list_changes(pages))


_EXACT_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY body)
"""


@register("op12_exact_duplicates", _EXACT_SQL)
def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the row that stays of its group of equal texts (operator 12)."""
    return exact.label(table(spark, sf_dir, "documents"))


@register("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all whole texts with their standard forms (operator 11)."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first four whitened components (operator 13)."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
