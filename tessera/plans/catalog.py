"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, base_dir)`` and returns a DataFrame over the tables in
``base_dir``.  Most are lazy; index builds write their term frequencies when called, and the
round-trip and streaming builders first write their output to the shared folder and return
the read-back.  Output columns are named identically in the Spark plan
and the SQL; doubles are rounded (``R``) to 6 decimals in both, arrays are flattened to
strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions import text as X
from tessera.operators import corpus as C
from tessera.operators.chunking import chunk_documents
from tessera.operators.long_texts import chunk_files
from tessera.operators.pyramid import PyramidParts
from tessera.operators.search import cosine_scores, query_vectors, search
from tessera.plans import oracle as O
from tessera.plans import standins as SI
from tessera.plans.ingest import delete_documents, ingest_documents, search_index
from tessera.session import shared_dir, spread
from tessera.sources import tables as TB

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
R = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _r(c, d: int = R):
    return F.round(c, d)


# ---------------------------------------------------------------------------------------
# P: windows, pyramid, TF-IDF, search
# ---------------------------------------------------------------------------------------

def _docs(spark: SparkSession, base: str) -> DataFrame:
    return spread(TB.documents(spark, base))


def _parts(spark: SparkSession, base: str) -> PyramidParts:
    return PyramidParts(chunk_documents(_docs(spark, base)))


@register("chunk_windows", O.with_(O.chunks_cte(), "SELECT * FROM chunks"))
def chunk_windows(spark, base):
    return chunk_documents(_docs(spark, base))


@register("tokens", f"""SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS pos, u.token
FROM (SELECT doc_id, {O.tokenize_sql('text')} AS toks FROM documents) d,
     unnest(d.toks) WITH ORDINALITY AS u(token, pos)""")
def tokens(spark, base):
    return (TB.documents(spark, base)
            .select("doc_id", F.posexplode(X.tokenize("text")).alias("pos", "token"))
            .select("doc_id", F.col("pos").cast("int").alias("pos"), "token"))


@register("chunk_summary", O.with_(O.pyramid_cte(),
                                   "SELECT doc_id, chunk_no, summary FROM pyramid"))
def chunk_summary(spark, base):
    return _parts(spark, base).base.select("doc_id", "chunk_no", "summary")


@register("chunk_category", O.with_(O.pyramid_cte(),
                                    "SELECT doc_id, chunk_no, category FROM pyramid"))
def chunk_category(spark, base):
    return _parts(spark, base).base.select("doc_id", "chunk_no", "category")


@register("chunk_keywords", O.with_(
    O.pyramid_cte(),
    "SELECT doc_id, chunk_no, array_to_string(keywords, ' ') AS keywords, "
    "CAST(len(keywords) AS INTEGER) AS n_keywords FROM pyramid"))
def chunk_keywords(spark, base):
    p = _parts(spark, base).pyramid
    return p.select("doc_id", "chunk_no", F.array_join("keywords", " ").alias("keywords"),
                    F.size("keywords").alias("n_keywords"))


@register("pyramid", O.with_(
    O.pyramid_cte(),
    "SELECT doc_id, chunk_no, chunk_id, start_char, end_char, raw_text, summary, category, "
    "array_to_string(keywords, ',') AS keywords FROM pyramid"))
def pyramid(spark, base):
    p = _parts(spark, base).pyramid
    return p.withColumn("keywords", F.array_join("keywords", ","))


@register("term_frequency", O.with_(
    O.postings_cte(),
    "SELECT doc_id, chunk_no, level, term, round(tf, 6) AS tf FROM tf"))
def term_frequency(spark, base):
    tf = C.term_frequency(C.level_counts(_parts(spark, base)))
    return tf.select("doc_id", "chunk_no", "level", "term", _r("tf").alias("tf"))


@register("document_frequency", O.with_(O.postings_cte(), "SELECT level, term, df FROM dfreq"))
def document_frequency(spark, base):
    tf = C.term_frequency(C.level_counts(_parts(spark, base)))
    return C.document_frequency(tf, "corpus")


def _idf(spark, base, scope):
    parts = _parts(spark, base)
    tf = C.term_frequency(C.level_counts(parts))
    return C.inverse_document_frequency(C.document_frequency(tf, scope),
                                        C.chunk_totals(parts, scope), scope)


@register("idf", O.with_(
    O.postings_cte(),
    "SELECT level, term, df, n_chunks, round(idf, 6) AS idf FROM idf"))
def idf(spark, base):
    return _idf(spark, base, "corpus").withColumn("idf", _r("idf"))


@register("idf_document_scope", O.with_(
    O.postings_cte(scope="document"),
    "SELECT doc_id, level, term, df, n_chunks, round(idf, 6) AS idf FROM idf"))
def idf_document_scope(spark, base):
    return _idf(spark, base, "document").withColumn("idf", _r("idf"))


@register("tfidf_vectors", O.with_(
    O.postings_cte(),
    "SELECT doc_id, chunk_no, level, term, round(weight, 6) AS weight FROM postings"))
def tfidf_vectors(spark, base):
    p = C.build_postings(_parts(spark, base))
    return p.select("doc_id", "chunk_no", "level", "term", _r("weight").alias("weight"))


@register("tfidf_document_scope", O.with_(
    O.postings_cte(scope="document"),
    "SELECT doc_id, chunk_no, level, term, round(weight, 6) AS weight, "
    "round(norm, 6) AS norm FROM postings"))
def tfidf_document_scope(spark, base):
    p = C.build_postings(_parts(spark, base), scope="document")
    return p.select("doc_id", "chunk_no", "level", "term", _r("weight").alias("weight"),
                    _r("norm").alias("norm"))


@register("vector_norms", O.with_(
    O.postings_cte(),
    "SELECT doc_id, chunk_no, level, round(max(norm), 6) AS norm FROM postings "
    "GROUP BY doc_id, chunk_no, level"))
def vector_norms(spark, base):
    n = C.vector_norms(C.build_postings(_parts(spark, base)))
    return n.withColumn("norm", _r("norm"))


@register("tfidf_levels", O.with_(
    O.postings_cte(),
    "SELECT level, count(*) AS n_postings, count(DISTINCT term) AS n_terms, "
    "count(DISTINCT (doc_id, chunk_no)) AS n_chunks, round(sum(weight), 6) AS sum_weight "
    "FROM postings GROUP BY level"))
def tfidf_levels(spark, base):
    p = C.build_postings(_parts(spark, base))
    return p.groupBy("level").agg(
        F.count(F.lit(1)).alias("n_postings"), F.countDistinct("term").alias("n_terms"),
        F.countDistinct("doc_id", "chunk_no").alias("n_chunks"),
        _r(F.sum("weight")).alias("sum_weight"))


@register("query_vectors", O.with_(
    O.search_cte(O.BENCH_QUERIES),
    "SELECT query_id, term, round(qtf, 6) AS qtf, round(qnorm, 6) AS qnorm FROM qvec"))
def query_vectors_q(spark, base):
    q = query_vectors(TB.benchmark_queries(spark, base))
    return q.select("query_id", "term", _r("qtf").alias("qtf"), _r("qnorm").alias("qnorm"))


@register("cosine_scores", O.with_(
    O.search_cte(O.BENCH_QUERIES),
    "SELECT query_id, doc_id, chunk_no, round(raw_score, 6) AS raw_score, "
    "round(summary_score, 6) AS summary_score, round(keywords_score, 6) AS keywords_score "
    "FROM scores"))
def cosine_scores_q(spark, base):
    parts = _parts(spark, base)
    s = cosine_scores(query_vectors(TB.benchmark_queries(spark, base)), C.build_postings(parts))
    return s.select("query_id", "doc_id", "chunk_no",
                    *[_r(f"{lv}_score").alias(f"{lv}_score") for lv in K.LEVELS])


@register("search_all_levels", O.with_(
    O.search_cte(O.BENCH_QUERIES),
    "SELECT query_id, doc_id, chunk_no, round(composite, 6) AS composite, matched_level "
    "FROM scores"))
def search_all_levels(spark, base):
    parts = _parts(spark, base)
    s = cosine_scores(query_vectors(TB.benchmark_queries(spark, base)), C.build_postings(parts))
    return s.select("query_id", "doc_id", "chunk_no", _r("composite").alias("composite"),
                    "matched_level")


def _search(spark, base, top_k=K.SEARCH_TOP_K, level=None, queries=None):
    """Ingest, then search with bounds."""
    version = ingest_documents(_docs(spark, base), shared_dir(spark, "search_index"), export_pyramid=False)
    q = queries if queries is not None else TB.benchmark_queries(spark, base)
    return search_index(version, q, top_k=top_k, level=level)


_RESULTS = "SELECT * FROM results"


@register("search_benchmark", O.with_(O.search_cte(O.BENCH_QUERIES), _RESULTS))
def search_benchmark(spark, base):
    return _search(spark, base)


for _lv in K.LEVELS:
    def _mk(lv):
        @register(f"search_{lv}", O.with_(O.search_cte(O.BENCH_QUERIES, level=lv), _RESULTS))
        def _f(spark, base):
            return _search(spark, base, level=lv)
        return _f
    _mk(_lv)


@register("search_topk", O.with_(O.search_cte(O.BENCH_QUERIES, top_k=10), _RESULTS))
def search_topk(spark, base):
    return _search(spark, base, top_k=10)


_PART_QUERIES = "SELECT p_partkey AS query_id, p_name AS query FROM part"


@register("search_zero_fill", O.with_(O.search_cte(_PART_QUERIES), _RESULTS))
def search_zero_fill(spark, base):
    """Catalogue names as queries: mostly no shared term with the prose, so the
    zero-score fill decides most results."""
    q = TB.read_table(spark, base, "part").selectExpr("p_partkey AS query_id", "p_name AS query")
    return _search(spark, base, queries=q)


@register("search_document_scope", O.with_(O.search_cte(O.BENCH_QUERIES, scope="document"),
                                           _RESULTS))
def search_document_scope(spark, base):
    parts = _parts(spark, base)
    return search(TB.benchmark_queries(spark, base), C.build_postings(parts, scope="document"),
                  parts.paged()[0])


# ---------------------------------------------------------------------------------------
# R: query routing over a table of templated questions
# ---------------------------------------------------------------------------------------

from tessera.operators.router.handlers import Module, result as module_result  # noqa: E402
from tessera.operators.router.registry import Router, call_log, default_router  # noqa: E402
from tessera.sources.router_inputs import WORD_TEMPLATES, router_queries, router_queries_sql  # noqa: E402

_ARITH_CASES = (
    "CASE WHEN detected = 'math' AND template_no = 1 THEN CAST(round(q * l + p / 4, 4) AS VARCHAR)"
    " WHEN detected = 'math' AND template_no = 12 THEN CAST(round(q / l + t, 4) AS VARCHAR)"
    " WHEN detected = 'math' AND template_no = 13 THEN CAST(q * l AS VARCHAR) END AS arith_answer,"
    " CASE WHEN detected = 'math' AND template_no = 1 THEN CAST(q * l + p / 4 AS VARCHAR)"
    " WHEN detected = 'math' AND template_no = 12 THEN CAST(q / l + t AS VARCHAR)"
    " WHEN detected = 'math' AND template_no = 13 THEN CAST(q * l AS VARCHAR) END AS arith_computed,"
    " CASE WHEN detected = 'math' AND template_no = 1 THEN q * l + p / 4"
    " WHEN detected = 'math' AND template_no = 12 THEN q / l + t"
    " WHEN detected = 'math' AND template_no = 13 THEN CAST(q * l AS DOUBLE) END AS arith_value")
_ROUTED = O.routed_cte(router_queries_sql(), _ARITH_CASES)
_WORD_ROUTED = O.routed_cte(router_queries_sql(WORD_TEMPLATES), _ARITH_CASES)


def _rsql(select: str, routed: str = _ROUTED) -> str:
    return "WITH " + routed.lstrip() + "\n" + select


def _rq(spark, base):
    return router_queries(spark, base)


def _routed(spark, base, router: Router | None = None):
    return (router or default_router()).route(_rq(spark, base))


@register("classify_scores", _rsql(
    "SELECT query_id, score_math, score_legal, score_code, score_science, score_general FROM cls2"))
def classify_scores(spark, base):
    r = default_router()
    q = _rq(spark, base)
    cls = r.classify(F.col("query"))
    return q.select("query_id", *[cls[f"score_{t}"].alias(f"score_{t}") for t in K.QUERY_TYPES])


@register("classify_flags", _rsql(
    "SELECT query_id, has_numbers, has_operator, has_code FROM cls2"))
def classify_flags(spark, base):
    cls = default_router().classify(F.col("query"))
    return _rq(spark, base).select(
        "query_id", *[cls[n].alias(n) for n in ("has_numbers", "has_operator", "has_code")])


@register("classify_question_word", _rsql(
    "SELECT query_id, qword AS question_word, how_math FROM cls2"))
def classify_question_word(spark, base):
    from tessera.operators.router import classify as CLS
    q = F.col("query")
    qw = CLS.question_word(q)
    how = qw.isNotNull() & (F.instr(F.lower(q), "how") > 0) & CLS.flags(q)["has_numbers"]
    return _rq(spark, base).select("query_id", qw.alias("question_word"),
                                              how.alias("how_math"))


@register("classify", _rsql("SELECT query_id, detected AS query_type FROM cls2"))
def classify(spark, base):
    cls = default_router().classify(F.col("query"))
    return _rq(spark, base).select("query_id", cls["query_type"].alias("query_type"))


@register("route", _rsql(
    "SELECT query_id, detected, module_used, answer, confidence FROM routed"))
def route(spark, base):
    return _routed(spark, base).select("query_id", "detected", "module_used", "answer",
                                       "confidence")


@register("route_arithmetic", _rsql(
    "SELECT query_id, run AS expression, round(arith_value, 6) AS result, answer FROM routed "
    "WHERE arith_answer IS NOT NULL"))
def route_arithmetic(spark, base):
    r = _routed(spark, base)
    return (r.where(F.col("result.expression").isNotNull())
            .select("query_id", F.col("result.expression").alias("expression"),
                    _r("result.result").alias("result"), "answer"))


@register("route_word_problem", _rsql(
    "SELECT query_id, reasoning[1] AS numbers, op AS operation, answer FROM routed "
    "WHERE detected = 'math' AND arith_answer IS NULL", _WORD_ROUTED))
def route_word_problem(spark, base):
    """With the word problem on osmosis, which :data:`TEMPLATES` asks as a science question."""
    r = default_router().route(router_queries(spark, base, WORD_TEMPLATES))
    return (r.where((F.col("module_used") == "math") & F.col("result.expression").isNull())
            .select("query_id", F.col("reasoning")[0].alias("numbers"),
                    F.regexp_extract(F.col("reasoning")[1], "Detected operation type: (.*)", 1)
                    .alias("operation"), "answer"))


@register("route_legal", _rsql(
    "SELECT query_id, domain, array_to_string(jurisdiction, ',') AS jurisdiction, answer "
    "FROM routed WHERE module_used = 'legal'"))
def route_legal(spark, base):
    r = _routed(spark, base).where(F.col("module_used") == "legal")
    return r.select("query_id", F.col("result.domain").alias("domain"),
                    F.array_join("result.jurisdiction", ",").alias("jurisdiction"), "answer")


@register("route_code", _rsql(
    "SELECT query_id, language, task, answer FROM routed WHERE module_used = 'code'"))
def route_code(spark, base):
    r = _routed(spark, base).where(F.col("module_used") == "code")
    return r.select("query_id", F.col("result.language").alias("language"),
                    F.col("result.task").alias("task"), "answer")


@register("route_science", _rsql(
    "SELECT query_id, answer, confidence FROM routed WHERE module_used = 'science'"))
def route_science(spark, base):
    return _routed(spark, base).where(F.col("module_used") == "science") \
        .select("query_id", "answer", "confidence")


@register("route_general", _rsql(
    "SELECT query_id, answer, confidence FROM routed WHERE module_used = 'general'"))
def route_general(spark, base):
    return _routed(spark, base).where(F.col("module_used") == "general") \
        .select("query_id", "answer", "confidence")


@register("route_trace", _rsql(
    "SELECT query_id, array_to_string(reasoning, '; ') AS trace FROM routed"))
def route_trace(spark, base):
    return _routed(spark, base).select("query_id",
                                       F.array_join("reasoning", "; ").alias("trace"))


@register("route_annotated", _rsql(
    "SELECT query_id, module_used, confidence, score_math, score_legal, score_code, "
    "score_science, score_general, has_numbers, has_operator, has_code FROM routed"))
def route_annotated(spark, base):
    return _routed(spark, base).select(
        "query_id", "module_used", "confidence", *[f"score_{t}" for t in K.QUERY_TYPES],
        "has_numbers", "has_operator", "has_code")


@register("router_log", _rsql(
    "SELECT query_id, substr(query, 1, 100) AS query, detected, module_used, confidence "
    "FROM routed"))
def router_log(spark, base):
    return call_log(_routed(spark, base))


# A module added with its own rule, ahead of the catch-all general module.
SHIPPING_RULE = r"\b(ship|shipped|shipping|delivery|freight)\b"


def shipping_router() -> Router:
    shipping = Module(
        "shipping", lambda t: t == "shipping",
        lambda q, s: module_result("shipping", F.concat(F.lit("Logistics lookup for: "), q), 0.65,
                                   F.array(F.lit("Detected shipping query"))))
    return default_router().register(shipping, rules=[SHIPPING_RULE], before="general")


_SHIP_ROUTED = O.routed_cte(router_queries_sql(), _ARITH_CASES, extra=[
    ("shipping", [SHIPPING_RULE], "'Logistics lookup for: ' || query", 0.65,
     "['Detected shipping query']")])


@register("route_custom_module", "WITH " + _SHIP_ROUTED.lstrip() +
          "\nSELECT query_id, detected, module_used, answer, confidence FROM routed")
def route_custom_module(spark, base):
    r = shipping_router().route(_rq(spark, base))
    return r.select("query_id", "detected", "module_used", "answer", "confidence")


# ---------------------------------------------------------------------------------------
# T: SFT data preparation and evaluation
# ---------------------------------------------------------------------------------------

from tessera.operators.sft import evaluate as EV  # noqa: E402
from tessera.operators.sft import prepare as PR  # noqa: E402
from tessera.sources import qa as QA  # noqa: E402

_SYNTH = QA.synthesize_qa_sql()
_PAIRS = QA.qa_pairs_sql()
_SEED_KEY = f"md5('{K.SEED}-' || CAST(qa_id AS VARCHAR))"
_TRAIN = f"SELECT * FROM ({_SYNTH}) ORDER BY {_SEED_KEY}, qa_id LIMIT {K.TRAIN_SAMPLES}"
_HEAD = O._q(K.PROMPT_TEMPLATE_HEAD + K.SYSTEM_PROMPT + K.PROMPT_TEMPLATE_QUESTION)
_ANS = O._q(K.PROMPT_TEMPLATE_ANSWER)


def _prompts_sql(src: str) -> str:
    return (f"SELECT *, {_HEAD} || question || {_ANS} || coalesce(answer, '') AS train_prompt, "
            f"{_HEAD} || question || {_ANS} AS inference_prompt FROM ({src})")


_TOK = O._q(PR.TOKEN_PATTERN)
_VOCAB_CTE = f"""train AS ({_prompts_sql(_SYNTH)}),
counts AS (SELECT token, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(train_prompt, {_TOK})) AS token FROM train) GROUP BY token),
ranked AS (SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, md5(token)) + 2 AS INTEGER) AS token_id, freq FROM counts),
vocab AS (SELECT '<pad>' AS token, 0 AS token_id, 0 AS freq UNION ALL SELECT '<unk>', 1, 0
          UNION ALL SELECT '<eos>', 2, 0 UNION ALL SELECT token, token_id, freq FROM ranked)"""
_ENC_CTE = _VOCAB_CTE + f""",
train_rows AS (SELECT *, row_number() OVER () AS rid FROM train),
toks AS (
  SELECT rid, qa_id, least(len(regexp_extract_all(inference_prompt, {_TOK})), {K.MAX_SEQ_LEN}) AS n_prompt,
         u.token, u.pos - 1 AS pos
  FROM train_rows t, unnest(regexp_extract_all(t.train_prompt, {_TOK})) WITH ORDINALITY AS u(token, pos)
),
enc AS (
  SELECT qa_id, n_prompt, list(coalesce(v.token_id, 1) ORDER BY pos) AS input_ids
  FROM toks LEFT JOIN vocab v USING (token) WHERE pos < {K.MAX_SEQ_LEN}
  GROUP BY rid, qa_id, n_prompt
),
enc2 AS (
  SELECT *, list_transform(input_ids, lambda x, i: CASE WHEN i - 1 < n_prompt THEN {K.LABEL_IGNORE_ID} ELSE x END) AS labels,
         list_transform(input_ids, lambda x: CASE WHEN x = 0 THEN 0 ELSE 1 END) AS attention_mask,
         CAST(len(input_ids) AS INTEGER) AS n_tokens,
         CAST(greatest(len(input_ids) - n_prompt, 0) AS INTEGER) AS n_label_tokens
  FROM enc
)"""


def _ids_str(col):
    return F.array_join(F.col(col).cast("array<string>"), " ")


def _sql_ids(col):
    return f"array_to_string(list_transform({col}, lambda x: CAST(x AS VARCHAR)), ' ')"


def _synth(spark, base):
    return QA.synthesize_qa(spark, base)


def _train(spark, base):
    return PR.sample_train(_synth(spark, base))


def _encoded(spark, base):
    rows = PR.with_prompts(_synth(spark, base))
    return PR.encode(rows, PR.build_vocab(rows))


@register("qa_pairs", _PAIRS)
def qa_pairs(spark, base):
    return QA.qa_pairs(spark, base)


@register("synthesize_qa", _SYNTH)
def synthesize_qa(spark, base):
    return _synth(spark, base)


@register("sample_train", f"SELECT qa_id, question, answer FROM ({_TRAIN})")
def sample_train(spark, base):
    return _train(spark, base).select("qa_id", "question", "answer")


@register("sample_eval", f"SELECT qa_id, question, answer FROM ({_PAIRS}) ORDER BY qa_id "
                         f"LIMIT {K.EVAL_SAMPLES}")
def sample_eval(spark, base):
    return PR.sample_eval(QA.qa_pairs(spark, base))


@register("split_qa", f"""SELECT qa_id, CASE WHEN rk <= floor(n * {PR.TRAIN_SHARE}) THEN 'train' ELSE 'eval' END AS split
FROM (SELECT qa_id, row_number() OVER (ORDER BY {_SEED_KEY}, qa_id) AS rk, count(*) OVER () AS n FROM ({_SYNTH}))""")
def split_qa(spark, base):
    return PR.split_qa(_synth(spark, base)).select("qa_id", "split")


@register("format_prompts", f"SELECT qa_id, train_prompt, inference_prompt FROM "
                            f"({_prompts_sql(_PAIRS)})")
def format_prompts(spark, base):
    return PR.with_prompts(QA.qa_pairs(spark, base)).select("qa_id", "train_prompt",
                                                            "inference_prompt")


_EXTRACT_SQL = ("CASE WHEN regexp_matches({c}, '####\\s*[\\d,\\.\\-]+') "
                "THEN replace(regexp_extract({c}, '####\\s*([\\d,\\.\\-]+)', 1), ',', '') "
                "ELSE replace(regexp_extract_all({c}, '\\b\\d[\\d,\\.]*\\b')[-1], ',', '') END")


def _extract_sql(c: str) -> str:
    return _EXTRACT_SQL.format(c=c)


@register("extract_answer", f"""SELECT s.qa_id, {_extract_sql('s.answer')} AS from_answer,
  {_extract_sql('p.generated')} AS from_generated
FROM ({_SYNTH}) s JOIN ({SI.predictions_sql(_SYNTH)}) p USING (qa_id)""")
def extract_answer(spark, base):
    s = _synth(spark, base)
    p = SI.predictions(s)
    return s.join(p, "qa_id").select("qa_id", X.extract_final_answer("answer").alias("from_answer"),
                                     X.extract_final_answer("generated").alias("from_generated"))


@register("build_vocab", "WITH " + _VOCAB_CTE + "\nSELECT token, token_id, freq FROM vocab")
def build_vocab(spark, base):
    return PR.build_vocab(PR.with_prompts(_synth(spark, base)))


@register("tokenize_sft", "WITH " + _ENC_CTE + f"""
SELECT qa_id, {_sql_ids('input_ids')} AS input_ids, n_tokens, CAST(n_prompt AS INTEGER) AS n_prompt,
       n_label_tokens FROM enc2""")
def tokenize_sft(spark, base):
    e = _encoded(spark, base)
    return e.select("qa_id", _ids_str("input_ids").alias("input_ids"), "n_tokens",
                    F.col("n_prompt").cast("int").alias("n_prompt"), "n_label_tokens")


@register("mask_labels", "WITH " + _ENC_CTE + f"""
SELECT qa_id, {_sql_ids('labels')} AS labels, n_label_tokens FROM enc2""")
def mask_labels(spark, base):
    e = _encoded(spark, base)
    return e.select("qa_id", _ids_str("labels").alias("labels"), "n_label_tokens")


@register("attention_mask", "WITH " + _ENC_CTE + f"""
SELECT qa_id, {_sql_ids('attention_mask')} AS attention_mask FROM enc2""")
def attention_mask(spark, base):
    e = _encoded(spark, base)
    return e.select("qa_id", _ids_str("attention_mask").alias("attention_mask"))


_BUCKET = (f"(CAST(('0x' || substr(md5(CAST(qa_id AS VARCHAR)), 1, 8)) AS BIGINT) % "
           f"(SELECT greatest(CAST(ceil(count(*) / {PR.ROWS_PER_BUCKET}) AS BIGINT), 1) FROM train))")


@register("left_pad_batches", "WITH " + _ENC_CTE + f""",
b0 AS (SELECT *, {_BUCKET} AS bucket FROM enc2),
b AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY qa_id) - 1) / {K.BATCH_SIZE}) AS INTEGER) AS batch_no
      FROM b0),
p AS (SELECT *, max(n_tokens) OVER (PARTITION BY bucket, batch_no) AS padded_len FROM b)
SELECT qa_id, bucket, batch_no, padded_len, padded_len - n_tokens AS n_pad,
  {_sql_ids("list_concat(list_transform(range(padded_len - n_tokens), lambda x: 0), input_ids)")} AS input_ids,
  {_sql_ids("list_concat(list_transform(range(padded_len - n_tokens), lambda x: 0), attention_mask)")} AS attention_mask
FROM p""")
def left_pad_batches(spark, base):
    rows = _synth(spark, base)
    b = PR.encode_batches(rows, PR.build_vocab(PR.with_prompts(rows)))
    return b.select("qa_id", "bucket", "batch_no", "padded_len", "n_pad",
                    _ids_str("input_ids").alias("input_ids"),
                    _ids_str("attention_mask").alias("attention_mask"))


@register("token_stats", "WITH " + _ENC_CTE + f"""
SELECT (SELECT count(*) FROM train) AS n_samples,
       round((SELECT avg(floor(length(train_prompt) * {K.TOKENS_PER_CHAR}::DOUBLE)) FROM train), 6) AS est_tokens_avg,
       round((SELECT avg(n_tokens) FROM enc2), 6) AS real_tokens_avg,
       (SELECT max(n_tokens) FROM enc2) AS max_tokens""")
def token_stats(spark, base):
    rows = PR.with_prompts(_synth(spark, base))
    st = PR.token_stats(rows, PR.encode(rows, PR.build_vocab(rows)))
    return st.select("n_samples", _r("est_tokens_avg").alias("est_tokens_avg"),
                     _r("real_tokens_avg").alias("real_tokens_avg"), "max_tokens")


@register("step_plan", f"""SELECT count(*) AS n_samples,
  CAST(ceil(count(*) / {K.BATCH_SIZE}) AS BIGINT) AS steps_per_epoch,
  CAST(ceil(ceil(count(*) / {K.BATCH_SIZE}) * {K.NUM_EPOCHS} / {K.GRAD_ACCUM_STEPS}) AS BIGINT) AS total_steps_trainer,
  CAST(floor(ceil(count(*) / {K.BATCH_SIZE}) * {K.NUM_EPOCHS} / {K.GRAD_ACCUM_STEPS}) AS BIGINT) AS total_steps_simulation
FROM ({_TRAIN})""")
def step_plan(spark, base):
    return PR.step_plan(_train(spark, base))


_SCORED = f"""SELECT s.qa_id, {_extract_sql('p.generated')} AS pred, {_extract_sql('s.answer')} AS truth
FROM ({_SYNTH}) s LEFT JOIN ({SI.predictions_sql(_SYNTH)}) p USING (qa_id)"""


@register("score_predictions", f"""SELECT qa_id, pred, truth,
  coalesce(pred IS NOT NULL AND pred = truth, false) AS correct FROM ({_SCORED})""")
def score_predictions(spark, base):
    s = _synth(spark, base)
    return EV.score_predictions(SI.predictions(s), s)


@register("exact_match_accuracy", f"""SELECT count(*) AS n_total,
  CAST(coalesce(sum(CASE WHEN pred IS NOT NULL AND pred = truth THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_correct,
  round(coalesce(sum(CASE WHEN pred IS NOT NULL AND pred = truth THEN 1 ELSE 0 END), 0) / greatest(count(*), 1), 6) AS accuracy
FROM ({_SCORED})""")
def exact_match_accuracy(spark, base):
    s = _synth(spark, base)
    acc = EV.exact_match_accuracy(EV.score_predictions(SI.predictions(s), s))
    return acc.select("n_total", "n_correct", _r("accuracy").alias("accuracy"))


_ROLLUP = f"""SELECT CAST((floor((event_id) / {K.LOGGING_STEPS}) + 1) * {K.LOGGING_STEPS} AS BIGINT) AS step,
  count(*) AS n_steps, round(avg(value), 4) AS train_loss
FROM events GROUP BY floor((event_id) / {K.LOGGING_STEPS})"""


@register("loss_rollup", _ROLLUP)
def loss_rollup(spark, base):
    return EV.loss_rollup(SI.step_log(TB.read_table(spark, base, "events")))


@register("checkpoint_steps", f"SELECT DISTINCT event_id + 1 AS step FROM events "
                              f"WHERE (event_id + 1) % {K.SAVE_STEPS} = 0")
def checkpoint_steps(spark, base):
    return EV.checkpoint_steps(SI.step_log(TB.read_table(spark, base, "events")))


_EPOCH_ACC = """SELECT user_id AS run_id,
  CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) + 1 AS INTEGER) AS epoch,
  avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS accuracy
FROM events GROUP BY 1, 2"""


@register("best_checkpoints", f"""SELECT run_id, epoch, round(accuracy, 6) AS accuracy,
  accuracy > greatest(coalesce(max(accuracy) OVER (PARTITION BY run_id ORDER BY epoch
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS is_best
FROM ({_EPOCH_ACC})""")
def best_checkpoints(spark, base):
    b = EV.best_checkpoints(SI.epoch_accuracy(TB.read_table(spark, base, "events")))
    return b.select("run_id", "epoch", _r("accuracy").alias("accuracy"), "is_best")


_EVAL = f"SELECT * FROM ({_SYNTH}) ORDER BY qa_id LIMIT {K.EVAL_SAMPLES}"
_EVAL_SCORED = f"""SELECT {_extract_sql('p.generated')} AS pred, {_extract_sql('s.answer')} AS truth
FROM ({_EVAL}) s LEFT JOIN ({SI.predictions_sql(_EVAL)}) p USING (qa_id)"""
_SUMMARY = f"""SELECT (SELECT count(*) FROM ({_TRAIN})) AS train_samples,
  (SELECT count(*) FROM ({_EVAL})) AS eval_samples,
  (SELECT arg_max(train_loss, step) FROM ({_ROLLUP})) AS final_train_loss,
  (SELECT round(coalesce(sum(CASE WHEN pred IS NOT NULL AND pred = truth THEN 1 ELSE 0 END), 0) / greatest(count(*), 1), 6) FROM ({_EVAL_SCORED})) AS accuracy"""


@register("run_summary", _SUMMARY)
def run_summary(spark, base):
    """Accuracy is that of the evaluation rows."""
    rows = _synth(spark, base)
    held = PR.sample_eval(rows)
    acc = EV.exact_match_accuracy(EV.score_predictions(SI.predictions(held), held))
    summ = EV.run_summary(PR.sample_train(rows), held,
                          EV.loss_rollup(SI.step_log(TB.read_table(spark, base, "events"))), acc)
    return summ.select("train_samples", "eval_samples", "final_train_loss",
                       _r("accuracy").alias("accuracy"))


# ---------------------------------------------------------------------------------------
# Sources and sinks: every write goes to the shared checkpoint folder and is read back.
# ---------------------------------------------------------------------------------------

from tessera.sources import files as FS  # noqa: E402
from tessera.streaming import router_stream as RS  # noqa: E402


@register("src_text_files", "SELECT doc_id, text FROM documents")
def src_text_files(spark, base):
    path = shared_dir(spark, "text_files")
    FS.write_text_files(TB.read_table(spark, base, "documents"), path)
    files = FS.read_text_files(spark, path)
    doc_id = F.regexp_extract("file_path", r"/([^/]*)\.txt$", 1)
    # the writer ended each file with one line break: drop exactly that one
    text = F.expr("substring(text, 1, length(text) - 1)")
    return files.select(F.when(doc_id != FS.NO_ID, doc_id).cast("bigint").alias("doc_id"), text.alias("text"))


@register("chunk_long_files", O.with_(
    """long_texts AS (
  SELECT source AS doc_id, string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id) AS text
  FROM documents GROUP BY source),""" + O.chunks_cte(source="long_texts"),
    "SELECT doc_id AS source, chunk_no, chunk_id, start_char, end_char, text FROM chunks"))
def chunk_long_files(spark, base):
    """All documents of a source as one file, a line break after each, cut by byte ranges."""
    path = shared_dir(spark, "long_files")
    FS.write_long_files(TB.read_table(spark, base, "documents"), "source", "doc_id", path)
    chunks = chunk_files(spark, path, segment_bytes=1 << 15)
    return chunks.select(F.regexp_extract("doc_id", "/source=([^/]*)/", 1).alias("source"),
                         F.col("chunk_no").cast("int").alias("chunk_no"), "chunk_id",
                         F.col("start_char").cast("int").alias("start_char"),
                         F.col("end_char").cast("int").alias("end_char"), "text")


@register("export_pyramid_json", O.with_(
    O.pyramid_cte(),
    "SELECT doc_id, chunk_no, chunk_id, start_char, end_char, raw_text, summary, category, "
    "array_to_string(keywords, ',') AS keywords FROM pyramid"))
def export_pyramid_json(spark, base):
    path = shared_dir(spark, "pyramid_json")
    FS.write_json(_parts(spark, base).pyramid, path)
    back = FS.read_json(spark, path, FS.PYRAMID_SCHEMA)
    return back.withColumn("keywords", F.array_join("keywords", ","))


@register("index_roundtrip", O.with_(
    O.postings_cte(),
    "SELECT doc_id, chunk_no, level, term, round(weight, 6) AS weight, round(norm, 6) AS norm "
    "FROM postings"))
def index_roundtrip(spark, base):
    path = shared_dir(spark, "index")
    FS.write_index(C.build_postings(_parts(spark, base)), path)
    p = FS.read_index(spark, path)
    return p.select("doc_id", "chunk_no", "level", "term", _r("weight").alias("weight"),
                    _r("norm").alias("norm"))


@register("search_persisted_index", O.with_(O.search_cte(O.BENCH_QUERIES), _RESULTS))
def search_persisted_index(spark, base):
    """Search served from the written index (postings + chunk table read back)."""
    version = ingest_documents(_docs(spark, base), shared_dir(spark, "ingested"))
    return search_index(version, TB.benchmark_queries(spark, base))


@register("search_replaced_documents", O.with_(O.search_cte(O.BENCH_QUERIES), _RESULTS))
def search_replaced_documents(spark, base):
    """The same search after three ingests and a deletion: a third of the documents with other
    texts and some that do not belong, then those replaced and the rest added, then the others
    taken out.  The index must be that of one ingest."""
    docs, root = _docs(spark, base), shared_dir(spark, "segments")
    first = docs.where("doc_id % 3 = 0").withColumn("text", F.concat(F.lit("outdated "), F.reverse("text")))
    strangers = docs.select((-F.col("doc_id") - 1).alias("doc_id"), F.upper("text").alias("text"))
    ingest_documents(first.unionByName(strangers), root, export_pyramid=False)
    ingest_documents(docs.where("doc_id % 3 <> 1"), root, export_pyramid=False)
    ingest_documents(docs.where("doc_id % 3 = 1"), root, export_pyramid=False)
    version = delete_documents(strangers, root)
    return search_index(version, TB.benchmark_queries(spark, base))


@register("export_router_log", _rsql(
    "SELECT query_id, substr(query, 1, 100) AS query, detected, module_used, confidence "
    "FROM routed"))
def export_router_log(spark, base):
    path = shared_dir(spark, "router_log")
    FS.write_json(call_log(_routed(spark, base)), path)
    return FS.read_json(spark, path, FS.ROUTER_LOG_SCHEMA)


_EPOCH_STEPS = f"(SELECT ceil(count(*) / {K.NUM_EPOCHS}) FROM events)"


@register("export_metrics_json", f"SELECT *, CAST(ceil(step / {_EPOCH_STEPS}) AS INTEGER) AS epoch FROM ({_ROLLUP})")
def export_metrics_json(spark, base):
    path = shared_dir(spark, "metrics_json")
    steps = SI.step_log(TB.read_table(spark, base, "events"))
    per_epoch = steps.select(F.ceil(F.count(F.lit(1)) / K.NUM_EPOCHS)).scalar()
    FS.write_json(EV.with_epoch(EV.loss_rollup(steps), per_epoch), path)
    return FS.read_json(spark, path, FS.METRICS_SCHEMA)


@register("export_run_summary_json", _SUMMARY)
def export_run_summary_json(spark, base):
    path = shared_dir(spark, "run_summary_json")
    FS.write_json(run_summary(spark, base), path)
    return FS.read_json(spark, path, FS.SUMMARY_SCHEMA)


@register("src_qa_files", f"SELECT question, answer, 'train' AS split FROM ({_SYNTH}) UNION ALL "
                          f"SELECT question, answer, 'test' FROM ({_PAIRS})")
def src_qa_files(spark, base):
    """Question/answer JSON files in train and test folders, read back."""
    path = shared_dir(spark, "qa_files")
    for split, rows in (("train", _synth(spark, base)), ("test", QA.qa_pairs(spark, base))):
        FS.write_json(rows.select("question", "answer"), f"{path}/split={split}")
    return QA.read_qa(spark, path)


@register("stream_router_log", _rsql(
    "SELECT query_id, substr(query, 1, 100) AS query, detected, module_used, confidence "
    "FROM routed"))
def stream_router_log(spark, base):
    """The call log produced by a Structured Streaming query over the query table landed
    as parquet files (run to completion with an available-now trigger)."""
    src, sink, ckpt = (shared_dir(spark, n) for n in ("stream_src", "stream_sink", "stream_ckpt"))
    router_queries(spark, base).select("query_id", "query").write.mode("overwrite").parquet(src)
    q = RS.start_router_log(spark, src, sink, ckpt)
    q.awaitTermination()
    return spark.read.schema(FS.ROUTER_LOG_SCHEMA).parquet(sink)


@register("stream_search", O.with_(O.search_cte(O.BENCH_QUERIES), _RESULTS))
def stream_search(spark, base):
    """Benchmark queries landed as parquet files and searched by a Structured Streaming
    query (per micro-batch, against the persisted index), then read back."""
    from tessera.streaming.search_stream import start_search_stream
    root = shared_dir(spark, "stream_index")
    ingest_documents(_docs(spark, base), root, export_pyramid=False)
    src, sink, ckpt = (shared_dir(spark, n) for n in ("qstream_src", "qstream_sink", "qstream_ckpt"))
    TB.benchmark_queries(spark, base).write.mode("overwrite").parquet(src)
    start_search_stream(spark, src, root, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("query_id", "rank", "doc_id", "chunk_no", "chunk_id",
                                           "score", "level")
