import glob
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.chunking import chunk_documents
from tessera.operators.corpus import build_postings
from tessera.operators.pyramid import PyramidParts
from tessera.operators.search import cosine_scores, query_vectors, search

Q1 = "What is gradient descent and how does it work?"
Q2 = "Explain transformer models and fine-tuning"
Q3 = "What is reinforcement learning?"


@pytest.fixture(scope="module")
def demo_index(spark, demo_text):
    docs = spark.createDataFrame([(0, demo_text)], "doc_id long, text string")
    parts = PyramidParts(chunk_documents(docs, 800, 2, 150))
    return parts, build_postings(parts)


def _run(spark, demo_index, queries, k, level=None):
    parts, post = demo_index
    q = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    out = {}
    for r in search(q, post, parts.base, top_k=k, level=level).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.chunk_id, r.score, r.level))
    return {k_: [x[1:] for x in sorted(v)] for k_, v in out.items()}


def test_derived_expectations(spark, demo_index):
    got = _run(spark, demo_index, [Q1, Q2, Q3], 4)
    assert got[0] == [("9d872ef5", 0.1878, "raw"), ("79475df8", 0.0125, "raw"),
                      ("167689dc", 0.0, "raw"), ("dedf3169", 0.0, "raw")]
    assert got[1] == [("9d872ef5", 0.1977, "keywords"), ("167689dc", 0.0517, "raw"),
                      ("dedf3169", 0.0, "raw"), ("79475df8", 0.0, "raw")]
    assert got[2] == [("167689dc", 0.2643, "summary"), ("dedf3169", 0.1944, "raw"),
                      ("79475df8", 0.1628, "raw"), ("9d872ef5", 0.0124, "raw")]


def test_level_restriction_keeps_weights(spark, demo_index):
    got = _run(spark, demo_index, [Q1, Q3], 4, level="summary")
    assert got[0] == [("9d872ef5", 0.0, "raw"), ("167689dc", 0.0, "raw"),
                      ("dedf3169", 0.0, "raw"), ("79475df8", 0.0, "raw")]
    assert got[1] == [("167689dc", 0.1194, "summary"), ("79475df8", 0.0615, "summary"),
                      ("dedf3169", 0.0463, "summary"), ("9d872ef5", 0.0, "raw")]


def test_stopwords_only_and_large_k(spark, demo_index):
    got = _run(spark, demo_index, ["the of and is", Q3], 50)
    assert 0 not in got                  # no tokens -> no result at all
    assert len(got[1]) == 4              # k larger than the corpus -> every chunk


def test_cosine_range(spark, demo_index):
    parts, post = demo_index
    q = spark.createDataFrame([(0, Q1), (1, Q2), (2, Q3)], "query_id long, query string")
    s = cosine_scores(query_vectors(q), post)
    lo, hi = s.select(F.least("raw_score", "summary_score", "keywords_score").alias("lo"),
                      F.greatest("raw_score", "summary_score", "keywords_score").alias("hi")) \
        .agg(F.min("lo"), F.max("hi")).first()
    assert lo >= 0.0 and hi <= 1.0 + 1e-12


def test_tunable_weights_and_summariser(spark, demo_text):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(0, demo_text)], "doc_id long, text string")
    # a replacement summariser (first 40 characters) and raw-only weights
    parts = PyramidParts(chunk_documents(docs, 800, 2, 150),
                         summariser=lambda c: F.substring(c, 1, 40))
    assert all(len(r.summary) <= 40 for r in parts.base.collect())
    q = spark.createDataFrame([(0, Q1)], "query_id long, query string")
    rows = search(q, build_postings(parts), parts.base, top_k=1,
                  weights={"raw": 1.0, "summary": 0.0, "keywords": 0.0}).collect()
    assert rows[0].chunk_id == "9d872ef5" and rows[0].level == "raw"


def test_ingest_files_and_search(spark, demo_text):
    from tessera.plans.ingest import ingest_files, read_pyramid, search_index
    from tessera.session import shared_dir
    src = shared_dir(spark, "demo_files")
    os.makedirs(src)
    with open(os.path.join(src, "demo.txt"), "w", encoding="utf-8") as fh:
        fh.write(demo_text)
    version = ingest_files(spark, src, shared_dir(spark, "demo_index"), page_chars=800,
                         window_pages=2, overlap_chars=150)
    assert sorted(r.chunk_id for r in read_pyramid(version).collect()) == \
        sorted(["79475df8", "dedf3169", "167689dc", "9d872ef5"])
    q = spark.createDataFrame([(0, Q3)], "query_id long, query string")
    top = search_index(version, q, top_k=1).first()
    assert (top.chunk_id, top.score, top.level) == ("167689dc", 0.2643, "summary")


def test_search_reads_only_its_level_and_its_folders(spark, demo_text):
    from tessera.operators.topk import BoundedSearch
    from tessera.plans.ingest import current_version, ingest_documents, search_index
    from tessera.session import shared_dir
    docs = spark.createDataFrame([(0, demo_text)], "doc_id long, text string")
    version = ingest_documents(docs, shared_dir(spark, "prune_index"), 800, 2, 150)
    q = spark.createDataFrame([(0, Q3)], "query_id long, query string")
    hits = search_index(version, q, top_k=4, level="summary")
    got = [(r.chunk_id, r.score, r.level) for r in sorted(hits.collect(), key=lambda r: r.rank)]
    assert got[0] == ("167689dc", 0.1194, "summary")
    search = BoundedSearch(version, q, 4, "summary")
    matches = search.matches(search.block_bounds(search.query_terms()), search.query_terms())
    assert "dynamicpruning" in matches._jdf.queryExecution().executedPlan().toString()
    assert not {"raw", "keywords"} & set(matches.columns)
    # folders of no query term cannot be read any more, and are not
    used, spoilt = {r.bucket for r in search.qvec.collect()}, 0
    for path in glob.glob(f"{version.root}/**/bucket=*/*.parquet", recursive=True):
        if int(path.split("bucket=")[1].split("/")[0]) not in used:
            with open(path, "wb") as fh:
                fh.write(b"unreadable")
            spoilt += 1
    assert spoilt > 10
    again = current_version(spark, version.root)
    assert sorted(map(tuple, search_index(again, q, top_k=4, level="summary").collect())) == sorted(map(tuple, hits.collect()))
    with pytest.raises(Exception):
        again.postings[0].selectExpr("sum(block)").collect()


def test_search_and_routing_independent_of_partitioning(spark):
    from tessera.operators.router.registry import call_log, default_router
    from tessera.sources import tables as TB
    sf = "/root/testdata/sf0.001"
    docs = TB.documents(spark, sf)
    q = TB.benchmark_queries(spark, sf)
    results = []
    for n in (1, 6):
        parts = PyramidParts(chunk_documents(docs.repartition(n)))
        hits = search(q.repartition(n), build_postings(parts), parts.base, top_k=3)
        results.append(sorted(tuple(r) for r in hits.collect()))
    assert results[0] == results[1] and len(results[0]) == 3 * q.count()
    logs = [sorted(tuple(r) for r in call_log(default_router().route(q.repartition(n))).collect())
            for n in (1, 5)]
    assert logs[0] == logs[1]


def test_document_scope_persisted_equals_in_memory(spark):
    from tessera.plans.ingest import ingest_documents, search_index
    from tessera.session import shared_dir
    from tessera.sources import tables as TB
    sf = "/root/testdata/sf0.001"
    docs, q = TB.documents(spark, sf), TB.benchmark_queries(spark, sf)
    version = ingest_documents(docs, shared_dir(spark, "docscope"), scope="document")
    persisted = sorted(tuple(r) for r in search_index(version, q).collect())
    parts = PyramidParts(chunk_documents(docs))
    in_memory = sorted(tuple(r) for r in
                       search(q, build_postings(parts, scope="document"), parts.base).collect())
    assert persisted == in_memory


def test_a_search_of_one_level_meets_no_rows_without_it(spark):
    from tessera.operators.topk import BoundedSearch
    from tessera.plans.ingest import ingest_documents, search_index
    from tessera.session import shared_dir
    text = "Alpha beta. Gamma delta. Epsilon zeta. Eta theta. Iota alpha kappa omega."
    docs = spark.createDataFrame([(i, text + f" Lambda{i} omega.") for i in range(6)], "doc_id long, text string")
    version = ingest_documents(docs, shared_dir(spark, "level_index"), export_pyramid=False)
    q = spark.createDataFrame([(0, "alpha omega"), (1, "omega"), (2, "zzz")], "query_id long, query string")
    parts = PyramidParts(chunk_documents(docs))
    chunks, postings = parts.base, build_postings(parts)
    for level in ("summary", "keywords", "raw"):
        bounded = BoundedSearch(version, q, 3, level)
        terms = bounded.query_terms()
        bounds = bounded.block_bounds(terms)
        assert bounded.matches(bounds.select("query_id", "block"), terms).where(F.col(level).isNull()).isEmpty()
        want = search(q, postings, chunks, top_k=3, level=level)
        assert sorted(map(tuple, search_index(version, q, top_k=3, level=level).collect())) == sorted(map(tuple, want.collect()))
