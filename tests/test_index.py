"""Segments, versions and the bounded search."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from shared_cases import SF_SMALL
from tessera.functions import constants as K
from tessera.operators import topk
from tessera.operators.chunking import chunk_documents
from tessera.operators.corpus import build_postings
from tessera.operators.pyramid import PyramidParts
from tessera.operators.search import search
from tessera.operators.topk import BoundedSearch
from tessera.plans.ingest import current_version, delete_documents, ingest_documents, read_pyramid, search_index
from tessera.session import materialize, shared_dir
from tessera.sources import tables as TB
from tessera.sources.versions import VersionLog


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _words(seed, n):
    rng = random.Random(seed)
    stock = [f"word{i}" for i in range(60)]
    return " ".join(rng.choice(stock[:rng.choice([4, 15, 60])]) + rng.choice(["", "", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    docs = [(i, _words(i, random.Random(i).choice([1, 6, 40, 400, 900]))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "  "), (103, docs[5][1]), (104, docs[5][1]), (105, "the of and"), (None, "word1")]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def questions(spark):
    rows = [(i, _words(1000 + i, 8)) for i in range(12)] + [(50, ""), (51, "the and"), (52, "unheard"), (53, None),
                                                           (54, "word1 word1 unheard")]
    return spark.createDataFrame(rows, "query_id long, query string")


def _plain(docs, questions, scope="corpus", **kwargs):
    """Every chunk scored, from an index in memory."""
    parts = PyramidParts(chunk_documents(docs, 100, 2, 40))
    return _rows(search(questions, build_postings(parts, scope), parts.paged()[0], **kwargs))


@pytest.fixture(scope="module")
def in_memory(corpus):
    parts = PyramidParts(chunk_documents(corpus, 100, 2, 40))
    return materialize(build_postings(parts)), parts.paged()[0]


@pytest.fixture(scope="module")
def version(spark, corpus):
    return ingest_documents(corpus, shared_dir(spark, "bounded"), 100, 2, 40, term_buckets=8)


@pytest.mark.parametrize("kwargs", [
    {"top_k": 1}, {"top_k": 5}, {"top_k": 200}, {"top_k": 3, "level": "raw"}, {"top_k": 3, "level": "summary"},
    {"top_k": 3, "level": "keywords"}, {"top_k": 4, "weights": {"raw": 0.0, "summary": 2.0, "keywords": -0.5}}])
def test_bounded_search_equals_scoring_everything(version, in_memory, questions, kwargs):
    assert _rows(search_index(version, questions, **kwargs)) == _rows(search(questions, *in_memory, **kwargs))


def test_joins_beyond_the_broadcast_limit(version, in_memory, questions, monkeypatch):
    monkeypatch.setattr(topk, "BROADCAST_ROWS", 0)
    assert _rows(search_index(version, questions, top_k=3)) == _rows(search(questions, *in_memory, top_k=3))


def test_document_scope(spark, corpus, questions):
    version = ingest_documents(corpus, shared_dir(spark, "scoped"), 100, 2, 40, scope="document")
    assert _rows(search_index(version, questions)) == _plain(corpus, questions, scope="document")


def test_bounds_hold_and_most_blocks_are_skipped(spark):
    version = ingest_documents(TB.documents(spark, SF_SMALL), shared_dir(spark, "skipping"), export_pyramid=False)
    search_ = BoundedSearch(version, TB.benchmark_queries(spark, SF_SMALL), 3)
    terms = search_.query_terms()
    bounds = search_.block_bounds(terms)
    blocks = version.live.select("doc_id", "chunk_no", "block")
    over = (search_.scores(bounds, terms).join(blocks, ["doc_id", "chunk_no"]).join(bounds, ["query_id", "block"])
            .where(F.col("composite") > F.col("bound") + 1e-12))
    assert over.count() == 0
    kept = search_.surviving_blocks(bounds, terms)
    entered, everything = search_.matches(kept, terms).count(), search_.matches(bounds, terms).count()
    assert 0 < entered < 0.8 * everything   # few blocks here; a fifth of the pairs are scored at sf0.1


def test_replacing_and_deleting_equals_one_ingest(spark, corpus, questions):
    root = shared_dir(spark, "replaced")
    old = corpus.where("doc_id % 2 = 0").withColumn("text", F.concat(F.lit("word1 word7 stale "), F.col("text")))
    gone = spark.createDataFrame([(900, "word1 word2 stale"), (901, "word3")], "doc_id long, text string")
    options = {"term_buckets": 8, "page_chars": 100, "overlap_chars": 40}
    ingest_documents(old.unionByName(gone), root, **options)
    half = ingest_documents(corpus.where("doc_id % 2 = 0"), root, **options)
    assert _rows(search_index(half, questions)) == _plain(corpus.where("doc_id % 2 = 0").unionByName(gone), questions)
    ingest_documents(corpus.where("doc_id % 2 = 1 OR doc_id IS NULL"), root, **options)
    whole = delete_documents(gone, root)
    assert whole.number == 4 and len(whole.segments) == 4
    assert _rows(search_index(whole, questions, top_k=6)) == _plain(corpus, questions, top_k=6)
    # document frequencies are those of the live chunks, deleted terms included
    terms = {r.term: r for r in whole.terms.collect()}
    assert "stale" not in terms
    one = ingest_documents(corpus, shared_dir(spark, "one"), **options)
    columns = ["term", *[f"df_{lv}" for lv in K.LEVELS]]
    assert _rows(whole.terms.select(columns)) == _rows(one.terms.select(columns))
    key = ["doc_id", "chunk_no", "chunk_id", "start_char", "raw_text", "summary", "category", "keywords"]
    assert sorted(map(repr, read_pyramid(whole).select(key).collect())) == sorted(map(repr, read_pyramid(one).select(key).collect()))
    # the version before still answers as it did
    assert _rows(search_index(half, questions)) == _plain(corpus.where("doc_id % 2 = 0").unionByName(gone), questions)


def test_an_emptied_index_and_other_options(spark):
    root = shared_dir(spark, "emptied")
    docs = spark.createDataFrame([(1, "apple pear"), (2, "apple fig")], "doc_id long, text string")
    ask = spark.createDataFrame([(0, "apple")], "query_id long, query string")
    ingest_documents(docs, root)
    with pytest.raises(ValueError):
        ingest_documents(docs, root, term_buckets=3)
    assert search_index(delete_documents(docs, root), ask).count() == 0
    with pytest.raises(ValueError):
        delete_documents(docs, shared_dir(spark, "nowhere"))
    empty = ingest_documents(docs.where("false"), shared_dir(spark, "empty"))
    assert search_index(empty, ask).count() == 0


def test_readers_never_see_a_gap_and_old_versions_go(spark):
    root = shared_dir(spark, "swap")
    ask = spark.createDataFrame([(0, "apple")], "query_id long, query string")
    docs = lambda i: spark.createDataFrame([(1, f"apple number{i}"), (2, "pear")], "doc_id long, text string")
    ingest_documents(docs(0), root, export_pyramid=False, retain=2)
    seen, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                version = current_version(spark, root)
                seen.append(version.number)
                top = search_index(version, ask, top_k=1).collect()
                assert [r.doc_id for r in top] == [1]
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    first = current_version(spark, root)
    for i in range(1, 3):
        ingest_documents(docs(i), root, export_pyramid=False, retain=10)
    done.set()
    reader.join()
    assert not failures and seen == sorted(seen)
    last = ingest_documents(docs(9), root, export_pyramid=False, retain=2)
    log = VersionLog(spark, root)
    assert log.numbers() == [3, 4] and last.number == 4
    with pytest.raises(Exception):
        first.live.count()   # its files are gone
    assert search_index(last, ask, top_k=1).count() == 1


def test_two_writers_of_one_number(spark):
    log = VersionLog(spark, shared_dir(spark, "log"))
    assert log.latest() is None
    assert log.append(1, {"who": "a"}) and not log.append(1, {"who": "b"})
    rounds = []

    def make(before):
        rounds.append(before["number"])
        if len(rounds) == 1:
            assert log.append(2, {"who": "other"})   # somebody publishes in between
        return {"who": "c", "after": before["who"]}

    assert log.publish(make) == {"who": "c", "after": "other", "number": 3} and rounds == [1, 2]
    assert log.latest()["who"] == "c"
    assert len({log.take_number() for _ in range(3)}) == 3


def test_a_page_counts_its_terms_once(spark):
    """What :mod:`tessera.functions.text` cuts and counts, as one row for each term of a page."""
    from collections import Counter
    from tessera.functions import text as X
    from tessera.operators import paged as P
    from tessera.operators.paged import write_counts, write_windows
    texts = ["", "The of and a 1 x", "Na\u00efve \u0130stanbul \u212aelvin 12km a-b ab. Ab! AB?", "zz yy zz. xx yy zz 9 99", "\u00e9\u00e9 \u00fc"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(7, texts[3])] * 2, "doc_id long, text string")
    windows = write_windows(PyramidParts(chunk_documents(docs.coalesce(1)), top_k=2), shared_dir(spark, "count_windows"))
    counts = write_counts(windows, shared_dir(spark, "page_counts"), 2, 2)
    assert counts.count() == counts.select("page", "term").distinct().count()
    got = {(r.doc_id, r.term): r for r in P.entries(counts).collect()}
    tokens = {r.doc_id: (r.t, r.s) for r in windows.select(
        "doc_id", X.tokenize("raw_text").alias("t"), X.tokenize("summary").alias("s")).collect()}
    want = {(d, w) for d, (t, s) in tokens.items() for w in {*t, *s}}
    assert set(got) == want and "12km" in {w for _, w in want}
    for (d, w), r in got.items():
        both = 2 if d == 7 else 1   # equal rows of one key are one chunk
        t, s = tokens[d]
        assert r.raw == both * t.count(w) / len(t) and r.summary == (both * s.count(w) / len(s) if w in s else None)
        best = sorted(Counter(t), key=lambda x: (-t.count(x), t.index(x)))[:2]
        assert r.place == (best.index(w) + 1 if w in best else None)
        assert r.keywords == (1 / min(2, len(set(t))) if w in best else None)


def test_terms_of_documents_in_one_page_do_not_travel(spark):
    """Frequencies inside a document are summed over pages only where it lies in several."""
    from tessera.operators.paged import _of_documents
    text = " ".join(f"word{i} common" for i in range(400))
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string").coalesce(1)
    windows, counts = PyramidParts(chunk_documents(docs, 100, 2, 40)).paged()
    known = _of_documents(windows, counts)
    pages = windows.groupBy("doc_id").agg(F.countDistinct("page").alias("n")).collect()
    several = {r.doc_id for r in pages if r.n > 1}
    assert 0 < len(several) < 20
    assert {r.doc_id for r in known.where("term IS NOT NULL").select("doc_id").distinct().collect()} == several
    rows = build_postings(PyramidParts(chunk_documents(docs, 100, 2, 40)), "document")
    per_term = rows.where("level = 'raw'").groupBy("doc_id", "term").agg(F.count("*").alias("df"), F.max("idf").alias("idf"))
    n = windows.groupBy("doc_id").agg(F.count("*").alias("n"))
    off = per_term.join(n, "doc_id").where("abs(idf - (ln((n + 1) / (df + 1)) + 1)) > 1e-12")
    assert off.count() == 0 and per_term.count() > 40 * 400


def test_postings_do_not_move_for_a_few_query_terms(in_memory, questions):
    from tessera.operators.search import cosine_scores, query_vectors
    plan = cosine_scores(query_vectors(questions), in_memory[0])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_pages_without_live_chunks_are_left_out(spark):
    root = shared_dir(spark, "all_replaced")
    docs = lambda w: spark.createDataFrame([(i, f"{w}{i} shared") for i in range(5)], "doc_id long, text string")
    ingest_documents(docs("old"), root, export_pyramid=False)
    version = ingest_documents(docs("new"), root, export_pyramid=False)
    assert version.entry["layout"] == 2
    assert {r.term for r in version.bounds.collect()} == {"shared", *[f"new{i}" for i in range(5)]}
    assert {r.segment for r in version.live.collect()} == {1}
