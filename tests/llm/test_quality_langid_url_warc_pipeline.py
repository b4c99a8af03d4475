import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_cases import BASE, TEXTS, prose
from tessera.llm import langid, quality, urlfilter, warc


def brute_statistics(text):
    words = (text or "").encode().split()
    n = len(words)
    chars = sum(len(w.decode()) for w in words)
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    covered = {i + k for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return [n, chars, sum((text or "").count(c) for c in quality.SYMBOLS), dup, len(covered)]


def test_statistics_equal_brute_force():
    rng = random.Random(1)
    texts = [t for _, t in TEXTS] + ["".join(rng.choice("ab \n\t#|é") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    assert [quality.statistics(t)[0] for t in texts] == [brute_statistics(t) for t in texts]


def test_trees_obey_monotonic_constraints_and_flat_scoring():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.FEATURES)))
    y = ((x[:, 2] < 0.5) ^ (rng.random(2000) < 0.1)).astype(float)
    forest = quality.fit_trees(x, y, trees=15)
    score = forest.score(x)
    assert ((score > 0.5) == (x[:, 2] < 0.5)).mean() > 0.9
    for j in np.flatnonzero(quality.MONOTONE):
        for _ in range(20):
            grid = np.repeat(x[rng.integers(len(x))][None], 50, 0)
            grid[:, j] = np.linspace(0, 1, 50)
            assert (np.diff(forest.score(grid)) * quality.MONOTONE[j] >= -1e-12).all()
    for i in range(20):                                   # one row through the nodes by hand
        total = forest.start
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if x[i, forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        assert 1 / (1 + np.exp(-total)) == pytest.approx(score[i])


def junk(seed):
    return " ".join(w + "%%%" for w in prose(seed, 90).split())


def test_quality_rejects_junk_and_keeps_clean_text(spark, documents, no_documents):
    rows = [(i, prose(i, 90)) for i in range(60)] + [(100 + i, junk(i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100), 0, None) for i, _ in rows if i % 2] + [(None, 1, 0, "x"), (1, None, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    forest = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, forest).collect()}
    assert all(got[i].kept == (i < 100) for i, _ in rows)
    edge = quality.score(documents, forest).collect()
    assert Counter((r.doc_id, r.n_words, r.n_repeat_words) for r in edge) == Counter(
        (i, brute_statistics(t)[0], brute_statistics(t)[4]) for i, t in TEXTS)
    assert all(not r.kept for r in edge if r.base_failed) and {r.doc_id for r in edge if not r.base_failed} >= {1, 6}
    assert quality.keep(documents, forest).columns == documents.columns
    assert quality.score(no_documents, quality.fit(no_documents, labels)).count() == 0
    assert quality.fit(docs, labels.where("false")).score(np.zeros((1, 9)))[0] > 0.5


def test_languages_are_learned_and_unknown_is_und(spark, documents, no_documents):
    de = [" ".join(random.Random(i).choices("der die das und ist nicht ein für über".split(), k=60)) for i in range(60)]
    rows = [(i, prose(i, 60), "en") for i in range(60)] + [(100 + i, t, "de") for i, t in enumerate(de)]
    rows += [(300, None, "en"), (301, "123 456 !!", "de"), (302, prose(77, 50), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where("not held_out"))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i < 300)
    assert (got[300].lang_pred, got[300].score, got[301].lang_pred) == ("und", 0.0, "und")
    assert got[302].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert {r.doc_id for r in langid.keep(docs, model).collect()} == {i for i, _, _ in rows} - {300, 301}
    empty = langid.fit(no_documents)
    assert langid.predict(documents, empty).where("lang_pred <> 'und'").count() == 0
    assert langid.keep(documents, model).columns == documents.columns


def test_held_out_fold_is_crc32_of_the_id_as_text(spark):
    import zlib
    rows = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("h", langid.held_out()).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def brute_url(captures, changes):
    out = {}
    for page, url, day in captures:
        active = []
        for scope, value, action in {c[:3] for c in changes if None not in c}:
            log = {}
            for s, v, a, added, on in changes:
                if (s, v, a) == (scope, value, action) and on is not None and added is not None:
                    log[on] = log.get(on, False) or added
            days = [d for d in sorted(log) if day is not None and d <= day]
            if days and log[days[-1]]:
                host, _, path = (url or "").split("://")[-1].partition("/")
                path = "/" + path.split("?")[0].split("#")[0]
                hit = {"host": host == value, "domain": host == value or host.endswith("." + value),
                       "prefix": (host + path + "/").startswith(value)}[scope]
                if url and hit:
                    active.append((urlfilter.SCOPES.index(scope), len(value), action == "block", action, f"{scope}:{value}"))
        best = max(active, default=(0, 0, 0, "none", ""))
        out[page] = (sum(a[3] == "block" for a in active), sum(a[3] == "allow" for a in active), best[3], best[4])
    return out


def test_url_lists_equal_brute_force(spark):
    from datetime import date, timedelta
    rng, start = random.Random(4), date(2020, 1, 1)
    hosts, folders = ["a.x.com", "b.x.com", "y.org", "c.d.y.org"], ["", "/p/", "/p/q/", "/r/"]
    changes = []
    for _ in range(150):
        scope = rng.choice(urlfilter.SCOPES)
        value = {"domain": rng.choice(["x.com", "y.org", "d.y.org"]), "host": rng.choice(hosts),
                 "prefix": rng.choice(hosts) + rng.choice(folders[1:])}[scope]
        changes.append((scope, value, rng.choice(["block", "allow"]), rng.random() < 0.6, start + timedelta(rng.randint(0, 200))))
    changes.append(("host", "y.org", "block", True, None))
    captures = [(i, f"http://{rng.choice(hosts)}{rng.choice(folders) or '/'}z{i % 3}?q#f", start + timedelta(rng.randint(0, 250)))
                for i in range(120)] + [(500, None, start), (501, "", start), (502, "http://y.org/", None)]
    rows = spark.createDataFrame(captures + captures[:1], "page_id long, url string, fetched_on date")
    log = spark.createDataFrame(changes, "scope string, value string, action string, added boolean, on date")
    got = urlfilter.evaluate(rows, log).collect()
    assert len(got) == len(captures) + 1
    assert {r.page_id: (r.n_block, r.n_allow, r.verdict, r.entry) for r in got} == brute_url(captures, changes)
    assert urlfilter.evaluate(rows.where("false"), log).count() == 0
    assert urlfilter.evaluate(rows, log.where("false")).where("verdict <> 'none'").count() == 0


def pages():
    big = prose(1, 400)
    rows = [(1, "http://b/", big), (5, "http://a/", big), (3, "http://c/\r\nX: y", big), (4, "http://d/", "small"),
            (6, "http://e/", "small"), (7, None, None), (8, "http://f/", ""), (9, "http://g/", "é" * 700),
            (10, "http://h/", "é" * 700), (11, "http://i/", "x" * 300_000), (None, "http://j/", big)]
    return rows


def test_warc_round_trip_equals_brute_force(spark):
    rows = pages()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    got = {r.page_id: r for r in warc.round_trip(frame).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "").encode() == data]
        first = max(same, default=None) if len(data) >= 1000 else i
        want = (len(data), hashlib.sha1(data).hexdigest(), "response" if first == i else "revisit", None if first == i else first)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want
    assert warc.round_trip(frame.where("false")).count() == 0


def test_archives_roll_and_lost_attempts_are_not_read(spark, tmp_path):
    import os
    frame = spark.createDataFrame([(i, f"http://h/{i:03d}", prose(i, 300)) for i in range(60)], "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    manifest = warc.write_archives(frame, folder, max_bytes=4000)
    assert manifest.count() > 4 and all(r.bytes < 8000 for r in manifest.collect())
    assert not [f for f in os.listdir(folder + "/_temporary") if f.endswith(".gz")]
    with open(f"{folder}/999999-0000.warc.gz", "wb") as stray:         # of an attempt that was lost
        stray.write(b"not a record")
    back = warc.read_archives(manifest, folder)
    assert sorted((r.page_id, r.url, r.html) for r in back.collect()) == sorted(
        (r.page_id, r.url, r.html) for r in frame.collect())
    again = warc.write_archives(frame.repartition(5), str(tmp_path / "again"), max_bytes=4000)
    assert sorted(r.sha1 for r in again.collect()) == sorted(r.sha1 for r in manifest.collect())   # deterministic


def test_damaged_records_are_errors():
    data = warc.record({"page_id": 1, "url": "http://a", "html": "hello", "refers_to": None})
    assert warc.parse(data)[1] == b"hello"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"hello", b"hellO"))


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline
    clean = [(i, prose(i, 120)) for i in range(40)]
    rows = clean + [(100 + i, junk(i)) for i in range(40)] + [(200, clean[3][1]), (201, clean[4][1] + " end"),
            (202, clean[5][1].replace(" ", "  ")), (203, prose(300, 100) + " mail me at a.b@ex.com now"), (204, None), (205, "12 3")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    root = str(tmp_path)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100 or i > 199), 0) for i, t in rows if t], "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet")
    now, kept = docs, []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, root)
        out.write.parquet(f"{root}/{n}")
        now = spark.read.parquet(f"{root}/{n}")
        kept.append((name, now))
    assert [n for n, _ in kept] == ["quality_rules", "language_id", "near_dedup", "personal_data", "best_fit_packing"]
    assert all(frame.columns == docs.columns for _, frame in kept[:-1])
    ids = {name: {r.doc_id for r in frame.select("doc_id").collect()} for name, frame in kept}
    assert ids["quality_rules"] == set(range(40)) | {200, 201, 202, 203}
    assert ids["language_id"] == ids["quality_rules"]
    assert ids["near_dedup"] == set(range(40)) | {203} == ids["personal_data"] == ids["best_fit_packing"]
    masked = kept[3][1].where("doc_id = 203").first()
    assert masked.text.endswith("mail me at [email] now") and masked.n_chars == len(masked.text)
    assert corpus_pipeline.run(spark, root).count() == kept[4][1].count()
    assert BASE


def test_pages_without_an_id_revisit_the_only_page_with_one(spark):
    html, other = prose(1, 400), prose(2, 400)
    rows = [(7, "http://a", html), (None, "http://b", html), (None, "http://b", html), (None, "http://c", html),
            (None, "http://d", other), (None, "http://e", other), (8, "http://f", prose(3, 400))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect())
    sha = [hashlib.sha1(h.encode()).hexdigest() for h in (html, other, prose(3, 400))]
    assert got == {(7, sha[0], "response", None): 1, (None, sha[0], "revisit", 7): 3,
                   (None, sha[1], "response", None): 2, (8, sha[2], "response", None): 1}


def test_archives_are_the_same_from_any_partitions(spark, tmp_path):
    rows = [(i % 39_000 if i % 7 else None, f"http://host{i * 7919 % 300}.org/{i % 37}", "text é " * (i % 90)) for i in range(40_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n, (partitions, setting) in enumerate([(1, 4), (7, 9)]):
            spark.conf.set("spark.sql.shuffle.partitions", setting)
            manifest = warc.write_archives(pages.repartition(partitions), str(tmp_path / f"run{n}"), shard_bytes=4 << 20)
            found.append(sorted(map(tuple, manifest.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) > 5
    assert sum(r[2] for r in found[0]) == len(rows)


def test_a_shortened_archive_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://a", "x" * i) for i in range(20)], "page_id long, url string, html string")
    for cut in (60, None):
        folder = str(tmp_path / f"cut{cut}")
        manifest = warc.write_archives(pages, folder)
        name = f"{folder}/{manifest.first()['name']}"
        with open(name, "rb") as fh:
            data = fh.read()
        ends = data.rfind(b"\x1f\x8b")   # cut inside the last record, then just before it
        with open(name, "wb") as fh:
            fh.write(data[:-cut] if cut else data[:ends])
        with pytest.raises(Exception):
            warc.read_archives(manifest, folder).collect()
