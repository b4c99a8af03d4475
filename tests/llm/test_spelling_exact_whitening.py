"""Operators 11 to 13 against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import TEXTS
from tessera.llm import exact, qd, spelling, whitening

# -- 12: exact duplicates ----------------------------------------------------------------------


def _plain_groups(rows):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    ids = defaultdict(list)
    for (i, _), b in zip(rows, body):
        ids[b].append(i)
    out = []
    for (i, _), b in zip(rows, body):
        known = [x for x in ids[b] if x is not None]
        out.append((i, min(known) if known else None, len(ids[b]), hashlib.sha256(b.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = TEXTS + [(20, "a  b"), (21, "a\tb"), (22, "a b "), (23, " a b"), (24, "a\x0bb"), (25, "a b"),
                 (3, "a b"), (None, "a b"), (None, "lonely"), (None, "lonely"), (26, "\n"), (27, "x" * 300_000),
                 (28, "x" * 300_000)] + [(100 + i, "hot text") for i in range(400)]


def _weak(body, attempt):
    return F.substring(F.md5(F.concat(F.lit(str(attempt)), body)), 1, [1, 2, 32][attempt])


@pytest.mark.parametrize("digest", [exact.content_hash, _weak])
def test_exact_groups_equal_brute_force(spark, digest):
    docs = spark.createDataFrame(EXACT, "doc_id long, text string").repartition(5)
    got = exact.label(docs, digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == _plain_groups(EXACT)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in got}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_general_interface_and_empty(spark, documents, no_documents):
    kept = exact.keep_first(documents)
    assert kept.columns == documents.columns
    bodies = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(bodies) == len(set(bodies)) == len({b for *_, b in _plain_groups(TEXTS)})
    assert exact.label(no_documents).count() == 0 and exact.keep_first(no_documents).count() == 0
    assert exact.label(documents).count() == len(TEXTS)


# -- 11: spelling variants ---------------------------------------------------------------------


def _plain_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _plain_variants(words):
    near = {w: [o for o in words if _near(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def _rows(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def _spelled(seed, n):
    """Words with chains of ever rarer misspellings, hot and tied ones among them."""
    rng = random.Random(seed)
    letters = "abcdeélñ×÷ÿß"
    words = Counter()
    for _ in range(n):
        word, count = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9))), rng.choice([2000, 700, 100])
        while count >= 5 and len(word) >= 6:
            words[word] += count
            i, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:i] + ("" if kind == 0 else rng.choice(letters)) + word[i + (kind != 2):]
            count //= rng.choice([1, 4, 5, 6])
            if rng.random() < 0.4:
                count = 0
    return words


def test_words_equal_brute_force(spark):
    rng = random.Random(5)
    stock = ["Spelling", "ÉCOLES", "écoles", "naïveté", "letters", "x÷y×zab", "wordssix", "short", "LETTERS"]
    rows = [(rng.choice([None, *range(40)]), " ".join(rng.choice(stock) + rng.choice(["", ",", "9", "\n"])
                                                      for _ in range(300))) for _ in range(60)]
    rows += [(1, None), (2, ""), (3, "z" * 200_000), (4, "z" * 200_000)] + [(5 + i, "q" * 3_000) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    words = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert words == _plain_words(rows) and len(words) >= 8
    assert _rows(spelling.variants(docs)) == _plain_variants(words)


@pytest.mark.parametrize("wave_words", [spelling.WAVE_WORDS, 50])
def test_variants_equal_brute_force(spark, wave_words):
    words = _spelled(1, 120) + Counter({"a" * 70: 100, "a" * 69: 10, "a" * 70 + "b": 20, "llllll": 50, "lllllll": 5})
    vocab = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = _plain_variants(words)
    assert _rows(spelling.group_variants(vocab, wave_words=wave_words)) == want
    assert any(r[1] and r[2] != r[1] for r in want)   # chains of more than one step


def test_filter_lets_every_word_through_and_few_others(spark):
    rng = np.random.default_rng(3)
    ranks = rng.integers(0, 26, (30_000, 9))
    words = sorted({"".join(chr(97 + c) for c in r) for r in ranks.tolist()})
    vocab = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    layout = spelling.Layout({9: len(words)})
    blocks = spelling.build_filter(vocab, layout, 0)

    def passed(matrix):
        hashes = spelling.mix64(spelling.word_hash(matrix))
        at = layout.place(hashes, 9)
        return np.logical_and.reduce([blocks[at, k] & spelling.lane(hashes, k) == spelling.lane(hashes, k)
                                      for k in range(spelling.LANES)])
    assert passed(spelling.ranks_of(words, 9)).all()
    assert passed(rng.integers(26, 90, (200_000, 9))).mean() < 1e-3


def test_no_words(spark, no_documents):
    assert spelling.variants(no_documents).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "only short ones")], "doc_id long, text string")).count() == 0


# -- 13: whitening --------------------------------------------------------------------------------


@pytest.mark.parametrize("make", [
    lambda g: g.normal(size=(50, 7)), lambda g: g.normal(size=(200, 40)) * np.logspace(0, -6, 40),
    lambda g: g.normal(size=(30, 3)) @ g.normal(size=(3, 9)), lambda g: np.vstack([np.eye(6), -np.eye(6)]),
    lambda g: np.linalg.qr(g.normal(size=(60, 12)))[0] * ([1, 1 + 1e-13, 1 + 1e-11, 1 + 1e-7] + [0.5] * 8),
    lambda g: np.zeros((5, 4)), lambda g: np.ones((5, 1)), lambda g: g.normal(size=(9, 2))])
def test_qd_against_svd(make):
    rows = make(np.random.default_rng(0))
    r = np.linalg.qr(rows, mode="r")
    squares, v = qd.right_singular(r, rows.shape[1])
    want = np.linalg.svd(rows, compute_uv=False) ** 2
    assert np.allclose(squares, want, rtol=1e-9, atol=1e-14 * max(want[0], 1e-300))
    rank = int((want > want[0] * 1e-20).sum()) if want[0] else 0
    v = v[:, :rank]
    assert np.abs(v.T @ v - np.eye(rank)).max(initial=0) < 1e-11
    assert np.abs(rows.T @ (rows @ v) - v * squares[:rank]).max(initial=0) <= 1e-12 * max(want[0], 1)


def _check_whitening(spark, vectors, rows, partitions=3):
    """``vectors``: (id, list or None); ``rows``: those that remain."""
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, n string, x int, part long") \
        .repartition(partitions)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = sorted(out.collect(), key=lambda r: (r.vec_id, r.component, r.whitened))
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    k = min(4, x.shape[1])
    values, vectors_ = values[::-1][:k], vectors_[:, ::-1][:, :k]
    white = (x - sums / n) @ vectors_ / np.sqrt(values)
    assert len(got) == k * len(rows) and {r.n for r in got} == {n}
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == \
        sorted((i, int(d)) for (i, _), d in zip(rows, ((n * x - sums) ** 2).sum(axis=1)))
    for c in range(k):
        mine = np.array([w for _, w in sorted((r.vec_id, r.whitened) for r in got if r.component == c + 1)])
        want = np.array([w for _, w in sorted((i, w) for (i, _), w in zip(rows, white[:, c] * 1.0))])
        flipped = np.array([w for _, w in sorted((i, w) for (i, _), w in zip(rows, -white[:, c]))])
        assert min(np.abs(mine - want).max(), np.abs(mine - flipped).max()) < 1e-9
    total = np.trace(centred.T @ centred / n)
    assert all(abs(r.explained - values[r.component - 1] / total) < 1e-10 and r.identity_error < 1e-10 for r in got)


def test_whitening_equals_brute_force(spark):
    g = np.random.default_rng(7)
    base = g.normal(size=(120, 6)) * [3, 2, 1, 0.5, 0.2, 0.1] + 5
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist()) for i in range(200)] + [(3, base[9].tolist())]   # a hot vector, a used id
    bad = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6),
           (503, [1.0, float("-inf"), 0.0, 0.0, 0.0, 0.0]), (504, [1.0]), (505, []), (506, [0.5] * 7)]
    _check_whitening(spark, [(i, v, "clash", 1, 2) for i, v in rows + bad], rows)


def test_whitening_gathers_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    x = np.floor(np.random.default_rng(8).normal(size=(90, 3)) * [100, 400, 900]).astype(int)
    fit = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>").repartition(9)
    model = whitening.fit_whitening(fit, 3)
    centred = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(centred.T @ centred / 90)[::-1]
    assert (model.n, model.sums) == (90, x.sum(axis=0).tolist()) and np.allclose(model.variances, values, rtol=1e-12)
    assert whitening.identity_error(fit, model) < 1e-12


def test_whitening_without_rows_or_variance(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None), (2, [])])).count() == 0
    flat = whitening.whiten(make([(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(flat) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, 0, 0, 0)
                                  for r in flat)
    line = whitening.whiten(make([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])])).collect()
    assert sorted(round(abs(r.whitened), 6) for r in line) == [0, 0, 0, 0, 1.224745, 1.224745]
    assert all(r.identity_error < 1e-12 for r in line)


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [1e15, 0.0]), (2, [1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).collect() if r.component == 1}
    assert got[2] is None and len(got) == 3
