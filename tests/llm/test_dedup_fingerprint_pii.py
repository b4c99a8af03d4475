import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from llm_cases import BASE, TEXTS, prose
from tessera.llm import dedup, pii
from tessera.llm import fingerprint as fp
from tessera.llm.components import components


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute_components(rows, size):
    """rows: (id, text); id -> smallest id reachable."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations([(i, shingle_set(t, size)) for i, t in rows], 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i: find(i) for i in parent}


def copies(n=60, seed=5):
    """Near copies of a few texts at all degrees of likeness, a shared passage, a chain."""
    rng, rows = random.Random(seed), []
    passage = prose(99, 60)
    for k in range(n):
        words = prose(k % 4, 80).split()
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 999)}"
        rows.append((k, " ".join(words)))
        rows.append((1000 + k, passage + " " + prose(200 + k, 60)))
    chain = [f"c{i}" for i in range(120)]
    rows += [(2000 - k, " ".join(chain[k * 5:k * 5 + 60])) for k in range(10)]
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    rows = copies()
    got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), dedup.Parameters(shingle=size))
    assert {r.doc_id: r.component_id for r in got.collect()} == brute_components(rows, size)


def test_near_duplicates_edge_rows(documents, no_documents):
    p = dedup.Parameters(shingle=2)
    rows = dedup.near_duplicates(documents, p).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in rows) == Counter((i, len(shingle_set(t, 2))) for i, t in TEXTS)
    comp = {(r.doc_id, r.n_shingles > 0): (r.component_id, r.kept) for r in rows}
    assert comp[6, True] == (1, False) and comp[10, True] == (1, False) and comp[9, True] == (7, False)
    assert comp[2, False] == (2, True) and comp[None, True] == (None, True)
    assert dedup.near_duplicates(no_documents, p).count() == 0


def test_keep_first_keeps_columns_and_one_row_of_each_group(documents, no_documents):
    kept = dedup.keep_first(documents, dedup.Parameters(shingle=2))
    assert kept.columns == documents.columns
    # 12 is two different texts, both stay; the copies 6, 6 and 10 of 1 and the copy 9 of 7 go
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 7, 8, 11, 12, 12, None])
    assert dedup.keep_first(no_documents).count() == 0


def test_pigeonhole_finds_every_pair_within_the_radius(spark):
    p, rng = dedup.Parameters(), np.random.default_rng(1)
    pairs = []
    for k in range(40):
        a = rng.integers(0, 256, p.symbols).astype(np.uint8)
        b = a.copy()
        at = rng.permutation(p.symbols)[:p.radius]
        b[at] += 1
        pairs += [(2 * k, bytearray(a.tobytes())), (2 * k + 1, bytearray(b.tobytes()))]
    keys = {}
    for r in dedup.postings(spark.createDataFrame(pairs, "node long, sig binary"), p).collect():
        keys.setdefault(r.node, set()).add(r.key)
    assert all(keys[2 * k] & keys[2 * k + 1] for k in range(40))


def test_components_of_a_long_path(spark):
    rng, nodes = random.Random(2), list(range(-50, 150))
    rng.shuffle(nodes)
    edges = list(zip(nodes[:120], nodes[1:121])) + list(zip(nodes[130:], nodes[131:]))
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: min(nodes[:121]) for n in nodes[:121]} | {n: min(nodes[130:]) for n in nodes[130:]}


def test_neighbours_equal_brute_force(documents, no_documents):
    rows = [(i, t or "") for i, t in TEXTS]
    out = fp.compare_neighbours(documents).collect()
    assert Counter((r.doc_id, r.n_chars, r.fingerprint) for r in out) == Counter(
        (i, len(t), fp.fingerprint(t)) for i, t in rows)
    plain = {r.doc_id: r for r in out if r.doc_id in (7, 8, 9, 10, 11)}
    texts = {i: t for i, t in rows}
    for i, j in ((7, 8), (8, 9), (9, 10), (10, 11)):
        text, after = texts[i], texts[j]
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        assert plain[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert plain[i].edited_fingerprint == fp.fingerprint(edited)
        assert plain[i].near_edited == fp.likeness(fp.fingerprint(text), fp.fingerprint(edited))
        assert plain[i].near_next == fp.likeness(fp.fingerprint(text), fp.fingerprint(after))
    assert fp.compare_neighbours(no_documents).count() == 0


def test_fingerprint_follows_the_phrase_sets():
    def phrases(text):
        known, out, now = {""}, set(), ""
        for c in text:
            if now + c in known:
                now += c
            else:
                known.add(now + c)
                out.add(now + c)
                now = ""
        return out | ({now} if now else set())

    a, b = prose(7, 400), prose(7, 300) + prose(8, 100)
    real = len(phrases(a) & phrases(b)) / len(phrases(a) | phrases(b))
    assert abs(fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) - real) < 0.2
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint(None)) == 1.0
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("a")) == 0.0


_PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_spans(text):
    valid = [lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")),
             lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
             lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15]
    found = [(m.start(), k, m.end()) for k, p in enumerate(_PATTERNS) for m in re.finditer(p, text) if valid[k](m.group())]
    return ",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in sorted(found))


def test_base_spans_equal_plain_rules(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("01239.@+- ()aZ_%é\n") for _ in range(rng.randint(0, 60)))) for i in range(1500)]
    rows += list(enumerate(["a@b.c_d@e.f x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 00255.0.0.001", "4111 1111 1111 1111",
                            "é@é.é ñ1@2.3 +44 20 7946 0958.", "7" * 40, "x" * 200_000, "1 " * 20_000, None, ""], 2000))
    rows.append((2000, rows[-9][1]))
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = Counter()
    for i, t in rows:
        spans = brute_spans(t or "")
        want[i, hashlib.sha256(spans.encode()).hexdigest(), *(spans.count(k + ":") for k in pii.KINDS)] += 1
    assert Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == want


def contexts():
    rows = [(i, f"please write mail me at u{i}@ex.com soon") for i in range(20)]
    rows += [(100 + i, f"room {i} is number {i * 7} here") for i in range(20)]
    return [*rows, (200, "so write mail me at weird#9 soon"), (201, "there is version 2.0 of it")]


def test_contexts_discover_unseen_identifiers_only(spark):
    docs = spark.createDataFrame(contexts(), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert got[200] == "email:20:27" and got[201] == "" and all(got[100 + i] == "" for i in range(20))


def test_redaction_keeps_rows_and_columns(spark, documents, no_documents):
    from pyspark.sql import functions as F
    out = pii.redact(documents)
    assert out.columns == documents.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, documents.collect()))     # nothing personal there
    docs = spark.createDataFrame(contexts(), "doc_id long, text string").withColumn("n_chars", F.length("text"))
    got = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert got[3].text == "please write mail me at [email] soon" and got[3].n_chars == len(got[3].text)
    assert got[200].text == "so write mail me at [email] soon" and got[201].text == "there is version 2.0 of it"
    assert pii.redact(no_documents).count() == 0 and pii.find(no_documents).count() == 0


def test_masking_of_overlapping_spans(spark):
    from pyspark.sql import functions as F
    row = spark.createDataFrame([("0123456789", [(1, 0, 4), (2, 1, 3), (3, 2, 6), (8, 3, 10)])],
                                "text string, spans array<struct<start:int,kind:int,end:int>>")
    assert row.select(pii.masked(F.col("text"), F.col("spans")).alias("t")).first().t == "0[email][card]67[phone]"


def test_personal_data_runs_no_python(documents):
    scanned = pii.with_spans(pii.scan(documents))
    plan = scanned._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert BASE


def test_very_many_identifiers_in_one_text(spark):
    text = " ".join(f"10.{i // 250 % 250}.{i % 250}.7" for i in range(50_000))
    docs = spark.createDataFrame([(1, text), (2, "mail to ann@x.org now"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert got[1].n_ip == 50_000 and got[2].n_email == 1 and got[3].spans == ""
    want = ",".join(f"ip:{m.start()}:{m.end()}" for m in re.finditer(r"\S+", text))
    assert got[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_remaining_pairs_miss_no_similar_pair(spark):
    """Families of edited, shortened and lengthened sets, two pivots, in one bucket."""
    rng, sets, pivot, comp = random.Random(4), {}, {}, {}
    for first in (0, 1000):
        core = set(range(first, first + 60))
        sets[first] = core
        for k in range(1, 50):
            mine = set(rng.sample(sorted(core), 60 - rng.randint(0, 14)))
            mine |= {first + 5000 + rng.randrange(25) for _ in range(rng.randint(0, 9))}
            sets[first + k] = mine
        for k in range(50):
            pivot[first + k] = first if k % 7 else rng.choice((0, 1000))
    pivot[0], pivot[1000] = 0, 1000

    def alike(a, b):
        return 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])

    for n in sets:
        comp[n] = pivot[n] if alike(n, pivot[n]) else n
    rows = [(1, n, comp[n], len(s), len(s), pivot[n], pivot[n]) for n, s in sets.items()]
    rest = spark.createDataFrame(rows, "key long, node long, comp long, n long, shared long, pivot long, pivot_comp long")
    keys = spark.createDataFrame([(n, bytearray(np.array(sorted(s), np.uint64).tobytes())) for n, s in sets.items()],
                                 "node long, keys binary")
    got = {tuple(sorted(r)) for r in dedup.remaining_pairs(rest, keys, 80).collect()}
    want = {(a, b) for a, b in combinations(sorted(sets), 2) if alike(a, b) and comp[a] != comp[b]}
    assert want and want <= got
    assert all(comp[a] != comp[b] for a, b in got)


def test_remaining_pairs_of_a_family_are_far_fewer_than_its_square(spark):
    """300 copies of one text, an eighth of each replaced, by few words that others have, too:
    none is similar to another one but the twins, which are found."""
    rng, core = random.Random(5), set(range(400))
    sets, twins = {0: core}, set()
    for k in range(1, 301):
        lost = set(rng.sample(sorted(core), 50))
        sets[k] = core - lost | set(rng.sample(range(1000, 1030), 6)) | set(range(2000 + 100 * k, 2044 + 100 * k))
    for k in range(1, 11):
        sets[300 + k] = sets[k] | {50_000 + k}
        twins.add((k, 300 + k))
    rows = [(1, n, n, len(s), len(s), 0, 0) for n, s in sets.items()]
    rest = spark.createDataFrame(rows, "key long, node long, comp long, n long, shared long, pivot long, pivot_comp long")
    keys = spark.createDataFrame([(n, bytearray(np.array(sorted(s), np.uint64).tobytes())) for n, s in sets.items()],
                                 "node long, keys binary")
    got = [tuple(sorted(r)) for r in dedup.remaining_pairs(rest, keys, 80).collect()]
    assert twins <= set(got)
    assert len(got) < len(sets) ** 2 / 8


def test_a_node_similar_to_its_pivot_is_paired_with_it(spark):
    core = set(range(100))
    sets = {0: core, 1: core - {1, 2, 3}, 2: core - {4, 5, 6} | {200}, 3: core - set(range(10, 27))}
    rows = [(1, n, n, len(s), len(s), 0, 0) for n, s in sets.items()]
    rest = spark.createDataFrame(rows, "key long, node long, comp long, n long, shared long, pivot long, pivot_comp long")
    keys = spark.createDataFrame([(n, bytearray(np.array(sorted(s), np.uint64).tobytes())) for n, s in sets.items()],
                                 "node long, keys binary")
    got = {tuple(sorted(r)) for r in dedup.remaining_pairs(rest, keys, 80).collect()}
    assert {(0, 1), (0, 2), (0, 3)} <= got


def test_bits_let_every_needed_row_through(spark):
    rows = spark.range(-500, 5000).withColumnRenamed("id", "doc_id")
    need = rows.where("doc_id % 7 = 0")
    got = {r.doc_id for r in dedup.with_bit_of(need, rows, "doc_id").collect()}
    want = {r.doc_id for r in need.collect()}
    assert want <= got and len(got) < len(want) + 50
