import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from llm_cases import BASE, TEXTS
from tessera.llm import bpe, lm, packing

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = P.path("word_bpe_49k.json")


def digest(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_bpe_is_the_library_and_an_exact_round_trip(documents):
    encoding, want = bpe.load_encoding(RANKS, P.PATTERN), Counter()
    for i, t in TEXTS:
        ids = encoding.encode_ordinary(t or "")
        want[i, len(ids), digest(",".join(map(str, ids))), digest(t or "")] += 1
    rows = bpe.encode_decode(documents, RANKS, P.PATTERN, keep_ids=True).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert all(encoding.decode_bytes(r.ids) == bytes(r.decoded) for r in rows)


def test_bpe_words_never_cut_a_pre_token():
    import regex
    pattern, text = regex.compile(P.PATTERN), "a  b\n\n c\t\td   's 12 !? x  　y \x1c.z  "
    cut = [t for w in bpe.split_words(text) for t in pattern.findall(w.decode())]
    assert cut == pattern.findall(text)


def test_small_blocks_give_the_same_result(documents, monkeypatch):
    from tessera.llm import blocks
    want = sorted(bpe.encode_decode(documents, RANKS, P.PATTERN).collect(), key=repr)
    write = blocks.write_blocks
    monkeypatch.setattr(bpe, "write_blocks", lambda *a, **k: write(*a, **k, block_bytes=500))
    assert sorted(bpe.encode_decode(documents, RANKS, P.PATTERN).collect(), key=repr) == want


@pytest.mark.parametrize("counted, most", [(False, 100), (True, 130)])
def test_closing_a_block_holds_little_beside_its_words(counted, most):
    """Bytes for each word of the dictionary, most of them the sorting of its words."""
    import tracemalloc
    from tessera.llm import blocks
    n = 40_000
    index = {b"%x" % (i * 2654435761 % 2 ** 32): i for i in range(n)}
    docs = [(d, d % 2 == 0, np.arange(n, dtype=np.uint32)) for d in range(20)]
    tracemalloc.start()
    try:
        for _ in blocks._close(0, docs, index, 8, counted):
            pass
        assert tracemalloc.get_traced_memory()[1] < most * n
    finally:
        tracemalloc.stop()


def test_a_block_has_each_word_once_in_its_bucket_and_order():
    from tessera.llm import blocks
    words, times = [b"%x" % (i * i * 7919) for i in range(500)], [1 + i % 5 for i in range(500)]
    index = {w: i for i, w in enumerate(words)}
    codes = np.repeat(np.arange(500, dtype=np.uint32), times)
    docs = [(1, True, codes), (2, False, codes[::-1]), (3, True, np.empty(0, np.uint32)), (4, False, codes[:7])]
    rows = [r for r, _ in blocks._close(9, docs, index, 8, True)]
    texts, buckets = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1]
    word_of, seen = {}, {}
    for _, _, _, _, _, bucket, packed_codes, packed_words, counts in buckets:
        found = blocks.unpack_words(packed_words)
        assert found == sorted(found) and {zlib.crc32(w) % 8 for w in found} == {bucket}
        word_of.update(zip(blocks.unpack(packed_codes).tolist(), found))
        seen.update(zip(found, blocks.unpack(counts).tolist()))
    assert [r[5] for r in buckets] == sorted({r[5] for r in buckets}) and len(word_of) == 500
    assert seen == dict(zip(words, times))     # of the documents with a true flag
    assert [(r[2], [word_of[c] for c in blocks.unpack(r[4]).tolist()] if r[4] else []) for r in texts] == [
        (d, [words[c] for c in codes.tolist()]) for d, _, codes in docs]


def test_packing_pieces_and_sequences(documents):
    tokenizer, want = packing.load_tokenizer(WORD_BPE), Counter()
    for i, t in TEXTS:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s:s + 4096]
            want[i, k, s, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packing.pack_documents(documents, WORD_BPE).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    _gapless(rows, 4096)


def _gapless(rows, capacity):
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return at


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_obeys_every_constraint(rule):
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(3, 1.2, 5000).astype(int) + 1, 256)
    counts = Counter(lengths.tolist())
    plan = packing.best_fit(counts, 256, max_documents=6, max_attention=256 * 256, rule=rule, weights=(1, 1, 1))
    used, docs, cost = np.zeros(plan.sequences, int), np.zeros(plan.sequences, int), np.zeros(plan.sequences, int)
    cells = np.zeros((plan.sequences, 256), bool)
    for n, c in counts.items():
        sequence, offset = plan.place(np.full(c, n), np.arange(c))
        for s, o in zip(sequence, offset):
            assert not cells[s, o:o + n].any()
            cells[s, o:o + n] = True
            used[s] += n
            docs[s] += 1
            cost[s] += n * n
    assert used.max() <= 256 and docs.max() <= 6 and cost.max() <= 256 * 256
    assert (cells.sum(1) == used).all() and (np.diff(cells.astype(int)) <= 0).all()   # gapless from 0


def test_best_fit_is_near_the_bound():
    rng = np.random.default_rng(4)
    counts = Counter(np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 4096).tolist())
    plan = packing.best_fit(counts)
    assert plan.sequences <= 1.01 * math.ceil(sum(n * c for n, c in counts.items()) / 4096) + 1


def test_empty_tables(no_documents):
    assert bpe.encode_decode(no_documents, RANKS, P.PATTERN).count() == 0
    assert packing.pack_documents(no_documents, WORD_BPE).count() == 0
    assert lm.score(no_documents, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_lm_base_is_exact_and_the_model_a_distribution(spark, documents):
    from pyspark.sql import functions as F
    held = documents.withColumn("held_out", F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)))
    rows = lm.score(held, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    count = Counter()
    for i, t in TEXTS:
        if i is None or i % 3:
            count.update([*(t or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in TEXTS:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)
        want[i, i is not None and i % 3 == 0, len(tokens), sum(w in count for w in tokens), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in rows) == want
    assert all(r.score < 0 for r in rows)
    same = {round(r.score, 6) for r in rows if r.doc_id in (1, 6)}
    assert len(same) == 1 and BASE                                # equal texts, equal scores


def test_attention_is_causal_and_normalised_and_learns():
    rng = np.random.default_rng(0)
    text = np.tile(np.array([3, 5, 7, 9], np.uint8), 200)
    model = lm.Attention.start(np.ones((lm.CLASSES, lm.CLASSES)), 0)
    model.p["out"] = rng.normal(0, 0.3, model.p["out"].shape).astype(np.float32)
    starts = np.ones(lm.CLASSES, bool)
    (whole, total), = model.positions([text], starts)
    (short, _), = model.positions([text[:100]], starts)
    np.testing.assert_allclose(whole[:100], short, atol=1e-5)      # later tokens change nothing
    np.testing.assert_allclose(total, 0, atol=1e-5)                # all classes together: 1
    x, y, valid, _ = lm.cut_windows([text], 0)
    assert valid.sum() == len(text)                                # each token is scored once
    grad, eps = model.gradients(x, y, valid), 1e-2

    def loss(m):
        return -float(np.mean(m.positions([text], starts)[0][0])) * math.log(10)

    for name in lm.Attention.NAMES:
        at = np.unravel_index(np.argmax(np.abs(grad[name])), grad[name].shape)
        old = model.p[name][at]
        model.p[name][at] = old + eps
        up = loss(model)
        model.p[name][at] = old - eps
        down = loss(model)
        model.p[name][at] = old
        assert (up - down) / (2 * eps) == pytest.approx(grad[name][at], rel=0.05, abs=1e-4)
    before, adam = loss(model), lm.Adam(model)
    for _ in range(60):
        adam.step(x, y, valid)
    assert loss(model) < 0.3 * before


def cycle_documents(spark, n=60, length=200):
    """Texts that go round the same words, from different places: the next word is known."""
    from llm_cases import WORDS
    rows = [(i, " ".join(WORDS[(i + k) % len(WORDS)] for k in range(length)), i % 7 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)


def test_lm_share_is_fitted_and_context_counts(spark):
    rng = np.random.default_rng(0)
    for share in (0.1, 0.6):
        base, own = rng.dirichlet(np.full(50, 0.3)), rng.dirichlet(np.full(50, 0.3))
        drawn = rng.choice(50, 200_000, p=share * base + (1 - share) * own)
        assert lm.fit_share(np.log10(own / base), np.bincount(drawn, minlength=50)) == pytest.approx(share, abs=0.02)
    assert lm.fit_share(np.empty(0), np.empty(0)) == 0.5
    rows = lm.score(cycle_documents(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    held = [r for r in rows if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score - r.base_score for r in held) / n > 0.5     # log10 per token


def test_attention_tells_ids_of_one_class_apart():
    rng = np.random.default_rng(5)
    first = rng.integers(0, 150, 3000)
    text = np.stack([first, first + 150], 1).reshape(-1).astype(np.uint16)     # 300 ids, each pair fixed
    starts = np.append(np.ones(300, bool), True)
    lexicon = lm.make_lexicon(np.bincount(text, minlength=301), starts, 6000, 300, 0)
    assert (np.bincount(lexicon.class_of) > 5).any()
    model = lm.Attention.start(np.ones((lm.CLASSES, lm.CLASSES)), 300, lexicon)
    model.p["node"] += rng.normal(0, 0.3, model.p["node"].shape).astype(np.float32)
    model.p["out"] += rng.normal(0, 0.3, model.p["out"].shape).astype(np.float32)
    prefix = text[:70]
    last = [model.positions([np.append(prefix, np.uint16(i))], lexicon.starts)[0][0][-1] for i in range(301)]
    assert sum(10 ** v for v in last) == pytest.approx(1, abs=1e-4)            # over ids, not classes
    x, y, valid, _ = lm.cut_windows([text[:400]], 300)
    grad, eps = model.gradients(x, y, valid), 1e-2

    def loss(m, of):
        return -float(np.mean(m.positions([of], lexicon.starts)[0][0])) * math.log(10)

    for name in ("embedding", "node", "bias"):
        at = np.unravel_index(np.argmax(np.abs(grad[name])), grad[name].shape)
        old = model.p[name][at]
        model.p[name][at] = old + eps
        up = loss(model, text[:400])
        model.p[name][at] = old - eps
        down = loss(model, text[:400])
        model.p[name][at] = old
        assert (up - down) / (2 * eps) == pytest.approx(grad[name][at], rel=0.05, abs=1e-4)
    model = lm.Attention.start(np.ones((lm.CLASSES, lm.CLASSES)), 300, lexicon)
    adam, (x, y, valid, _) = lm.Adam(model), lm.cut_windows([text[:5000]], 300)
    for _ in range(40):
        for at in range(0, len(x), 16):
            adam.step(x[at:at + 16], y[at:at + 16], valid[at:at + 16])
    second = model.positions([text[5000:]], lexicon.starts)[0][0][1::2]
    assert second.mean() > math.log10(0.5)         # by class alone at best the 1 / size of the class


def test_lm_trains_on_every_window_whatever_the_partitions(spark, monkeypatch):
    from tessera.llm.blocks import unpack
    docs, seen, train = cycle_documents(spark, n=40, length=3000), [], lm.train
    encoding = lm.load_encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)

    def spy(gathered, *rest):
        pieces = gathered.where("ids is not null").collect()
        seen.append(sum(len(unpack(r.ids)) - lm.CONTEXT - 1 for r in pieces))
        assert {r.round for r in pieces} == set(range(lm.ROUNDS))
        return train(gathered, *rest)

    monkeypatch.setattr(lm, "train", spy)
    monkeypatch.setattr(lm, "n_groups", lambda ids: 3)
    scores = []
    for n in (1, 5):
        rows = lm.score(docs.repartition(n), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
        scores.append([r.score for r in sorted(rows, key=lambda r: r.doc_id)])
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)
    ids = [len(encoding.encode_ordinary(" " + r.text)) + 1 for r in docs.where("not held_out").collect()]
    assert seen == [sum(ids)] * 2


def test_lm_groups_grow_with_the_corpus_and_are_bounded():
    window = lm.STRIDE * lm.ROUNDS
    assert [lm.n_groups(n * window) for n in (0, 1023, 4096, 1 << 20)] == [1, 1, 2, 32]
    assert (1 << 45) / lm.n_groups((1 << 45) * window) <= lm.GROUP_WINDOWS


def test_lm_counts_of_very_large_corpora_are_exact(spark):
    from tessera.llm.blocks import pack, pack_words
    most = 0xFFFFFFFF
    rows = [(b, 0, bytearray(pack(np.arange(2))), bytearray(pack_words([b"a", b"the"])),
             bytearray(pack(np.array([b, most])))) for b in range(3)]
    frame = spark.createDataFrame(rows, "block long, bucket int, codes binary, words binary, counts binary")
    out = lm.count_words(frame, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    lexicon = lm.make_lexicon(np.ones(50257), np.ones(50257, bool), 1, 1, 1)
    for b in range(3):
        block = lm.Block([r.asDict() for r in out if r.block == b], lexicon)
        assert block.count.tolist() == [3, 3 * most]
    assert sum(r.n for r in out if r.stat == "tokens") == 3 + 3 * most
