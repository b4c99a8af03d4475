"""Spelling variants (operator 11): generated edits against length-sharded blocked Bloom filters.

1. Words are counted inside each task and then over the corpus; those frequent and long enough
   are the vocabulary, a written table.
2. The vocabulary goes into Bloom filters, one shard for each word length, of blocks of 256 bits
   in four lanes.  Tasks turn words into block numbers and lane bits, blocks are put together
   in slices of 1 MB, and the slices are broadcast.  A filter holds ``WAVE_WORDS`` words at most
   (96 MB); a larger vocabulary is dealt by hash into as many waves as it takes, each with a
   filter of its own, and every word's edits are probed in the wave that they belong to.
3. Of two near words of one length, the one with the larger code point in the differing place
   reaches the other by a replacement; of two of different length, the longer reaches the
   shorter by a deletion.  So each word generates only its deletions and its replacements by
   smaller code points.  An edit's hash follows from its word's by taking one addend out and
   putting one in (positions after a deletion count one less), for whole batches at once.
4. Edits that the filter lets through are written out and joined with the vocabulary on the
   word itself, which removes the false positives.  Every link counts for both words.
5. A form has at least ``RATIO`` times the word's count, so chains of forms are short and have
   no cycles.  Roots go down the chains a step at a time; a step joins on the form, which has no
   more words next to it than it has edits.

Defined results: a NULL text has no words and a NULL id counts as an empty one; texts and runs
are whole, whatever their length; repeated rows count as often as they occur; equal counts go to
the smallest word in code-point order.  Without words there are no rows.  Only the id and the
text are read, so other columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Emitter, mix64, rows_of, written

MIN_LENGTH, MIN_COUNT = 6, 5
RATIO = 5
#: One run in so many loses a code point.
DAMAGE = 199
#: Most words of a filter: 3 bytes each.
WAVE_WORDS = 32_000_000
LANES, LANE_BITS = 4, 3
WORDS_PER_BLOCK = 32 * LANES // 12   # 24 bits a word
SLICE_BLOCKS = 32_768                # 1 MB
LAST_SHARD = 64                      # longer words share a shard
_HELD_WORDS, _HELD_BYTES = 200_000, 32 << 20
_PROBES = 1 << 20

#: The code points that a word can have, in order.
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_RUN = re.compile("[a-zÀ-ÿ]+")
_RANK = np.zeros(256, np.int64)
_RANK[ALPHABET] = np.arange(len(ALPHABET))
_CODES = np.array(ALPHABET, np.int64)

_COUNTS = "word string, n long"
_COUNTS_ARROW = pa.schema([("word", pa.string()), ("n", pa.int64())])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of the whole corpus with their counts."""
    def count(batches):
        out, held, size = Emitter(_COUNTS_ARROW, 20_000), Counter(), 0
        for r in rows_of(batches):
            found = _RUN.findall((r["text"] or "").encode("utf-8").lower().decode("utf-8"))
            seed = zlib.crc32(f"{r['id']}:".encode() if r["id"] is not None else b":")
            for run in found:
                if len(run) < min_length:
                    continue
                h = zlib.crc32(run.encode("utf-8"), seed)
                if not h % DAMAGE:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < min_length:
                        continue
                held[run] += 1
                size += len(run) if held[run] == 1 else 0
            if len(held) >= _HELD_WORDS or size >= _HELD_BYTES:
                for word, n in held.items():
                    yield from out.add((word, n), len(word))
                held, size = Counter(), 0
        for word, n in held.items():
            yield from out.add((word, n), len(word))
        yield from out.rest()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(count, _COUNTS)
    return written(rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "spelling_words")


# -- hashes of words and of their edits ------------------------------------------------------

def addend(position, rank) -> np.ndarray:
    """What a code point in a position adds to its word's hash (modulo 2^64)."""
    return mix64((np.asarray(position).astype(np.uint64).reshape(-1) << np.uint64(8)) + np.asarray(rank).astype(np.uint64)
                 + np.uint64(0x9E3779B97F4A7C15))


def ranks_of(words: list[str], length: int) -> np.ndarray:
    """Words of one length as a matrix of places in the alphabet."""
    return _RANK[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), length)


def word_hash(ranks: np.ndarray) -> np.ndarray:
    return addend(np.arange(ranks.shape[1]), ranks).sum(axis=1, dtype=np.uint64)


def _finish(total: np.ndarray) -> np.ndarray:
    return mix64(total)


class Layout:
    """Where the blocks of each shard start, from the number of words of each length."""

    def __init__(self, words: dict[int, int], waves: int = 1):
        self.blocks = np.zeros(LAST_SHARD + 1, np.uint64)
        for shard, n in words.items():
            self.blocks[shard] = n // (waves * WORDS_PER_BLOCK) + 1
        self.start = np.cumsum(self.blocks) - self.blocks
        self.waves = waves

    @property
    def total(self) -> int:
        return int(self.blocks.sum())

    def place(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Block of every hash (of a shard that has blocks)."""
        shard = min(length, LAST_SHARD)
        return self.start[shard] + (hashes >> np.uint64(8)) % self.blocks[shard]

    def wave(self, hashes: np.ndarray) -> np.ndarray:
        return mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(self.waves)


def lane(hashes: np.ndarray, i: int) -> np.ndarray:
    """The bits that lane ``i`` of a block has for a hash."""
    bits = mix64(hashes + np.uint64(0xD1B54A32D192ED03 * (i + 1) % 2 ** 64))
    out = np.zeros(len(hashes), np.uint64)
    for k in range(LANE_BITS):
        out |= np.uint64(1) << ((bits >> np.uint64(6 * k)) & np.uint64(63))
    return out


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(length, places in the list, words) of every length, long ones in small parts."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, _PROBES // int(length))
        for i in range(0, len(at), step):
            part = at[i:i + step]
            yield int(length), part, [words[k] for k in part]


# -- building a filter --------------------------------------------------------------------------

_KEYS = "slice int, blocks binary, bits binary"
_KEYS_ARROW = pa.schema([("slice", pa.int32()), ("blocks", pa.binary()), ("bits", pa.binary())])
_SLICE = "slice int, bits binary"
_SLICE_ARROW = pa.schema([("slice", pa.int32()), ("bits", pa.binary())])


def build_filter(vocab: DataFrame, layout: Layout, wave: int) -> np.ndarray:
    """The blocks of the words of one wave: at most 3 bytes for each of ``WAVE_WORDS`` words."""
    def place(batches):
        for batch in batches:
            for length, _, words in _by_length(batch.column(0).to_pylist()):
                hashes = _finish(word_hash(ranks_of(words, length)))
                hashes = hashes[layout.wave(hashes) == wave]
                blocks = layout.place(hashes, length)
                bits = np.stack([lane(hashes, i) for i in range(LANES)], axis=1)
                order = np.argsort(blocks, kind="stable")
                slices = blocks[order] // np.uint64(SLICE_BLOCKS)
                for part in np.split(order, np.flatnonzero(np.diff(slices)) + 1):
                    if len(part):
                        yield pa.RecordBatch.from_pylist([{
                            "slice": int(blocks[part[0]]) // SLICE_BLOCKS,
                            "blocks": (blocks[part] % np.uint64(SLICE_BLOCKS)).astype("<u4").tobytes(),
                            "bits": bits[part].astype("<u8").tobytes()}], _KEYS_ARROW)

    def put_together(key: tuple, rows: pa.Table) -> pa.Table:
        out = np.zeros((SLICE_BLOCKS, LANES), np.uint64)
        for row in rows.to_pylist():
            at = np.frombuffer(row["blocks"], "<u4")
            np.bitwise_or.at(out, at, np.frombuffer(row["bits"], "<u8").reshape(-1, LANES))
        return pa.Table.from_pylist([{"slice": key[0].as_py(), "bits": out.tobytes()}], _SLICE_ARROW)

    n_slices = -(-layout.total // SLICE_BLOCKS)
    out = np.zeros((n_slices * SLICE_BLOCKS, LANES), np.uint64)
    slices = vocab.select("word").mapInArrow(place, _KEYS).groupBy("slice").applyInArrow(put_together, _SLICE)
    for row in slices.toLocalIterator():
        at = row["slice"] * SLICE_BLOCKS
        out[at:at + SLICE_BLOCKS] = np.frombuffer(bytes(row["bits"]), "<u8").reshape(-1, LANES)
    return out[:layout.total]


# -- probing ------------------------------------------------------------------------------------

def _edits(ranks: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(position, rows, hash sums, new ranks or None for a deletion) of all edits of words of one
    length, a position at a time."""
    n, length = ranks.shape
    places = np.arange(length)
    here = addend(places, ranks)
    total = here.sum(axis=1, dtype=np.uint64)
    moved = addend(np.maximum(places - 1, 0), ranks)
    after = moved.sum(axis=1, dtype=np.uint64)
    before = np.zeros(n, np.uint64)
    for i in range(length):
        after = after - moved[:, i]
        new = np.flatnonzero(ranks[:, i] != ranks[:, i - 1]) if i else np.arange(n)  # "ll": once
        yield i, new, (before + after)[new], None
        before = before + here[:, i]
        smaller = ranks[:, i]
        rows = np.repeat(np.arange(n), smaller)
        to = np.arange(len(rows)) - np.repeat(np.cumsum(smaller) - smaller, smaller)
        yield i, rows, (total - here[:, i])[rows] + addend(i, to), to


def positives(vocab: DataFrame, layout: Layout, wave: int, blocks: np.ndarray) -> DataFrame:
    """(word, n, edit): the edits that the filter lets through."""
    shared = vocab.sparkSession.sparkContext.broadcast(blocks)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("edit", pa.string())])

    def probe(batches):
        held, out = shared.value, Emitter(schema, 20_000)
        for batch in batches:
            counts = batch.column(1).to_pylist()
            for length, at, words in _by_length(batch.column(0).to_pylist()):
                for i, rows, sums, to in _edits(ranks_of(words, length)):
                    size = length - (to is None)
                    if not layout.blocks[min(size, LAST_SHARD)]:
                        continue
                    hashes = _finish(sums)
                    left = np.flatnonzero(layout.wave(hashes) == wave) if layout.waves > 1 else np.arange(len(rows))
                    block = layout.place(hashes[left], size)
                    for k in range(LANES):
                        bits = lane(hashes[left], k)
                        hit = held[block, k] & bits == bits
                        left, block = left[hit], block[hit]
                    for p in left.tolist():
                        word = words[rows[p]]
                        edit = word[:i] + ("" if to is None else chr(_CODES[to[p]])) + word[i + 1:]
                        yield from out.add((word, counts[at[rows[p]]], edit), len(word) * 2)
        yield from out.rest()

    return vocab.select("word", "n").mapInArrow(probe, "word string, n long, edit string")


def near_pairs(vocab: DataFrame, wave_words: int = WAVE_WORDS) -> DataFrame:
    """(word, n, other, other_n) of all pairs of near words, once each."""
    sizes = {r["shard"]: r["words"] for r in vocab.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("shard"))
             .agg(F.count(F.lit(1)).alias("words")).collect()}
    waves = max(1, -(-sum(sizes.values()) // wave_words))
    layout = Layout(sizes, waves)
    found = None
    for wave in range(waves):
        mine = written(positives(vocab, layout, wave, build_filter(vocab, layout, wave)), "spelling_positives")
        found = mine if found is None else found.unionByName(mine)
    known = vocab.select(F.col("word").alias("edit"), F.col("n").alias("other_n"))
    return found.join(known, "edit").select("word", "n", F.col("edit").alias("other"), "other_n")


# -- forms and roots ----------------------------------------------------------------------------

def _forms(vocab: DataFrame, pairs: DataFrame, ratio: int) -> DataFrame:
    """(word, n, n_near, form, form_n)."""
    both = F.explode(F.array(
        F.struct("word", F.col("n").alias("own"), "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("own"), F.col("word").alias("other"),
                 F.col("n").alias("other_n"))))
    best = F.min(F.struct((-F.col("other_n")).alias("key"), "other"))
    near = (pairs.select(both.alias("l")).select("l.*").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    top: Column = -F.col("best.key")
    ok = top >= ratio * F.col("n")
    return (vocab.join(near, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(ok, F.col("best.other")).alias("form"), F.when(ok, top).alias("form_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form."""
    links = forms.where("form IS NOT NULL").select("word", "form")
    ends = links.join(links.select(F.col("word").alias("form")), "form", "left_anti")
    step = written(ends.select("word", F.col("form").alias("root")), "spelling_roots")
    roots = step
    while not step.isEmpty():
        step = written(links.join(step.select(F.col("word").alias("form"), "root"), "form").select("word", "root"),
                       "spelling_roots")
        roots = roots.unionByName(step)
    return roots


def group_variants(vocab: DataFrame, ratio: int = RATIO, wave_words: int = WAVE_WORDS) -> DataFrame:
    """``vocab`` (word, n; written) -> word, form, root, n, n_near, form_n."""
    forms = written(_forms(vocab, near_pairs(vocab, wave_words), ratio), "spelling_forms")
    return (forms.join(_roots(forms), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def variants(docs: DataFrame) -> DataFrame:
    """Words of whole texts with their standard form, the last form of the chain and how many
    words are near."""
    return group_variants(vocabulary(docs))
