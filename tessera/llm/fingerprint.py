"""Operator 3: Lempel-Ziv phrase fingerprints.

A text is parsed into LZ78 phrases: the longest phrase known so far and one code point
more (a last phrase may be a known one).  The set of phrases is hashed, and the smallest
hash under each of ``HASHES`` multipliers, cut to 16 bits, makes the fingerprint: texts
that compress alike share phrases, so the share of equal minima estimates the Jaccard
similarity of their phrase sets.

:func:`compare_neighbours` sorts the documents by id with one range shuffle (ties by a
hash of the text, NULL ids first) and streams over each partition, so every document sees
the next one in the same task.  The first and last document of each partition are written
apart and joined across partitions in a second, small step.

A NULL or empty text has no phrases; two texts without phrases are alike (1), and one
without is like no other (0).  Equal texts have equal fingerprints.  Extra columns are
ignored; an empty table gives no rows; a single document is its own next one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Emitter, mix64, rows_of, shuffle_partitions, written

HASHES = 64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BY = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; grown when a longer text comes."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 14), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


class Parser:
    """LZ78 parse state that can be taken back to a mark."""

    def __init__(self):
        self.trie, self.node, self.size = {}, 0, 0

    def extend(self, codes: list[int], at: int, cuts: list[int], added: list[int] | None = None) -> None:
        """Parse on; phrase ends go to ``cuts``, new trie keys to ``added``."""
        trie, node, size = self.trie, self.node, self.size
        get = trie.get
        for at, c in enumerate(codes, at + 1):
            key = node | c
            known = get(key)
            if known is None:
                size += 1
                trie[key] = size << 21
                node = 0
                cuts.append(at)
                if added is not None:
                    added.append(key)
            else:
                node = known
        self.node, self.size = node, size


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _print(codes: np.ndarray, cuts: list[int]) -> str:
    """Fingerprint of the phrases that end at ``cuts`` (and at the end of the text)."""
    n = len(codes)
    if not n:
        return "f" * (4 * HASHES)
    ends = np.array(cuts if cuts and cuts[-1] == n else [*cuts, n], np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power(_INVERSE, n))])
    keys = (sums[ends] - sums[starts]) * _power(_BASE, n)[starts]
    keys = np.unique(mix64(keys + (ends - starts).astype(np.uint64)))
    low = np.full(HASHES, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(keys), 2048):
        np.minimum(low, (keys[at:at + 2048, None] * _BY).min(0), out=low)
    return (mix64(low) & np.uint64(0xFFFF)).astype(">u2").tobytes().hex()


def fingerprint(text: str | None) -> str:
    codes, cuts = _codes(text or ""), []
    Parser().extend(codes.tolist(), 0, cuts)
    return _print(codes, cuts)


def likeness(left: str, right: str) -> float:
    """Share of equal minima."""
    if left == right:
        return 1.0
    empty = "f" * (4 * HASHES)
    if empty in (left, right):
        return 0.0
    a, b = (np.frombuffer(bytes.fromhex(x), ">u2") for x in (left, right))
    return float((a == b).mean())


def with_edited(text: str, after: str) -> tuple[str, str, str]:
    """Edited text (the last quarter replaced by the start of ``after``), and the
    fingerprints of ``text`` and of it.  The common start is parsed once."""
    replaced = len(text) // 4
    edited = text[:len(text) - replaced] + after[:replaced]
    codes, other, stem = _codes(text), _codes(edited), len(text) - replaced
    parser, cuts, added = Parser(), [], []
    parser.extend(codes[:stem].tolist(), 0, cuts)
    node, size, shared = parser.node, parser.size, list(cuts)
    parser.extend(codes[stem:].tolist(), stem, cuts, added)
    for key in added:
        del parser.trie[key]
    parser.node, parser.size = node, size
    parser.extend(other[stem:].tolist(), stem, shared)
    return edited, _print(codes, cuts), _print(other, shared)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, fingerprint."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.string())],
                ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


_OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
_ROWS = pa.schema([("part", pa.int32()), ("place", pa.string()), ("text", pa.string()), ("doc_id", pa.int64()),
                   ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                   ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _finished(doc_id, text: str, after: str, next_print: str | None) -> tuple:
    """An output row but for near_next, which needs the next document's fingerprint."""
    edited, own, other = with_edited(text, after)
    near_next = None if next_print is None else likeness(own, next_print)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), own, other,
            likeness(own, other), near_next)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text): each document's fingerprint against those of its edited text
    and of the next document by id."""
    spark = docs.sparkSession
    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(shuffle_partitions(spark), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie"))

    def run(batches):
        out, part, held, row = Emitter(_ROWS), TaskContext.get().partitionId(), None, None
        for r in rows_of(batches):
            if held is None:  # the head of the partition: the document before it waits elsewhere
                yield from out.add((part, "head", r["text"], r["doc_id"], None, None, fingerprint(r["text"]), *[None] * 3),
                                   len(r["text"]))
            else:
                done = _finished(held["doc_id"], held["text"], r["text"], None)
                if row is not None:
                    yield from out.add((part, "done", None, *row[:-1], likeness(row[3], done[3])), 1000)
                row = done
            held = r
        if held is not None:
            own = fingerprint(held["text"])
            if row is not None:
                yield from out.add((part, "done", None, *row[:-1], likeness(row[3], own)), 1000)
            yield from out.add((part, "tail", held["text"], held["doc_id"], None, None, own, *[None] * 3), len(held["text"]))
        yield from out.rest()

    rows = written(ordered.select("doc_id", "text").mapInArrow(
        run, "part int, place string, text string, " + _DDL), "fingerprints")
    parts = sorted(r["part"] for r in rows.where("place = 'tail'").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    heads = rows.where("place = 'head'").select(F.col("part").alias("next"), F.col("text").alias("after"),
                                                F.col("fingerprint").alias("next_print"))
    tails = (rows.where("place = 'tail'").select("part", "doc_id", "text").join(follows, "part").join(heads, "next"))

    def close(batches):
        for batch in batches:
            found = [_finished(*v) for v in zip(*(batch.column(c).to_pylist() for c in (
                "doc_id", "text", "after", "next_print")))]
            columns = list(zip(*found)) or [()] * len(_OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, _ROWS.field(n).type) for c, n in zip(columns, _OUT)], _OUT)

    return (rows.where("place = 'done'").select(*_OUT)
            .unionByName(tails.select("doc_id", "text", "after", "next_print").mapInArrow(close, _DDL)))
