"""Word dictionaries of blocks of documents.

Several operators treat each distinct word of the corpus once (encode it, count it) and
then need the result at every position of every document.  Exploding all positions into
rows would shuffle many times the text, so a task cuts its documents into blocks of a
bounded number of bytes and writes, for each block,

* one row per document: its words as codes into the block's dictionary, in order, and
* the dictionary, dealt by a hash of the word into buckets (packed rows).

A word crosses the network once per block that has it, never once per occurrence, so the
most frequent word of the corpus is no larger than any other word that is in every block.
Both kinds of rows come from one committed write, so a retried task cannot leave codes and
dictionaries that do not belong together.  The files are bucketed by block, so the codes
are not shuffled when the documents are put together again.

The dictionary rows of a bucket meet in one task (:func:`dictionary`), where every
distinct word is treated once; the results go back to their blocks, are put in the order
of the codes, and the documents are reassembled by position (:func:`reassemble`).
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Emitter, rows_of, shuffle_partitions, written_in_buckets

BLOCK_BYTES = 48 << 20
_DOC, _DICT = 0, 1

_SCHEMA = ("block long, kind int, doc_id long, flag boolean, stream binary, bucket int, codes binary, "
           "words binary, counts binary")
_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()),
                    ("flag", pa.bool_()), ("stream", pa.binary()), ("bucket", pa.int32()),
                    ("codes", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def pack_words(items: list[bytes]) -> bytes:
    lengths = pack(np.fromiter(map(len, items), np.uint32, len(items)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(items), 3)


def unpack_words(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack(data[4:4 + n]), dtype=np.int64).tolist()
    body = zstandard.decompress(data[4 + n:])
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def _occurrences(streams: list[np.ndarray], n: int) -> np.ndarray:
    """How often each of the codes 0 .. n-1 is in ``streams``, about as many codes at a time as
    there are words."""
    total, held, size = np.zeros(n, np.int64), [], 0
    for codes in streams:
        held.append(codes)
        size += len(codes)
        if size >= n:
            total += np.bincount(np.concatenate(held), minlength=n)
            held, size = [], 0
    return total + np.bincount(np.concatenate(held), minlength=n) if held else total


def _close(block: int, docs: list, index: dict, n_buckets: int, counted: bool) -> Iterator[tuple]:
    """Rows of a finished block.  Codes are renumbered by falling frequency, which makes
    them small numbers that compress well."""
    n = len(index)
    rank = np.empty(n, np.uint32)
    rank[np.argsort(-_occurrences([d[2] for d in docs], n), kind="stable")] = np.arange(n, dtype=np.uint32)
    for doc_id, flag, codes in docs:
        data = pack(rank[codes]) if len(codes) else None
        yield (block, _DOC, doc_id, flag, data, None, None, None, None), 64 + len(data or b"")
    if not n:
        return
    used = _occurrences([d[2] for d in docs if d[1]], n) if counted else None
    items = list(index)
    bucket = np.fromiter(map(zlib.crc32, items), np.uint32, n) % n_buckets
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        part = sorted(part.tolist(), key=items.__getitem__)
        row_words = pack_words([items[i] for i in part])
        row_codes = pack(rank[part])
        row_counts = pack(used[part]) if counted else None
        yield ((block, _DICT, None, None, None, int(bucket[part[0]]), row_codes, row_words, row_counts),
               len(row_words) + len(row_codes) + 64)


def write_blocks(docs: DataFrame, split: Callable[[str], list[bytes]], label: str,
                 counted: bool = False, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``docs`` has doc_id, text and flag.  Returns (documents, dictionary rows) of the
    blocks.  With ``counted`` a dictionary row also has, for each word, how often the
    block's documents with a true flag have it.  A NULL text has no words."""
    n_buckets = shuffle_partitions(docs.sparkSession)

    def run(batches):
        out = Emitter(_ARROW)
        base, serial = TaskContext.get().partitionId() << 32, count()
        held, index, size = [], defaultdict(count().__next__), 0
        for r in rows_of(batches):
            found = split(r["text"]) if r["text"] else []
            codes = np.fromiter(map(index.__getitem__, found), np.uint32, len(found))
            held.append((r["doc_id"], r["flag"], codes))
            size += len(r["text"] or "") + 64
            if size >= block_bytes:
                for row, n in _close(base + next(serial), held, index, n_buckets, counted):
                    yield from out.add(row, n)
                held, index, size = [], defaultdict(count().__next__), 0
        if held:
            for row, n in _close(base + next(serial), held, index, n_buckets, counted):
                yield from out.add(row, n)
        yield from out.rest()

    rows = docs.select("doc_id", "text", "flag").mapInArrow(run, _SCHEMA)
    both = written_in_buckets(rows, label, "block")
    return (both.where(F.col("kind") == _DOC).select("block", "doc_id", "flag", "stream"),
            both.where(F.col("kind") == _DICT).select("block", "bucket", "codes", "words", "counts"))


def by_bucket(dictionary: DataFrame) -> DataFrame:
    """All rows of a bucket in one partition; a word is in one bucket."""
    return dictionary.repartitionById(shuffle_partitions(dictionary.sparkSession), F.col("bucket"))


class Ragged:
    """Arrays of unsigned numbers of different lengths, for each of the codes 0 .. n-1."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """parts: (codes, lengths, values one after another)."""
        codes = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint32)
        lengths = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.uint32)
        self.values = np.concatenate([p[2] for p in parts]) if parts else np.empty(0, np.uint32)
        starts = np.cumsum(lengths, dtype=np.int64) - lengths
        self.start, self.length = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        self.start[codes], self.length[codes] = starts, lengths

    def take(self, codes: np.ndarray) -> np.ndarray:
        """The arrays of ``codes``, one after another."""
        length = self.length[codes]
        ends = np.cumsum(length)
        if not len(ends):
            return np.empty(0, np.uint32)
        at = np.arange(ends[-1]) + np.repeat(self.start[codes] - (ends - length), length)
        return self.values[at]


def reassemble(documents: DataFrame, results: DataFrame, finish: Callable, schema: str,
               arrow: pa.Schema) -> DataFrame:
    """Bring the documents of a block and the results of its words together.  ``finish``
    gets the documents' (doc_id, flag, codes) and the result rows of one block, a bounded
    amount, and yields output tuples.  A block without words has no result rows."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = [(r["doc_id"], r["flag"], unpack(r["stream"]) if r["stream"] else np.empty(0, np.uint32))
                for r in left.to_pylist()]
        out = list(finish(docs, right.to_pylist()))
        columns = list(zip(*out)) or [()] * len(arrow)
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, arrow)], schema=arrow)

    return (documents.groupBy("block").cogroup(results.groupBy("block"))
            .applyInArrow(run, schema))
