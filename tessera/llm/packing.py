"""Operator 7: vector best-fit packing of documents into sequences.

Each document's ids are cut into pieces of at most ``capacity`` tokens.  A piece has a
demand vector (tokens, one document, attention cost length^2) and a sequence a capacity
vector; pieces go in falling length into the open sequence whose residual vector fits best
under every constraint: the smallest weighted norm of what would be left, or the smallest
weighted dot product of residual and demand.

A demand depends on the length alone, so the plan needs only how many pieces have each
length: at most ``capacity`` rows, whatever the size of the corpus.  The driver runs
best-fit on that histogram with whole groups of equal sequences at a time, and returns
segments (length, ordinals, sequences) that also depend on the capacity only.  Every piece
then finds its segment by its length and its ordinal among the pieces of that length;
ordinals come from counts by block and a running sum, so no length is gathered in one task.

A NULL or empty text is the single end id.  Repeated rows and ids are packed as documents
of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.blocks import (Emitter, Ragged, by_bucket, pack, reassemble, rows_of, unpack,
                                unpack_words, write_blocks)
from tessera.llm.common import words, written

CAPACITY = 4096
END_ID = 1
BLOCK_BYTES = 32 << 20

_IDS = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("lengths", pa.binary()),
                  ("ids", pa.binary())])
_PIECES = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
                     ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("nth", pa.int64())])
_PIECES_DDL = ("block long, doc_id long, piece int, start long, length long, ids_crc32 long, nth long")


@lru_cache(maxsize=2)
def load_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


class _Growing(Ragged):
    """Arrays of numbers to which more are added; the buffers double as they fill."""

    def __init__(self):
        super().__init__([])
        self.arrays = self.used = 0

    @staticmethod
    def _room(held: np.ndarray, n: int) -> np.ndarray:
        if n <= len(held):
            return held
        return np.concatenate([held, np.empty(max(n, 2 * len(held)) - len(held), held.dtype)])

    def extend(self, more: list[list[int]]) -> None:
        length = np.fromiter(map(len, more), np.int64, len(more))
        last, end = self.arrays + len(more), self.used + int(length.sum())
        self.start, self.length = self._room(self.start, last), self._room(self.length, last)
        self.values = self._room(self.values, end)
        self.start[self.arrays:last] = self.used + np.cumsum(length) - length
        self.length[self.arrays:last] = length
        self.values[self.used:end] = np.fromiter(chain.from_iterable(more), np.uint32, end - self.used)
        self.arrays, self.used = last, end


def encode_words(dictionary: DataFrame, path: str) -> DataFrame:
    """Ids of each distinct word, encoded once.  The tokenizer never merges across white
    space, so a text's ids are those of its words one after another."""
    def run(batches):
        tokenizer, known, out = load_tokenizer(path), {}, Emitter(_IDS)
        ids = _Growing()
        for r in rows_of(batches):
            items = unpack_words(r["words"])
            new = [w for w in items if w not in known]
            known.update(zip(new, range(len(known), len(known) + len(new))))
            for at in range(0, len(new), 1000):
                part = [w.decode("utf-8") for w in new[at:at + 1000]]
                ids.extend([e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)])
            which = np.fromiter(map(known.__getitem__, items), np.int64, len(items))
            row = (r["block"], r["codes"], pack(ids.length[which]), pack(ids.take(which)))
            yield from out.add(row, sum(map(len, row[1:])))
        yield from out.rest()

    return by_bucket(dictionary.drop("counts")).mapInArrow(
        run, "block long, codes binary, lengths binary, ids binary")


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document, with ``nth``: the piece's number among the block's pieces
    of its length."""
    documents, dictionary = write_blocks(docs.select("doc_id", "text", F.lit(True).alias("flag")), words, "packing",
                                         block_bytes=BLOCK_BYTES)

    def finish(block_docs, rows):
        of_word = Ragged([(unpack(r["codes"]), unpack(r["lengths"]), unpack(r["ids"])) for r in rows])
        block, seen = None, {}
        for doc_id, block, codes in block_docs:
            ids = np.append(of_word.take(codes), np.uint32(end_id)).astype("<u4")
            for piece, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start:start + capacity]
                nth = seen.get(len(part), 0)
                seen[len(part)] = nth + 1
                yield block, doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), nth

    marked = documents.withColumn("flag", F.col("block"))  # finish sees the block's number
    return written(reassemble(marked, encode_words(dictionary, path), finish, _PIECES_DDL, _PIECES), "pieces")


class Plan:
    """Segments of the packing: pieces ``first`` .. of a length fill ``copies`` at a time
    the sequences from ``sequence`` on, from ``offset`` in each."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]], sequences: int):
        self.sequences = sequences
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.key = (table[:, 0] << 40) + table[:, 1]
        self.length, self.first, self.sequence, self.copies, self.offset = table.T

    def place(self, length: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 40) + ordinal, side="right") - 1
        inside = ordinal - self.first[at]
        return (self.sequence[at] + inside // self.copies[at],
                self.offset[at] + inside % self.copies[at] * length)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY, max_documents: int | None = None,
             max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.0, 0.05),
             rule: str = "norm") -> Plan:
    """Vector best-fit decreasing over a histogram length -> pieces.  ``max_documents`` and
    ``max_attention`` (sum of squared lengths) bound a sequence besides its tokens; left
    out, they are as large as the token capacity allows."""
    limit = np.array([capacity, max_documents or capacity, max_attention or capacity * capacity], np.int64)
    scale = np.array(weights) / limit.astype(float) ** 2
    groups: dict[tuple[int, int, int], list[list[int]]] = {}  # residual -> [first sequence, how many]
    states = np.empty((0, 3), np.int64)
    rows, opened = [], 0

    def add(state: tuple, first: int, n: int) -> None:
        nonlocal states
        if n:
            if state not in groups:
                groups[state] = []
                states = np.vstack([states, np.array([state], np.int64)])
            groups[state].append([first, n])

    for length in sorted(histogram, reverse=True):
        demand = np.array([length, 1, length * length], np.int64)
        if (demand > limit).any():
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        left, done = histogram[length], 0
        while left:
            fits = np.flatnonzero((states >= demand).all(1))
            if len(fits):
                room = states[fits]
                if rule == "norm":
                    score = ((room - demand).astype(float) ** 2 * scale).sum(1)
                else:
                    score = (room.astype(float) * demand * scale).sum(1)
                state = tuple(int(v) for v in room[int(np.argmin(score))])
                first, n = groups[state].pop()
                if not groups[state]:
                    del groups[state]
                    states = states[(states != np.array(state)).any(1)]
            else:
                state = tuple(int(v) for v in limit)
                n = -(-left // int(min(limit // demand)))
                first, opened = opened, opened + n
            copies = int(min(np.array(state) // demand))
            offset = capacity - state[0]

            def after(k: int, state=state) -> tuple:
                return tuple(int(v) for v in np.array(state) - k * demand)

            full = min(n, left // copies)
            if full:
                rows.append((length, done, first, copies, offset))
                add(after(copies), first, full)
                done, left = done + full * copies, left - full * copies
            if full < n and left:  # one sequence gets the rest, fewer than copies
                rows.append((length, done, first + full, left, offset))
                add(after(left), first + full, 1)
                done, left, full = done + left, 0, full + 1
            add(state, first + full, n - full)
    return Plan(rows, opened)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **constraints) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_pieces(docs, path, capacity)
    counts = written(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(best_fit(histogram, capacity, **constraints))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("block")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = pieces.join(counts.select("block", "length", before.alias("before")), ["block", "length"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.value.place(batch["length"].to_numpy(), batch["ordinal"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (ordered.withColumn("ordinal", F.col("before") + F.col("nth"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "ordinal")
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                               "sequence_id long, offset long"))
