"""Operator 10: byte-level BPE by a global distinct-word shuffle.

A text is cut into words: a run of non-space characters with one space before it, or a
run of white space as the pre-token pattern takes it.  No pre-token crosses such a word,
so the pre-tokens of a word are those the pattern finds in the whole text.  The words keep
their positions (:mod:`tessera.llm.blocks`), every distinct word of a bucket is split by
the pattern and encoded once, and the ids are joined back and put in order by position.
Decoding joins ids with the token-byte table, whose size the rank file fixes (about
50,000 rows), so each task holds it.

NULL and empty texts have no tokens (digests of the empty string).  Repeated rows and
repeated ids give one row each; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import (Emitter, Ragged, by_bucket, pack, reassemble, rows_of, unpack,
                                unpack_words, write_blocks)

#: A word: non-space characters after at most one space, else white space as the pattern takes it.
_WORD = regex.compile(r" ?\S+|\s+(?!\S)|\s+")

_IDS = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("lengths", pa.binary()),
                  ("ids", pa.binary())])


def split_words(text: str) -> list[bytes]:
    return [w.encode("utf-8") for w in _WORD.findall(text)]


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def load_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path),
                             special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    """The token-byte table: id -> bytes."""
    return {v: k for k, v in load_ranks(path).items()}


def encode_words(dictionary: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode each distinct word once in the task of its bucket."""
    def run(batches):
        encoding, known, out = load_encoding(path, pattern), {}, Emitter(_IDS)
        for r in rows_of(batches):
            items = unpack_words(r["words"])
            for w in items:
                if w not in known:
                    known[w] = np.array(encoding.encode_ordinary(w.decode("utf-8")), np.uint32)
            ids = [known[w] for w in items]
            lengths = np.fromiter(map(len, ids), np.uint32, len(ids))
            row = (r["block"], r["codes"], pack(lengths), pack(np.concatenate(ids)))
            yield from out.add(row, sum(map(len, row[1:])))
        yield from out.rest()

    return by_bucket(dictionary.drop("counts")).mapInArrow(
        run, "block long, codes binary, lengths binary, ids binary")


def word_ids(rows: list[dict]) -> Ragged:
    return Ragged([(unpack(r["codes"]), unpack(r["lengths"]), unpack(r["ids"])) for r in rows])


def encode_decode(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256, and with
    ``keep_ids`` also ids (array) and decoded (binary)."""
    documents, dictionary = write_blocks(
        docs.select("doc_id", "text", F.lit(True).alias("flag")), split_words, "bpe")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    if keep_ids:
        schema += ", ids array<int>, decoded binary"
        arrow = arrow.append(pa.field("ids", pa.list_(pa.int32()))).append(pa.field("decoded", pa.binary()))

    def finish(block_docs, rows):
        table, of_word = token_bytes(path), word_ids(rows)
        each = [of_word.values[a:a + n].tolist() for a, n in zip(of_word.start, of_word.length)]
        decimal = [",".join(map(str, ids)) for ids in each]
        plain = [b"".join([table[i] for i in ids]) for ids in each]
        for doc_id, _, codes in block_docs:
            at = codes.tolist()
            decoded = b"".join([plain[c] for c in at])
            row = (doc_id, int(of_word.length[codes].sum()),
                   hashlib.sha256(",".join([decimal[c] for c in at]).encode()).hexdigest(),
                   hashlib.sha256(decoded).hexdigest())
            yield (*row, of_word.take(codes).astype(np.int32), decoded) if keep_ids else row

    return reassemble(documents, encode_words(dictionary, path, pattern), finish, schema, arrow)
