"""Operator 5: near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its distinct word shingles, as 64-bit hashes.  Its signature has
``chunks * width`` symbols: the low ``bits`` bits of as many MinHash values.  Two
signatures are as far apart as they have differing symbols.  The signature is split into
chunks; if two of them differ in at most ``chunks * (errors + 1) - 1`` symbols, some chunk
has at most ``errors`` differing ones (pigeonhole), and they then share one of the chunk's
variants, each of which leaves out ``errors`` symbols.  So a join on variants finds every
pair within that radius; pairs beyond it that share a variant are taken as well.  With the
defaults (14 chunks of 6, one error) a pair of similarity 0.8 shares none with probability
0.345^14 = 3e-7.

Equal sets are one node, so copies never meet in a bucket.  In a bucket (a variant that
several nodes have) nodes are first compared with the bucket's centre only, and each node
is confirmed against its best centre.  The first centre is the node that meets most others
over all its buckets, in a family of near copies the one nearest to what they share; the
second is the most met one outside the first one's component; later ones follow an order
that each chunk has for itself.  Nodes that are then in one component need no comparison.

What is left is joined exactly through pivots.  A node's pivot is the most met of its first
centres, a whole family's usually the same.  A node that has the similarity with its pivot is
paired with it.  Of two others, or of such a one and another, the shingles in which they
differ from the pivot must have a certain number in common, which follows from the sizes
and is never 0; so they meet by (pivot, difference), where only a node's rarest differences
are taken, as many as make sure that a common one is among them.  Nodes of different
pivots meet in their buckets.  Pairs that their counts exclude are not made.  A pair goes
on to confirmation if its signatures agree in at least ``agree`` of the symbols (0.55: a
pair of similarity 0.8 fails with probability below 1e-7) and becomes a link if the full
shingle sets have the similarity.

Defined results: a NULL or empty text has no shingles and is linked with nothing; a text
with fewer words than a shingle is one shingle; a row with a NULL id is linked with nothing,
is its own component (NULL) and is kept; rows that repeat an id are documents of their own,
whose component has the smallest id of all its rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_CLASS, mix64, written, written_in_buckets
from tessera.llm.components import components
from tessera.session import shared_dir

MAX_CACHED_WORDS = 20_000   # the frequent ones; more take memory and save no time
BIT_WORDS = 1 << 20         # of 64 bits each


@dataclass(frozen=True)
class Parameters:
    shingle: int = 5
    percent: int = 80
    chunks: int = 14
    width: int = 6
    errors: int = 1
    bits: int = 8
    agree: float = 0.55
    rounds: int = 3

    def __post_init__(self):
        if self.bits > 8 or self.bits * (self.width - self.errors) + self.variants.bit_length() > 63:
            raise ValueError("a variant must fit a 63-bit key, a symbol a byte")

    @property
    def symbols(self) -> int:
        return self.chunks * self.width

    @property
    def variants(self) -> int:
        return self.chunks * comb(self.width, self.errors)

    @property
    def radius(self) -> int:
        return self.chunks * (self.errors + 1) - 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, size: int, cache: dict | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words of the whole text."""
    found = text.encode("utf-8").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    cache = _WordHashes() if cache is None else cache
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    size = min(size, len(h))
    key = h[:len(h) - size + 1]
    for i in range(1, size):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i])
    return np.unique(mix64(key + np.uint64(size)))


def node_of(keys: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(keys.tobytes(), digest_size=8).digest(), "little", signed=True)


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def signature(keys: np.ndarray, p: Parameters) -> bytes:
    by, low = _multipliers(p.symbols), np.full(p.symbols, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(keys), 2048):
        values = keys[at:at + 2048, None] * by
        values >>= np.uint64(32)
        np.minimum(low, values.min(0), out=low)
    return (low & np.uint64((1 << p.bits) - 1)).astype(np.uint8).tobytes()


def describe(docs: DataFrame, p: Parameters) -> DataFrame:
    """doc_id, n_shingles, node, sig and row_key (a hash of id and text) of every row."""
    def run(batches):
        cache = _WordHashes()
        for batch in batches:
            sizes, names, sigs = [], [], []
            for text in batch.column("text"):
                keys = shingles(text.as_py(), p.shingle, cache)
                sizes.append(len(keys))
                names.append(node_of(keys) if len(keys) else None)
                sigs.append(signature(keys, p) if len(keys) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
                 pa.array(sigs, pa.binary()), batch.column("row_key")],
                ["doc_id", "n_shingles", "node", "sig", "row_key"])

    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key")).mapInArrow(
        run, "doc_id long, n_shingles long, node long, sig binary, row_key long")


def postings(nodes: DataFrame, p: Parameters) -> DataFrame:
    """(key, node): every variant of every chunk of a node's signature."""
    kept = [list(c) for c in combinations(range(p.width), p.width - p.errors)]
    shifts = np.arange(p.width - p.errors, dtype=np.int64) * p.bits

    def run(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8)
            sig = sig.reshape(-1, p.chunks, p.width).astype(np.int64)
            keys = np.stack([(sig[:, :, c] << shifts).sum(2) for c in kept], 2).reshape(len(sig), p.variants)
            keys = keys * p.variants + np.arange(p.variants)
            nodes_of = np.repeat(batch.column("node").to_numpy(), p.variants)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes_of)], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def agreeing(pairs: DataFrame, nodes: DataFrame, p: Parameters) -> DataFrame:
    """(a, b, same): pairs whose signatures agree in enough symbols."""
    sig = nodes.select("node", "sig")
    least = int(np.ceil(p.agree * p.symbols))

    def run(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, p.symbols)
                           for c in ("sig_a", "sig_b"))
            same = (left == right).sum(1)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same, pa.int32())],
                                             ["a", "b", "same"])
            yield out.filter(pa.array(same >= least))

    return (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, same int"))


def with_bit_of(need: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """The rows whose hashed column ``name`` has its bit set by some row of ``need``: all that a
    join on it finds, and few others, so that most are not shuffled for the join.  The broadcast
    bits have at most ``BIT_WORDS`` rows; very many values only make them let more through."""
    word = F.pmod(F.xxhash64(name), F.lit(BIT_WORDS)).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({name}), 58) as int))")
    bits = need.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return (rows.withColumn("word", word).join(F.broadcast(bits), "word")
            .where(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits"))


class _Sets:
    """Full shingle sets of the nodes that some pair needs, written as they come to be needed:
    in buckets of nodes, which a join by node reads in place, and ``spread``, the same files
    without their buckets, for joins in which a few nodes may have most of the rows."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, p: Parameters):
        self.docs, self.nodes, self.p, self.tables = docs, nodes, p, []

    def cover(self, pairs: DataFrame) -> None:
        need = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        for have, _ in self.tables:
            need = need.join(have.select("node"), "node", "left_anti")
        need = written(need.join(self.nodes.select("node", "doc_id"), "node"), "need")
        if not need.isEmpty():
            spark, path = self.docs.sparkSession, shared_dir(self.docs.sparkSession, "llm_sets")
            table = written_in_buckets(self._read(need), "sets", "node", path)
            self.tables.append((table, spark.read.schema(table.schema).parquet(path)))

    def by_node(self) -> DataFrame:
        return self._all(0)

    def spread(self) -> DataFrame:
        return self._all(1)

    def _all(self, form: int) -> DataFrame:
        if not self.tables:
            return self.docs.sparkSession.createDataFrame([], "node long, keys binary")
        return reduce(DataFrame.unionByName, [t[form] for t in self.tables])

    def _read(self, need: DataFrame) -> DataFrame:
        size = self.p.shingle

        def run(batches):
            cache = _WordHashes()
            for batch in batches:
                out = {}
                for text, node in zip(batch.column("text"), batch.column("node").to_pylist()):
                    keys = shingles(text.as_py(), size, cache)
                    if len(keys) and node_of(keys) == node:  # rows may share an id but not the text
                        out[node] = keys.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())],
                                                 ["node", "keys"])

        return (with_bit_of(need, self.docs.select("doc_id", "text"), "doc_id").join(need, "doc_id")
                .mapInArrow(run, "node long, keys binary").dropDuplicates(["node"]))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, spread: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) whose full sets have the similarity, exactly; a b may have many pairs."""
    def run(batches):
        for batch in batches:
            ok = []
            for left, right in zip(batch.column("keys_a"), batch.column("keys_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(ok, pa.bool_()))

    others = with_bit_of(pairs.select(F.col("b").alias("node")), sets if spread is None else spread, "node")
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("keys").alias("keys_a")), "a")
            .join(others.select(F.col("node").alias("b"), F.col("keys").alias("keys_b")), "b")
            .select("a", "b", "keys_a", "keys_b").mapInArrow(run, "a long, b long"))


def shared_counts(sets: DataFrame) -> DataFrame:
    """(node, shared): how many of a node's shingles some other node of ``sets`` has, too.
    A shingle that very many nodes have is counted before it is shuffled."""
    def run(batches):
        for batch in batches:
            keys = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column("keys")]
            owner = np.repeat(batch.column("node").to_numpy(), list(map(len, keys)))
            every = np.concatenate(keys) if keys else np.empty(0, np.int64)
            for at in range(0, len(every), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(owner[at:at + (1 << 18)]), pa.array(every[at:at + (1 << 18)])],
                                                 ["node", "shingle"])

    rows = sets.mapInArrow(run, "node long, shingle long")
    common = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    return rows.join(common, "shingle").groupBy("node").agg(F.count("*").alias("shared"))


def pivoted(nodes: DataFrame, sets: DataFrame, spread: DataFrame) -> DataFrame:
    """``nodes`` (node, pivot, ...) with ``apart``, the shingles that either a node or its
    pivot has but not both, and ``pivot_n``, the pivot's number of shingles."""
    def run(batches):
        for batch in batches:
            apart, sizes = [], []
            for own, other in zip(batch.column("keys"), batch.column("pivot_keys")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (own, other))
                apart.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
                sizes.append(len(y))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sizes, pa.int64()), pa.array(apart, pa.list_(pa.int64()))],
                ["node", "pivot_n", "apart"])

    both = (nodes.select("node", "pivot").join(sets, "node")
            .join(with_bit_of(nodes.select(F.col("pivot").alias("node")), spread, "node")
                  .select(F.col("node").alias("pivot"), F.col("keys").alias("pivot_keys")), "pivot")
            .select("node", "keys", "pivot_keys"))
    return nodes.join(both.mapInArrow(run, "node long, pivot_n long, apart array<long>"), "node")


def _pairs(left: DataFrame, right: DataFrame, by: list[str], condition) -> DataFrame:
    """(a, b) of rows x and y with equal ``by`` and different components that meet ``condition``."""
    x, y = (rows.select(*by, F.struct(*[c for c in rows.columns if c not in by or c == "pivot"]).alias(mark))
            for rows, mark in ((left, "x"), (right, "y")))
    return (x.join(y, by).where((F.col("x.comp") != F.col("y.comp")) & condition)
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _by_differences(full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one pivot; ``full``: rows of :func:`pivoted`.

    Sets x and y have the similarity if and only if at most r(|x| + |y|) shingles are in one
    of them only, r = (100 - percent) / (100 + percent).  Those are the differences dx and dy
    from the pivot c less what both have, so |dx & dy| >= (|dx| + |dy| - r(|x| + |y|)) / 2.  A
    node is near if it has the similarity with the pivot; it is paired with the pivot, and two
    near nodes need no pair.  For far y, |dy| > r(|y| + |c|), so x shares more than
    (|dx| + r(|c| - |x|)) / 2 of its differences with it, which is no less than 0; and far y
    shares at least (|dy| - r(|y| + |c|)) / 2 > 0 with any x.  So both have a common one among
    their rarest differences, leaving out as many as they must share less one (prefix filter);
    the first common one bounds by its places how many more there are."""
    plus, minus = 100 + percent, 100 - percent
    size = F.size("apart").cast("long")
    full = (full.withColumn("d", size)
            .withColumn("near", plus * F.col("d") <= minus * (F.col("n") + F.col("pivot_n")))
            .withColumn("with_far", F.floor((plus * F.col("d") + minus * (F.col("pivot_n") - F.col("n"))) / (2 * plus))
                        .cast("long") + 1)
            .withColumn("with_any", F.when(F.col("near"), F.col("with_far")).otherwise(
                F.ceil((plus * F.col("d") - minus * (F.col("pivot_n") + F.col("n"))) / (2 * plus)).cast("long"))))
    linked = full.where(F.col("near") & (F.col("comp") != F.col("pivot_comp"))).select(
        F.col("node").alias("a"), F.col("pivot").alias("b"))

    spread = full.select("pivot", "node", "comp", F.explode("apart").alias("shingle"))
    common = (spread.groupBy("pivot", "shingle")
              .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("nodes"))
              .where("low != high").select("pivot", "shingle", "nodes"))
    ranked = (spread.join(common, ["pivot", "shingle"]).groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("nodes", "shingle"))).alias("ranked")))
    prefix = (full.drop("apart", "pivot_comp", "pivot_n").join(ranked, "node")
              .withColumn("m", F.size("ranked").cast("long")).where("m >= with_any")
              .select("pivot", "node", "comp", "n", "d", "m", "near", "with_far", F.posexplode(
                  F.expr("slice(ranked, 1, cast(m - with_any + 1 as int))")).alias("at", "r"))
              .select("pivot", F.col("r.shingle").alias("shingle"), "node", "comp", "n", "d", "near",
                      (F.col("m") - F.col("at")).alias("left"),
                      (F.col("at") <= F.col("m") - F.col("with_far")).alias("ahead")))
    prefix = written(prefix, "prefix")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    met = _pairs(prefix.where("ahead"), prefix.where("not near"), ["pivot", "shingle"],
                 (x("near") | (y("ahead") & (x("node") < y("node"))))
                 & (100 * F.least(x("n"), y("n")) >= percent * F.greatest(x("n"), y("n")))
                 & (2 * plus * F.least(x("left"), y("left"))
                    >= plus * (x("d") + y("d")) - minus * (x("n") + y("n"))))
    return linked.unionByName(met)


def remaining_pairs(rest: DataFrame, sets: DataFrame, percent: int, spread: DataFrame | None = None) -> DataFrame:
    """Pairs of different components, of nodes that share a bucket, that link all which have
    the similarity; ``rest``: (key, node, comp, n, shared, pivot, pivot_comp).

    Nodes of one pivot meet by their differences from it; where the pivots differ, two nodes
    meet in a bucket if the smaller ``shared`` allows the similarity."""
    alone = rest.select("node", "comp", "n", "pivot", "pivot_comp").distinct()
    full = written(pivoted(alone, sets, sets if spread is None else spread), "pivoted")

    several = (rest.groupBy("key").agg(F.min("pivot").alias("low"), F.max("pivot").alias("high"))
               .where("low != high").select("key"))
    mixed = rest.join(several, "key").select("key", "node", "comp", "n", "shared", "pivot")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    across = _pairs(mixed, mixed, ["key"], (x("node") < y("node")) & (x("pivot") != y("pivot"))
                    & ((100 + percent) * F.least(x("shared"), y("shared")) >= percent * (x("n") + y("n"))))
    return _by_differences(full, percent).unionByName(across)


def link_nodes(docs: DataFrame, nodes: DataFrame, p: Parameters) -> DataFrame:
    """(node, comp) of the nodes that have a link; ``nodes``: (node, sig, n, doc_id of a row)."""
    def order(number: int):
        chunk = F.floor(F.pmod("key", F.lit(p.variants)) / (p.variants // p.chunks))
        return F.xxhash64("node", chunk, F.lit(number))

    several = postings(nodes, p).withColumn("size", F.count("*").over(Window.partitionBy("key"))).where("size > 1")
    multi = written(several, "buckets")
    met = multi.groupBy("node").agg(F.struct(F.sum("size").alias("met"), F.xxhash64("node").alias("o")).alias("rank"))
    multi = written(multi.drop("size").join(met, "node"), "ranked")
    sets, labels, edges = _Sets(docs, nodes, p), None, None
    sets.cover(multi.select(F.col("node").alias("a"), F.col("node").alias("b")))

    def with_comp(rows: DataFrame, node: str, comp: str) -> DataFrame:
        if labels is None:
            return rows.withColumn(comp, F.col(node))
        found = labels.select(F.col("node").alias(node), F.col("comp").alias(comp))
        return rows.join(found, node, "left").withColumn(comp, F.coalesce(comp, node))

    def open_buckets() -> DataFrame:
        """Rows of the buckets that have several components, with their components."""
        rows = with_comp(multi, "node", "comp")
        if labels is None:
            return rows
        rows = written(rows, "labelled")
        several = (rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                   .where("low != high").select("key"))
        return written(rows.join(several, "key"), "open")

    def first(rows: DataFrame, *by) -> DataFrame:
        return rows.groupBy("key").agg(F.max(F.struct(*by, "node", "comp")).alias("c"))

    def close(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return agreeing(ordered, nodes, p)

    def link(pairs: DataFrame, rounds: int | None) -> None:
        nonlocal labels, edges
        sets.cover(pairs)
        found = written(confirm(pairs, sets.by_node(), p.percent, sets.spread()), "links")
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
        if edges is not None and (rounds is None or not found.isEmpty()):
            labels = components(edges, rounds)

    pivots = None
    for number in range(p.rounds):
        rows = open_buckets()
        if number < 2:
            chosen = first(rows, "rank")
            if number:
                chosen = first(rows.join(chosen, "key").where("comp != c.comp").drop("c"), "rank")
        else:
            chosen = first(rows, order(number).alias("o"))
        rows = rows.join(chosen, "key")
        if not number:
            pivots = written(rows.groupBy("node").agg(F.max(F.struct("c.rank", "c.node"))["node"].alias("pivot")), "pivots")
        near = written(close(rows.where("comp != c.comp").select(F.col("node").alias("a"), F.col("c.node").alias("b"))),
                       "close")
        if near.isEmpty():
            break
        both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "same"))
        best = both.groupBy(F.col("a").alias("node")).agg(F.max_by("b", F.struct("same", "b")).alias("b"))
        once = best.groupBy(F.least("node", "b").alias("low"), F.greatest("node", "b").alias("high"))
        link(written(once.agg(F.max_by("node", "b").alias("a"), F.max("b").alias("b")).select("a", "b"), "best"),
             None if number == p.rounds - 1 else 3)
    # A pair shares at most what either node shares with any other that is left.
    rest = open_buckets().select("key", "node", "comp")
    left = sets.by_node().join(rest.select("node").distinct(), "node", "left_semi")
    sizes = (nodes.select("node", "n").join(shared_counts(left), "node")
             .where(100 * F.col("shared") >= p.percent * F.col("n")))
    sizes = written(with_comp(sizes.join(pivots, "node"), "pivot", "pivot_comp"), "sizes")
    rest = written(rest.join(sizes, "node"), "rest")
    link(written(close(remaining_pairs(rest, sets.by_node(), p.percent, sets.spread())).select("a", "b"), "remaining"), None)
    return labels if labels is not None else docs.sparkSession.createDataFrame([], "node long, comp long")


def _linked(docs: DataFrame, p: Parameters) -> tuple[DataFrame, DataFrame]:
    """Every row, and the nodes (node, doc_id, comp)."""
    rows = written(describe(docs, p), "signatures")
    nodes = written(rows.where("node is not null and doc_id is not null")
                    .groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"),
                         F.first("n_shingles").alias("n")), "nodes")
    labels = link_nodes(docs, nodes, p)
    return rows, (nodes.join(labels, "node", "left")
                  .select("node", "doc_id", F.coalesce("comp", "node").alias("comp")))


def near_duplicates(docs: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, kept for every row."""
    rows, members = _linked(docs, p)
    first = members.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = members.join(first, "comp").select("node", "component_id")
    linked = rows.where("doc_id is not null").join(named, "node", "left")
    apart = rows.where("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
    return (linked.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .unionByName(apart.select("doc_id", "n_shingles", "component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_first(docs: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each component one row,
    with the smallest id, stays.  Rows with a NULL id or without words all stay."""
    rows, members = _linked(docs, p)
    firsts = (rows.where("node is not null and doc_id is not null").join(members.select("node", "comp"), "node")
              .groupBy("comp").agg(F.min(F.struct("doc_id", "row_key")).alias("first")))
    key = next(n for n in (f"row_key_{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    has_words = F.coalesce(F.col("text").rlike(WORD_CLASS), F.lit(False)) & F.col("doc_id").isNotNull()
    stay = (docs.where(has_words).withColumn(key, F.xxhash64("doc_id", "text"))
            .join(firsts.select(F.col("first.row_key").alias(key)), key, "left_semi").dropDuplicates([key]))
    return stay.select(docs.columns).unionByName(docs.where(~has_words))
