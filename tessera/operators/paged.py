"""Chunks and their term frequencies, written once and kept together by page.

``windows`` holds every chunk of a document table once.  ``counts`` is derived from it and has a row
for each (page, term): how many chunks of the page have the term at each level, and as ``entries``
its frequencies in each of these chunks.  Both are bucketed by page, so terms are counted, ranked
and weighted where they are, a page at a time in Arrow vector functions; what has to meet by term
(document frequencies, idf, postings) travels as one row for each page that has the term, not for
each chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.group_ops import PandasCogroupedOps
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.functions import constants as K
from tessera.operators.pyramid import PyramidParts
from tessera.sources.paged import bucket_count, write_paged

PAGE_CHUNKS = 256
BLOCK_CHUNKS = 8     # chunks that share a largest weight for each term
CHUNK = ["page", "doc_id", "chunk_no"]
_SEGMENT, _PARTITION, _ROW = 2 ** 40, 2 ** 18, 2 ** 33
_TOKEN_BYTES = np.zeros(256, bool)
_TOKEN_BYTES[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_STOPWORDS = pa.array(K.STOPWORDS)
_NO_PLACE = 1 << 62


def write_windows(parts: PyramidParts, path: str, segment: int = 0) -> DataFrame:
    """``(page, doc_id, chunk_no, chunk_id, start_char, end_char, raw_text, summary)``."""
    rows = parts.chunks.withColumn("_row", F.monotonically_increasing_id())
    page = (F.lit(segment * _SEGMENT).cast("long") + F.shiftright("_row", 33) * _PARTITION
            + F.expr(f"(_row & {_ROW - 1}L) div {PAGE_CHUNKS}"))
    windows = rows.select(page.alias("page"), *parts.chunks.columns, parts.summary(F.col("raw_text")).alias("summary"))
    return write_paged(windows, path, bucket_count(windows.sparkSession))


def entries_type(doc_id: T.DataType = T.LongType(), chunk_no: T.DataType = T.IntegerType()) -> T.ArrayType:
    """Of each chunk of a page with a term: its number in the page (``slot``), its key and block, the
    term's frequency at each level (NULL where the level does not have it), and the term's place
    among the chunk's keywords."""
    return T.ArrayType(T.StructType([
        T.StructField("slot", T.IntegerType()), T.StructField("doc_id", doc_id), T.StructField("chunk_no", chunk_no),
        T.StructField("block", T.LongType()), *[T.StructField(lv, T.DoubleType()) for lv in K.LEVELS],
        T.StructField("place", T.IntegerType())]))


def counts_schema(doc_id: T.DataType = T.LongType(), chunk_no: T.DataType = T.IntegerType()) -> T.StructType:
    return T.StructType([T.StructField("page", T.LongType()), T.StructField("term", T.StringType()),
                         *[T.StructField(f"df_{lv}", T.LongType()) for lv in K.LEVELS],
                         T.StructField("entries", entries_type(doc_id, chunk_no))])


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _numbers(column: pa.Array) -> np.ndarray:
    """As doubles; NaN for NULL."""
    return pc.fill_null(column, float("nan")).to_numpy(zero_copy_only=False)


def _nullable(values: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.array(values, kind, mask=np.isnan(values))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    change = np.zeros(len(keys[0]) - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.append(0, np.flatnonzero(change) + 1)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of lower-cased texts that end with a line break, as :func:`tessera.functions.text.tokenize`
    cuts them: each token's text and term, and the terms in order."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    kept = _TOKEN_BYTES[data]
    edges = np.flatnonzero(kept[1:] != kept[:-1]) + 1
    if kept[0]:
        edges = np.append(0, edges)
    starts, length = edges[::2], edges[1::2] - edges[::2]
    kept[starts[length == 1]] = False
    starts, length = starts[length > 1], length[length > 1]
    ends = np.append(0, np.cumsum(length))
    tokens = pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[kept]))
    coded = tokens.dictionary_encode()
    codes, terms = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())
    order = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    wanted = ~pc.is_in(terms, value_set=_STOPWORDS).to_numpy(zero_copy_only=False)[codes]
    text = np.searchsorted(offsets - offsets[0], starts[wanted], side="right") - 1
    return text, rank[codes[wanted]], terms.take(pa.array(order))


def _numbered(keys) -> tuple[np.ndarray, int]:
    """A number for each distinct key, in order of appearance."""
    index: dict = {}
    return np.array([index.setdefault(k, len(index)) for k in keys], np.int64), len(index)


def count_page(windows: pa.Table, top_k: int) -> pa.Table | None:
    """The rows of :func:`counts_schema` of one page, from its chunks with their lower-cased ``_raw``
    text and ``_short`` summary, a line break after each; sorted by term, entries by block.  Rows of one chunk key
    with as many tokens are counted as one chunk."""
    raw, short = _column(windows, "_raw"), _column(windows, "_short")
    m = len(raw)
    text, term, terms = _tokens(pa.concat_arrays([raw, short]))
    if not len(term):
        return None
    sizes = np.bincount(text, minlength=2 * m)
    pos = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[text]
    pos[text >= m] = _NO_PLACE
    doc_id, chunk_no = _column(windows, "doc_id"), _column(windows, "chunk_no")
    keys = list(zip(doc_id.to_pylist(), chunk_no.to_pylist()))
    slot_of, slots = _numbered(keys)
    row_of = np.unique(slot_of, return_index=True)[1]
    variant_of, variants = _numbered(zip(slot_of, sizes[:m], sizes[m:]))
    first_row = np.unique(variant_of, return_index=True)[1]

    key = term * variants + variant_of[text % m]
    order = np.argsort(key, kind="stable")
    key, in_text = key[order], (text < m)[order].astype(np.int64)
    at = _firsts(key)
    cnt, first_pos = np.add.reduceat(in_text, at), np.minimum.reduceat(pos[order], at)
    cnt_short = np.diff(np.append(at, len(key))) - cnt
    term, variant = np.divmod(key[at], variants)
    slot, of_row = slot_of[first_row][variant], first_row[variant]

    found = np.flatnonzero(cnt)
    found = found[np.lexsort((first_pos[found], -cnt[found], slot[found]))]
    n_terms = np.bincount(slot[found], minlength=slots)
    place = np.full(len(term), np.nan)
    place[found] = np.arange(len(found)) - (np.cumsum(n_terms) - n_terms)[slot[found]] + 1
    place[place > top_k] = np.nan

    leads = np.full((2, slots), -1)
    for i in (1, 0):
        leads[i][slot[place == i + 1]] = term[place == i + 1]
    in_order = sorted(np.flatnonzero(leads[0] >= 0).tolist(), key=lambda s: (
        leads[0][s], leads[1][s], *[(k is not None, k) for k in keys[row_of[s]]]))
    page = _column(windows, "page")[0].as_py()
    block = np.full(slots, np.nan)
    block[in_order] = np.arange(len(in_order)) // BLOCK_CHUNKS

    with np.errstate(divide="ignore", invalid="ignore"):
        values = {"raw": np.where(cnt > 0, cnt / sizes[:m][of_row], np.nan),
                  "summary": np.where(cnt_short > 0, cnt_short / sizes[m:][of_row], np.nan),
                  # each keyword is one token of the keyword level
                  "keywords": np.where(place > 0, 1.0 / np.minimum(n_terms, top_k)[slot], np.nan)}
    order = np.lexsort((block[slot], term))
    slot, term = slot[order], term[order]
    at = _firsts(term)
    of_slot = pa.array(row_of[slot])
    blocks = np.nan_to_num(block[slot]).astype(np.int64) + page * (PAGE_CHUNKS // BLOCK_CHUNKS)
    entries = pa.StructArray.from_arrays(
        [pa.array(slot, pa.int32()), doc_id.take(of_slot), chunk_no.take(of_slot),
         pa.array(blocks, pa.int64(), mask=np.isnan(block[slot])), *[_nullable(values[lv][order]) for lv in K.LEVELS],
         _nullable(place[order]).cast(pa.int32())],
        names=["slot", "doc_id", "chunk_no", "block", *K.LEVELS, "place"])
    dfs = [np.add.reduceat((~np.isnan(values[lv][order])).astype(np.int64), at) for lv in K.LEVELS]
    return pa.table([pa.array(np.full(len(at), page)), terms.take(pa.array(term[at])), *map(pa.array, dfs),
                     pa.ListArray.from_arrays(pa.array(np.append(at, len(term)), pa.int32()), entries)],
                    names=["page", "term", *[f"df_{lv}" for lv in K.LEVELS], "entries"])


def _by_page(groups: GroupedData | PandasCogroupedOps, finish: Callable, schema: T.StructType) -> DataFrame:
    """``finish`` of the rows of each page (one table, or one of each side of a cogroup); None is
    no rows."""
    kinds = to_arrow_schema(schema)

    def fit(out: pa.Table | None) -> pa.Table:
        return kinds.empty_table() if out is None else out.select(kinds.names).cast(kinds)

    if isinstance(groups, PandasCogroupedOps):
        return groups.applyInArrow(lambda left, right: fit(finish(left, right)), schema)
    return groups.applyInArrow(lambda rows: fit(finish(rows)), schema)


def write_counts(windows: DataFrame, path: str, buckets: int, top_k: int = K.KEYWORDS_TOP_K) -> DataFrame:
    """:func:`counts_schema`.  No shuffle: every group is a page.  A bucket is one file, sorted by
    page and term."""
    ends = lambda c: F.concat(F.lower(c), F.lit("\n"))
    rows = (windows.where("raw_text IS NOT NULL AND summary IS NOT NULL")
            .select(*CHUNK, ends("raw_text").alias("_raw"), ends("summary").alias("_short")))
    schema = counts_schema(*[windows.schema[c].dataType for c in CHUNK[1:]])
    counts = _by_page(rows.groupBy("page"), lambda page: count_page(page, top_k), schema)
    return write_paged(counts, path, buckets, ["page", "term"])


def entries(counts: DataFrame, *more: str) -> DataFrame:
    """A row for each (chunk, term): ``page``, ``term``, the columns ``more`` and those of the entry."""
    return counts.select("page", "term", *more, F.inline("entries"))


def idf_of(df: Column, n_chunks: Column) -> Column:
    """A3; NULL where no chunk has the term."""
    return F.when(df > 0, F.log((n_chunks + 1) / (df + 1)) + 1.0)


def keyword_lists(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``windows`` with ``keywords`` in order; ``[]`` for chunks without tokens."""
    lists = (entries(counts).where("place IS NOT NULL").groupBy(*CHUNK)
             .agg(F.array_sort(F.collect_list(F.struct("place", "term"))).alias("k"))
             .select(*CHUNK, F.transform("k", lambda k: k["term"]).alias("keywords")))
    return (windows.join(lists, CHUNK, "left")
            .withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>"))))


class _Entries:
    """The entries of a page, one after another, with the row of ``counts`` that each is of."""

    def __init__(self, counts: pa.Table):
        lists = _column(counts, "entries")
        flat = lists.flatten()
        self.arrays = dict(zip([f.name for f in flat.type], flat.flatten()))
        self.sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(lists)), self.sizes)
        self.slot = self.arrays["slot"].to_numpy(zero_copy_only=False)
        self.values = {lv: _numbers(self.arrays[lv]) for lv in K.LEVELS}
        self.slots = int(self.slot.max()) + 1 if len(self.slot) else 0

    def of_slots(self, *columns: str) -> list[tuple]:
        """The value of ``columns`` of each slot."""
        slot, first = np.unique(self.slot, return_index=True)
        out: list = [None] * self.slots
        for s, *values in zip(slot, *[self.arrays[c].take(pa.array(first)).to_pylist() for c in columns]):
            out[s] = tuple(values)
        return out


def page_tops(counts: pa.Table, live: pa.Table) -> pa.Table | None:
    """Of a page's live chunks, the largest share of a term in a vector's length, for each term and
    block: ``page``, ``term`` and ``entries`` of ``block`` and ``top_*``."""
    e = _Entries(counts)
    at = dict(zip(zip(_column(live, "doc_id").to_pylist(), _column(live, "chunk_no").to_pylist()), range(len(live))))
    row = np.array([-1 if k is None else at.get(k, -1) for k in e.of_slots("doc_id", "chunk_no")], np.int64)
    block = e.arrays["block"]
    kept = np.flatnonzero((row[e.slot] >= 0) & block.is_valid().to_numpy(zero_copy_only=False))
    if not len(kept):
        return None
    of_term, block = e.row[kept], pc.fill_null(block, 0).to_numpy(zero_copy_only=False)[kept]
    first, norm_row = _firsts(of_term, block), row[e.slot[kept]]
    tops = [np.fmax.reduceat(e.values[lv][kept] / _numbers(_column(live, f"norm_{lv}"))[norm_row], first) for lv in K.LEVELS]
    of_list = of_term[first]
    lists = _firsts(of_list)
    found = pa.StructArray.from_arrays([pa.array(block[first]), *map(_nullable, tops)],
                                       names=["block", *[f"top_{lv}" for lv in K.LEVELS]])
    which = pa.array(of_list[lists])
    return pa.table([_column(counts, "page").take(which), _column(counts, "term").take(which),
                     pa.ListArray.from_arrays(pa.array(np.append(lists, len(of_list)), pa.int32()), found)],
                    names=["page", "term", "entries"])


TOPS = T.StructType([T.StructField("page", T.LongType()), T.StructField("term", T.StringType()), T.StructField(
    "entries", T.ArrayType(T.StructType([T.StructField("block", T.LongType()),
                                         *[T.StructField(f"top_{lv}", T.DoubleType()) for lv in K.LEVELS]])))])


def block_tops(counts: DataFrame, live: DataFrame) -> DataFrame:
    """:func:`page_tops` of all pages."""
    lengths = live.select(*CHUNK, *[f"norm_{lv}" for lv in K.LEVELS])
    return _by_page(counts.select("page", "term", "entries").groupBy("page").cogroup(lengths.groupBy("page")), page_tops, TOPS)


def page_weights(e: _Entries, counts: pa.Table, idf: dict[str, np.ndarray], levels: list[str]) -> pa.Table:
    """The postings of a page: a row for each entry and level, with its weight and the length of the
    chunk's vector; ``idf`` of each entry."""
    parts = []
    for i, lv in enumerate(levels):
        weight = e.values[lv] * idf[lv]
        norm = np.sqrt(np.bincount(e.slot, np.nan_to_num(weight * weight), e.slots))
        at = np.flatnonzero(~np.isnan(e.values[lv]))
        take = pa.array(at)
        parts.append(pa.table([
            e.arrays["doc_id"].take(take), e.arrays["chunk_no"].take(take), pa.array(np.full(len(at), i, np.int8)),
            _column(counts, "term").take(pa.array(e.row[at])), pa.array(e.values[lv][at]), pa.array(idf[lv][at]),
            pa.array(weight[at]), pa.array(norm[e.slot[at]])],
            names=["doc_id", "chunk_no", "level_no", "term", "tf", "idf", "weight", "norm"]))
    return pa.concat_tables(parts)


def _postings_schema(counts: DataFrame) -> T.StructType:
    of_entry = counts.schema["entries"].dataType.elementType
    return T.StructType([of_entry["doc_id"], of_entry["chunk_no"], T.StructField("level_no", T.ByteType()),
                         T.StructField("term", T.StringType()),
                         *[T.StructField(c, T.DoubleType()) for c in ("tf", "idf", "weight", "norm")]])


def corpus_weights(counts: DataFrame, idf: DataFrame, levels: list[str]) -> DataFrame:
    """Postings of all pages by ``idf`` (term, idf_*), which goes to every page that has the term."""
    known = counts.select("page", "term").join(idf.hint("shuffle_hash"), "term")
    weighted = counts.select("page", "term", "entries").join(known, ["page", "term"])

    def finish(page: pa.Table) -> pa.Table:
        e = _Entries(page)
        return page_weights(e, page, {lv: _numbers(_column(page, f"idf_{lv}"))[e.row] for lv in levels}, levels)

    return _by_page(weighted.groupBy("page"), finish, _postings_schema(counts))


def _of_documents(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """What a page has to know of its documents: a row for each with its number of chunks ``n``; and
    of those with chunks in other pages as well, a row for each term with its document frequencies
    in all of them.  Terms of the others, which is nearly all of them, do not travel."""
    here = windows.groupBy("page", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    whole = here.groupBy("doc_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))
    docs = here.select("page", "doc_id").join(whole, "doc_id")
    several = docs.where("pages > 1").select("page", "doc_id")
    dfs = [f"df_{lv}" for lv in K.LEVELS]
    of_page = (entries(counts).join(several.hint("shuffle_hash"), ["page", "doc_id"], "left_semi")
               .groupBy("page", "doc_id", "term").agg(*[F.count(lv).alias(f"df_{lv}") for lv in K.LEVELS]))
    summed = of_page.groupBy("doc_id", "term").agg(*[F.sum(c).alias(c) for c in dfs])
    terms = of_page.select("page", "doc_id", "term").join(summed, ["doc_id", "term"])
    return docs.select("page", "doc_id", "n", F.lit(None).cast("string").alias("term"),
                       *[F.lit(None).cast("long").alias(c) for c in dfs]).unionByName(
        terms.select("page", "doc_id", F.lit(None).cast("long").alias("n"), "term", *dfs))


def _document_idf(e: _Entries, counts: pa.Table, known: pa.Table) -> dict[str, np.ndarray]:
    """The idf of each entry among the chunks of its document."""
    rows = known.select(["doc_id", "n", "term"])
    of_doc, of_term = rows.filter(pc.is_null(rows["term"])), pc.is_valid(known["term"])
    index = {d: i for i, d in enumerate(of_doc["doc_id"].to_pylist())}
    n = _numbers(_column(of_doc, "n").cast(pa.float64()))
    doc = np.array([-1 if k is None else index[k[0]] for k in e.of_slots("doc_id")], np.int64)[e.slot]
    key, places = np.unique(e.row * len(index) + doc, return_inverse=True)
    shared = known.filter(of_term)
    row = pc.index_in(_column(shared, "term"), value_set=_column(counts, "term")).to_numpy(zero_copy_only=False)
    at = np.searchsorted(key, row * len(index) + np.array([index[d] for d in shared["doc_id"].to_pylist()], np.int64))
    out = {}
    for lv in K.LEVELS:
        df = np.bincount(places, ~np.isnan(e.values[lv]), len(key))
        df[at] = _numbers(_column(shared, f"df_{lv}").cast(pa.float64()))
        out[lv] = np.log((n[doc] + 1) / (df[places] + 1)) + 1.0
    return out


def document_weights(windows: DataFrame, counts: DataFrame, levels: list[str]) -> DataFrame:
    """Postings of all pages by the idf inside each document."""
    def finish(page: pa.Table, known: pa.Table) -> pa.Table | None:
        if not len(page):
            return None
        e = _Entries(page)
        return page_weights(e, page, _document_idf(e, page, known), levels)

    return _by_page(counts.select("page", "term", "entries").groupBy("page").cogroup(
        _of_documents(windows, counts).groupBy("page")), finish, _postings_schema(counts))


def document_weighted(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``counts`` with frequencies times the idf inside each document."""
    def finish(page: pa.Table, known: pa.Table) -> pa.Table | None:
        if not len(page):
            return None
        e = _Entries(page)
        idf = _document_idf(e, page, known)
        arrays = {**e.arrays, **{lv: _nullable(e.values[lv] * idf[lv]) for lv in K.LEVELS}}
        flat = pa.StructArray.from_arrays(list(arrays.values()), names=list(arrays))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(e.sizes)), pa.int32()), flat)
        return page.set_column(page.schema.get_field_index("entries"), "entries", lists)

    return _by_page(counts.groupBy("page").cogroup(_of_documents(windows, counts).groupBy("page")), finish, counts.schema)
