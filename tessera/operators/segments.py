"""Index segments and versions.

A segment is what one ingest adds: its chunks, their term counts (with how many chunks of each page
have a term), and postings that can be read by term.  It never changes.  A version is a list of
segments with what depends on all of them: which chunks are live (a document that a later segment
has again, or deletes, is not), document frequencies, vector lengths, and the largest weight of
each term in each block of chunks.  A new version reads counts, never texts or chunks again.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K
from tessera.operators import paged as P
from tessera.operators.pyramid import PyramidParts
from tessera.sources import files as FS
from tessera.sources.paged import open_paged, write_paged

TERM_BUCKETS = 64
LAYOUT = 2   # of the tables; an index of another one has to be ingested anew

_KEY = [T.StructField("page", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("chunk_no", T.IntegerType())]
_BLOCK, _TERM = T.StructField("block", T.LongType()), T.StructField("term", T.StringType())
_BUCKET = T.StructField("bucket", T.IntegerType())


def _levels(prefix: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(f"{prefix}{lv}", kind) for lv in K.LEVELS]


WINDOWS = T.StructType([*_KEY, T.StructField("chunk_id", T.StringType()), T.StructField("start_char", T.IntegerType()),
                        T.StructField("end_char", T.IntegerType()), T.StructField("raw_text", T.StringType()),
                        T.StructField("summary", T.StringType())])
COUNTS = P.counts_schema()
POSTINGS = T.StructType([_TERM, _KEY[0], COUNTS["entries"], _BUCKET])   # a row for each page with the term
BOUNDS = T.StructType([_TERM, _KEY[0], P.TOPS["entries"], _BUCKET])
TERMS = T.StructType([_TERM, *_levels("df_", T.LongType()), _BUCKET])
LIVE = T.StructType([*_KEY, T.StructField("chunk_id", T.StringType()), _BLOCK, *_levels("norm_", T.DoubleType()),
                     T.StructField("segment", T.IntegerType())])
DOCS = T.StructType([_KEY[1]])


def term_bucket(term: str | Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term), F.lit(buckets)).cast("int")


def write_by_term(rows: DataFrame, path: str, term_buckets: int, order: list[str]) -> None:
    """Rows in a folder for each bucket of terms, sorted inside each file.  The rebalancing gives a
    folder as many tasks as its size asks for, so a very frequent term is split over files and
    small folders share a task."""
    (rows.withColumn("bucket", term_bucket("term", term_buckets)).hint("rebalance", "bucket")
     .sortWithinPartitions("bucket", *order)
     .write.partitionBy("bucket").option("compression", "zstd").parquet(path))


class Segment:
    """The tables of one segment under ``path``; ``number`` orders the segments of an index."""

    def __init__(self, spark: SparkSession, path: str, number: int, buckets: int, scope: str):
        self.spark, self.path, self.number, self.buckets, self.scope = spark, path, number, buckets, scope

    def _paged(self, name: str, schema: T.StructType, order: list[str] | None = None) -> DataFrame:
        return open_paged(self.spark, f"{self.path}/{name}", schema, self.buckets, order)

    @property
    def windows(self) -> DataFrame:
        return self._paged("windows", WINDOWS)

    @property
    def counts(self) -> DataFrame:
        return self._paged("counts", COUNTS, ["page", "term"])

    @property
    def docs(self) -> DataFrame:
        """Documents that this segment replaces in earlier ones: its own and deleted ones."""
        return self.spark.read.schema(DOCS).parquet(f"{self.path}/docs")

    @property
    def postings_path(self) -> str:
        return f"{self.path}/postings"

    @property
    def pyramid(self) -> DataFrame:
        return FS.read_json(self.spark, f"{self.path}/pyramid", FS.PYRAMID_SCHEMA)

    def own_weights(self) -> DataFrame:
        """Counts with what a term weighs before the corpus-wide idf: its frequency, and for
        ``scope="document"`` that times the idf among its document's own chunks."""
        return P.document_weighted(self.windows, self.counts) if self.scope == "document" else self.counts

    def write(self, parts: PyramidParts, docs: DataFrame, term_buckets: int, pyramid: bool) -> None:
        """All tables of the segment.  Documents are cut into chunks once, for ``windows``."""
        docs.select("doc_id").where("doc_id IS NOT NULL").distinct().write.parquet(f"{self.path}/docs")
        windows = P.write_windows(parts, f"{self.path}/windows", self.number)
        counts = P.write_counts(windows, f"{self.path}/counts", self.buckets, parts.top_k)
        write_by_term(self.own_weights().select("term", "page", "entries"), self.postings_path, term_buckets, ["term", "page"])
        if pyramid:
            full = P.keyword_lists(windows, counts)
            FS.write_json(parts.categorised(full).select(*FS.PYRAMID_SCHEMA.names), f"{self.path}/pyramid")


class Version:
    """What searching needs of one version."""

    def __init__(self, spark: SparkSession, root: str, entry: dict):
        self.spark, self.root, self.entry = spark, root.rstrip("/"), entry
        self.scope, self.term_buckets = entry["scope"], entry["term_buckets"]
        self.path = f"{self.root}/{entry['folder']}"

    @property
    def number(self) -> int | None:
        return self.entry.get("number")

    @property
    def segments(self) -> list[Segment]:
        return [Segment(self.spark, f"{self.root}/{s['folder']}", s["number"], s["buckets"], self.scope)
                for s in self.entry["segments"]]

    @cached_property
    def live(self) -> DataFrame:
        """Chunks of the version with their vector lengths: ``(segment, page, doc_id, chunk_no,
        chunk_id, block, norm_raw, norm_summary, norm_keywords)``; no block without tokens."""
        return self.spark.read.schema(LIVE).parquet(f"{self.path}/live")

    @cached_property
    def n_chunks(self) -> int:
        return self.entry["n_chunks"]

    @cached_property
    def terms(self) -> DataFrame:
        return self.spark.read.schema(TERMS).parquet(f"{self.path}/terms")

    @cached_property
    def bounds_by_page(self) -> DataFrame:
        """:data:`BOUNDS`: the blocks of a page with a term are the ``entries`` of one row."""
        return self.spark.read.schema(BOUNDS).parquet(f"{self.path}/bounds")

    @cached_property
    def postings_by_page(self) -> list[DataFrame]:
        """:data:`POSTINGS` of each segment, those of replaced documents included: joining ``live``
        leaves them out."""
        return [self.spark.read.schema(POSTINGS).parquet(s.postings_path) for s in self.segments]

    @property
    def bounds(self) -> DataFrame:
        """``(term, bucket, block, top_raw, ..)``."""
        return self.bounds_by_page.select("term", "bucket", F.inline("entries"))

    @property
    def postings(self) -> list[DataFrame]:
        """``(term, bucket, doc_id, chunk_no, block, raw, ..)`` of each segment."""
        return [p.select("term", "bucket", F.inline("entries")).drop("slot", "place") for p in self.postings_by_page]

    @property
    def pyramid(self) -> DataFrame:
        """The four layers of every live chunk."""
        live = self.live.select("segment", "doc_id").distinct()
        return reduce(DataFrame.unionByName, [
            s.pyramid.join(live.where(F.col("segment") == s.number).select("doc_id"), "doc_id", "left_semi")
            .select(*FS.PYRAMID_SCHEMA.names) for s in self.segments])

    def idf(self, df: Column) -> Column:
        if self.scope == "document":
            return F.lit(1.0)   # it is in the postings already
        return P.idf_of(df, F.lit(self.n_chunks))

    def write(self) -> None:
        """The tables of the version, from its segments' counts.  Everything but the document
        frequencies is computed inside pages.  Sets ``n_chunks`` of the entry."""
        segments = self.segments
        chunks = [s.windows.select(*P.CHUNK, "chunk_id") for s in segments]
        frequencies = [s.counts.select("term", *[f"df_{lv}" for lv in K.LEVELS]) for s in segments]
        weights = [s.own_weights() for s in segments]
        if len(segments) > 1:
            # a document belongs to the last segment that names it
            named = reduce(DataFrame.unionByName, [s.docs.withColumn("owner", F.lit(s.number)) for s in segments[1:]])
            owner = named.groupBy("doc_id").agg(F.max("owner").alias("owner"))
            for i, s in enumerate(segments[:-1]):
                dead = write_paged(chunks[i].join(owner.where(F.col("owner") > s.number), "doc_id", "left_semi")
                                   .select(*P.CHUNK), f"{self.path}/dead/segment={s.number}", s.buckets)
                if dead.isEmpty():
                    continue
                gone = P.entries(s.counts).join(dead.hint("shuffle_hash"), P.CHUNK, "left_semi")
                frequencies[i] = frequencies[i].unionByName(
                    gone.groupBy("term").agg(*[(-F.count(lv)).alias(f"df_{lv}") for lv in K.LEVELS]))
                chunks[i] = chunks[i].join(dead, P.CHUNK, "left_anti")
                # pages without a live chunk have no part in lengths and bounds
                weights[i] = weights[i].join(chunks[i].select("page").distinct().hint("shuffle_hash"), "page", "left_semi")
        self.entry["n_chunks"] = sum(c.count() for c in chunks)

        dfs = reduce(DataFrame.unionByName, frequencies).groupBy("term").agg(
            *[F.sum(f"df_{lv}").alias(f"df_{lv}") for lv in K.LEVELS])
        write_by_term(dfs.where(" OR ".join(f"df_{lv} > 0" for lv in K.LEVELS)), f"{self.path}/terms",
                      self.term_buckets, ["term"])

        idf = self.terms.select("term", *[self.idf(F.col(f"df_{lv}")).alias(f"idf_{lv}") for lv in K.LEVELS])
        tops = []
        for i, s in enumerate(segments):
            weight = {lv: F.col(lv) for lv in K.LEVELS}
            own = weights[i]
            if self.scope == "document":
                weighted = P.entries(own)
            else:
                known = s.counts.select("page", "term").join(idf.hint("shuffle_hash"), "term")
                weighted = P.entries(own.join(known, ["page", "term"]), *[f"idf_{lv}" for lv in K.LEVELS])
                weight = {lv: F.col(lv) * F.col(f"idf_{lv}") for lv in K.LEVELS}
            # of replaced chunks of such pages as well; they are not among the chunks that this is joined to
            lengths = weighted.groupBy(*P.CHUNK).agg(
                F.max("block").alias("block"),
                *[F.sqrt(F.sum(weight[lv] * weight[lv])).alias(f"norm_{lv}") for lv in K.LEVELS])
            live = write_paged(chunks[i].join(lengths, P.CHUNK, "left").select(*LIVE.names[:-1]),
                               f"{self.path}/live/segment={s.number}", s.buckets)
            tops.append(P.block_tops(own, live))
        write_by_term(reduce(DataFrame.unionByName, tops), f"{self.path}/bounds", self.term_buckets, ["term", "page"])
