"""Ingest and serve (S1, S2, S3, S4): an index that grows by segments.

``ingest_documents`` adds a document table to the index under a folder; documents that are there
already are replaced.  ``delete_documents`` takes documents out.  Both write a segment and a
version (:mod:`tessera.operators.segments`) and publish it in one step
(:mod:`tessera.sources.versions`): a reader sees the version before or the version after, and
nothing that a version names changes or goes before ``RETAIN`` later ones are there.
``search_index`` answers a query table from a version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.operators.chunking import chunk_documents
from tessera.operators.pyramid import PyramidParts
from tessera.operators.segments import LAYOUT, TERM_BUCKETS, Segment, Version
from tessera.operators.topk import search_version
from tessera.session import spread
from tessera.sources import files as FS
from tessera.sources.paged import bucket_count
from tessera.sources.versions import RETAIN, VersionLog


def _folders(entry: dict) -> list[str]:
    return [entry["folder"], *(s["folder"] for s in entry["segments"])]


def current_version(spark: SparkSession, root: str) -> Version | None:
    """The latest published version, or None."""
    entry = VersionLog(spark, root).latest()
    return Version(spark, root, entry) if entry else None


def _publish(spark: SparkSession, root: str, log: VersionLog, segment: Segment, options: dict, retain: int) -> Version:
    """A version of the latest one's segments and a new one.  If another writer publishes in the
    meantime, the version is made again with its segment as well."""
    mine = {"folder": segment.path[len(log.root) + 1:], "number": segment.number, "buckets": segment.buckets}

    def make(before: dict | None) -> dict:
        others = before["segments"] if before else []
        entry = options | {"folder": f"versions/{uuid.uuid4().hex[:12]}",
                           "segments": sorted([*others, mine], key=lambda s: s["number"])}
        Version(spark, root, entry).write()
        return entry

    entry = log.publish(make)
    log.trim(_folders, retain)
    return Version(spark, root, entry)


def _new_segment(spark: SparkSession, log: VersionLog, scope: str) -> Segment:
    return Segment(spark, f"{log.root}/segments/{uuid.uuid4().hex[:12]}", log.take_number(), bucket_count(spark), scope)


def ingest_documents(docs: DataFrame, root: str, page_chars: int = K.PAGE_CHARS,
                     window_pages: int = K.WINDOW_PAGES, overlap_chars: int = K.OVERLAP_CHARS,
                     scope: str = "corpus", term_buckets: int = TERM_BUCKETS, export_pyramid: bool = True,
                     retain: int = RETAIN, **pyramid) -> Version:
    """Add ``docs(doc_id, text)`` to the index under ``root``, replacing documents of the same
    id, and publish the new version.  ``scope`` and ``term_buckets`` are those of the index: they
    are fixed by its first ingest.  ``pyramid``: rules, summariser, n_sentences and top_k
    (keywords) of :class:`PyramidParts`; ``export_pyramid`` also writes the four layers as JSON
    lines (without vectors)."""
    spark = docs.sparkSession
    log = VersionLog(spark, root)
    before = log.latest()
    options = {"scope": scope, "term_buckets": term_buckets, "layout": LAYOUT}
    if before and any(before.get(k) != v for k, v in options.items()):
        raise ValueError(f"the index has {({k: before.get(k) for k in options})}")
    parts = PyramidParts(chunk_documents(docs, page_chars, window_pages, overlap_chars), **pyramid)
    segment = _new_segment(spark, log, scope)
    segment.write(parts, docs, term_buckets, export_pyramid)
    return _publish(spark, root, log, segment, options, retain)


def delete_documents(ids: DataFrame, root: str, retain: int = RETAIN) -> Version:
    """Take the documents of ``ids(doc_id)`` out of the index and publish the new version."""
    spark = ids.sparkSession
    before = current_version(spark, root)
    if before is None:
        raise ValueError(f"no index at {root}")
    none = ids.select("doc_id", F.lit(None).cast("string").alias("text"))
    return ingest_documents(none, root, scope=before.scope, term_buckets=before.term_buckets, retain=retain)


def ingest_files(spark: SparkSession, path: str, root: str, **kwargs) -> Version:
    """A folder of UTF-8 text files, one document per file; ``doc_id`` is a hash of the
    file path (stable across runs)."""
    files = FS.read_text_files(spark, path)
    docs = files.select(F.xxhash64("file_path").alias("doc_id"), "text")
    return ingest_documents(spread(docs), root, **kwargs)


def search_index(version: Version, queries: DataFrame, top_k: int = K.SEARCH_TOP_K, level: str | None = None,
                 weights: dict | None = None) -> DataFrame:
    """Top-k chunks per query from a version."""
    return search_version(version, queries, top_k=top_k, level=level, weights=weights)


def read_pyramid(version: Version) -> DataFrame:
    return version.pyramid
