"""Windows of text files of any length (S1, C1-C3), the same as of whole texts.

The walk over a text is sequential: a window begins where the one before it says.  All that a
segment of a file has to know of the text before it is where its first window begins, and that
is less than ``window - overlap`` code points after the segment's own begin.  So

1. each segment is walked from every possible begin at once (numpy arrays), which gives its
   *passage*: for each begin the begin in the next segment, and the number of windows;
2. passages of up to ``FANOUT`` neighbours are joined to one, level by level, until a file has a
   single one;
3. from the top down, each passage learns the begin, the window number and the code point at which
   the true walk enters it;
4. each segment is read again and cuts its own windows, looking over its border for the last one.

Only passages are shuffled (8 bytes for each possible begin, 28.8 KB for the default window; a
segment has 1 MB by default), in groups of at most ``FANOUT``; no file, however long, meets in one
task, and the text itself is read twice but never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.operators.chunking import chunk_id
from tessera.session import materialize
from tessera.sources.ranges import SEGMENT_BYTES, file_ranges, read_range, spread_ranges

FANOUT = 64
FLUSH_BYTES = 4 << 20   # passages that a task holds at a time
DONE = -1   # the last window of the file has begun before

_PASSAGE = "file_path string, segment_no long, chars long, next binary, counts binary"
_ENTRY = "file_path string, segment_no long, begin long, chunk_no long, start_char long"


class Walk:
    """Where windows that begin in a segment end.  ``ahead`` is the text after the segment: at least
    a window's length of it, or all that is left of the file."""

    def __init__(self, text: str, ahead: str, window: int, overlap: int):
        codes = np.frombuffer((text + ahead).encode("utf-32-le"), "<u4")
        self.chars, self.size = len(text), len(codes)
        self.window, self.overlap = window, overlap
        # for each place the last blank before it, -1 where there is none
        self.blank = np.full(self.size + 1, -1, "<i8")
        self.blank[1:] = np.maximum.accumulate(np.where(codes == ord(" "), np.arange(self.size), -1))

    def ends(self, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ends of the windows, and which of them are the file's last."""
        limits = begins + self.window
        last = limits >= self.size
        blank = self.blank[np.minimum(limits, self.size)]
        return np.where(last, self.size, np.where(blank > begins + self.overlap, blank, limits)), last

    def passage(self) -> tuple[np.ndarray, np.ndarray]:
        """For every begin below ``window - overlap``: the begin in the next segment and the number of
        windows that begin in this one."""
        at = np.arange(self.window - self.overlap)
        counts = np.zeros(len(at), "<i8")
        ended = np.zeros(len(at), bool)
        going = np.flatnonzero(at < self.chars)
        while len(going):
            ends, last = self.ends(at[going])
            counts[going] += 1
            at[going] = ends - self.overlap
            ended[going[last]] = True
            going = going[~last & (at[going] < self.chars)]
        return np.where(ended, DONE, at - self.chars), counts

    def spans(self, begin: int) -> Iterator[tuple[int, int]]:
        """The windows that begin in this segment on the walk that enters it at ``begin``."""
        while begin < self.chars:
            ends, last = self.ends(np.array([begin]))
            yield begin, int(ends[0])
            if last[0]:
                return
            begin = int(ends[0]) - self.overlap


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row.next, "<i4"), np.frombuffer(row.counts, "<i8")


def _segment_passages(window: int, overlap: int):
    columns = ["file_path", "segment_no", "chars", "next", "counts"]
    # a batch has thousands of ranges: their passages leave a few at a time
    most = max(1, FLUSH_BYTES // (12 * (window - overlap)))

    def passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                text, ahead = read_range(row.file_path, row.byte_start, row.byte_end, window)
                if len(text) < window and row.segment_no < row.n_segments - 1:
                    raise ValueError(f"segment {row.segment_no} of {row.file_path} is shorter than a window")
                after, counts = Walk(text, ahead, window, overlap).passage()
                out.append((row.file_path, row.segment_no, len(text),
                            after.astype("<i4").tobytes(), counts.tobytes()))
                if len(out) >= most:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)
    return passages


def _joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One passage through all neighbours of a group."""
    at = counts = None
    for row in rows.sort_values("segment_no").itertuples():
        after, windows = _unpack(row)
        if at is None:
            at, counts = after, windows.copy()
            continue
        inside = at != DONE
        counts[inside] += windows[at[inside]]
        at = np.where(inside, after[at], DONE)
    return pd.DataFrame([(key[0], key[1], int(rows.chars.sum()), at.astype("<i4").tobytes(), counts.tobytes())],
                        columns=["file_path", "segment_no", "chars", "next", "counts"])


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    """The true walk's entries into the members of a group, from its entry into the first one."""
    rows = rows.sort_values("segment_no")
    begin, number, start = (int(rows[c].iat[0]) for c in ("begin", "chunk_no", "start_char"))
    out = []
    for row in rows.itertuples():
        out.append((row.file_path, row.segment_no, begin, number, start))
        start += row.chars
        if begin != DONE:
            after, counts = _unpack(row)
            begin, number = int(after[begin]), number + int(counts[begin])
    return pd.DataFrame(out, columns=["file_path", "segment_no", "begin", "chunk_no", "start_char"])


def _group(fanout: int):
    return F.floor(F.col("segment_no") / fanout).cast("long")


def _walk_entries(passages: DataFrame, most_segments: int, fanout: int) -> DataFrame:
    """Where the true walk enters each segment (begin, number of its first window, code point)."""
    levels, width = [passages], most_segments
    while width > fanout:
        levels.append(materialize(
            levels[-1].groupBy("file_path", _group(fanout).alias("group_no")).applyInPandas(_joined, _PASSAGE)))
        width = -(-width // fanout)
    top = levels[-1].select("file_path", F.lit(0).cast("long").alias("group_no")).distinct()
    above = top.select("*", *(F.lit(0).cast("long").alias(c) for c in ("begin", "chunk_no", "start_char")))
    for level in reversed(levels):
        above = (level.withColumn("group_no", _group(fanout)).join(above, ["file_path", "group_no"])
                 .groupBy("file_path", "group_no").applyInPandas(_entries, _ENTRY)
                 .withColumnRenamed("segment_no", "group_no"))
    return above.withColumnRenamed("group_no", "segment_no")


def _cut(window: int, overlap: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                text, ahead = read_range(row.file_path, row.byte_start, row.byte_end, window)
                whole = text + ahead
                rows = [(row.file_path, row.chunk_no + i, row.start_char + a, row.start_char + b, whole[a:b].strip())
                        for i, (a, b) in enumerate(Walk(text, ahead, window, overlap).spans(row.begin))]
                yield pd.DataFrame(rows, columns=["doc_id", "chunk_no", "start_char", "end_char", "text"])
    return cut


def chunk_files(spark: SparkSession, path: str, page_chars: int = K.PAGE_CHARS,
                window_pages: int = K.WINDOW_PAGES, overlap_chars: int = K.OVERLAP_CHARS,
                segment_bytes: int = SEGMENT_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Files under ``path`` -> ``chunks(doc_id, chunk_no, chunk_id, start_char, end_char, text)``.

    As ``chunk_documents`` on the whole texts: ``doc_id`` is the file's path, numbers and offsets
    are 64 bits wide.  A segment must hold a window (``segment_bytes`` at least four bytes for each
    code point of one); an empty file gives no chunk, a blank one a single chunk with text ``''``.
    Runs when called, up to the passages (written to the shared folder); the cutting is lazy.
    """
    window = page_chars * window_pages
    if not 0 <= overlap_chars < window:
        raise ValueError("need 0 <= overlap_chars < page_chars * window_pages")
    if segment_bytes < 4 * (window + 1) or fanout < 2:
        raise ValueError("need segment_bytes >= 4 * (window + 1) and fanout >= 2")
    ranges = materialize(file_ranges(spark, path, segment_bytes))
    total, most = ranges.agg(F.count("*"), F.max("n_segments")).first()
    passages = materialize(spread_ranges(ranges, total, segment_bytes).mapInPandas(
        _segment_passages(window, overlap_chars), _PASSAGE))
    entries = ranges.join(_walk_entries(passages, most or 0, fanout), ["file_path", "segment_no"])
    cut = spread_ranges(entries.where(F.col("begin") != DONE), total, segment_bytes).mapInPandas(
        _cut(window, overlap_chars), "doc_id string, chunk_no long, start_char long, end_char long, text string")
    return cut.select("doc_id", "chunk_no", chunk_id(F.col("start_char"), F.col("end_char")).alias("chunk_id"),
                      "start_char", "end_char", "text")
