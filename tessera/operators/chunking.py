"""Overlapping character windows over a table of documents.

Where a window ends depends on where the one before it ended, so a document is walked in
order; documents are independent of each other.  A scalar ``arrow_udf`` gets the ``text``
column in Arrow batches (bounded by rows and by ``spark.sql.execution.arrow.maxBytesPerBatch``)
and returns the pieces already cut, so the document itself is not copied to each of its
windows and the cost is linear in its length.  Texts and pieces are Python strings for one
document and ``FLUSH_CHARS`` of pieces at a time; all others stay in Arrow buffers.  The id and
the explode are Spark expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import constants as K

PIECES_TYPE = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("text", T.StringType()),
]))
_BLANK = re.compile(" ")
FLUSH_CHARS = 1 << 20   # pieces that are Python strings at a time


def window_spans(text: str, window: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Offsets of every window of one document.

    All spaces are indexed once; a window that does not reach the end of the text stops at
    the last indexed space before its limit.  A space within the overlap does not count:
    the next window would not start after this one, so the window is cut at its limit."""
    blanks = [m.start() for m in _BLANK.finditer(text)]
    begin, size = 0, len(text)
    while size:
        limit = begin + window
        if limit >= size:
            yield begin, size
            return
        nearest = bisect_left(blanks, limit) - 1
        stop = blanks[nearest] if nearest >= 0 and blanks[nearest] > begin + overlap else limit
        yield begin, stop
        begin = stop - overlap


def cut_pieces(texts: pa.Array, window: int, overlap: int) -> pa.Array:
    """The windows of every text of a batch as :data:`PIECES_TYPE`; NULL for NULL."""
    starts, ends, pieces, chars = [], [], [], 0
    done, counts = [], [0]

    def flush() -> None:
        nonlocal chars
        done.append(pa.StructArray.from_arrays(
            [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(pieces, pa.string())],
            names=["start", "end", "text"]))
        starts.clear(), ends.clear(), pieces.clear()
        chars = 0

    for text in texts:
        t, before = text.as_py(), counts[-1]
        for a, b in window_spans(t or "", window, overlap):
            starts.append(a), ends.append(b), pieces.append(t[a:b].strip())
            before += 1
            chars += b - a
            if chars >= FLUSH_CHARS:
                flush()
        counts.append(before)
    flush()
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.concat_arrays(done), mask=texts.is_null())


def _pieces_udf(window: int, overlap: int):
    @F.arrow_udf(PIECES_TYPE)
    def pieces(texts: pa.Array) -> pa.Array:
        return cut_pieces(texts, window, overlap)
    return pieces


def chunk_id(start: Column, end: Column) -> Column:
    """First 8 hex digits of md5("{start}-{end}")."""
    return F.substring(F.md5(F.concat_ws("-", start.cast("string"), end.cast("string"))), 1, 8)


def chunk_documents(docs: DataFrame, page_chars: int = K.PAGE_CHARS,
                    window_pages: int = K.WINDOW_PAGES,
                    overlap_chars: int = K.OVERLAP_CHARS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` -> ``chunks(doc_id, chunk_no, chunk_id, start_char, end_char, text)``.

    Empty and NULL texts give no chunk; a blank text gives one chunk with text ``''``.  A
    document with a NULL id gives none, since nothing could refer to its chunks:
    :func:`unidentified` returns those rows.
    """
    window = page_chars * window_pages
    if not 0 <= overlap_chars < window:
        raise ValueError("need 0 <= overlap_chars < page_chars * window_pages")
    pieces = _pieces_udf(window, overlap_chars)(F.col(text_col))
    w = F.col("_w")
    return (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("doc_id"), F.posexplode(pieces).alias("chunk_no", "_w"))
            .select("doc_id", F.col("chunk_no").cast("int").alias("chunk_no"),
                    chunk_id(w["start"], w["end"]).alias("chunk_id"),
                    w["start"].alias("start_char"), w["end"].alias("end_char"), w["text"].alias("text")))


def unidentified(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that :func:`chunk_documents` leaves out because they have no id."""
    return docs.where(F.col(id_col).isNull())
