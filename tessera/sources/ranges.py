"""Text files by byte ranges: for files that fit neither a row nor a Python call.

A file is cut every ``segment_bytes`` bytes.  A segment's text is the code points whose first
byte lies in its range, so the segments of a file joined are its text whatever the size of
the ranges.  ``ahead`` holds the first code points after the segment, for a reader that has to
look over its border.  Only the list of files (path and length, from Spark's ``binaryFile``
source, which does not open a file whose content is not selected) and the ranges made from it
travel as rows; bytes are read where they are used, through ``pyarrow.fs``.

Files are UTF-8; a malformed byte becomes U+FFFD.  An empty file has no segment.  Files must
not change while a plan over them runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES = 1 << 20
TASK_BYTES = 128 << 20
_TAIL = 3   # most bytes of a code point after its first one


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path inside it."""
    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1)
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    system, inner = file_system(path)
    return system.open_input_file(inner)


def _continued(data: bytes) -> int:
    """How many of the first bytes belong to a code point that began before them."""
    n = 0
    while n < min(_TAIL, len(data)) and 0x80 <= data[n] < 0xC0:
        n += 1
    return n


def read_range(path: str, begin: int, end: int, ahead: int = 0) -> tuple[str, str]:
    """Text of the code points that begin in ``[begin, end)``, and the next ``ahead`` of them."""
    with _open(path) as file:
        file.seek(begin)
        data = file.read(end - begin + 4 * ahead + 2 * _TAIL)
    first = _continued(data) if begin else 0
    cut = min(end - begin, len(data))
    cut += _continued(data[cut:])
    after = data[cut:].decode("utf-8", "replace")[:ahead]
    return data[first:cut].decode("utf-8", "replace"), after


def file_ranges(spark: SparkSession, path: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``(file_path, n_segments, segment_no, byte_start, byte_end)`` of all files under ``path``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .where("length > 0").select(F.col("path").alias("file_path"), "length"))
    step = F.lit(segment_bytes)
    count = F.ceil(F.col("length") / step)
    return (files.select("file_path", "length", count.alias("n_segments"),
                         F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("segment_no"))
            .select("file_path", "n_segments", "segment_no",
                    (F.col("segment_no") * step).alias("byte_start"),
                    F.least((F.col("segment_no") + 1) * step, F.col("length")).alias("byte_end")))


def spread_ranges(ranges: DataFrame, segments: int, segment_bytes: int) -> DataFrame:
    """Ranges dealt to tasks that read about ``TASK_BYTES`` each.  A stated number of partitions:
    by their own size the rows would be put together into very few."""
    tasks = max(ranges.sparkSession.sparkContext.defaultParallelism,
                math.ceil(segments * segment_bytes / TASK_BYTES))
    return ranges.repartition(tasks, "file_path", "segment_no")


def read_text_ranges(spark: SparkSession, path: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``(file_path, segment_no, byte_start, byte_end, text)`` of all files under ``path``."""
    ranges = file_ranges(spark, path, segment_bytes).drop("n_segments")
    total = ranges.count()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                yield pd.DataFrame([(row.file_path, row.segment_no, row.byte_start, row.byte_end,
                                     read_range(row.file_path, row.byte_start, row.byte_end)[0])],
                                   columns=["file_path", "segment_no", "byte_start", "byte_end", "text"])

    return spread_ranges(ranges, total, segment_bytes).mapInPandas(
        read, "file_path string, segment_no long, byte_start long, byte_end long, text string")
