"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import shared_dir

#: Words are runs of anything but these six ASCII characters.
WORD_CLASS = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_SPACE = re.compile(r"[\x20\x09-\x0D]")


#: Most bytes of an Arrow batch that goes to a Python worker (one longer text is a batch of
#: its own).  A worker holds a batch several times over, as buffers, strings and words.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts; from here on the session's Arrow batches are bounded for them."""
    size = spark.conf.get(_BATCH).removesuffix("b")
    if not size.isdigit() or int(size) > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared folder and read it back: the
    lineage is cut at committed files, which survive lost executors."""
    path = shared_dir(df.sparkSession, f"llm_{label}")
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, label: str, column: str, path: str | None = None) -> DataFrame:
    """Like :func:`written`, bucketed by ``column`` without a shuffle: what is later grouped
    by that column is read in place.  Spark keeps bucketing in its catalog only, so the
    files get a table name while they are resolved; no name stays behind."""
    spark = df.sparkSession
    n = min(shuffle_partitions(spark), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    name = f"llm_{label}_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").bucketBy(n, column).option("compression", "zstd")
     .option("path", path or shared_dir(spark, f"llm_{label}")).saveAsTable(name))
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of Arrow batches as dicts, one batch in Python objects at a time."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for values in zip(*columns):
            yield dict(zip(batch.schema.names, values))


def words(text: str | None) -> list[bytes]:
    """Whole-text words in UTF-8.  ``bytes.split()`` separates at exactly the six ASCII
    characters of the word definition."""
    return text.encode("utf-8").split() if text else []


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only."""
    return text.encode("utf-8").lower().decode("utf-8")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply-xorshift) over uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Emitter:
    """Collects rows and hands them out as Arrow batches of a schema, bounded by rows and
    by an estimate of their bytes."""

    def __init__(self, schema: pa.Schema, max_rows: int = 2000, max_bytes: int = 16 << 20):
        self.schema, self.max_rows, self.max_bytes = schema, max_rows, max_bytes
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= self.max_rows or self.size >= self.max_bytes:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.size = [], 0
        return out

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self.batch()
