"""File sources and sinks.

Every writer but that of one file per document goes through Spark's commit protocol into a folder
under the cluster's shared checkpoint location (:func:`tessera.session.shared_dir`), so a lost
executor only re-runs its tasks; readers use explicit schemas, no inference.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.ranges import file_system

PYRAMID_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("chunk_no", T.IntegerType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("start_char", T.IntegerType()),
    T.StructField("end_char", T.IntegerType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("keywords", T.ArrayType(T.StringType())),
])

ROUTER_LOG_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("detected", T.StringType()),
    T.StructField("module_used", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("n_steps", T.LongType()),
    T.StructField("train_loss", T.DoubleType()),
    T.StructField("epoch", T.IntegerType()),
])

SUMMARY_SCHEMA = T.StructType([
    T.StructField("train_samples", T.LongType()),
    T.StructField("eval_samples", T.LongType()),
    T.StructField("final_train_loss", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
])


# -- S1: whole-file text documents -----------------------------------------------------------

NO_ID = "none"   # the file of documents without an id


def write_text_files(docs: DataFrame, path: str) -> None:
    """A file ``<doc_id>.txt`` for each document, in a folder for each task: the text and one line
    break after it.

    Tasks write through ``pyarrow.fs``: with Spark's writer every document costs a folder, a
    checksum file, permission calls and a move by the driver, and a folder each to list for the
    reader.  A file gets its name when it is whole; a repeated task writes the same names again.  Rows of one id in one task share a file, a line break after
    each."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(path)
        task = TaskContext.get()
        folder = f"{root}/part={task.partitionId()}"
        draft = f"{folder}/_draft-{task.taskAttemptId()}"
        system.create_dir(folder)
        current, stream, files = None, None, 0

        def finish() -> None:
            stream.close()
            system.move(draft, current)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                file = f"{folder}/{doc_id.as_py() if doc_id.is_valid else NO_ID}.txt"
                if file != current:
                    if stream is not None:
                        finish()
                    current, stream = file, system.open_output_stream(draft, compression=None)
                    files += 1
                if text.is_valid:
                    stream.write(text.as_buffer())
                stream.write(b"\n")
        if stream is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    system, root = file_system(path)
    system.create_dir(root)
    (docs.select("doc_id", "text").sortWithinPartitions("doc_id").mapInArrow(write, "files long")
     .agg(F.sum("files")).collect())


def write_long_files(docs: DataFrame, file_col: str, order_col: str, path: str) -> None:
    """One file for each value of ``file_col``: its texts by ``order_col``, a line break after each
    (an empty line for NULL).  A file is written by one task, row by row from its sorted input,
    which spills; nothing holds a file's text."""
    (docs.repartition(file_col).sortWithinPartitions(file_col, order_col)
     .select(file_col, "text").write.mode("overwrite").partitionBy(file_col).text(path))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file under ``path`` as one row ``(file_path, text)``: the whole file,
    verbatim (UTF-8); partition folders such as ``part=7`` become columns."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select("*", F.col("_metadata.file_path").alias("file_path"),
                      F.col("value").alias("text")).drop("value")


# -- S3 / S5 / S7: JSON lines -----------------------------------------------------------------

def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


# -- S4: the persisted index -------------------------------------------------------------------

def write_index(postings: DataFrame, path: str) -> None:
    """Postings as parquet, one folder per level (a level filter prunes folders) and
    sorted by term inside each file (row-group statistics then skip terms).  No shuffle:
    hash-partitioning by term would put every posting of a very frequent term into one
    task, so each task sorts and writes its own postings."""
    (postings.sortWithinPartitions("level", "term")
     .write.mode("overwrite").partitionBy("level").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
