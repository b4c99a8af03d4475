"""Tables whose rows stay with their page.

A page is a few hundred chunks that were written together.  Its tables are bucketed by page, so
whatever is grouped or joined by page (and anything else) is read in place: no shuffle.  Spark
keeps bucketing in its catalog only, so the files get a table name for as long as it takes to
resolve them; no name stays behind, and the files can be opened again by any session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PAGE = "page"
_SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def bucket_count(spark: SparkSession) -> int:
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")),
               int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def open_paged(spark: SparkSession, path: str, schema: T.StructType, buckets: int,
               order: list[str] | None = None) -> DataFrame:
    """A table written by :func:`write_paged`."""
    # a join on page and term may use the page alone to bring its sides together
    spark.conf.set(_SUBSET, "false")
    # a bucket that is one sorted file is not sorted again
    spark.conf.set(_ORDERED, "true")
    name = f"tessera_paged_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    ordered = f"SORTED BY ({', '.join(order)}) " if order else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({PAGE}) {ordered}INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def write_paged(df: DataFrame, path: str, buckets: int, order: list[str] | None = None) -> DataFrame:
    """``df`` (with ``page``) written to ``path`` and read back.  Each task writes its own pages:
    no shuffle.  ``order``: columns that sort every file."""
    spark = df.sparkSession
    name = f"tessera_paged_{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet").bucketBy(buckets, PAGE).option("path", path).option("compression", "zstd")
    (writer.sortBy(*order) if order else writer).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    return open_paged(spark, path, df.schema, buckets, order)
