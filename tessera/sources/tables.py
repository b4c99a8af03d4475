"""Readers for the input tables.

Every reader returns a lazy DataFrame over parquet; Catalyst prunes the columns a plan
does not use and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "documents").select("doc_id", "text")


def benchmark_queries(spark: SparkSession, base: str) -> DataFrame:
    """``benchmark`` rows as a search-query table ``(query_id, query)``."""
    return (read_table(spark, base, "benchmark")
            .selectExpr("item_id AS query_id", "text AS query"))
