"""Exact duplicates (operator 12): 128-bit content hash, smallest id kept, bytes compared.

Two texts are equal when they are the same after each run of white space
(``[\\x20\\x09-\\x0D]+``) becomes one space.

1. One pass over the texts writes a narrow table: row number, id and the MD5 (128 bits) of the
   normalised text.  No text is in it.
2. The groups are counted from that table: size and the row with the smallest id.
3. Bytes are compared inside the groups by an aggregation whose key is hash *and* text: copies
   collapse before the shuffle to one row a task, so a text that a third of all rows have is no
   larger than another, and what is left is one row for each different text of a hash.
4. A hash with one text is a group.  The rows of a hash with several texts (a collision) are
   grouped again in the same way by another hash, until no two texts share one.
5. Decisions go back to the rows by a join on the hash.  A hash of more than one row in
   ``HOT_SHARE`` is broadcast, and there can be no more than ``HOT_SHARE`` of those; all others
   are joined by a shuffle, in which no key has more rows than that.

Defined results: a NULL text is empty; an empty text and a blank one (one space) differ; texts
are whole, whatever their length.  A NULL id is larger than every other, and ``keep_id`` is
NULL only where all ids of a group are.  Of repeated rows (same id, same text) one is kept.  An
empty table gives no rows.  Columns other than the id and the text are not read by
:func:`label`, so their names do not matter; :func:`keep_first` returns all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

#: A hash of more than one row in so many is broadcast: at most so many of them exist.
HOT_SHARE = 1000
_WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _WHITE, " ")


def content_hash(body: Column, attempt: int) -> Column:
    """128 bits of a normalised text.  Each attempt hashes another text, so texts that
    collide in one do not in the next."""
    return F.unhex(F.md5(F.concat(F.lit(f"{attempt}:"), body) if attempt else body))


def _decide(rows: DataFrame, digest: Callable[[Column, int], Column], attempt: int) -> DataFrame:
    """``rows`` (row, id, body) -> (row, id, keep_id, group_size, kept, text_sha256)."""
    hashed = rows.withColumn("hash", digest(F.col("body"), attempt))
    narrow = written(hashed.select("row", "id", "hash"), "exact_rows")
    texts = (hashed.select("hash", "body").distinct().select("hash", F.sha2("body", 256).alias("sha"))
             .groupBy("hash").agg(F.count(F.lit(1)).alias("texts"), F.min("sha").alias("text_sha256")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = written(narrow.groupBy("hash").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))
                     .join(texts, "hash"), "exact_groups")
    total = groups.select(F.sum("group_size")).scalar()
    single = groups.where("texts = 1").select(
        "hash", "group_size", "text_sha256", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"),
        (F.col("group_size") * HOT_SHARE > total).alias("hot"))
    hot, others = single.where("hot"), single.where("not hot")
    out = (narrow.join(F.broadcast(hot), "hash")
           .unionByName(narrow.join(F.broadcast(hot.select("hash")), "hash", "left_anti").join(others, "hash"))
           .select("row", "id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                   "text_sha256"))
    collided = groups.where("texts > 1").select("hash")
    if collided.isEmpty():
        return out
    again = written(hashed.join(collided, "hash", "left_semi").select("row", "id", "body"), "exact_collided")
    return out.unionByName(_decide(again, digest, attempt + 1))


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest: Callable[[Column, int], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (id of the row that stays), group_size,
    kept, text_sha256 (lowercase hex of the normalised text)."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("body"))
    return (_decide(rows.withColumn("row", F.monotonically_increasing_id()), digest, 0)
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact duplicates: all columns of the row with the smallest id of each
    group of equal texts.  The rows are written once with a number, so that the number of a row
    does not change while the decisions are made."""
    number = "_exact_row"
    while number in docs.columns:
        number += "_"
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "exact_input")
    rows = numbered.select(F.col(number).alias("row"), F.col(id_col).alias("id"),
                           normalised(F.col(text_col)).alias("body"))
    kept = _decide(rows, content_hash, 0).where("kept").select(F.col("row").alias(number))
    return numbered.join(kept, number, "left_semi").select(*docs.columns)
