"""Stand-in inputs of registered queries: tables that in use arrive from outside (model
output, a training log), read from the test tables in the schema the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import constants as K


def step_log(events: DataFrame) -> DataFrame:
    """The events table read as a training step log: step = event_id + 1, loss = value."""
    return events.select((F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"))


def epoch_accuracy(events: DataFrame) -> DataFrame:
    """Per (run, epoch) accuracy read from the events table: run = user, epoch = day of the
    log (1 = first day in the table), accuracy = share of ``purchase`` events."""
    first_day = events.select(F.min(F.to_date("ts"))).scalar()
    return (events.groupBy(F.col("user_id").alias("run_id"),
                           (F.datediff(F.to_date("ts"), first_day) + 1).alias("epoch"))
            .agg(F.avg((F.col("event_type") == "purchase").cast("double")).alias("accuracy")))


def predictions(qa: DataFrame, seed: int = K.SEED) -> DataFrame:
    """``(qa_id, generated)``: by ``md5`` bucket keep / perturb / unmark / NULL."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-pred-"), F.col("qa_id").cast("string"))),
                           1, 8), 16, 10).cast("bigint") % 4
    marked = F.regexp_extract("answer", r"####\s*(-?\d+)", 1)
    perturbed = F.regexp_replace("answer", r"####\s*-?\d+",
                                 F.concat(F.lit("#### "), (marked.try_cast("bigint") + 1).cast("string")))
    unmarked = F.regexp_replace("answer", r"####\s*", "")
    gen = (F.when(h == 0, F.col("answer")).when(h == 1, perturbed)
           .when(h == 2, unmarked).otherwise(F.lit(None).cast("string")))
    return qa.select("qa_id", gen.alias("generated"))


def predictions_sql(qa_sql: str, seed: int = K.SEED) -> str:
    h = (f"(CAST(('0x' || substr(md5('{seed}-pred-' || CAST(qa_id AS VARCHAR)), 1, 8)) AS BIGINT) % 4)")
    return (f"SELECT qa_id, CASE {h} WHEN 0 THEN answer "
            f"WHEN 1 THEN regexp_replace(answer, '####\\s*-?\\d+', '#### ' || CAST(TRY_CAST(regexp_extract(answer, '####\\s*(-?\\d+)', 1) AS BIGINT) + 1 AS VARCHAR)) "
            f"WHEN 2 THEN regexp_replace(answer, '####\\s*', '') END AS generated FROM ({qa_sql})")
