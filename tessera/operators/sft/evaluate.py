"""Answer scoring and run metrics.

All of these are aggregations: exact-match scoring is a join on the example id plus a
global average (partial aggregation, one row out); loss roll-ups group a step log into
blocks; best-checkpoint selection is a running maximum over a run's few epoch rows (the
per-epoch table is aggregated first, so no window ever sees raw log rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.functions.text import extract_final_answer


def score_predictions(preds: DataFrame, truth: DataFrame, id_col: str = "qa_id") -> DataFrame:
    """Extract the final number from the generation and from the reference answer and
    compare them as strings; a NULL prediction is wrong."""
    joined = truth.select(id_col, "answer").join(preds.select(id_col, "generated"), id_col, "left")
    pred = extract_final_answer("generated")
    true = extract_final_answer("answer")
    return joined.select(id_col, pred.alias("pred"), true.alias("truth"),
                         F.coalesce(pred.isNotNull() & (pred == true), F.lit(False)).alias("correct"))


def exact_match_accuracy(scored: DataFrame) -> DataFrame:
    """Correct / max(total, 1) (0.0 on an empty table)."""
    total = F.count(F.lit(1))
    correct = F.sum(F.col("correct").cast("long"))
    return scored.agg(total.alias("n_total"), F.coalesce(correct, F.lit(0)).alias("n_correct"),
                      (F.coalesce(correct, F.lit(0)) / F.greatest(total, F.lit(1))).alias("accuracy"))


def loss_rollup(steps: DataFrame, every: int = K.LOGGING_STEPS) -> DataFrame:
    """A10: one record per block of ``every`` steps: the block's last step, its number of
    steps and the mean loss (rounded to 4 places as logged)."""
    block = F.floor((F.col("step") - 1) / every)
    return (steps.groupBy(block.alias("block"))
            .agg(F.count(F.lit(1)).alias("n_steps"), F.avg("loss").alias("mean_loss"))
            .select(((F.col("block") + 1) * every).cast("long").alias("step"), "n_steps",
                    F.round("mean_loss", 4).alias("train_loss")))


def with_epoch(rollup: DataFrame, steps_per_epoch) -> DataFrame:
    """Adds ``epoch`` (from 1) to metric records: the epoch of the block's last step."""
    return rollup.withColumn("epoch", F.ceil(F.col("step") / steps_per_epoch).cast("int"))


def checkpoint_steps(steps: DataFrame, every: int = K.SAVE_STEPS) -> DataFrame:
    """The steps at which a checkpoint is written (multiples of ``every``)."""
    return steps.where(F.col("step") % every == 0).select("step").distinct()


def best_checkpoints(acc: DataFrame) -> DataFrame:
    """An epoch is kept when its accuracy is strictly above every earlier epoch of the
    same run (and above 0.0, the starting best)."""
    prior = Window.partitionBy("run_id").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.coalesce(F.max("accuracy").over(prior), F.lit(0.0))
    return acc.select("run_id", "epoch", "accuracy",
                      (F.col("accuracy") > F.greatest(best_before, F.lit(0.0))).alias("is_best"))


def run_summary(train: DataFrame, eval_: DataFrame, rollup: DataFrame,
                accuracy: DataFrame) -> DataFrame:
    """Sample counts, final logged loss (at the largest step) and accuracy."""
    return (accuracy.select(
        train.select(F.count(F.lit(1))).scalar().alias("train_samples"),
        eval_.select(F.count(F.lit(1))).scalar().alias("eval_samples"),
        rollup.select(F.max_by("train_loss", "step")).scalar().alias("final_train_loss"),
        F.col("accuracy").alias("accuracy")))
