"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Session settings that every job relies on: AQE for runtime re-planning (partition
# coalescing, skew-join splitting, join-strategy switching on measured sizes), UTC for
# timestamps, Arrow for the few Python steps, and no web UI.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins go broadcast only on a size measured at run time: the planner's estimate does
    # not follow an explode, so the static threshold is off.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """A session for tests, the bench and local runs.

    On a cluster the session is normally provided by the platform; the library only
    reads settings from it (see :func:`shared_dir`).
    """
    cpus = os.environ.get("BENCH_CPUS", "*")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    settings.setdefault("spark.driver.memory", "8g")
    if conf:
        settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder that all executors and the driver share: ``spark.checkpoint.dir``, or the
    checkpoint folder set on the context; where neither is set, a folder of the session's
    warehouse, which a cluster shares as well.  Never a machine's temporary folder."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tessera_checkpoints")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under :func:`shared_base`."""
    path = "/".join([shared_base(spark).rstrip("/"), "tessera", *parts])
    return f"{path}-{uuid.uuid4().hex[:12]}" if unique else path


def spread(scan):
    """Round-robin a file scan that arrives in fewer partitions than there are task slots
    (e.g. one unsplittable file) so a CPU-heavy step after it runs on all cores.  A large
    input already has at least that many splits and is returned unchanged: no shuffle.

    Only for a plain scan: counting the partitions of a plan with an exchange would run it."""
    target = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < target:
        return scan.repartition(target)
    return scan


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The SparkContext checkpoint folder, set to :func:`shared_base` if there is none yet."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    return spark.sparkContext.getCheckpointDir()


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder now and continue from the
    written copy.  Used where one intermediate feeds several branches of a plan (Spark would
    otherwise recompute it per branch).  The written copy keeps ``df``'s partitioning, and
    a lost executor costs a re-read, not a recomputation from the source."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
