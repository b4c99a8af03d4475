import os


from tessera.session import materialize, shared_dir, spread
from tessera.streaming.router_stream import start_router_log


def test_shared_dir_under_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    p1, p2 = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert p1.startswith(base.rstrip("/")) and p1 != p2


def test_materialize_keeps_rows_and_partitioning(spark):
    df = spark.range(1000).repartition(5, "id")
    m = materialize(df)
    assert m.rdd.getNumPartitions() == 5
    assert sorted(r.id for r in m.collect()) == list(range(1000))


def test_spread_only_when_under_partitioned(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism + 3)
    assert spread(many).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism + 3


def test_streaming_router_log(spark, router_golden):
    src, sink, ckpt = (shared_dir(spark, n) for n in ("s_src", "s_sink", "s_ckpt"))
    rows = [(str(i), g["query"]) for i, g in enumerate(router_golden)]
    spark.createDataFrame(rows, "query_id string, query string").write.parquet(src)
    q = start_router_log(spark, src, sink, ckpt)
    q.awaitTermination()
    got = sorted(spark.read.parquet(sink).collect(), key=lambda r: int(r.query_id))
    assert [(r.detected, r.module_used, r.confidence) for r in got] == \
        [(g["detected"], g["module_used"], g["confidence"]) for g in router_golden]
    assert os.path.isdir(ckpt)
