"""Headline workloads at one scale factor; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each workload is executed in full through Spark's ``noop`` sink (every row is produced,
nothing is collected to the driver), except the index build, which writes the persisted
index that the search then reads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators.chunking import chunk_documents  # noqa: E402
from tessera.operators.pyramid import PyramidParts  # noqa: E402
from tessera.operators.router.registry import call_log, default_router  # noqa: E402
from tessera.operators.sft import prepare as PR  # noqa: E402
from tessera.plans.ingest import ingest_documents, search_index  # noqa: E402
from tessera.session import build_session, shared_dir, spread  # noqa: E402
from tessera.sources import qa as QA  # noqa: E402
from tessera.sources import tables as TB  # noqa: E402
from tessera.sources.router_inputs import router_queries  # noqa: E402


def _sf_value(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    spark = build_session(master=f"local[{cpus}]", app="tessera-bench",
                          shuffle_partitions=2 * cpus,
                          conf={"spark.checkpoint.dir": scratch, "spark.driver.memory": "16g"})
    timings: dict[str, float] = {}
    counts: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up: start the JVM and one Python worker per core on a tiny table, so the
    # timings below measure steady-state work rather than process start-up
    region = TB.read_table(spark, sf_dir, "region").repartition(cpus)
    _run(region.select(F.pandas_udf(lambda s: s.str.len(), "long")("r_name")))

    docs = spread(TB.documents(spark, sf_dir))
    holder = {}

    def pyramid():
        holder["parts"] = PyramidParts(chunk_documents(docs))
        _run(holder["parts"].pyramid)
    timed("pyramid", pyramid)
    parts = holder["parts"]
    counts["chunks"] = parts.chunks.count()

    def build_index():
        holder["version"] = ingest_documents(docs, shared_dir(spark, "bench_index"), export_pyramid=False)
    timed("index_build", build_index)

    queries = TB.benchmark_queries(spark, sf_dir)
    timed("search_benchmark", lambda: _run(search_index(holder["version"], queries)))

    rq = router_queries(spark, sf_dir)
    timed("route", lambda: _run(call_log(default_router().route(rq))))
    counts["route_rows"] = rq.count()

    def sft():
        qa = QA.synthesize_qa(spark, sf_dir)
        vocab = PR.build_vocab(PR.with_prompts(qa))
        _run(PR.encode_batches(qa, vocab))
    timed("tokenize_sft", sft)
    counts["sft_rows"] = TB.read_table(spark, sf_dir, "lineitem").count()

    total = round(sum(timings.values()), 3)
    out = {
        "metric": "total_headline_seconds", "value": total, "unit": "sec",
        "queries": timings, "sf": _sf_value(sf_dir),
        "cpus": cpus,
        "throughput": {
            "pyramid_chunks_per_sec": round(counts["chunks"] / max(timings["pyramid"], 1e-9), 1),
            "route_rows_per_sec": round(counts["route_rows"] / max(timings["route"], 1e-9), 1),
            "tokenize_sft_rows_per_sec": round(counts["sft_rows"] / max(timings["tokenize_sft"], 1e-9), 1),
        },
        "rows": counts,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
