"""Execute headline queries and summarise their final (adaptive) physical plans.

    python tools/plan_report.py [--sf /root/testdata/sf0.01] > PLANS.md

For each query: the exchanges (shuffles) with their partitioning, join strategies,
window/top-k operators, Python evaluation nodes, whole-stage-codegen stage count and the
parquet scans with their pushed filters and read schema.
"""

from __future__ import annotations

import argparse
import contextlib
import importlib.util
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.session import build_session  # noqa: E402

HEADLINE = ["chunk_windows", "pyramid", "tfidf_vectors", "search_benchmark", "search_zero_fill",
            "route", "router_log", "qa_pairs", "sample_train", "tokenize_sft",
            "left_pad_batches", "score_predictions", "best_checkpoints", "loss_rollup"]

KEEP = re.compile(r"^\((\d+)\) (Exchange|ShuffleQueryStage|BroadcastExchange|BroadcastHashJoin|"
                  r"SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|"
                  r"Window|WindowGroupLimit|TakeOrderedAndProject|ArrowEvalPython|"
                  r"HashAggregate|ObjectHashAggregate|SortAggregate|Scan parquet|Generate|"
                  r"ReusedExchange|Scan ExistingRDD|InMemoryTableScan)")


def summarise(text: str) -> list[str]:
    tree, _, details = text.partition("\n\n\n")
    final_tree = tree.split("== Initial Plan ==")[0]
    final_ids = set(re.findall(r"\((\d+)\)", final_tree.split("== Final Plan ==")[-1]))
    out, codegen = [], set()
    for block in re.split(r"\n\n", details):
        lines = block.strip().splitlines()
        if not lines:
            continue
        m = re.match(r"^\((\d+)\) (.*)$", lines[0])
        if not m or m.group(1) not in final_ids:
            continue
        codegen.update(re.findall(r"codegen id : (\d+)", lines[0]))
        if not KEEP.match(lines[0]):
            continue
        detail = [ln.strip() for ln in lines[1:] if ln.startswith((
            "Arguments", "Left keys", "Right keys", "Join type", "Keys", "PushedFilters",
            "ReadSchema", "Functions"))]
        out.append(lines[0].strip() + (" — " + "; ".join(d[:150] for d in detail) if detail else ""))
    out.append(f"whole-stage codegen stages: {len(codegen)}")
    return out


def _materialisations(spark, sf: str) -> None:
    """Plan of the write that runs as its own job: the term-frequency checkpoint (shown as
    the plan of the DataFrame it writes)."""
    from tessera.operators import corpus as C
    from tessera.operators.chunking import chunk_documents
    from tessera.operators.pyramid import PyramidParts
    from tessera.session import spread
    from tessera.sources import tables as TB

    df = C.term_frequency(C.level_counts(PyramidParts(chunk_documents(spread(TB.documents(spark, sf))))))
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    print("## materialisation: term-frequency checkpoint\n")
    for line in summarise(buf.getvalue()):
        print(f"- {line}")
    print()


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = build_session(shuffle_partitions=8)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` at `{args.sf}` on local[8] after execution, "
          "so the adaptive (final) plan is shown.  Each line is one operator of the final "
          "plan with its partitioning / keys / pushed filters.\n")
    if not args.names:
        _materialisations(spark, args.sf)
    for name in args.names or HEADLINE:
        df = entry.queries()[name](spark, args.sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        print(f"## `{name}`\n")
        for line in summarise(buf.getvalue()):
            print(f"- {line}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
