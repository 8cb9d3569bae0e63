"""Benchmark the headline queries.

Runs each query after a warm-up on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
the median of 3 runs for queries of up to 10 seconds, one run of the others
(``$BENCH_RUNS`` fixes the number for all).
A query's time covers building it (including any stage it writes) and
materialising the full result with the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from itemwise.plans import catalog  # noqa: E402
from itemwise.session import get_spark  # noqa: E402

HEADLINE = [
    "left_join_chain",        # entry 1: four joins + JSON
    "clean_items",            # distinct + per-title first row
    "label_distribution",     # flagship: clean + label + distribution
    "expand_tokens",          # entry 2: per-day token top-k on four lists
    "remove_conflicts",       # union of days minus contradictory titles
    "ordinal_encode",         # vocabulary fit + 18 encoded columns
    "profile_nunique",        # exact distinct counts of all columns
    "step_counts",            # every cleaning step from one grouped pass
    "topk_tokens_6",          # top-k over whole document texts
    "token_frequency",
    "auc_exact",
    "roc_curve",
    "threshold_sweep",
    "score_density",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "0"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("left_join_item")  # warm-up: JVM, codegen caches, file listing
    times = {}
    for name in names:
        took = [run(name)]
        more = runs - 1 if runs else 2 if took[0] <= 10 else 0
        times[name] = round(statistics.median(took + [run(name) for _ in range(more)]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "spark": spark.version}))


if __name__ == "__main__":
    main()
