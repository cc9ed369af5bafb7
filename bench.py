"""Headline-query bench: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query is run to
completion with the no-op sink (every row computed, nothing collected) after
one warm-up pass of every query on the smallest fixture.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recforge.plans.registry import QUERIES  # noqa: E402
from recforge.session import local_session  # noqa: E402

HEADLINE = [
    "training_samples",      # W1-W7, J1-J2, A2, P1-P8
    "transition_probs",      # A7-A8
    "item_distribution",     # A9
    "user_embeddings",       # A10
    "nearest_k",             # K8
    "two_tower_scores",      # M9
    "random_walks",          # X5
    "als_user_recs",         # M4 + K4
]


def run(spark, name, sf_dir):
    t0 = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="recforge-bench")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):  # JIT and Python workers warm, as for a long-lived cluster session
        for n in names:
            run(spark, n, warm)
    times = {n: round(run(spark, n, sf_dir), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
