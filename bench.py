"""Seconds per headline query over $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line.

Each query is run to the end by writing its rows to Spark's no-op sink. Of three runs the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from edgeloom.queries import QUERIES  # noqa: E402
from edgeloom.session import local_session  # noqa: E402

HEADLINE = [
    "follower_count", "follower_count_dense", "max_filter", "degrees", "two_path_degree",
    "two_path_count", "two_path_count_dense", "two_paths_shuffle", "two_paths_broadcast",
    "adjacency", "adjacency_blocks",
    "triangle_count_distinct_shuffle", "triangle_count_distinct_broadcast",
    "triangle_count_all_shuffle", "triangle_count_all_broadcast",
    "triangle_count_closing_exists_shuffle", "triangle_count_closing_exists_broadcast",
    "triangle_count_dense_distinct", "triangle_count_dense_all", "triangle_count_dense_closing_exists",
    "triangle_count_skewed_distinct", "two_paths_skewed", "triangles", "pagerank_step", "pagerank_chain", "pagerank_sink", "pagerank_out_degree",
    "read_edges_roundtrip", "write_pairs_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = local_session(cpus, "edgeloom-bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("follower_count")  # the first query of a JVM pays for its start
    seconds = {name: round(median(run(name) for _ in range(3)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
