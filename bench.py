"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
is run once to its last row into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codeweft.queries import REGISTRY  # noqa: E402
from codeweft.session import build  # noqa: E402

HEADLINE = [
    "edges_by_kind",
    "ast_nodes",
    "graph_edges",
    "source_metadata",
    "file_metadata",
    "reconcile",
    "stale_elements",
    "node_merge",
    "edge_merge",
    "edge_enrich",
    "nearest_ancestor",
    "next_sibling",
    "reaching_defs",
    "compact_latest",
    "dead_letter",
    "table_digest",
    "replay_assertions",
    "metadata_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
