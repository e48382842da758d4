"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables and BENCH_CPUS the cores. The crosswalk is published once, as its own
entry, and read back by the queries that need it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perigee.bindings import domain  # noqa: E402
from perigee.bindings.registry import load  # noqa: E402
from perigee.runtime import build_session  # noqa: E402

HEADLINE = [
    "snapshot_coverage", "risk_metric_history", "presence_history", "object_lifecycle", "risk_history_by_run",
    "entity_bridge", "id_resolution", "characterization_profile", "coherent_snapshot", "catalog_profile",
    "threat_watchlist_view", "threat_watchlist", "cross_source_profile", "crosswalk_coverage_audit",
    "world_snapshot", "risk_profile", "asteroid_detail", "unified_profile", "raw_approach_rows", "raw_risk_rows",
    "catalog_object_rows", "latest_event_per_user", "first_line_per_order", "approach_totals", "closest_ten",
    "distance_bands", "squeezed_documents", "redacted_pages", "structure_checks", "crosswalk_checks",
    "raw_replay", "deep_line_page", "world_in_order", "published_approaches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark_sql_shuffle_partitions": cpus, "spark_ui_enabled": "false", "spark_driver_memory": "12g",
        "spark_ui_showConsoleProgress": "false", "spark_log_level": "OFF"})
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    domain.published_crosswalk(spark, sf_dir)
    seconds["publish_crosswalk"] = round(time.perf_counter() - start, 3)
    queries = load()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
