"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from cellwatch.session import build_session

HEADLINE = [
    "decode_weather",
    "feature_snapshots",
    "unified_events",
    "nearest_cell",
    "ordinal_risk",
    "batch_model_scores",
    "confirmed_alerts",
    "neighbor_propagation",
    "daily_outcomes",
    "daily_training",
    "cell_windows",
    "window_snapshots",
    "payload_flatten",
    "response_decode",
    "all_predictions",
    "encoder_export",
    "incremental_outcomes",
    "fire_history",
    "recent_maxima",
    "latest_weather",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from cellwatch.registry import QUERIES

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events_per_sec": {q: round(n_events / seconds[q]) for q in ("daily_outcomes", "cell_windows")},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
