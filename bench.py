"""Headline queries on the tables of $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line.

Every query runs to completion into a sink that drops the rows.  Times are the
best of three runs in one warm session, of two for the load of the star schema
into an empty folder.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from hazardry.plans import catalog
from hazardry.plans import warehouse as W
from hazardry.plans.lifts import lift
from hazardry.sources.workspace import fresh_folder

HEADLINES = [
    "event_summary",
    "event_summary_filtered",
    "event_counts",
    "monthly_trends",
    "monthly_trends_filtered",
    "top_locations",
    "search_events",
    "map_grid",
    "map_hex",
    "map_points",
    "stratified_cap",
    "process_events",
    "processing_stats",
    "dedup_last",
    "upsert_last_wins",
    "nearest_city",
    "fire_clusters_modis",
    "fire_clusters_viirs",
    "hull_area",
    "flood_fmi",
    "norm_all",
    "stream_process",
]


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hazardry")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()

    loaded: dict[str, int] = {}

    def load() -> None:
        store = W.Warehouse(spark, fresh_folder(spark, "bench"))
        loaded.update(store.load(catalog._hist(spark, sf_dir), lift(spark, sf_dir, "gaz")))

    seconds = {"star_load": min(_timed(load) for _ in range(2))}
    for name in HEADLINES:
        run = lambda: catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = min(_timed(run) for _ in range(3))
    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "star_load_rows_per_sec": round(loaded["inserted"] / seconds["star_load"]),
                "event_summary_ms": round(seconds["event_summary"] * 1000),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
