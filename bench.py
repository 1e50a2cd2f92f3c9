"""Benchmark: metrics over a stored star, Silver job, extracts and format scans. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every figure is the best of three runs, as wall-clock seconds of the whole action.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clicklake import fixtures as fx  # noqa: E402
from clicklake.plans import increments, metrics, refine  # noqa: E402
from clicklake.schemas import SOURCE_TABLES, conform  # noqa: E402
from clicklake.session import configure, scratch_path  # noqa: E402
from clicklake.sinks import formats as sink_formats  # noqa: E402
from clicklake.sinks import tables as sinks  # noqa: E402
from clicklake.sources import formats  # noqa: E402
from clicklake.sources.bronze import read_bronze  # noqa: E402
from clicklake.sources.relational import incremental_scan  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3


def drain(df: DataFrame) -> None:
    """Compute every row and column of ``df`` and drop them."""
    df.write.format("noop").mode("overwrite").save()


def best(action: Callable[[], object]) -> float:
    samples = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        action()
        samples.append(time.perf_counter() - start)
    return round(min(samples), 4)


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    lake = scratch_path(spark, "bench")
    clicks = conform(fx.src_clicks(spark, SF_DIR), SOURCE_TABLES["clicks"])
    top = clicks.agg(F.max("id")).first()[0]
    cut = top * 7 // 10
    sinks.write_snapshot(clicks.where(F.col("id") <= cut), lake, "clicks", "2024-02-01")
    sinks.write_batch(incremental_scan(clicks, cut, top), lake, "clicks", cut, top)

    timings["silver_job"] = best(lambda: refine.silver_job(spark, lake, own_files=True))
    silver = spark.read.parquet(f"{lake}/silver/clicks")
    gold = f"{lake}/gold"
    timings["build_star"] = best(
        lambda: refine.publish_star(gold, fx.src_urls(spark, SF_DIR), fx.src_users(spark, SF_DIR), silver)
    )

    urls, users = fx.src_urls(spark, SF_DIR), fx.src_users(spark, SF_DIR)
    timings["build_star_shuffled_lookup"] = best(
        lambda: refine.publish_star(f"{lake}/gold-shuffled", urls, users, silver, broadcast_bytes=0)
    )
    foreign = f"{lake}/foreign/bronze"
    for day, kind in enumerate(("int", "decimal(20,0)", "string"), 1):
        part = clicks.where(F.col("id") % 3 == day - 1).withColumn("id", F.col("id").cast(kind))
        part.write.parquet(f"{foreign}/clicks/ingestion_date=2024-02-0{day}")
    timings["foreign_bronze_read"] = best(lambda: drain(read_bronze(spark, foreign)))
    for day, known in (("2024-02-01", urls.where("id % 4 <> 0")), ("2024-02-02", urls)):
        sinks.write_snapshot(conform(known, SOURCE_TABLES["urls"]), lake, "urls", day)
        sinks.write_snapshot(conform(users, SOURCE_TABLES["users"]), lake, "users", day)
    # The first run works in both days, the later ones the last day again.
    timings["gold_job_two_days"] = best(lambda: refine.gold_job(spark, lake))

    # By increments: the second load and day onto a state that is made anew, unmeasured, for each run.
    samples: dict[str, list[float]] = {"silver_increment": [], "gold_increment": []}
    for _ in range(REPEATS):
        own = scratch_path(spark, "bench-increments")
        for k, (day, known) in enumerate((("2024-02-01", urls.where("id % 4 <> 0")), ("2024-02-02", urls))):
            sinks.write_snapshot(clicks.where(F.col("id") <= cut if k == 0 else F.col("id") > cut), own, "clicks", day)
            sinks.write_snapshot(conform(known, SOURCE_TABLES["urls"]), own, "urls", day)
            sinks.write_snapshot(conform(users, SOURCE_TABLES["users"]), own, "users", day)
            for name, job in (("silver_increment", increments.silver_increment), ("gold_increment", increments.gold_increment)):
                start = time.perf_counter()
                job(spark, own)
                if k == 1:
                    samples[name].append(time.perf_counter() - start)
    timings |= {name: round(min(found), 4) for name, found in samples.items()}

    star = refine.read_star(spark, gold)
    for name in metrics.CATALOGUE:
        timings[name] = best(lambda name=name: metrics.metric(name, star).collect())

    source = f"{lake}/source"
    sinks.publish(clicks.sortWithinPartitions("id"), source)
    stored = spark.read.parquet(source)
    timings["extract_full"] = best(lambda: drain(stored))
    timings["extract_incremental"] = best(lambda: drain(incremental_scan(stored, cut)))

    for fmt in formats.FORMATS:
        path = f"{lake}/formats/{fmt}"
        timings[f"{fmt}_write"] = best(lambda: sink_formats.write(stored, path, fmt))
        timings[f"{fmt}_full_read"] = best(lambda: drain(formats.scan(spark, path, fmt)))
        timings[f"{fmt}_one_column_read"] = best(lambda: drain(formats.scan(spark, path, fmt, columns=["device_type"])))

    print(
        json.dumps(
            {
                "metric": "total wall-clock of all benchmark queries",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "fact_rows": star["fact_clicks"].count(),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
