"""Headline timings: python bench.py prints one JSON line. Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_CHECKPOINT_DIR."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from merchantry.operators import cache
from merchantry.plans import models
from merchantry.registry import QUERIES
from merchantry.session import get_session
from merchantry.sources import files, sinks
from merchantry.sources.store import release, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = (
    "q_3nf_1_order_lines q_3nf_2_revenue_by_user q_3nf_3_orders_by_day "
    "q_star_1_revenue_by_product q_star_2_top_users q_star_3a_daily_revenue q_star_3b_weekly_revenue q_star_3c_monthly_growth "
    "q_star_4a_revenue_by_location q_star_4b_revenue_by_region q_star_5_category_performance "
    "q_snow_1_revenue_by_product q_snow_2_top_users q_snow_3a_revenue_by_region q_snow_3b_revenue_by_state "
    "q_snow_3c_revenue_by_city q_snow_4_category_performance "
    "q_bm_1_revenue_by_product_3nf q_bm_1_revenue_by_product_star q_bm_1_revenue_by_product_snow "
    "q_bm_2_top_users_3nf q_bm_2_top_users_star q_bm_2_top_users_snow "
    "q_bm_3_monthly_revenue_3nf q_bm_3_monthly_revenue_star q_bm_3_monthly_revenue_snow "
    "q_bm_4_wide_join_3nf q_bm_4_wide_join_star q_bm_4_wide_join_snow "
    "q_bm_5_heavy_aggregate_3nf q_bm_5_heavy_aggregate_star q_bm_5_heavy_aggregate_snow "
    "q_bm_6_filtered_products q_bm_6_filtered_documents"
).split()


def drain(df) -> None:
    """Compute every column of every row without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median(action) -> float:
    return round(statistics.median(timed(action) for _ in range(RUNS)), 4)


def format_times(spark, users) -> tuple[dict[str, float], dict[str, float]]:
    """Writing and reading the 31-column user table in each format, and the MB that it takes."""
    formats = {
        "csv": (sinks.write_csv, lambda p: files.read_csv(spark, p, users.schema)),
        "json": (sinks.write_json_lines, lambda p: spark.read.schema(users.schema).json(p)),
        "parquet": (sinks.write_parquet, lambda p: spark.read.schema(users.schema).parquet(p)),
    }
    times, sizes = {}, {}
    for name, (write, read) in formats.items():
        path = scratch_path(spark, f"bench-{name}")
        times[f"format_{name}_write"] = median(lambda: write(users, path))
        times[f"format_{name}_read"] = median(lambda: drain(read(path)))
        sizes[name] = round(files.size_mb(spark, path).first()[0], 3)
    return times, sizes


def main() -> None:
    folder = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="merchantry-bench-")
    spark = get_session(f"local[{CPUS}]", CPUS, **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.checkpoint.dir": folder})
    spark.sparkContext.setLogLevel("ERROR")
    queries: dict[str, float] = {}
    for build in (models.normalized, models.star, models.snowflake, models.collections):
        queries[f"build_{build.__name__}"] = round(timed(lambda: build(spark, SF_DIR).items()), 4)
    for name in HEADLINES:
        queries[name] = median(lambda: QUERIES[name](spark, SF_DIR).collect())
    tables = models.normalized(spark, SF_DIR)
    times, sizes = format_times(spark, tables["users"])
    queries.update(times)
    snapshot = lambda: cache.load(
        {"user": tables["users"], "product": tables["products"], "order": tables["orders"]}, "2025-01-01 12:00:00"
    )
    queries["cache_put"] = median(lambda: drain(snapshot()))
    queries["read_one_by_id"] = median(lambda: tables["users"].filter("id = 42").collect())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": CPUS, "runs": RUNS, "format_mb": sizes,
    }))
    for model in ("documents", "snowflake", "star", "normalized"):
        release(spark, SF_DIR, model)


if __name__ == "__main__":
    main()
