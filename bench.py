"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query runs once for time,
after a run on the smallest data that warms up the JVM. Results go to Spark's noop sink, published tables to the
folder the session names.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from suite import QUERIES
from suite.apply_queries import LINE_KEY
from suite.registry import new_store, rows_of

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "scan_table query_source_join_agg query_source_window_topk query_source_rollup project_expr incr_filter incr_template "
    "clean_blank clean_control csv_export_lines text_guid mode_initial mode_full mode_append mode_merge mode_merge_null_pk "
    "mode_merge_hot_key mode_merge_dup_source merge_counts mode_chunked_merge hwm_compute hwm_upsert jobs_resolved "
    "mapping_violations publish_merge mode_chunked_append publish_chunked_merge incremental_append stream_append stream_merge"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def load_rates(spark: SparkSession) -> dict[str, float]:
    """Rows per second of each mode on lineitem, published; merges with 1 %, 10 % and 100 % of the target."""
    lines = rows_of(spark, SF_DIR, "SELECT * FROM lineitem")
    total = lines.count()
    store = new_store(spark, lines)
    rates = {"initial": total / timed(lambda: store.load(lines, "initial"))}
    days = lines.selectExpr("percentile_approx(l_shipdate, array(0.99, 0.9), 10000) AS d").first().d
    for name, day in zip(("merge_1pct", "merge_10pct"), days):
        part = lines.where(lines.l_shipdate > day)
        rows = part.count()
        rates[name] = rows / timed(lambda part=part: store.load(part, "merge", pk=LINE_KEY, incr="l_shipdate"))
    rates["merge_100pct"] = total / timed(lambda: store.load(lines, "merge", pk=LINE_KEY, incr="l_shipdate"))
    rates["append"] = total / timed(lambda: store.load(lines, "append", incr="l_shipdate"))
    rates["full"] = total / timed(lambda: store.load(lines, "full"))
    return {name: round(rate) for name, rate in rates.items()}


def main() -> None:
    spark = session()
    warm_up = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    for name in HEADLINES if os.path.isdir(warm_up) else ():
        run_all(QUERIES[name](spark, warm_up))
    seconds = {name: timed(lambda name=name: run_all(QUERIES[name](spark, SF_DIR))) for name in HEADLINES}
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "rows_per_sec": load_rates(spark),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
