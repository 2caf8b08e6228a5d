"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to a no-op sink, so every row is produced but none reaches the
driver. ``volume_*`` run on a few million bars derived from ``lineitem``, where
row counts matter more than market meaning.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

import workload  # noqa: E402
from candlemill.operators import gaps, rollup  # noqa: E402
from candlemill.session import build_session  # noqa: E402

HEADLINE = [
    "final_dedup", "source_precedence", "kline_5m", "kline_1h", "kline_1d", "kline_all_levels", "oi_1h", "ratio_1h",
    "rollup_refresh", "bar_quality", "oi_verdict", "coverage_bar", "conservation", "kline_gaps", "minute_gaps", "oi_gaps",
    "last_200", "oi_delta", "monotonic_guard", "snap_plan", "merge_ranges", "kline_with_oi", "market_panel",
    "rollup_mismatch", "reconcile_external", "merge_ratios", "clock_probe", "subtract_present", "wanted_bars",
    "repair_stats", "resume_plan", "sections", "held_sections", "silence_gaps", "archive_align", "stream_frames",
    "validate_live",
]
REPEAT = 40  # copies of lineitem, each a day later


def volume_bars(spark, sf_dir):
    """lineitem as raw bars: a supplier is a symbol, copies fill the minutes of its ship day."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("symbol"),
        (F.unix_date(F.col("l_shipdate").cast("date")).cast("long") * 86_400_000
         + (F.col("l_orderkey") % 360) * 240_000).alias("at"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("volume"),
        F.col("l_orderkey").alias("ingest_seq"))
    # the source is one small file; a real table arrives in many splits
    rows = rows.repartition(spark.sparkContext.defaultParallelism * 2)
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(REPEAT - 1))))
    price = F.col("price")
    start = F.col("at") + F.col("copy") * 60_000
    return copies.select(
        "symbol", start.alias("start_ms"), (start + 59_999).alias("end_ms"), price.alias("open"),
        (price + 1).alias("high"), (price - 1).alias("low"), price.alias("close"), "volume",
        (F.col("volume") * price).alias("quote_volume"), F.col("volume").alias("taker_buy_volume"),
        (F.col("volume") * price).alias("taker_buy_quote_volume"), F.lit(1).cast("long").alias("trades_count"),
        (F.col("copy") % 3).cast("long").alias("version"), "ingest_seq")


VOLUME = {
    "volume_dedup_rollup": lambda s, d: rollup.rollup_raw_klines(volume_bars(s, d), "1h"),
    "volume_dedup_rollup_colocated": lambda s, d: rollup.rollup_raw_klines(volume_bars(s, d), "1h", True),
    "volume_rollup_levels": lambda s, d: rollup.rollup_klines_many(volume_bars(s, d), ["5m", "15m", "1h", "4h", "1d"]),
    "volume_gaps": lambda s, d: gaps.find_gaps(volume_bars(s, d), 60_000),
    "volume_gaps_on_grid": lambda s, d: gaps.find_gaps(volume_bars(s, d), 60_000, on_grid=True),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("candlemill-bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    spark.sparkContext.setLogLevel("ERROR")
    runs = {**{name: workload.QUERIES[name] for name in HEADLINE}, **VOLUME}
    only = sys.argv[1:]
    times: dict[str, float] = {}
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    for name, run in runs.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() * REPEAT
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1], "volume_rows": rows}))


if __name__ == "__main__":
    main()
