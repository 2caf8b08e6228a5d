"""Bucketed folds of bars, open interest and ratios.

Each fold is recomputed from base rows that are already one per key; nothing is
accumulated, so a fold can be repeated at will.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import versions
from candlemill.operators.filters import within


def _bar_folds() -> list[Column]:
    return [
        F.max("end_ms").alias("end_ms"),
        F.min_by("open", "start_ms").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "start_ms").alias("close"),
        *[F.sum(c).alias(c) for c in S.VOLUMES],
        F.sum("trades_count").alias("trades_count"),
    ]


def rollup_klines(bars: DataFrame, interval: str) -> DataFrame:
    """Fold 1m bars to one row per symbol and bucket."""
    step = tg.rollup_step(interval)
    return (
        bars.groupBy("symbol", tg.bucket(F.col("start_ms"), step).alias("bucket_ms"))
        .agg(*_bar_folds())
        .select("symbol", F.col("bucket_ms").alias("start_ms"), "end_ms", *S.BAR_VALUES)
    )


def rollup_raw_klines(raw: DataFrame, interval: str, bounded_copies: bool = False) -> DataFrame:
    """Dedup raw bars and fold them.

    By default the dedup collapses copies before its shuffle, whatever their
    number, and the fold shuffles again. Where the writer bounds the copies of a
    bar (a compacted table does), ``bounded_copies`` places rows by symbol and
    bucket once and both steps share that one exchange.
    """
    if not bounded_copies:
        return rollup_klines(versions.latest_bars(raw), interval)
    step = tg.rollup_step(interval)
    placed = raw.withColumn("bucket_ms", tg.bucket(F.col("start_ms"), step)).repartition(
        "symbol", "bucket_ms")
    bars = versions.latest_by_version(
        placed, ["symbol", "bucket_ms", "start_ms"], ["version", "ingest_seq"])
    return (bars.groupBy("symbol", "bucket_ms").agg(*_bar_folds())
            .select("symbol", F.col("bucket_ms").alias("start_ms"), "end_ms", *S.BAR_VALUES))


def rollup_klines_many(bars: DataFrame, intervals: list[str]) -> DataFrame:
    """All levels in one scan and one exchange; adds an ``interval`` column.

    Rows are repeated once per level before the partial aggregation, which folds
    them again inside the same task, so the exchange carries buckets, not rows.
    """
    levels = F.explode(F.array(*[
        F.struct(F.lit(iv).alias("interval"), F.lit(tg.rollup_step(iv)).cast("long").alias("step"))
        for iv in intervals]))
    rows = bars.withColumn("_level", levels)
    start = F.col("start_ms")
    return (
        rows.groupBy("symbol", F.col("_level.interval").alias("interval"),
                     (start - F.pmod(start, F.col("_level.step"))).alias("bucket_ms"))
        .agg(*_bar_folds())
        .select("symbol", "interval", F.col("bucket_ms").alias("start_ms"), "end_ms", *S.BAR_VALUES)
    )


def rollup_oi(oi: DataFrame, interval: str) -> DataFrame:
    """Fold 5m open interest: value at the bucket's close, its range, row count."""
    step = tg.rollup_step(interval)
    value = "sum_open_interest"
    return (
        oi.groupBy("symbol", tg.bucket(F.col("start_ms"), step).alias("bucket_ms"))
        .agg(F.count("*").alias("samples"),
             F.max_by(value, "start_ms").alias("close"),
             F.max(value).alias("high"),
             F.min(value).alias("low"))
        .withColumnRenamed("bucket_ms", "start_ms")
    )


def rollup_ratios(ratios: DataFrame, interval: str) -> DataFrame:
    """Fold 5m ratios; a measure's close is its last value that is not NULL."""
    step = tg.rollup_step(interval)
    folds = []
    for c in S.RATIOS:
        # max_by ignores rows whose ordering is NULL, so a missing value cannot win
        seen_at = F.when(F.col(c).isNotNull(), F.col("start_ms"))
        folds += [F.max_by(c, seen_at).alias(f"{c}_close"),
                  F.max(c).alias(f"{c}_high"), F.min(c).alias(f"{c}_low")]
    return (
        ratios.groupBy("symbol", tg.bucket(F.col("start_ms"), step).alias("bucket_ms"))
        .agg(F.count("*").alias("samples"), *folds)
        .withColumnRenamed("bucket_ms", "start_ms")
    )


def refresh_bound(now_ms: int, interval: str, lookback_days: int) -> int:
    """First bucket an incremental refresh rewrites, always a bucket start.

    A bound inside a bucket would overwrite that bucket from part of its rows.
    """
    return tg.floor_to(now_ms - lookback_days * tg.DAY_MS, tg.rollup_step(interval))


def refresh_rows(base: DataFrame, now_ms: int, interval: str, lookback_days: int) -> DataFrame:
    """Base rows an incremental refresh has to read."""
    return within(base, refresh_bound(now_ms, interval, lookback_days))


def complete_only(rollup: DataFrame, interval: str) -> DataFrame:
    """Snapshot buckets that hold every one of their 5m rows."""
    return rollup.where(F.col("samples") == tg.interval_ms(interval) // tg.BAR_MS)
