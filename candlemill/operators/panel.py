"""Consumer reads: panels joined on (symbol, start_ms), cross-sections, newest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.functions import columns as fx
from candlemill.operators import ordered


def kline_with_oi(bars: DataFrame, oi: DataFrame) -> DataFrame:
    """Bars with the open interest known at their close; NULL where there is none."""
    return bars.join(oi.select(*S.BAR_KEYS, "sum_open_interest"), S.BAR_KEYS, "left")


def market_panel(bars: DataFrame, oi: DataFrame, ratios: DataFrame) -> DataFrame:
    """Bars, open interest and ratios of the same bar; all joins share one key."""
    return kline_with_oi(bars, oi).join(
        ratios.select(*S.BAR_KEYS, *S.RATIOS), S.BAR_KEYS, "left")


def derived_measures(panel: DataFrame) -> DataFrame:
    """Approximate notional, taker buy/sell ratio and the long share of each ratio."""
    sold = F.col("volume") - F.col("taker_buy_volume")
    added = {
        "oi_value": F.col("sum_open_interest") * F.col("close"),
        "taker_ratio": F.try_divide("taker_buy_volume", sold),
    }
    for c in S.RATIOS:
        if c in panel.columns:
            added[f"{c}_long_share"] = F.try_divide(F.col(c), F.lit(1.0) + F.col(c))
    return panel.withColumns(added)


def oi_delta(oi: DataFrame) -> DataFrame:
    """Bar-over-bar change of open interest; NULL on a symbol's first row."""
    rows = ordered.with_previous(oi.select(*S.BAR_KEYS, "sum_open_interest"), ["symbol"],
                                 "start_ms", {"sum_open_interest": "previous"})
    return rows.select(*S.BAR_KEYS, "sum_open_interest",
                       (F.col("sum_open_interest") - F.col("previous")).alias("d_oi"))


def oi_open(rollup: DataFrame, chunk_ms: int) -> DataFrame:
    """Opening value of each bucket: the close of the symbol's bucket before it."""
    return ordered.with_previous(rollup, ["symbol"], "start_ms", {"close": "open"}, chunk_ms)


def last_n(df: DataFrame, n: int, keys: list[str] | None = None,
           order: str = "start_ms") -> DataFrame:
    """Newest ``n`` rows of every key; each map task sends at most ``n`` per key."""
    newest = Window.partitionBy(*(keys or ["symbol"])).orderBy(F.col(order).desc())
    return (df.withColumn("_rn", F.row_number().over(newest))
            .where(F.col("_rn") <= n).drop("_rn"))


def newest_n(df: DataFrame, symbol: str, n: int) -> DataFrame:
    return df.where(F.col("symbol") == symbol).orderBy(F.col("start_ms").desc()).limit(n)


def cross_section(bars: DataFrame, start_ms: int) -> DataFrame:
    """The whole market at one bar, biggest quote volume first."""
    return (bars.where(F.col("start_ms") == start_ms)
            .select("symbol", "close", "quote_volume", "trades_count")
            .orderBy(F.col("quote_volume").desc(), "symbol"))


def oi_cross_section(oi: DataFrame, start_ms: int) -> DataFrame:
    return (oi.where(F.col("start_ms") == start_ms)
            .select("symbol", "sum_open_interest").orderBy("symbol"))


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct().orderBy("symbol")


def sample_symbols(df: DataFrame, n: int) -> DataFrame:
    """Rows of the first ``n`` symbols in alphabetical order."""
    return df.join(symbols(df).limit(n), "symbol", "left_semi")


def rows_by_source(oi: DataFrame) -> DataFrame:
    return oi.groupBy("src_rank").agg(F.count("*").alias("n"), F.max("start_ms").alias("newest_ms"))


def span_by_symbol(df: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    inside = (F.col("start_ms") >= from_ms) & (F.col("start_ms") < to_ms)
    return df.where(inside).groupBy("symbol").agg(
        F.count("*").alias("n"), F.min("start_ms").alias("min_ms"),
        F.max("start_ms").alias("max_ms"))


def high_water_marks(df: DataFrame) -> DataFrame:
    """Newest row of a symbol, and newest calibrated one (rank 2 or 3)."""
    return df.groupBy("symbol").agg(
        F.max("start_ms").alias("mark_ms"),
        F.max(F.when(F.col("src_rank") >= S.RANK_HIST, F.col("start_ms"))).alias("calibrated_ms"))


def universe_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Symbols added to and removed from the universe."""
    before, after = old.select("symbol").distinct(), new.select("symbol").distinct()
    added = after.join(before, "symbol", "left_anti").withColumn("change", F.lit("added"))
    removed = before.join(after, "symbol", "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def key_grid(universe: DataFrame, intervals: list[str]) -> DataFrame:
    """Every (symbol, interval) key, repeated from each symbol row."""
    levels = F.array(*[F.lit(iv) for iv in intervals])
    return universe.select("symbol", F.explode(levels).alias("interval"))


def stream_plan(universe: DataFrame, intervals: list[str], shards: int) -> DataFrame:
    """Stream names with the shard each one belongs to, one row per stream."""
    grid = key_grid(universe.select("symbol").distinct(), intervals)
    bucket = fx.stable_bucket(F.col("symbol"), shards)
    return grid.select(
        F.concat(F.lit("kline_"), "interval", F.lit("_"), bucket.cast("string")).alias("shard"),
        fx.stream_name(F.col("symbol"), F.col("interval")).alias("stream"),
        "symbol", "interval", bucket.alias("bucket"))
