"""Merging history series and planning how far back each symbol must resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg


def merge_ratio_series(points: DataFrame, now_ms: int) -> DataFrame:
    """Three ratio series to one row per bar.

    ``points`` holds ``symbol, measure, label_ms, ratio``. A symbol's rows end at
    the newest label that every series reached; a series without that label
    inside leaves NULL; a symbol that lacks a whole series is held back.
    """
    newest = points.groupBy("symbol").agg(*[
        F.max(F.when(F.col("measure") == c, F.col("label_ms"))).alias(c) for c in S.RATIOS])
    bounds = (
        newest.where(F.col(S.RATIOS[0]).isNotNull() & F.col(S.RATIOS[1]).isNotNull()
                     & F.col(S.RATIOS[2]).isNotNull())
        .select("symbol", F.least(*S.RATIOS, F.lit(now_ms)).alias("_bound")))
    label = F.col("label_ms")
    usable = points.where(F.pmod(label, F.lit(tg.BAR_MS)) == 0)
    # pivot before the join: one row per bar instead of one per point
    wide = usable.groupBy("symbol", label).agg(*[
        F.max(F.when(F.col("measure") == c, F.col("ratio"))).alias(c) for c in S.RATIOS])
    return (
        wide.join(bounds, "symbol", "inner").where(label <= F.col("_bound"))
        .select("symbol", (label - tg.BAR_MS).alias("start_ms"), *S.RATIOS,
                label.alias("snap_ms"), F.lit(S.RANK_HIST).alias("src_rank"))
    )


def held_back(points: DataFrame) -> DataFrame:
    """Symbols for which some but not all series returned points."""
    return (points.groupBy("symbol").agg(F.count_distinct("measure").alias("series"))
            .where(F.col("series") < len(S.RATIOS)))


def resume_plan(universe: DataFrame, marks: DataFrame, now_ms: int, *, full: bool = False,
                cold_start_ms: int = 48 * tg.HOUR_MS, max_age_ms: int = 168 * tg.HOUR_MS,
                lag_ms: int = 4 * tg.MINUTE_MS, page_bars: int = 490) -> DataFrame:
    """Where each symbol's history fetch starts, biggest need first.

    No mark: the cold-start window. Mark at the newest published bar: skipped,
    unless ``full``. Otherwise from the mark, widened by a full pass to one page
    and never older than ``max_age_ms`` (``beyond_cap`` flags what that cuts).
    """
    floor_now = tg.floor_to(now_ms, tg.BAR_MS)
    target = tg.newest_published(now_ms, lag_ms)
    oldest = tg.floor_to(now_ms - max_age_ms, tg.BAR_MS)
    page_start = floor_now - max(page_bars, 1) * tg.BAR_MS
    mark = F.col("calibrated_ms")
    asked = F.coalesce(mark, F.lit(floor_now - cold_start_ms))
    widened = F.least(asked, F.lit(page_start)) if full else asked
    since = F.greatest(widened, F.lit(oldest))
    current = (mark >= target) if not full else F.lit(False)
    needed = tg.whole(F.lit(floor_now) - since, tg.BAR_MS)
    rows = universe.select("symbol").distinct().join(
        marks.select("symbol", "calibrated_ms"), "symbol", "left")
    skipped = F.coalesce(current, F.lit(False)) | (needed < 1)
    return rows.select(
        "symbol",
        mark.isNull().alias("fresh"),
        F.when(F.coalesce(current, F.lit(False)), "current").when(needed < 1, "nothing_due")
        .otherwise("fetch").alias("decision"),
        F.when(~skipped, since).alias("since_ms"),
        F.when(~skipped, needed).otherwise(0).alias("needed"),
        (~F.coalesce(current, F.lit(False)) & (asked < oldest)).alias("beyond_cap"),
    ).orderBy(F.col("needed").desc(), "symbol")


def resume_klines(universe: DataFrame, marks: DataFrame, until_ms: int, step: int, *,
                  cold_start_ms: int | None = None, since_ms: int | None = None,
                  window_bars: int = 200) -> DataFrame:
    """Fetch range per symbol for bars: the bar after the mark, else the anchor given."""
    if cold_start_ms is not None:
        anchor = cold_start_ms
    elif since_ms is not None:
        anchor = since_ms - step
    else:
        anchor = until_ms - window_bars * step
    start = F.coalesce(F.col("mark_ms") + step, F.lit(anchor))
    return (
        universe.select("symbol").distinct()
        .join(marks.select("symbol", "mark_ms"), "symbol", "left")
        .select("symbol", start.alias("from_ms"), F.lit(until_ms).alias("to_ms"))
        .where(F.col("to_ms") - F.col("from_ms") >= step)
    )
