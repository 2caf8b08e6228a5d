"""Whole-table reports: the frames a reader of the checkers' output needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import gaps, quality, reconcile


def kline_report(bars: DataFrame, interval: str, universe: DataFrame | None = None
                 ) -> dict[str, DataFrame]:
    """Quality counters, gaps and the verdict of one bar table."""
    step = tg.interval_ms(interval)
    holes = gaps.find_gaps(bars, step)
    counters = quality.bar_quality(bars, step)
    verdict = quality.bar_verdict(counters, gaps.gap_totals(holes), universe)
    return {"gaps": gaps.gap_report_rows(holes, interval), "verdict": verdict,
            "tally": quality.status_tally(verdict)}


def oi_report(oi: DataFrame, bars: DataFrame, now_ms: int, *, hours: float = 24.0,
              settle_minutes: float = 10.0, start_ms: int | None = None,
              min_coverage: float = 0.995, min_cross_section: float = 0.99,
              labels: DataFrame | None = None, tail: bool = False) -> dict[str, DataFrame]:
    """The sections of the open-interest check, each one a frame.

    ``series`` verdict per symbol, ``freshness``, coverage ``by_symbol`` and
    ``by_bar``, ``gaps`` (with the trailing holes on request) and, given history
    labels, ``labels``.
    """
    lo, hi = tg.settled_window(now_ms, hours, settle_minutes)
    if start_ms is not None:
        lo = start_ms
    inside = oi.where((F.col("start_ms") >= lo) & (F.col("start_ms") <= hi))
    kl = bars.where((F.col("start_ms") >= lo) & (F.col("start_ms") <= hi))
    # an off-grid row is no bar: the bar it stands for counts as missing
    holes = gaps.find_gaps(inside, tg.BAR_MS, on_grid=True)
    if tail:
        holes = holes.unionByName(gaps.tail_gaps(inside, hi, tg.BAR_MS))
    report = {
        "series": quality.oi_verdict(quality.oi_stats(oi, lo, hi), lo, hi),
        "freshness": quality.freshness(oi, hi),
        "by_symbol": quality.coverage(kl, inside, "symbol", min_coverage),
        "by_bar": quality.coverage(kl, inside, "start_ms", min_cross_section),
        "gaps": gaps.gap_report_rows(holes, "5m"),
    }
    if labels is not None:
        report["labels"] = reconcile.compare_labels(
            oi.select(*S.BAR_KEYS, "sum_open_interest", "src_rank"), labels, lo, hi)
    return report


def report_outcome(report: dict[str, DataFrame], max_lag_bars: int = 2) -> DataFrame:
    """One PASS/WARN/FAIL row per section of an open-interest report."""
    fresh = report["freshness"].select(
        F.when((F.col("total") == 0) | (F.col("lag_bars") > max_lag_bars), "FAIL")
        .when(F.col("newest_cal_ms").isNull() | (F.col("lag_cal_bars") > 24), "WARN")
        .otherwise("PASS").alias("status"))
    sections = {name: (report[name], True) for name in ("series", "by_symbol", "by_bar")}
    if "labels" in report:
        sections["labels"] = (report["labels"], True)
    return quality.scorecard({"freshness": (fresh, True), **sections})
