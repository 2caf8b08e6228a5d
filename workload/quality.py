"""Counters, verdicts, coverage and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import filters, gaps, panel, quality, rollup, snap
from candlemill.plans import reports
from workload.base import (
    BAR, CTES, DAY, HOUR, MEASURES, NOW, SPAN_FROM, bars, bars_at, gaps_sql, kline_events, oi, oi_off_grid,
    oi_raw, query, ratios, rounded, universe,
)

LO, HI = SPAN_FROM, NOW - BAR
STALE = HI - 2 * HOUR


def _damaged(spark, sf):
    """1m bars with a few broken rows per rule."""
    slot = F.col("start_ms") / 60_000
    return bars(spark, sf).withColumns({
        "low": F.when(slot % 97 == 0, F.col("high") + 1).otherwise(F.col("low")),
        "volume": F.when(slot % 101 == 0, -1.0).otherwise(F.col("volume")),
        "trades_count": F.when(slot % 103 == 0, 0).otherwise(F.col("trades_count")),
        "end_ms": F.when(slot % 107 == 0, F.col("start_ms")).otherwise(F.col("end_ms"))})


CTES["damaged"] = """
SELECT symbol, start_ms, CASE WHEN start_ms // 60000 % 107 = 0 THEN start_ms ELSE end_ms END AS end_ms, open, high,
       CASE WHEN start_ms // 60000 % 97 = 0 THEN high + 1 ELSE low END AS low, close,
       CASE WHEN start_ms // 60000 % 101 = 0 THEN -1.0 ELSE volume END AS volume, quote_volume,
       CASE WHEN start_ms // 60000 % 103 = 0 THEN 0 ELSE trades_count END AS trades_count FROM bars"""
# what a bar breaks, from the rules' text
_BAR_BREACHES = {
    "sign_price": "least(open, high, low, close) <= 0",
    "sign_volume": "least(volume, quote_volume) < 0",
    "bounds_price": "high < greatest(low, open, close) OR low > least(open, close)",
    "clock_span": "end_ms - start_ms < 1",
    "idle": "trades_count = 0",
}
_GRAVE = " + ".join(name for name in _BAR_BREACHES if name != "idle")


def _filtered(rules: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in rules.items())


CTES["bar_counts"] = f"""
SELECT symbol, count(*) AS total_bars, min(start_ms) AS min_ms, max(start_ms) AS max_ms, {_filtered(_BAR_BREACHES)},
       (max(start_ms) - min(start_ms)) // 60000 + 1 AS expected_bars,
       round(count(*) / ((max(start_ms) - min(start_ms)) // 60000 + 1), 9) AS coverage
FROM damaged GROUP BY symbol"""
CTES["gaps_1m"] = gaps_sql("damaged", 60_000)


@query("SELECT * FROM bar_counts")
def bar_quality(spark, sf):
    return rounded(quality.bar_quality(_damaged(spark, sf), 60_000), "coverage", digits=9)


@query(f"""SELECT symbol, total_bars, gap_count, missing_bars,
                 CASE WHEN gap_count > 0 OR {_GRAVE} > 0
                      THEN 'FAIL' WHEN idle > 0 THEN 'WARN' ELSE 'PASS' END AS status
          FROM (SELECT symbol, total_bars, coalesce(gap_count, 0) AS gap_count,
                       CAST(coalesce(missing_bars, 0) AS BIGINT) AS missing_bars, {", ".join(_BAR_BREACHES)}
                FROM bar_counts LEFT JOIN (SELECT symbol, count(*) AS gap_count, sum(missing_count) AS missing_bars
                                           FROM gaps_1m GROUP BY symbol) USING (symbol))""")
def bar_verdict(spark, sf):
    report = reports.kline_report(_damaged(spark, sf), "1m", universe(spark, sf))
    return report["verdict"].select("symbol", "total_bars", "gap_count", "missing_bars", "status")


_OI_COUNTERS = {
    "sign_value": "NOT isfinite(sum_open_interest) OR sum_open_interest < 0",
    "sign_zero": "sum_open_interest = 0",
    "source_unknown": "src_rank NOT BETWEEN 1 AND 3",
    "clock_calibrated": "src_rank > 1 AND snap_ms <> start_ms + 300000",
    "clock_live": "src_rank = 1 AND abs(snap_ms - start_ms - 300000) > 60000",
    "clock_waiting": f"src_rank = 1 AND start_ms < {STALE}",
    "grid_start": "start_ms % 300000 <> 0",
    **{f"from_{name}": f"src_rank = {rank}" for rank, name in enumerate(("live", "history", "archive"), 1)},
}
CTES["oi_counts"] = f"""
SELECT symbol, count(*) AS n, min(start_ms) AS min_ms, max(start_ms) AS max_ms, {_filtered(_OI_COUNTERS)}
FROM oi_mixed WHERE start_ms BETWEEN {LO} AND {HI} GROUP BY symbol"""
CTES["oi_mixed"] = """
SELECT symbol, start_ms, sum_open_interest, snap_ms, src_rank, ingest_seq FROM oi
UNION ALL SELECT symbol, start_ms, sum_open_interest, snap_ms, src_rank, ingest_seq FROM oi_off"""


def _mixed(spark, sf):
    """Snapshots together with the off-grid archive rows."""
    return oi(spark, sf).select(*[f.name for f in S.OI_5M.fields]).unionByName(oi_off_grid(spark, sf))


@query("SELECT * FROM oi_counts")
def oi_stats(spark, sf):
    return quality.oi_stats(_mixed(spark, sf), LO, HI)


CTES["oi_verdicts"] = f"""
SELECT symbol, missing, lag_bars, expected,
       CASE WHEN missing > 0 OR grid_start > 0 OR sign_value > 0 OR clock_calibrated > 0 OR source_unknown > 0 OR lag_bars > 2 THEN 'FAIL'
            WHEN clock_live > 0 OR sign_zero > 0 OR min_ms > {LO} + 300000 OR clock_waiting > 0 THEN 'WARN'
            ELSE 'PASS' END AS status,
       concat_ws(';', CASE WHEN missing > 0 THEN 'missing_bars=' || missing END,
                 CASE WHEN grid_start > 0 THEN 'off_grid_rows=' || grid_start END,
                 CASE WHEN sign_value > 0 THEN 'bad_values=' || sign_value END,
                 CASE WHEN clock_calibrated > 0 THEN 'calibrated_snap_mismatch=' || clock_calibrated END,
                 CASE WHEN source_unknown > 0 THEN 'bad_ranks=' || source_unknown END,
                 CASE WHEN lag_bars > 2 THEN 'bars_behind=' || lag_bars END) AS fails,
       concat_ws(';', CASE WHEN clock_live > 0 THEN 'live_snap_far=' || clock_live END,
                 CASE WHEN sign_zero > 0 THEN 'zero_values=' || sign_zero END,
                 CASE WHEN min_ms > {LO} + 300000 THEN 'starts_late=' || (min_ms - {LO}) // 300000 END,
                 CASE WHEN clock_waiting > 0 THEN 'uncalibrated_live=' || clock_waiting END) AS warns
FROM (SELECT *, greatest(expected - (n - grid_start), 0) AS missing FROM (
        SELECT *, (max_ms - min_ms) // 300000 + 1 AS expected,
               greatest(({HI} - max_ms) // 300000, 0) AS lag_bars FROM oi_counts))"""


def _oi_verdicts(spark, sf):
    return quality.oi_verdict(quality.oi_stats(_mixed(spark, sf), LO, HI), LO, HI)


@query("SELECT * FROM oi_verdicts")
def oi_verdict(spark, sf):
    return _oi_verdicts(spark, sf).select(
        "symbol", "missing", "lag_bars", "expected", "status",
        F.array_join("fails", ";").alias("fails"), F.array_join("warns", ";").alias("warns"))


@query("SELECT status, count(*) AS symbols FROM oi_verdicts GROUP BY status")
def status_tally(spark, sf):
    return quality.status_tally(_oi_verdicts(spark, sf))


@query(f"""SELECT *, CASE WHEN newest_ms IS NOT NULL THEN greatest(({HI} - newest_ms) // 300000, 0) END AS lag_bars,
                  CASE WHEN newest_cal_ms IS NOT NULL THEN greatest(({HI} - newest_cal_ms) // 300000, 0) END AS lag_cal_bars
           FROM (SELECT max(start_ms) AS newest_ms, max(start_ms) FILTER (WHERE src_rank >= 2) AS newest_cal_ms,
                        count(*) AS total FROM oi_raw)""")
def freshness(spark, sf):
    return quality.freshness(oi_raw(spark, sf), HI)


@query("""SELECT symbol, max(start_ms) AS mark_ms, max(start_ms) FILTER (WHERE src_rank >= 2) AS calibrated_ms
          FROM oi_raw GROUP BY symbol""")
def high_water(spark, sf):
    return panel.high_water_marks(oi_raw(spark, sf))


def _hist_oi(spark, sf):
    """Snapshots without live-only bars, so that coverage has holes."""
    return oi(spark, sf).where(F.col("src_rank") >= 2)


def _coverage_sql(by: str, minimum: float) -> str:
    return f"""
SELECT {by}, bars, with_oi, round(with_oi / bars, 9) AS share,
       CASE WHEN with_oi / bars >= {minimum} THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT b.{by} AS {by}, count(*) AS bars, count(o.symbol) AS with_oi
      FROM bars_5m b LEFT JOIN (SELECT symbol, start_ms FROM oi WHERE src_rank >= 2) o
        ON o.symbol = b.symbol AND o.start_ms = b.start_ms GROUP BY b.{by})"""


CTES["coverage_bars"] = _coverage_sql("start_ms", 0.99)


@query(_coverage_sql("symbol", 0.995))
def coverage_symbol(spark, sf):
    rows = quality.coverage(bars_at(spark, sf, "5m"), _hist_oi(spark, sf), "symbol", 0.995)
    return rounded(rows, "share", digits=9)


@query("SELECT * FROM coverage_bars")
def coverage_bar(spark, sf):
    rows = quality.coverage(bars_at(spark, sf, "5m"), _hist_oi(spark, sf), "start_ms", 0.99)
    return rounded(rows, "share", digits=9)


@query("SELECT * FROM coverage_bars ORDER BY share, start_ms LIMIT 10")
def worst_coverage(spark, sf):
    rows = quality.coverage(bars_at(spark, sf, "5m"), _hist_oi(spark, sf), "start_ms", 0.99)
    return rounded(quality.worst_first(rows, "start_ms", 10), "share", digits=9)


@query("SELECT src_rank, count(*) AS n, max(start_ms) AS newest_ms FROM oi GROUP BY src_rank")
def rows_by_source(spark, sf):
    return panel.rows_by_source(oi(spark, sf))


@query(f"""SELECT symbol, count(*) AS n, min(start_ms) AS min_ms, max(start_ms) AS max_ms FROM bars
           WHERE start_ms >= {NOW - 7 * DAY} AND start_ms < {NOW} GROUP BY symbol""")
def span_by_symbol(spark, sf):
    return panel.span_by_symbol(bars(spark, sf), NOW - 7 * DAY, NOW)


_LEVELS = ["15m", "1h", "4h", "1d"]


@query(" UNION ALL ".join(
    f"""SELECT '{iv}' AS level, (SELECT count(*) FROM oi) AS raw_rows,
               (SELECT CAST(sum(samples) AS BIGINT) FROM oi_{iv}) AS level_rows,
               (SELECT count(*) FROM oi) = (SELECT sum(samples) FROM oi_{iv}) AS ok""" for iv in _LEVELS))
def conservation(spark, sf):
    base = oi(spark, sf)
    return quality.conservation(base, {iv: rollup.rollup_oi(base, iv) for iv in _LEVELS})


@query("""
WITH hist AS (SELECT symbol, start_ms, arg_max(sum_open_interest, ingest_seq) AS hist FROM oi_raw WHERE src_rank = 2 GROUP BY 1, 2),
live AS (SELECT symbol, start_ms, arg_max(sum_open_interest, ingest_seq) AS live FROM oi_raw WHERE src_rank = 1 GROUP BY 1, 2),
pairs AS (SELECT hist, live, CASE WHEN hist > 0 THEN abs(live - hist) / hist END AS d
          FROM hist LEFT JOIN live USING (symbol, start_ms))
SELECT count(*) AS hist_bars, count(*) FILTER (WHERE live IS NULL) AS live_missed, count(d) AS compared,
       round(avg(d), 9) AS mean_diff, round(max(d), 9) AS max_diff, """ + ", ".join(
    f"count(*) FILTER (WHERE d <= {b}) AS le_{i}" for i, b in enumerate(quality.DIFF_BOUNDS)) + " FROM pairs")
def live_hist_diff(spark, sf):
    return rounded(quality.live_vs_hist(oi_raw(spark, sf)), "mean_diff", "max_diff", digits=9)


_TARGET = tg.newest_published(NOW) - 8 * BAR


@query(f"""SELECT count(*) AS symbols, count(*) FILTER (WHERE calibrated_ms >= {_TARGET}) AS current,
                  round(count(*) FILTER (WHERE calibrated_ms >= {_TARGET}) / count(*), 9) AS completeness
           FROM universe LEFT JOIN (SELECT symbol, max(start_ms) FILTER (WHERE src_rank >= 2) AS calibrated_ms
                                    FROM oi_raw GROUP BY symbol) USING (symbol)""")
def completeness(spark, sf):
    marks = panel.high_water_marks(oi_raw(spark, sf))
    return rounded(quality.completeness(universe(spark, sf), marks, _TARGET), "completeness", digits=9)


@query("SELECT DISTINCT symbol FROM bars")
def symbols(spark, sf):
    return panel.symbols(bars(spark, sf))


CTES["snap_plans"] = """
SELECT symbol, old_start, new_start, value, dist_ms,
       CASE WHEN (symbol, new_start) IN (SELECT (symbol, start_ms) FROM oi_taken) THEN 'drop_slot_taken'
            WHEN rn > 1 THEN 'drop_collision' ELSE 'move' END AS action
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, new_start ORDER BY dist_ms, old_start) AS rn
      FROM (SELECT symbol, start_ms AS old_start, (start_ms + 150000) - (start_ms + 150000) % 300000 AS new_start,
                   sum_open_interest AS value,
                   abs(start_ms - ((start_ms + 150000) - (start_ms + 150000) % 300000)) AS dist_ms FROM oi_off))"""
# of the on-grid rows only those of odd slots exist, so every action occurs
CTES["oi_taken"] = "SELECT DISTINCT symbol, start_ms FROM oi WHERE start_ms // 300000 % 2 = 1"


def snap_plan_of(spark, sf):
    table = oi(spark, sf).where((F.col("start_ms") / BAR) % 2 == 1)
    return snap.snap_plan(oi_off_grid(spark, sf), table)


@query("SELECT action, count(*) AS rows, max(dist_ms) / 1000 AS max_offset_s FROM snap_plans GROUP BY action")
def snap_summary(spark, sf):
    return snap.snap_summary(snap_plan_of(spark, sf))


@query("SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in MEASURES) + " FROM ratios")
def null_cells(spark, sf):
    return quality.null_cells(ratios(spark, sf), MEASURES)


@query("""
WITH f AS (SELECT CASE WHEN newest_ms IS NULL THEN 'FAIL' ELSE 'PASS' END AS status
           FROM (SELECT max(start_ms) AS newest_ms FROM oi_raw)),
checks AS (
  SELECT 'bars' AS "check", TRUE AS critical, count(*) AS subjects,
         count(*) FILTER (WHERE bad) AS failed, count(*) FILTER (WHERE NOT bad AND idle > 0) AS warned
  FROM (SELECT b.symbol, idle, g.symbol IS NOT NULL OR """ + _GRAVE + """ > 0 AS bad
        FROM bar_counts b LEFT JOIN (SELECT DISTINCT symbol FROM gaps_1m) g ON g.symbol = b.symbol)
  UNION ALL
  SELECT 'events', FALSE, count(*), count(*) FILTER (WHERE status = 'FAIL'), 0 FROM f
  UNION ALL
  SELECT 'open_interest', TRUE, count(*), count(*) FILTER (WHERE status = 'FAIL'), count(*) FILTER (WHERE status = 'WARN')
  FROM oi_verdicts),
graded AS (SELECT *, CASE WHEN (failed > 0 OR subjects = 0) AND critical THEN 'FAIL'
                          WHEN failed > 0 OR subjects = 0 OR warned > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM checks)
SELECT * FROM graded
UNION ALL SELECT 'overall', TRUE, CAST(sum(subjects) AS BIGINT), CAST(sum(failed) AS BIGINT), CAST(sum(warned) AS BIGINT),
                 CASE WHEN bool_and(status <> 'FAIL') THEN 'PASS' ELSE 'FAIL' END FROM graded""")
def scorecard(spark, sf):
    bars_report = reports.kline_report(_damaged(spark, sf), "1m")
    seen = quality.freshness(oi_raw(spark, sf), HI).select(
        F.when(F.col("newest_ms").isNull(), "FAIL").otherwise("PASS").alias("status"))
    return quality.scorecard({
        "bars": (bars_report["verdict"], True), "events": (seen, False),
        "open_interest": (_oi_verdicts(spark, sf), True)})


@query("""SELECT start_ms, count(DISTINCT symbol) AS snapshotted, (SELECT count(*) FROM universe) AS universe_size,
                 round(count(DISTINCT symbol) / (SELECT count(*) FROM universe), 9) AS completeness
          FROM oi_raw WHERE src_rank = 1 GROUP BY start_ms""")
def round_completeness(spark, sf):
    rows = quality.round_completeness(oi_raw(spark, sf), universe(spark, sf))
    return rounded(rows, "completeness", digits=9)


@query("""SELECT interval, CASE WHEN is_final THEN 'closed' ELSE 'live' END AS kind, count(*) AS events
          FROM kline_events GROUP BY 1, 2""")
def stream_counts(spark, sf):
    return quality.stream_counts(kline_events(spark, sf))


@query(f"""
WITH w AS (SELECT symbol, start_ms, src_rank FROM oi WHERE start_ms >= {NOW - 20 * DAY} AND start_ms <= {HI}),
k AS (SELECT symbol, start_ms FROM bars_5m WHERE start_ms >= {NOW - 20 * DAY} AND start_ms <= {HI}),
cov AS (SELECT k.symbol, count(*) AS bars, count(w.symbol) AS hit FROM k LEFT JOIN w USING (symbol, start_ms) GROUP BY 1),
gap AS (SELECT symbol, count(*) AS gaps, sum((start_ms - prev) // 300000 - 1) AS missing
        FROM (SELECT symbol, start_ms, lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) AS prev FROM w)
        WHERE start_ms - prev > 300000 GROUP BY 1)
SELECT symbol, bars, hit AS with_oi, coalesce(gaps, 0) AS gaps, CAST(coalesce(missing, 0) AS BIGINT) AS missing,
       n AS oi_rows FROM cov LEFT JOIN gap USING (symbol) JOIN (SELECT symbol, count(*) AS n FROM w GROUP BY 1) USING (symbol)""")
def oi_report(spark, sf):
    """Sections of the snapshot report over twenty days, joined per symbol."""
    report = reports.oi_report(oi(spark, sf), bars_at(spark, sf, "5m"), NOW, settle_minutes=0.0,
                               start_ms=NOW - 20 * DAY)
    holes = gaps.gap_totals(report["gaps"]).select(
        "symbol", F.col("gap_count").alias("gaps"), F.col("missing_bars").alias("missing"))
    return (report["by_symbol"].select("symbol", "bars", "with_oi")
            .join(holes, "symbol", "left").fillna(0, ["gaps", "missing"])
            .join(report["series"].select("symbol", F.col("n").alias("oi_rows")), "symbol"))


@query("""SELECT symbol, gap_count, missing_bars, expected_bars FROM (
            SELECT symbol, count(*) AS gap_count, CAST(sum(missing_count) AS BIGINT) AS missing_bars
            FROM (""" + gaps_sql("bars_1h", HOUR) + """) GROUP BY symbol)
          RIGHT JOIN (SELECT symbol, (max(start_ms) - min(start_ms)) // 3600000 + 1 AS expected_bars FROM bars_1h GROUP BY 1)
          USING (symbol)""")
def kline_report(spark, sf):
    """Gaps and expected bars of the 1h level."""
    rows = reports.kline_report(bars_at(spark, sf, "1h"), "1h")["verdict"]
    blank = F.col("gap_count") == 0
    return rows.select("symbol", F.when(~blank, F.col("gap_count")).alias("gap_count"),
                       F.when(~blank, F.col("missing_bars")).alias("missing_bars"), "expected_bars")
