"""Planning and repair jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import gaps, panel, ranges, series, versions, windows
from candlemill.plans import repair
from candlemill.sources import facts
from workload.base import (
    BAR, CTES, DAY, HOUR, MINUTE, NOW, SPAN_FROM, bars, bars_raw, fresh, gaps_5m, kline_events, oi, oi_off_grid,
    oi_raw, query, rollup_tables, table_and_rollups, table_and_rollups_sql, table_of, ticks, universe,
)
from workload.joins import repair_ranges

# contracts: one per symbol and user, so that marks differ
CTES["contract_marks"] = """
SELECT symbol || '_' || uid AS symbol, max(start_ms) AS calibrated_ms FROM (
  SELECT symbol, uid, t_ms - t_ms % 300000 AS start_ms FROM ticks) WHERE start_ms % 900000 <> 0 GROUP BY 1"""
CTES["contracts"] = "SELECT DISTINCT symbol || '_' || uid AS symbol FROM ticks"
_PLAN_NOW = SPAN_FROM + 30 * DAY + 450_000
_FLOOR = tg.floor_to(_PLAN_NOW, BAR)
_TARGET = tg.newest_published(_PLAN_NOW)
_OLDEST = tg.floor_to(_PLAN_NOW - 168 * HOUR, BAR)


def contract_rows(spark, sf):
    return ticks(spark, sf).select(
        F.concat_ws("_", "symbol", F.col("uid").cast("string")).alias("symbol"),
        tg.bucket(F.col("t_ms"), BAR).alias("start_ms"), F.lit(2).alias("src_rank"))


@query(f"""
WITH r AS (SELECT symbol, calibrated_ms, coalesce(calibrated_ms, {_FLOOR - 48 * HOUR}) AS asked,
                  coalesce(calibrated_ms >= {_TARGET}, FALSE) AS current
           FROM contracts LEFT JOIN contract_marks USING (symbol)),
p AS (SELECT *, greatest(asked, {_OLDEST}) AS since, ({_FLOOR} - greatest(asked, {_OLDEST})) // 300000 AS need FROM r)
SELECT symbol, calibrated_ms IS NULL AS fresh,
       CASE WHEN current THEN 'current' WHEN need < 1 THEN 'nothing_due' ELSE 'fetch' END AS decision,
       CASE WHEN NOT current AND need >= 1 THEN since END AS since_ms,
       CASE WHEN NOT current AND need >= 1 THEN need ELSE 0 END AS needed,
       NOT current AND asked < {_OLDEST} AS beyond_cap FROM p""")
def resume_plan(spark, sf):
    rows = contract_rows(spark, sf)
    marks = panel.high_water_marks(rows.where(F.col("start_ms") % 900_000 != 0))
    return series.resume_plan(rows.select("symbol"), marks, _PLAN_NOW)


@query(f"""
SELECT symbol, coalesce(calibrated_ms + 300000, {SPAN_FROM + 20 * DAY}) AS from_ms, CAST({_FLOOR} AS BIGINT) AS to_ms
FROM contracts LEFT JOIN contract_marks USING (symbol)
WHERE {_FLOOR} - coalesce(calibrated_ms + 300000, {SPAN_FROM + 20 * DAY}) >= 300000""")
def resume_klines(spark, sf):
    rows = contract_rows(spark, sf)
    marks = panel.high_water_marks(rows.where(F.col("start_ms") % 900_000 != 0))
    return series.resume_klines(rows.select("symbol"), marks, _FLOOR, BAR, cold_start_ms=SPAN_FROM + 20 * DAY)


# candidates: the landed answers hold two of three bars; the table holds the others
CTES["held_bars"] = "SELECT * FROM bars WHERE start_ms // 60000 % 5 <> 2"
CTES["offered_bars"] = "SELECT * FROM bars WHERE start_ms // 60000 % 3 <> 0"
CTES["repair_merged"] = f"""
SELECT symbol, min(from_ms) AS from_ms, max(to_ms) AS to_ms FROM (
  SELECT *, sum(opens) OVER (PARTITION BY symbol ORDER BY from_ms, to_ms ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, CASE WHEN from_ms <= max(to_ms) OVER (PARTITION BY symbol ORDER BY from_ms, to_ms
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
    FROM (SELECT symbol, from_ms, least(to_ms, {NOW}) AS to_ms FROM repair_ranges))) GROUP BY symbol, island"""


def _held(spark, sf):
    return bars(spark, sf).where((F.col("start_ms") / MINUTE) % 5 != 2)


def _offered(spark, sf):
    return bars(spark, sf).where((F.col("start_ms") / MINUTE) % 3 != 0)


@query("""SELECT DISTINCT o.symbol, o.start_ms, o.close FROM offered_bars o JOIN repair_ranges r
            ON o.symbol = r.symbol AND o.start_ms >= r.from_ms AND o.start_ms < r.to_ms
          WHERE (o.symbol, o.start_ms) NOT IN (SELECT (symbol, start_ms) FROM held_bars)""")
def repair_bars(spark, sf):
    rows = repair.repair_bars(repair_ranges(spark, sf), _held(spark, sf), _offered(spark, sf), NOW)
    return rows.select(*S.BAR_KEYS, "close")


@query("""
WITH w AS (SELECT symbol, unnest(generate_series(from_ms, to_ms - 60000, 60000)) AS start_ms FROM repair_merged),
j AS (SELECT w.symbol, h.symbol IS NOT NULL AS have, o.symbol IS NOT NULL AS offer FROM w
      LEFT JOIN held_bars h ON h.symbol = w.symbol AND h.start_ms = w.start_ms
      LEFT JOIN offered_bars o ON o.symbol = w.symbol AND o.start_ms = w.start_ms)
SELECT symbol, count(*) AS requested, count(*) FILTER (WHERE have) AS present,
       count(*) FILTER (WHERE NOT have AND offer) AS fetched, count(*) FILTER (WHERE NOT have AND NOT offer) AS empty
FROM j GROUP BY symbol""")
def repair_stats(spark, sf):
    return repair.repair_stats(repair_ranges(spark, sf), _held(spark, sf), _offered(spark, sf), NOW)


CTES["hist_points"] = """
SELECT symbol, start_ms + 300000 AS label_ms, sum_open_interest AS value FROM oi_raw WHERE ingest_seq % 4 <> 0"""


def hist_points(spark, sf):
    return oi_raw(spark, sf).where("ingest_seq % 4 <> 0").select(
        "symbol", (F.col("start_ms") + BAR).alias("label_ms"), F.col("sum_open_interest").alias("value"))


@query("""SELECT p.symbol, label_ms - 300000 AS start_ms, max(value) AS sum_open_interest, label_ms AS snap_ms,
                 CAST(2 AS INTEGER) AS src_rank
          FROM hist_points p JOIN oi o ON o.symbol = p.symbol AND o.start_ms = label_ms - 300000 AND o.src_rank = 1
          WHERE label_ms - 300000 >= """ + str(tg.floor_to(NOW - 20 * DAY, BAR) + BAR) + """
          GROUP BY p.symbol, label_ms""")
def replace_live(spark, sf):
    return repair.replace_live(oi_raw(spark, sf), hist_points(spark, sf), NOW, 20 * DAY)


@query("""SELECT p.symbol, label_ms - 300000 AS start_ms, max(value) AS sum_open_interest, label_ms AS snap_ms,
                 CAST(2 AS INTEGER) AS src_rank
          FROM hist_points p JOIN oi o ON o.symbol = p.symbol AND o.start_ms = label_ms - 300000 AND o.src_rank = 1
          GROUP BY p.symbol, label_ms""")
def replace_live_all(spark, sf):
    """The same from a stored table and a source that forgets nothing."""
    names = [f.name for f in S.OI_5M.fields]
    stored = facts.read_facts(spark, table_of(oi_raw(spark, sf).select(*names), "live-rows"), S.OI_5M)
    return repair.replace_live(stored, hist_points(spark, sf), NOW)


CTES["thin_oi"] = "SELECT * FROM oi_raw WHERE ingest_seq % 2 = 0"
CTES["oi_holes"] = """
SELECT symbol, prev + 300000 AS from_ms, start_ms AS to_ms FROM (
  SELECT symbol, start_ms, lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) AS prev
  FROM (SELECT DISTINCT symbol, start_ms FROM thin_oi)) WHERE start_ms - prev > 300000"""


@query("""SELECT p.symbol, label_ms - 300000 AS start_ms, max(value) AS sum_open_interest, label_ms AS snap_ms,
                 CAST(2 AS INTEGER) AS src_rank
          FROM hist_points p JOIN oi_holes h ON h.symbol = p.symbol AND label_ms - 300000 >= h.from_ms AND label_ms - 300000 < h.to_ms
          WHERE label_ms - 300000 >= """ + str(tg.floor_to(NOW - 20 * DAY, BAR) + BAR) + """
          GROUP BY p.symbol, label_ms""")
def repair_gap_oi(spark, sf):
    thin = oi_raw(spark, sf).where("ingest_seq % 2 = 0")
    holes = gaps.find_gaps(thin, BAR, on_grid=True)
    return repair.repair_gap_oi(holes, thin, hist_points(spark, sf), NOW, 20 * DAY)


@query("""SELECT p.symbol, label_ms - 300000 AS start_ms, max(value) AS sum_open_interest, label_ms AS snap_ms,
                 CAST(2 AS INTEGER) AS src_rank
          FROM hist_points p JOIN oi_holes h ON h.symbol = p.symbol AND label_ms - 300000 >= h.from_ms AND label_ms - 300000 < h.to_ms
          GROUP BY p.symbol, label_ms""")
def repair_gap_oi_all(spark, sf):
    """All holes of a stored table from a source that forgets nothing."""
    names = [f.name for f in S.OI_5M.fields]
    thin = facts.read_facts(spark, table_of(oi_raw(spark, sf).where("ingest_seq % 2 = 0").select(*names), "thin"), S.OI_5M)
    return repair.repair_gap_oi(gaps.find_gaps(thin, BAR, on_grid=True), thin, hist_points(spark, sf), NOW)


_OLD = SPAN_FROM + 12 * DAY + 7 * BAR


@query(f"""SELECT symbol, from_ms, to_ms, missing_count,
                  CASE WHEN to_ms > {_OLD} THEN greatest(from_ms, {_OLD}) END AS kept_from_ms,
                  CASE WHEN to_ms > {_OLD} THEN to_ms END AS kept_to_ms,
                  CASE WHEN to_ms <= {_OLD} THEN (to_ms - from_ms) // 300000
                       ELSE greatest(({_OLD} - from_ms) // 300000, 0) END AS dropped_bars FROM gaps_5m""")
def clip_ranges(spark, sf):
    return ranges.clip_ranges(gaps_5m(spark, sf), _OLD, BAR)


@query("""SELECT symbol, p AS from_ms, least(p + 1500000, to_ms) AS to_ms FROM (
            SELECT symbol, to_ms, unnest(generate_series(from_ms, to_ms - 1, 1500000)) AS p FROM gaps_5m)""")
def page_ranges(spark, sf):
    return ranges.page_ranges(gaps_5m(spark, sf).select("symbol", "from_ms", "to_ms"), BAR, 5)


@query(f"""SELECT symbol, from_ms, interval FROM gaps_5m
           CROSS JOIN (VALUES {', '.join(f"('{iv}', {d})" for iv, d in tg.KLINE_LOOKBACK_DAYS.items())}) l(interval, days)
           WHERE {NOW} - from_ms > days * 86400000""")
def stale_rollups(spark, sf):
    repaired = gaps_5m(spark, sf).select("symbol", F.col("from_ms").alias("start_ms"))
    return ranges.stale_rollups(repaired, NOW, tg.KLINE_LOOKBACK_DAYS).withColumnRenamed("start_ms", "from_ms")


# served live bars, one per contract: some fields lost, some prices inverted, some old
CTES["live_records"] = """
SELECT symbol || '_' || uid AS symbol, max(t_ms) AS t, arg_max(price, seq) - 20 AS o, uid FROM ticks GROUP BY 1, uid"""
CTES["live_fields"] = """
SELECT symbol, t, uid, o, o AS c, CASE WHEN uid % 11 = 0 THEN o - 0.5 ELSE o END AS h, CASE WHEN uid % 13 = 0 THEN o + 0.25 ELSE o END AS l,
       CASE WHEN uid % 17 = 0 THEN -1 ELSE 1 END AS v, CASE WHEN uid % 7 <> 0 THEN 2 END AS qv FROM live_records"""
CTES["live_notes"] = """
SELECT symbol, t, uid, CASE WHEN qv IS NULL THEN 'missing_qv' ELSE concat_ws(';',
         CASE WHEN o <= 0 OR h <= 0 OR l <= 0 OR c <= 0 THEN 'non_positive_price' END, CASE WHEN h < l THEN 'high_below_low' END,
         CASE WHEN h < o OR h < c THEN 'high_below_body' END, CASE WHEN l > o OR l > c THEN 'low_above_body' END,
         CASE WHEN v < 0 THEN 'negative_volume' END) END AS notes FROM live_fields"""
_LIVE_NOW = NOW - 2 * DAY


@query(f"""
SELECT symbol, CASE WHEN uid % 5 = 0 THEN 'MISSING' WHEN notes <> '' THEN 'CORRUPT' WHEN {_LIVE_NOW} - t < -10000 THEN 'WARN'
                    WHEN {_LIVE_NOW} - t > {2 * DAY} THEN 'STALE' ELSE 'PASS' END AS status,
       CASE WHEN uid % 5 = 0 THEN 'none' ELSE notes END AS notes FROM live_notes""")
def validate_live(spark, sf):
    """Served live bars of every contract: some absent, some with a field lost, crossed bounds, or values of the wrong sign."""
    contract = F.concat_ws("_", "symbol", F.col("uid").cast("string")).alias("symbol")
    latest = ticks(spark, sf).groupBy(contract, "uid").agg(
        F.max("t_ms").alias("t_ms"), (F.max_by("price", "seq") - 20).alias("p"))
    p, uid = F.col("p"), F.col("uid")
    price = p.cast("string")
    records = latest.where("uid % 5 <> 0").select(
        "symbol", F.col("t_ms").cast("string").alias("t"), price.alias("o"),
        F.when(uid % 11 == 0, (p - 0.5).cast("string")).otherwise(price).alias("h"),
        F.when(uid % 13 == 0, (p + 0.25).cast("string")).otherwise(price).alias("l"), price.alias("c"),
        F.when(uid % 17 == 0, "-1").otherwise("1").alias("v"),
        F.when(uid % 7 != 0, F.lit("2")).alias("qv"), F.lit("0").alias("tbv"), F.lit("0").alias("tbqv"),
        F.lit("3").alias("n"), F.lit("1").alias("x"))
    rows = windows.validate_live(records, latest.select("symbol"), DAY, _LIVE_NOW)
    return rows.select("symbol", "status", F.coalesce("notes", F.lit("none")).alias("notes"))


CTES["grid_repaired"] = """
SELECT p.symbol, new_start AS start_ms, value AS sum_open_interest, new_start + 300000 AS snap_ms, CAST(3 AS INTEGER) AS src_rank, o.ingest_seq
FROM snap_plans p JOIN oi_best_off o ON o.symbol = p.symbol AND o.start_ms = p.old_start WHERE action = 'move'
UNION ALL SELECT symbol, start_ms, sum_open_interest, snap_ms, src_rank, ingest_seq FROM oi WHERE start_ms // 300000 % 2 = 1"""
CTES["oi_best_off"] = "SELECT symbol, start_ms, max(ingest_seq) AS ingest_seq FROM oi_off GROUP BY 1, 2"


@query(table_and_rollups_sql("grid_repaired"))
def off_grid_repair(spark, sf):
    """Off-grid rows of a table snapped or dropped in place, its rollups folded anew; a second run moves nothing."""
    names = [f.name for f in S.OI_5M.fields]
    grid = oi(spark, sf).where((F.col("start_ms") / BAR) % 2 == 1).select(*names)
    raw = grid.unionByName(oi_off_grid(spark, sf).select(*names))
    path, log, levels = table_of(raw, "offgrid"), fresh(spark, "offgrid-log"), rollup_tables(raw, "offgrid")
    for k in range(2):
        repair.repair_off_grid(spark, path, log, NOW + k, levels)
    return table_and_rollups(spark, path, levels)


_SWEEP_DAYS = 12
CTES["sweep_gaps"] = f"""
SELECT symbol, prev + 60000 AS from_ms, start_ms AS to_ms FROM (
  SELECT symbol, start_ms, lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) AS prev FROM held_bars
  WHERE start_ms >= {NOW - 180_000 - _SWEEP_DAYS * DAY} AND start_ms < {NOW - 180_000}) WHERE start_ms - prev > 60000"""


@query("""
WITH n AS (SELECT g.symbol, g.from_ms, count(*) AS fetched FROM sweep_gaps g JOIN offered_bars o
             ON o.symbol = g.symbol AND o.start_ms >= g.from_ms AND o.start_ms < g.to_ms
           WHERE (o.symbol, o.start_ms) NOT IN (SELECT (symbol, start_ms) FROM held_bars) GROUP BY 1, 2)
SELECT g.symbol, g.from_ms, g.to_ms, coalesce(fetched, 0) AS fetched,
       CASE WHEN fetched IS NULL THEN 'empty' ELSE 'repaired' END AS outcome
FROM sweep_gaps g LEFT JOIN n ON n.symbol = g.symbol AND n.from_ms = g.from_ms""")
def sweep(spark, sf):
    """One sweep over the last twelve days with room for every hole it finds."""
    none = spark.createDataFrame([], "symbol string, from_ms long, expires_ms long")
    _, outcome, _ = repair.sweep(_held(spark, sf), _offered(spark, sf), none, NOW,
                                 window_ms=_SWEEP_DAYS * DAY)
    return outcome.select("symbol", "from_ms", "to_ms", "fetched", "outcome")


# half of the holes were found empty before
CTES["sweep_told"] = f"""
SELECT g.symbol, g.from_ms, g.from_ms // 60000 % 2 = 0 AS skipped, EXISTS (
         SELECT 1 FROM offered_bars o WHERE o.symbol = g.symbol AND o.start_ms >= g.from_ms AND o.start_ms < g.to_ms
           AND (o.symbol, o.start_ms) NOT IN (SELECT (symbol, start_ms) FROM held_bars)) AS hit FROM sweep_gaps g"""


@query("""SELECT symbol, count(*) AS found, count(*) FILTER (WHERE skipped) AS skipped, count(*) FILTER (WHERE NOT skipped) AS submitted,
                 count(*) FILTER (WHERE NOT skipped AND hit) AS repaired, count(*) FILTER (WHERE NOT skipped AND NOT hit) AS empty,
                 CAST(0 AS BIGINT) AS failed FROM sweep_told GROUP BY symbol""")
def sweep_stats(spark, sf):
    held, days = _held(spark, sf), {"window_ms": _SWEEP_DAYS * DAY}
    holes = gaps.find_gaps(held, 60_000, *tg.sweep_window(NOW, 180_000, _SWEEP_DAYS * DAY, 60_000))
    known = holes.where("from_ms div 60000 % 2 = 0").select("symbol", "from_ms", F.lit(NOW + 1).alias("expires_ms"))
    _, outcome, _ = repair.sweep(held, _offered(spark, sf), known, NOW, **days)
    return repair.sweep_stats(held, known, outcome, NOW, **days)


# a second sweep finds what the first one left; its holes have new borders, or were found empty and are remembered
CTES["sweep_first"] = """
SELECT g.symbol, g.from_ms, g.to_ms, (SELECT count(*) FROM offered_bars o WHERE o.symbol = g.symbol AND o.start_ms >= g.from_ms AND o.start_ms < g.to_ms
  AND (o.symbol, o.start_ms) NOT IN (SELECT (symbol, start_ms) FROM held_bars)) AS fetched FROM sweep_gaps g"""
CTES["sweep_filled"] = f"""
SELECT symbol, start_ms FROM held_bars UNION SELECT o.symbol, o.start_ms FROM offered_bars o JOIN sweep_gaps g
ON o.symbol = g.symbol AND o.start_ms >= g.from_ms AND o.start_ms < g.to_ms"""
CTES["sweep_second"] = f"""
SELECT symbol, prev + 60000 AS from_ms, start_ms AS to_ms FROM (
  SELECT symbol, start_ms, lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) AS prev FROM sweep_filled
  WHERE start_ms >= {NOW - 180_000 - _SWEEP_DAYS * DAY} AND start_ms < {NOW - 180_000}) WHERE start_ms - prev > 60000
AND (symbol, prev + 60000) NOT IN (SELECT (symbol, from_ms) FROM sweep_first WHERE fetched = 0)"""


@query("""SELECT CAST(1 AS INTEGER) AS run, symbol, from_ms, to_ms, fetched, CASE WHEN fetched = 0 THEN 'empty' ELSE 'repaired' END AS outcome FROM sweep_first
          UNION ALL SELECT 2, symbol, from_ms, to_ms, 0, 'empty' FROM sweep_second""")
def sweep_job(spark, sf):
    """Two sweeps in a row over a written table; the second asks for nothing that the first found empty."""
    names = [f.name for f in S.BARS_1M.fields]
    path, memory, log = table_of(_held(spark, sf).select(*names), "swept"), fresh(spark, "swept-memory"), fresh(spark, "swept-log")
    offered = facts.read_facts(spark, table_of(_offered(spark, sf).select(*names), "offered"), S.BARS_1M)
    out = None
    for run in (1, 2):
        told = repair.sweep_job(spark, path, offered, memory, log, NOW + run - 1, window_ms=_SWEEP_DAYS * DAY)
        told = told.select(F.lit(run).alias("run"), "symbol", "from_ms", "to_ms", "fetched", "outcome")
        out = told if out is None else out.unionByName(told)
    return out


_OLDEST = tg.floor_to(NOW - 20 * DAY, BAR) + BAR
CTES["oi_wanted"] = f"""
SELECT w.symbol, w.t, w.t < {_OLDEST} AS gone, EXISTS (SELECT 1 FROM hist_points p WHERE p.symbol = w.symbol AND p.label_ms = w.t + 300000) AS hit
FROM (SELECT symbol, unnest(range(from_ms, least(to_ms, {NOW - NOW % BAR}), 300000)) AS t FROM oi_holes) w"""
CTES["oi_live"] = f"""
SELECT b.symbol, b.start_ms >= {_OLDEST} AND EXISTS (
         SELECT 1 FROM hist_points p WHERE p.symbol = b.symbol AND p.label_ms = b.start_ms + 300000) AS replaced
FROM (SELECT symbol, start_ms, src_rank FROM thin_oi QUALIFY row_number() OVER (
        PARTITION BY symbol, start_ms ORDER BY src_rank DESC, ingest_seq DESC) = 1) b WHERE src_rank = 1"""


@query("""SELECT symbol, coalesce(requested, 0) AS requested, coalesce(beyond_retention, 0) AS beyond_retention, CAST(0 AS BIGINT) AS present,
                 coalesce(fetched, 0) AS fetched, coalesce(not_at_source, 0) AS not_at_source, coalesce(live_rows, 0) AS live_rows,
                 coalesce(live_replaced, 0) AS live_replaced
          FROM (SELECT symbol, count(*) AS requested, count(*) FILTER (WHERE gone) AS beyond_retention,
                       count(*) FILTER (WHERE NOT gone AND hit) AS fetched, count(*) FILTER (WHERE NOT gone AND NOT hit) AS not_at_source
                FROM oi_wanted GROUP BY symbol)
          FULL JOIN (SELECT symbol, count(*) AS live_rows, count(*) FILTER (WHERE replaced) AS live_replaced FROM oi_live GROUP BY symbol) USING (symbol)""")
def oi_repair_stats(spark, sf):
    """What a source that remembers twenty days can still give."""
    thin = oi_raw(spark, sf).where("ingest_seq % 2 = 0")
    holes = gaps.find_gaps(thin, BAR, on_grid=True)
    return repair.oi_repair_stats(holes, thin, hist_points(spark, sf), NOW, 20 * DAY)
