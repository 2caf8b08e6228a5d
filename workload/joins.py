"""Joins, reconciliation, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.functions import columns as fx
from candlemill.operators import panel, ranges, reconcile, series, snap, windows
from workload.base import (
    crc_sql, BAR, CTES, DAY, HOUR, MEASURES, MINUTE, NOW, SPAN_FROM, bars, bars_at, external_1h, oi, oi_off_grid, oi_raw,
    query, ratio_raw, ratios, round_sql, rounded, ticks, universe,
)
from workload.quality import snap_plan_of
from workload.series import wanted_ranges

_ROW = f"b.symbol, b.start_ms, b.close, {round_sql('volume')}"


@query(f"""SELECT {_ROW}, o.sum_open_interest FROM bars_5m b
           LEFT JOIN (SELECT symbol, start_ms, sum_open_interest FROM oi WHERE src_rank >= 2) o
             ON o.symbol = b.symbol AND o.start_ms = b.start_ms""")
def kline_with_oi(spark, sf):
    rows = panel.kline_with_oi(bars_at(spark, sf, "5m"), oi(spark, sf).where("src_rank >= 2"))
    return rounded(rows.select(*S.BAR_KEYS, "close", "volume", "sum_open_interest"), "volume")


@query(f"""SELECT {_ROW}, o.sum_open_interest, {', '.join('r.' + c for c in MEASURES)}
           FROM bars_5m b LEFT JOIN oi o ON o.symbol = b.symbol AND o.start_ms = b.start_ms
           LEFT JOIN ratios r ON r.symbol = b.symbol AND r.start_ms = b.start_ms""")
def market_panel(spark, sf):
    rows = panel.market_panel(bars_at(spark, sf, "5m"), oi(spark, sf), ratios(spark, sf))
    return rounded(rows.select(*S.BAR_KEYS, "close", "volume", "sum_open_interest", *MEASURES), "volume")


@query("""SELECT symbol, start_ms, start_ms // 900000 % 6 = 0 AS missing, trades_count
          FROM bars_15m WHERE start_ms // 900000 % 6 = 0 OR start_ms // 900000 % 10 = 3""")
def rollup_mismatch(spark, sf):
    """A stored 15m rollup with lost and miscounted buckets against a fresh fold."""
    slot = F.col("start_ms") / 900_000
    stored = bars_at(spark, sf, "15m").where(slot % 6 != 0).withColumn(
        "trades_count", F.when(slot % 10 == 3, F.col("trades_count") + 1).otherwise(F.col("trades_count")))
    return reconcile.rollup_mismatch(bars(spark, sf), stored, "15m").select(
        *S.BAR_KEYS, "missing", "trades_count")


@query("""SELECT symbol, start_ms FROM bars_1h WHERE start_ms // 3600000 % 7 = 0 AND start_ms // 3600000 % 10 <> 0
          AND abs(close * 1.01 - close) > 1e-9""")
def close_mismatch(spark, sf):
    rows = reconcile.close_mismatch(bars(spark, sf), external_1h(spark, sf), "1h", 1e-9)
    return rows.select(*S.BAR_KEYS)


# our side lacks some hours; the other side lacks others, and has some prices, volumes and counts of its own
CTES["kept_1h"] = "SELECT * FROM bars_1h WHERE start_ms // 3600000 % 11 <> 4"
CTES["other_1h"] = """
SELECT symbol, start_ms, open, high, low, close, CASE WHEN start_ms // 3600000 % 13 = 5 THEN volume * 1.5 ELSE volume END AS volume,
       quote_volume, taker_buy_volume, taker_buy_quote_volume, trades_count + CASE WHEN start_ms // 3600000 % 9 = 2 THEN 1 ELSE 0 END AS trades_count
FROM external_1h"""


def _apart(columns, tolerance: str) -> str:
    return " OR ".join(f"abs(a.{c} - b.{c}) > {tolerance} * greatest(abs(a.{c}), abs(b.{c}), 1e-12)" for c in columns)


@query(f"""
SELECT *, CASE WHEN missing_ours + price_diff + volume_diff + count_diff > 0 THEN 'FAIL' WHEN checked = 0 THEN 'EMPTY'
               WHEN missing_theirs > 0 THEN 'WARN' ELSE 'PASS' END AS status
FROM (SELECT symbol, count(*) FILTER (WHERE has_a AND has_b) AS checked, count(*) FILTER (WHERE NOT has_a) AS missing_ours,
             count(*) FILTER (WHERE NOT has_b) AS missing_theirs, count(*) FILTER (WHERE price) AS price_diff,
             count(*) FILTER (WHERE volumes) AS volume_diff, count(*) FILTER (WHERE trades) AS count_diff,
             count(*) FILTER (WHERE has_a AND has_b AND NOT (price OR volumes OR trades)) AS matched
      FROM (SELECT coalesce(a.symbol, b.symbol) AS symbol, a.symbol IS NOT NULL AS has_a, b.symbol IS NOT NULL AS has_b,
                   coalesce({_apart(S.PRICES, '1e-9')}, FALSE) AS price, coalesce({_apart(S.VOLUMES, '1e-6')}, FALSE) AS volumes,
                   coalesce(a.trades_count <> b.trades_count, FALSE) AS trades
            FROM kept_1h a FULL JOIN other_1h b ON a.symbol = b.symbol AND a.start_ms = b.start_ms) GROUP BY symbol)""")
def reconcile_external(spark, sf):
    hour = F.col("start_ms") / HOUR
    theirs = external_1h(spark, sf).withColumns({
        "volume": F.when(hour % 13 == 5, F.col("volume") * 1.5).otherwise(F.col("volume")),
        "trades_count": F.col("trades_count") + F.when(hour % 9 == 2, 1).otherwise(0)})
    return reconcile.reconcile(bars_at(spark, sf, "1h").where(hour % 11 != 4), theirs)


@query("""
WITH w AS (SELECT symbol, rn - 1 AS pos, start_ms AS t, close AS c, volume AS v FROM last_200_bars),
changed AS (SELECT symbol, pos, CASE WHEN pos % 23 = 5 THEN t + 1 ELSE t END AS t,
                   CASE WHEN t // 60000 % 13 = 0 THEN c + 1 ELSE c END AS c,
                   CASE WHEN t // 60000 % 17 = 0 THEN v + 1 ELSE v END AS v FROM w)
SELECT symbol, cached, stored, compared, "match", "time", price, volume,
       CASE WHEN "time" + price + volume > 0 THEN 'FAIL' WHEN compared < 200 THEN 'WARN' ELSE 'PASS' END AS status
FROM (SELECT a.symbol, count(*) AS cached, count(*) AS stored, count(*) AS compared,
             count(*) FILTER (WHERE a.t <> w.t) AS "time",
             count(*) FILTER (WHERE a.t = w.t AND abs(a.c - w.c) > 1e-5) AS price,
             count(*) FILTER (WHERE a.t = w.t AND abs(a.c - w.c) <= 1e-5 AND abs(a.v - w.v) > 1e-5) AS volume,
             count(*) FILTER (WHERE a.t = w.t AND abs(a.c - w.c) <= 1e-5 AND abs(a.v - w.v) <= 1e-5) AS "match"
      FROM changed a JOIN w ON a.symbol = w.symbol AND a.pos = w.pos GROUP BY a.symbol)""")
def reconcile_positional(spark, sf):
    """Served windows with some altered times, closes and volumes against the stored bars."""
    base = bars(spark, sf)
    listed = windows.rolling_window(base, 200).select("symbol", F.posexplode("bars").alias("pos", "b"))
    slot = F.col("t") / MINUTE
    served = listed.select("symbol", "pos", "b.t", "b.o", "b.h", "b.l", "b.c", "b.v", "b.qv").withColumns({
        "c": F.when(slot % 13 == 0, F.col("c") + 1).otherwise(F.col("c")),
        "v": F.when(slot % 17 == 0, F.col("v") + 1).otherwise(F.col("v")),
        "t": F.when(F.col("pos") % 23 == 5, F.col("t") + 1).otherwise(F.col("t"))})
    return reconcile.reconcile_positional(served, base, 200)


# history labels: each bar's value at the right label, for odd days one label late
CTES["oi_labels"] = """
SELECT symbol, start_ms + CASE WHEN start_ms // 86400000 % 2 = 1 THEN 600000 ELSE 300000 END AS label_ms,
       sum_open_interest AS value FROM oi"""


def oi_labels(spark, sf):
    late = F.when((F.col("start_ms") - F.col("start_ms") % DAY) / DAY % 2 == 1, 2 * BAR).otherwise(BAR)
    return oi(spark, sf).select("symbol", (F.col("start_ms") + late).alias("label_ms"),
                                F.col("sum_open_interest").alias("value"))


@query("""SELECT symbol, count(*) FILTER (WHERE k = 1) AS match_5m, count(*) FILTER (WHERE k = 2) AS match_10m
          FROM (SELECT o.symbol, k FROM oi o CROSS JOIN (VALUES (1), (2)) s(k)
                JOIN oi_labels l ON l.symbol = o.symbol AND l.label_ms = o.start_ms + k * 300000
                                AND l.value = o.sum_open_interest)
          GROUP BY symbol""")
def shift_probe(spark, sf):
    return reconcile.shift_probe(oi(spark, sf), oi_labels(spark, sf))


_CMP_LO, _CMP_HI = SPAN_FROM + 5 * DAY, NOW - 5 * DAY


@query(f"""
WITH j AS (SELECT l.symbol, l.label_ms - 300000 BETWEEN {_CMP_LO} AND {_CMP_HI} AS inside, o.src_rank = 1 AS live,
                  o.sum_open_interest IS NOT NULL AS hit,
                  o.sum_open_interest = l.value OR abs(o.sum_open_interest - l.value)
                    / greatest(abs(o.sum_open_interest), abs(l.value), 1e-12)
                    <= CASE WHEN o.src_rank = 1 THEN 0.005 ELSE 1e-9 END AS ok
           FROM oi_labels l LEFT JOIN oi o ON o.symbol = l.symbol AND o.start_ms = l.label_ms - 300000),
c AS (SELECT symbol, count(*) FILTER (WHERE NOT inside) AS skipped, count(*) FILTER (WHERE inside AND hit) AS compared,
             count(*) FILTER (WHERE inside AND NOT hit) AS missing,
             count(*) FILTER (WHERE inside AND hit AND ok AND NOT live) AS ok_calibrated,
             count(*) FILTER (WHERE inside AND hit AND ok AND live) AS ok_live,
             count(*) FILTER (WHERE inside AND hit AND NOT ok) AS mismatched FROM j GROUP BY symbol)
SELECT *, CASE WHEN mismatched + missing > 0 THEN 'FAIL' WHEN compared = 0 THEN 'WARN' ELSE 'PASS' END AS status FROM c""")
def compare_labels(spark, sf):
    return reconcile.compare_labels(oi(spark, sf), oi_labels(spark, sf), _CMP_LO, _CMP_HI)


@query("""
WITH missing AS (SELECT symbol, t FROM (SELECT symbol, unnest(generate_series(from_ms, to_ms - 60000, 60000)) AS t FROM merged_ranges)
                 WHERE (symbol, t) NOT IN (SELECT (symbol, start_ms) FROM bars)),
islands AS (SELECT symbol, t, t - 60000 * row_number() OVER (PARTITION BY symbol ORDER BY t) AS g FROM missing)
SELECT symbol, min(t) AS from_ms, max(t) + 60000 AS to_ms FROM islands GROUP BY symbol, g""")
def subtract_present(spark, sf):
    merged = ranges.merge_ranges(wanted_ranges(spark, sf))
    return ranges.subtract_present(merged, bars(spark, sf), MINUTE)


CTES["repair_ranges"] = """
SELECT symbol, min(from_ms) AS from_ms, max(to_ms) AS to_ms FROM (
  SELECT symbol, from_ms - 1800000 AS from_ms, to_ms + 600000 AS to_ms FROM gaps_5m WHERE missing_count % 4 = 1)
GROUP BY symbol, from_ms"""


def repair_ranges(spark, sf):
    """Stretches around every fourth kind of 5m gap, in bars of any minute."""
    from workload.base import gaps_5m

    return gaps_5m(spark, sf).where("missing_count % 4 = 1").select(
        "symbol", (F.col("from_ms") - 1_800_000).alias("from_ms"), (F.col("to_ms") + 600_000).alias("to_ms"))


@query("""SELECT DISTINCT b.symbol, b.start_ms, b.close FROM bars b JOIN repair_ranges r
          ON b.symbol = r.symbol AND b.start_ms >= r.from_ms AND b.start_ms < r.to_ms""")
def wanted_bars(spark, sf):
    return ranges.wanted_bars(bars(spark, sf), repair_ranges(spark, sf)).select(*S.BAR_KEYS, "close")


_HALF = SPAN_FROM + 15 * DAY
CTES["universe_old"] = f"""
SELECT DISTINCT symbol || '_' || (uid % 50) AS symbol FROM ticks WHERE t_ms < {_HALF} UNION SELECT 'delisted'"""
CTES["universe_new"] = f"""
SELECT DISTINCT symbol || '_' || (uid % 50) AS symbol FROM ticks WHERE t_ms >= {_HALF} UNION SELECT 'listed'"""


@query("""SELECT symbol, 'added' AS change FROM universe_new WHERE symbol NOT IN (SELECT symbol FROM universe_old)
          UNION ALL SELECT symbol, 'removed' FROM universe_old WHERE symbol NOT IN (SELECT symbol FROM universe_new)""")
def universe_diff(spark, sf):
    """Contracts seen in each half of the month, with one delisted and one listed."""
    contracts = ticks(spark, sf).select(
        F.concat_ws("_", "symbol", (F.col("uid") % 50).cast("string")).alias("symbol"), "t_ms")

    def with_one_more(rows, name):
        return rows.select(F.explode(F.array("symbol", F.lit(name))).alias("symbol"))

    old = with_one_more(contracts.where(F.col("t_ms") < _HALF), "delisted")
    new = with_one_more(contracts.where(F.col("t_ms") >= _HALF), "listed")
    return panel.universe_diff(old, new)


@query("SELECT symbol, interval FROM universe CROSS JOIN (VALUES ('1m'), ('5m'), ('1h')) v(interval)")
def key_grid(spark, sf):
    return panel.key_grid(universe(spark, sf), ["1m", "5m", "1h"])


@query(f"""SELECT 'kline_' || interval || '_' || bucket AS shard, lower(symbol) || '@kline_' || interval AS stream, symbol, interval, bucket
           FROM (SELECT symbol, CAST({crc_sql("upper(symbol)")} % 8 AS BIGINT) AS bucket FROM (SELECT DISTINCT symbol || uid AS symbol FROM ticks))
           CROSS JOIN (VALUES ('1m'), ('5m')) v(interval)""")
def stream_plan(spark, sf):
    """Streams per shard for every contract."""
    contracts = ticks(spark, sf).select(F.concat("symbol", F.col("uid").cast("string")).alias("symbol"))
    return panel.stream_plan(contracts, ["1m", "5m"], 8)


CTES["ratio_points"] = " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS measure, snap_ms + CASE WHEN ingest_seq % 29 = 0 THEN 1 ELSE 0 END AS label_ms, {c} AS ratio "
    f"FROM ratio_raw WHERE {c} IS NOT NULL" for c in MEASURES)
_MERGE_NOW = NOW - 2 * DAY


def ratio_points(spark, sf):
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("ratio")) for c in MEASURES]))
    off = F.when(F.col("ingest_seq") % 29 == 0, 1).otherwise(0)
    return ratio_raw(spark, sf).select("symbol", (F.col("snap_ms") + off).alias("label_ms"), cells.alias("c")).select(
        "symbol", "c.measure", "label_ms", "c.ratio").where("ratio IS NOT NULL")


@query(f"""
WITH newest AS (SELECT symbol, measure, max(label_ms) AS top FROM ratio_points GROUP BY 1, 2),
bound AS (SELECT symbol, least(min(top), {_MERGE_NOW}) AS b FROM newest GROUP BY symbol HAVING count(*) = 3)
SELECT p.symbol, label_ms - 300000 AS start_ms, {', '.join(f"max(ratio) FILTER (WHERE measure = '{c}') AS {c}" for c in MEASURES)},
       label_ms AS snap_ms, CAST(2 AS INTEGER) AS src_rank
FROM ratio_points p JOIN bound USING (symbol) WHERE label_ms % 300000 = 0 AND label_ms <= b GROUP BY p.symbol, label_ms""")
def merge_ratios(spark, sf):
    return series.merge_ratio_series(ratio_points(spark, sf), _MERGE_NOW)


_SWEEP_DUE = f"""
WITH e AS (SELECT symbol, from_ms FROM gaps_5m WHERE from_ms // 300000 % 3 = 0),
x AS (SELECT symbol, from_ms, {NOW} + CASE WHEN from_ms // 300000 % 2 = 0 THEN 1000 ELSE -1000 END AS expires_ms FROM e)
SELECT symbol, from_ms, to_ms, missing_count FROM gaps_5m
WHERE (symbol, from_ms) NOT IN (SELECT (symbol, from_ms) FROM x WHERE expires_ms > {NOW})"""


def _known_empty(spark, sf):
    """The gaps, and a third of them as found empty before; half of these memories have expired."""
    from workload.base import gaps_5m

    holes = gaps_5m(spark, sf)
    slot = F.col("from_ms") / BAR
    return holes, holes.where(slot % 3 == 0).select("symbol", "from_ms", (F.lit(NOW) + F.when(
        slot % 2 == 0, 1_000).otherwise(-1_000)).alias("expires_ms"))


@query(_SWEEP_DUE)
def sweep_due(spark, sf):
    """All ranges that are due."""
    return ranges.sweep_plan(*_known_empty(spark, sf), NOW)


@query(_SWEEP_DUE + " ORDER BY symbol, from_ms LIMIT 400")
def sweep_plan(spark, sf):
    """The ranges that are due, up to an explicit cap."""
    return ranges.sweep_plan(*_known_empty(spark, sf), NOW, 400)


# a snapshot's value at the close price of the bar 5m later on odd days
CTES["clock_snaps"] = """
SELECT b.symbol, b.start_ms + 300000 - CASE WHEN b.start_ms // 86400000 % 2 = 1 THEN 300000 ELSE 0 END AS label_ms,
       o.sum_open_interest + 1 AS sum_open_interest, (o.sum_open_interest + 1) * (b.close + 1) AS sum_open_interest_value
FROM bars_5m b JOIN oi o ON o.symbol = b.symbol AND o.start_ms = b.start_ms"""
CTES["clock_closes"] = "SELECT symbol, start_ms + 300000 AS at_ms, close + 1 AS close FROM bars_5m"


@query("""
WITH d AS (SELECT s.symbol, s.label_ms - s.label_ms % 86400000 AS day_ms, k,
                  abs(s.sum_open_interest_value / s.sum_open_interest / c.close - 1.0) * 10000.0 AS dev
           FROM clock_snaps s CROSS JOIN (VALUES (0), (300000)) v(k)
           JOIN clock_closes c ON c.symbol = s.symbol AND c.at_ms = s.label_ms + k),
m AS (SELECT symbol, day_ms, median(dev) FILTER (WHERE k = 0) AS a, median(dev) FILTER (WHERE k <> 0) AS b
      FROM d GROUP BY 1, 2)
SELECT symbol, day_ms, round(a, 6) AS at_label_bp, round(b, 6) AS after_label_bp,
       CASE WHEN a <= b THEN 'snapshot_at_label' WHEN a > b THEN 'snapshot_after_label' END AS meaning FROM m""")
def clock_probe(spark, sf):
    late = F.when((F.col("start_ms") - F.col("start_ms") % DAY) / DAY % 2 == 1, BAR).otherwise(0)
    held = F.col("sum_open_interest") + 1
    pairs = panel.kline_with_oi(bars_at(spark, sf, "5m"), oi(spark, sf)).where("sum_open_interest IS NOT NULL")
    snaps = pairs.select("symbol", (F.col("start_ms") + BAR - late).alias("label_ms"),
                         held.alias("sum_open_interest"),
                         (held * (F.col("close") + 1)).alias("sum_open_interest_value"))
    closes = bars_at(spark, sf, "5m").select("symbol", (F.col("start_ms") + BAR).alias("at_ms"),
                                             (F.col("close") + 1).alias("close"))
    return rounded(reconcile.clock_probe(snaps, closes), "at_label_bp", "after_label_bp")


@query("""SELECT count(*) AS planned, count(*) FILTER (WHERE new_start // 300000 % 5 <> 0) AS found,
                 count(*) = count(*) FILTER (WHERE new_start // 300000 % 5 <> 0) AS ok
          FROM snap_plans WHERE action = 'move'""")
def moved_check(spark, sf):
    """Planned moves against a table that lost one slot in five."""
    plan = snap_plan_of(spark, sf)
    table = plan.where("action = 'move'").where((F.col("new_start") / BAR) % 5 != 0).select(
        "symbol", F.col("new_start").alias("start_ms"), F.col("value").alias("sum_open_interest"),
        F.lit(3).alias("src_rank"))
    return reconcile.moved_check(plan, table)


# --- top-k and set operations ---------------------------------------------------

@query(f"SELECT symbol, start_ms, close, {round_sql('volume')} FROM bars WHERE symbol = 'view' ORDER BY start_ms DESC LIMIT 100")
def newest_n(spark, sf):
    return rounded(panel.newest_n(bars(spark, sf), "view", 100).select(*S.BAR_KEYS, "close", "volume"), "volume")


_SLOT = SPAN_FROM + 10 * DAY + 16 * HOUR


@query(f"""SELECT symbol, close, {round_sql('quote_volume')}, trades_count FROM bars_4h WHERE start_ms = {_SLOT}""")
def cross_section(spark, sf):
    return rounded(panel.cross_section(bars_at(spark, sf, "4h"), _SLOT), "quote_volume")


@query(f"SELECT symbol, sum_open_interest FROM (SELECT symbol, close AS sum_open_interest, start_ms FROM oi_4h) WHERE start_ms = {_SLOT}")
def oi_cross_section(spark, sf):
    from candlemill.operators.rollup import rollup_oi

    rows = rollup_oi(oi(spark, sf), "4h").withColumnRenamed("close", "sum_open_interest")
    return panel.oi_cross_section(rows, _SLOT)


@query("""SELECT symbol, start_ms, close FROM bars_1h
          WHERE symbol IN (SELECT symbol FROM universe ORDER BY symbol LIMIT 2)""")
def sample_symbols(spark, sf):
    return panel.sample_symbols(bars_at(spark, sf, "1h"), 2).select(*S.BAR_KEYS, "close")


_WL_FROM, _WL_TO = SPAN_FROM + 3 * DAY, SPAN_FROM + 27 * DAY


@query(f"""SELECT DISTINCT symbol, day_ms FROM (
             SELECT symbol, start_ms - start_ms % 86400000 AS day_ms, start_ms FROM oi
             UNION ALL SELECT symbol, (start_ms + 300000) - (start_ms + 300000) % 86400000, start_ms FROM oi)
           WHERE start_ms >= {_WL_FROM - BAR} AND start_ms < {_WL_TO} AND day_ms >= {_WL_FROM} AND day_ms < {_WL_TO}""")
def archive_worklist(spark, sf):
    return snap.archive_worklist(oi(spark, sf), _WL_FROM, _WL_TO)


@query("""SELECT DISTINCT CAST(strftime(make_timestamp(ms * 1000), '%Y%m') AS INTEGER) AS month
          FROM (SELECT old_start AS ms FROM snap_plans UNION ALL SELECT new_start FROM snap_plans)""")
def months_touched(spark, sf):
    return snap.months_touched(snap_plan_of(spark, sf))
