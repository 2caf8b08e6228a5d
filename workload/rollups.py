"""Folds to coarser intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import rollup
from candlemill.plans import refresh
from workload.base import (
    CTES, DAY, MEASURES, NOW, STEPS, bars, bars_at, bars_raw, oi, query, ratios, round_sql, rounded,
)

_BAR = f"symbol, start_ms, end_ms, open, high, low, close, {round_sql(*S.VOLUMES)}, trades_count"
SNAPSHOT_LEVELS = ["15m", "1h", "4h", "1d"]


def _kline(interval):
    def run(spark, sf):
        return rounded(bars_at(spark, sf, interval), *S.VOLUMES)

    query(f"SELECT {_BAR} FROM bars_{interval}", name=f"kline_{interval}")(run)


def _oi(interval, step):
    def run(spark, sf):
        return rollup.rollup_oi(oi(spark, sf), interval)

    CTES[f"oi_{interval}"] = f"""
SELECT symbol, start_ms - start_ms % {step} AS start_ms, count(*) AS samples,
       arg_max(sum_open_interest, oi.start_ms) AS close, max(sum_open_interest) AS high,
       min(sum_open_interest) AS low FROM oi GROUP BY symbol, oi.start_ms - oi.start_ms % {step}"""
    query(f"SELECT * FROM oi_{interval}", name=f"oi_{interval}")(run)


def _ratio(interval, step):
    def run(spark, sf):
        return rollup.rollup_ratios(ratios(spark, sf), interval)

    cells = ", ".join(f"arg_max({c}, ratios.start_ms) AS {c}_close, max({c}) AS {c}_high, min({c}) AS {c}_low"
                      for c in MEASURES)
    query(f"""SELECT symbol, start_ms - start_ms % {step} AS start_ms, count(*) AS samples, {cells}
              FROM ratios GROUP BY symbol, ratios.start_ms - ratios.start_ms % {step}""",
          name=f"ratio_{interval}")(run)


for _iv in STEPS:
    _kline(_iv)
for _iv in SNAPSHOT_LEVELS:
    _oi(_iv, STEPS[_iv])
    _ratio(_iv, STEPS[_iv])


@query(" UNION ALL ".join(
    f"SELECT '{iv}' AS interval, {_BAR} FROM bars_{iv}" for iv in STEPS))
def kline_all_levels(spark, sf):
    """Every level from one scan."""
    rows = rollup.rollup_klines_many(bars(spark, sf), list(STEPS))
    return rounded(rows, *S.VOLUMES)


@query(f"SELECT {_BAR} FROM bars_1h")
def kline_1h_colocated(spark, sf):
    """Dedup and fold over one exchange, for tables with few copies per bar."""
    rows = rollup.rollup_raw_klines(bars_raw(spark, sf), "1h", bounded_copies=True)
    return rounded(rows, *S.VOLUMES)


def _bound(interval: str) -> int:
    return rollup.refresh_bound(NOW, interval, tg.KLINE_LOOKBACK_DAYS[interval] * 2)


@query(" UNION ALL ".join(
    f"SELECT '{iv}' AS interval, symbol, start_ms, close, {round_sql('volume')}, CAST({NOW} AS BIGINT) AS version "
    f"FROM bars_{iv} WHERE start_ms >= {_bound(iv)}" for iv in STEPS))
def rollup_refresh(spark, sf):
    """The buckets each level's incremental refresh rewrites."""
    base = bars(spark, sf)
    rows = None
    for interval, days in tg.KLINE_LOOKBACK_DAYS.items():
        one = refresh.refresh_rollup(base, rollup.rollup_klines, NOW, interval, days * 2)
        one = one.select(F.lit(interval).alias("interval"), *S.BAR_KEYS, "close", "volume", "version")
        rows = one if rows is None else rows.unionByName(one)
    return rounded(rows, "volume")


@query("SELECT * FROM oi_15m WHERE samples = 3")
def complete_only(spark, sf):
    return rollup.complete_only(rollup.rollup_oi(oi(spark, sf), "15m"), "15m")
