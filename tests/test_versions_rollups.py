from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import quality, rollup, versions
from candlemill.operators.panel import high_water_marks
from candlemill.plans import refresh
from candlemill.sources import facts
from helpers import BAR, DAY, HOUR, MIN, OI, bar, bars, ms, rows


def test_version_wins_then_later_insert(spark):
    made = [bar("A", 0, 1.0, version=2, seq=1), bar("A", 0, 2.0, version=1, seq=9),
            bar("B", 0, 3.0, version=1, seq=1), bar("B", 0, 4.0, version=1, seq=2)]
    for seed in range(3):
        random.Random(seed).shuffle(made)
        assert rows(versions.latest_bars(bars(spark, made)), "symbol", "close") == [("A", 1.0), ("B", 4.0)]


def test_source_precedence(frame):
    t = ms("2026-09-21 12:00")
    got = versions.latest_snapshots(frame([
        ("AAA", t, 100.0, t, 1, 1), ("AAA", t, 100.25, t + BAR, 2, 2), ("AAA", t, 999.0, t, 1, 3)], OI))
    assert rows(got, "sum_open_interest", "src_rank") == [(100.25, 2)]


def test_ratio_row_is_replaced_whole(frame):
    schema = "symbol string, start_ms long, a double, b double, c double, src_rank int, ingest_seq long"
    got = versions.latest_snapshots(frame([
        ("AAA", 0, 1.25, 2.5, 3.75, 3, 1), ("AAA", 0, 9.0, None, None, 2, 2),
        ("BBB", 0, None, None, 0.5, 2, 3)], schema))
    assert rows(got, "symbol", "a", "b", "c") == [("AAA", 1.25, 2.5, 3.75), ("BBB", None, None, 0.5)]


def test_dedup_is_idempotent(spark):
    raw = bars(spark, [bar("A", m * MIN, float(m), version=v, seq=v) for m in range(20) for v in range(3)])
    once = versions.latest_bars(raw)
    assert rows(once) == rows(versions.latest_bars(once))


def test_high_water_marks(frame):
    five = ms("2026-09-21 12:05")
    got = high_water_marks(frame([
        ("AAA", five - BAR, 1.0, 0, 2, 1), ("AAA", five, 1.0, 0, 1, 2),
        ("BBB", five - BAR, 1.0, 0, 3, 3), ("LIVE", five, 1.0, 0, 1, 4)], OI))
    assert rows(got) == [("AAA", five, five - BAR), ("BBB", five - BAR, five - BAR), ("LIVE", five, None)]


def test_rollup_takes_first_open_and_last_close(spark, zone):
    start = ms("2024-05-01 00:00")
    made = [bar("A", start + m * MIN, 10.0 + m, high=20.0 + m, low=5.0 - m) for m in (3, 0, 4, 1)]
    got = rollup.rollup_klines(bars(spark, made), "5m")
    assert rows(got, "start_ms", "end_ms", "open", "high", "low", "close", "volume", "trades_count") == [
        (start, start + 5 * MIN - 1, 10.0, 24.0, 1.0, 14.0, 4.0, 12)]


def test_day_buckets_stay_on_utc_midnight(spark, zone):
    last, first = ms("2024-05-01 23:59"), ms("2024-05-02 00:00")
    got = rollup.rollup_klines(bars(spark, [bar("A", last), bar("A", first)]), "1d")
    assert rows(got, "start_ms") == [(ms("2024-05-01"),), (ms("2024-05-02"),)]


def test_ratio_close_skips_nulls(frame):
    schema = "symbol string, start_ms long, " + ", ".join(f"{c} double" for c in S.RATIOS)
    got = rollup.rollup_ratios(frame([("A", 0, 1.0, None, 2.0), ("A", BAR, None, None, 3.0)], schema), "15m")
    assert rows(got, "samples", f"{S.RATIOS[0]}_close", f"{S.RATIOS[1]}_close", f"{S.RATIOS[2]}_close") == [
        (2, 1.0, None, 3.0)]


def test_all_levels_equal_single_levels(spark):
    base = bars(spark, [bar("A", m * 7 * MIN, float(m)) for m in range(500)])
    many = rollup.rollup_klines_many(base, ["5m", "1h", "1d"])
    for level in ("5m", "1h", "1d"):
        assert rows(many.where(F.col("interval") == level).drop("interval")) == rows(
            rollup.rollup_klines(base, level).select(*[c for c in many.columns if c != "interval"]))


def test_colocated_fold_equals_the_default(spark):
    raw = bars(spark, [bar("A", m * MIN, float(m * v), version=v, seq=v) for m in range(300) for v in (1, 2)])
    assert rows(rollup.rollup_raw_klines(raw, "1h", True)) == rows(rollup.rollup_raw_klines(raw, "1h"))


def test_refresh_bound_is_aligned_and_refresh_equals_rebuild(spark, folder):
    base = bars(spark, [bar("A", m * 11 * MIN, float(m)) for m in range(3_000)])
    now = 20 * DAY + 37 * MIN
    assert rollup.refresh_bound(now, "4h", 7) % (4 * HOUR) == 0
    path = folder("refresh")
    full = rollup.rollup_klines(base, "4h").withColumn("version", F.lit(1).cast("long"))
    refresh.rebuild_rollups(base, {"4h": (rollup.rollup_klines, path)}, 1)
    refresh.apply_refresh(base, rollup.rollup_klines, path, now, "4h", 7)
    stored = facts.read_facts(spark, path, S.BARS).drop("month", "version")
    assert rows(stored) == rows(full.select(*stored.columns))


def test_refold_wants_month_starts(spark):
    with pytest.raises(ValueError):
        refresh.refold(bars(spark, [bar("A", 0)]), rollup.rollup_klines, "1h", 0, 5 * DAY)


def test_samples_are_conserved(frame):
    base = frame([("A", i * BAR, float(i), 0, 2, i) for i in range(700)], OI)
    levels = {iv: rollup.rollup_oi(base, iv) for iv in ("15m", "1h", "4h", "1d")}
    assert all(r.ok and r.raw_rows == 700 for r in quality.conservation(base, levels).collect())
    lost = {"15m": levels["15m"].where("start_ms > 0")}
    assert [r.ok for r in quality.conservation(base, lost).collect()] == [False]


@pytest.mark.parametrize("text,ok", [
    ("5m", True), ("15m", True), ("1h", True), ("4h", True), ("1d", True), ("120s", True), ("1m", False),
    ("90s", False), ("1w", False), ("2d", False), ("1M", False), ("m", False), ("0m", False), ("x", False)])
def test_derivable_intervals(text, ok):
    assert tg.is_derivable(text) is ok


def test_interval_grammar():
    assert tg.interval_ms("1w") == 7 * DAY
    assert tg.interval_ms("1M", calendar_month=True) == 30 * DAY
    with pytest.raises(ValueError):
        tg.interval_ms("1M")


def test_driver_side_times():
    day = "2026-09-21 "
    for now, want in (("14:11:14", "14:00"), ("14:09:00", "14:00"), ("14:08:59", "13:55")):
        assert tg.newest_published(ms(day + now)) == ms(day + want)
    assert tg.newest_published(ms(day + "00:02")) == ms("2026-09-20 23:50")
    now = ms(day + "12:07:30")
    lo, hi = tg.settled_window(now, 1, 10)
    assert (hi, (hi - lo) // BAR + 1) == (ms(day + "11:50"), 12)
    assert tg.settled_window(now, 1, 0)[1] == ms(day + "12:00")
    assert tg.sweep_window(ms(day + "12:00:30"), 3 * MIN, DAY, MIN) == (
        ms("2026-09-20 11:57"), ms(day + "11:57"))
    assert tg.parse_start("2024-01-01 06:31") == ms("2024-01-01 06:35")
    assert tg.months_between(ms("2023-12-31"), ms("2024-02-01")) == [202312, 202401]
