from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from candlemill import timegrid as tg
from candlemill.operators import gaps, ordered, ranges, sections
from candlemill.sources import gapfile
from helpers import BAR, DAY, HOUR, MIN, bar, bars, ms, rows

RANGE = "symbol string, from_ms long, to_ms long"


def minutes(*pairs):
    return [("A", a * MIN, b * MIN) for a, b in pairs]


@pytest.mark.parametrize("on_grid", [False, True])
def test_gap_detection(spark, on_grid):
    base = ms("2026-09-07 10:00")
    seen = {"AAA": [0, 1, 2, 4, 4, 5, 8, 9], "BBB": range(5), "CCC": [5, 6, 7, 9]}
    made = bars(spark, [bar(s, base + m * MIN) for s, ms_ in seen.items() for m in ms_])
    got = rows(gaps.find_gaps(made, MIN, base, base + 10 * MIN, on_grid))
    assert got == [("AAA", base + 3 * MIN, base + 4 * MIN, 1), ("AAA", base + 6 * MIN, base + 8 * MIN, 2),
                   ("CCC", base + 8 * MIN, base + 9 * MIN, 1)]


def test_off_grid_rows_are_no_bars(frame):
    made = frame([("A", 0), ("A", BAR + 7), ("A", 2 * BAR)], "symbol string, start_ms long")
    assert rows(gaps.find_gaps(made, BAR, on_grid=True)) == [("A", BAR, 2 * BAR, 1)]


@pytest.mark.parametrize("on_grid", [False, True])
def test_gaps_across_days_and_lone_bars(spark, frame, on_grid):
    rng = random.Random(7)
    made = sorted({rng.randrange(0, 9 * 1440) for _ in range(900)} | {0})
    got = rows(gaps.find_gaps(frame([("A", m * MIN) for m in made], "symbol string, start_ms long"), MIN, on_grid=on_grid))
    want = [("A", (a + 1) * MIN, b * MIN, b - a - 1) for a, b in zip(made, made[1:]) if b - a > 1]
    assert got == sorted(want, key=repr)
    # gaps and present bars tile the span
    assert sum(g[3] for g in got) + len(made) == made[-1] - made[0] + 1


def test_tail_gaps(frame):
    hi = 100 * BAR
    rows_ = frame([("A", hi), ("B", hi - 3 * BAR)], "symbol string, start_ms long")
    assert rows(gaps.tail_gaps(rows_, hi, BAR)) == [("B", hi - 2 * BAR, hi + BAR, 3)]


def test_merge_ranges(frame):
    got = ranges.merge_ranges(frame(minutes((5, 6), (1, 2), (2, 3), (10, 11)), RANGE))
    assert rows(got) == sorted(minutes((1, 3), (5, 6), (10, 11)), key=repr)


def test_merge_ranges_against_brute_force(frame):
    rng = random.Random(3)
    made = []
    for s in "AB":
        for _ in range(150):
            a = rng.randrange(0, 6 * 1440)
            made.append((s, a * MIN, (a + rng.choice([1, 5, 40, 3000])) * MIN))
        made += [(s, DAY, 2 * DAY), (s, 2 * DAY, 3 * DAY)]
    want = []
    for s in "AB":
        for _, a, b in sorted(r for r in made if r[0] == s):
            if want and want[-1][0] == s and a <= want[-1][2]:
                want[-1] = (s, want[-1][1], max(want[-1][2], b))
            else:
                want.append((s, a, b))
    assert rows(ranges.merge_ranges(frame(made, RANGE))) == sorted(want, key=repr)


def test_subtract_present(frame):
    bars_ = "symbol string, start_ms long"
    present = frame([("A", MIN), ("A", 3 * MIN)], bars_)
    assert rows(ranges.subtract_present(frame(minutes((0, 5)), RANGE), present, MIN)) == sorted(
        minutes((0, 1), (2, 3), (4, 5)), key=repr)
    full = frame([("A", 0), ("A", MIN)], bars_)
    assert rows(ranges.subtract_present(frame(minutes((0, 2)), RANGE), full, MIN)) == []


def test_clip_ranges(frame):
    got = ranges.clip_ranges(frame([("A", a * BAR, b * BAR) for a, b in ((0, 2), (3, 6), (8, 9))], RANGE),
                             4 * BAR, BAR)
    kept = rows(got.where("kept_from_ms IS NOT NULL"), "kept_from_ms", "kept_to_ms")
    assert kept == sorted([(4 * BAR, 6 * BAR), (8 * BAR, 9 * BAR)], key=repr)
    assert got.agg(F.sum("dropped_bars")).first()[0] == 3


def test_pages(frame):
    long = ranges.page_ranges(frame(minutes((0, 3000)), RANGE), MIN, 1500)
    assert sorted((r.to_ms - r.from_ms) // MIN for r in long.collect()) == [1500, 1500]
    bars_ = ranges.page_ranges(frame([("A", 0, 1200 * BAR)], RANGE), BAR, 500)
    assert sorted((r.to_ms - r.from_ms) // BAR for r in bars_.collect()) == [200, 500, 500]


def test_wanted_bars_over_day_borders(frame):
    at = frame([("A", DAY - MIN), ("A", DAY), ("A", 3 * DAY), ("B", DAY)], "symbol string, start_ms long")
    hit = ranges.wanted_bars(at, frame([("A", DAY - MIN, 3 * DAY)], RANGE))
    assert rows(hit) == sorted([("A", DAY - MIN), ("A", DAY)], key=repr)


def test_stale_rollups(frame):
    now = 100 * DAY
    for age, want in ((2, []), (5, ["15m", "1h", "5m"]), (20, ["15m", "1d", "1h", "4h", "5m"])):
        at = frame([("A", now - age * DAY)], "symbol string, start_ms long")
        got = ranges.stale_rollups(at, now, tg.KLINE_LOOKBACK_DAYS)
        assert sorted(r.interval for r in got.collect()) == want


def test_sweep_plan_memory_and_cap(frame):
    holes = frame(minutes(*[(2 * i, 2 * i + 1) for i in range(10)]), RANGE)
    memory = "symbol string, from_ms long, expires_ms long"
    asleep, expired = frame([("A", 0, 1_001)], memory), frame([("A", 0, 1_000)], memory)
    assert ranges.sweep_plan(holes, asleep, 1_000, 100).count() == 9
    assert ranges.sweep_plan(holes, expired, 1_000, 100).count() == 10
    capped = rows(ranges.sweep_plan(holes, expired, 1_000, 4), "from_ms")
    assert capped == sorted([(2 * i * MIN,) for i in range(4)], key=repr)


def test_gap_file_round_trip_and_rejects(spark, frame, folder):
    path = folder("gapfile")
    gapfile.write_gaps(gaps.gap_report_rows(
        frame([("A", 0, 2 * MIN, 2)], RANGE + ", missing_count long"), "1m"), path)
    loaded = gapfile.load_gaps(spark, path)
    assert rows(loaded, "from_utc", "to_utc") == [("1970-01-01 00:00:00", "1970-01-01 00:02:00")]
    text = "symbol string, interval string, from_ms string, to_ms string"
    got = gapfile.read_gaps(frame([
        ("btcusdt", "1m", str(60 * MIN), str(61 * MIN)), ("BTCUSDT", "1m", str(61 * MIN), str(63 * MIN)),
        ("BTCUSDT", "5m", "0", str(5 * MIN)), ("币安人生USDT", "1m", "0", str(MIN)),
        ("BTC;DROP", "1m", "0", str(MIN)), ("BTCUSDT", "1m", "1", str(MIN)), ("BTCUSDT", "1m", "x", "0")], text), "1m")
    good = ranges.merge_ranges(got.where("reject IS NULL"))
    assert rows(good) == sorted([("BTCUSDT", 60 * MIN, 63 * MIN), ("币安人生USDT", 0, MIN)], key=repr)
    assert sorted(r.reject for r in got.where("reject IS NOT NULL").collect()) == [
        "interval", "not_an_integer", "range", "symbol"]


def test_monotonic_guard(frame):
    events = frame([("A", 1000, 1, 1), ("A", 1000, 2, 2), ("A", 999, 3, 3), ("A", 2000, 4, 4)],
                   "symbol string, open_ms long, arrival_ms long, seq long")
    got = sections.monotonic_guard(events, ["symbol"], 2)
    assert [r.accepted for r in got.orderBy("seq").collect()] == [True, False, False, True]


def test_prefix_and_previous_match_plain_windows(frame):
    rng = random.Random(11)
    made = [("A" if rng.random() < 0.8 else "B", i * 13 * MIN, rng.randrange(1000)) for i in range(600)]
    data = frame(made, "symbol string, t long, v long")
    got = ordered.prefix_max(data, ["symbol"], ["t"], F.col("v"), "top", tg.whole(F.col("t"), HOUR))
    got = ordered.with_previous(got, ["symbol"], "t", {"v": "prev"}, DAY)
    top, prev = {}, {}
    for row in got.orderBy("t").collect():
        assert row.top == top.get(row.symbol) and row.prev == prev.get(row.symbol)
        top[row.symbol] = max(row.v, top.get(row.symbol, -1))
        prev[row.symbol] = row.v


def test_silences_and_debounce(frame):
    at = frame([("A", t) for t in (0, 10_000, 200_000, 215_000, 400_000)], "symbol string, arrival_ms long")
    quiet = gaps.silence_gaps(at, ["symbol"], 60_000)
    assert rows(quiet, "last_before_ms", "first_after_ms") == sorted([(10_000, 200_000), (215_000, 400_000)], key=repr)
    ends = frame([("g", 1_000), ("g", 20_000), ("g", 90_000)], "symbol string, first_after_ms long")
    fired = gaps.debounced_repairs(ends, ["symbol"])
    assert rows(fired, "from_ms", "last_end_ms", "fire_ms") == sorted(
        [(1_000, 20_000, 50_000), (90_000, 90_000, 120_000)], key=repr)


def test_section_gaps(frame):
    events = frame([("1m", 0), ("1m", MIN), ("1m", 4 * MIN), ("5m", 0), ("5m", BAR)],
                   "interval string, timestamp long")
    assert rows(gaps.section_gaps(events, {"1m": MIN, "5m": BAR})) == [("1m", MIN, 4 * MIN, 2)]


@pytest.mark.parametrize("on_grid", [True, False])
def test_a_series_of_wide_steps_is_no_lane(spark, on_grid):
    """One symbol, every step wide: all gaps are found, and only two rows of a chunk meet by symbol."""
    bars = spark.range(5_000).selectExpr("if(id < 9000, 'A', 'B') AS symbol", "id * 180000 AS start_ms")
    found = gaps.find_gaps(bars, MIN, on_grid=on_grid)
    assert found.count() == 4_999 and found.where("missing_count = 2").count() == 4_999
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(symbol#\w+, _lane#", plan) and not re.search(r"hashpartitioning\(symbol#\w+, \d", plan)
