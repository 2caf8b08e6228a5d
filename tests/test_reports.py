from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.operators import panel, quality, reconcile, series, windows
from candlemill.plans import reports
from helpers import BAR, DAY, HOUR, MIN, OI, bar, bars, ms, rows

LO = ms("2026-09-20 12:00")
HI = LO + 287 * BAR


def oi_day(n=288, **over):
    return {i: ("A", LO + i * BAR, 10.0, LO + (i + 1) * BAR, 2, i) for i in range(n)} | over


def verdict(frame, made, **kw):
    row = quality.oi_verdict(quality.oi_stats(frame(list(made), OI), LO, HI), LO, HI, **kw).first()
    return row.status, row.missing, list(row.fails), list(row.warns)


def test_oi_verdicts(frame):
    day = oi_day()
    assert verdict(frame, day.values()) == ("PASS", 0, [], [])
    holes = [r for i, r in day.items() if i not in (5, 6, 9)]
    assert verdict(frame, holes)[:2] == ("FAIL", 3)
    off = [*day.values(), ("A", LO + 7, 1.0, LO + 7 + BAR, 3, 999)]
    assert verdict(frame, off)[:3] == ("FAIL", 0, ["off_grid_rows=1"])
    snap = {**day, 3: ("A", LO + 3 * BAR, 1.0, LO, 2, 3)}
    assert verdict(frame, snap.values())[0] == "FAIL"
    far_live = {**day, 287: ("A", LO + 287 * BAR, 1.0, LO, 1, 3)}
    assert verdict(frame, far_live.values())[0] == "WARN"
    assert verdict(frame, list(day.values())[:278])[2] == ["bars_behind=10"]
    zero = {**day, 3: ("A", LO + 3 * BAR, 0.0, LO + 4 * BAR, 2, 3)}
    assert verdict(frame, zero.values())[0] == "WARN"
    live = {**day, 3: ("A", LO + 3 * BAR, 1.0, LO + 4 * BAR, 1, 3)}
    assert verdict(frame, live.values())[0] == "WARN"
    assert verdict(frame, live.values(), require_calibration=True)[0] == "FAIL"


def test_bar_verdicts(spark):
    good = [bar("GOOD", i * MIN) for i in range(5)]
    hole = [bar("HOLE", i * MIN) for i in (0, 1, 4)]
    quiet = [bar("QUIET", i * MIN, trades_count=0 if i == 2 else 1) for i in range(5)]
    bad = [bar("BAD", i * MIN, low=99.0) for i in range(3)]
    universe = spark.createDataFrame([(s,) for s in ("GOOD", "HOLE", "QUIET", "BAD", "NONE")], "symbol string")
    got = reports.kline_report(bars(spark, good + hole + quiet + bad), "1m", universe)
    assert dict(rows(got["verdict"], "symbol", "status")) == {
        "GOOD": "PASS", "HOLE": "FAIL", "QUIET": "WARN", "BAD": "FAIL", "NONE": "EMPTY"}
    assert rows(got["gaps"], "symbol", "from_utc", "missing_count") == [("HOLE", "1970-01-01 00:02:00", 2)]
    card = {r["check"]: r.status for r in quality.scorecard({
        "bars": (got["verdict"], True), "events": (got["verdict"], False)}).collect()}
    assert card == {"bars": "FAIL", "events": "WARN", "overall": "FAIL"}


def test_coverage_thresholds(spark, frame):
    keys = "symbol string, start_ms long"
    kl = frame([(s, i * BAR) for s in "ABC" for i in range(288)], keys)
    oi = frame([("A", i * BAR) for i in range(288)] + [("B", i * BAR) for i in range(287)]
               + [("C", i * BAR) for i in range(285)], keys)
    got = quality.coverage(kl, oi, "symbol", 0.995)
    assert rows(got, "symbol", "with_oi", "status") == [("A", 288, "PASS"), ("B", 287, "PASS"), ("C", 285, "FAIL")]
    worst = quality.worst_first(quality.coverage(kl, oi, "start_ms", 0.99), "start_ms", 2).collect()
    assert [r.start_ms for r in worst] == [287 * BAR, 285 * BAR]


def test_freshness_is_null_without_calibrated_rows(frame):
    row = quality.freshness(frame([("A", HI - 2 * BAR, 1.0, 0, 1, 0)], OI), HI).first()
    assert (row.lag_bars, row.newest_cal_ms, row.lag_cal_bars) == (2, None, None)


def test_missing_rollup_row_is_a_mismatch(spark):
    base = bars(spark, [bar("A", i * MIN) for i in range(15)])
    from candlemill.operators.rollup import rollup_klines
    stored = rollup_klines(base, "5m").where(F.col("start_ms") != 5 * MIN)
    got = reconcile.rollup_mismatch(base, stored, "5m")
    assert rows(got, "start_ms", "missing") == [(5 * MIN, True)]


def test_reconcile_statuses(spark):
    ours = [bar(s, i * MIN) for s in ("OK", "DRIFT", "PRICE", "LATE") for i in range(3)] + [bar("EXTRA", i * MIN) for i in range(4)]
    theirs = ([bar("OK", i * MIN) for i in range(3)] + [bar("DRIFT", i * MIN, volume=1.0 + 5e-9) for i in range(3)]
              + [bar("PRICE", i * MIN, close=10.05) for i in range(3)] + [bar("LATE", i * MIN) for i in range(4)]
              + [bar("EXTRA", i * MIN) for i in range(3)])
    got = reconcile.reconcile(bars(spark, ours), bars(spark, theirs))
    assert dict(rows(got, "symbol", "status")) == {
        "OK": "PASS", "DRIFT": "PASS", "PRICE": "FAIL", "LATE": "FAIL", "EXTRA": "WARN"}
    strict = reconcile.reconcile(bars(spark, ours), bars(spark, theirs), volume_tol=1e-12)
    assert dict(rows(strict, "symbol", "status"))["DRIFT"] == "FAIL"
    assert reconcile.settled_range(10 * HOUR + 5, HOUR, 3) == (6 * HOUR, 9 * HOUR)


def test_labels(frame):
    row = frame([("A", 10 * BAR, 100.0, 0, 2, 0), ("B", 10 * BAR, 100.0, 0, 1, 0)], OI)
    labels = "symbol string, label_ms long, value double"
    good = reconcile.compare_labels(row, frame([("A", 11 * BAR, 100.0), ("B", 11 * BAR, 100.2)], labels), 0, 20 * BAR)
    assert rows(good, "symbol", "ok_calibrated", "ok_live", "status") == [("A", 1, 0, "PASS"), ("B", 0, 1, "PASS")]
    early = reconcile.compare_labels(row, frame([("A", 10 * BAR, 100.0)], labels), 0, 20 * BAR)
    assert rows(early, "missing", "status") == [(1, "FAIL")]
    off = reconcile.compare_labels(row, frame([("A", 11 * BAR, 100.0 * (1 + 1e-6))], labels), 0, 20 * BAR)
    assert rows(off, "mismatched", "status") == [(1, "FAIL")]
    skipped = reconcile.compare_labels(row, frame([("A", 30 * BAR, 1.0)], labels), 0, 20 * BAR)
    assert rows(skipped, "skipped", "status") == [(1, "WARN")]
    shifted = reconcile.shift_probe(row, frame([("A", 12 * BAR, 100.0), ("B", 11 * BAR, 100.0)], labels))
    assert rows(shifted) == [("A", 0, 1), ("B", 1, 0)]


def test_join_keeps_null_for_missing_oi(spark, frame):
    joined = panel.kline_with_oi(bars(spark, [bar("A", 0), bar("A", BAR)]), frame([("A", 0, 7.0, 0, 2, 0)], OI))
    assert rows(joined, "start_ms", "sum_open_interest") == [(0, 7.0), (BAR, None)]


def ratio_points(frame, starts):
    made = []
    for measure, labels in zip(S.RATIOS, starts):
        made += [("A", measure, t, float(S.RATIOS.index(measure) + 1)) for t in labels]
    return frame(made, "symbol string, measure string, label_ms long, ratio double")


def labels_between(a, b):
    return list(range(ms("2026-09-21 " + a), ms("2026-09-21 " + b) + 1, BAR))


def test_ratio_merge(frame):
    now = ms("2026-09-21 12:07:30")
    full = labels_between("11:05", "12:05")
    got = series.merge_ratio_series(ratio_points(frame, [full] * 3), now)
    assert got.count() == 13 and rows(got.select(*S.RATIOS).distinct()) == [(1.0, 2.0, 3.0)]
    short = labels_between("11:05", "12:00")
    bound = series.merge_ratio_series(ratio_points(frame, [short, short, full]), now)
    assert bound.count() == 12 and bound.agg(F.max("start_ms")).first()[0] == ms("2026-09-21 11:55")
    hole = [t for t in full if t != ms("2026-09-21 11:30")]
    holed = series.merge_ratio_series(ratio_points(frame, [full, hole, full]), now)
    assert rows(holed.where(F.col("start_ms") == ms("2026-09-21 11:25")), *S.RATIOS) == [(1.0, None, 3.0)]
    assert holed.count() == 13
    lacking = ratio_points(frame, [full, full, []])
    assert series.merge_ratio_series(lacking, now).count() == 0
    assert rows(series.held_back(lacking), "symbol") == [("A",)]


def test_resume_plan(frame):
    now = ms("2026-09-21 12:07:30")
    universe = frame([(s,) for s in ("COLD", "OLD", "CURRENT", "BEHIND")], "symbol string")
    target = ms("2026-09-21 11:55")
    marks = frame([("OLD", now - 20 * DAY), ("CURRENT", target), ("BEHIND", target - 3 * BAR)],
                  "symbol string, calibrated_ms long")
    plan = series.resume_plan(universe, marks, now).collect()
    by = {r.symbol: r for r in plan}
    noon = ms("2026-09-21 12:05")
    assert (by["COLD"].since_ms, by["COLD"].needed, by["COLD"].fresh) == (noon - 48 * HOUR, 576, True)
    assert (by["OLD"].since_ms, by["OLD"].beyond_cap) == (noon - 168 * HOUR, True)
    assert by["CURRENT"].decision == "current" and by["CURRENT"].since_ms is None
    assert by["BEHIND"].needed == 5
    assert [r.symbol for r in plan] == ["OLD", "COLD", "BEHIND", "CURRENT"]
    full = {r.symbol: r for r in series.resume_plan(universe, marks, now, full=True).collect()}
    assert full["CURRENT"].since_ms == noon - 490 * BAR and full["COLD"].needed == 576


def test_resume_klines(frame):
    universe = frame([("A",), ("B",), ("C",)], "symbol string")
    marks = frame([("A", 5 * MIN), ("C", 9 * MIN)], "symbol string, mark_ms long")
    assert rows(series.resume_klines(universe, marks, 10 * MIN, MIN, cold_start_ms=2 * MIN)) == [
        ("A", 6 * MIN, 10 * MIN), ("B", 2 * MIN, 10 * MIN)]
    since = rows(series.resume_klines(universe, marks, 10 * MIN, MIN, since_ms=4 * MIN), "symbol", "from_ms")
    assert ("B", 3 * MIN) in since


def live_record(symbol, **over):
    made = dict(t="0", o="10", h="11", l="9", c="10", v="1", qv="1", tbv="0", tbqv="0", n="5", x="0")
    made.update(over)
    return (symbol, *[made[k] for k in windows.LIVE_FIELDS])


def test_live_validation(frame):
    records = frame([live_record("OK"), live_record("FIELD", qv=None), live_record("HL", h="8"), live_record("NUM", o="x"),
                     live_record("FLAG", x="2"), live_record("FUTURE", t="60000")],
                    "symbol string, " + ", ".join(f"{k} string" for k in windows.LIVE_FIELDS))
    names = ["OK", "FIELD", "HL", "NUM", "FLAG", "FUTURE", "GONE"]
    universe = frame([(s,) for s in names], "symbol string")
    got = dict(rows(windows.validate_live(records, universe, MIN, 30_000), "symbol", "status"))
    assert got == {"OK": "PASS", "FIELD": "CORRUPT", "HL": "CORRUPT", "NUM": "CORRUPT", "FLAG": "CORRUPT",
                   "FUTURE": "WARN", "GONE": "MISSING"}
    old = dict(rows(windows.validate_live(records, universe, MIN, 130_000), "symbol", "status"))
    assert old["OK"] == "STALE"


def served(frame, starts, broken=()):
    text = [f"[{t},10.0,11.0,9.0,10.0,1.0,1.0,0.5,0.5,3]" for t in starts] + list(broken)
    return frame([("A", i, p) for i, p in enumerate(text)], "symbol string, pos int, payload string")


def test_window_inspection(frame):
    now = 100 * MIN + 5
    newest = 99 * MIN
    good = windows.inspect_window(served(frame, [newest - i * MIN for i in range(5)]), MIN, now, 5).first()
    assert (good.status, good.head_lag, good.gaps) == ("PASS", 0, 0)
    holed = windows.inspect_window(served(frame, [newest - i * MIN for i in (0, 1, 3)]), MIN, now, 3).first()
    assert (holed.status, holed.gaps, holed.missing) == ("FAIL", 1, 1)
    short = windows.inspect_window(served(frame, [newest]), MIN, now, 5).first()
    stale = windows.inspect_window(served(frame, [newest - 3 * MIN]), MIN, now, 1).first()
    lag = windows.inspect_window(served(frame, [newest - MIN]), MIN, now, 1).first()
    assert (short.status, stale.status, lag.status) == ("SHORT", "STALE", "WARN")
    mixed = windows.inspect_window(served(frame, [newest - MIN, newest]), MIN, now, 2).first()
    assert (mixed.status, mixed.corrupt) == ("FAIL", 1)
    faults = windows.validate_compact(served(frame, [], ["[1,2]", "{}", '[1,"x",1,1,1,1,1,1,1,1]', "[1,1,1,2,1,1,1,1,1,1]"]))
    assert [r.fault for r in faults.orderBy("pos").collect()][:1] == ["wrong_length"]
    assert {r.fault for r in faults.collect()} >= {"wrong_length", "not_a_number", "high_below_low"}


def test_bars_without_a_symbol_are_no_window_of_the_universe(frame):
    newest = 99 * MIN
    held = served(frame, [newest, newest - MIN], ["[1]"])
    both = held.unionByName(held.selectExpr("CAST(NULL AS string) AS symbol", "pos", "payload"))
    universe = frame([("A",), ("B",), (None,)], "symbol string")
    got = windows.inspect_window(both, MIN, 100 * MIN, 3, universe)
    assert rows(got, "symbol", "length", "head_ms", "gaps", "corrupt", "status") == [
        ("A", 3, newest, 0, 1, "FAIL"), ("B", 0, None, 0, 0, "EMPTY"), (None, 0, None, 0, 0, "EMPTY")]
    # with no universe they are listed as they are
    alone = windows.inspect_window(both, MIN, 100 * MIN, 3).where("symbol IS NULL").first()
    assert (alone.length, alone.head_ms, alone.tail_ms, alone.corrupt, alone.status) == (3, newest, newest - MIN, 1, "FAIL")


def test_positional_reconciliation(spark, frame):
    base = bars(spark, [bar("A", i * MIN) for i in range(5)])
    columns = "symbol string, pos int, t long, o double, h double, l double, c double, v double, qv double"
    listed = [("A", i, (4 - i) * MIN, 10.0, 10.0, 10.0, 10.0, 1.0, 10.0) for i in range(5)]
    assert reconcile.reconcile_positional(frame(listed, columns), base, 5).first().status == "PASS"
    assert reconcile.reconcile_positional(frame(listed[:4], columns), base, 5).first().status == "WARN"
    wrong = [("A", 0, 4 * MIN, 10.0, 10.0, 10.0, 10.5, 9.0, 10.0), *listed[1:]]
    row = reconcile.reconcile_positional(frame(wrong, columns), base, 5).first()
    assert (row.status, row.price, row.volume) == ("FAIL", 1, 0)
    none = reconcile.reconcile_positional(frame([], columns), base, 5).first()
    assert (none.status, none.cached) == ("FAIL", 0)


def test_oi_report_sections(spark, frame):
    day = list(oi_day().values())
    kl = bars(spark, [bar("A", LO + i * BAR) for i in range(288)])
    now = HI + 2 * BAR
    labels = frame([("A", LO + BAR, 10.0)], "symbol string, label_ms long, value double")
    report = reports.oi_report(frame(day, OI), kl, now, settle_minutes=0, labels=labels, tail=True)
    outcome = {r["check"]: r.status for r in reports.report_outcome(report).collect()}
    assert outcome == {"freshness": "PASS", "series": "PASS", "by_symbol": "PASS", "by_bar": "PASS",
                       "labels": "WARN", "overall": "PASS"}
    # the window ends one bar after the newest row
    assert rows(report["gaps"], "from_ms", "missing_count") == [(HI + BAR, 1)]
    holed = reports.oi_report(frame(day[:100] + day[101:], OI), kl, now, settle_minutes=0)
    assert {r["check"]: r.status for r in reports.report_outcome(holed).collect()}["overall"] == "FAIL"
    assert rows(holed["by_bar"].where("status = 'FAIL'"), "start_ms") == [(LO + 100 * BAR,)]


def test_cross_sections_and_samples(spark):
    base = bars(spark, [bar("A", 0, 1.0), bar("B", 0, 2.0), bar("C", MIN, 3.0)])
    assert [r.symbol for r in panel.cross_section(base, 0).collect()] == ["B", "A"]
    assert rows(panel.sample_symbols(base, 2), "symbol") == [("A",), ("B",)]
    assert [r.start_ms for r in panel.newest_n(bars(spark, [bar("A", i) for i in range(5)]), "A", 2).collect()] == [4, 3]
