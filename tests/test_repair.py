from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import gaps, rollup, versions
from candlemill.operators.rollup import rollup_klines
from candlemill.plans import refresh, repair
from candlemill.sources import facts
from helpers import BAR, DAY, MIN, OI, bar, bars, ms, rows

RANGE = "symbol string, from_ms long, to_ms long"
POINTS = "symbol string, label_ms long, value double"


def test_repair_fills_only_wanted_absent_closed_bars(spark, frame):
    gap = frame([("A", 0, 4 * MIN)], RANGE)
    held = bars(spark, [bar("A", MIN)])
    offered = bars(spark, [bar("A", 0), bar("A", 2 * MIN), bar("A", 5 * MIN)])
    now = 10 * MIN
    assert rows(repair.repair_bars(gap, held, offered, now), "start_ms") == sorted([(0,), (2 * MIN,)], key=repr)
    assert rows(repair.repair_stats(gap, held, offered, now)) == [("A", 4, 1, 2, 1)]
    # the bar now forming is not repaired
    assert rows(repair.repair_bars(gap, held, offered, 2 * MIN + 30_000), "start_ms") == [(0,)]


def test_replace_live_never_touches_calibrated_rows(frame):
    t = ms("2026-09-21 12:00")
    raw = frame([("A", t, 1.0, t, 1, 1), ("A", t + BAR, 1.0, t, 1, 2), ("A", t + BAR, 2.0, t, 3, 3),
                 ("A", t + 2 * BAR, 1.0, t, 1, 4)], OI)
    points = frame([("A", t + BAR, 9.0), ("A", t + 2 * BAR, 9.0), ("A", t + 3 * BAR, float("nan")),
                    ("A", t + BAR + 1, 5.0)], POINTS)
    got = repair.replace_live(raw, points, t + DAY)
    assert rows(got, "start_ms", "sum_open_interest", "snap_ms", "src_rank") == [(t, 9.0, t + BAR, 2)]


def test_gap_oi_repair_respects_retention(frame):
    now = 40 * DAY
    holes = frame([("A", 0, 3 * BAR), ("A", 39 * DAY, 39 * DAY + 3 * BAR)], RANGE)
    raw = frame([("A", 39 * DAY + BAR, 1.0, 0, 2, 1)], OI)
    points = frame([("A", t + BAR, 4.0) for t in (0, 39 * DAY, 39 * DAY + BAR, 39 * DAY + 9 * BAR)], POINTS)
    assert rows(repair.repair_gap_oi(holes, raw, points, now, 30 * DAY), "start_ms") == [(39 * DAY,)]
    assert rows(repair.repair_gap_oi(holes, raw, points, now), "start_ms") == [(0,), (39 * DAY,)]
    told = repair.oi_repair_stats(holes, raw, points, now, 30 * DAY).first()
    assert told[1:] == (6, 3, 1, 1, 1, 0, 0)


def test_sweep_reaches_the_last_symbol(spark, frame):
    now, base = ms("2026-09-21 12:00:30"), ms("2026-09-21 10:00")
    held = bars(spark, [bar(f"S{k:04d}", base + i * MIN) for k in range(1_001) for i in (0, 2)])
    failed = frame([(f"S{k:04d}", base + MIN) for k in range(1_000)], "symbol string, from_ms long")
    empty = frame([], "symbol string, from_ms long, expires_ms long")
    found, outcome, _ = repair.sweep(held, bars(spark, [bar("S1000", base + MIN)]), empty, now, failed=failed)
    assert rows(found, "symbol") == [("S1000",)] and outcome.count() == 1_001


def archive_table(frame, folder, cutoff):
    made = [("A", cutoff + i * BAR, float(i), cutoff + (i + 1) * BAR, 3, i) for i in range(-5, 20)]
    made += [("A", cutoff + 30 * BAR, 7.0, cutoff + 31 * BAR, 2, 99)]
    path = folder("archive")
    facts.append_facts(frame(made, OI), path)
    return path


def test_archive_shift_runs_once_and_resumes(spark, frame, folder):
    cutoff = ms("2024-03-31 23:55")
    path, log = archive_table(frame, folder, cutoff), folder("log")
    before = rows(facts.read_facts(spark, path, S.OI_5M), "start_ms", "src_rank")
    assert repair.repair_archive_shift(spark, path, log, cutoff, 1) is True
    moved = facts.read_facts(spark, path, S.OI_5M)
    want = [(t + BAR if r == 3 and t >= cutoff - BAR else t, r) for t, r in before]
    assert rows(moved, "start_ms", "src_rank") == sorted(want, key=repr)
    assert moved.where("src_rank = 3 AND snap_ms - start_ms != 300000").count() == 0
    after = rows(moved)
    assert repair.repair_archive_shift(spark, path, log, cutoff, 2) is False
    # a crash after the rewrite but before its mark: the rerun lands on the same table
    resumed = repair.RepairLog(spark, folder("log2"))
    spark.read.schema(S.OI_5M).parquet(f"{log}/backup").write.parquet(resumed.backup)
    resumed.mark("backup", 1)
    assert repair.repair_archive_shift(spark, path, resumed.folder, cutoff, 3) is True
    assert rows(facts.read_facts(spark, path, S.OI_5M)) == after
    # no trace of an unshifted edge and no log: refuse
    with pytest.raises(repair.RepairRefused):
        repair.repair_archive_shift(spark, path, folder("log3"), cutoff, 4)


def test_off_grid_repair_and_refold(spark, frame, folder):
    base = ms("2024-03-31 23:50")
    made = [("A", base, 1.0, base + BAR, 3, 1), ("A", base + 7_000, 2.0, base + 7_000 + BAR, 3, 2),
            ("A", base + BAR - 3_000, 3.0, 0, 3, 3), ("A", base + BAR + 9_000, 4.0, 0, 3, 4),
            ("A", base + 3 * BAR - 1_000, 5.0, 0, 3, 5)]
    path, log = folder("offgrid"), folder("log")
    facts.append_facts(frame(made, OI), path)
    plan = repair.repair_off_grid(spark, path, log, 1)
    assert sorted(r.action for r in plan.collect()) == ["drop_collision", "drop_slot_taken", "move", "move"]
    got = rows(facts.read_facts(spark, path, S.OI_5M), "start_ms", "sum_open_interest", "snap_ms")
    assert got == sorted([(base, 1.0, base + BAR), (base + BAR, 3.0, base + 2 * BAR),
                          (base + 3 * BAR, 5.0, base + 4 * BAR)], key=repr)
    repair.repair_off_grid(spark, path, log, 2)
    assert rows(facts.read_facts(spark, path, S.OI_5M), "start_ms", "sum_open_interest", "snap_ms") == got
    target = folder("rollup")
    wrong = rollup.rollup_oi(frame(made, OI), "15m").withColumn("version", F.lit(0).cast("long"))
    facts.append_facts(wrong, target)
    repair.checked_refold(spark, path, {"15m": target}, [202403, 202404], 5)
    fold = spark.read.parquet(target)
    assert fold.agg(F.sum("samples")).first()[0] == 3 and {r.version for r in fold.collect()} == {5}


def test_sweeps_remember_what_they_found_empty(spark, frame, folder):
    now, base = ms("2026-09-21 12:00:30"), ms("2026-09-21 10:00")
    path, memory, log = folder("swept"), folder("memory"), folder("log")
    held = bars(spark, [bar("A", base + i * MIN) for i in range(30) if i not in (3, 4, 10)] + [bar("A", ms("2026-01-05") + i * MIN) for i in range(3)])
    facts.append_facts(held, path)
    offered = bars(spark, [bar("A", base + 3 * MIN)]).withColumn("month", F.lit(202609))
    first = repair.sweep_job(spark, path, offered, memory, log, now)
    assert rows(first, "from_ms", "fetched", "outcome") == sorted([(base + 3 * MIN, 1, "repaired"), (base + 10 * MIN, 0, "empty")], key=repr)
    # what is left of the repaired hole is asked for, what was empty isn't, until its time is over
    second = repair.sweep_job(spark, path, offered, memory, log, now + MIN)
    assert rows(second, "from_ms", "outcome") == [(base + 4 * MIN, "empty")]
    assert repair.sweep_job(spark, path, offered, memory, log, now + 2 * MIN).count() == 0
    later = repair.sweep_job(spark, path, offered, memory, log, now + (12 * 60 + 2) * MIN)
    assert sorted(r.from_ms for r in later.collect()) == [base + 4 * MIN, base + 10 * MIN]
    assert facts.read_facts(spark, path, S.BARS_1M).count() == 31
    # a memory that wasn't written to its end isn't read
    frame([("A", 1, 2**60)], "symbol string, from_ms long, expires_ms long").coalesce(1).write.parquet(f"{memory}/at=9")
    from candlemill.session import remove
    remove(spark, f"{memory}/at=9/_SUCCESS")
    assert repair.read_memory(spark, memory).where("from_ms = 1").count() == 0


def test_repairs_read_the_months_of_their_ranges(spark, frame, folder):
    path = folder("pruned")
    facts.append_facts(bars(spark, [bar("A", ms(f"2024-{m:02d}-03") + i * MIN) for m in range(1, 7) for i in (0, 2)]), path)
    table = facts.read_facts(spark, path, S.BARS_1M)
    hole = frame([("A", ms("2024-03-03") + MIN, ms("2024-03-03") + 2 * MIN)], RANGE)
    now = ms("2024-07-01")
    for df in (repair.repair_bars(hole, table, table, now), repair.repair_stats(hole, table, table, now)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "202403" in plan
    assert rows(repair.repair_stats(hole, table, table, now)) == [("A", 1, 0, 0, 1)]
    snaps = folder("snaps")
    facts.append_facts(frame([("A", ms(f"2024-{m:02d}-03"), 1.0, 0, 1, m) for m in range(1, 7)], OI), snaps)
    raw = facts.read_facts(spark, snaps, S.OI_5M)
    points = frame([("A", ms("2024-05-03") + BAR, 4.0)], POINTS)
    gap = frame([("A", ms("2024-05-03"), ms("2024-05-03") + 2 * BAR)], RANGE)
    for df in (repair.replace_live(raw, points, now), repair.repair_gap_oi(gap, raw, points, now)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "202405" in plan and "202403" not in plan
    assert rows(repair.replace_live(raw, points, now), "start_ms") == [(ms("2024-05-03"),)]


def test_presence_words_are_sets_of_bars(spark, frame):
    import random

    from candlemill.operators import presence, ranges

    rng = random.Random(7)
    asked = [("AB"[rng.random() < 0.4], a * MIN, (a + rng.randrange(1, 200)) * MIN) for a in (rng.randrange(0, 3_000) for _ in range(30))] + [("A", 7, 5), ("B", 130 * MIN + 1, 130 * MIN + 2)]
    held = {("AB"[rng.random() < 0.5], rng.randrange(0, 3_200) * MIN) for _ in range(1_500)}
    want = {(s, t) for s, a, b in asked for t in range(-(-a // MIN) * MIN, b, MIN)}
    words = presence.range_words(frame(asked, RANGE), MIN)
    assert words.agg(F.sum(F.bit_count("bits"))).first()[0] == len(want)
    left = ranges.subtract_present(frame(asked, RANGE), bars(spark, [bar(s, t) for s, t in held]), MIN).collect()
    got = [(r.symbol, t) for r in left for t in range(r.from_ms, r.to_ms, MIN)]
    assert set(got) == want - held and len(got) == len(set(got))
    assert all((r.symbol, r.to_ms) not in set(got) for r in left)  # runs are joined across words
    # ten years of minutes are 87,600 words, not 5 million rows
    years = presence.range_words(frame([("A", 0, 3_650 * DAY)], RANGE), MIN)
    assert years.count() == 87_600 and years.agg(F.sum(F.bit_count("bits"))).first()[0] == 3_650 * 1_440


class Crash(Exception):
    pass


def broken_at(*steps):
    """Breaks once at each of the steps."""
    left = list(steps)

    def between(at):
        if at in left:
            left.remove(at)
            raise Crash(at)
    return between


def rollup_of(spark, path, target):
    facts.append_facts(rollup.rollup_oi(versions.latest_snapshots(facts.read_facts(spark, path, S.OI_5M)), "1h").withColumn(
        "version", F.lit(0).cast("long")), target)
    return {"1h": target}


def two_months(frame, folder):
    """Archive rows around the end of a month, some off the grid, a bucket that is to lose its only row."""
    cutoff = ms("2024-03-31 23:55")
    made = [("A", cutoff + i * BAR, float(i), cutoff + (i + 1) * BAR, 3, i) for i in (-2, -1, 0, 1, 2, 7, 23)]
    made += [("B", cutoff + 40 * BAR - 1_000, 5.0, cutoff + 41 * BAR, 3, 50), ("A", cutoff + 90 * BAR, 7.0, cutoff + 91 * BAR, 2, 99)]
    path = folder("two-months")
    facts.append_facts(frame(made, OI), path)
    return path, cutoff


@pytest.mark.parametrize("kind", ["shift", "grid"])
def test_repairs_resume_after_every_step(spark, frame, folder, kind):
    """A run that breaks behind each step in turn, each time on what the last one left, ends like one that doesn't."""
    steps = ["backup", *["planned"] * (kind == "grid"), "expected", "written", "moved", "refolded"]
    ends = []
    for between in (broken_at(), broken_at(*steps)):
        path, cutoff = two_months(frame, folder)
        levels, log, crashes = rollup_of(spark, path, folder("hours")), folder("log"), 0
        while True:
            try:
                if kind == "shift":
                    repair.repair_archive_shift(spark, path, log, cutoff, 9, rollup_paths=levels, between=between)
                else:
                    repair.repair_off_grid(spark, path, log, 9, levels, between)
                break
            except Crash:
                crashes += 1
        hours = spark.read.parquet(levels["1h"])
        ends.append((rows(facts.read_facts(spark, path, S.OI_5M)), rows(hours)))
        assert 9 in {r.version for r in hours.collect()}
    assert ends[0] == ends[1] and crashes == len(steps)


@pytest.mark.parametrize("step", ["expected", "written"])
def test_a_row_that_changed_meanwhile_stops_the_repair(spark, frame, folder, step):
    path, cutoff = two_months(frame, folder)
    log = folder("log")
    with pytest.raises(Crash):
        repair.repair_archive_shift(spark, path, log, cutoff, 9, between=broken_at(step))
    facts.append_facts(frame([("C", cutoff + 3 * BAR, 1.0, cutoff + 4 * BAR, 2, 7)], OI), path)
    before = rows(facts.read_facts(spark, path, S.OI_5M))
    with pytest.raises(repair.RepairRefused):
        repair.repair_archive_shift(spark, path, log, cutoff, 9)
    assert rows(facts.read_facts(spark, path, S.OI_5M)) == before


def test_a_repair_refuses_other_layouts_and_short_rollups(spark, frame, folder):
    path, cutoff = two_months(frame, folder)
    other = folder("other")
    facts.append_facts(spark.read.parquet(path).drop("month", "src_rank"), other)
    for run in (lambda: repair.repair_archive_shift(spark, other, folder("log"), cutoff, 9), lambda: repair.repair_off_grid(spark, other, folder("log"), 9),
                lambda: facts.compact(spark, other, S.OI_5M, S.BAR_KEYS, ["src_rank"]), lambda: facts.delete_where(spark, other, S.OI_5M, F.lit(True))):
        with pytest.raises(facts.LayoutError):
            run()
    target = folder("short")
    facts.append_facts(frame([("Z", cutoff, 1, 1.0, 1.0, 1.0, 0)], "symbol string, start_ms long, samples long, close double, high double, low double, version long"), target)
    base = versions.latest_snapshots(facts.read_facts(spark, path, S.OI_5M))
    repair.checked_refold(spark, path, {"1h": target}, [202403, 202404], 5)
    assert rows(spark.read.parquet(target).groupBy().agg(F.sum("samples"))) == [(base.count(),)]


def test_fingerprint_tells_rows_and_copies_not_their_order(frame):
    one = frame([("A", 1), ("B", 2), ("B", 2)], "s string, n long")
    assert repair.fingerprint(one, ["s", "n"]) == repair.fingerprint(one.orderBy(F.desc("n")), ["s", "n"])
    for other in ([("A", 1), ("B", 2)], [("A", 1), ("A", 1), ("B", 2)], [("A", 1), ("B", 2), ("B", 3)]):
        assert repair.fingerprint(frame(other, "s string, n long"), ["s", "n"]) != repair.fingerprint(one, ["s", "n"])


def test_refold_drops_buckets_that_lost_their_rows(spark, frame, folder):
    jan, feb, mar = ms("2024-01-01"), ms("2024-02-01"), ms("2024-03-01")
    rows_ = frame([("A", jan, 1.0, 0, 3, 1), ("A", feb, 1.0, 0, 3, 2), ("A", mar, 1.0, 0, 3, 3)], OI)
    path = folder("refold")
    facts.append_facts(rollup.rollup_oi(rows_, "1h").withColumn("version", F.lit(1).cast("long")), path)
    refresh.apply_refold(rows_.where(F.col("start_ms") != jan), rollup.rollup_oi, path, "1h", jan, mar, 2)
    assert rows(spark.read.parquet(path), "start_ms", "version") == sorted([(feb, 2), (mar, 1)], key=repr)


def test_delete_and_upsert(spark, folder):
    path = folder("mutate")
    a, b = ms("2024-01-05"), ms("2024-02-05")
    facts.append_facts(bars(spark, [bar("A", a), bar("A", b), bar(None, b)]), path)
    facts.delete_where(spark, path, S.BARS_1M, F.col("symbol") == "A")
    # a row whose predicate is unknown stays, an emptied month vanishes
    assert rows(facts.read_facts(spark, path, S.BARS_1M), "symbol", "month") == [(None, 202402)]
    new = bars(spark, [bar("A", a, 5.0, version=2)])
    for _ in range(2):
        facts.upsert_partitions(new, path, S.BARS_1M, S.BAR_KEYS, ["version", "ingest_seq"])
    facts.upsert_partitions(bars(spark, [bar("A", a, 4.0, version=1)]), path, S.BARS_1M, S.BAR_KEYS,
                            ["version", "ingest_seq"])
    assert rows(facts.read_facts(spark, path, S.BARS_1M).where("symbol = 'A'"), "close", "version") == [(5.0, 2)]


def test_prune_and_pending(frame):
    keys = "symbol string, start_ms long"
    old, fresh = frame([("A", 0), ("A", 60), ("A", 900)], keys), frame([("A", 0)], keys)
    assert rows(versions.prune_orphans(old, fresh, 0, 100)) == [("A", 60)]
    assert rows(versions.pending_work(old, fresh, ["symbol", "start_ms"])) == [("A", 60), ("A", 900)]


def test_sweep_outcomes(spark, frame):
    now = ms("2026-09-21 12:00:30")
    base = ms("2026-09-21 10:00")
    held = bars(spark, [bar("A", base + i * MIN) for i in (0, 2, 4, 6, 7)])
    offered = bars(spark, [bar("A", base + MIN)])
    empty = frame([], "symbol string, from_ms long, expires_ms long")
    failed = frame([("A", base + 5 * MIN)], "symbol string, from_ms long")
    found, outcome, memory = repair.sweep(held, offered, empty, now, failed=failed)
    assert rows(found, "start_ms") == [(base + MIN,)]
    assert dict(rows(outcome, "from_ms", "outcome")) == {
        base + MIN: "repaired", base + 3 * MIN: "empty", base + 5 * MIN: "failed"}
    assert rows(memory, "from_ms") == [(base + 3 * MIN,)]
    # the empty range is left alone until its memory expires
    _, again, kept = repair.sweep(held, offered, memory, now + MIN)
    assert (base + 3 * MIN) not in {r.from_ms for r in again.collect()} and kept.count() == 2
    _, later, _ = repair.sweep(held, offered, memory, now + 13 * 60 * MIN, window_ms=2 * DAY)
    assert (base + 3 * MIN) in {r.from_ms for r in later.collect()}


def pruned(df) -> bool:
    """Whether the scan is bound to some months."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return all("month" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])


def test_jobs_read_only_their_months(spark, folder):
    path, now = folder("months"), ms("2026-09-21 12:00")
    made = [bar("A", ms(f"2026-0{m}-10 00:00") + i * MIN) for m in range(1, 10) for i in range(3)]
    facts.append_facts(bars(spark, made), path)
    table = facts.read_facts(spark, path, S.BARS_1M)
    assert facts.months_in(spark, path) == list(range(202601, 202610))
    fresh = refresh.refresh_rollup(refresh.versions_of(table), rollup_klines, now, "1h", 10)
    assert pruned(fresh) and fresh.count() == 0
    lo, hi = tg.month_bounds("2026-03")
    old = refresh.refold(refresh.versions_of(table), rollup_klines, "1h", lo, hi)
    assert pruned(old) and old.count() == 1
    assert pruned(gaps.find_gaps(table, MIN, lo, hi)) and pruned(facts.scan_bars(spark, path, from_ms=lo))


def test_first_refresh_makes_its_table(spark, folder):
    path, now = folder("first"), ms("2026-09-21 12:00")
    rows_ = bars(spark, [bar("A", ms("2026-09-20 00:00") + i * MIN) for i in range(90)])
    for _ in range(2):
        refresh.apply_refresh(rows_, rollup_klines, path, now, "1h", 10)
    assert facts.read_facts(spark, path, S.BARS).count() == 2
