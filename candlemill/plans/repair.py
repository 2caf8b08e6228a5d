"""Filling holes and correcting rows in place.

Nothing here talks to an exchange: repairs draw on a landed table of candidate
rows, and write only through ``sources.facts``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx
from candlemill.operators import filters, gaps, presence, ranges, snap, versions
from candlemill.operators.rollup import rollup_oi
from candlemill.plans import refresh
from candlemill.session import exists, materialize, newest_whole, remove, scratch_path
from candlemill.sources import facts


def _one_each(candidates: DataFrame) -> DataFrame:
    """The candidate that landed last per bar; without a landing order the greatest in all columns."""
    landed = [c for c in ("version", "ingest_seq") if c in candidates.columns]
    rest = sorted(set(candidates.columns) - {*S.BAR_KEYS, *landed})
    return versions.latest_by_version(candidates, S.BAR_KEYS, [*landed, *rest])


def repair_bars(gap_ranges: DataFrame, bars: DataFrame, candidates: DataFrame, now_ms: int,
                step: int = tg.MINUTE_MS) -> DataFrame:
    """Closed candidate bars that fill a hole; not yet written anywhere."""
    closed_before = tg.floor_to(now_ms, step)
    due = gap_ranges.where(F.col("from_ms") < closed_before).withColumn(
        "to_ms", F.least("to_ms", F.lit(closed_before)))
    closed = ranges.in_months_of(candidates, due).where(F.col("end_ms") < now_ms)
    fitting = ranges.wanted_bars(closed, ranges.merge_ranges(due))
    absent = fitting.join(ranges.in_months_of(bars, due).select(*S.BAR_KEYS), S.BAR_KEYS, "left_anti")
    return _one_each(absent)


def repair_stats(gap_ranges: DataFrame, bars: DataFrame, candidates: DataFrame, now_ms: int,
                 step: int = tg.MINUTE_MS) -> DataFrame:
    """Per symbol: bars asked for, already there, found and not found; bars are those on the grid of ``step``.

    Ranges, bars and candidates meet as words of 60 bars; no row stands for a single bar that is asked for.
    """
    closed_before = tg.floor_to(now_ms, step)
    due = (gap_ranges.where(F.col("from_ms") < closed_before)
           .select("symbol", "from_ms", F.least("to_ms", F.lit(closed_before)).alias("to_ms")))
    have = presence.bar_words(ranges.in_months_of(bars, due), step)
    offered = presence.bar_words(ranges.in_months_of(candidates, due).where(F.col("end_ms") < now_ms), step)
    words = presence.compared(presence.range_words(due, step), have, offered)
    asked, here, found = (F.col(c) for c in ("bits", "bits_1", "bits_2"))
    absent = presence.without_bits(asked, here)
    counts = {"requested": asked, "present": asked.bitwiseAND(here), "fetched": absent.bitwiseAND(found), "empty": presence.without_bits(absent, found)}
    return words.groupBy("symbol").agg(*[F.sum(F.bit_count(c)).alias(n) for n, c in counts.items()])


def oldest_offered(now_ms: int, retention_ms: int | None) -> int | None:
    """First bar that a source of limited memory still has; a landed table has no such limit."""
    return None if retention_ms is None else tg.floor_to(now_ms - retention_ms, tg.BAR_MS) + tg.BAR_MS


def _offered_oi(candidates: DataFrame, now_ms: int) -> DataFrame:
    """Usable history points by bar, the one that landed last."""
    value = F.col("value")
    points = filters.label_to_bar(candidates, now_ms).where(fx.finite(value) & (value >= 0))
    return _one_each(points).withColumnRenamed("value", "sum_open_interest")


def replace_live(raw_oi: DataFrame, candidates: DataFrame, now_ms: int,
                 retention_ms: int | None = None) -> DataFrame:
    """History rows for on-grid bars whose best row is still a live one.

    ``candidates`` holds ``symbol, label_ms, value``. Rows of rank 2 or 3 are
    never touched. ``retention_ms`` is for a source that forgets. Of a table that
    carries its month only those of the candidates are read.
    """
    raw_oi = ranges.in_months_at(raw_oi, candidates.select((F.col("label_ms") - tg.BAR_MS).alias("ms")))
    end = tg.floor_to(now_ms, tg.BAR_MS)
    reachable = filters.within(filters.on_grid(raw_oi, tg.BAR_MS), oldest_offered(now_ms, retention_ms), end)
    best = versions.latest_snapshots(reachable)
    live = best.where(F.col("src_rank") == S.RANK_LIVE).select(*S.BAR_KEYS)
    return live.join(_offered_oi(candidates, now_ms), S.BAR_KEYS, "inner").select(
        *S.BAR_KEYS, "sum_open_interest", (F.col("start_ms") + tg.BAR_MS).alias("snap_ms"),
        F.lit(S.RANK_HIST).alias("src_rank"))


def _due_oi(gap_ranges: DataFrame, now_ms: int) -> DataFrame:
    """The part of the ranges that has closed."""
    end = tg.floor_to(now_ms, tg.BAR_MS)
    return gap_ranges.where(F.col("from_ms") < end).select(
        "symbol", "from_ms", F.least("to_ms", F.lit(end)).alias("to_ms"))


def repair_gap_oi(gap_ranges: DataFrame, raw_oi: DataFrame, candidates: DataFrame, now_ms: int,
                  retention_ms: int | None = None) -> DataFrame:
    """History rows that fill missing open-interest bars.

    ``retention_ms`` is for a source that forgets; what it cuts off is counted by
    :func:`oi_repair_stats`.
    """
    due = _due_oi(gap_ranges, now_ms)
    oldest = oldest_offered(now_ms, retention_ms)
    if oldest is not None:
        due = ranges.clip_ranges(due, oldest, tg.BAR_MS).where(F.col("kept_from_ms").isNotNull()).select(
            "symbol", F.col("kept_from_ms").alias("from_ms"), F.col("kept_to_ms").alias("to_ms"))
    fitting = ranges.wanted_bars(_offered_oi(candidates, now_ms), due)
    here = filters.on_grid(ranges.in_months_of(raw_oi, due), tg.BAR_MS).select(*S.BAR_KEYS)
    absent = fitting.join(here, S.BAR_KEYS, "left_anti")
    return absent.select(
        *S.BAR_KEYS, "sum_open_interest", (F.col("start_ms") + tg.BAR_MS).alias("snap_ms"),
        F.lit(S.RANK_HIST).alias("src_rank"))


def oi_repair_stats(gap_ranges: DataFrame, raw_oi: DataFrame, candidates: DataFrame, now_ms: int,
                    retention_ms: int | None = None) -> DataFrame:
    """Per symbol what became of the missing bars and of the live rows.

    Bars of the ranges: ``requested``, of them ``beyond_retention``, else
    ``present`` already, ``fetched`` or ``not_at_source``. On-grid bars whose best
    row is live: ``live_rows``, of them ``live_replaced``.
    """
    oldest = oldest_offered(now_ms, retention_ms)
    wanted = ranges.range_bars(ranges.merge_ranges(_due_oi(gap_ranges, now_ms)), tg.BAR_MS)
    have = filters.on_grid(raw_oi, tg.BAR_MS).select(*S.BAR_KEYS).distinct().withColumn("_have", F.lit(True))
    offered = _offered_oi(candidates, now_ms).select(*S.BAR_KEYS).withColumn("_offered", F.lit(True))
    gone = F.lit(False) if oldest is None else F.col("start_ms") < oldest
    present, found = F.col("_have").isNotNull(), F.col("_offered").isNotNull()
    holes = wanted.join(have, S.BAR_KEYS, "left").join(offered, S.BAR_KEYS, "left").select(
        "symbol", F.lit(True).alias("requested"), gone.alias("beyond_retention"), (~gone & present).alias("present"),
        (~gone & ~present & found).alias("fetched"), (~gone & ~present & ~found).alias("not_at_source"),
        F.lit(False).alias("live_rows"), F.lit(False).alias("live_replaced"))
    no = [F.lit(False).alias(c) for c in holes.columns[1:6]]
    best = versions.latest_snapshots(filters.on_grid(raw_oi, tg.BAR_MS)).where(F.col("src_rank") == S.RANK_LIVE)
    replaced = replace_live(raw_oi, candidates, now_ms, retention_ms).select(*S.BAR_KEYS, F.lit(True).alias("_new"))
    live = best.select(*S.BAR_KEYS).join(replaced, S.BAR_KEYS, "left").select(
        "symbol", *no, F.lit(True).alias("live_rows"), F.col("_new").isNotNull().alias("live_replaced"))
    return holes.unionByName(live).groupBy("symbol").agg(*[F.count_if(c).alias(c) for c in holes.columns[1:]])


# --- repairs that rewrite a table --------------------------------------------

def fingerprint(df: DataFrame, columns: list[str]) -> tuple[int, int]:
    """Number of the rows and sum of their hashes: equal for the same rows in any order, copies counted."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


class RepairRefused(RuntimeError):
    """The table does not look as the repair expects."""


class RepairLog:
    """Steps a repair has finished, kept next to its backup so that it can resume, each with what it saw."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.backup = f"{self.folder}/backup"
        self.plan = f"{self.folder}/plan"

    def done(self, step: str) -> bool:
        return exists(self.spark, f"{self.folder}/steps/{step}/_SUCCESS")

    def mark(self, step: str, at_ms: int, seen: tuple[int, int] = (0, 0)) -> None:
        self.spark.range(1).select(F.lit(step).alias("step"), F.lit(at_ms).cast("long").alias("at_ms"), F.lit(seen[0]).cast("long").alias("rows"),
                                   F.lit(str(seen[1])).alias("hash")).write.mode("overwrite").parquet(f"{self.folder}/steps/{step}")

    def seen(self, step: str) -> tuple[int, int]:
        """The fingerprint that a finished step noted."""
        row = self.spark.read.parquet(f"{self.folder}/steps/{step}").first()
        return row["rows"], int(row["hash"])

    def saved(self, rows: DataFrame, path: str, step: str, now_ms: int) -> DataFrame:
        """The rows as a table of the repair; written and compared once, then read."""
        if not self.done(step):
            want = fingerprint(rows, rows.columns)
            rows.write.mode("overwrite").parquet(path)
            got = fingerprint(self.spark.read.schema(rows.schema).parquet(path), rows.columns)
            if got != want:
                raise RepairRefused(f"{step} holds {got[0]} rows of {want[0]}, or others")
            self.mark(step, now_ms, want)
        return self.spark.read.schema(rows.schema).parquet(path)


def _replace_months(spark: SparkSession, path: str, log: RepairLog, content: DataFrame, touched: list[int], now_ms: int,
                    between: Callable[[str], None]) -> None:
    """Replace some months by ``content``, which must be the rows that the plan of the repair foresaw.

    Their fingerprint is noted before the first write, and held against what is about to be written and what then stands
    in the table. A run that resumes works on the table as it is; rows that others changed meanwhile give another
    fingerprint, and nothing is written.
    """
    if not touched:
        log.mark("moved", now_ms)
        return
    names = [f.name for f in S.OI_5M.fields]
    if not log.done("expected"):
        log.mark("expected", now_ms, fingerprint(content, names))
    between("expected")
    want = log.seen("expected")
    if not log.done("moved"):
        if fingerprint(content, names) != want:
            raise RepairRefused("the table changed since the repair was planned")
        facts.overwrite_months(content, path, touched)
        between("written")
        got = fingerprint(facts.read_facts(spark, path, S.OI_5M).where(F.col("month").isin(touched)), names)
        if got != want:
            raise RepairRefused(f"{got[0]} rows stand where {want[0]} were planned, or others")
        log.mark("moved", now_ms, want)
    between("moved")


def checked_refold(spark: SparkSession, path: str, rollup_paths: dict[str, str], months: list[int], version: int) -> None:
    """Re-fold the open-interest rollups of some months and hold them against the base table. Writes tables.

    Every base bar lies in one bucket of each rollup, so the samples of the months must add up to the bars; and a bucket
    with an older version than this fold's is an orphan that the replacement should have taken away.
    """
    base = versions.latest_snapshots(facts.read_facts(spark, path, S.OI_5M).where(F.col("month").isin(months)))
    n = base.count()
    for interval, target in rollup_paths.items():
        refresh.refold_months(base, rollup_oi, target, interval, months, version)
        told = spark.read.parquet(target).where(F.col("month").isin(months)).agg(
            F.coalesce(F.sum("samples"), F.lit(0)).alias("samples"), F.count_if(F.col("version") < version).alias("orphans")).first()
        if told["samples"] != n or told["orphans"]:
            raise RepairRefused(f"{interval} rollup: {told['samples']} samples of {n} bars, {told['orphans']} orphans")


def repair_archive_shift(spark: SparkSession, path: str, log_folder: str, cutoff_ms: int, now_ms: int, shift_ms: int = tg.BAR_MS,
                         rollup_paths: dict[str, str] | None = None, between: Callable[[str], None] = lambda step: None) -> bool:
    """Move archive rows snapped at or after ``cutoff_ms`` one bar later, exactly once, and re-fold the rollups.

    The affected rows are backed up; backup, plan and result are checked by fingerprints of their rows; then the rollups of
    the touched months are folded anew and their samples counted. Each step is recorded, and a run after a crash
    resumes (``between`` is told each step; tests break the run there). Returns False if the rows were moved before; the
    rollups are folded and checked then too. An unshifted table holds rows at the bar before the cutoff; without them and
    without a backup the repair refuses to run. Only months from the day before the cutoff on are read: a snapshot's bar
    opens less than a day before it. Writes tables.
    """
    log = RepairLog(spark, log_folder)
    facts.preflight(spark, path, S.OI_5M)
    first = not log.done("moved")
    table = filters.within(facts.read_facts(spark, path, S.OI_5M), tg.floor_to(cutoff_ms - tg.DAY_MS, tg.DAY_MS), None)
    archive = F.col("src_rank") == S.RANK_ARCHIVE
    names = [f.name for f in S.OI_5M.fields]
    if not log.done("backup") and table.where(archive & (F.col("start_ms") == cutoff_ms - shift_ms)).isEmpty():
        raise RepairRefused("no archive row before the cutoff: already shifted?")
    saved = log.saved(table.where(archive & (F.col("snap_ms") >= cutoff_ms)).select(*names), log.backup, "backup", now_ms)
    between("backup")
    moved = versions.latest_snapshots(saved).withColumns({
        "start_ms": F.col("start_ms") + shift_ms, "snap_ms": F.col("snap_ms") + shift_ms})
    # rows are identified by the backup's keys and by the moved keys, so a half
    # finished earlier run is cleaned up as well
    keys = ["symbol", "start_ms", "src_rank"]
    stale = saved.select(*keys).unionByName(moved.select(*keys)).distinct()
    touched = facts.months_of(saved.select("start_ms").unionByName(moved.select("start_ms")))
    whole = facts.read_facts(spark, path, S.OI_5M).where(F.col("month").isin(touched))
    rest = whole.select(*names).join(stale, keys, "left_anti")
    _replace_months(spark, path, log, rest.unionByName(moved.select(*names)), touched, now_ms, between)
    checked_refold(spark, path, rollup_paths or {}, touched, now_ms)
    between("refolded")
    return first


def repair_off_grid(spark: SparkSession, path: str, log_folder: str, now_ms: int, rollup_paths: dict[str, str] | None = None,
                    between: Callable[[str], None] = lambda step: None) -> DataFrame:
    """Snap off-grid archive rows to their boundary or drop them, and re-fold the rollups; returns the plan.

    Backup, plan (a row for each bar that is off) and result are checked as in :func:`repair_archive_shift`; a resumed
    run uses the tables that it finds. Off-grid rows are looked for in the whole table, all else touches the plan's months
    only. Writes tables.
    """
    log = RepairLog(spark, log_folder)
    facts.preflight(spark, path, S.OI_5M)
    names = [f.name for f in S.OI_5M.fields]
    table = facts.read_facts(spark, path, S.OI_5M)
    wrong = (F.col("src_rank") == S.RANK_ARCHIVE) & (F.pmod("start_ms", F.lit(tg.BAR_MS)) != 0)
    saved = log.saved(table.where(wrong).select(*names), log.backup, "backup", now_ms)
    between("backup")
    off = versions.latest_snapshots(saved)
    if not log.done("planned"):
        near = facts.months_of(saved.select(F.explode(F.array(F.col("start_ms") - tg.BAR_MS, F.col("start_ms") + tg.BAR_MS)).alias("start_ms")))
        snap.snap_plan(off, table.where(F.col("month").isin(near))).write.mode("overwrite").parquet(log.plan)
        planned, bars = spark.read.parquet(log.plan).count(), off.count()
        if planned != bars:
            raise RepairRefused(f"the plan has {planned} rows for {bars} bars")
        log.mark("planned", now_ms)
    between("planned")
    plan = spark.read.parquet(log.plan)
    moves = plan.where(F.col("action") == "move").select(
        "symbol", F.col("old_start").alias("start_ms"), "new_start")
    moved = off.join(moves, ["symbol", "start_ms"], "inner").withColumns({
        "start_ms": F.col("new_start"), "snap_ms": F.col("new_start") + tg.BAR_MS})
    touched = sorted(r[0] for r in snap.months_touched(plan).collect())
    inside = table.where(F.col("month").isin(touched)).select(*names)
    landed = moved.select("symbol", "start_ms", "src_rank")
    kept = versions.without(inside, wrong).join(landed, ["symbol", "start_ms", "src_rank"], "left_anti")
    _replace_months(spark, path, log, kept.unionByName(moved.select(*names)), touched, now_ms, between)
    checked_refold(spark, path, rollup_paths or {}, touched, now_ms)
    between("refolded")
    return plan


# --- the periodic sweep ------------------------------------------------------

def sweep(bars: DataFrame, candidates: DataFrame, known_empty: DataFrame, now_ms: int, *,
          step: int = tg.MINUTE_MS, settle_ms: int = 3 * tg.MINUTE_MS,
          window_ms: int = tg.DAY_MS, empty_ttl_ms: int = 12 * tg.HOUR_MS,
          failed: DataFrame | None = None,
          store: Callable[[DataFrame, str], DataFrame] = materialize) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Find holes in the recent window and repair them from the candidates.

    All ranges that are due are taken at once. Returns the rows to append, the outcome of every range (``repaired``,
    ``empty`` or ``failed``) and the updated memory of empty ranges. ``failed``
    lists ranges whose fetch broke; they are neither filled nor remembered.
    """
    from_ms, to_ms = tg.sweep_window(now_ms, settle_ms, window_ms, step)
    holes = gaps.find_gaps(bars, step, from_ms, to_ms)
    plan = store(ranges.sweep_plan(holes, known_empty, now_ms), "sweep")
    usable = plan
    if failed is not None:
        usable = plan.join(failed.select("symbol", "from_ms"), ["symbol", "from_ms"], "left_anti")
    rows = repair_bars(usable.select("symbol", "from_ms", "to_ms"), bars, candidates, now_ms, step)
    found = store(rows, "sweep-rows")
    # holes never overlap, so each repaired bar belongs to one range
    spans = plan.select("symbol", "from_ms", "to_ms", F.explode(F.sequence(
        tg.whole(F.col("from_ms"), tg.DAY_MS), tg.whole(F.col("to_ms") - 1, tg.DAY_MS))).alias("_d"))
    hits = found.select("symbol", "start_ms", tg.whole(F.col("start_ms"), tg.DAY_MS).alias("_d"))
    counts = (
        spans.join(hits, ["symbol", "_d"], "inner")
        .where((F.col("start_ms") >= F.col("from_ms")) & (F.col("start_ms") < F.col("to_ms")))
        .groupBy("symbol", "from_ms").agg(F.count("*").alias("fetched")))
    outcome = plan.join(counts, ["symbol", "from_ms"], "left").fillna(0, ["fetched"])
    broken = F.lit(False)
    if failed is not None:
        outcome = outcome.join(failed.select("symbol", "from_ms", F.lit(True).alias("_broken")),
                               ["symbol", "from_ms"], "left")
        broken = F.coalesce("_broken", F.lit(False))
    outcome = outcome.withColumn(
        "outcome", F.when(broken, "failed").when(F.col("fetched") == 0, "empty")
        .otherwise("repaired")).select(*plan.columns, "fetched", "outcome")
    remembered = known_empty.where(F.col("expires_ms") > now_ms).select(
        "symbol", "from_ms", "expires_ms")
    fresh = outcome.where(F.col("outcome") == "empty").select(
        "symbol", "from_ms", F.lit(now_ms + empty_ttl_ms).cast("long").alias("expires_ms"))
    return found, outcome, remembered.unionByName(fresh)


_MEMORY = "symbol string, from_ms long, expires_ms long"


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """Ranges that sweeps found empty; of the folders that were written whole the newest counts."""
    kept = newest_whole(spark, path)
    return spark.createDataFrame([], _MEMORY) if kept is None else spark.read.schema(_MEMORY).parquet(kept)


def write_memory(memory: DataFrame, path: str, now_ms: int) -> None:
    """Replace the memory at once: readers see the old folder until the new one is whole, then that alone."""
    spark, before = memory.sparkSession, newest_whole(memory.sparkSession, path)
    target = f"{path.rstrip('/')}/at={now_ms:020d}"
    memory.write.mode("overwrite").parquet(target)
    if before and not before.endswith(target.rsplit("/", 1)[-1]):
        remove(spark, before)


def sweep_job(spark: SparkSession, bars_path: str, candidates: DataFrame, memory_path: str, log_path: str, now_ms: int,
              version: int | None = None, **options) -> DataFrame:
    """One sweep over a stored table: fill its holes, remember what was found empty, and log each range's outcome.

    Only the months of the swept window are read, and of the candidates those of the holes. The rows are appended, then the
    memory is replaced, then the log written; a run that breaks leaves holes that the next one finds again. What the
    run wrote for itself is removed. Returns the outcomes. Writes tables.
    """
    facts.preflight(spark, bars_path, S.BARS_1M)
    bars = facts.read_facts(spark, bars_path, S.BARS_1M)
    own = scratch_path(spark, "sweep")

    def store(df: DataFrame, label: str) -> DataFrame:
        df.write.parquet(f"{own}/{label}")
        return spark.read.schema(df.schema).parquet(f"{own}/{label}")

    memory = store(read_memory(spark, memory_path), "memory")
    found, outcome, remembered = sweep(bars, candidates, memory, now_ms, store=store, **options)
    told = store(outcome, "outcome")
    facts.append_facts(found.select(*[f.name for f in S.BARS_1M.fields]), bars_path, now_ms if version is None else version)
    write_memory(remembered, memory_path, now_ms)
    log = f"{log_path.rstrip('/')}/sweep={now_ms}"
    told.write.mode("overwrite").parquet(log)
    remove(spark, own)
    return spark.read.schema(told.schema).parquet(log)


def sweep_stats(bars: DataFrame, known_empty: DataFrame, outcome: DataFrame, now_ms: int, *, step: int = tg.MINUTE_MS,
                settle_ms: int = 3 * tg.MINUTE_MS, window_ms: int = tg.DAY_MS) -> DataFrame:
    """Per symbol: holes found, skipped since they were found empty before, submitted, and what became of these."""
    from_ms, to_ms = tg.sweep_window(now_ms, settle_ms, window_ms, step)
    found = gaps.find_gaps(bars, step, from_ms, to_ms).groupBy("symbol").agg(F.count("*").alias("found"))
    told = outcome.groupBy("symbol").agg(F.count("*").alias("submitted"), *[
        F.count_if(F.col("outcome") == kind).alias(kind) for kind in ("repaired", "empty", "failed")])
    rows = found.join(told, "symbol", "left").fillna(0)
    return rows.withColumn("skipped", F.col("found") - F.col("submitted"))
