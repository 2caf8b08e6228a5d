"""Rows whose time is not on the grid, and the archive's clock rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg

# Fixed value: first archive file date whose create_time is the window start.
ARCHIVE_SWITCH_MS = tg.to_ms(dt.datetime(2024, 3, 4))


def nearest_boundary(ms: Column, step: int) -> Column:
    """Nearest multiple of ``step``; half way goes up."""
    return tg.bucket(ms + step // 2, step)


def snap_plan(off: DataFrame, table: DataFrame, step: int = tg.BAR_MS) -> DataFrame:
    """What to do with each off-grid row.

    A row whose boundary already holds an on-grid row is dropped; of several rows
    for one boundary the closest moves there (the earlier one on a tie) and the
    others are dropped.
    """
    target = nearest_boundary(F.col("start_ms"), step)
    rows = off.select(
        "symbol", F.col("start_ms").alias("old_start"), target.alias("new_start"),
        F.col("sum_open_interest").alias("value"),
        F.abs(F.col("start_ms") - target).alias("dist_ms"))
    closest = Window.partitionBy("symbol", "new_start").orderBy("dist_ms", "old_start")
    ranked = rows.withColumn("_rn", F.row_number().over(closest))
    months = rows.select("symbol", tg.month_of(F.col("new_start")).alias("_month")).distinct()
    taken = (
        table.where(F.pmod("start_ms", F.lit(step)) == 0)
        .select("symbol", F.col("start_ms").alias("new_start"),
                tg.month_of(F.col("start_ms")).alias("_month"))
        .join(months, ["symbol", "_month"], "left_semi")
        .select("symbol", "new_start", F.lit(True).alias("_taken")).distinct()
    )
    action = (F.when(F.col("_taken"), "drop_slot_taken")
              .when(F.col("_rn") > 1, "drop_collision").otherwise("move"))
    return (ranked.join(taken, ["symbol", "new_start"], "left")
            .select("symbol", "old_start", "new_start", "value", "dist_ms", action.alias("action")))


def snap_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(
        F.count("*").alias("rows"), (F.max("dist_ms") / 1000.0).alias("max_offset_s"))


def months_touched(plan: DataFrame) -> DataFrame:
    """Months that hold an old or a new start of the plan."""
    both = plan.select(F.explode(F.array("old_start", "new_start")).alias("ms"))
    return both.select(tg.month_of(F.col("ms")).alias("month")).distinct()


def archive_align(rows: DataFrame) -> DataFrame:
    """Archive rows with their bar start, and the reason for those not used.

    Input: ``symbol, file_day_ms, create_ms, line_no`` and the measures. An
    off-grid time goes to its nearest boundary unless that belongs to another
    file's day, is taken by an on-grid row, or a closer row wants it too. Files
    before the switch hold the snapshot at create_time, later ones five minutes
    after it. ``fault`` is NULL for the rows to store.
    """
    created = F.col("create_ms")
    target = nearest_boundary(created, tg.BAR_MS)
    gridded = created == target
    crosses = tg.bucket(target, tg.DAY_MS) != tg.bucket(created, tg.DAY_MS)
    empty = F.coalesce(*S.RATIOS).isNull()
    usable = created.isNotNull() & ~empty & ~(~gridded & crosses)
    rows = rows.withColumns({"_target": target, "_gridded": gridded, "_usable": usable,
                             "_dist": F.abs(created - target)})
    # of equal on-grid times the later line counts, of equal distances the earlier
    preference = Window.partitionBy("symbol", "file_day_ms", "_target", "_usable").orderBy(
        F.col("_gridded").desc(), "_dist",
        F.when(F.col("_gridded"), -F.col("line_no")).otherwise(F.col("line_no")))
    shift = F.when(F.col("file_day_ms") >= ARCHIVE_SWITCH_MS, 0).otherwise(tg.BAR_MS)
    start = F.col("_target") - shift
    fault = (
        F.when(created.isNull(), "time").when(empty, "empty")
        .when(~F.col("_usable"), "other_day")
        .when(F.row_number().over(preference) > 1, "superseded")
    )
    return rows.withColumns({
        "fault": fault, "start_ms": start, "snap_ms": start + tg.BAR_MS,
        "src_rank": F.lit(S.RANK_ARCHIVE),
    }).drop("_target", "_gridded", "_usable", "_dist")


def archive_worklist(oi: DataFrame, from_ms: int, until_ms: int) -> DataFrame:
    """(symbol, day) files worth reading: days of each row's start and snapshot."""
    rows = oi.where((F.col("start_ms") >= from_ms - tg.BAR_MS) & (F.col("start_ms") < until_ms))
    opens = rows.select("symbol", tg.bucket(F.col("start_ms"), tg.DAY_MS).alias("day_ms"))
    closes = rows.select(
        "symbol", tg.bucket(F.col("start_ms") + tg.BAR_MS, tg.DAY_MS).alias("day_ms"))
    days = opens.unionByName(closes).distinct()
    return days.where((F.col("day_ms") >= from_ms) & (F.col("day_ms") < until_ms))
