"""Half-open ranges ``[from_ms, to_ms)`` of bar opens, per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill import timegrid as tg
from candlemill.operators import presence

# ranges are joined to bars through the day chunks they cover
_JOIN_CHUNK_MS = tg.DAY_MS


def merge_ranges(ranges: DataFrame, keys: list[str] | None = None,
                 chunk_ms: int = tg.DAY_MS) -> DataFrame:
    """Join overlapping or touching ranges of a key.

    Ranges are cut at chunk borders and merged inside their chunk. Only islands
    that touch a border can belong together across chunks; at most two per chunk
    do, and they alone share a lane per key for the second merge.
    """
    keys = keys or ["symbol"]
    start, end, chunk = F.col("from_ms"), F.col("to_ms"), F.col("_chunk")
    pieces = (
        ranges.where(end > start)
        .select(*keys, start, end, F.explode(F.sequence(
            tg.whole(start, chunk_ms), tg.whole(end - 1, chunk_ms))).alias("_chunk"))
        .select(*keys, chunk, F.greatest(start, chunk * chunk_ms).alias("from_ms"),
                F.least(end, (chunk + 1) * chunk_ms).alias("to_ms"))
        # copies and nested pieces with one start fold before the shuffle
        .groupBy(*keys, "_chunk", "from_ms").agg(F.max("to_ms").alias("to_ms"))
    )
    local = _islands(pieces, [*keys, "_chunk"])
    border = (start == chunk * chunk_ms) | (end == (chunk + 1) * chunk_ms)
    lanes = local.withColumn("_lane", F.when(border, -1).otherwise(chunk))
    return _islands(lanes.select(*keys, "_lane", "from_ms", "to_ms"), [*keys, "_lane"]).drop("_lane")


def _islands(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the ranges inside each group; starts are unique there."""
    order = Window.partitionBy(*keys).orderBy("from_ms")
    reach = F.max("to_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("_reach", reach).withColumn("_head", F.when(
        F.col("_reach").isNull() | (F.col("from_ms") > F.col("_reach")), F.col("from_ms")))
    # starts ascend, so the running maximum is the start of the current island
    island = F.max("_head").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        opened.withColumn("_island", island).groupBy(*keys, "_island")
        .agg(F.max("to_ms").alias("to_ms"))
        .select(*keys, F.col("_island").alias("from_ms"), "to_ms")
    )


def page_ranges(ranges: DataFrame, step: int, page_bars: int) -> DataFrame:
    """Cut long ranges into pages of at most ``page_bars`` bars."""
    page = step * page_bars
    others = [c for c in ranges.columns if c not in ("from_ms", "to_ms")]
    return (
        ranges.where(F.col("to_ms") > F.col("from_ms"))
        .select(*others, "to_ms",
                F.explode(F.sequence("from_ms", F.col("to_ms") - 1, F.lit(page))).alias("page_ms"))
        .select(*others, F.col("page_ms").alias("from_ms"),
                F.least(F.col("page_ms") + page, F.col("to_ms")).alias("to_ms"))
    )


def range_bars(ranges: DataFrame, step: int) -> DataFrame:
    """Every bar open inside the ranges, paged first so no array grows with a range."""
    pages = page_ranges(ranges, step, 1_440)
    others = [c for c in ranges.columns if c not in ("from_ms", "to_ms")]
    return pages.select(
        *others,
        F.explode(F.sequence("from_ms", F.col("to_ms") - 1, F.lit(step))).alias("start_ms"))


def subtract_present(ranges: DataFrame, bars: DataFrame, step: int) -> DataFrame:
    """Parts of the ranges for which no bar exists; bars are those on the grid of ``step``.

    Ranges and bars are laid side by side as words of 60 bars, so a range of years costs its words, and what is left
    over is read off in runs. ``bars`` are bound to the ranges' months if they carry theirs.
    """
    asked = ranges.select("symbol", "from_ms", "to_ms")
    words = presence.compared(presence.range_words(asked, step), presence.bar_words(in_months_of(bars, asked), step))
    left = words.select("symbol", "word", presence.without_bits(F.col("bits"), F.col("bits_1")).alias("bits")).where("bits <> 0")
    runs = presence.bit_runs(left, step)
    return merge_ranges(runs.select("symbol", F.col("head").alias("from_ms"), (F.col("tail") + step).alias("to_ms")))


def in_months_of(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of the months that the ranges touch; all of them if the rows don't carry their month."""
    days = F.explode(F.sequence(tg.whole(F.col("from_ms"), tg.DAY_MS), tg.whole(F.col("to_ms") - 1, tg.DAY_MS)))
    touched = ranges.where(F.col("to_ms") > F.col("from_ms")).select(days.alias("day"))
    return in_months_at(rows, touched.select((F.col("day") * tg.DAY_MS).alias("ms")))


def in_months_at(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """The rows of the months of the ``ms`` of ``moments``; all of them if the rows don't carry their month.

    The driver gets the months, a list that the calendar bounds.
    """
    if "month" not in rows.columns:
        return rows
    months = moments.select(tg.month_of(F.col("ms")).alias("m")).distinct().collect()
    return rows.where(F.col("month").isin(sorted(r["m"] for r in months)))


def wanted_bars(bars: DataFrame, ranges: DataFrame) -> DataFrame:
    """Bars that fall inside some range of their symbol.

    Both sides carry a day chunk, so this is an equi join with a residual
    condition: no nested loop, and a busy symbol spreads over its days.
    """
    chunk = _JOIN_CHUNK_MS
    spans = ranges.where(F.col("to_ms") > F.col("from_ms")).select(
        F.col("symbol").alias("r_symbol"), "from_ms", "to_ms",
        F.explode(F.sequence(tg.whole(F.col("from_ms"), chunk),
                             tg.whole(F.col("to_ms") - 1, chunk))).alias("r_chunk"))
    rows = bars.withColumn("_chunk", tg.whole(F.col("start_ms"), chunk))
    hit = ((F.col("symbol") == F.col("r_symbol")) & (F.col("_chunk") == F.col("r_chunk"))
           & (F.col("start_ms") >= F.col("from_ms")) & (F.col("start_ms") < F.col("to_ms")))
    return rows.join(spans, hit, "left_semi").drop("_chunk")


def clip_ranges(ranges: DataFrame, oldest_ms: int, step: int) -> DataFrame:
    """Split ranges at the oldest bar still available.

    ``kept_from_ms`` is NULL for a range that lies before it; ``dropped_bars``
    counts the part cut off.
    """
    start, end = F.col("from_ms"), F.col("to_ms")
    gone = end <= oldest_ms
    return ranges.select(
        "*",
        F.when(~gone, F.greatest(start, F.lit(oldest_ms))).alias("kept_from_ms"),
        F.when(~gone, end).alias("kept_to_ms"),
        F.when(gone, tg.whole(end - start, step))
        .otherwise(F.greatest(tg.whole(F.lit(oldest_ms) - start, step), F.lit(0)))
        .alias("dropped_bars"))


def stale_rollups(repaired: DataFrame, now_ms: int, lookback_days: dict[str, int]) -> DataFrame:
    """Levels that no longer refresh over a repaired bar, one row per bar and level."""
    levels = F.array(*[
        F.struct(F.lit(iv).alias("interval"), F.lit(days).alias("days"))
        for iv, days in lookback_days.items()])
    return (
        repaired.withColumn("_level", F.explode(levels))
        .where(F.lit(now_ms) - F.col("start_ms") > F.col("_level.days") * F.lit(tg.DAY_MS))
        .withColumn("interval", F.col("_level.interval")).drop("_level")
    )


def sweep_plan(gaps: DataFrame, known_empty: DataFrame, now_ms: int,
               max_ranges: int | None = None) -> DataFrame:
    """Gaps to repair in this run: those not known to be empty, in symbol order up to a cap.

    The cap only defers: what it leaves out is found again by the next run.
    """
    asleep = known_empty.where(F.col("expires_ms") > now_ms).select("symbol", "from_ms")
    due = gaps.join(asleep, ["symbol", "from_ms"], "left_anti")
    return due if max_ranges is None else due.orderBy("symbol", "from_ms").limit(max_ranges)
