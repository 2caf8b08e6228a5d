"""Holes in bar series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill import timegrid as tg
from candlemill.operators import ordered
from candlemill.operators.filters import within
from candlemill.operators.presence import bar_words, bit_runs
from candlemill.operators.ranges import merge_ranges


def find_gaps(bars: DataFrame, step: int, from_ms: int | None = None,
              to_ms: int | None = None, on_grid: bool = False) -> DataFrame:
    """Missing bars strictly between two bars of a symbol, as ``[from_ms, to_ms)``.

    Holes before a symbol's first bar or after its last one are not gaps, and
    repeated bars change nothing, so raw rows may be passed without dedup. With
    ``on_grid`` only bars whose open is a multiple of ``step`` count, and 60 of
    them travel through the shuffle as the bits of one number.
    """
    rows = within(bars, from_ms, to_ms)
    # a chunk holds about a day of minutes, whatever the step
    chunk = max(tg.DAY_MS, step * 1_440)
    if on_grid:
        steps = _steps_between_runs(rows, step, chunk)
    else:
        steps = ordered.wide_steps(rows, ["symbol"], "start_ms", step, chunk)
    return steps.select(
        "symbol",
        (F.col("before") + step).alias("from_ms"),
        F.col("after").alias("to_ms"),
        (tg.whole(F.col("after") - F.col("before"), step) - 1).alias("missing_count"),
    )


def _steps_between_runs(rows: DataFrame, step: int, chunk_ms: int) -> DataFrame:
    """Last bar of a run and first bar of the next one, for runs of unbroken bars."""
    runs = bit_runs(bar_words(rows, step), step)
    runs = runs.withColumn("_chunk", tg.whole(F.col("head"), chunk_ms))
    inside = Window.partitionBy("symbol", "_chunk").orderBy("head")
    apart = (
        runs.withColumn("_prev", F.lag("tail").over(inside))
        .withColumn("_last", F.lead("tail").over(inside).isNull())
        .where(F.col("_prev").isNull() | F.col("_last") | (F.col("head") - F.col("_prev") > step)))
    # only the runs at a chunk's borders meet by symbol; those inside know their neighbour
    border = F.col("_prev").isNull() | F.col("_last")
    across = Window.partitionBy("symbol", ordered.LANE).orderBy("head")
    return (
        apart.withColumn(ordered.LANE, F.when(~border, F.col("_chunk")))
        .withColumn("before", F.coalesce("_prev", F.lag("tail").over(across)))
        .where(F.col("head") - F.col("before") > step)
        .select("symbol", "before", F.col("head").alias("after")))


def tail_gaps(bars: DataFrame, hi_ms: int, step: int) -> DataFrame:
    """One range per symbol that ends before the newest bar expected."""
    return (
        bars.groupBy("symbol").agg(F.max("start_ms").alias("newest"))
        .where(F.col("newest") < hi_ms)
        .select("symbol", (F.col("newest") + step).alias("from_ms"),
                F.lit(hi_ms + step).alias("to_ms"),
                tg.whole(F.lit(hi_ms) - F.col("newest"), step).alias("missing_count"))
    )


def gap_report_rows(gaps: DataFrame, interval: str) -> DataFrame:
    """Gaps in the layout of the gap file."""
    return gaps.select(
        "symbol", F.lit(interval).alias("interval"), "from_ms", "to_ms",
        tg.utc_text(F.col("from_ms")).alias("from_utc"),
        tg.utc_text(F.col("to_ms")).alias("to_utc"),
        "missing_count")


def gap_totals(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("symbol").agg(
        F.count("*").alias("gap_count"), F.sum("missing_count").alias("missing_bars"))


def silence_gaps(arrivals: DataFrame, keys: list[str], stale_ms: int) -> DataFrame:
    """Stretches longer than ``stale_ms`` without any arrival of a key."""
    steps = ordered.wide_steps(arrivals, keys, "arrival_ms", stale_ms)
    return steps.select(*keys, F.col("before").alias("last_before_ms"),
                        F.col("after").alias("first_after_ms"),
                        (F.col("after") - F.col("before")).alias("silent_ms"))


def debounced_repairs(silences: DataFrame, keys: list[str], quiet_ms: int = 30_000) -> DataFrame:
    """Join silences of a group that end within ``quiet_ms`` of each other into one request."""
    ends = silences.select(
        *keys, F.col("first_after_ms").alias("from_ms"),
        (F.col("first_after_ms") + quiet_ms).alias("to_ms"))
    merged = merge_ranges(ends, keys)
    return merged.select(*keys, "from_ms", (F.col("to_ms") - quiet_ms).alias("last_end_ms"),
                         F.col("to_ms").alias("fire_ms"))


def section_gaps(events: DataFrame, steps: dict[str, int]) -> DataFrame:
    """Ready events of one interval that do not follow each other by one interval."""
    step = F.create_map(*[F.lit(x) for pair in steps.items() for x in pair])[F.col("interval")]
    served = events.where(F.col("interval").isin(list(steps)))
    wide = ordered.wide_steps(served, ["interval"], "timestamp", step, 30 * tg.DAY_MS)
    missed = ((F.col("after") - F.col("before")) / step).cast("long") - 1
    return wide.select("interval", F.col("before").alias("previous_ms"),
                       F.col("after").alias("timestamp"), missed.alias("missed"))
