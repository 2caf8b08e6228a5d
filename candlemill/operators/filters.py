"""Row predicates and simple projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx


def in_range(df: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    """Bars whose open lies in ``[from, to)``."""
    return within(df, from_ms, to_ms)


def within(df: DataFrame, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """Rows of ``[from, to)``; where the table's month is at hand it is bound too, so that months are pruned."""
    start, month = F.col("start_ms"), F.col("month")
    dated = "month" in df.columns
    if from_ms is not None:
        df = df.where((start >= from_ms) & (month >= tg.months_between(from_ms, from_ms + 1)[0]) if dated else start >= from_ms)
    if to_ms is not None:
        df = df.where((start < to_ms) & (month <= tg.months_between(to_ms - 1, to_ms)[0]) if dated else start < to_ms)
    return df


def closed_only(df: DataFrame, now_ms: int, settle_ms: int = 1_000) -> DataFrame:
    """Bars whose close is at least ``settle_ms`` in the past."""
    return df.where(F.col("end_ms") <= now_ms - settle_ms)


def opened_before_current(df: DataFrame, now_ms: int, step: int = tg.MINUTE_MS) -> DataFrame:
    """Bars that opened before the interval now forming."""
    return df.where(F.col("start_ms") < tg.floor_to(now_ms, step))


def final_only(events: DataFrame) -> DataFrame:
    return events.where("is_final")


def on_grid(df: DataFrame, step: int) -> DataFrame:
    return df.where(F.pmod("start_ms", F.lit(step)) == 0)


def off_grid(df: DataFrame, step: int) -> DataFrame:
    return df.where(F.pmod("start_ms", F.lit(step)) != 0)


def members_only(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows of universe symbols."""
    return df.join(universe.select("symbol"), "symbol", "left_semi")


def with_month(df: DataFrame) -> DataFrame:
    """Partition month, month bounds and UTC day of a bar."""
    start = F.col("start_ms")
    return (df.withColumn("month", tg.month_of(start))
            .withColumn("month_from_ms", tg.month_start_ms(start))
            .withColumn("month_to_ms", tg.next_month_start_ms(start))
            .withColumn("day_ms", tg.bucket(start, tg.DAY_MS)))


def parse_quantities(events: DataFrame) -> DataFrame:
    """Strict parse of the text quantities; ``bad_field`` names the first failure.

    A negative trade count is clamped to 0. Split the result on ``bad_field``:
    NULL rows are good, the others are the rejects to count.
    """
    parsed = {c: fx.number(F.col(c)) for c in S.EVENT_TEXT}
    bad = fx.first_reason(*[(value.isNull(), c) for c, value in parsed.items()])
    return events.withColumns({
        **parsed, "trade_count": F.greatest("trade_count", F.lit(0)), "bad_field": bad})


def oi_row_fault(df: DataFrame) -> DataFrame:
    """Add ``fault``: why an open-interest row may not be stored, NULL if it may."""
    value = F.col("sum_open_interest")
    return df.withColumn("fault", fx.first_reason(
        (F.coalesce(F.col("symbol"), F.lit("")) == "", "symbol"),
        (F.coalesce(F.pmod("start_ms", F.lit(tg.BAR_MS)) != 0, F.lit(True)), "grid"),
        (~fx.finite(value) | (value < 0), "value"),
        (F.coalesce(~F.col("src_rank").isin(1, 2, 3), F.lit(True)), "rank"),
    ))


def ratio_row_fault(df: DataFrame) -> DataFrame:
    """Add ``fault`` for a ratio row: off grid, wrong source, no value, bad value.

    NaN stands for a missing value here and is stored as NULL.
    """
    cells = [F.when(~F.isnan(c), F.col(c)) for c in S.RATIOS]
    return df.withColumns(dict(zip(S.RATIOS, cells))).withColumn("fault", fx.first_reason(
        (F.coalesce(F.col("symbol"), F.lit("")) == "", "symbol"),
        (F.coalesce(F.pmod("start_ms", F.lit(tg.BAR_MS)) != 0, F.lit(True)), "grid"),
        (F.coalesce(~F.col("src_rank").isin(2, 3), F.lit(True)), "rank"),
        (fx.any_of([F.col(c).isNotNull() & (~fx.finite(F.col(c)) | (F.col(c) < 0))
                    for c in S.RATIOS]), "value"),
        (F.coalesce(*S.RATIOS).isNull(), "empty"),
    ))


def split_faults(df: DataFrame, column: str = "fault") -> tuple[DataFrame, DataFrame]:
    """Good rows without the marker column, and the rejected ones with it."""
    return df.where(F.col(column).isNull()).drop(column), df.where(F.col(column).isNotNull())


def label_to_bar(labels: DataFrame, now_ms: int) -> DataFrame:
    """History labels to the bar that closes there; off-grid and future labels drop out."""
    label = F.col("label_ms")
    return (labels.where((F.pmod(label, F.lit(tg.BAR_MS)) == 0) & (label <= now_ms))
            .withColumn("start_ms", label - tg.BAR_MS))


def snapshot_to_bar(snaps: DataFrame, min_remaining_ms: int = 5_000,
                    catch_up_ms: int | None = None) -> DataFrame:
    """Assign live snapshots to the bar closing at their round's boundary.

    The round is chosen by the request time: the next boundary, or the one after
    it when too little time remains. With ``catch_up_ms`` a request shortly after
    a boundary serves the bar that just closed instead. The answer's own time
    only becomes ``snap_ms``.
    """
    asked = F.col("requested_ms")
    floor = tg.bucket(asked, tg.BAR_MS)
    ahead = floor + tg.BAR_MS
    boundary = F.when(ahead - asked < min_remaining_ms, ahead + tg.BAR_MS).otherwise(ahead)
    if catch_up_ms is not None:
        boundary = F.when(asked - floor <= catch_up_ms, floor).otherwise(boundary)
    return (snaps.withColumn("start_ms", boundary - tg.BAR_MS)
            .withColumn("src_rank", F.lit(S.RANK_LIVE)))
