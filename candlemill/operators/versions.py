"""Which row counts when several exist for a key, and what to do with the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill import schemas as S


def latest_by_version(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` per key.

    Spark turns the filter into a group limit that runs before the shuffle, so
    many copies of one key collapse on the map side.
    """
    # the month follows from the open time; as a key it lets a month predicate pass below the window
    keys = [*keys, "month"] if "month" in df.columns and "start_ms" in keys else keys
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("_rn", F.row_number().over(newest))
            .where(F.col("_rn") == 1).drop("_rn"))


def latest_bars(raw: DataFrame) -> DataFrame:
    """1m bars: newest version, the later insert on a tie."""
    return latest_by_version(raw, S.BAR_KEYS, ["version", "ingest_seq"])


def latest_snapshots(raw: DataFrame) -> DataFrame:
    """Open interest or ratios: archive over history over live, then the later insert."""
    return latest_by_version(raw, S.BAR_KEYS, ["src_rank", "ingest_seq"])


def without(df: DataFrame, pred: Column) -> DataFrame:
    """Rows for which ``pred`` is not true; an unknown predicate keeps the row."""
    return df.where(F.coalesce(~pred, F.lit(True)))


def prune_orphans(old: DataFrame, fresh: DataFrame, from_ms: int, to_ms: int,
                  keys: list[str] | None = None) -> DataFrame:
    """Rollup rows in range whose bucket a fresh fold no longer produces."""
    keys = keys or S.BAR_KEYS
    inside = (F.col("start_ms") >= from_ms) & (F.col("start_ms") < to_ms)
    return old.where(inside).join(fresh.where(inside).select(*keys), keys, "left_anti")


def pending_work(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work items not yet recorded as done."""
    return todo.join(done.select(*keys), keys, "left_anti")


def dedup_pages(pages: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    """Concatenated pages: trim to the window, one row per bar, the first page wins."""
    inside = pages.where((F.col("start_ms") >= from_ms) & (F.col("start_ms") < to_ms))
    first = Window.partitionBy(*S.BAR_KEYS).orderBy("page_no")
    return (inside.withColumn("_rn", F.row_number().over(first))
            .where(F.col("_rn") == 1).drop("_rn"))
