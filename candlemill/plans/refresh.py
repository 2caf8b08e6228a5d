"""Keeping rollup tables current: refresh, monthly re-fold, full rebuild."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import rollup as R
from candlemill.operators import versions
from candlemill.operators.filters import within
from candlemill.sources import facts

Fold = Callable[[DataFrame, str], DataFrame]


def refresh_rollup(base: DataFrame, fold: Fold, now_ms: int, interval: str,
                   lookback_days: int) -> DataFrame:
    """Fresh rows of the buckets an incremental refresh covers, stamped ``now_ms``."""
    rows = R.refresh_rows(base, now_ms, interval, lookback_days)
    return fold(rows, interval).withColumn("version", F.lit(now_ms).cast("long"))


def apply_refresh(base: DataFrame, fold: Fold, path: str, now_ms: int, interval: str,
                  lookback_days: int) -> None:
    """Write a refresh into a rollup table; running it twice changes nothing."""
    fresh = refresh_rollup(base, fold, now_ms, interval, lookback_days)
    facts.upsert_partitions(fresh, path, fresh.schema, S.BAR_KEYS, ["version"])


def refold(base: DataFrame, fold: Fold, interval: str, from_ms: int, to_ms: int) -> DataFrame:
    """Recompute whole months of a rollup; both bounds must be month starts."""
    tg.require_month_start(from_ms)
    tg.require_month_start(to_ms)
    return fold(within(base, from_ms, to_ms), interval)


def apply_refold(base: DataFrame, fold: Fold, path: str, interval: str, from_ms: int, to_ms: int,
                 version: int) -> None:
    """Replace the months in range; buckets that lost all rows vanish with them."""
    fresh = refold(base, fold, interval, from_ms, to_ms).withColumn(
        "version", F.lit(version).cast("long"))
    facts.overwrite_months(fresh, path, tg.months_between(from_ms, to_ms))


def refold_months(base: DataFrame, fold: Fold, path: str, interval: str, months: list[int], version: int) -> None:
    """Replace some months of a rollup by one fold over their base rows; ``base`` carries its month.

    A rollup's bucket lies within one month. Buckets that lost all rows vanish with the months that are replaced.
    """
    rows = fold(base.where(F.col("month").isin(months)), interval)
    facts.overwrite_months(rows.withColumn("version", F.lit(version).cast("long")), path, months)


def rebuild_rollups(base: DataFrame, folds: dict[str, tuple[Fold, str]], version: int) -> None:
    """Recompute rollup tables from base rows; ``folds`` maps interval to (fold, path)."""
    for interval, (fold, path) in folds.items():
        rows = fold(base, interval).withColumn("version", F.lit(version).cast("long"))
        facts.overwrite_all(rows, path)


def refresh_batch(read_base: Callable[[], DataFrame], fold: Fold, path: str, interval: str,
                  lookback_days: int, clock: Callable[[], int]):
    """A ``foreachBatch`` body that refreshes a rollup whenever new rows arrive."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        apply_refresh(versions_of(read_base()), fold, path, clock(), interval, lookback_days)

    return run


def versions_of(raw: DataFrame) -> DataFrame:
    """Authoritative rows of a raw fact table, whichever kind it is."""
    if "src_rank" in raw.columns:
        return versions.latest_snapshots(raw)
    return versions.latest_bars(raw)
