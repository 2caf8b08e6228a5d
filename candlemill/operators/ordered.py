"""Ordered computations that never put a whole key into one task.

A window over ``symbol`` alone sends all rows of the busiest symbol to one task.
These helpers split every key by a time chunk, work inside ``(key, chunk)``, and
carry only per-chunk summaries across chunk borders. A key then contributes one
summary row per chunk of its time span, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill import timegrid as tg

CHUNK = "_chunk"
LANE = "_lane"  # NULL for the rows of all chunks that meet, else a row's own chunk


def _chunked(df: DataFrame, order: str, chunk_ms: int) -> DataFrame:
    return df.withColumn(CHUNK, tg.whole(F.col(order), chunk_ms))


def wide_steps(df: DataFrame, keys: list[str], order: str, over: int | Column,
               chunk_ms: int = tg.DAY_MS) -> DataFrame:
    """Neighbouring values of ``order`` within a key that lie more than ``over`` apart.

    Returns ``keys + (before, after)``. One scan: inside a chunk only the wide
    steps and the two border rows survive, and the borders are then compared
    across chunks. Only they meet by key, two rows a chunk; a wide step inside a
    chunk stays with it, so a series in which every step is wide is no hot key.
    ``over`` may be an expression over the keys.
    """
    rows = _chunked(df.select(*keys, order), order, chunk_ms)
    # copies of a row change nothing here, so they are folded before the shuffle
    rows = rows.groupBy(*keys, CHUNK, order).agg(F.lit(1).alias("_one")).drop("_one")
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    rows = (
        rows.withColumn("_prev", F.lag(order).over(inside))
        .withColumn("_next", F.lead(order).over(inside))
        .where(F.col("_prev").isNull() | F.col("_next").isNull()
               | (F.col(order) - F.col("_prev") > over))
    )
    across = Window.partitionBy(*keys, LANE).orderBy(order)
    # a chunk's first row follows the last row of the chunk before it; any other
    # surviving row already knows its neighbour
    border = F.col("_prev").isNull() | F.col("_next").isNull()
    return (
        rows.withColumn(LANE, F.when(~border, F.col(CHUNK)))
        .withColumn("before", F.coalesce("_prev", F.lag(order).over(across)))
        .where(F.col(order) - F.col("before") > over)
        .select(*keys, "before", F.col(order).alias("after"))
    )


def with_previous(df: DataFrame, keys: list[str], order: str, columns: dict[str, str],
                  chunk_ms: int = tg.DAY_MS) -> DataFrame:
    """Add each source column's value on the preceding row as ``columns[source]``.

    ``order`` must be unique within a key.
    """
    rows = _chunked(df, order, chunk_ms)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    for source, name in columns.items():
        rows = rows.withColumn(name, F.lag(source).over(inside))
    rows = rows.withColumn("_first", F.row_number().over(inside) == 1)
    last = _chunked(df, order, chunk_ms).groupBy(*keys, CHUNK).agg(
        *[F.max_by(source, order).alias(f"_last_{source}") for source in columns])
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = last.select(*keys, CHUNK, *[
        F.lag(f"_last_{source}").over(across).alias(f"_carry_{source}") for source in columns])
    joined = rows.join(carried, [*keys, CHUNK], "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_first"), F.col(f"_carry_{source}")).otherwise(F.col(name)).alias(name)
          for source, name in columns.items()])


def prefix_max(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str,
               chunk: Column) -> DataFrame:
    """Add the maximum of ``value`` over all earlier rows of the key as ``name``.

    ``chunk`` must not decrease along ``order``; NULL where no earlier row exists.
    """
    rows = df.withColumn("_value", value).withColumn(CHUNK, chunk)
    earlier = (Window.partitionBy(*keys, CHUNK).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    inside = rows.withColumn("_inside", F.max("_value").over(earlier))
    before = (Window.partitionBy(*keys).orderBy(CHUNK)
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = (
        rows.groupBy(*keys, CHUNK).agg(F.max("_value").alias("_top"))
        .select(*keys, CHUNK, F.max("_top").over(before).alias("_carry"))
    )
    return (
        inside.join(carried, [*keys, CHUNK], "left")
        .withColumn(name, F.greatest("_inside", "_carry"))
        .select(*df.columns, name)
    )


def bounded_count(df: DataFrame, keys: list[str], order: list[str], delta: Column, before: str, after: str,
                  chunk: Column) -> DataFrame:
    """Add a running sum of ``delta`` that never falls below zero: its value ``before`` and ``after`` each row.

    A step that would go below zero ends at zero. The value is the plain running sum less the least value that sum has
    had so far (if that is below zero), so chunks need only carry their sum and their least running sum. ``chunk`` must
    not decrease along ``order``, which must be unique within a key.
    """
    rows = df.withColumns({"_delta": delta.cast("long"), CHUNK: chunk})
    upto = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.withColumn("_sum", F.sum("_delta").over(upto)).withColumn("_low", F.min("_sum").over(earlier))
    across = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        sums.groupBy(*keys, CHUNK).agg(F.sum("_delta").alias("_total"), F.min("_sum").alias("_least"))
        .withColumn("_base", F.coalesce(F.sum("_total").over(across), F.lit(0)))
        .withColumn("_floor", F.least(F.min(F.col("_base") + F.col("_least")).over(across), F.lit(0)))
        .select(*keys, CHUNK, (F.col("_base") - F.coalesce("_floor", F.lit(0))).alias("_carry")))
    here = F.col("_sum") - F.col("_delta")
    value = F.greatest(F.col("_carry") + here, here - F.least(F.coalesce("_low", F.lit(0)), F.lit(0)))
    return (
        sums.join(chunks, [*keys, CHUNK]).withColumn(before, value)
        .withColumn(after, F.greatest(F.col(before) + F.col("_delta"), F.lit(0)))
        .select(*df.columns, before, after))
