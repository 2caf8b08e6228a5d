"""Fact and rollup tables: Parquet, partitioned by month, sorted by key in each file.

Every row carries its month in ``month``; a time predicate on ``start_ms`` alone
cannot prune partitions, so the readers here add the month predicate.

Rewrites replace whole month partitions. The new content is first written to a
staging table, which both frees the job from the files it replaces and lets it
continue after executors are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import versions
from candlemill.operators.filters import within
from candlemill.session import exists, remove, staged


class LayoutError(ValueError):
    """A table does not have the columns a job relies on."""


def layout_faults(have: StructType, want: StructType) -> list[tuple[str, str, str | None]]:
    """(column, wanted type, found type or None) of every expected column that is missing or has another type."""
    found = {f.name: f.dataType for f in have.fields}
    return [(f.name, f.dataType.simpleString(), found[f.name].simpleString() if f.name in found else None)
            for f in want.fields if found.get(f.name) != f.dataType]


def require_layout(df: DataFrame, schema: StructType) -> DataFrame:
    """Refuse to run on a table that lacks an expected column or type."""
    wrong = [name for name, *_ in layout_faults(df.schema, schema)]
    if wrong:
        raise LayoutError(f"missing or differently typed columns: {', '.join(wrong)}")
    return df


def preflight(spark: SparkSession, path: str, schema: StructType) -> None:
    """Refuse a table whose files are not laid out as a job expects, before it writes anything; an absent one is fine.

    Readers impose a schema, under which a column that a file lacks reads as NULL, so the files' own schema is asked.
    """
    if months_in(spark, path):
        require_layout(spark.read.parquet(path), schema)


def read_facts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of a fact table with their month; folders below the months (stream batches) are not told apart."""
    full = StructType([*schema.fields, StructField("month", IntegerType(), True)])
    return spark.read.schema(full).parquet(path).select(*full.names)


def months_in(spark: SparkSession, path: str) -> list[int]:
    """Months that have a partition, from the folder's listing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []
    return sorted(int(n[6:]) for n in names if n.startswith("month=") and n[6:].isdigit())


def scan_bars(spark: SparkSession, path: str, schema: StructType = S.BARS_1M,
              symbols: list[str] | None = None, from_ms: int | None = None,
              to_ms: int | None = None) -> DataFrame:
    """Rows of a fact table for some symbols and a half-open time range."""
    df = read_facts(spark, path, schema)
    if symbols:
        df = df.where(F.col("symbol").isin(symbols))
    return within(df, from_ms, to_ms)


def _laid_out(df: DataFrame) -> DataFrame:
    """Rows grouped by month into even files: big months split, small ones share."""
    keys = [k for k in ("symbol", "start_ms") if k in df.columns]
    placed = df.drop("month").withColumn("month", tg.month_of(F.col("start_ms")))
    return placed.hint("rebalance", F.col("month")).sortWithinPartitions("month", *keys)


def append_facts(df: DataFrame, path: str, version: int | None = None) -> None:
    """Append a batch; ``version`` stamps its rows."""
    if version is not None:
        df = df.withColumn("version", F.lit(version).cast("long"))
    _laid_out(df).write.mode("append").partitionBy("month").parquet(path)


def overwrite_all(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    with staged(df, "overwrite") as copy:
        _laid_out(copy).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("month").parquet(path)


def overwrite_months(df: DataFrame, path: str, touched: list[int] | None = None) -> None:
    """Replace the months present in ``df``, and empty the ``touched`` ones it lacks."""
    with staged(df, "months") as copy:
        _laid_out(copy).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
        if touched:
            left = set(months_of(copy))
            drop_months(df.sparkSession, path, [m for m in touched if m not in left])


def months_of(df: DataFrame) -> list[int]:
    """Distinct months of the rows; a driver-side list bounded by the calendar."""
    return sorted(r[0] for r in df.select(tg.month_of(F.col("start_ms"))).distinct().collect())


def drop_months(spark: SparkSession, path: str, months: list[int]) -> None:
    """Delete month partitions that a rewrite left without any row."""
    for month in months:
        remove(spark, f"{path}/month={month}")


def upsert_partitions(new: DataFrame, path: str, schema: StructType, keys: list[str],
                      order: list[str]) -> None:
    """Merge rows into the months they touch, the greatest ``order`` wins per key."""
    spark = new.sparkSession
    names = [f.name for f in schema.fields]
    preflight(spark, path, schema)
    with staged(new, "upsert") as rows:
        touched = months_of(rows)
        if not touched:
            return
        merged = rows.select(*names)
        if exists(spark, path):  # the first run makes the table
            merged = read_facts(spark, path, schema).where(F.col("month").isin(touched)).select(*names).unionByName(merged)
        overwrite_months(versions.latest_by_version(merged, keys, order), path)


def compact(spark: SparkSession, path: str, schema: StructType, keys: list[str],
            order: list[str], months: list[int] | None = None) -> None:
    """Drop superseded row versions of some months, or of all that the table has, for good."""
    preflight(spark, path, schema)
    months = months_in(spark, path) if months is None else months
    rows = read_facts(spark, path, schema).where(F.col("month").isin(months))
    overwrite_months(versions.latest_by_version(rows.drop("month"), keys, order), path)


def delete_where(spark: SparkSession, path: str, schema: StructType, pred: Column) -> None:
    """Delete the rows for which ``pred`` is true, rewriting only months that hold one."""
    preflight(spark, path, schema)
    table = read_facts(spark, path, schema)
    hit = sorted(r[0] for r in table.where(pred).select("month").distinct().collect())
    if not hit:
        return
    kept = versions.without(table.where(F.col("month").isin(hit)), pred)
    overwrite_months(kept.drop("month"), path, hit)


def append_ready_events(events: DataFrame, path: str) -> None:
    """Append ready events; readers take the newest rows."""
    events.select(*[f.name for f in S.READY_EVENT.fields]).write.mode("append").parquet(path)


def trim_ready_events(spark: SparkSession, path: str, keep: int) -> None:
    """Rewrite the event log with the newest ``keep`` events; they are written elsewhere before the log goes."""
    events = spark.read.schema(S.READY_EVENT).parquet(path)
    newest = events.orderBy(F.col("published_ms").desc(), F.col("interval").desc(),
                            F.col("timestamp").desc()).limit(keep)
    with staged(newest, "events") as kept:
        kept.write.mode("overwrite").parquet(path)
