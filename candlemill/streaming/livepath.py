"""The live path: one micro-batch feeds the archive, then the windows, then the sections.

By the time a section's event is in the ready log, the windows hold the bars of every symbol it counts. Each sink keeps
its state as a table of the batch that wrote it, and its own mark; a batch that is run again skips the sinks that have
finished it and gives the others the same rows, so a crash between any two of them changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import ordered, windows
from candlemill.session import exists, remove
from candlemill.streaming.jobs import fan_out, query_folder

_OPEN = "interval string, open_ms long, symbol string, arrival_ms long"
_SECTION = "interval string, timestamp long, symbols_count long, reason string, published_ms long"


def _finished(spark: SparkSession, path: str, batch_id: int) -> bool:
    return exists(spark, f"{path}/batch={batch_id}/_SUCCESS")


def _write(df: DataFrame, path: str, batch_id: int, keep: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    if keep:
        remove(df.sparkSession, f"{path}/batch={batch_id - keep}")  # a batch that is run again needs the one before at most


def pushed_windows(known: DataFrame | None, closed: DataFrame, size: int) -> DataFrame:
    """``symbol, bars``: windows after bars that the guard let through, newest first.

    Such bars are newer than all earlier ones of their key, so the newest ``size`` of both are the new window. At most
    ``size`` rows a symbol of either side meet.
    """
    bars = closed.select("symbol", F.col("open_ms").alias("start_ms"), *S.PRICES, *S.VOLUMES, F.col("trade_count").alias("trades_count"))
    fresh = windows.rolling_window(bars, size)
    if known is None:
        return fresh
    both = known.select("symbol", "bars").unionByName(fresh).groupBy("symbol").agg(F.flatten(F.collect_list("bars")).alias("bars"))
    return both.select("symbol", F.slice(F.sort_array(F.array_distinct("bars"), asc=False), 1, size).alias("bars"))


def dated(universe: DataFrame) -> DataFrame:
    """``symbol, valid_from_ms, valid_to_ms``: membership spans, half-open; a symbol without times is a member at all times."""
    names = universe.columns
    start = F.coalesce("valid_from_ms", F.lit(0)) if "valid_from_ms" in names else F.lit(0)
    end = F.col("valid_to_ms") if "valid_to_ms" in names else F.lit(None)
    return universe.select("symbol", start.cast("long").alias("valid_from_ms"), end.cast("long").alias("valid_to_ms")).distinct()


def sizes_at(members: DataFrame, asked: DataFrame) -> DataFrame:
    """``open_ms, size``: how many members the universe has at each of the times asked for.

    Members come and go as +1 and -1 on one line of time, on which the times asked for are laid; days are summed apart.
    """
    steps = members.select(F.col("valid_from_ms").alias("at_ms"), F.lit(1).alias("d"), "symbol").unionByName(
        members.where("valid_to_ms IS NOT NULL").select(F.col("valid_to_ms").alias("at_ms"), F.lit(-1).alias("d"), "symbol"))
    line = steps.withColumn("ask", F.lit(0)).unionByName(asked.select("open_ms").distinct().select(
        F.col("open_ms").alias("at_ms"), F.lit(0).alias("d"), F.lit("").alias("symbol"), F.lit(1).alias("ask")))
    told = ordered.bounded_count(line.withColumn("line", F.lit(0)), ["line"], ["at_ms", "ask", "symbol", "d"], F.col("d"), "size", "after",
                                 tg.whole(F.col("at_ms"), tg.DAY_MS))
    return told.where("ask = 1").select(F.col("at_ms").alias("open_ms"), "size")


def marked_sections(known: DataFrame | None, done: DataFrame | None, closed: DataFrame, members: DataFrame,
                    clock_ms: int, timeout_ms: int) -> tuple[DataFrame, DataFrame]:
    """(ready, open): sections that are complete, or past their deadline by the clock, and the first arrivals of the others.

    ``known`` holds the first arrivals of open sections, ``done`` the sections published within the retention, whose
    stragglers are swallowed. A section waits for the ``members`` of its own time. The clock is the greatest arrival so far.
    """
    key = ["interval", "open_ms"]
    rows = closed.select(*key, "symbol", "arrival_ms")
    if known is not None:
        rows = rows.unionByName(known.select(*rows.columns))
    if done is not None:
        rows = rows.join(done.select("interval", F.col("timestamp").alias("open_ms")), key, "left_anti")
    spans = members.withColumnRenamed("symbol", "m_symbol")
    inside = (F.col("symbol") == F.col("m_symbol")) & (F.col("open_ms") >= F.col("valid_from_ms")) & (
        F.col("valid_to_ms").isNull() | (F.col("open_ms") < F.col("valid_to_ms")))
    rows = rows.join(spans, inside, "left_semi")
    first = rows.groupBy(*key, "symbol").agg(F.min("arrival_ms").alias("arrival_ms"))
    first = first.join(sizes_at(members, first), "open_ms")
    section, by_arrival = Window.partitionBy(*key), Window.partitionBy(*key).orderBy("arrival_ms", "symbol")
    marked = first.withColumn("_n", F.row_number().over(by_arrival)).withColumn("_deadline", F.min("arrival_ms").over(section) + timeout_ms)
    in_time = F.col("arrival_ms") <= F.col("_deadline")
    told = marked.withColumn("_done", F.min(F.when((F.col("_n") == F.col("size")) & in_time, F.col("arrival_ms"))).over(section)).withColumn(
        "_seen", F.count(F.when(in_time, 1)).over(section))
    complete = F.col("_done").isNotNull()
    over = complete | (F.col("_deadline") < clock_ms)
    ready = told.where(over & (F.col("_n") == 1)).select(
        "interval", F.col("open_ms").alias("timestamp"), F.when(complete, F.col("size")).otherwise(F.col("_seen")).cast("long").alias("symbols_count"),
        F.when(complete, "complete").otherwise("timeout").alias("reason"), F.coalesce("_done", "_deadline").alias("published_ms"))
    return ready, told.where(~over).select(*key, "symbol", "arrival_ms")


def live_path(root: str, universe: DataFrame | Callable[[], DataFrame], window_size: int = 200, timeout_ms: int = 5_000, retention_ms: int = tg.MINUTE_MS,
              between: Callable[[str, int], None] = lambda sink, batch_id: None):
    """A ``foreachBatch`` body with ordered sinks below ``root``: live, archive, windows, ready (and rejects).

    ``universe`` names the symbols that a section waits for, as a table or as a function that reads it, which every batch
    calls anew: with ``valid_from_ms`` and ``valid_to_ms`` symbols join and leave while the stream runs, and a section waits
    for those of its own time. ``between`` is told each sink that has finished a batch; tests
    break the run there. Windows and open sections are carried from batch to batch, a row for each symbol and for each
    open section and symbol; the ready log holds one folder a batch.
    """
    names = {n: f"{root.rstrip('/')}/{n}" for n in ("live", "archive", "rejects", "windows", "open", "ready", "clock")}

    def after(closed: DataFrame, batch_id: int) -> None:
        spark, own = closed.sparkSession, query_folder(closed.sparkSession)
        path = {n: f"{p}/{own}" for n, p in names.items()}
        between("archive", batch_id)

        def last(name: str, schema: str | None = None) -> DataFrame | None:
            if not _finished(spark, path[name], batch_id - 1):
                return None
            reader = spark.read if schema is None else spark.read.schema(schema)
            return reader.parquet(f"{path[name]}/batch={batch_id - 1}")

        if not _finished(spark, path["windows"], batch_id):
            _write(pushed_windows(last("windows"), closed, window_size), path["windows"], batch_id, 2)
        between("windows", batch_id)
        if not _finished(spark, path["clock"], batch_id):
            earlier = last("clock", "at_ms long")
            clock = max([r[0] or 0 for f in (closed.agg(F.max("arrival_ms")), earlier) if f is not None for r in f.collect()])
            done = None
            if batch_id > 0:
                done = spark.read.schema(_SECTION + ", batch int").option("basePath", path["ready"]).parquet(path["ready"]).where(
                    (F.col("batch") < batch_id) & (F.col("published_ms") > clock - retention_ms - timeout_ms))
            members = dated(universe() if callable(universe) else universe)
            ready, waiting = marked_sections(last("open", _OPEN), done, closed, members, clock, timeout_ms)
            _write(ready, path["ready"], batch_id, 0)
            between("ready", batch_id)
            _write(waiting, path["open"], batch_id, 2)
            # the mark comes last: until then the batch's sections are worked out again from the batch before
            _write(spark.range(1).select(F.lit(clock).cast("long").alias("at_ms")), path["clock"], batch_id, 2)
        between("sections", batch_id)

    return fan_out(names["live"], names["archive"], names["rejects"], after)
