"""Streaming queries built from the processors and the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import filters, windows
from candlemill.operators.sections import monotonic_guard
from candlemill.session import exists, remove, use_rocksdb_state
from candlemill.sources import facts
from candlemill.streaming import processors as P
from candlemill.streaming.advancing import advanced, rebuilt

KEYS = ("symbol", "interval")
_BAR = ("open_ms", *S.PRICES, *S.VOLUMES, "trade_count")
_MARKS = "symbol string, interval string, mark_ms long"


def live_bars_stream(events: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Latest event per key; every event counts, closed or not."""
    use_rocksdb_state(events.sparkSession)
    return events.groupBy(*KEYS).transformWithState(
        P.LiveBar(ttl_ms), P.LiveBar.schema, "Update", "ProcessingTime" if ttl_ms else "None")


def guard_stream(closed: DataFrame) -> DataFrame:
    """Closed bars without replays and reorders."""
    use_rocksdb_state(closed.sparkSession)
    rows = advanced(closed.select(*KEYS, "open_ms", "arrival_ms", "seq"), *KEYS)
    return rows.groupBy(*KEYS).transformWithState(
        P.MonotonicGuard(), P.MonotonicGuard.schema, "Append", "None")


def window_stream(closed: DataFrame, size: int = 200, stored: DataFrame | None = None) -> DataFrame:
    """Changed windows after each batch; ``stored`` seeds them from a rolling window table."""
    use_rocksdb_state(closed.sparkSession)
    seed = None if stored is None else stored.select("symbol", F.inline("bars")).groupBy("symbol")
    rows = advanced(closed.select("symbol", *_BAR, "arrival_ms", "seq"), "symbol")
    return rows.groupBy("symbol").transformWithState(
        P.RollingWindow(size), P.RollingWindow.schema, "Update", "None", seed)


def section_stream(closed: DataFrame, universe: DataFrame | None, timeout_ms: int = 5_000,
                   retention_ms: int = tg.MINUTE_MS, delay: str = "0 seconds",
                   clock: str = "EventTime") -> DataFrame:
    """Cross-section events.

    With ``clock="EventTime"`` timers follow the watermark of the arrival clock,
    so a replay gives the same events; ``"ProcessingTime"`` fires them by the wall
    clock, for arrivals stamped with it.
    """
    use_rocksdb_state(closed.sparkSession)
    rows = closed
    if clock == "EventTime":
        rows = closed.withColumn("arrival_ts", F.timestamp_millis("arrival_ms")).withWatermark(
            "arrival_ts", delay)
    if universe is not None:
        members = universe.select("symbol").distinct()
        size = members.agg(F.count("*").alias("universe_size"))
        # the size travels with every member row; a Parquet universe lists its files when the query is built
        sized = members.withColumn("universe_size", size.scalar())
        rows = rows.join(sized, "symbol", "inner")
    else:
        rows = rows.withColumn("universe_size", F.lit(0).cast("long"))
    return rows.groupBy("interval", "open_ms").transformWithState(
        P.SectionReady(timeout_ms, retention_ms), P.SectionReady.schema, "Append", clock)


def gate_input(events: DataFrame, commands: DataFrame) -> DataFrame:
    """Section events and hold commands (``symbol, interval, at_ms, seq, command``) as the one input of a gate."""
    nothing = {"symbols_count": F.lit(None).cast("long"), "reason": F.lit(None).cast("string"), "timestamp": F.lit(None).cast("long")}
    told = commands.select("interval", F.col("command").alias("kind"), "symbol", "at_ms", "seq", *[c.alias(n) for n, c in nothing.items()])
    made = events.select("interval", F.lit("event").alias("kind"), F.lit(None).cast("string").alias("symbol"),
                         F.col("published_ms").alias("at_ms"), F.col("timestamp").alias("seq"), "symbols_count", "reason", "timestamp")
    return told.unionByName(made)


def hold_stream(rows: DataFrame) -> DataFrame:
    """The events of ``gate_input`` that no held key of their interval suppresses."""
    use_rocksdb_state(rows.sparkSession)
    return rows.groupBy("interval").transformWithState(P.HoldGate(), P.HoldGate.schema, "Append", "None")


def rebuild_input(closed: DataFrame, rebuilds: DataFrame) -> DataFrame:
    """Closed bars and rebuild commands (``symbol, bars, arrival_ms, seq``; bars as in a rolling window) as one input."""
    kind = dict(rebuilds.dtypes)["bars"]
    names = ("open_ms", *S.PRICES, *S.VOLUMES, "trade_count", "arrival_ms", "seq")
    bars = closed.select("symbol", *names, F.lit(None).cast(kind).alias("stored"))
    # a rebuild without bars clears the window
    told = rebuilds.select("symbol", "arrival_ms", "seq", F.coalesce("bars", F.array().cast(kind)).alias("stored"))
    return bars.unionByName(told, allowMissingColumns=True)


def rebuild_stream(rows: DataFrame, size: int = 200) -> DataFrame:
    """Changed windows after each batch of ``rebuild_input``."""
    use_rocksdb_state(rows.sparkSession)
    return rebuilt(rows, size).groupBy("symbol").transformWithState(P.RebuiltWindow(size), P.RebuiltWindow.schema, "Update", "None")


def stream_rollup(events: DataFrame, interval: str, late: str = "10 minutes") -> DataFrame:
    """Preview bars straight from closed 1m bars; the refresh job stays authoritative.

    A bar sent twice is counted once, the first time it is seen.
    """
    step = tg.rollup_step(interval)
    opened = F.timestamp_millis("open_ms").alias("open_ts")
    bars = events.select("*", opened).withWatermark("open_ts", late).dropDuplicatesWithinWatermark(
        ["symbol", "open_ms"])
    window = F.window("open_ts", f"{step // 1000} seconds")
    return (
        bars.groupBy("symbol", window).agg(
            F.min_by("open", "open_ms").alias("open"), F.max("high").alias("high"),
            F.min("low").alias("low"), F.max_by("close", "open_ms").alias("close"),
            *[F.sum(c).alias(c) for c in S.VOLUMES], F.sum("trade_count").alias("trades_count"))
        .select("symbol", F.unix_millis(F.col("window.start")).alias("start_ms"),
                *S.BAR_VALUES))


def silence_monitor(events: DataFrame, stale: str = "60 seconds", late: str = "0 seconds") -> DataFrame:
    """Sessions of uninterrupted arrivals per key; a new session marks a silence before it."""
    rows = events.withColumn("arrival_ts", F.timestamp_millis("arrival_ms")).withWatermark(
        "arrival_ts", late)
    return rows.groupBy(*KEYS, F.session_window("arrival_ts", stale)).agg(
        F.min("arrival_ms").alias("first_ms"), F.max("arrival_ms").alias("last_ms"),
        F.count("*").alias("events")).drop("session_window")


def silence_requests(events: DataFrame, stale_ms: int, quiet_ms: int = 30_000, late: str = "0 seconds") -> DataFrame:
    """Repair requests per interval: silences of its keys, joined while they end within ``quiet_ms`` of each other.

    Two stateful steps: silences are told per key, so a busy interval is no hot key, and only their ends meet by interval.
    The quiet time is event time, so a replay gives the same requests.
    """
    use_rocksdb_state(events.sparkSession)
    rows = events.withColumn("arrival_ts", F.timestamp_millis("arrival_ms")).withWatermark("arrival_ts", late)
    ends = rows.groupBy(*KEYS).transformWithState(P.SilenceEnd(stale_ms), P.SilenceEnd.schema, "Append", "EventTime", eventTimeColumnName="ended_at")
    return ends.groupBy("interval").transformWithState(P.Debounce(quiet_ms), P.Debounce.schema, "Append", "EventTime")


def query_folder(spark) -> str:
    """Folder of the running stream: its id stays with the checkpoint, so another checkpoint overwrites nothing."""
    return f"query={spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"


def fan_out(live_path: str, archive_path: str, reject_path: str,
            after: Callable[[DataFrame, int], None] | None = None):
    """A ``foreachBatch`` body that feeds every sink from one micro-batch.

    All good events reach the live log; the closed ones that pass the guard are
    archived, then handed to ``after`` (sections come last, when the windows
    already hold their bars). Rows that fail to
    parse go to the rejects. The newest archived bar of every symbol is carried
    from batch to batch in a table of one row per symbol.

    The archive is a fact table by month. A bar's version is its arrival, so a
    re-send wins whichever stream brings it. A batch that was archived leaves a
    mark and isn't archived again; if it is lost between the two, the copies have
    equal versions and sequence numbers and the dedup of readers drops them.
    """
    marks_root = f"{archive_path.rstrip('/')}_marks"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = query_folder(spark)
        marks_path = f"{marks_root}/{own}"
        parsed = filters.parse_quantities(batch).persist()
        try:
            good, bad = filters.split_faults(parsed, "bad_field")
            stamp = F.lit(batch_id).cast("long")
            # overwriting the batch's own folder makes a retried batch harmless
            bad.write.mode("overwrite").parquet(f"{reject_path}/{own}/batch={batch_id}")
            windows.live_bar_record(good).withColumn("batch_id", stamp).write.mode(
                "overwrite").parquet(f"{live_path}/{own}/batch={batch_id}")
            guarded = monotonic_guard(good.where("is_final"), list(KEYS)).where("accepted")
            if batch_id > 0:
                marks = spark.read.schema(_MARKS).parquet(f"{marks_path}/batch={batch_id - 1}")
                guarded = guarded.join(marks, list(KEYS), "left").where(
                    F.col("mark_ms").isNull() | (F.col("open_ms") > F.col("mark_ms"))).drop("mark_ms")
            rows = guarded.select(
                "symbol", F.col("open_ms").alias("start_ms"), F.col("close_ms").alias("end_ms"),
                *S.PRICES, *S.VOLUMES, F.col("trade_count").alias("trades_count"),
                F.col("arrival_ms").alias("version"), F.col("seq").alias("ingest_seq"))
            if not exists(spark, f"{marks_path}/batch={batch_id}/_SUCCESS"):
                facts.append_facts(rows, archive_path)
            seen = guarded.groupBy(*KEYS).agg(F.max("open_ms").alias("mark_ms"))
            if batch_id > 0:
                seen = seen.unionByName(marks).groupBy(*KEYS).agg(F.max("mark_ms").alias("mark_ms"))
            seen.write.mode("overwrite").parquet(f"{marks_path}/batch={batch_id}")
            remove(spark, f"{marks_path}/batch={batch_id - 2}")  # a retry needs the one before at most
            if after is not None:
                after(guarded, batch_id)
        finally:
            parsed.unpersist()

    return run


def accounted(events: DataFrame, name: str = "events") -> DataFrame:
    """Attach counters that each micro-batch reports with its progress."""
    return events.observe(
        name, F.count("*").alias("events"), F.count_if("is_final").alias("closed"),
        F.count_if(F.col("bad_field").isNotNull()).alias("parse_errors"))


class BatchCounters(StreamingQueryListener):
    """Keeps what ``accounted`` reports with each micro-batch, one row a batch, in a table.

    A batch that is run again after a failure reports again and replaces its row's folder, so counts are exact. The
    listener runs on the driver and writes a row of sums, whatever the batch's size.
    """

    def __init__(self, spark, path: str, name: str = "events"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress.observedMetrics.get(self.name)
        if told is None or event.progress.numInputRows == 0:
            return
        counts = told.asDict()
        row = self.spark.range(1).select(*[F.lit(counts[c]).cast("long").alias(c) for c in ("events", "closed", "parse_errors")])
        row.write.mode("overwrite").parquet(f"{self.path}/query={event.progress.id}/batch={event.progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_accounted(events: DataFrame, body: Callable[[DataFrame, int], None], counts_path: str, checkpoint: str) -> None:
    """Process everything available now and keep each batch's counters (events, closed ones, parse errors).

    ``events`` are parsed (``bad_field`` names what didn't parse). The counters come with the batch itself: no second pass
    counts them.
    """
    spark = events.sparkSession
    listener = BatchCounters(spark, counts_path)
    spark.streams.addListener(listener)
    try:
        (accounted(events).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # progress is reported behind the batch
    finally:
        spark.streams.removeListener(listener)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available now into one folder per micro-batch.

    Overwriting the batch's own folder makes a retried batch harmless. ``mode`` is
    ``update`` for queries that emit changed rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{query_folder(batch.sparkSession)}/batch={batch_id}")

    query = (stream.writeStream.outputMode(mode).foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def refresh_job(events: DataFrame, body, checkpoint: str, every: str | None = None):
    """Start a rollup refresh that runs whenever new base rows have arrived."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (events.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())
