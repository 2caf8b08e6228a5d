"""The live path as a whole: counted holds, windows rebuilt while the feed runs, ordered sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.operators import filters, sections, windows
from candlemill.sources import facts, landing
from candlemill.streaming import jobs, livepath
from workload.base import (
    CTES, DAY, HOUR, MINUTE, SECTION_TIMEOUT, SPAN_FROM, bars, fresh, guard_events, kline_events, query, sections_1h,
    ticks, universe,
)
from workload.streams import _DERIVED, _SILENT, _replayed

# --- counted holds: five keys of one interval; two releases for every hold, many of them without one ---------------

CTES["hold_commands"] = """
SELECT 'k' || (uid % 5) AS symbol, '1h' AS interval, t_ms AS at_ms, seq,
       CASE WHEN seq % 50 = 0 THEN 'hold' ELSE 'release' END AS command FROM ticks WHERE seq % 50 IN (0, 20, 40)"""
CTES["hold_walk"] = """
SELECT symbol, interval, at_ms, s - least(0, min(s) OVER (PARTITION BY symbol ORDER BY at_ms, seq)) AS holders
FROM (SELECT *, sum(CASE command WHEN 'hold' THEN 1 ELSE -1 END) OVER (PARTITION BY symbol ORDER BY at_ms, seq) AS s FROM hold_commands)
QUALIFY row_number() OVER (PARTITION BY symbol, at_ms ORDER BY seq DESC) = 1"""
CTES["free_sections"] = """
SELECT * FROM sections_1h WHERE (interval, timestamp) NOT IN (
  SELECT (e.interval, e.timestamp) FROM (SELECT * FROM sections_1h, (SELECT DISTINCT symbol FROM hold_walk)) e
  ASOF JOIN hold_walk w ON w.symbol = e.symbol AND w.at_ms <= e.published_ms WHERE holders > 0)"""
_FREE = "SELECT interval, timestamp, symbols_count, reason, published_ms FROM free_sections " + "".join(
    f"""UNION ALL SELECT '{iv}', timestamp + 3600000 - {ms}, symbols_count, 'derived', published_ms
FROM free_sections WHERE (timestamp + 3600000) % {ms} = 0
""" for iv, ms in _DERIVED.items())


def hold_commands(spark, sf):
    return ticks(spark, sf).where("seq % 50 IN (0, 20, 40)").select(
        F.concat(F.lit("K"), (F.col("uid") % 5).cast("string")).alias("symbol"), F.lit("1h").alias("interval"), F.col("t_ms").alias("at_ms"), "seq",
        F.when(F.col("seq") % 50 == 0, sections.HOLD).otherwise(sections.RELEASE).alias("command"))


@query(_FREE)
def counted_holds(spark, sf):
    """Section events that no holder suppresses, and what is derived from them."""
    kept = sections.suppress_counted(sections_1h(spark, sf), hold_commands(spark, sf))
    return sections.derive_sections(kept, "1h", list(_DERIVED))


@query(_FREE)
def hold_stream(spark, sf):
    """The same from a stream of commands and events."""
    rows = jobs.gate_input(sections_1h(spark, sf), hold_commands(spark, sf)).withColumn("arrival_ms", F.col("at_ms"))
    path = fresh(spark, "holds")
    _replayed(spark, rows, "holds", lambda stream, checkpoint: jobs.run_to_table(
        sections.derive_sections(jobs.hold_stream(stream), "1h", list(_DERIVED)), path, checkpoint))
    return spark.read.parquet(path).drop("batch", "query")


# --- windows rebuilt while bars arrive: every symbol on day 10, again on day 20; one is cleared ------------------------

_SIZE = 50
_REBUILDS = [SPAN_FROM + 10 * DAY, SPAN_FROM + 20 * DAY]
CTES["rebuilt"] = f"""
SELECT symbol, start_ms AS t, close AS c FROM bars WHERE start_ms < {_REBUILDS[1]} AND symbol <> 'error'
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY start_ms DESC) <= {_SIZE}"""
CTES["after_rebuild"] = f"""
SELECT g.symbol, open_ms AS t, price AS c FROM guard_events g LEFT JOIN (SELECT symbol, max(t) AS head FROM rebuilt GROUP BY 1) r ON r.symbol = g.symbol
WHERE arrival_ms >= {_REBUILDS[1]} QUALIFY open_ms > coalesce(greatest(head, max(open_ms) OVER (
  PARTITION BY g.symbol ORDER BY arrival_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), -1)"""


@query(f"""SELECT symbol, t, c, row_number() OVER (PARTITION BY symbol ORDER BY t DESC) - 1 AS pos
           FROM (SELECT * FROM rebuilt UNION ALL SELECT * FROM after_rebuild) QUALIFY pos < {_SIZE}""")
def rebuild_stream(spark, sf):
    """Windows that are replaced twice by stored bars while closed bars go on arriving."""
    closed = guard_events(spark, sf).withColumns({
        **{c: F.col("price") for c in S.PRICES + S.VOLUMES}, "trade_count": F.col("uid")}).drop("price", "uid")
    told = None
    for at in _REBUILDS:
        kept = windows.rolling_window(bars(spark, sf).where((F.col("start_ms") < at) & (F.col("symbol") != "error")), _SIZE)
        rows = universe(spark, sf).join(kept, "symbol", "left").withColumns({
            "arrival_ms": F.lit(at).cast("long"), "seq": F.lit(-1).cast("long")})
        told = rows if told is None else told.unionByName(rows)
    path = fresh(spark, "rebuilt")
    _replayed(spark, jobs.rebuild_input(closed, told), "rebuilt", lambda stream, checkpoint: jobs.run_to_table(
        jobs.rebuild_stream(stream, _SIZE), path, checkpoint, "update"))
    updates = spark.read.option("basePath", path).parquet(path)
    newest = updates.groupBy("symbol").agg(F.max_by("bars", "batch").alias("bars"))
    return newest.select("symbol", F.posexplode("bars").alias("pos", "bar")).select(
        "symbol", F.col("bar.t").alias("t"), F.col("bar.c").alias("c"), F.col("pos").cast("long").alias("pos"))


# --- one run through all sinks -------------------------------------------------------------------------------------

CTES["path_accepted"] = """
SELECT symbol, '1h' AS interval, open_ms, price, arrival_ms, seq FROM (
  SELECT symbol, t_ms - t_ms % 3600000 AS open_ms, price, t_ms AS arrival_ms, seq, coalesce(t_ms - t_ms % 3600000 > max(t_ms - t_ms % 3600000) OVER (
           PARTITION BY symbol ORDER BY t_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS ok
  FROM ticks WHERE seq % 5 <> 1 AND seq % 19 <> 0) WHERE ok"""
CTES["path_sections"] = f"""
SELECT open_ms, deadline, size, min(arrival_ms) FILTER (WHERE n = size AND arrival_ms <= deadline) AS done, count(*) FILTER (WHERE arrival_ms <= deadline) AS seen
FROM (SELECT *, row_number() OVER (PARTITION BY open_ms ORDER BY arrival_ms, symbol) AS n, min(arrival_ms) OVER (PARTITION BY open_ms) + {SECTION_TIMEOUT} AS deadline,
             (SELECT count(*) FROM universe) AS size FROM path_accepted) GROUP BY 1, 2, 3"""


def run_path(spark, sf, members):
    """Hourly bars, some of which don't parse, through the live path; returns its folder."""
    rows = kline_events(spark, sf).withColumns({
        "interval": F.lit("1h"), "open_ms": F.col("arrival_ms") - F.col("arrival_ms") % HOUR, "is_final": F.col("seq") % 5 != 1,
        "high": F.when(F.col("seq") % 19 == 0, "broken").otherwise(F.col("high"))}).withColumn("close_ms", F.col("open_ms") + (HOUR - 1))
    root = fresh(spark, "path")
    body = livepath.live_path(root, members, _SIZE, SECTION_TIMEOUT, DAY)

    def run(stream, checkpoint):
        stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    _replayed(spark, rows, "path", run)
    return root


@query(f"""
SELECT 'archive' AS sink, symbol AS name, open_ms AS at_ms, price AS value, arrival_ms AS told_ms FROM path_accepted
UNION ALL SELECT 'window', symbol, open_ms, price, row_number() OVER (PARTITION BY symbol ORDER BY open_ms DESC) - 1 AS pos FROM path_accepted QUALIFY pos < {_SIZE}
UNION ALL SELECT 'ready', CASE WHEN done IS NOT NULL THEN 'complete' ELSE 'timeout' END, open_ms,
                 CAST(CASE WHEN done IS NOT NULL THEN size ELSE seen END AS DOUBLE), coalesce(done, deadline)
          FROM path_sections WHERE done IS NOT NULL OR deadline < (SELECT max(arrival_ms) FROM path_accepted)""")
def live_path(spark, sf):
    """Archive, windows and ready events of one run over hourly bars."""
    root = run_path(spark, sf, universe(spark, sf))
    archive = facts.scan_bars(spark, f"{root}/archive").select(
        F.lit("archive").alias("sink"), F.col("symbol").alias("name"), F.col("start_ms").alias("at_ms"), F.col("close").alias("value"), F.col("version").alias("told_ms"))
    held = spark.read.option("basePath", f"{root}/windows").parquet(f"{root}/windows")
    window = held.where(F.col("batch") == held.agg(F.max("batch").alias("n")).scalar()).select("symbol", F.posexplode("bars").alias("pos", "bar")).select(
        F.lit("window"), "symbol", F.col("bar.t"), F.col("bar.c"), F.col("pos").cast("long"))
    ready = spark.read.parquet(f"{root}/ready").select(F.lit("ready"), "reason", "timestamp", F.col("symbols_count").cast("double"), "published_ms")
    return archive.union(window).union(ready)


# a member that joins in the middle: earlier sections don't wait for it and don't count it
_JOINS = SPAN_FROM + 12 * DAY
CTES["joined_sections"] = f"""
SELECT open_ms, deadline, size, min(arrival_ms) FILTER (WHERE n = size AND arrival_ms <= deadline) AS done, count(*) FILTER (WHERE arrival_ms <= deadline) AS seen
FROM (SELECT *, row_number() OVER (PARTITION BY open_ms ORDER BY arrival_ms, symbol) AS n, min(arrival_ms) OVER (PARTITION BY open_ms) + {SECTION_TIMEOUT} AS deadline,
             (SELECT count(*) FROM universe) - CASE WHEN open_ms < {_JOINS} THEN 1 ELSE 0 END AS size
      FROM path_accepted WHERE symbol <> 'error' OR open_ms >= {_JOINS}) GROUP BY 1, 2, 3"""


@query("""SELECT open_ms AS timestamp, CASE WHEN done IS NOT NULL THEN size ELSE seen END AS symbols_count,
                 CASE WHEN done IS NOT NULL THEN 'complete' ELSE 'timeout' END AS reason, coalesce(done, deadline) AS published_ms
          FROM joined_sections WHERE done IS NOT NULL OR deadline < (SELECT max(arrival_ms) FROM path_accepted)""")
def changing_universe(spark, sf):
    """Ready events of a live path whose universe grows while it runs."""
    members = universe(spark, sf).withColumn("valid_from_ms", F.when(F.col("symbol") == "error", _JOINS).otherwise(0))
    root = run_path(spark, sf, lambda: members)
    return spark.read.parquet(f"{root}/ready").select("timestamp", "symbols_count", "reason", "published_ms")


# --- counters of a stream's batches ------------------------------------------------------------------------------------

@query("""SELECT count(*) AS events, count(*) FILTER (WHERE is_final) AS closed, count(*) FILTER (WHERE seq % 19 = 0) AS parse_errors FROM kline_events""")
def stream_accounting(spark, sf):
    """The sums of what every batch of a stream reported about itself."""
    rows = kline_events(spark, sf).withColumn("high", F.when(F.col("seq") % 19 == 0, "broken").otherwise(F.col("high")))
    counts, out = fresh(spark, "counts"), fresh(spark, "counted")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/{jobs.query_folder(batch.sparkSession)}/batch={batch_id}")

    _replayed(spark, rows, "counts", lambda stream, checkpoint: jobs.run_accounted(filters.parse_quantities(stream), write, counts, checkpoint))
    return spark.read.parquet(counts).agg(*[F.sum(c).alias(c) for c in ("events", "closed", "parse_errors")])


# --- requests for repair after silences ----------------------------------------------------------------------------------

_QUIET = 30 * MINUTE
CTES["silence_ends"] = f"""
SELECT interval, arrival_ms AS t FROM (SELECT symbol, interval, arrival_ms, lag(arrival_ms) OVER (PARTITION BY symbol, interval ORDER BY arrival_ms, seq) AS prev
                                       FROM kline_events) WHERE arrival_ms - prev > {_SILENT}"""


@query(f"""SELECT interval, min(t) AS from_ms, max(t) AS last_end_ms, max(t) + {_QUIET} AS fire_ms FROM (
             SELECT interval, t, sum(CASE WHEN t - prev <= {_QUIET} THEN 0 ELSE 1 END) OVER (PARTITION BY interval ORDER BY t ROWS UNBOUNDED PRECEDING) AS island
             FROM (SELECT interval, t, lag(t) OVER (PARTITION BY interval ORDER BY t) AS prev FROM silence_ends)) GROUP BY interval, island""")
def silence_requests(spark, sf):
    """Repair requests from a stream of events; an outsider's event fires the last ones."""
    rows = kline_events(spark, sf).select("symbol", "interval", "arrival_ms")
    last = F.lit(SPAN_FROM + 400 * DAY).cast("long")
    rows = rows.unionByName(universe(spark, sf).limit(1).select(F.lit("none").alias("symbol"), F.lit("none").alias("interval"), last.alias("arrival_ms")))
    path = fresh(spark, "requests")
    _replayed(spark, rows, "requests", lambda stream, checkpoint: jobs.run_to_table(jobs.silence_requests(stream, _SILENT, _QUIET), path, checkpoint))
    return spark.read.parquet(path).drop("batch", "query")
