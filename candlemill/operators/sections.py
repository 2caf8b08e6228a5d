"""Live events and cross-section events, as batch computations.

They define what the streaming operators must produce for the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill import timegrid as tg
from candlemill.operators import ordered
from candlemill.operators.ranges import merge_ranges


def live_bars(events: DataFrame, now_ms: int, interval_ms: int) -> DataFrame:
    """Latest event of each (symbol, interval), unless it has expired by ``now_ms``."""
    keys = ["symbol", "interval"]
    newest = Window.partitionBy(*keys).orderBy(F.col("arrival_ms").desc(), F.col("seq").desc())
    return (
        events.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") == 1).drop("_rn")
        .where(F.lit(now_ms) - F.col("arrival_ms") <= 2 * interval_ms)
    )


def monotonic_guard(events: DataFrame, keys: list[str], chunk_ms: int = tg.HOUR_MS) -> DataFrame:
    """Flag events whose open time exceeds every earlier one of their key.

    Order is arrival, then ``seq``. The last accepted open time equals the
    running maximum, so a prefix maximum decides without any state.
    """
    rows = ordered.prefix_max(events, keys, ["arrival_ms", "seq"], F.col("open_ms"), "_high",
                              tg.whole(F.col("arrival_ms"), chunk_ms))
    accepted = F.col("_high").isNull() | (F.col("open_ms") > F.col("_high"))
    return rows.withColumn("accepted", accepted).drop("_high")


def sections(closed: DataFrame, universe: DataFrame | None, timeout_ms: int) -> DataFrame:
    """One ready event per (interval, open time).

    Published when the last universe symbol reports, or ``timeout_ms`` after the
    first report with the symbols seen by then. Without a universe only the
    timeout publishes. Later reports are swallowed; they are taken to arrive
    within the retention of a live run, which forgets a section after it.
    """
    key = ["interval", "open_ms"]
    rows = closed
    size = F.lit(0)
    if universe is not None:
        members = universe.select("symbol").distinct()
        rows = rows.join(members, "symbol", "left_semi")
        size = members.agg(F.count("*").alias("n")).scalar()
    first = rows.groupBy(*key, "symbol").agg(F.min("arrival_ms").alias("arrival_ms"))
    # at most one row per universe symbol is left in a section
    by_arrival = Window.partitionBy(*key).orderBy("arrival_ms", "symbol")
    section = Window.partitionBy(*key)
    marked = (
        first.withColumn("_n", F.row_number().over(by_arrival))
        .withColumn("_deadline", F.min("arrival_ms").over(section) + timeout_ms))
    in_time = F.col("arrival_ms") <= F.col("_deadline")
    return (
        marked.withColumn("_size", size).groupBy(*key, "_deadline", "_size").agg(
            F.min(F.when((F.col("_n") == F.col("_size")) & in_time, F.col("arrival_ms")))
            .alias("_done"),
            F.count_if(in_time).alias("_seen"))
        .select(
            "interval", F.col("open_ms").alias("timestamp"),
            F.when(F.col("_done").isNotNull(), F.col("_size")).otherwise(F.col("_seen"))
            .cast("long").alias("symbols_count"),
            F.when(F.col("_done").isNotNull(), "complete").otherwise("timeout").alias("reason"),
            F.coalesce("_done", "_deadline").alias("published_ms"))
    )


def derive_sections(events: DataFrame, base: str, intervals: list[str]) -> DataFrame:
    """Base events plus the event of every coarser bucket a base bar closes."""
    base_ms = tg.interval_ms(base)
    served = F.array(*[
        F.struct(F.lit(iv).alias("interval"), F.lit(tg.rollup_step(iv)).cast("long").alias("step"))
        for iv in intervals])
    end = F.col("timestamp") + base_ms
    closing = F.filter(served, lambda s: F.pmod(end, s["step"]) == 0)
    own = F.struct(F.col("interval"), F.lit(base_ms).cast("long").alias("step"))
    every = F.when(F.col("interval") == base, F.concat(F.array(own), closing)).otherwise(F.array(own))
    kept = [c for c in events.columns if c not in ("interval", "timestamp", "reason")]
    return (
        events.withColumn("_end", end).withColumn("_s", F.explode(every))
        .select(
            F.col("_s.interval").alias("interval"),
            F.when(F.col("_s.interval") == F.col("interval"), F.col("timestamp"))
            .otherwise(F.col("_end") - F.col("_s.step")).alias("timestamp"),
            F.when(F.col("_s.interval") == F.col("interval"), F.col("reason"))
            .otherwise("derived").alias("reason"),
            *kept)
    )


def suppress_held(events: DataFrame, holds: DataFrame, requeue: bool = False) -> DataFrame:
    """Drop events published while some key of their interval is held for repair.

    ``holds`` is ``interval, held_from_ms, held_to_ms`` (half-open). With
    ``requeue`` a held event is published when its last hold ends instead.
    """
    spans = merge_ranges(
        holds.select("interval", F.col("held_from_ms").alias("from_ms"),
                     F.col("held_to_ms").alias("to_ms")), ["interval"])
    chunks = F.explode(F.sequence(tg.whole(F.col("from_ms"), tg.DAY_MS),
                                  tg.whole(F.col("to_ms") - 1, tg.DAY_MS)))
    spans = spans.where(F.col("to_ms") > F.col("from_ms")).select(
        F.col("interval").alias("h_interval"), "from_ms", "to_ms", chunks.alias("h_chunk"))
    rows = events.withColumn("_chunk", tg.whole(F.col("published_ms"), tg.DAY_MS))
    held = ((F.col("interval") == F.col("h_interval")) & (F.col("_chunk") == F.col("h_chunk"))
            & (F.col("published_ms") >= F.col("from_ms")) & (F.col("published_ms") < F.col("to_ms")))
    if not requeue:
        return rows.join(spans, held, "left_anti").drop("_chunk")
    return rows.join(spans, held, "left").withColumn(
        "published_ms", F.coalesce("to_ms", "published_ms")).select(*events.columns)


HOLD, RELEASE = "hold", "release"
# a command takes effect before an event of the same millisecond
_HOLD_ORDER = ["at_ms", "_event", "seq"]


def held_keys(commands: DataFrame, chunk_ms: int = tg.DAY_MS) -> DataFrame:
    """How many holders each key has before and after every command, as ``before`` and ``after``.

    ``commands``: ``symbol, interval, at_ms, seq, command``. Every hold counts one more, every release one less; a release
    of a key that nobody holds does nothing. Keys are told apart without regard to the symbol's case.
    """
    rows = commands.withColumn("symbol", F.upper("symbol"))
    step = F.when(F.col("command") == HOLD, 1).when(F.col("command") == RELEASE, -1).otherwise(0)
    return ordered.bounded_count(rows, ["symbol", "interval"], ["at_ms", "seq"], step, "before", "after",
                                 tg.whole(F.col("at_ms"), chunk_ms))


def suppress_counted(events: DataFrame, commands: DataFrame, chunk_ms: int = tg.DAY_MS) -> DataFrame:
    """Drop events published while any key of their interval has a holder.

    A sweep over commands and events: a key that gets its first holder adds one to its interval's held keys, one that
    loses its last takes one away, and an event goes if the sum before it isn't zero. Derive events of coarser intervals
    from what is left, so that they go with their base event.
    """
    keys = held_keys(commands, chunk_ms)
    turn = F.when((F.col("before") == 0) & (F.col("after") == 1), 1).when((F.col("before") == 1) & (F.col("after") == 0), -1)
    turns = keys.withColumn("_turn", turn).where(F.col("_turn").isNotNull()).select(
        "interval", "at_ms", "seq", F.col("symbol").alias("_by"), "_turn", F.lit(0).alias("_event"))
    asked = events.withColumn("_row", F.struct(*events.columns)).select(
        "interval", F.col("published_ms").alias("at_ms"), F.col("timestamp").alias("seq"), F.lit("").alias("_by"),
        F.lit(0).alias("_turn"), F.lit(1).alias("_event"), "_row")
    both = turns.unionByName(asked, allowMissingColumns=True)
    told = ordered.bounded_count(both, ["interval"], [*_HOLD_ORDER, "_by"], F.col("_turn"), "_held", "_left",
                                 tg.whole(F.col("at_ms"), chunk_ms))
    return told.where((F.col("_event") == 1) & (F.col("_held") == 0)).select("_row.*")


def section_latency(events: DataFrame, universe_size: int, steps: dict[str, int]) -> DataFrame:
    """Delay between a section's close and its event, and how much of the market it holds."""
    step = F.create_map(*[F.lit(x) for pair in steps.items() for x in pair])[F.col("interval")]
    close = F.col("timestamp") + F.coalesce(step, F.lit(tg.MINUTE_MS))
    share = (F.col("symbols_count") * 100.0 / universe_size) if universe_size > 0 else F.lit(100.0)
    complete = (F.col("symbols_count") >= universe_size) if universe_size > 0 else F.lit(False)
    return events.select(
        "interval", "timestamp", "symbols_count", "published_ms",
        close.alias("close_ms"), (F.col("published_ms") - close).alias("latency_ms"),
        share.alias("coverage_pct"),
        F.when(complete, "Complete").otherwise("Partial").alias("trigger"))


def recent_events(events: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` ready events, shown oldest first."""
    order = ["published_ms", "interval", "timestamp"]
    newest = events.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return newest.orderBy(*order)
