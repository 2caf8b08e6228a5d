"""Served windows: the last closed bars of a symbol, their text form and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx
from candlemill.operators.panel import last_n

# Short names of the served bar, in array order.
BAR_FIELDS = ["t", "o", "h", "l", "c", "v", "qv", "tbv", "tbqv", "n"]
LIVE_FIELDS = BAR_FIELDS + ["x"]
_SOURCES = ["start_ms", *S.PRICES, *S.VOLUMES, "trades_count"]


def short_bar() -> Column:
    """A bar under its served field names."""
    return F.struct(*[F.col(src).alias(name) for src, name in zip(_SOURCES, BAR_FIELDS)])


def rolling_window(bars: DataFrame, size: int = 200) -> DataFrame:
    """Newest ``size`` bars of each symbol, newest first, as one array."""
    # the array is bounded by ``size``: only that many rows per symbol get here
    return (
        last_n(bars, size).withColumn("_bar", short_bar()).groupBy("symbol")
        .agg(F.sort_array(F.collect_list("_bar"), asc=False).alias("bars"))
    )


def compact_bar(bar: Column) -> Column:
    """A served bar as keyless array text; time and count stay integers."""
    return F.concat(F.lit("["), F.concat_ws(",", *[
        bar[name].cast("string") for name in BAR_FIELDS]), F.lit("]"))


def compact_bars(bars: DataFrame) -> DataFrame:
    return bars.select(*S.BAR_KEYS, compact_bar(short_bar()).alias("payload"))


def live_bar_record(events: DataFrame) -> DataFrame:
    """Live bars with the 11 served fields, as an object and as a keyless array."""
    named = F.struct(
        F.col("open_ms").alias("t"),
        *[F.col(src).alias(name) for src, name in zip(S.PRICES + S.VOLUMES, BAR_FIELDS[1:9])],
        F.col("trade_count").alias("n"),
        F.when(F.col("is_final"), 1).otherwise(0).alias("x"))
    return events.withColumn("_b", named).select(
        "symbol", "interval", F.to_json("_b").alias("record"),
        F.concat(F.lit("["), F.concat_ws(",", *[
            F.col(f"_b.{name}").cast("string") for name in LIVE_FIELDS]), F.lit("]")).alias("payload"))


def _shape_faults(o: Column, h: Column, l: Column, c: Column) -> list[tuple[Column, str]]:
    return [
        ((o <= 0) | (h <= 0) | (l <= 0) | (c <= 0), "non_positive_price"),
        (h < l, "high_below_low"),
        ((h < o) | (h < c), "high_below_body"),
        ((l > o) | (l > c), "low_above_body"),
    ]


def validate_compact(windows: DataFrame) -> DataFrame:
    """First fault of each serialized bar in ``payload``; NULL if it is sound."""
    parts = F.from_json("payload", "array<string>")
    rows = windows.withColumn("_p", parts)
    cell = {name: F.get(F.col("_p"), F.lit(i)) for i, name in enumerate(BAR_FIELDS)}
    rows = rows.withColumns({
        **{f"_{n}": fx.number(F.trim(cell[n])) for n in BAR_FIELDS[1:9]},
        "_t": cell["t"].try_cast("long"), "_n": cell["n"].try_cast("long")})
    v = {name: F.col(f"_{name}") for name in BAR_FIELDS}
    fault = fx.first_reason(
        (F.col("_p").isNull(), "not_an_array"),
        (F.size("_p") != len(BAR_FIELDS), "wrong_length"),
        (fx.any_of([v[n].isNull() for n in BAR_FIELDS]), "not_a_number"),
        (v["t"] <= 0, "time"),
        *_shape_faults(v["o"], v["h"], v["l"], v["c"]),
        ((v["v"] < 0) | (v["qv"] < 0), "negative_volume"),
        (v["n"] < 0, "negative_trades"),
    )
    return rows.withColumn("fault", fault).withColumn("t", v["t"]).select(
        *windows.columns, "t", "fault")


def inspect_window(windows: DataFrame, step: int, now_ms: int, expected: int = 200, universe: DataFrame | None = None) -> DataFrame:
    """Order, continuity, freshness and length of each served window; EMPTY for a ``universe`` symbol without one.

    ``windows`` holds one row per list position (``symbol, pos, payload``, newest
    first) and at most a few hundred rows per symbol.
    """
    checked = validate_compact(windows).withColumn("_sound", F.col("fault").isNull())
    by_position = Window.partitionBy("symbol", "_sound").orderBy("pos")
    apart = F.when(F.col("_sound"), F.col("t") - F.lead("t").over(by_position))
    sound_pos = F.when(F.col("_sound"), F.col("pos"))
    rows = checked.withColumn("_apart", apart).groupBy("symbol").agg(
        F.count("*").alias("length"), F.count_if(~F.col("_sound")).alias("bad_bars"),
        F.min_by("t", sound_pos).alias("head_ms"), F.max_by("t", sound_pos).alias("tail_ms"),
        F.count_if(F.col("_apart") <= 0).alias("out_of_order"),
        F.count_if(F.col("_apart") > step).alias("gaps"),
        F.sum(F.when(F.col("_apart") > step, tg.whole(F.col("_apart"), step) - 1).otherwise(0)).alias("missing"))
    newest_closed = tg.floor_to(now_ms, step) - step
    if universe is not None:
        # bars without a symbol are no symbol's window
        rows = rows.where(F.col("symbol").isNotNull()).join(universe.select("symbol").distinct(), "symbol", "full").fillna(
            0, ["length", "bad_bars", "out_of_order", "gaps", "missing"])
    rows = rows.withColumn("corrupt", F.col("bad_bars") + F.col("out_of_order")).withColumn(
        "head_lag", F.greatest(tg.whole(F.lit(newest_closed) - F.col("head_ms"), step), F.lit(0)))
    status = (
        F.when(F.col("length") == 0, "EMPTY")
        .when(F.col("head_ms").isNull(), "CORRUPT")
        .when((F.col("corrupt") > 0) | (F.col("gaps") > 0), "FAIL")
        .when(F.col("head_lag") > 2, "STALE")
        .when(F.col("length") < expected, "SHORT")
        .when(F.col("head_lag") > 0, "WARN").otherwise("PASS"))
    return rows.withColumn("status", status).select(
        "symbol", "length", "head_ms", "tail_ms", "head_lag", "gaps", "missing", "corrupt", "status")


def validate_live(records: DataFrame, universe: DataFrame, interval_ms: int,
                  now_ms: int) -> DataFrame:
    """Status of every universe symbol's live bar.

    ``records`` holds ``symbol`` and the 11 fields as text, plus ``ttl_s`` if
    known (-1 means no expiry was set).
    """
    rows = universe.select("symbol").distinct().join(
        records.withColumn("_present", F.lit(True)), "symbol", "left")
    text = {n: F.col(n) for n in LIVE_FIELDS}
    num = {n: fx.number(F.trim(text[n])) for n in BAR_FIELDS[1:9]}
    t, n = F.trim(text["t"]).try_cast("long"), F.trim(text["n"]).try_cast("long")
    faults = fx.findings(
        *[(cond, F.lit(name)) for cond, name in (
            *_shape_faults(num["o"], num["h"], num["l"], num["c"]),
            (fx.any_of([num[k] < 0 for k in ("v", "qv", "tbv", "tbqv")]), "negative_volume"),
            (n < 0, "negative_trades"),
            (~F.trim(text["x"]).isin("0", "1"), "final_flag"))])
    absent = fx.findings(*[
        (F.coalesce(text[k], F.lit("")) == "", F.lit(f"missing_{k}")) for k in LIVE_FIELDS])
    unparsed = fx.any_of([t.isNull(), n.isNull(), *[c.isNull() for c in num.values()]])
    notes = (F.when(F.size(absent) > 0, absent)
             .when(unparsed, F.array(F.lit("not_a_number"))).otherwise(faults))
    age = F.lit(now_ms) - t
    ttl = F.col("ttl_s") if "ttl_s" in records.columns else F.lit(-1)
    status = (
        F.when(F.col("_present").isNull(), "MISSING")
        .when(F.size(notes) > 0, "CORRUPT")
        .when(age < -10_000, "WARN")
        .when(age > 2 * interval_ms, "STALE")
        .when((ttl <= 0) & (ttl != -1), "WARN").otherwise("PASS"))
    return rows.select(
        "symbol", status.alias("status"),
        F.when(F.col("_present"), F.array_join(notes, ";")).alias("notes"),
        F.when(F.col("_present"), age).alias("age_ms"))
