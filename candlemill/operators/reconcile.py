"""Comparisons of one table with a recomputation, a cache or an outside source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx
from candlemill.operators.rollup import rollup_klines


def rollup_mismatch(bars: DataFrame, rollup: DataFrame, interval: str) -> DataFrame:
    """Buckets whose stored rollup is absent or differs from a fresh fold."""
    fresh = rollup_klines(bars, interval)
    stored = rollup.select(*S.BAR_KEYS, F.col("volume").alias("r_volume"),
                           F.col("high").alias("r_high"), F.col("low").alias("r_low"),
                           F.col("trades_count").alias("r_trades"), F.lit(True).alias("_stored"))
    volume = F.col("volume")
    far = F.abs(F.col("r_volume") - volume) > F.greatest(F.lit(1.0), volume) * 1e-6
    differs = F.col("_stored").isNull() | fx.any_of([
        # a stored NULL never equals a value; it differs from all but NULL
        F.when(F.col("r_volume").isNull() | volume.isNull(), ~F.col("r_volume").eqNullSafe(volume)).otherwise(far),
        *[~F.col(a).eqNullSafe(F.col(b)) for a, b in (("r_trades", "trades_count"), ("r_high", "high"), ("r_low", "low"))]])
    return (fresh.join(stored, S.BAR_KEYS, "left").where(differs)
            .select(*S.BAR_KEYS, F.col("_stored").isNull().alias("missing"),
                    "volume", "r_volume", "trades_count", "r_trades"))


def close_mismatch(bars: DataFrame, rollup: DataFrame, interval: str,
                   tol: float = 0.0) -> DataFrame:
    """Stored buckets whose close differs from the last base bar's close."""
    fresh = rollup_klines(bars, interval).select(*S.BAR_KEYS, F.col("close").alias("base_close"))
    return (rollup.select(*S.BAR_KEYS, "close").join(fresh, S.BAR_KEYS, "inner")
            .where(F.abs(F.col("close") - F.col("base_close")) > tol))


def settled_range(now_ms: int, step: int, bars: int, settle_lag: int = 1) -> tuple[int, int]:
    """Half-open range of the newest closed bars, less ``settle_lag`` unsettled ones."""
    newest = tg.floor_to(now_ms, step) - (1 + settle_lag) * step
    return newest - (bars - 1) * step, newest + step


def reconcile_bars(ours: DataFrame, theirs: DataFrame, price_tol: float = 1e-9,
                   volume_tol: float = 1e-6) -> DataFrame:
    """Bar-by-bar comparison over the union of keys, one flag per kind of difference."""
    columns = S.PRICES + S.VOLUMES + ["trades_count"]
    a = ours.select(*S.BAR_KEYS, *[F.col(c).alias(f"a_{c}") for c in columns],
                    F.lit(True).alias("_a"))
    b = theirs.select(*S.BAR_KEYS, *[F.col(c).alias(f"b_{c}") for c in columns],
                      F.lit(True).alias("_b"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()

    def close(names: list[str], tol: float):
        return fx.all_of([fx.rel_close(F.col(f"a_{c}"), F.col(f"b_{c}"), tol) for c in names])

    return a.join(b, S.BAR_KEYS, "full_outer").select(
        *S.BAR_KEYS,
        both.alias("checked"),
        F.col("_a").isNull().alias("missing_ours"),
        F.col("_b").isNull().alias("missing_theirs"),
        (both & ~close(S.PRICES, price_tol)).alias("price_diff"),
        (both & ~close(S.VOLUMES, volume_tol)).alias("volume_diff"),
        (both & (F.col("a_trades_count") != F.col("b_trades_count"))).alias("count_diff"))


def reconcile(ours: DataFrame, theirs: DataFrame, price_tol: float = 1e-9,
              volume_tol: float = 1e-6, expected_bars: int | None = None) -> DataFrame:
    """Per-symbol summary and status of :func:`reconcile_bars`."""
    flags = reconcile_bars(ours, theirs, price_tol, volume_tol)
    differs = F.col("price_diff") | F.col("volume_diff") | F.col("count_diff")
    names = ["checked", "missing_ours", "missing_theirs", "price_diff", "volume_diff", "count_diff"]
    rows = flags.groupBy("symbol").agg(
        *[F.count_if(c).alias(c) for c in names],
        F.count_if(F.col("checked") & ~differs).alias("matched"))
    short = (F.col("checked") < expected_bars) if expected_bars is not None else F.lit(True)
    wrong = F.col("missing_ours") + F.col("price_diff") + F.col("volume_diff") + F.col("count_diff")
    return rows.withColumn(
        "status",
        F.when(wrong > 0, "FAIL").when(F.col("checked") == 0, "EMPTY")
        .when((F.col("missing_theirs") > 0) & short, "WARN").otherwise("PASS"))


def reconcile_positional(windows: DataFrame, bars: DataFrame, window_size: int,
                         epsilon: float = 1e-5) -> DataFrame:
    """Cached windows against stored bars, position by position, newest first.

    ``windows`` holds ``symbol, pos, t, o, h, l, c, v, qv``. Only positions both
    sides have are compared; a position counts as one kind of difference: time,
    else price, else volume.
    """
    newest = Window.partitionBy("symbol").orderBy(F.col("start_ms").desc())
    stored = (bars.withColumn("_rn", F.row_number().over(newest))
              .where(F.col("_rn") <= window_size).withColumn("pos", F.col("_rn") - 1))
    cached_n = windows.groupBy("symbol").agg(F.count("*").alias("cached"))
    stored_n = stored.groupBy("symbol").agg(F.count("*").alias("stored"))
    pairs = windows.join(
        stored.select("symbol", "pos", "start_ms", *S.PRICES, "volume", "quote_volume"),
        ["symbol", "pos"], "inner")

    def apart(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) > epsilon

    kind = (
        F.when(F.col("t") != F.col("start_ms"), "time")
        .when(fx.any_of([apart(x, y) for x, y in zip("ohlc", S.PRICES)]), "price")
        .when(apart("v", "volume") | apart("qv", "quote_volume"), "volume")
        .otherwise("match")
    )
    counts = pairs.groupBy("symbol").agg(
        F.count("*").alias("compared"),
        *[F.count_if(kind == k).alias(k) for k in ("match", "time", "price", "volume")])
    rows = (cached_n.join(stored_n, "symbol", "full_outer").join(counts, "symbol", "left")
            .fillna(0))
    differing = F.col("time") + F.col("price") + F.col("volume")
    return rows.withColumn(
        "status",
        F.when((F.col("cached") == 0) | (F.col("stored") == 0) | (differing > 0), "FAIL")
        .when(F.col("compared") < window_size, "WARN").otherwise("PASS"))


def shift_probe(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """How many rows equal the label one bar, or two bars, after their start.

    One bar later is the right meaning; two bars later betrays a shifted import.
    """
    keyed = labels.select("symbol", "label_ms", F.col("value").alias("label_value"))
    shifts = F.explode(F.array(F.lit(1), F.lit(2)))
    candidates = (
        rows.select("symbol", "start_ms", "sum_open_interest", shifts.alias("bars_after"))
        .withColumn("label_ms", F.col("start_ms") + F.col("bars_after") * F.lit(tg.BAR_MS)))
    hits = candidates.join(keyed, ["symbol", "label_ms"], "inner").where(
        F.col("sum_open_interest") == F.col("label_value"))
    return hits.groupBy("symbol").agg(
        F.count_if(F.col("bars_after") == 1).alias("match_5m"),
        F.count_if(F.col("bars_after") == 2).alias("match_10m"))


def compare_labels(rows: DataFrame, labels: DataFrame, lo_ms: int, hi_ms: int,
                   live_tol: float = 0.005, exact_tol: float = 1e-9) -> DataFrame:
    """Per symbol: stored rows against history labels, tolerance by source rank."""
    start = F.col("label_ms") - tg.BAR_MS
    wanted = labels.select("symbol", start.alias("start_ms"), F.col("value").alias("label_value"))
    stored = rows.select(*S.BAR_KEYS, "sum_open_interest", "src_rank")
    inside = (F.col("start_ms") >= lo_ms) & (F.col("start_ms") <= hi_ms)
    live = F.col("src_rank") == S.RANK_LIVE
    value, label = F.col("sum_open_interest"), F.col("label_value")
    ok = (live & fx.rel_close(value, label, live_tol)) | (~live & fx.rel_close(value, label, exact_tol))
    found = inside & value.isNotNull()
    counts = wanted.join(stored, S.BAR_KEYS, "left").groupBy("symbol").agg(
        F.count_if(~inside).alias("skipped"),
        F.count_if(found).alias("compared"),
        F.count_if(inside & value.isNull()).alias("missing"),
        F.count_if(found & ok & ~live).alias("ok_calibrated"),
        F.count_if(found & ok & live).alias("ok_live"),
        F.count_if(found & ~ok).alias("mismatched"))
    return counts.withColumn(
        "status",
        F.when(F.col("mismatched") + F.col("missing") > 0, "FAIL")
        .when(F.col("compared") == 0, "WARN").otherwise("PASS"))


def moved_check(plan: DataFrame, table: DataFrame) -> DataFrame:
    """Planned moves against rows found at the target with the planned value."""
    moves = plan.where(F.col("action") == "move")
    at_target = table.where(F.col("src_rank") == S.RANK_ARCHIVE).select(
        "symbol", F.col("start_ms").alias("new_start"), F.col("sum_open_interest").alias("_stored"))
    joined = moves.join(at_target, ["symbol", "new_start"], "left")
    return joined.agg(
        F.count("*").alias("planned"),
        F.count_if(F.col("_stored") == F.col("value")).alias("found"),
    ).withColumn("ok", F.col("planned") == F.col("found"))


def clock_probe(snaps: DataFrame, closes: DataFrame) -> DataFrame:
    """Does a label name the snapshot moment or the moment five minutes earlier?

    The implied price (value / open interest) is set against the close known at
    the label and the one five minutes on; the smaller median deviation (in
    basis points, per symbol and day) tells.
    """
    shifts = F.explode(F.array(F.lit(0).cast("long"), F.lit(tg.BAR_MS).cast("long")))
    priced = snaps.select(
        "symbol", "label_ms", shifts.alias("shift_ms"),
        F.try_divide("sum_open_interest_value", "sum_open_interest").alias("price"),
    ).withColumn("at_ms", F.col("label_ms") + F.col("shift_ms"))
    deviation = F.abs(F.col("price") / F.nullif("close", F.lit(0.0)) - 1.0) * 10_000.0
    day = tg.bucket(F.col("label_ms"), tg.DAY_MS).alias("day_ms")
    joined = priced.join(closes.select("symbol", "at_ms", "close"), ["symbol", "at_ms"], "inner")
    medians = joined.groupBy("symbol", day).agg(
        F.median(F.when(F.col("shift_ms") == 0, deviation)).alias("at_label_bp"),
        F.median(F.when(F.col("shift_ms") != 0, deviation)).alias("after_label_bp"))
    return medians.withColumn(
        "meaning",
        F.when(F.col("at_label_bp") <= F.col("after_label_bp"), "snapshot_at_label")
        .when(F.col("at_label_bp") > F.col("after_label_bp"), "snapshot_after_label"))
