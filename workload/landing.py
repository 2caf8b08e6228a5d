"""Sources, sinks, projections and row predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx
from candlemill.operators import filters, gaps, panel, sections, snap, windows
from candlemill.plans import refresh
from candlemill.operators.rollup import rollup_klines
from candlemill.sources import facts, gapfile, landing
from workload.base import (
    crc_sql, BAR, CTES, DAY, HOUR, MEASURES, MINUTE, NOW, SPAN_FROM, STEPS, bars, bars_at, bars_raw, fresh,
    gaps_5m, kline_events, oi_raw, query, ratio_raw, round_sql, rounded, sections_1h, table_of, ticks,
    universe,
)

SCAN_FROM, SCAN_TO = SPAN_FROM + 4 * DAY, SPAN_FROM + 19 * DAY


@query(f"""SELECT symbol, start_ms, version, ingest_seq, close FROM bars_raw
           WHERE symbol IN ('click', 'view') AND start_ms >= {SCAN_FROM} AND start_ms < {SCAN_TO}""")
def scan_bars(spark, sf):
    path = table_of(bars_raw(spark, sf), "bars")
    rows = facts.scan_bars(spark, path, S.BARS_1M, ["click", "view"], SCAN_FROM, SCAN_TO)
    return rows.select(*S.BAR_KEYS, "version", "ingest_seq", "close")


@query(f"""SELECT symbol, start_ms, end_ms, open, high, low, close, {round_sql(*S.VOLUMES)}, trades_count
           FROM bars""")
def rest_klines(spark, sf):
    """Bars as REST pages of an hour, each ending in a cut-off array, and back."""
    def text(c):
        return F.col(c).cast("string")

    cells = F.array(text("start_ms"), *[text(c) for c in S.PRICES], text("volume"), text("end_ms"),
                    text("quote_volume"), text("trades_count"), text("taker_buy_volume"),
                    text("taker_buy_quote_volume"), F.lit("0"))
    # at most 60 bars per page
    pages = bars(spark, sf).groupBy("symbol", tg.bucket(F.col("start_ms"), HOUR).alias("h")).agg(
        F.collect_list(cells).alias("rows"))
    cut = F.array(F.array(F.col("h").cast("string"), F.lit("1.0")))
    bodies = pages.select("symbol", F.to_json(F.concat("rows", cut)).alias("body"))
    good, _ = filters.split_faults(landing.parse_rest_klines(bodies), "bad_field")
    return rounded(good, *S.VOLUMES)


@query("""SELECT symbol, interval, open_ms, close_ms, price AS high, price AS taker_buy_volume,
                 trade_count, is_final, seq FROM kline_events WHERE seq % 11 <> 0""")
def stream_frames(spark, sf):
    """Events as stream frames, half of them wrapped; frames without a symbol vanish."""
    ev = kline_events(spark, sf)
    symbol = F.when(F.col("seq") % 11 != 0, F.col("symbol")).otherwise("")
    bar = F.to_json(F.struct(
        symbol.alias("s"), F.col("interval").alias("i"), F.col("open_ms").alias("t"),
        F.col("close_ms").alias("T"), *[F.col(c).alias(k) for c, k in landing.FRAME_TEXT.items()],
        F.col("trade_count").alias("n"), F.col("is_final").alias("x")))
    bare = F.concat(F.lit('{"e":"kline","k":'), bar, F.lit("}"))
    wrapped = F.concat(F.lit('{"stream":"s","data":'), bare, F.lit("}"))
    frames = ev.select("seq", F.when(F.col("seq") % 2 == 0, wrapped).otherwise(bare).alias("body"))
    good = filters.parse_quantities(landing.decode_kline_frames(frames)).where("bad_field IS NULL")
    return good.select("symbol", "interval", "open_ms", "close_ms", "high", "taker_buy_volume",
                       "trade_count", "is_final", "seq")


def _history_body(key: str, value, label):
    return F.concat(F.lit('[{"' + key + '":"'), value, F.lit('","timestamp":'), label.cast("string"),
                    F.lit("}]"))


@query("""SELECT symbol, snap_ms AS label_ms, sum_open_interest AS value, ingest_seq FROM oi_raw
          WHERE ingest_seq % 13 <> 0""")
def oi_history_items(spark, sf):
    value = F.when(F.col("ingest_seq") % 13 == 0, "oops").otherwise(
        F.col("sum_open_interest").cast("string"))
    pages = oi_raw(spark, sf).select(
        "symbol", "ingest_seq", _history_body("sumOpenInterest", value, F.col("snap_ms")).alias("body"))
    return landing.parse_oi_hist(pages).select("symbol", "label_ms", "value", "ingest_seq")


@query("""SELECT symbol, snap_ms, sum_open_interest, ingest_seq FROM oi_raw
          WHERE ingest_seq % 13 <> 0 AND ingest_seq % 19 <> 0""")
def oi_snapshots(spark, sf):
    seq = F.col("ingest_seq")
    time = F.when(seq % 19 == 0, F.lit(0)).otherwise(F.col("snap_ms"))
    answer = F.to_json(F.struct(
        F.when(seq % 13 != 0, F.col("sum_open_interest").cast("string")).alias("openInterest"),
        time.alias("time")))
    return landing.parse_oi_snapshot(oi_raw(spark, sf).select("symbol", "ingest_seq", answer.alias("body")))


@query(f"""SELECT symbol, measure, snap_ms AS label_ms, ratio FROM (
             SELECT symbol, snap_ms, '{MEASURES[0]}' AS measure, {MEASURES[0]} AS ratio FROM ratio_raw
             UNION ALL SELECT symbol, snap_ms, '{MEASURES[1]}', {MEASURES[1]} FROM ratio_raw
             UNION ALL SELECT symbol, snap_ms, '{MEASURES[2]}', {MEASURES[2]} FROM ratio_raw)
           WHERE ratio IS NOT NULL""")
def ratio_history_items(spark, sf):
    """Ratio cells as responses of three endpoints; NULL cells arrive as NaN text."""
    kinds = F.explode(F.array(*[
        F.struct(F.lit(endpoint).alias("endpoint"), F.coalesce(
            F.col(measure).cast("string"), F.lit("NaN")).alias("text"))
        for endpoint, measure in S.RATIO_KINDS.items()]))
    pages = ratio_raw(spark, sf).select("symbol", "snap_ms", kinds.alias("k")).select(
        "symbol", F.col("k.endpoint").alias("endpoint"),
        _history_body("longShortRatio", F.col("k.text"), F.col("snap_ms")).alias("body"))
    return landing.parse_ratio_hist(pages)


# archive files around the clock change: the data's month moved 45 days on
ARCHIVE_SHIFT = 45 * DAY
CTES["archive_rows"] = f"""
SELECT symbol, c AS create_ms, c - c % 86400000 AS file_day_ms, seq AS line_no, m0, m1, m2 FROM (
  SELECT symbol, seq,
         CASE WHEN seq % 3 = 0 THEN (t_ms + {ARCHIVE_SHIFT}) - (t_ms + {ARCHIVE_SHIFT}) % 300000
              ELSE (t_ms + {ARCHIVE_SHIFT}) - (t_ms + {ARCHIVE_SHIFT}) % 1000 END AS c,
         CASE WHEN uid % 3 = 0 AND seq % 17 <> 0 THEN price END AS m0,
         CASE WHEN uid % 3 = 1 AND seq % 17 <> 0 THEN price END AS m1,
         CASE WHEN uid % 3 = 2 AND seq % 17 <> 0 THEN price END AS m2 FROM ticks)"""


@query(f"""
WITH a AS (
  SELECT *, (create_ms + 150000) - (create_ms + 150000) % 300000 AS target FROM archive_rows),
b AS (
  SELECT *, create_ms = target AS gridded, abs(create_ms - target) AS dist,
         coalesce(m0, m1, m2) IS NULL AS is_empty,
         create_ms <> target AND target - target % 86400000 <> create_ms - create_ms % 86400000 AS crosses
  FROM a),
c AS (
  SELECT *, row_number() OVER (
           PARTITION BY symbol, file_day_ms, target, NOT is_empty AND NOT crosses
           ORDER BY CAST(gridded AS INTEGER) DESC, dist, CASE WHEN gridded THEN -line_no ELSE line_no END) AS rn
  FROM b)
SELECT symbol, line_no,
       target - CASE WHEN file_day_ms >= {snap.ARCHIVE_SWITCH_MS} THEN 0 ELSE 300000 END AS start_ms,
       target - CASE WHEN file_day_ms >= {snap.ARCHIVE_SWITCH_MS} THEN 0 ELSE 300000 END + 300000 AS snap_ms,
       CASE WHEN is_empty THEN 'empty' WHEN crosses THEN 'other_day'
            WHEN rn > 1 THEN 'superseded' ELSE 'none' END AS fault
FROM c""")
def archive_align(spark, sf):
    """Archive text rows, on and off the grid, on both sides of the clock change."""
    moved = F.col("t_ms") + ARCHIVE_SHIFT
    created = F.when(F.col("seq") % 3 == 0, tg.bucket(moved, BAR)).otherwise(tg.bucket(moved, 1000))
    cells = [F.coalesce(F.when((F.col("uid") % 3 == k) & (F.col("seq") % 17 != 0),
                               F.col("price").cast("string")), F.lit("")).alias(c)
             for k, c in enumerate(MEASURES)]
    rows = ticks(spark, sf).select(
        "symbol", tg.utc_text(created).alias("create_time"),
        tg.bucket(created, DAY).alias("file_day_ms"), F.col("seq").alias("line_no"), *cells)
    return landing.import_archive(rows).select(
        "symbol", "line_no", "start_ms", "snap_ms", F.coalesce("fault", F.lit("none")).alias("fault"))


@query("""SELECT upper(symbol) || CASE WHEN from_ms // 300000 % 7 = 0 THEN ';' ELSE '' END AS symbol,
                 CASE WHEN from_ms // 300000 % 11 = 0 THEN NULL
                      WHEN from_ms // 300000 % 5 = 0 THEN from_ms + 1 ELSE from_ms END AS from_ms,
                 to_ms,
                 CASE WHEN from_ms // 300000 % 7 = 0 THEN 'symbol'
                      WHEN from_ms // 300000 % 11 = 0 THEN 'not_an_integer'
                      WHEN from_ms // 300000 % 5 = 0 THEN 'range' ELSE 'none' END AS reject
          FROM gaps_5m""")
def gap_file_rows(spark, sf):
    """Gaps written to a gap file, some rows damaged on the way, and read back."""
    path = fresh(spark, "gaps")
    gapfile.write_gaps(gaps.gap_report_rows(gaps_5m(spark, sf), "5m"), path)
    slot = F.col("from_ms").cast("long") / BAR
    text = gapfile.load_gaps(spark, path)
    damaged = text.withColumns({
        "symbol": F.when(slot % 7 == 0, F.concat("symbol", F.lit(";"))).otherwise(F.col("symbol")),
        "from_ms": F.when(slot % 11 == 0, F.lit("soon")).when(
            slot % 5 == 0, (F.col("from_ms").cast("long") + 1).cast("string")).otherwise(F.col("from_ms"))})
    return gapfile.read_gaps(damaged, "5m").select(
        "symbol", "from_ms", "to_ms", F.coalesce("reject", F.lit("none")).alias("reject"))


@query("""SELECT symbol, start_ms, CAST(7 AS BIGINT) AS version, ingest_seq,
                 CAST(strftime(make_timestamp(start_ms * 1000), '%Y%m') AS INTEGER) AS month FROM bars_raw""")
def fact_append(spark, sf):
    """Two appended batches, stamped with a version, read back with their month."""
    rows, path = bars_raw(spark, sf), fresh(spark, "append")
    cut = SPAN_FROM + 15 * DAY
    facts.append_facts(rows.where(F.col("start_ms") < cut), path, version=7)
    facts.append_facts(rows.where(F.col("start_ms") >= cut), path, version=7)
    return facts.read_facts(spark, path, S.BARS_1M).select(*S.BAR_KEYS, "version", "ingest_seq", "month")


_BOUND_15M = (NOW - 10 * DAY) - (NOW - 10 * DAY) % STEPS["15m"]


@query(f"""SELECT symbol, start_ms, close, trades_count, {round_sql('volume')},
                  CAST(CASE WHEN start_ms >= {_BOUND_15M} THEN {NOW} ELSE 1 END AS BIGINT) AS version
           FROM bars_15m""")
def rollup_upsert(spark, sf):
    """A stored rollup with stale rows, refreshed in place over the last ten days."""
    base, path = bars(spark, sf), fresh(spark, "rollup")
    stale = rollup_klines(base, "15m").withColumn("version", F.lit(1).cast("long"))
    wrong = F.when(F.col("start_ms") >= _BOUND_15M, F.col("trades_count") + 5).otherwise(F.col("trades_count"))
    facts.append_facts(stale.withColumn("trades_count", wrong), path)
    for _ in range(2):  # a repeated run changes nothing
        refresh.apply_refresh(base, rollup_klines, path, NOW, "15m", 10)
    rows = facts.read_facts(spark, path, S.BARS)
    return rounded(rows.select(*S.BAR_KEYS, "close", "trades_count", "volume", "version"), "volume")


@query(f"""SELECT symbol, start_ms, start_ms AS head_ms, open AS o, close AS c, {round_sql('volume')},
                  trades_count AS n, CAST(10 AS INTEGER) AS fields FROM bars""")
def compact_bars(spark, sf):
    """Bars as keyless array text, read back position by position."""
    rows = windows.compact_bars(bars(spark, sf)).withColumn("p", F.from_json("payload", "array<string>"))
    cell = F.col("p")
    return rounded(rows.select(
        *S.BAR_KEYS, fx.leading_integer(F.col("payload")).alias("head_ms"),
        cell[1].cast("double").alias("o"), cell[4].cast("double").alias("c"),
        cell[5].cast("double").alias("volume"), cell[9].cast("long").alias("n"),
        F.size("p").alias("fields")), "volume")


@query("""SELECT symbol, open_ms AS t, price AS h, price AS tbqv, trade_count AS n,
                 CASE WHEN is_final THEN 1 ELSE 0 END AS x, CAST(11 AS INTEGER) AS fields FROM kline_events""")
def live_bar_record(spark, sf):
    """Live bars as named records and arrays, read back."""
    good = filters.parse_quantities(kline_events(spark, sf)).where("bad_field IS NULL")
    schema = "t long, o double, h double, l double, c double, v double, qv double, tbv double, tbqv double, n long, x int"
    rows = windows.live_bar_record(good).select(
        "symbol", F.from_json("record", schema).alias("r"),
        F.size(F.from_json("payload", "array<string>")).alias("fields"))
    return rows.select("symbol", *[F.col(f"r.{c}").alias(c) for c in ("t", "h", "tbqv", "n", "x")], "fields")


_TAIL_SQL = """SELECT interval, timestamp, symbols_count, published_ms FROM sections_1h
               ORDER BY published_ms DESC, interval DESC, timestamp DESC LIMIT {n}"""


@query(_TAIL_SQL.format(n=300))
def ready_log(spark, sf):
    """Ready events appended to the log, which is then trimmed to the newest 300."""
    path = fresh(spark, "ready")
    facts.append_ready_events(sections_1h(spark, sf), path)
    facts.trim_ready_events(spark, path, keep=300)
    return spark.read.schema(S.READY_EVENT).parquet(path)


@query(_TAIL_SQL.format(n=50))
def recent_events(spark, sf):
    return sections.recent_events(sections_1h(spark, sf), 50).select(
        "interval", "timestamp", "symbols_count", "published_ms")


@query("""SELECT DISTINCT event_type || '_' || user_id AS symbol FROM events
          WHERE user_id % 3 = 0 AND user_id % 2 = 0 AND user_id % 5 < 2""")
def exchange_universe(spark, sf):
    """Exchange metadata, one document per listed contract, to the trading universe."""
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_type", "user_id").distinct()
    uid = F.col("user_id")
    listed = F.struct(
        F.concat_ws("_", "event_type", uid.cast("string")).alias("symbol"),
        F.when(uid % 3 == 0, "PERPETUAL").otherwise("CURRENT_QUARTER").alias("contractType"),
        F.when(uid % 2 == 0, "TRADING").otherwise("SETTLING").alias("status"),
        F.when(uid % 5 == 0, "USDT").when(uid % 5 == 1, "USDC").otherwise("BTC").alias("quoteAsset"))
    documents = ev.select(F.to_json(F.struct(F.array(listed).alias("symbols"))).alias("body"))
    return landing.build_universe(documents, ["USDT", "USDC"])


# --- projections and predicates -------------------------------------------------

@query("""SELECT seq, CASE WHEN seq % 19 = 0 THEN NULL ELSE price END AS high,
                 CASE WHEN seq % 23 = 0 THEN 0 ELSE trade_count END AS trade_count,
                 CASE WHEN seq % 19 = 0 THEN 'high' WHEN seq % 29 < 4 THEN 'low' ELSE 'none' END AS bad_field FROM kline_events""")
def quantities(spark, sf):
    # text that is a number to a cast, but not to a strict parser
    almost = F.element_at(F.array(*map(F.lit, ("1.5d", "2f", " 1.5 ", "0x1"))), (F.col("seq") % 29 + 1).cast("int"))
    damaged = kline_events(spark, sf).withColumns({
        "high": F.when(F.col("seq") % 19 == 0, F.concat(F.lit("x"), "high")).otherwise(F.col("high")),
        "low": F.when(F.col("seq") % 29 < 4, almost).otherwise(F.col("low")),
        "trade_count": F.when(F.col("seq") % 23 == 0, F.lit(-4)).otherwise(F.col("trade_count"))})
    return filters.parse_quantities(damaged).select(
        "seq", "high", "trade_count", F.coalesce("bad_field", F.lit("none")).alias("bad_field"))


@query(f"SELECT symbol, start_ms, close FROM bars WHERE start_ms >= {SCAN_FROM} AND start_ms < {SCAN_TO}")
def in_range(spark, sf):
    return filters.in_range(bars(spark, sf), SCAN_FROM, SCAN_TO).select(*S.BAR_KEYS, "close")


_MID = SPAN_FROM + 14 * DAY + 30_500


@query(f"""SELECT symbol, start_ms, end_ms <= {_MID} - 1000 AS settled FROM bars
           WHERE start_ms < {_MID} - {_MID} % 60000""")
def closed_only(spark, sf):
    rows = filters.opened_before_current(bars(spark, sf), _MID)
    settled = filters.closed_only(rows, _MID).select(*S.BAR_KEYS, F.lit(True).alias("settled"))
    late = rows.join(settled, S.BAR_KEYS, "left_anti").select(*S.BAR_KEYS, F.lit(False).alias("settled"))
    return settled.unionByName(late)


@query("SELECT symbol, start_ms, close FROM bars WHERE start_ms % 300000 = 0")
def on_grid(spark, sf):
    return filters.on_grid(bars(spark, sf), BAR).select(*S.BAR_KEYS, "close")


@query("""SELECT ingest_seq, CASE WHEN ingest_seq % 31 = 0 THEN 'symbol' WHEN ingest_seq % 29 = 0 THEN 'grid'
                 WHEN ingest_seq % 37 = 0 OR ingest_seq % 41 = 0 OR ingest_seq % 47 = 0 THEN 'value'
                 WHEN ingest_seq % 43 = 0 THEN 'rank' ELSE 'none' END AS fault FROM oi_raw""")
def valid_oi(spark, sf):
    seq, value = F.col("ingest_seq"), F.col("sum_open_interest")
    damaged = oi_raw(spark, sf).withColumns({
        "symbol": F.when(seq % 31 == 0, "").otherwise(F.col("symbol")),
        "start_ms": F.when(seq % 29 == 0, F.col("start_ms") + 1).otherwise(F.col("start_ms")),
        "sum_open_interest": F.when(seq % 37 == 0, -value - 1).when(seq % 41 == 0, float("nan"))
        .when(seq % 47 == 0, float("inf")).otherwise(value),
        "src_rank": F.when(seq % 43 == 0, 4).otherwise(F.col("src_rank"))})
    return filters.oi_row_fault(damaged).select(
        "ingest_seq", F.coalesce("fault", F.lit("none")).alias("fault"))


@query(f"""SELECT symbol, start_ms, CASE WHEN ingest_seq % 29 = 0 THEN 'rank'
                 WHEN ingest_seq % 31 = 0 THEN 'value'
                 WHEN coalesce({', '.join(MEASURES)}) IS NULL THEN 'empty' ELSE 'none' END AS fault
           FROM ratio_raw""")
def valid_ratio(spark, sf):
    seq = F.col("ingest_seq")
    damaged = ratio_raw(spark, sf).withColumns({
        MEASURES[0]: F.when(seq % 31 == 0, -1.0).otherwise(F.coalesce(MEASURES[0], F.lit(float("nan")))),
        "src_rank": F.when(seq % 29 == 0, 1).otherwise(F.col("src_rank"))})
    return filters.ratio_row_fault(damaged).select(
        *S.BAR_KEYS, F.coalesce("fault", F.lit("none")).alias("fault"))


_LABEL_NOW = NOW - 10 * DAY


@query(f"""SELECT seq, label_ms, label_ms - 300000 AS start_ms
           FROM (SELECT seq, t_ms - t_ms % 60000 AS label_ms FROM ticks)
           WHERE label_ms % 300000 = 0 AND label_ms <= {_LABEL_NOW}""")
def label_to_bar(spark, sf):
    labels = ticks(spark, sf).select("seq", tg.bucket(F.col("t_ms"), MINUTE).alias("label_ms"))
    return filters.label_to_bar(labels, _LABEL_NOW).select("seq", "label_ms", "start_ms")


@query("""SELECT seq,
                 CASE WHEN f + 300000 - t_ms < 5000 THEN f + 300000 ELSE f END AS start_ms,
                 CASE WHEN t_ms - f <= 240000 THEN f - 300000
                      WHEN f + 300000 - t_ms < 5000 THEN f + 300000 ELSE f END AS catch_up_start_ms
          FROM (SELECT seq, t_ms, t_ms - t_ms % 300000 AS f FROM ticks)""")
def snapshot_to_bar(spark, sf):
    asked = ticks(spark, sf).select("seq", F.col("t_ms").alias("requested_ms"))
    first = filters.snapshot_to_bar(asked)
    again = filters.snapshot_to_bar(
        first.withColumnRenamed("start_ms", "normal_ms"), catch_up_ms=4 * MINUTE)
    return again.select("seq", F.col("normal_ms").alias("start_ms"),
                        F.col("start_ms").alias("catch_up_start_ms"))


@query(f"""SELECT b.symbol, b.start_ms, round(o.sum_open_interest * b.close, 6) AS oi_value,
                  round(b.taker_buy_volume / nullif(b.volume - b.taker_buy_volume, 0), 6) AS taker_ratio,
                  {', '.join(f'round(r.{c} / (1 + r.{c}), 9) AS {c}_long_share' for c in MEASURES)}
           FROM bars_5m b LEFT JOIN oi o USING (symbol, start_ms) LEFT JOIN ratios r USING (symbol, start_ms)""")
def derived_measures(spark, sf):
    from workload.base import oi, ratios

    full = panel.market_panel(bars_at(spark, sf, "5m"), oi(spark, sf), ratios(spark, sf))
    # a bar whose volume is all taker buys has no ratio: sums may differ in the last bits
    sold = F.col("volume") - F.col("taker_buy_volume")
    exact = full.withColumn("taker_buy_volume", F.when(
        F.abs(sold) < 1e-9, F.col("volume")).otherwise(F.col("taker_buy_volume")))
    rows = panel.derived_measures(exact)
    shares = [f"{c}_long_share" for c in MEASURES]
    return rounded(rounded(rows, "oi_value", "taker_ratio"), *shares, digits=9).select(
        *S.BAR_KEYS, "oi_value", "taker_ratio", *shares)


@query("""SELECT symbol, start_ms, close FROM bars
          WHERE symbol <> (SELECT min(symbol) FROM universe)""")
def universe_members(spark, sf):
    everyone = universe(spark, sf)
    first = everyone.agg(F.min("symbol").alias("m")).scalar()
    return filters.members_only(bars(spark, sf), everyone.where(F.col("symbol") != first)).select(
        *S.BAR_KEYS, "close")


@query("""SELECT symbol, interval, lower(symbol) || '@kline_' || interval AS stream,
                 upper(symbol) AS parsed_symbol, interval AS parsed_interval, count(*) AS events
          FROM kline_events GROUP BY 1, 2, 3, 4, 5""")
def stream_names(spark, sf):
    counts = kline_events(spark, sf).groupBy("symbol", "interval").agg(F.count("*").alias("events"))
    named = counts.withColumn("stream", fx.stream_name(F.upper("symbol"), F.col("interval")))
    parsed = fx.parse_stream_name(F.col("stream"))
    return named.select("symbol", "interval", "stream", parsed["symbol"].alias("parsed_symbol"),
                        parsed["interval"].alias("parsed_interval"), "events")


@query(f"""SELECT CAST({crc_sql("upper(s)")} % 16 AS BIGINT) AS bucket, CAST(sum(n) AS BIGINT) AS rows
           FROM (SELECT symbol || '_' || uid AS s, count(*) AS n FROM ticks GROUP BY 1) GROUP BY 1""")
def stable_bucket(spark, sf):
    """Rows per stable bucket."""
    bucket = fx.stable_bucket(F.concat_ws("_", "symbol", F.col("uid").cast("string")), 16)
    return ticks(spark, sf).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"))


@query("""SELECT symbol, start_ms, CAST(strftime(ts, '%Y%m') AS INTEGER) AS month,
                 epoch_ms(date_trunc('month', ts)) AS month_from_ms,
                 epoch_ms(date_trunc('month', ts) + INTERVAL 1 MONTH) AS month_to_ms,
                 start_ms - start_ms % 86400000 AS day_ms
          FROM (SELECT symbol, start_ms, make_timestamp(start_ms * 1000) AS ts FROM bars)""")
def with_month(spark, sf):
    return filters.with_month(bars(spark, sf)).select(
        *S.BAR_KEYS, "month", "month_from_ms", "month_to_ms", "day_ms")
