from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx
from candlemill.operators import filters, snap, windows
from candlemill.sources import facts, landing
from helpers import BAR, DAY, HOUR, MIN, OI, bar, bars, ms, rows


def test_rest_bar(frame):
    body = json.dumps([
        [1789755240000, "1.5", "2", "1", "1.8", "10", 1789755299999, "18.5", 42, "4", "7.2", "0"],
        [1789755300000, "1.5", "2"],
        [1789755360000, "bad", "2", "1", "1.8", "10", 1789755419999, "18.5", -3, "4", "7.2", "0"]])
    got = landing.parse_rest_klines(frame([("A", body)], "symbol string, body string"))
    good, bad = filters.split_faults(got, "bad_field")
    start = ms("2026-09-18 18:14:00")
    assert rows(good, "start_ms", "end_ms", "open", "quote_volume", "trades_count", "taker_buy_volume",
                "taker_buy_quote_volume") == [(start, start + 59_999, 1.5, 18.5, 42, 4.0, 7.2)]
    assert rows(bad, "bad_field", "trades_count") == [("open", 0)]


def frame_body(wrap: bool, **over) -> str:
    k = {"t": 1, "T": 2, "s": "BTC", "i": "1m", "o": "1", "h": "2", "l": "0.5", "c": "1.5", "v": "10", "q": "15",
         "V": "4", "Q": "6", "n": 7, "x": True}
    k.update(over)
    inner = {"e": "kline", "k": k}
    return json.dumps({"stream": "x", "data": inner} if wrap else inner)


def test_stream_frames(frame):
    got = landing.decode_kline_frames(frame([
        (frame_body(True),), (frame_body(False, x=False),), (frame_body(True, s=""),),
        ('{"result":null}',), ("not json",)], "body string"))
    assert rows(got, "symbol", "open_ms", "close_ms", "volume", "taker_buy_volume", "quote_volume",
                "taker_buy_quote_volume", "trade_count", "is_final") == sorted(
        [("BTC", 1, 2, "10", "4", "15", "6", 7, True), ("BTC", 1, 2, "10", "4", "15", "6", 7, False)], key=repr)


def test_history_and_snapshot(frame):
    body = '[{"sumOpenInterest":"2.5","timestamp":10},{"sumOpenInterest":"x","timestamp":11},{"sumOpenInterest":"1","timestamp":0}]'
    got = landing.parse_oi_hist(frame([("A", body)], "symbol string, body string"))
    assert rows(got, "label_ms", "value") == [(10, 2.5)]
    snaps = landing.parse_oi_snapshot(frame([
        ("A", '{"openInterest":"3.5","time":9}'), ("B", '{"openInterest":"","time":9}'), ("C", '{"time":0}')],
        "symbol string, body string"))
    assert rows(snaps, "symbol", "sum_open_interest", "snap_ms") == [("A", 3.5, 9)]


def test_ratio_history(frame):
    items = [{"longShortRatio": v, "timestamp": 5} for v in ("1.5", "NaN", "-1", "Infinity", "x")]
    got = landing.parse_ratio_hist(frame(
        [("A", "globalLongShortAccountRatio", json.dumps(items)), ("A", "other", json.dumps(items))],
        "symbol string, endpoint string, body string"))
    assert rows(got) == [("A", "count_long_short_ratio", 5, 1.5)]


def test_universe(frame):
    def listed(s, c="PERPETUAL", st="TRADING", q="USDT"):
        return {"symbol": s, "contractType": c, "status": st, "quoteAsset": q}
    body = json.dumps({"symbols": [listed("Z"), listed("A"), listed("B", c="CURRENT_QUARTER"),
                                   listed("C", st="SETTLING"), listed("D", q="BUSD"), listed("E", q="USDC")]})
    got = landing.build_universe(frame([(body,)], "body string"), ["USDT", "USDC"])
    assert [r.symbol for r in got.collect()] == ["A", "E", "Z"]


def archive(frame, made):
    data = [(t, "A", "", "", v, "", "", "", tg.floor_to(ms(day), DAY), i)
            for i, (day, t, v) in enumerate(made)]
    columns = ", ".join(f"{f.name} string" for f in S.ARCHIVE_CSV.fields)
    return landing.import_archive(frame(data, columns + ", file_day_ms long, line_no long"))


def test_archive_clock_change(frame, zone):
    got = archive(frame, [("2024-03-03", "2024-03-03 23:55:00", "1.5"), ("2024-03-04", "2024-03-04 00:00:00", "2.5")])
    assert rows(got.where("fault IS NULL"), "start_ms", "snap_ms") == sorted([
        (ms("2024-03-03 23:50"), ms("2024-03-03 23:55")), (ms("2024-03-04 00:00"), ms("2024-03-04 00:05"))], key=repr)


def test_archive_snapping(frame):
    day = "2024-04-01"
    got = archive(frame, [
        (day, "2024-04-01 00:00:00", "1"), (day, "2024-04-01 00:00:07", "2"),   # slot taken
        (day, "2024-04-01 00:09:59", "3"), (day, "2024-04-01 00:10:03", "4"),   # the closer one moves
        (day, "2024-04-01 00:12:30", "5"),                                      # half way goes up
        (day, "2024-04-01 23:58:00", "6"),                                      # belongs to the next file
        (day, "2024-04-01 00:20:00", ""), (day, "nonsense", "7")])
    kept = rows(got.where("fault IS NULL"), "start_ms", S.RATIOS[0])
    at = ms(day)
    assert kept == sorted([(at, 1.0), (at + 10 * MIN, 3.0), (at + 15 * MIN, 5.0)], key=repr)
    assert sorted(r.fault for r in got.where("fault IS NOT NULL").collect()) == [
        "empty", "other_day", "superseded", "superseded", "time"]


def test_archive_files(spark, folder):
    path = folder("archive")
    header = ",".join(f.name for f in S.ARCHIVE_CSV.fields)
    lines = [header, "2024-04-01 00:05:00,A,1,2,1.25,,0.5,9"]
    spark.createDataFrame([("\n".join(lines),)], "v string").coalesce(1).write.text(f"{path}/raw")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = [f for f in spark.read.format("binaryFile").load(f"{path}/raw").select("path").collect()][0][0]
    Path = jvm.org.apache.hadoop.fs.Path
    target = Path(f"{path}/A-metrics-2024-04-01.csv")
    target.getFileSystem(conf).rename(Path(source), target)
    got = landing.import_archive(landing.read_archive(spark, f"{path}/*.csv"))
    assert rows(got, "symbol", "start_ms", S.RATIOS[0], S.RATIOS[1], "fault") == [
        ("A", ms("2024-04-01 00:05"), 1.25, None, None)]


def test_snap_plan(frame):
    sec = 1000
    off = frame([("A", t * sec, float(t), 0, 3, t) for t in (7, 599, 603, 750)], OI)
    table = frame([("A", 0, 1.0, 0, 3, 1)], OI)
    got = {r.old_start // sec: (r.new_start // sec, r.action) for r in snap.snap_plan(off, table).collect()}
    assert got == {7: (0, "drop_slot_taken"), 599: (600, "move"), 603: (600, "drop_collision"), 750: (900, "move")}


@pytest.mark.parametrize("label,start", [("2026-09-21 14:10", "2026-09-21 14:05"), ("2026-09-21 00:00", "2026-09-20 23:55"),
                                         ("2026-09-21 00:05", "2026-09-21 00:00"), ("2026-09-21 23:55", "2026-09-21 23:50"),
                                         ("2026-09-21 14:11", None), ("2026-09-21 14:10:30", None)])
def test_label_alignment(frame, label, start):
    got = filters.label_to_bar(frame([(ms(label),)], "label_ms long"), ms("2027-01-01"))
    assert rows(got, "start_ms") == ([(ms(start),)] if start else [])


def test_future_labels_drop(frame):
    day = "2026-09-21 "
    labels = frame([(ms(day + t),) for t in ("11:50", "11:52", "12:05", "12:10")], "label_ms long")
    got = filters.label_to_bar(labels, ms(day + "12:07:30"))
    assert rows(got, "start_ms") == sorted([(ms(day + "11:45"),), (ms(day + "12:00"),)], key=repr)


def test_snapshot_rounds(frame):
    day = "2026-09-21 "
    asked = frame([(i, ms(day + t)) for i, t in enumerate(("12:04:40", "12:04:57", "12:01:00"))], "i int, requested_ms long")
    plain = {r.i: r.start_ms for r in filters.snapshot_to_bar(asked).collect()}
    assert plain == {0: ms(day + "12:00"), 1: ms(day + "12:05"), 2: ms(day + "12:00")}
    late = {r.i: r.start_ms for r in filters.snapshot_to_bar(asked, catch_up_ms=4 * MIN).collect()}
    assert late[2] == ms(day + "11:55") and late[0] == ms(day + "12:00")


def test_row_faults(frame):
    inf, nan = float("inf"), float("nan")
    made = [("A", 0, 1.0, 0, 1, 0), ("", 0, 1.0, 0, 1, 0), ("A", 1, 1.0, 0, 1, 0), ("A", 0, nan, 0, 1, 0),
            ("A", 0, inf, 0, 1, 0), ("A", 0, -1.0, 0, 1, 0), ("A", 0, 1.0, 0, 4, 0), ("A", 0, 0.0, 0, 3, 0)]
    got = [r.fault for r in filters.oi_row_fault(frame(made, OI)).collect()]
    assert got == [None, "symbol", "grid", "value", "value", "value", "rank", None]
    ratio = "symbol string, start_ms long, " + ", ".join(f"{c} double" for c in S.RATIOS) + ", src_rank int"
    faults = filters.ratio_row_fault(frame([
        ("A", 0, 1.0, nan, None, 2), ("A", 0, nan, nan, None, 2), ("A", 0, inf, 1.0, 1.0, 3), ("A", 0, 1.0, 1.0, 1.0, 1)], ratio))
    assert [(r.fault, r[S.RATIOS[1]]) for r in faults.collect()] == [
        (None, None), ("empty", None), ("value", 1.0), ("rank", 1.0)]


def test_quantities(frame):
    row = ("A", "1m", 0, 1, *["1"] * 8, -5, True, 0)
    broken = ("A", "1m", 0, 1, "1", "1", "1", "1", "one", "1", "1", "1", 5, True, 0)
    good, bad = filters.split_faults(filters.parse_quantities(frame([row, broken], S.EVENT)), "bad_field")
    assert rows(good, "close", "trade_count") == [(1.0, 0)] and rows(bad, "bad_field") == [("volume",)]


def test_closed_bars(spark):
    base = bars(spark, [bar("A", 0), bar("A", MIN), bar("A", 2 * MIN)])
    assert rows(filters.closed_only(base, 2 * MIN), "start_ms") == [(0,)]
    assert rows(filters.closed_only(base, 2 * MIN + 1_000), "start_ms") == [(0,), (MIN,)]
    assert rows(filters.opened_before_current(base, 2 * MIN + 5), "start_ms") == [(0,), (MIN,)]


def test_names_and_buckets(spark, frame):
    names = frame([("btcusdt@kline_1m",), ("nope",)], "n string")
    got = names.select(fx.parse_stream_name(F.col("n")).alias("p")).collect()
    assert tuple(got[0].p) == ("BTCUSDT", "1m") and got[1].p is None
    import zlib
    syms = frame([("btcusdt",), ("ETHUSDT",)], "s string")
    assert [r.b for r in syms.select(fx.stable_bucket(F.col("s"), 7).alias("b")).collect()] == [
        zlib.crc32(b"BTCUSDT") % 7, zlib.crc32(b"ETHUSDT") % 7]


def test_rel_close(frame):
    made = frame([(100.0, 100.0 * (1 + 5e-9)), (100.0, 100.5), (0.0, 0.0)], "a double, b double")
    for tol, want in ((1e-6, [True, False, True]), (1e-12, [False, False, True])):
        assert [r.c for r in made.select(fx.rel_close(F.col("a"), F.col("b"), tol).alias("c")).collect()] == want


def test_time_columns_ignore_the_session_zone(spark, zone):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-01 00:00:00.123' AS ts").select(
        tg.epoch_ms(F.col("ts")).alias("ms")).withColumns({
            "month": tg.month_of(F.col("ms")), "text": tg.utc_text(F.col("ms")),
            "lo": tg.month_start_ms(F.col("ms")), "hi": tg.next_month_start_ms(F.col("ms"))}).first()
    assert tuple(row) == (ms("2024-03-01") + 123, 202403, "2024-03-01 00:00:00", ms("2024-03-01"), ms("2024-04-01"))


def test_served_text(spark, frame):
    text = windows.compact_bars(bars(spark, [bar("A", 5, 1.5)])).first().payload
    assert json.loads(text) == [5, 1.5, 1.5, 1.5, 1.5, 1.0, 1.5, 0.5, 0.75, 3] and text.startswith("[5,")
    event = frame([("A", "1m", 5, 6, *[1.0] * 8, 3, True)], "symbol string, interval string, open_ms long, close_ms long, "
                  + ", ".join(f"{c} double" for c in S.EVENT_TEXT) + ", trade_count long, is_final boolean")
    got = windows.live_bar_record(event).first()
    assert list(json.loads(got.record)) == windows.LIVE_FIELDS and json.loads(got.payload)[-1] == 1
    assert spark.createDataFrame([(text,)], "p string").select(fx.leading_integer(F.col("p"))).first()[0] == 5


def test_layout_and_scan(spark, folder):
    path = folder("scan")
    made = [bar(s, ms(d)) for s in ("A", "B") for d in ("2024-01-31 23:59", "2024-02-01", "2024-02-29", "2024-03-01")]
    facts.append_facts(bars(spark, made), path)
    got = facts.scan_bars(spark, path, symbols=["A"], from_ms=ms("2024-02-01"), to_ms=ms("2024-03-01"))
    assert rows(got, "symbol", "start_ms") == sorted([("A", ms("2024-02-01")), ("A", ms("2024-02-29"))], key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [", 1)[1].split("]")[0] and "PushedFilters: [IsNotNull(start_ms)" in plan.replace("IsNotNull(symbol), ", "")
    facts.require_layout(got, S.BARS_1M)
    with pytest.raises(facts.LayoutError):
        facts.require_layout(got, S.OI_5M)
