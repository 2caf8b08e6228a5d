from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.operators import sections, versions, windows
from candlemill.session import scratch_path
from candlemill.sources import facts, landing
from candlemill.streaming import jobs
from helpers import HOUR, MIN, bar, bars, rows

CLOSED = "symbol string, interval string, open_ms long, arrival_ms long, seq long"
PRICED = CLOSED + ", " + ", ".join(f"{c} double" for c in S.PRICES + S.VOLUMES) + ", trade_count long"


def closed(*items):
    return [(s, "1m", t, a, i) for i, (s, t, a) in enumerate(items)]


def priced(*items):
    return [(s, "1m", t, a, i, *[float(t)] * 8, 1) for i, (s, t, a) in enumerate(items)]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def play(spark, frame):
    """Feed batches one after another through a stream, resuming its checkpoint each time."""

    def run(batches, schema, build, mode="append"):
        source, sink, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
        for batch in batches:
            frame(batch, schema).write.mode("append").parquet(source)
            stream = landing.event_stream(spark, source, frame([], schema).schema)
            jobs.run_to_table(build(stream), sink, checkpoint, mode)
        return spark.read.option("basePath", sink).parquet(sink)

    return run


def test_guard_holds_across_batches(play):
    got = play([closed(("A", 1000, 1), ("A", 1000, 2)), closed(("A", 999, 3), ("A", 2000, 4))],
               CLOSED, jobs.guard_stream)
    assert rows(got, "open_ms") == [(1000,), (2000,)]


def section_rows(play, universe, *batches, timeout=5_000):
    # a late bar of another section moves the watermark past every deadline
    last = closed(("A", 999 * HOUR, 999 * HOUR))
    got = play([*batches, last], CLOSED, lambda s: jobs.section_stream(s, universe, timeout, HOUR))
    return rows(got.where(F.col("timestamp") < 999 * HOUR), "timestamp", "symbols_count", "reason", "published_ms")


def test_sections(play, frame):
    abc = frame([(s,) for s in "ABC"], "symbol string")
    ab = frame([(s,) for s in "AB"], "symbol string")
    # the first section completes, the second one times out and swallows its straggler
    both = section_rows(play, abc, closed(("A", 1000, 10), ("B", 1000, 20)),
                        closed(("C", 1000, 30), ("A", 1000, 40), ("A", 2000, 50), ("B", 2000, 9_000)))
    assert both == [(1000, 3, "complete", 30), (2000, 1, "timeout", 5_050)]
    unknown = section_rows(play, None, closed(("A", 1000, 10), ("B", 1000, 20)))
    assert unknown == [(1000, 2, "timeout", 5_010)]
    outsider = section_rows(play, ab, closed(("A", 1000, 10), ("Z", 1000, 15), ("B", 1000, 20)))
    assert outsider == [(1000, 2, "complete", 20)]


@pytest.mark.parametrize("retention", [HOUR, 1_000])
def test_stragglers_in_later_batches_publish_once(play, frame, retention):
    four = frame([(s,) for s in "ABCD"], "symbol string")
    batches = [closed(("A", 2000, 50)), closed(("B", 2000, 9_000)), closed(("C", 2000, 9_200)), closed(("A", 999 * HOUR, 9_900)),
               closed(("A", 999 * HOUR, 999 * HOUR))]
    got = play(batches, CLOSED, lambda s: jobs.section_stream(s, four, 5_000, retention))
    found = rows(got.where("timestamp = 2000"), "symbols_count", "reason", "published_ms")
    # a retention that is over before the last straggler comes has forgotten the section
    again = [] if retention == HOUR else [(1, "timeout", 14_200)]
    assert sorted(found, key=lambda r: r[2]) == [(1, "timeout", 5_050), *again]


def test_section_twin_agrees(frame):
    rows_ = frame(closed(("A", 1000, 10), ("B", 1000, 20), ("C", 1000, 30), ("A", 2000, 10), ("B", 2000, 9_000)), CLOSED)
    abc = frame([(s,) for s in "ABC"], "symbol string")
    assert rows(sections.sections(rows_, abc, 5_000)) == [
        ("1m", 1000, 3, "complete", 30), ("1m", 2000, 1, "timeout", 5_010)]
    assert rows(sections.sections(rows_, None, 5_000), "symbols_count", "reason") == [(1, "timeout"), (3, "timeout")]


def test_derived_and_held_sections(frame):
    schema = "interval string, timestamp long, symbols_count long, reason string, published_ms long"
    base = frame([("1m", 240_000, 3, "complete", 300_100), ("1m", 300_000, 3, "complete", 360_100)], schema)
    got = rows(sections.derive_sections(base, "1m", ["5m", "1h"]), "interval", "timestamp", "reason")
    assert got == [("1m", 240_000, "complete"), ("1m", 300_000, "complete"), ("5m", 0, "derived")]
    holds = frame([("1m", 300_000, 300_200)], "interval string, held_from_ms long, held_to_ms long")
    kept = sections.derive_sections(sections.suppress_held(base, holds), "1m", ["5m", "1h"])
    assert rows(kept, "interval", "timestamp") == [("1m", 300_000)]
    again = sections.suppress_held(base, holds, requeue=True)
    assert rows(again, "timestamp", "published_ms") == [(240_000, 300_200), (300_000, 360_100)]


def test_section_latency(frame):
    event = frame([("1m", 1719835200000, 245, 1719835262000)],
                  "interval string, timestamp long, symbols_count long, published_ms long")
    row = sections.section_latency(event, 250, {"1m": MIN}).first()
    assert (row.latency_ms, row.coverage_pct, row.trigger) == (2_000, 98.0, "Partial")


def head(df, size=None):
    newest = df.agg(F.max("batch")).first()[0]
    return [r.t for r in df.where(F.col("batch") == newest).orderBy("pos").collect()]


def test_window_push_is_monotonic(play):
    got = play([priced(("A", 100, 1), ("A", 100, 2), ("A", 99, 3), ("A", 101, 4))], PRICED,
               lambda s: jobs.window_stream(s, 200), "update")
    assert head(got) == [101, 100]


def test_window_trims_and_joins_the_store(spark, play):
    # a window rebuilt from the store, then live bars: replays and old bars are skipped
    stored = windows.rolling_window(bars(spark, [bar("A", t) for t in (60, 120, 180, 240, 300)]), 4)
    got = play([priced(("A", 300, 1), ("A", 120, 2), ("A", 360, 3))], PRICED,
               lambda s: jobs.window_stream(s, 4, stored), "update")
    assert head(got) == [360, 300, 240, 180]
    trimmed = play([priced(*[("A", t, t) for t in range(1, 9)])], PRICED, lambda s: jobs.window_stream(s, 5), "update")
    assert head(trimmed) == [8, 7, 6, 5, 4]


def test_rolling_window_keeps_the_newest(spark):
    got = windows.rolling_window(bars(spark, [bar("A", t) for t in range(993, 1001)]), 5).first()
    assert [b.t for b in got.bars] == [1000, 999, 998, 997, 996]


def test_live_bars_see_every_event(play):
    schema = "symbol string, interval string, open_ms long, close double, trade_count long, is_final boolean, " \
             "arrival_ms long, seq long"
    made = [[("A", "1m", 1000, 1.0, 1, True, 1, 1), ("A", "1m", 999, 2.0, 1, False, 2, 2)],
            [("A", "1m", 900, 3.0, 1, False, 1, 0)]]
    got = play(made, schema, jobs.live_bars_stream, "update")
    # the older arrival of the second batch changes nothing
    assert rows(got, "close") == [(2.0,)]
    twin = sections.live_bars(got, 10 * MIN, MIN)
    assert twin.count() == 0 and sections.live_bars(got, 100, MIN).count() == 1


def test_fan_out_feeds_every_sink(spark, frame, folder):
    def event(seq, t, final, high="2"):
        return ("A", "1m", t, t + 59_999, "1", high, "1", "1", "1", "1", "1", "1", 1, final, seq, seq)

    schema = frame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.EVENT.fields) + ", seq long").schema
    live, archive, reject, source, checkpoint = (scratch_path(spark, n) for n in "larsc")
    seen = []
    body = jobs.fan_out(live, archive, reject, after=lambda df, i: seen.append(df.count()))
    for batch in ([event(1, 1000, True), event(2, 999, True), event(3, 2000, False), event(4, 3000, True, "bad")],
                  [event(5, 1000, True), event(6, 2000, True)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        stream = landing.event_stream(spark, source, schema)
        stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(archive), "start_ms") == [(1000,), (2000,)]
    assert spark.read.parquet(live).count() == 5 and rows(spark.read.parquet(reject), "bad_field") == [("high",)]
    assert seen == [1, 1]
    # a stream with a checkpoint of its own adds to the archive and replaces nothing
    stream = landing.event_stream(spark, source, schema)
    stream.writeStream.foreachBatch(jobs.fan_out(live, archive, reject)).option("checkpointLocation", folder("other")).trigger(
        availableNow=True).start().awaitTermination()
    stored = facts.scan_bars(spark, archive)
    assert stored.count() == 4 and rows(versions.latest_bars(stored), "start_ms", "version") == [(1000, 1), (2000, 6)]
    assert stored.where("month = 197001").count() == 4
    assert spark.read.parquet(live).select("query").where("query <> 'None'").distinct().count() == 2


def test_silence_monitor(play):
    made = [[("A", "1m", 0, t, i) for i, t in enumerate((0, 10_000, 200_000, 500_000_000))]]
    got = play(made + [closed(("A", 0, 900_000_000))], CLOSED, jobs.silence_monitor)
    assert (0, 10_000, 2) in rows(got, "first_ms", "last_ms", "events")


def test_ready_log(spark, frame, folder):
    path = folder("ready")
    facts.append_ready_events(frame([("1m", i * MIN, 3, i * MIN + 5) for i in range(9)], S.READY_EVENT), path)
    facts.trim_ready_events(spark, path, keep=4)
    got = spark.read.schema(S.READY_EVENT).parquet(path)
    assert got.count() == 4
    assert [r.timestamp for r in sections.recent_events(got, 2).collect()] == [7 * MIN, 8 * MIN]
