"""Counted holds, windows rebuilt during the feed, and the live path's ordered sinks."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.operators import ordered, sections, windows
from candlemill.session import scratch_path
from candlemill.sources import landing
from candlemill.streaming import jobs, livepath
from helpers import HOUR, MIN, bar, bars, rows
from test_streaming import few_partitions, play, priced  # noqa: F401

COMMANDS = "symbol string, interval string, at_ms long, seq long, command string"
EVENTS = "interval string, timestamp long, symbols_count long, reason string, published_ms long"


def told(*items):
    return [(s, iv, t, k, c) for k, (s, iv, t, c) in enumerate(items)]


def events(*times, interval="1m"):
    return [(interval, t * 1000, 3, "complete", t) for t in times]


def test_bounded_count_is_a_walk_that_stops_at_zero(frame):
    rng = random.Random(4)
    made = [("ab"[rng.random() < 0.3], rng.randrange(500), k, rng.choice([-1, -1, 1, 1, 0])) for k in range(600)]
    got = ordered.bounded_count(frame(made, "k string, t long, seq long, d int"), ["k"], ["t", "seq"], F.col("d"), "before", "after", F.expr("t div 50"))
    told_ = {r.seq: (r.before, r.after) for r in got.collect()}
    for key in "ab":
        n = 0
        for _, _, seq, d in sorted((r for r in made if r[0] == key), key=lambda r: r[1:3]):
            assert told_[seq] == (n, max(0, n + d))
            n = max(0, n + d)


HOLDS = {
    # holds of one key add up: the first release frees nothing
    "overlap": (told(("A", "1m", 10, "hold"), ("a", "1m", 20, "hold"), ("A", "1m", 30, "release"), ("A", "1m", 40, "release")), [5, 15, 35, 40, 45], [5, 40, 45]),
    # a release without a hold does nothing, also not to a later hold
    "unheld": (told(("A", "1m", 1, "release"), ("A", "1m", 10, "hold"), ("A", "1m", 20, "release"), ("A", "1m", 21, "release")), [5, 10, 15, 20], [5, 20]),
    # the interval is held while any of its keys is
    "keys": (told(("A", "1m", 10, "hold"), ("B", "1m", 12, "hold"), ("A", "1m", 20, "release"), ("B", "1m", 30, "release")), [11, 25, 31], [31]),
    # other intervals aren't
    "interval": (told(("A", "1h", 10, "hold"),), [11], [11]),
    "none": ([], [1, 2], [1, 2]),
}


@pytest.mark.parametrize("name", HOLDS)
def test_counted_holds(frame, play, name):  # noqa: F811
    commands, published, want = HOLDS[name]
    made, given = frame(events(*published), EVENTS), frame(commands, COMMANDS)
    assert sorted(t for t, in rows(sections.suppress_counted(made, given, 15), "published_ms")) == want
    inputs = [tuple(r) for r in jobs.gate_input(made, given).collect()]
    schema = jobs.gate_input(made, given).schema.simpleString()[7:-1].replace(":", " ")
    # cut inside a hold, so that its count is carried over
    for feed in [[[r for r in inputs if r[3] <= 30], [r for r in inputs if r[3] > 30]]]:
        assert sorted(t for t, in rows(play(feed, schema, jobs.hold_stream), "published_ms")) == want


def test_a_suppressed_base_event_has_no_derived_ones(frame):
    base = frame([("1m", 240_000, 3, "complete", 300_100), ("1m", 540_000, 3, "complete", 600_100)], EVENTS)
    kept = sections.suppress_counted(base, frame(told(("A", "1m", 300_000, "hold"), ("A", "1m", 301_000, "release")), COMMANDS))
    assert rows(sections.derive_sections(kept, "1m", ["5m"]), "interval", "timestamp") == [("1m", 540_000), ("5m", 300_000)]


def rebuilt(spark, play, size, *batches):  # noqa: F811
    """Play batches of (symbol, time, arrival) bars and (symbol, stored times, arrival) rebuilds; windows after the last."""
    made = []
    for batch in batches:
        live = spark.createDataFrame(priced(*[b for b in batch if isinstance(b[1], int)]), ", ".join(
            ["symbol string, interval string, open_ms long, arrival_ms long, seq long", *(f"{c} double" for c in S.PRICES + S.VOLUMES), "trade_count long"]))
        empty = windows.rolling_window(bars(spark, [bar("A", 0)]), 1)
        kind = dict(empty.dtypes)["bars"]
        told_ = [(s, [(t, *[float(t)] * 8, 1) for t in times], a, 0) for s, times, a in (b for b in batch if not isinstance(b[1], int))]
        told_ = spark.createDataFrame(told_, f"symbol string, bars {kind}, arrival_ms long, seq long")
        rows_ = jobs.rebuild_input(live, told_)
        made.append([tuple(r) for r in rows_.collect()])
    got = play(made, rows_.schema, lambda s: jobs.rebuild_stream(s, size), "update")
    newest = got.groupBy("symbol").agg(F.max_by("bars", "batch").alias("bars"))
    return {r.symbol: [b.t for b in r.bars] for r in newest.collect()}


def test_rebuild_replaces_trims_and_clears(spark, play):  # noqa: F811
    got = rebuilt(spark, play, 5, [("A", 7, 1), ("A", 5000, 2), ("B", 1, 1)], [("A", list(range(993, 1001)), 3), ("B", [], 4)])
    assert got == {"A": [1000, 999, 998, 997, 996], "B": []}


def test_live_bars_join_a_rebuilt_window_without_a_seam(spark, play):  # noqa: F811
    # the feed repeats the stored tail, then goes on; bars that arrive in the rebuild's own batch come before or after it
    got = rebuilt(spark, play, 4, [("A", 60, 1)], [("A", 900, 5), ("A", [120, 300, 240, 180], 6), ("A", 300, 7), ("A", 360, 8)], [("A", 360, 9), ("A", 420, 10)],
                  [("C", [], 11), ("C", 3, 12)])
    assert got == {"A": [420, 360, 300, 240], "C": [3]}


class Crash(Exception):
    pass


def path_events(spark, n=60):
    rng = random.Random(2)
    made = []
    for k in range(n):
        t = k * 20_000
        made.append((rng.choice("ABC"), "1m", t - t % MIN - rng.choice([0, 0, MIN]), t - t % MIN + MIN - 1, "1", "bad" if k % 17 == 3 else "2", "1", "1", "1", "1", "1", "1",
                     k, k % 7 != 0, t, k))
    schema = spark.createDataFrame([], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.EVENT.fields) + ", seq long").schema
    return made, schema


def play_path(spark, batches, schema, breaks=(), universe=None):
    """Run the batches through a live path that breaks once behind each of the named sinks of each batch."""
    root, source, checkpoint = (scratch_path(spark, f"path-{n}") for n in "rsc")
    left = {(sink, k) for sink in breaks for k in range(len(batches))}

    def between(sink, batch_id):
        if (sink, batch_id) in left:
            left.remove((sink, batch_id))
            raise Crash(sink)

    universe = universe or spark.createDataFrame([(s,) for s in "ABC"], "symbol string")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        while True:
            stream = landing.event_stream(spark, source, schema)
            running = stream.writeStream.foreachBatch(livepath.live_path(root, universe, 6, 2 * MIN, HOUR, between)).option(
                "checkpointLocation", checkpoint).trigger(availableNow=True).start()
            try:
                running.awaitTermination()
                break
            except Exception as e:
                assert "Crash" in str(e)
    assert not left
    held = spark.read.option("basePath", f"{root}/windows").parquet(f"{root}/windows")
    last = held.where(F.col("batch") == held.agg(F.max("batch")).first()[0])
    return (rows(spark.read.parquet(f"{root}/archive").drop("month")), sorted((r.symbol, [b.t for b in r.bars]) for r in last.collect()),
            rows(spark.read.parquet(f"{root}/ready").drop("batch", "query")))


def test_a_crash_between_sinks_changes_nothing(spark):
    made, schema = path_events(spark)
    batches = [made[:25], made[25:]]
    plain = play_path(spark, batches, schema)
    assert len(plain[0]) > 15 and [len(b) for _, b in plain[1]] == [6, 6, 6] and {r[3] for r in plain[2]} == {"complete", "timeout"}
    assert play_path(spark, batches, schema, ("archive", "windows", "ready", "sections")) == plain


def test_live_path_against_plain_python(spark):
    made, schema = path_events(spark)
    seen, closed, first = {}, [], {}
    for s, iv, t, *rest in made:
        if rest[2] != "bad" and rest[-3] and t > seen.get(s, -10**9):
            seen[s] = t
            closed.append((s, t, rest[-2]))
    for s, t, a in closed:
        first.setdefault(t, {}).setdefault(s, a)
    clock, ready = max(a for *_, a in closed), []
    for t, arrived in first.items():
        deadline = min(arrived.values()) + 2 * MIN
        inside = sorted(a for a in arrived.values() if a <= deadline)
        if len(inside) == 3:
            ready.append(("1m", t, 3, "complete", inside[-1]))
        elif deadline < clock:
            ready.append(("1m", t, len(inside), "timeout", deadline))
    archive, held, got = play_path(spark, [made[:30], made[30:]], schema)
    assert sorted((r[0], r[1]) for r in archive) == sorted((s, t) for s, t, _ in closed)
    assert held == [(s, sorted((t for x, t, _ in closed if x == s), reverse=True)[:6]) for s in "ABC"]
    assert sorted(got) == sorted(ready)
    assert all(len(list(g)) == 1 for _, g in itertools.groupby(sorted(r[1] for r in got)))


def test_a_section_waits_for_the_members_of_its_own_time(spark):
    """C joins between two batches and B leaves later; the table is read anew by every batch."""
    _, schema = path_events(spark, 1)
    spans = [[("A", 0, None), ("B", 0, 5 * MIN)], [("A", 0, None), ("B", 0, 5 * MIN), ("C", 3 * MIN, None)]]
    asked = []

    def members():
        asked.append(1)
        return spark.createDataFrame(spans[min(len(asked), 2) - 1], "symbol string, valid_from_ms long, valid_to_ms long")

    def closed(symbol, minute, seq):
        return (symbol, "1m", minute * MIN, minute * MIN + MIN - 1, *["1"] * 8, 1, True, minute * MIN + seq, 100 * minute + seq)

    first = [closed("A", 1, 1), closed("B", 1, 2), closed("C", 1, 3), closed("A", 2, 1)]
    second = [closed("B", 2, 4), closed("A", 3, 1), closed("B", 3, 2), closed("C", 3, 9), closed("A", 5, 1), closed("C", 5, 2), closed("B", 5, 3)]
    *_, ready = play_path(spark, [first, second], schema, universe=members)
    assert sorted(r[1:4] for r in ready) == [(MIN, 2, "complete"), (2 * MIN, 2, "complete"), (3 * MIN, 3, "complete"), (5 * MIN, 2, "complete")]
