"""Guards and windows that hold a key's different bars, not its rows."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import Row

from candlemill.streaming import advancing, processors
from helpers import rows

SCHEMA = "symbol string, interval string, open_ms long, arrival_ms long, seq long"


class Value:
    """A processor's state variable, kept in this process."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update


class Handle:
    def getValueState(self, *_):
        return Value()

    getListState = getValueState


class Counted:
    """A row that knows how many of its kind are held."""

    now = most = 0

    def __init__(self, open_ms, arrival_ms, seq):
        self.open_ms, self.arrival_ms, self.seq = open_ms, arrival_ms, seq
        Counted.now += 1
        Counted.most = max(Counted.most, Counted.now)

    def __del__(self):
        Counted.now -= 1

    def __getitem__(self, name):
        return getattr(self, name, 1)


def shuffled(n, bars):
    made = [(t * bars // n, t, t) for t in range(n)]
    random.Random(4).shuffle(made)
    return made


@pytest.mark.parametrize("kind", [
    processors.MonotonicGuard, pytest.param(lambda: processors.RollingWindow(5), id="RollingWindow")])
def test_a_key_holds_its_bars_alone(kind):
    processor = kind()
    processor.init(Handle())
    Counted.most = 0
    out = list(processor.handleInputRows(("A", "1m"), (Counted(*r) for r in shuffled(5_000, 40)), None))
    times = [r.open_ms if "open_ms" in r else r.t for r in out]
    assert times in (list(range(40)), [39, 38, 37, 36, 35]) and Counted.most < 5


def test_advance_is_running_maximum():
    for seed in range(200):
        r = random.Random(seed)
        made = [(r.randrange(12), r.randrange(15), i) for i in range(30)]
        high, want = 3, []
        for row in sorted(made, key=lambda x: x[1:]):
            if row[0] > high:
                high = row[0]
                want.append(row)
        found = advancing.Advance(3)
        for o, a, s in made:
            found.add(Row(open_ms=o, arrival_ms=a, seq=s), (o, a, s))
        assert found.bars == want


def test_tasks_send_bars_and_no_repeats(frame, monkeypatch):
    made = [(s, "1m", *r) for s in ("A", None) for r in shuffled(2_000, 30)]
    late = [("A", "1m", None, 1, 1), ("A", "1m", 1, None, 1)]
    found = advancing.advanced(frame(made + late, SCHEMA).coalesce(1), "symbol", "interval")
    want = [(s, "1m", o, t, t) for s in ("A", None) for o in range(30) for t in [-(-o * 2_000 // 30)]]
    assert rows(found) == sorted(want + late, key=repr)


REBUILDS = "symbol string, open_ms long, arrival_ms long, seq long, stored array<struct<t:long>>"


def window_after(made, size, window):
    """The open times a window shows after (open, arrival, seq, stored) rows, taken one by one."""
    for open_ms, _, _, stored in sorted(made, key=lambda r: r[1:3]):
        if stored is not None:
            window = sorted((t for t, in stored), reverse=True)[:size]
        elif not window or open_ms > window[0]:
            window = [open_ms, *window][:size]
    return window


def test_what_precedes_a_rebuild_or_leaves_the_window_again_is_not_needed():
    schema = pa.schema([("open_ms", pa.int64()), ("arrival_ms", pa.int64()), ("seq", pa.int64()), ("stored", pa.list_(pa.struct([("t", pa.int64())])))])
    for seed in range(300):
        r = random.Random(seed)
        made = [(None, a, i, [(r.randrange(20),) for _ in range(r.randrange(4))]) if r.random() < 0.1 else (r.randrange(20), a, i, None)
                for i in range(30) for a in [r.randrange(15)]]
        table = pa.table(dict(zip(schema.names, ([[{"t": t} for t, in v] if k == 3 and v is not None else v for v in column]
                                                 for k, column in enumerate(zip(*made))))), schema)
        size = r.choice([1, 3, 50])
        kept = [(x["open_ms"], x["arrival_ms"], x["seq"], x["stored"] and [(b["t"],) for b in x["stored"]])
                for x in advancing.since_rebuild(table, size).to_pylist()]
        held = sorted(r.sample(range(20), 3), reverse=True)
        assert len(kept) <= size + 1
        for before in ([], held[:size]):
            assert window_after(kept, size, before) == window_after(made, size, before)


def test_a_keys_task_gets_its_spans_and_no_repeats(frame):
    # a bar that was held back counts again behind the rebuild, which another task reads
    bars = [("A", o * 60_000, t * 600, t, None) for o, t, _ in shuffled(20_000, 200)]
    told = [("A", None, 9_000_300, 0, [(1,)])]
    found = advancing.rebuilt(frame(bars + told, REBUILDS).repartition(7), 5)
    assert found.count() <= 4 * 6 and found.where("stored IS NOT NULL").count() == 1
    assert window_after([tuple(x)[1:] for x in found.collect()], 5, []) == window_after([x[1:] for x in bars + told], 5, [])
    late = [("A", 1, None, 1, None), (None, None, 5, 1, None), (None, 7, 6, 1, None)]
    assert rows(advancing.rebuilt(frame(late, REBUILDS), 5)) == sorted(late, key=repr)
