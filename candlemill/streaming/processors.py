"""Stateful processors for ``transformWithState``.

State is small by construction: one value per key for the guard and the live
bar, at most ``size`` bars per window, at most one entry per universe symbol in
an open section. Within a batch the guard and the windows hold a key's different
bars, not its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

from candlemill.streaming.advancing import Advance

# executors get these classes with the query, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE_BAR = "t long, o double, h double, l double, c double, v double, qv double, " \
             "tbv double, tbqv double, n long"
_BAR_NAMES = ("t", "o", "h", "l", "c", "v", "qv", "tbv", "tbqv", "n")
_ROW_NAMES = ("open_ms", "open", "high", "low", "close", "volume", "quote_volume",
              "taker_buy_volume", "taker_buy_quote_volume", "trade_count")


def _arrival_order(row: Row) -> tuple:
    return row.arrival_ms, row.seq


class LiveBar(StatefulProcessor):
    """Latest event per (symbol, interval), forgotten when it was not renewed in time."""

    schema = "symbol string, interval string, open_ms long, close double, trade_count long, " \
             "is_final boolean, arrival_ms long, seq long"

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.last = handle.getValueState(
            "last", "open_ms long, close double, trade_count long, is_final boolean, "
                    "arrival_ms long, seq long", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max(rows, key=_arrival_order)
        known = self.last.get() if self.last.exists() else None
        if known is not None and (known[4], known[5]) > _arrival_order(newest):
            return
        self.last.update((newest.open_ms, newest.close, newest.trade_count, newest.is_final,
                          newest.arrival_ms, newest.seq))
        yield Row(symbol=key[0], interval=key[1], open_ms=newest.open_ms, close=newest.close,
                  trade_count=newest.trade_count, is_final=newest.is_final,
                  arrival_ms=newest.arrival_ms, seq=newest.seq)

    def close(self) -> None:
        pass


class MonotonicGuard(StatefulProcessor):
    """Pass on closed bars whose open time exceeds every earlier one of the key."""

    schema = "symbol string, interval string, open_ms long, arrival_ms long, seq long"

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "open_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = Advance(self.last.get()[0] if self.last.exists() else None)
        for row in rows:
            passed.add(row, ())
        for open_ms, (arrival_ms, seq) in zip(passed.opens, passed.order):
            yield Row(symbol=key[0], interval=key[1], open_ms=open_ms, arrival_ms=arrival_ms, seq=seq)
        if passed.opens:
            self.last.update((passed.opens[-1],))

    def close(self) -> None:
        pass


class RollingWindow(StatefulProcessor):
    """Last ``size`` closed bars per symbol, newest first.

    A bar enters only if it is newer than the head, so replays are harmless and
    an initial window from the store joins the live feed without a seam.
    """

    schema = f"symbol string, pos int, {_STATE_BAR}"

    def __init__(self, size: int = 200):
        self.size = size

    def init(self, handle) -> None:
        self.bars = handle.getListState("bars", _STATE_BAR)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # called once per stored bar, in no particular order
        self.bars.appendValue(tuple(initialState[name] for name in _BAR_NAMES))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.bars.get() if self.bars.exists() else []
        window = sorted((tuple(bar) for bar in known), reverse=True)[: self.size]
        entered = Advance(window[0][0] if window else None)
        for row in rows:
            entered.add(row, tuple(row[name] for name in _ROW_NAMES))
        if not entered.bars:
            return
        window = [*entered.bars[::-1][:self.size], *window][:self.size]
        self.bars.put(window)
        for pos, bar in enumerate(window):
            yield Row(symbol=key[0], pos=pos, **dict(zip(_BAR_NAMES, bar)))

    def close(self) -> None:
        pass


class SectionReady(StatefulProcessor):
    """One ready event per (interval, open time): all symbols in, or a timeout.

    Time is event time over the arrival clock. A timer fires at the deadline, and
    a second one forgets the section after its retention.
    """

    schema = "interval string, timestamp long, symbols_count long, reason string, published_ms long"

    def __init__(self, timeout_ms: int, retention_ms: int):
        self.timeout_ms, self.retention_ms = timeout_ms, retention_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "symbol string", "arrival_ms long")
        # forget_ms is 0 until the section is published
        self.section = handle.getValueState("section", "deadline_ms long, forget_ms long")

    def _publish(self, key, count: int, reason: str, at_ms: int, deadline_ms: int) -> Row:
        forget = at_ms + self.retention_ms
        self.section.update((deadline_ms, forget))
        self.seen.clear()
        self.handle.deleteTimer(deadline_ms)
        self.handle.registerTimer(forget)
        return Row(interval=key[0], timestamp=key[1], symbols_count=count, reason=reason,
                   published_ms=at_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # one entry per symbol: its first arrival in this batch
        first: dict[str, int] = {}
        size = 0
        for row in rows:
            size = row.universe_size
            if row.symbol not in first or row.arrival_ms < first[row.symbol]:
                first[row.symbol] = row.arrival_ms
        if self.section.exists():
            deadline, forget = self.section.get()
            if forget:
                return
        else:
            deadline = min(first.values()) + self.timeout_ms
            self.section.update((deadline, 0))
            self.handle.registerTimer(deadline)
        known = {entry[0] for entry in self.seen.keys()} if self.seen.exists() else set()
        for symbol, arrival in sorted(first.items(), key=lambda item: (item[1], item[0])):
            if arrival > deadline:
                yield self._publish(key, len(known), "timeout", deadline, deadline)
                return
            if symbol not in known:
                known.add(symbol)
                self.seen.updateValue((symbol,), (arrival,))
            if 0 < size <= len(known):
                yield self._publish(key, len(known), "complete", arrival, deadline)
                return

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.section.exists():
            return
        deadline, forget = self.section.get()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if forget:
            # a timer of another time is a leftover and ends nothing
            if fired == forget:
                self.section.clear()
            return
        if fired != deadline:
            return
        count = sum(1 for _ in self.seen.keys()) if self.seen.exists() else 0
        yield self._publish(key, count, "timeout", deadline, deadline)

    def close(self) -> None:
        pass


class HoldGate(StatefulProcessor):
    """Pass on section events of an interval while none of its keys is held.

    One input carries hold and release commands and events. The state counts the holders of each held key, so holds that
    overlap add up and a release without a hold does nothing. A batch is gone through in the order of its times,
    commands first.
    """

    schema = "interval string, timestamp long, symbols_count long, reason string, published_ms long"

    def init(self, handle) -> None:
        self.holders = handle.getMapState("holders", "symbol string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        holders = {k[0]: n[0] for k, n in self.holders.iterator()} if self.holders.exists() else {}
        known = dict(holders)
        for row in sorted(rows, key=lambda r: (r.at_ms, r.kind == "event", r.seq)):
            if row.kind == "event":
                if not holders:
                    yield Row(interval=key[0], timestamp=row.timestamp, symbols_count=row.symbols_count,
                              reason=row.reason, published_ms=row.at_ms)
                continue
            symbol = row.symbol.upper()
            n = holders.get(symbol, 0) + (1 if row.kind == "hold" else -1)
            if n > 0:
                holders[symbol] = n
            else:
                holders.pop(symbol, None)
        for symbol in known.keys() - holders.keys():
            self.holders.removeKey((symbol,))
        for symbol, n in holders.items():
            if known.get(symbol) != n:
                self.holders.updateValue((symbol,), (n,))

    def close(self) -> None:
        pass


class RebuiltWindow(StatefulProcessor):
    """Rolling windows that a command may replace while the feed runs.

    A row with ``stored`` (not null) is a rebuild: the window becomes its newest ``size`` bars, none if it is empty. A row
    without it is a closed bar, which enters if it is newer than the head. Both are taken in the order of arrival, so the
    feed joins a rebuilt window without a seam. Every change gives the whole window, an empty one if it was cleared.
    """

    schema = f"symbol string, bars array<struct<{_STATE_BAR.replace(' ', ':').replace(',:', ',')}>>"

    def __init__(self, size: int = 200):
        self.size = size

    def init(self, handle) -> None:
        self.bars = handle.getListState("bars", _STATE_BAR)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        window = [tuple(bar) for bar in self.bars.get()] if self.bars.exists() else []
        changed = False
        for row in sorted(rows, key=_arrival_order):
            if row.stored is not None:
                window = sorted((tuple(bar[n] for n in _BAR_NAMES) for bar in row.stored), reverse=True)[:self.size]
            elif not window or row.open_ms > window[0][0]:
                window = [tuple(row[name] for name in _ROW_NAMES), *window][:self.size]
            else:
                continue
            changed = True
        if not changed:
            return
        if window:
            self.bars.put(window)
        else:
            self.bars.clear()
        yield Row(symbol=key[0], bars=[Row(**dict(zip(_BAR_NAMES, bar))) for bar in window])

    def close(self) -> None:
        pass


class SilenceEnd(StatefulProcessor):
    """One row for each arrival of a key that ends a silence longer than ``stale_ms``."""

    schema = "symbol string, interval string, last_before_ms long, first_after_ms long, ended_at timestamp"

    def __init__(self, stale_ms: int):
        self.stale_ms = stale_ms

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "arrival_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for at, stamp in sorted((row.arrival_ms, row.arrival_ts) for row in rows):
            if last is not None and at - last > self.stale_ms:
                yield Row(symbol=key[0], interval=key[1], last_before_ms=last, first_after_ms=at, ended_at=stamp)
            last = at if last is None else max(last, at)
        self.last.update((last,))

    def close(self) -> None:
        pass


class Debounce(StatefulProcessor):
    """One request for silences of a group that end within ``quiet_ms`` of each other, once that time is over.

    A later end puts the request off; a timer fires it when the watermark has passed the quiet time. State is one pending
    request for each group.
    """

    schema = "interval string, from_ms long, last_end_ms long, fire_ms long"

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "from_ms long, last_end_ms long")

    def _request(self, key, pending) -> Row:
        return Row(interval=key[0], from_ms=pending[0], last_end_ms=pending[1], fire_ms=pending[1] + self.quiet_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = tuple(self.pending.get()) if self.pending.exists() else None
        pending = known
        for end in sorted(row.first_after_ms for row in rows):
            if pending is not None and end <= pending[1] + self.quiet_ms:
                pending = (pending[0], max(pending[1], end))
                continue
            if pending is not None:
                yield self._request(key, pending)
            pending = (end, end)
        if pending != known:
            if known is not None:
                self.handle.deleteTimer(known[1] + self.quiet_ms)
            self.handle.registerTimer(pending[1] + self.quiet_ms)
            self.pending.update(pending)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        pending = tuple(self.pending.get()) if self.pending.exists() else None
        # a timer of another time was put off
        if pending is not None and expiredTimerInfo.getExpiryTimeInMs() == pending[1] + self.quiet_ms:
            self.pending.clear()
            yield self._request(key, pending)

    def close(self) -> None:
        pass
