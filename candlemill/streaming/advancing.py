"""Bars that move a key's open time on, found without ordering all rows of the key at once."""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# executors get these functions with the query, so they need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 250_000  # rows that a task holds at once
SPAN_MS = 3_600_000  # arrivals of a key that are reduced together where rebuilds lie between its bars
_ORDER = ("arrival_ms", "seq")


def _groups(table: pa.Table, keys: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): rows by key and time of arrival, and where each key begins in that order."""
    code = np.zeros(table.num_rows, np.int64)
    for key in keys:
        one = pc.dictionary_encode(table.column(key), null_encoding="encode").combine_chunks()
        one = one.chunk(0) if isinstance(one, pa.ChunkedArray) else one
        code = np.unique(code * len(one.dictionary) + one.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    order = np.lexsort((table.column("seq").to_numpy(), table.column("arrival_ms").to_numpy(), code))
    return order, np.flatnonzero(np.diff(code[order], prepend=-1))


def advancing(table: pa.Table, keys: tuple[str, ...]) -> pa.Table:
    """The rows whose open time exceeds that of every row of their key that arrived earlier."""
    if not table.num_rows:
        return table
    order, starts = _groups(table, keys)
    opens = table.column("open_ms").to_numpy()[order]
    kept = np.ones(len(opens), bool)
    for a, b in zip(starts, [*starts[1:], len(opens)]):
        kept[a + 1:b] = opens[a + 1:b] > np.maximum.accumulate(opens[a:b])[:-1]
    return table.take(pa.array(order[kept]))


def advanced(closed: DataFrame, *keys: str) -> DataFrame:
    """``closed`` without rows that an earlier arrival of their own task's rows and key holds back.

    No guard or window takes such a row, so this only saves moving it to its key's task: what a task sends grows with
    the bars it has seen, not with their repeats. Rows without a time are left to the step behind.
    """
    timed = ["open_ms", *_ORDER]
    rows = closed.withColumns({c: closed[c].cast("long") for c in timed})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if any(table.column(c).null_count for c in timed):
                known = pc.and_(pc.and_(*(pc.is_valid(table.column(c)) for c in timed[:2])), pc.is_valid(table.column(timed[2])))
                yield from table.filter(pc.invert(known)).to_batches()
                table = table.filter(known)
            held.append(table)
            n += table.num_rows
            if n >= BLOCK:
                kept = advancing(pa.concat_tables(held), keys)
                held, n = [kept], kept.num_rows
                if n > BLOCK // 2:
                    yield from kept.to_batches(10_000)
                    held, n = [], 0
        if held:
            yield from advancing(pa.concat_tables(held), keys).to_batches(10_000)

    return rows.mapInArrow(run, rows.schema)


def since_rebuild(table: pa.Table, size: int) -> pa.Table:
    """One key's last rebuild (a row with ``stored``) and the newest ``size`` bars behind it that move the open time on."""
    if any(table.column(c).null_count for c in _ORDER):
        return table
    order, _ = _groups(table, ())
    told = np.flatnonzero(pc.is_valid(table.column("stored")).to_numpy()[order])
    order, last = (order[told[-1]:], 1) if len(told) else (order, 0)
    bars = table.take(pa.array(order[last:]))
    if bars.column("open_ms").null_count:
        return table
    return pa.concat_tables([table.take(pa.array(order[:last])), advancing(bars, ())[-size:]])


def rebuilt(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` of rebuilds and bars without those that no window of ``size`` bars shows after their batch.

    A bar that an earlier one holds back counts again if a rebuild lies between them, so a key's rows of one span of
    arrivals meet first, and many tasks share a busy key. What goes on to the key's own task grows with the spans.
    """
    timed = ["open_ms", *_ORDER]
    rows = rows.withColumns({c: rows[c].cast("long") for c in timed})
    span = F.floor(F.col("arrival_ms") / SPAN_MS)
    return rows.groupBy("symbol", span).applyInArrow(lambda table: since_rebuild(table, size), rows.schema)


class Advance:
    """The same for one key's rows as they come, in any order: each bar's open time exceeds ``high`` and those before it.

    Open times rise with arrival among what is held, so there are never more entries than different bars.
    """

    def __init__(self, high: int | None):
        self.high = high
        self.order: list[tuple] = []
        self.opens: list[int] = []
        self.bars: list[tuple] = []

    def add(self, row: Row, bar: tuple) -> None:
        if self.high is not None and row.open_ms <= self.high:
            return
        order = (row.arrival_ms, row.seq)
        at = end = bisect_right(self.order, order)
        if at and self.opens[at - 1] >= row.open_ms:
            return
        while end < len(self.opens) and self.opens[end] <= row.open_ms:
            end += 1
        self.order[at:end], self.opens[at:end], self.bars[at:end] = [order], [row.open_ms], [bar]
