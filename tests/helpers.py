"""Small builders for literal fixtures."""

from __future__ import annotations

import datetime as dt

from candlemill import schemas as S
from candlemill import timegrid as tg

MIN, BAR, HOUR, DAY = tg.MINUTE_MS, tg.BAR_MS, tg.HOUR_MS, tg.DAY_MS
OI = "symbol string, start_ms long, sum_open_interest double, snap_ms long, src_rank int, ingest_seq long"


def ms(text: str) -> int:
    return tg.to_ms(dt.datetime.fromisoformat(text))


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def bar(symbol: str, start: int, price: float = 10.0, version: int = 1, seq: int = 0, **over) -> dict:
    made = dict(symbol=symbol, start_ms=start, end_ms=start + MIN - 1, open=price, high=price, low=price,
                close=price, volume=1.0, quote_volume=price, taker_buy_volume=0.5,
                taker_buy_quote_volume=price / 2, trades_count=3, version=version, ingest_seq=seq)
    made.update(over)
    return made


def bars(spark, made: list[dict]):
    names = [f.name for f in S.BARS_1M.fields]
    return spark.createDataFrame([tuple(b[n] for n in names) for b in made], S.BARS_1M)
