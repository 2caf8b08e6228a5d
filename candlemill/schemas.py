"""Schemas of the tables; readers always get one, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_S, _L, _D, _I, _B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

PRICES = ["open", "high", "low", "close"]
VOLUMES = ["volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume"]
BAR_VALUES = PRICES + VOLUMES + ["trades_count"]
BAR_KEYS = ["symbol", "start_ms"]

_BAR = [("symbol", _S), ("start_ms", _L), ("end_ms", _L),
        *[(c, _D) for c in PRICES + VOLUMES], ("trades_count", _L)]

BARS_1M = _schema(*_BAR, ("version", _L), ("ingest_seq", _L))
BARS = _schema(*_BAR, ("version", _L))

OI_5M = _schema(("symbol", _S), ("start_ms", _L), ("sum_open_interest", _D),
                ("snap_ms", _L), ("src_rank", _I), ("ingest_seq", _L))

# The three ratio measures, in the order of their source kinds.
RATIOS = ["count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio",
          "count_long_short_ratio"]
# Endpoint that delivers each measure.
RATIO_KINDS = {"topLongShortAccountRatio": RATIOS[0],
               "topLongShortPositionRatio": RATIOS[1],
               "globalLongShortAccountRatio": RATIOS[2]}

RATIO_5M = _schema(("symbol", _S), ("start_ms", _L), *[(c, _D) for c in RATIOS],
                   ("snap_ms", _L), ("src_rank", _I), ("ingest_seq", _L))

EVENT_TEXT = PRICES + VOLUMES
EVENT = _schema(("symbol", _S), ("interval", _S), ("open_ms", _L), ("close_ms", _L),
                *[(c, _S) for c in EVENT_TEXT], ("trade_count", _L), ("is_final", _B),
                ("arrival_ms", _L))

READY_EVENT = _schema(("interval", _S), ("timestamp", _L), ("symbols_count", _L),
                      ("published_ms", _L))

GAPS = _schema(("symbol", _S), ("interval", _S), ("from_ms", _L), ("to_ms", _L),
               ("from_utc", _S), ("to_utc", _S), ("missing_count", _L))
GAPS_TEXT = _schema(*[(f.name, _S) for f in GAPS.fields])

ARCHIVE_CSV = _schema(*[(c, _S) for c in (
    "create_time", "symbol", "sum_open_interest", "sum_open_interest_value",
    *RATIOS, "sum_taker_long_short_vol_ratio")])

# Source ranks, highest wins.
RANK_LIVE, RANK_HIST, RANK_ARCHIVE = 1, 2, 3
