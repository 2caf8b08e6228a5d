"""Time handling shared by every operator.

All keys are UTC epoch milliseconds held in LongType, and every bucket is plain
integer arithmetic on them, so no result depends on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds per interval unit.
UNIT_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}

MINUTE_MS = 60_000
BAR_MS = 300_000  # snapshots (open interest, ratios) live on a 5-minute grid
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Rollup levels and the days each one keeps refreshing.
KLINE_LOOKBACK_DAYS = {"5m": 3, "15m": 3, "1h": 3, "4h": 7, "1d": 10}
SNAPSHOT_LOOKBACK_DAYS = {"15m": 3, "1h": 3, "4h": 7, "1d": 10}

_EPOCH = dt.datetime(1970, 1, 1)


# --- driver-side parameters -------------------------------------------------

def interval_ms(text: str, calendar_month: bool = False) -> int:
    """Length of an interval such as ``5m``; ``M`` (30 days) only for readers."""
    count, unit = text[:-1], text[-1:]
    if not (count.isascii() and count.isdigit()) or int(count) == 0:
        raise ValueError(f"not an interval: {text!r}")
    if unit == "M" and calendar_month:
        return int(count) * 30 * DAY_MS
    if unit not in UNIT_MS:
        raise ValueError(f"unknown interval unit: {text!r}")
    return int(count) * UNIT_MS[unit]


def is_derivable(text: str) -> bool:
    """Can the interval be folded from 1m bars by epoch-aligned buckets?

    Weeks and multi-day intervals are refused: the epoch is a Thursday.
    """
    try:
        step = interval_ms(text)
    except ValueError:
        return False
    if step <= MINUTE_MS or step % MINUTE_MS:
        return False
    return text[-1] in "smh" or step == DAY_MS


def rollup_step(text: str) -> int:
    """Step of a rollup level, refusing intervals that cannot be folded from 1m."""
    if not is_derivable(text):
        raise ValueError(f"{text!r} cannot be folded from 1m bars")
    return interval_ms(text)


def floor_to(ms: int, step: int) -> int:
    return ms - ms % step


def settled_window(now_ms: int, hours: float, settle_minutes: float) -> tuple[int, int]:
    """Inclusive ``(lo, hi)`` of 5m bar opens that should exist by now."""
    hi = floor_to(now_ms - int(settle_minutes * MINUTE_MS), BAR_MS) - BAR_MS
    return hi - int(hours * HOUR_MS) + BAR_MS, hi


def parse_start(text: str) -> int:
    """UTC date or date-time text to epoch ms, rounded up to the next 5m bar."""
    moment = dt.datetime.fromisoformat(text.strip())
    if moment.tzinfo is not None:
        raise ValueError("give a UTC time without an offset")
    ms = to_ms(moment)
    return ms + (-ms) % BAR_MS


def newest_published(now_ms: int, lag_ms: int = 4 * MINUTE_MS) -> int:
    """Open of the newest 5m bar whose history label is readable at ``now_ms``."""
    return floor_to(now_ms - lag_ms, BAR_MS) - BAR_MS


def sweep_window(now_ms: int, settle_ms: int, window_ms: int, step: int) -> tuple[int, int]:
    """Half-open scan range of a repair sweep."""
    to_ms_ = floor_to(now_ms - settle_ms, step)
    return to_ms_ - window_ms, to_ms_


def to_ms(moment: dt.datetime) -> int:
    return (moment - _EPOCH) // dt.timedelta(milliseconds=1)


def month_bounds(text: str) -> tuple[int, int]:
    """``YYYY-MM`` or a month-start date to its half-open ms range."""
    parts = text.split("-")
    if len(parts) == 3 and parts[2] != "01":
        raise ValueError(f"not a month start: {text!r}")
    year, month = int(parts[0]), int(parts[1])
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    return to_ms(dt.datetime(year, month, 1)), to_ms(dt.datetime(*following, 1))


def require_month_start(ms: int) -> None:
    moment = _EPOCH + dt.timedelta(milliseconds=ms)
    if moment != dt.datetime(moment.year, moment.month, 1):
        raise ValueError(f"{moment} is not a month start")


def months_between(from_ms: int, to_ms_: int) -> list[int]:
    """``yyyymm`` numbers of the months that ``[from, to)`` touches."""
    if to_ms_ <= from_ms:
        return []
    first = _EPOCH + dt.timedelta(milliseconds=from_ms)
    last = _EPOCH + dt.timedelta(milliseconds=to_ms_ - 1)
    span = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [(m // 12) * 100 + m % 12 + 1 for m in span]


# --- column expressions -----------------------------------------------------

def bucket(ms: Column, step: int) -> Column:
    """Start of the epoch-aligned bucket holding ``ms``."""
    return ms - F.pmod(ms, F.lit(step))


def whole(ms: Column, step: int) -> Column:
    """How many whole steps fit into ``ms`` (LongType, floor for ms >= 0)."""
    return ((ms - F.pmod(ms, F.lit(step))) / F.lit(step)).cast("long")


def epoch_ms(ts: Column) -> Column:
    """Epoch ms of a TIMESTAMP_NTZ read as UTC; no session zone involved."""
    return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def utc_text(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC."""
    day = F.date_from_unix_date(whole(ms, DAY_MS).cast("int")).cast("string")
    rest = F.pmod(ms, F.lit(DAY_MS))

    def two(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    return F.concat(
        day, F.lit(" "), two(whole(rest, HOUR_MS)), F.lit(":"),
        two(whole(F.pmod(rest, F.lit(HOUR_MS)), MINUTE_MS)), F.lit(":"),
        two(whole(F.pmod(rest, F.lit(MINUTE_MS)), 1_000)),
    )


def utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(whole(ms, DAY_MS).cast("int"))


def month_of(ms: Column) -> Column:
    """``yyyymm`` as an integer, the partition column of every table."""
    day = utc_date(ms)
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_start_ms(ms: Column) -> Column:
    return F.unix_date(F.trunc(utc_date(ms), "MM")).cast("long") * F.lit(DAY_MS)


def next_month_start_ms(ms: Column) -> Column:
    return F.unix_date(F.add_months(F.trunc(utc_date(ms), "MM"), 1)).cast("long") * F.lit(DAY_MS)
