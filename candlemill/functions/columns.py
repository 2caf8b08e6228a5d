from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


_NUMBER = r"(?i)\A(?:[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity)|nan)\z"


def finite(value: Column) -> Column:
    """True for a value that is neither NULL, NaN nor infinite."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))


def number(text: Column) -> Column:
    """Strict decimal text to double, NULL when it does not parse.

    A cast alone also takes padding and the suffixes of Java's number literals.
    """
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def rel_close(a: Column, b: Column, tol: float) -> Column:
    """Equal, or within ``tol`` of the larger magnitude."""
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1e-12))
    return (a == b) | (F.abs(a - b) / scale <= F.lit(tol))


def ratio_of(part: Column, total: Column, empty: float | None = None) -> Column:
    """``part / total`` with ``empty`` (NULL by default) for a zero total."""
    share = F.try_divide(part.cast("double"), total.cast("double"))
    return share if empty is None else F.coalesce(share, F.lit(empty))


def findings(*rules: tuple[Column, Column]) -> Column:
    """Array of the texts whose condition holds, in rule order."""
    return F.array_compact(F.array(*[F.when(cond, text) for cond, text in rules]))


def counted(label: str, n: Column) -> tuple[Column, Column]:
    """A finding that reports a non-zero counter."""
    return n > 0, F.concat(F.lit(label + "="), n.cast("string"))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Text of the first rule that holds, NULL when none does."""
    return F.coalesce(*[F.when(cond, F.lit(text)) for cond, text in rules])


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def stable_bucket(symbol: Column, buckets: int) -> Column:
    """Bucket of a symbol that never moves when other symbols come or go."""
    if buckets <= 1:
        return F.lit(0).cast("long")
    return F.pmod(F.crc32(F.upper(symbol)), F.lit(buckets)).cast("long")


def stream_name(symbol: Column, interval: Column) -> Column:
    """``BTCUSDT``, ``1m`` to ``btcusdt@kline_1m``."""
    return F.concat(F.lower(symbol), F.lit("@kline_"), interval)


def parse_stream_name(name: Column) -> Column:
    """Inverse of :func:`stream_name` as ``struct(symbol, interval)``, NULL if malformed."""
    pattern = r"^(.+)@kline_(\w+)$"
    return F.when(
        name.rlike(pattern),
        F.struct(F.upper(F.regexp_extract(name, pattern, 1)).alias("symbol"),
                 F.regexp_extract(name, pattern, 2).alias("interval")),
    )


def leading_integer(payload: Column) -> Column:
    """Open time of a serialized bar array, read without parsing the rest."""
    return F.regexp_extract(payload, r"^\[(-?\d+)", 1).try_cast("long")
