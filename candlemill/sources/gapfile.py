"""The gap file that moves missing ranges from the checkers to the repair jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx

# Fixed value: what a symbol may look like; letters of any script are allowed.
SYMBOL_PATTERN = r"(?U)^\w{1,32}$"


def write_gaps(gaps: DataFrame, path: str) -> None:
    """Write every gap as CSV with a header."""
    gaps.select(*[f.name for f in S.GAPS.fields]).write.mode("overwrite").option(
        "header", True).csv(path)


def load_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Raw text rows of a gap file."""
    return spark.read.schema(S.GAPS_TEXT).option("header", True).csv(path)


def read_gaps(rows: DataFrame, interval: str) -> DataFrame:
    """Validate gap rows; ``reject`` holds the first reason, NULL for usable rows."""
    step = tg.interval_ms(interval)
    symbol = F.upper(F.trim(F.coalesce("symbol", F.lit(""))))
    start, end = (F.trim(F.col(c)).try_cast("long") for c in ("from_ms", "to_ms"))
    reject = fx.first_reason(
        (F.coalesce(F.trim("interval"), F.lit("")) != interval, "interval"),
        (~symbol.rlike(SYMBOL_PATTERN), "symbol"),
        (start.isNull() | end.isNull(), "not_an_integer"),
        ((F.pmod(start, F.lit(step)) != 0) | (F.pmod(end, F.lit(step)) != 0) | (end <= start), "range"),
    )
    return rows.select(symbol.alias("symbol"), F.col("interval"), start.alias("from_ms"),
                       end.alias("to_ms"), reject.alias("reject"))
