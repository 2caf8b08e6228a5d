"""Bars as bits: 60 neighbouring bars of a symbol are one number, so series are compared word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill import timegrid as tg

WORD = 60  # bars per presence word: an hour of minutes, and it fits a long
_PAGE = 1_440  # words of a range that one array holds


def _shifted(one: int | Column, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(one).cast("long"), by.cast("int"))


def bar_words(bars: DataFrame, step: int) -> DataFrame:
    """(symbol, word, bits) of the bars whose open is a multiple of ``step``; copies fold before the shuffle."""
    slot = tg.whole(F.col("start_ms"), step)
    return (
        bars.where(F.pmod("start_ms", F.lit(step)) == 0)
        .groupBy("symbol", tg.whole(slot, WORD).alias("word"))
        .agg(F.bit_or(_shifted(1, F.pmod(slot, F.lit(WORD)))).alias("bits")))


def range_words(ranges: DataFrame, step: int) -> DataFrame:
    """(symbol, word, bits) of all bars on the grid inside the ranges, which may overlap. A range costs its words."""
    first = tg.whole(F.col("from_ms") + (step - 1), step)
    behind = tg.whole(F.col("to_ms") + (step - 1), step)  # the first slot that isn't inside any more
    slots = ranges.select("symbol", first.alias("_a"), behind.alias("_b")).where("_b > _a")
    pages = slots.select("symbol", "_a", "_b", F.explode(F.sequence(
        tg.whole(tg.whole(F.col("_a"), WORD), _PAGE), tg.whole(tg.whole(F.col("_b") - 1, WORD), _PAGE))).alias("_page"))
    low = F.greatest(tg.whole(F.col("_a"), WORD), F.col("_page") * _PAGE)
    high = F.least(tg.whole(F.col("_b") - 1, WORD), F.col("_page") * _PAGE + (_PAGE - 1))
    words = pages.select("symbol", "_a", "_b", F.explode(F.sequence(low, high)).alias("word"))
    start = F.col("word") * WORD
    upto, since = F.least(F.col("_b") - start, F.lit(WORD)), F.greatest(F.col("_a") - start, F.lit(0))
    return words.select("symbol", "word", (_shifted(1, upto) - _shifted(1, since)).alias("bits")).groupBy("symbol", "word").agg(F.bit_or("bits").alias("bits"))


def bit_runs(words: DataFrame, step: int) -> DataFrame:
    """(symbol, head, tail): the first and last open of every run of set bits inside a word."""
    bits = F.col("bits")
    opening = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    closing = bits.bitwiseAND(F.bitwise_not(F.shiftright(bits, 1)))
    places = F.sequence(F.lit(0), F.lit(WORD - 1))

    def set_places(mask):
        return F.filter(places, lambda i: F.getbit(mask, i) == 1)

    # the n-th opening bit and the n-th closing bit bound the n-th run of a word
    runs = F.explode(F.arrays_zip(set_places(opening).alias("a"), set_places(closing).alias("b")))
    first = F.col("word") * WORD
    return words.select("symbol", first.alias("first"), runs.alias("r")).select(
        "symbol", ((F.col("first") + F.col("r.a")) * step).alias("head"),
        ((F.col("first") + F.col("r.b")) * step).alias("tail"))


def compared(wanted: DataFrame, *others: DataFrame) -> DataFrame:
    """(symbol, word, bits, bits_1, ...): words of the first with those of the others, 0 where they have none."""
    out = wanted
    for k, other in enumerate(others, 1):
        out = out.join(other.select("symbol", "word", F.col("bits").alias(f"bits_{k}")), ["symbol", "word"], "left")
    return out.fillna(0)


def without_bits(a: Column, b: Column) -> Column:
    return a.bitwiseAND(F.bitwise_not(b))
