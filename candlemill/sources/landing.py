"""Exchange responses, stream frames and archive files to typed rows.

Responses are landed as text by whatever fetches them; each function takes that
text as a column named ``body`` and parses it inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.functions import columns as fx
from candlemill.operators import snap

# Positions in a REST bar array.
REST_TEXT = {"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "quote_volume": 7,
             "taker_buy_volume": 9, "taker_buy_quote_volume": 10}
REST_WHOLE = {"start_ms": 0, "end_ms": 6, "trades_count": 8}
REST_MIN_LENGTH = 11

# Keys of a stream frame's bar object. Some differ only by case.
FRAME_TEXT = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v",
              "quote_volume": "q", "taker_buy_volume": "V", "taker_buy_quote_volume": "Q"}


def parse_rest_klines(pages: DataFrame) -> DataFrame:
    """REST pages (``body`` = array of bar arrays) to bars; short arrays are skipped.

    ``bad_field`` names the first quantity that does not parse.
    """
    kept = [c for c in pages.columns if c != "body"]
    rows = pages.select(*kept, F.explode(F.from_json("body", "array<array<string>>")).alias("_k"))
    rows = rows.where(F.size("_k") >= REST_MIN_LENGTH)

    def cell(i: int) -> Column:
        return F.get(F.col("_k"), F.lit(i))

    whole = {name: cell(i).try_cast("long") for name, i in REST_WHOLE.items()}
    number = {name: fx.number(cell(i)) for name, i in REST_TEXT.items()}
    bad = fx.first_reason(
        (whole["start_ms"].isNull(), "start_ms"), (whole["end_ms"].isNull(), "end_ms"),
        *[(value.isNull(), name) for name, value in number.items()])
    return rows.select(
        *kept, whole["start_ms"].alias("start_ms"), whole["end_ms"].alias("end_ms"),
        *[number[c].alias(c) for c in S.PRICES + S.VOLUMES],
        F.greatest(F.coalesce(whole["trades_count"], F.lit(0)), F.lit(0)).alias("trades_count"),
        bad.alias("bad_field"))


def decode_kline_frames(frames: DataFrame) -> DataFrame:
    """Stream frames, wrapped in ``data`` or bare, to events with text quantities.

    Frames without a bar object, symbol or interval are dropped. Some keys differ
    only by case, which struct fields cannot; ``json_tuple`` tells them apart and
    parses the object once for all of them.
    """
    kept = [c for c in frames.columns if c != "body"]
    outer = F.from_json("body", "struct<data: struct<k: string>, k: string>")
    rows = frames.select(*kept, outer.alias("_f")).select(
        *kept, F.coalesce("_f.data.k", "_f.k").alias("_k")).where(F.col("_k").isNotNull())
    keys = ["s", "i", "t", "T", "n", "x", *FRAME_TEXT.values()]
    names = ["symbol", "interval", "_open", "_close", "_count", "_final", *FRAME_TEXT]
    fields = rows.select(*kept, F.json_tuple("_k", *keys).alias(*names))
    return fields.where(
        (F.coalesce("symbol", F.lit("")) != "") & (F.coalesce("interval", F.lit("")) != "")
    ).select(
        "symbol", "interval", F.col("_open").try_cast("long").alias("open_ms"),
        F.col("_close").try_cast("long").alias("close_ms"), *S.EVENT_TEXT,
        F.coalesce(F.col("_count").try_cast("long"), F.lit(0)).alias("trade_count"),
        F.coalesce(F.col("_final") == "true", F.lit(False)).alias("is_final"), *kept)


def _history_items(responses: DataFrame, value_key: str) -> DataFrame:
    kept = [c for c in responses.columns if c != "body"]
    schema = f"array<struct<{value_key}: string, timestamp: string>>"
    items = responses.select(*kept, F.explode(F.from_json("body", schema)).alias("_i"))
    return items.select(
        *kept, F.col("_i.timestamp").try_cast("long").alias("label_ms"),
        fx.number(F.col(f"_i.{value_key}")).alias("value"))


def parse_oi_hist(responses: DataFrame) -> DataFrame:
    """Open-interest history items; an unreadable value or time drops the item."""
    items = _history_items(responses, "sumOpenInterest")
    return items.where(F.col("value").isNotNull() & (F.col("label_ms") > 0))


def parse_oi_snapshot(responses: DataFrame) -> DataFrame:
    """Live open-interest answers; malformed ones are dropped."""
    body = F.from_json("body", "struct<openInterest: string, time: string>")
    kept = [c for c in responses.columns if c != "body"]
    rows = responses.withColumn("_b", body).select(
        *kept, fx.number(F.col("_b.openInterest")).alias("sum_open_interest"),
        F.col("_b.time").try_cast("long").alias("snap_ms"))
    return rows.where(F.col("sum_open_interest").isNotNull() & (F.col("snap_ms") > 0))


def parse_ratio_hist(responses: DataFrame) -> DataFrame:
    """Ratio history items as ``symbol, measure, label_ms, ratio``.

    ``endpoint`` says which measure a response carries; NaN, infinite, negative
    and unreadable values drop the item.
    """
    measures = F.create_map(*[F.lit(x) for pair in S.RATIO_KINDS.items() for x in pair])
    items = _history_items(responses.withColumn("measure", measures[F.col("endpoint")]),
                           "longShortRatio")
    sound = fx.finite(F.col("value")) & (F.col("value") >= 0) & (F.col("label_ms") > 0)
    return items.where(sound & F.col("measure").isNotNull()).select(
        "symbol", "measure", "label_ms", F.col("value").alias("ratio"))


def build_universe(metadata: DataFrame, quotes: list[str], contract_type: str = "PERPETUAL",
                   status: str = "TRADING") -> DataFrame:
    """Symbols of the exchange metadata that trade in the wanted contracts, sorted."""
    schema = ("struct<symbols: array<struct<symbol: string, contractType: string, "
              "status: string, quoteAsset: string>>>")
    listed = metadata.select(F.inline(F.from_json("body", schema)["symbols"]))
    return (
        listed.where(F.col("quoteAsset").isin(quotes) & (F.col("contractType") == contract_type)
                     & (F.col("status") == status))
        .select("symbol").distinct().orderBy("symbol"))


def _archive_ratio(text: Column) -> Column:
    value = fx.number(F.trim(text))
    return F.when(fx.finite(value) & (value >= 0), value)


def type_archive_rows(rows: DataFrame) -> DataFrame:
    """Archive text cells to typed columns; an empty or bad ratio becomes NULL."""
    strict = F.col("create_time").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    created = F.when(strict, F.col("create_time").try_cast("timestamp_ntz"))
    return rows.withColumns({
        **{c: _archive_ratio(F.col(c)) for c in S.RATIOS},
        "create_ms": tg.epoch_ms(created),
    })


def read_archive(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Daily archive files; the file date comes from the name, ``line_no`` keeps line order."""
    name = F.col("_metadata.file_name")
    day = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})\.csv", 1).try_cast("date")
    rows = spark.read.schema(S.ARCHIVE_CSV).option("header", True).csv(paths)
    return rows.select(
        "*", (F.unix_date(day).cast("long") * tg.DAY_MS).alias("file_day_ms"),
        F.monotonically_increasing_id().alias("line_no"))


def import_archive(rows: DataFrame) -> DataFrame:
    """Typed, aligned archive rows with a ``fault`` marker for those not to store."""
    return snap.archive_align(type_archive_rows(rows))


def event_stream(spark: SparkSession, path: str, schema=S.EVENT, fmt: str = "parquet",
                 max_files: int | None = None) -> DataFrame:
    """Unbounded source of events from files landing under ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
