"""Registry and stand-ins.

The given tables hold no bars, so each market table is derived from ``events``:
once with DataFrames, once as a SQL common table expression. Keys are epoch ms,
so no time zone reaches a result. Modulo terms below inject re-sends, faults and
holes; every row of ``events`` takes part.
"""

from __future__ import annotations

import functools
import re
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill import timegrid as tg
from candlemill.operators import rollup, versions
from candlemill.session import scratch_path
from candlemill.sources import facts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}

# The moment all reports look back from: the end of the data's month.
NOW = 1_706_659_200_000          # 2024-01-31 00:00 UTC
SPAN_FROM = 1_704_067_200_000    # 2024-01-01 00:00 UTC
DAY, HOUR, MINUTE, BAR = tg.DAY_MS, tg.HOUR_MS, tg.MINUTE_MS, tg.BAR_MS
STEPS = {"5m": BAR, "15m": 3 * BAR, "1h": HOUR, "4h": 4 * HOUR, "1d": DAY}


def query(sql: str | None = None, name: str | None = None):
    """Register a query, with its SQL twin when there is one."""

    def add(fn):
        key = name or fn.__name__

        @functools.wraps(fn)
        def run(spark, sf):
            shared_folder(spark)
            return fn(spark, sf)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_ctes(sql)
        return fn

    return add


def shared_folder(spark: SparkSession) -> None:
    """Name a folder for written tables where the session has none; only a session on one machine may go without."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def with_ctes(body: str) -> str:
    """Prefix the CTEs a statement mentions, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need(CTES[name])
                order.append(name)

    need(body)
    if not order:
        return body
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def crc_sql(text: str) -> str:
    """CRC-32 of ASCII text: each byte is mixed in, then followed by eight shifts (marked -1) through the reversed polynomial."""
    steps = f"""list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split({text}, ''),
        lambda ch: list_prepend(CAST(ascii(ch) AS BIGINT), CAST([-1, -1, -1, -1, -1, -1, -1, -1] AS BIGINT[])))))"""
    return f"xor(list_reduce({steps}, lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def round_sql(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def fresh(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


# --- stand-ins ----------------------------------------------------------------

def ticks(spark: SparkSession, sf: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.select(F.col("event_type").alias("symbol"), tg.epoch_ms(F.col("ts")).alias("t_ms"),
                     F.col("event_id").alias("seq"), F.col("user_id").alias("uid"),
                     F.col("value").alias("price"))


CTES["ticks"] = """
SELECT event_type AS symbol, epoch_us(ts) // 1000 AS t_ms, event_id AS seq, user_id AS uid, value AS price
FROM events"""


def bars_base(spark: SparkSession, sf: str) -> DataFrame:
    even = F.when(F.col("uid") % 2 == 0, F.col("price")).otherwise(0.0)
    start = tg.bucket(F.col("t_ms"), MINUTE).alias("start_ms")
    return (
        ticks(spark, sf).groupBy("symbol", start).agg(
            F.min_by("price", "seq").alias("open"), F.max("price").alias("high"),
            F.min("price").alias("low"), F.max_by("price", "seq").alias("close"),
            F.sum("price").alias("volume"), F.sum(F.col("price") * F.col("price")).alias("quote_volume"),
            F.sum(even).alias("taker_buy_volume"), F.sum(even * F.col("price")).alias("taker_buy_quote_volume"),
            F.count("*").alias("trades_count"), F.min("seq").alias("ingest_seq"))
        .withColumn("end_ms", F.col("start_ms") + (MINUTE - 1)))


CTES["bars_base"] = """
SELECT symbol, t_ms - t_ms % 60000 AS start_ms, t_ms - t_ms % 60000 + 59999 AS end_ms,
       arg_min(price, seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, seq) AS close,
       sum(price) AS volume, sum(price * price) AS quote_volume,
       sum(CASE WHEN uid % 2 = 0 THEN price ELSE 0 END) AS taker_buy_volume,
       sum(CASE WHEN uid % 2 = 0 THEN price * price ELSE 0 END) AS taker_buy_quote_volume,
       count(*) AS trades_count, min(seq) AS ingest_seq
FROM ticks GROUP BY 1, 2, 3"""


def bars_raw(spark: SparkSession, sf: str) -> DataFrame:
    """1m bars with re-sends: one that must win, one that must lose, one that wins a tie."""
    minute = F.col("start_ms") / MINUTE

    def sent(cond, version, factor, later):
        return F.when(cond, F.struct(F.lit(version).cast("long").alias("version"),
                                     F.lit(factor).alias("factor"),
                                     F.lit(later).cast("long").alias("later")))

    copies = F.array_compact(F.array(
        sent(F.lit(True), 1, 1.0, 0), sent(minute % 7 == 0, 2, 1.5, 1_000_000_000_000),
        sent(minute % 11 == 0, 0, 1.0, 2_000_000_000_000),
        sent(minute % 13 == 0, 1, 2.0, 3_000_000_000_000)))
    return bars_base(spark, sf).withColumn("_c", F.explode(copies)).select(
        *S.BAR_KEYS, "end_ms", *S.PRICES, (F.col("volume") * F.col("_c.factor")).alias("volume"),
        *S.VOLUMES[1:], "trades_count", F.col("_c.version").alias("version"),
        (F.col("ingest_seq") + F.col("_c.later")).alias("ingest_seq"))


_RESEND = """
SELECT symbol, start_ms, end_ms, open, high, low, close, volume * {factor} AS volume, quote_volume,
       taker_buy_volume, taker_buy_quote_volume, trades_count, CAST({version} AS BIGINT) AS version,
       ingest_seq + {later} AS ingest_seq FROM bars_base {where}"""
CTES["bars_raw"] = " UNION ALL ".join([
    _RESEND.format(factor="1.0", version=1, later=0, where=""),
    _RESEND.format(factor="1.5", version=2, later=1_000_000_000_000, where="WHERE start_ms // 60000 % 7 = 0"),
    _RESEND.format(factor="1.0", version=0, later=2_000_000_000_000, where="WHERE start_ms // 60000 % 11 = 0"),
    _RESEND.format(factor="2.0", version=1, later=3_000_000_000_000, where="WHERE start_ms // 60000 % 13 = 0"),
])


def bars(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_bars(bars_raw(spark, sf))


CTES["bars"] = """
SELECT * FROM bars_raw
QUALIFY row_number() OVER (PARTITION BY symbol, start_ms ORDER BY version DESC, ingest_seq DESC) = 1"""


def rollup_sql(step: int, source: str = "bars") -> str:
    return f"""
SELECT symbol, start_ms - start_ms % {step} AS start_ms, max(end_ms) AS end_ms,
       arg_min(open, {source}.start_ms) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, {source}.start_ms) AS close, sum(volume) AS volume,
       sum(quote_volume) AS quote_volume, sum(taker_buy_volume) AS taker_buy_volume,
       sum(taker_buy_quote_volume) AS taker_buy_quote_volume,
       CAST(sum(trades_count) AS BIGINT) AS trades_count
FROM {source} GROUP BY symbol, {source}.start_ms - {source}.start_ms % {step}"""


for _iv, _step in STEPS.items():
    CTES[f"bars_{_iv}"] = rollup_sql(_step)


def bars_at(spark: SparkSession, sf: str, interval: str) -> DataFrame:
    return rollup.rollup_klines(bars(spark, sf), interval)


def oi_raw(spark: SparkSession, sf: str) -> DataFrame:
    start = tg.bucket(F.col("t_ms"), BAR)
    rank = (F.lit(1) + F.col("uid") % 3).cast("int")
    return ticks(spark, sf).select(
        "symbol", start.alias("start_ms"), F.col("price").alias("sum_open_interest"),
        F.when(rank >= 2, start + BAR).otherwise(F.col("t_ms")).alias("snap_ms"),
        rank.alias("src_rank"), F.col("seq").alias("ingest_seq"))


CTES["oi_raw"] = """
SELECT symbol, t_ms - t_ms % 300000 AS start_ms, price AS sum_open_interest,
       CASE WHEN uid % 3 >= 1 THEN t_ms - t_ms % 300000 + 300000 ELSE t_ms END AS snap_ms,
       CAST(1 + uid % 3 AS INTEGER) AS src_rank, seq AS ingest_seq FROM ticks"""


def oi(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_snapshots(oi_raw(spark, sf))


CTES["oi"] = """
SELECT * FROM oi_raw
QUALIFY row_number() OVER (PARTITION BY symbol, start_ms ORDER BY src_rank DESC, ingest_seq DESC) = 1"""


def oi_off_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth row of the snapshots at its raw millisecond, as archive rows."""
    t = F.col("t_ms")
    return ticks(spark, sf).where((F.col("seq") % 5 == 0) & (t % BAR != 0)).select(
        "symbol", t.alias("start_ms"), F.col("price").alias("sum_open_interest"),
        (t + BAR).alias("snap_ms"), F.lit(3).alias("src_rank"), F.col("seq").alias("ingest_seq"))


CTES["oi_off"] = """
SELECT symbol, t_ms AS start_ms, price AS sum_open_interest, t_ms + 300000 AS snap_ms,
       3 AS src_rank, seq AS ingest_seq FROM ticks WHERE seq % 5 = 0 AND t_ms % 300000 <> 0"""

MEASURES = S.RATIOS


def ratio_raw(spark: SparkSession, sf: str) -> DataFrame:
    start = tg.bucket(F.col("t_ms"), BAR).alias("start_ms")
    cells = [F.max(F.when((F.col("uid") % 3 == k) & (F.col("seq") % 17 != 0), F.col("price"))).alias(c)
             for k, c in enumerate(MEASURES)]
    return ticks(spark, sf).groupBy("symbol", start).agg(
        *cells, F.max("seq").alias("ingest_seq"), F.min("uid").alias("_u")).select(
        *S.BAR_KEYS, *MEASURES, (F.col("start_ms") + BAR).alias("snap_ms"),
        (F.lit(2) + F.col("_u") % 2).cast("int").alias("src_rank"), "ingest_seq")


CTES["ratio_raw"] = f"""
SELECT symbol, t_ms - t_ms % 300000 AS start_ms,
       max(price) FILTER (WHERE uid % 3 = 0 AND seq % 17 <> 0) AS {MEASURES[0]},
       max(price) FILTER (WHERE uid % 3 = 1 AND seq % 17 <> 0) AS {MEASURES[1]},
       max(price) FILTER (WHERE uid % 3 = 2 AND seq % 17 <> 0) AS {MEASURES[2]},
       t_ms - t_ms % 300000 + 300000 AS snap_ms, CAST(2 + min(uid) % 2 AS INTEGER) AS src_rank,
       max(seq) AS ingest_seq
FROM ticks GROUP BY symbol, t_ms - t_ms % 300000"""


def ratios(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_snapshots(ratio_raw(spark, sf))


CTES["ratios"] = """
SELECT * FROM ratio_raw
QUALIFY row_number() OVER (PARTITION BY symbol, start_ms ORDER BY src_rank DESC, ingest_seq DESC) = 1"""


def kline_events(spark: SparkSession, sf: str) -> DataFrame:
    """One stream event per tick, quantities still text; every fifth one closes its bar."""
    text = F.col("price").cast("string")
    open_ms = tg.bucket(F.col("t_ms"), MINUTE)
    return ticks(spark, sf).select(
        "symbol", F.lit("1m").alias("interval"), open_ms.alias("open_ms"),
        (open_ms + (MINUTE - 1)).alias("close_ms"), *[text.alias(c) for c in S.EVENT_TEXT],
        F.col("uid").alias("trade_count"), (F.col("seq") % 5 == 0).alias("is_final"),
        F.col("t_ms").alias("arrival_ms"), "seq")


CTES["kline_events"] = """
SELECT symbol, '1m' AS interval, t_ms - t_ms % 60000 AS open_ms, t_ms - t_ms % 60000 + 59999 AS close_ms,
       price, uid AS trade_count, seq % 5 = 0 AS is_final, t_ms AS arrival_ms, seq FROM ticks"""


def guard_events(spark: SparkSession, sf: str) -> DataFrame:
    """Closed bars whose open times run up to four hours behind the arrival clock."""
    behind = F.col("t_ms") - (F.col("seq") % 5) * HOUR
    return ticks(spark, sf).select(
        "symbol", F.lit("1m").alias("interval"), tg.bucket(behind, MINUTE).alias("open_ms"),
        F.col("t_ms").alias("arrival_ms"), "seq", "price", "uid")


CTES["guard_events"] = """
SELECT symbol, '1m' AS interval,
       (t_ms - (seq % 5) * 3600000) - (t_ms - (seq % 5) * 3600000) % 60000 AS open_ms,
       t_ms AS arrival_ms, seq, price, uid FROM ticks"""

SECTION_TIMEOUT = 1_800_000


def closed_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Each tick reports its symbol's 1h bar; the first report of a symbol counts."""
    return ticks(spark, sf).select(
        F.lit("1h").alias("interval"), tg.bucket(F.col("t_ms"), HOUR).alias("open_ms"), "symbol",
        F.col("t_ms").alias("arrival_ms"), "seq")


CTES["closed_arrivals"] = """
SELECT '1h' AS interval, t_ms - t_ms % 3600000 AS open_ms, symbol, t_ms AS arrival_ms, seq FROM ticks"""


def universe(spark: SparkSession, sf: str) -> DataFrame:
    return ticks(spark, sf).select("symbol").distinct()


CTES["universe"] = "SELECT DISTINCT symbol FROM ticks"


def external_1h(spark: SparkSession, sf: str) -> DataFrame:
    """The 1h bars as an outside source would have them: some missing, some closes off."""
    hour = F.col("start_ms") / HOUR
    return bars_at(spark, sf, "1h").where(hour % 10 != 0).withColumn(
        "close", F.when(hour % 7 == 0, F.col("close") * 1.01).otherwise(F.col("close")))


CTES["external_1h"] = """
SELECT symbol, start_ms, end_ms, open, high, low,
       CASE WHEN start_ms // 3600000 % 7 = 0 THEN close * 1.01 ELSE close END AS close,
       volume, quote_volume, taker_buy_volume, taker_buy_quote_volume, trades_count
FROM bars_1h WHERE start_ms // 3600000 % 10 <> 0"""


def sections_1h(spark: SparkSession, sf: str) -> DataFrame:
    from candlemill.operators.sections import sections

    return sections(closed_arrivals(spark, sf), universe(spark, sf), SECTION_TIMEOUT)


CTES["sections_1h"] = f"""
SELECT interval, open_ms AS timestamp,
       CASE WHEN done IS NOT NULL THEN size ELSE seen END AS symbols_count,
       CASE WHEN done IS NOT NULL THEN 'complete' ELSE 'timeout' END AS reason,
       coalesce(done, deadline) AS published_ms
FROM (SELECT interval, open_ms, deadline, size,
             min(arrival_ms) FILTER (WHERE n = size AND arrival_ms <= deadline) AS done,
             count(*) FILTER (WHERE arrival_ms <= deadline) AS seen
      FROM (SELECT *, row_number() OVER (PARTITION BY interval, open_ms ORDER BY arrival_ms, symbol) AS n,
                   min(arrival_ms) OVER (PARTITION BY interval, open_ms) + {SECTION_TIMEOUT} AS deadline,
                   (SELECT count(*) FROM universe) AS size
            FROM (SELECT interval, open_ms, symbol, min(arrival_ms) AS arrival_ms
                  FROM closed_arrivals GROUP BY 1, 2, 3))
      GROUP BY 1, 2, 3, 4)"""


def gaps_5m(spark: SparkSession, sf: str) -> DataFrame:
    from candlemill.operators.gaps import find_gaps

    return find_gaps(bars_at(spark, sf, "5m"), BAR)


def gaps_sql(source: str, step: int) -> str:
    return f"""
SELECT symbol, prev + {step} AS from_ms, start_ms AS to_ms, (start_ms - prev) // {step} - 1 AS missing_count
FROM (SELECT symbol, start_ms, lag(start_ms) OVER (PARTITION BY symbol ORDER BY start_ms) AS prev
      FROM {source})
WHERE start_ms - prev > {step}"""


CTES["gaps_5m"] = gaps_sql("bars_5m", BAR)


def table_of(df: DataFrame, label: str) -> str:
    """Write rows as a month-partitioned table in scratch space; returns its path."""
    path = fresh(df.sparkSession, label)
    facts.append_facts(df, path)
    return path


# --- an open-interest table with its rollups, as a repair leaves them ------------------------------------------------

_LEVELS = {"1h": HOUR, "1d": DAY}


def rollup_tables(raw: DataFrame, label: str) -> dict[str, str]:
    """Rollups of the table as it is before a repair; returns their paths."""
    base, out = versions.latest_snapshots(raw), {}
    for interval in _LEVELS:
        out[interval] = fresh(raw.sparkSession, f"{label}-{interval}")
        facts.append_facts(rollup.rollup_oi(base, interval).withColumn("version", F.lit(1).cast("long")), out[interval])
    return out


def table_and_rollups(spark: SparkSession, path: str, levels: dict[str, str]) -> DataFrame:
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in (("snap_ms", "long"), ("src_rank", "int"), ("ingest_seq", "long"), ("samples", "long"))}
    out = facts.read_facts(spark, path, S.OI_5M).select(
        F.lit("5m").alias("level"), *S.BAR_KEYS, F.col("sum_open_interest").alias("value"), "snap_ms", "src_rank", "ingest_seq", nothing["samples"])
    for interval, target in levels.items():
        out = out.unionByName(spark.read.parquet(target).select(
            F.lit(interval).alias("level"), *S.BAR_KEYS, F.col("close").alias("value"), nothing["snap_ms"], nothing["src_rank"], nothing["ingest_seq"], "samples"))
    return out


def table_and_rollups_sql(source: str) -> str:
    folds = "".join(f"""
UNION ALL SELECT '{iv}', symbol, start_ms - start_ms % {ms}, arg_max(sum_open_interest, start_ms), NULL, NULL, NULL, count(*)
FROM (SELECT symbol, start_ms, sum_open_interest FROM {source} QUALIFY row_number() OVER (
        PARTITION BY symbol, start_ms ORDER BY src_rank DESC, ingest_seq DESC) = 1) GROUP BY symbol, start_ms - start_ms % {ms}""" for iv, ms in _LEVELS.items())
    return f"""SELECT '5m' AS level, symbol, start_ms, sum_open_interest AS value, snap_ms, CAST(src_rank AS INTEGER) AS src_rank, ingest_seq, CAST(NULL AS BIGINT) AS samples
FROM {source}{folds}"""
