"""Deduplication, deletion, re-folding and one-time corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlemill import schemas as S
from candlemill.operators import rollup, versions
from candlemill.plans import refresh, repair
from candlemill.sources import facts
from workload.base import (
    BAR, CTES, DAY, HOUR, NOW, SPAN_FROM, bars, bars_raw, fresh, oi, oi_raw, query, rollup_tables, round_sql, rounded,
    table_and_rollups, table_and_rollups_sql, table_of,
)

_BAR_COLUMNS = f"symbol, start_ms, version, ingest_seq, close, {round_sql('volume')}"


@query(f"SELECT {_BAR_COLUMNS} FROM bars")
def final_dedup(spark, sf):
    return rounded(bars(spark, sf).select(*S.BAR_KEYS, "version", "ingest_seq", "close", "volume"), "volume")


@query("SELECT symbol, start_ms, sum_open_interest, src_rank, ingest_seq FROM oi")
def source_precedence(spark, sf):
    return oi(spark, sf).select(*S.BAR_KEYS, "sum_open_interest", "src_rank", "ingest_seq")


@query(f"SELECT {_BAR_COLUMNS} FROM bars")
def compacted(spark, sf):
    """A raw table after its months were compacted: only the winning rows are left."""
    path = table_of(bars_raw(spark, sf), "compact")
    facts.compact(spark, path, S.BARS_1M, S.BAR_KEYS, ["version", "ingest_seq"])
    rows = facts.read_facts(spark, path, S.BARS_1M)
    return rounded(rows.select(*S.BAR_KEYS, "version", "ingest_seq", "close", "volume"), "volume")


@query(f"""SELECT symbol, start_ms, src_rank, ingest_seq FROM oi_raw
           WHERE NOT (src_rank = 3 AND snap_ms >= {SPAN_FROM + 10 * DAY})""")
def deleted_where(spark, sf):
    path = table_of(oi_raw(spark, sf), "delete")
    pred = (F.col("src_rank") == 3) & (F.col("snap_ms") >= SPAN_FROM + 10 * DAY)
    facts.delete_where(spark, path, S.OI_5M, pred)
    return facts.read_facts(spark, path, S.OI_5M).select(*S.BAR_KEYS, "src_rank", "ingest_seq")


@query(f"""SELECT DISTINCT symbol, start_ms - start_ms % 3600000 AS start_ms FROM oi
           WHERE start_ms >= {SPAN_FROM + 2 * DAY} AND start_ms < {SPAN_FROM + 25 * DAY}
             AND (symbol, start_ms - start_ms % 3600000) NOT IN (
               SELECT (symbol, start_ms - start_ms % 3600000) FROM oi_raw WHERE src_rank < 3)""")
def prune_orphans(spark, sf):
    """1h buckets whose rows were all archive rows, once the archive rows are gone."""
    raw = oi_raw(spark, sf)
    old = rollup.rollup_oi(versions.latest_snapshots(raw), "1h")
    fresh_fold = rollup.rollup_oi(versions.latest_snapshots(raw.where(F.col("src_rank") < 3)), "1h")
    gone = versions.prune_orphans(old, fresh_fold, SPAN_FROM + 2 * DAY, SPAN_FROM + 25 * DAY)
    return gone.select(*S.BAR_KEYS)


@query(f"SELECT symbol, start_ms, close, {round_sql('volume')}, trades_count, CAST(5 AS BIGINT) AS version FROM bars_4h")
def rebuilt_rollup(spark, sf):
    """A rollup table dropped and recomputed; an earlier row set leaves no trace."""
    base, path = bars(spark, sf), fresh(spark, "rebuild")
    for source, version in ((base.where("trades_count > 1"), 4), (base, 5)):
        refresh.rebuild_rollups(source, {"4h": (rollup.rollup_klines, path)}, version)
    rows = facts.read_facts(spark, path, S.BARS)
    return rounded(rows.select(*S.BAR_KEYS, "close", "volume", "trades_count", "version"), "volume")


@query("""SELECT symbol, start_ms - start_ms % 3600000 AS start_ms, count(*) AS samples,
                 arg_max(sum_open_interest, oi.start_ms) AS close FROM oi
          GROUP BY symbol, oi.start_ms - oi.start_ms % 3600000""")
def refold(spark, sf):
    """January re-folded in place over a table whose rows went wrong."""
    base, path = oi(spark, sf), fresh(spark, "refold")
    wrong = rollup.rollup_oi(base, "1h").withColumn("samples", F.lit(0).cast("long")).withColumn(
        "version", F.lit(1).cast("long"))
    facts.append_facts(wrong, path)
    january, february = SPAN_FROM, SPAN_FROM + 31 * DAY
    refresh.apply_refold(base, rollup.rollup_oi, path, "1h", january, february, 2)
    rows = spark.read.schema(wrong.schema).parquet(path)
    return rows.select(*S.BAR_KEYS, "samples", "close")


CTES["archive_moved"] = """
SELECT symbol, start_ms + 300000 AS start_ms, sum_open_interest, snap_ms + 300000 AS snap_ms, src_rank, ingest_seq
FROM oi_raw WHERE src_rank = 3
QUALIFY row_number() OVER (PARTITION BY symbol, start_ms ORDER BY ingest_seq DESC) = 1"""


CTES["archive_shifted"] = """
SELECT * FROM archive_moved
UNION ALL SELECT symbol, start_ms, sum_open_interest, snap_ms, src_rank, ingest_seq FROM oi_raw WHERE src_rank < 3"""


@query(table_and_rollups_sql("archive_shifted"))
def archive_shift_repair(spark, sf):
    """All archive rows moved one bar later, once, and the rollups folded anew; a second run moves nothing."""
    raw = oi_raw(spark, sf)
    path, log, levels = table_of(raw, "shift"), fresh(spark, "shift-log"), rollup_tables(raw, "shift")
    earliest = raw.where(F.col("src_rank") == 3).agg(F.min("start_ms")).first()[0]
    for k in range(2):
        repair.repair_archive_shift(spark, path, log, earliest + BAR, NOW + k, rollup_paths=levels)
    return table_and_rollups(spark, path, levels)


@query(f"""SELECT 'sound' AS name, count(*) AS bars, '' AS faults FROM oi
           UNION ALL SELECT 'short', count(*), 'src_rank:int:none' FROM oi
           UNION ALL SELECT 'mixed', count(*), 'sum_open_interest:double:string;snap_ms:bigint:string' FROM oi""")
def layout_check(spark, sf):
    """The preflight of the table jobs, on a sound table, one that lacks a column and one with columns of other types."""
    names = [f.name for f in S.OI_5M.fields]
    rows = oi(spark, sf).select(*names)
    made = {"sound": rows, "short": rows.drop("src_rank"), "mixed": rows.withColumns({
        "snap_ms": F.col("snap_ms").cast("string"), "sum_open_interest": F.col("sum_open_interest").cast("string")})}
    out = None
    for name, df in made.items():
        stored = spark.read.parquet(table_of(df, f"layout-{name}"))
        faults = ";".join(f"{c}:{want}:{found or 'none'}" for c, want, found in facts.layout_faults(stored.schema, S.OI_5M))
        told = stored.agg(F.lit(name).alias("name"), F.count("*").alias("bars"), F.lit(faults).alias("faults"))
        out = told if out is None else out.union(told)
    return out


@query("""SELECT symbol, day_ms FROM (SELECT DISTINCT symbol, start_ms - start_ms % 86400000 AS day_ms FROM oi)
          WHERE (symbol, day_ms) NOT IN (
            SELECT (symbol, start_ms - start_ms % 86400000) FROM bars WHERE trades_count > 1)""")
def pending_work(spark, sf):
    """Symbol-days with snapshots that no day with a multi-trade bar has marked as done."""
    day = (F.col("start_ms") - F.col("start_ms") % DAY).alias("day_ms")
    todo = oi(spark, sf).select("symbol", day).distinct()
    done = bars(spark, sf).where("trades_count > 1").select("symbol", day).distinct()
    return versions.pending_work(todo, done, ["symbol", "day_ms"])


@query("""SELECT symbol, start_ms, arg_min(page_no, page_no) AS page_no FROM (
            SELECT symbol, start_ms, start_ms // 3600000 AS page_no FROM bars
            UNION ALL SELECT symbol, start_ms, start_ms // 3600000 + 1 FROM bars WHERE start_ms % 3600000 >= 3000000)
          WHERE start_ms >= """ + f"{SPAN_FROM + DAY} AND start_ms < {SPAN_FROM + 20 * DAY} GROUP BY 1, 2")
def dedup_pages(spark, sf):
    """Hourly pages that overlap by ten minutes, concatenated and trimmed."""
    page = ((F.col("start_ms") - F.col("start_ms") % HOUR) / HOUR).cast("long")
    rows = bars(spark, sf)
    again = rows.where(F.col("start_ms") % HOUR >= 3_000_000)
    pages = rows.select(*S.BAR_KEYS, page.alias("page_no")).unionByName(
        again.select(*S.BAR_KEYS, (page + 1).alias("page_no")))
    return versions.dedup_pages(pages, SPAN_FROM + DAY, SPAN_FROM + 20 * DAY)
