"""Every registered query against its SQL twin, and the plans the design relies on."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import oracle_check
from candlemill.operators import gaps, rollup, versions, windows
from helpers import MIN

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
STREAMS = {n for n in QUERIES if n.endswith("_stream")} | {"fan_out", "stream_rollup"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sound_plan(df) -> None:
    """No nested-loop or Cartesian join, no Python in a batch plan."""
    plan = plan_of(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_query_matches_sql(spark, con, name):
    assert oracle_check.compare(spark, con, name, SF, QUERIES, ORACLES, sound_plan) is None


@pytest.mark.parametrize("name", ["kline_1d", "ratio_1d", "kline_gaps", "archive_align", "with_month", "gap_file_rows"])
def test_other_session_zone(spark, con, zone, name):
    assert oracle_check.compare(spark, con, name, SF, QUERIES, ORACLES) is None


def test_contract():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) >= 140


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def raw_table(spark):
    return spark.read.parquet(SF + "/events.parquet").selectExpr(
        "event_type AS symbol", "event_id * 60000 AS start_ms", "event_id AS end_ms", "value AS open", "value AS high",
        "value AS low", "value AS close", "value AS volume", "value AS quote_volume", "value AS taker_buy_volume",
        "value AS taker_buy_quote_volume", "user_id AS trades_count", "event_id AS version", "event_id AS ingest_seq")


def test_dedup_limits_before_the_shuffle(spark):
    plan = plan_of(versions.latest_bars(raw_table(spark)))
    below = plan.split("Exchange hashpartitioning(symbol")[1]
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in below


def test_colocated_fold_uses_one_exchange(spark):
    raw = raw_table(spark)
    one = plan_of(rollup.rollup_raw_klines(raw, "1h", bounded_copies=True))
    two = plan_of(rollup.rollup_raw_klines(raw, "1h"))
    assert one.count("Exchange hashpartitioning") == 1 and two.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in two


def test_gaps_scan_once_and_split_symbols(spark):
    rows = spark.read.parquet(SF + "/events.parquet").selectExpr("event_type AS symbol", "event_id * 60000 AS start_ms", "value")
    plan = plan_of(gaps.find_gaps(rows, MIN))
    assert plan.count("FileScan") == 1 and "value" not in plan.split("ReadSchema")[1]
    assert "hashpartitioning(symbol" in plan and "_chunk" in plan


@pytest.mark.parametrize("name", ["validate_compact", "window_inspection"])
def test_events_worth_nothing_make_no_faulty_window(spark, folder, name):
    """Served bars of events worth 0 are sound, and a bar whose price is 0 still isn't."""
    path = folder("events")
    events = spark.read.parquet(SF + "/events.parquet")
    events.withColumn("value", F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value"))).write.parquet(f"{path}/events.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/events.parquet/*.parquet')")
        assert oracle_check.compare(spark, con, name, path, QUERIES, ORACLES) is None
    free = spark.createDataFrame([("A", 0, "[60000,0.0,1.0,0.0,1.0,1.0,1.0,0.5,0.5,3]")], "symbol string, pos int, payload string")
    assert windows.validate_compact(free).first().fault == "non_positive_price"


def test_section_stream_reads_no_events_by_batch(spark, monkeypatch):
    """The universe that each batch joins is a small table, not a pass over the events."""
    from workload import streams

    seen = []

    def build(stream, universe, *_):
        seen.append((universe.count(), universe.inputFiles()))
        raise StopIteration

    monkeypatch.setattr(streams.jobs, "section_stream", build)
    with pytest.raises(StopIteration):
        QUERIES["section_stream"](spark, SF)
    assert seen[0][0] == 5 and not any("events.parquet" in f for f in seen[0][1])


@pytest.mark.parametrize("name", ["validate_compact", "window_inspection"])
def test_events_without_a_type(spark, folder, name):
    path = folder("events")
    events = spark.read.parquet(SF + "/events.parquet")
    events.withColumn("event_type", F.when(F.col("event_id") % 9 != 0, F.col("event_type"))).write.parquet(f"{path}/events.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/events.parquet/*.parquet')")
        assert oracle_check.compare(spark, con, name, path, QUERIES, ORACLES) is None
