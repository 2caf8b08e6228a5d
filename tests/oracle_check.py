"""Compare registered queries with their SQL twins: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, sf_dir, queries, oracles, check_plan=None) -> str | None:
    """None if equal, else what differs."""
    df = queries[name](spark, sf_dir)
    if check_plan is not None:
        check_plan(df)
    got = [tuple(r) for r in df.collect()]
    if name not in oracles:
        return None if got else "no rows"
    cur = con.execute(oracles[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    a, b = table_rows(df.columns, got), table_rows(columns, want)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"


def local_session(cores: int = 8, zone: str = "UTC"):
    import tempfile

    from candlemill.session import build_session

    extra = {"spark.master": f"local[{cores}]", "spark.sql.shuffle.partitions": str(cores),
             "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.sql.session.timeZone": zone}
    if not os.environ.get("SPARK_CHECKPOINT_DIR_SET"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = build_session("candlemill-test", **extra)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "" if name in oracles else " (rows only)"
        print(f"{'ok ' if problem is None else 'BAD'} {name}{kind} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
