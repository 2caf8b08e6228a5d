"""What the operators share: shared-folder tables, shipping of task code, connected components."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from candlemill.session import materialize


def shipped(module: str) -> None:
    """Send a module's functions to executors by value: those need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


shipped(__name__)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table in the shared folder: lineage ends there and a lost executor costs nothing."""
    return materialize(df, label)


def by_batch(df: DataFrame, make: Callable[[], Callable], schema: str, *columns: str) -> DataFrame:
    """Map rows batch by batch. ``make`` runs once a task and returns a function from lists to a list of lists.

    Text columns arrive as ``bytes`` or None and never as a part; the function gets one list for each of ``columns``
    and returns one list for each field of ``schema``. Batches are cut again by size, so that a batch of very long
    texts doesn't fill a worker's memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))
    kinds = dict(df.dtypes)
    taken = df.select(*(F.col(f"`{c}`").cast("binary").alias(c) if kinds[c] == "string" else F.col(f"`{c}`") for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            pieces = max(1, min(batch.num_rows, -(-batch.nbytes // 8_000_000)))
            rows = max(1, -(-batch.num_rows // pieces))
            for at in range(0, batch.num_rows, rows):
                made = step(*(c.to_pylist() for c in batch.slice(at, rows).columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, out)], schema=out)
                del made
            del batch
            pa.default_memory_pool().release_unused()  # a worker stays; what it holds adds up with the next ones

    return taken.mapInArrow(run, schema)


def versioned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds doc_id as a long and ``version``, a hash of the text; together they name a document even if an id repeats."""
    return docs.withColumns({"doc_id": F.col(f"`{id_col}`").cast("long"), "version": F.xxhash64(F.col(f"`{text_col}`"))})


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents that ``gone`` (doc_id, version) doesn't name; all rows of an id and text share their fate."""
    d, v = free(docs, "gone_doc", "gone_version")
    named = gone.select(F.col("doc_id").alias(d), F.col("version").alias(v)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(v))
    return docs.join(named, same, "left_anti")


def first_by_hash(rows: DataFrame, group: str, n: int) -> tuple[DataFrame, dict]:
    """At most ``n`` rows (doc_id, group, rank) of each group, those first by a hash of the id; and the groups' sizes.

    Of a large group only the share of hashes that holds about 2 n rows is ranked, so no group fills a task. The sizes,
    one row for each group, come to the driver.
    """
    sizes = {r[group]: r["n"] for r in rows.groupBy(group).agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for value, size in sizes.items():
        if size > 2 * n:
            share = F.when(F.col(group) == F.lit(value), 2 * n / size).otherwise(share)
    early = rows.where(F.xxhash64("doc_id") / F.lit(2.0 ** 64) + 0.5 <= share)
    order = Window.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id")
    return early.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n), sizes


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n positions the least position that the links i-j reach."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], least)
        np.minimum.at(label, label[j], least)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (a, b, both long); the component is its least node.

    Each round lets a node follow the neighbour, or itself, that comes first in an order drawn anew for the round, and
    contracts the graph by that; a constant share of the nodes goes away each round, whatever the shape. Each round is
    written, so the plan stays short. Hubs are safe: minima are pre-aggregated, and both sides of each join are plain
    shuffles, which adaptive execution splits. An empty edge table gives an empty result.
    """
    live = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)
    follows: list[DataFrame] = []
    while not live.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(follows))), F.col(c).alias("node"))  # noqa: B023, E731
        both = live.select("a", "b").unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(rank("b")).alias("first"))
        follow = stored(least.select(F.col("a").alias("node"), F.least(F.col("first"), rank("a"))["node"].alias("root")), label)
        follows.append(follow)
        left = follow.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = follow.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = live.join(left, "a").join(right, "b").where("ra <> rb")
        live = stored(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), label)
    if not follows:
        return live.selectExpr("a AS node", "a AS component")
    roots = follows[-1]
    for follow in reversed(follows[:-1]):
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("later"))
        roots = follow.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    roots = stored(roots, label)
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")


def prefix_sums(rows: DataFrame, group: str, order: list[str], value: str, label: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` over the earlier rows of the group, and ``total``, that over all of it.

    Rows are sorted by ranges of (group, order), so a large group lies in many tasks; each sums up its own rows, and only
    a row for each task and group is summed across tasks. Rows that are equal in all of ``order`` may come in any
    order among themselves. ``value`` is a long that is never null. The columns ``part`` and ``before`` must be free.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructType

    spread = rows.withColumn("before", F.rand(7))  # equal rows aren't bound to one task
    dealt = spread.repartitionByRange(group, *order, "before").sortWithinPartitions(group, *order, "before").drop("before")
    schema = StructType([*rows.schema.fields]).add("before", LongType()).add("part", LongType())
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, last, carry = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g, n = batch.column(group), batch.num_rows
            a, b = g.slice(1), g.slice(0, n - 1)
            differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[True], differ])
            v = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            ahead = np.cumsum(v) - v
            first = np.flatnonzero(starts)
            base = ahead[first]
            if last is not None and last[0] == g[0].as_py():
                base[0] -= carry
            before = ahead - base[np.cumsum(starts) - 1]
            last, carry = (g[n - 1].as_py(),), int(before[-1] + v[-1])
            columns = [*batch.columns, pa.array(before), pa.array(np.full(n, part))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    local = stored(dealt.mapInArrow(run, schema), label)
    parts = local.groupBy(group, "part").agg(F.sum(value).alias("n"))
    earlier = Window.partitionBy(group).orderBy("part")
    g, p, ahead = free(local, "sum_group", "sum_part", "sum_ahead")
    sums = parts.select(F.col(group).alias(g), F.col("part").alias(p), (F.sum("n").over(earlier) - F.col("n")).alias(ahead),
                        F.sum("n").over(Window.partitionBy(group)).alias("total"))
    placed = local.join(sums, F.col(group).eqNullSafe(F.col(g)) & (F.col("part") == F.col(p)))
    return placed.withColumn("before", F.col("before") + F.col(ahead)).drop(g, p, "part", ahead)
