"""Prefix trie of conversations: a count-min sketch tells which prefixes can be shared, only those are grouped."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from candlemill.llm.common import prefix_sums, shipped, stored

shipped(__name__)

ROWS = 3  # independent rows of the sketch
BLOCK = 4096  # cells that travel together
CHUNK = 1024  # turns of a conversation that one window goes through
PIECE = 256  # ids in one row on their way to a digest


def digested(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, t1, t2, bytes, total): every turn's place from 1, its 128-bit digest and its text's length in UTF-8.

    Turns are in the order of ``turn``, null first, then of their digests. Texts stay where they are read: only digests
    are sorted and shuffled. Rows without a conversation's id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, F.length(role), role).alias("t2"),
        F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("one"))
    placed = prefix_sums(rows, "conv_id", ["turn", "t1", "t2"], "one", "trie-turns")
    return stored(placed.select("conv_id", (F.col("before") + 1).alias("pos"), "t1", "t2", "bytes", "total"), "trie-placed")


def whole(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) as ``trie`` takes them, of conversations as they are."""
    heads = placed.where("pos = 1").select("conv_id", F.col("total").alias("length"))
    return heads, placed.withColumnRenamed("total", "length")


def spliced(placed: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) of which each begins like the first of its ``every`` neighbours by id.

    Conversation c gets the first h turns of conversation c - c % every, h = crc32(c) % most, and then its own after its
    first h. A conversation shares at most ``most`` - 1 turns with at most ``every`` others, so no key grows.
    """
    convs = placed.where("pos = 1").select(
        "conv_id", "total", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = convs.where("conv_id = base").select("base", F.col("total").alias("base_total"))
    given = F.least("h", F.coalesce("base_total", F.lit(0)))
    convs = stored(convs.join(bases, "base", "left").select("conv_id", "base", "h", given.alias("given"),
                   (given + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length")), "trie-spliced")
    heads = placed.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "bytes")
    first = heads.join(convs, "base").where("pos <= h").select("conv_id", "pos", "t1", "t2", "bytes", "length")
    own = placed.join(convs, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "t1", "t2", "bytes", "length")
    return convs.select("conv_id", "length"), first.unionAll(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, bytes, length): each turn with the digests of the prefix it ends and of the one before.

    A prefix's digest is the exclusive or of its turns' digests, each mixed with its place. So long conversations
    are digested chunk by chunk, and a chunk needs one row from each of those before it.
    """
    mixed = {"p1": F.xxhash64("pos", "t1", "t2"), "p2": F.xxhash64("t2", F.lit(17), "pos", "t1")}
    rows = turns.withColumns({"m1": mixed["p1"], "m2": mixed["p2"], "chunk": F.expr(f"(pos - 1) div {CHUNK}")})
    inside = Window.partitionBy("conv_id", "chunk").orderBy("pos")
    local = rows.withColumns({"p1": F.bit_xor("m1").over(inside), "p2": F.bit_xor("m2").over(inside)})
    sums = rows.where(F.col("length") > CHUNK).groupBy("conv_id", "chunk").agg(F.bit_xor("m1").alias("s1"), F.bit_xor("m2").alias("s2"))
    ahead = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "chunk", F.bit_xor("s1").over(ahead).alias("c1"), F.bit_xor("s2").over(ahead).alias("c2"))
    joined = local.join(carried, ["conv_id", "chunk"], "left")
    full = {f"p{k}": F.col(f"p{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0).cast("long"))) for k in (1, 2)}
    return joined.withColumns(full).select(
        "conv_id", F.col("pos").alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(F.col("m1")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("m2")).alias("q2"), "bytes", "length")


def cells(p1: np.ndarray, p2: np.ndarray, bits: int) -> list[np.ndarray]:
    """A digest's cell in each row of the sketch."""
    a, b = p1.view(np.uint64), p2.view(np.uint64)
    return [((a + np.uint64(2 * k + 1) * b) >> np.uint64(64 - bits)).astype(np.int64) for k in range(ROWS)]


def sketched(rows: DataFrame, bits: int) -> list[np.ndarray]:
    """A count-min sketch of the prefixes (p1, p2) with 2^``bits`` cells in a row, as far as it tells one from more.

    A task counts up to two in each cell and sends on its blocks of cells that aren't empty, two bits a cell; blocks are
    added up in Spark. What comes back is one bit a cell, whether it counts two or more: ROWS * 2^bits / 8 bytes.
    """
    size = 2 ** bits
    block = min(BLOCK, size)

    def count(batches):
        seen = np.zeros((ROWS, size), np.uint8)
        for batch in batches:
            for k, at in enumerate(cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)):
                at, n = np.unique(at, return_counts=True)
                seen[k, at] = np.minimum(2, seen[k, at] + np.minimum(2, n))
        flat = seen.reshape(-1, block)
        for at in np.array_split(np.flatnonzero(flat.any(axis=1)), 1 + len(flat) // 1024):
            if len(at):
                once, twice = np.packbits(flat[at] > 0, axis=1), np.packbits(flat[at] > 1, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([x.tobytes() for x in once]), pa.array([x.tobytes() for x in twice])],
                                                 names=["block", "once", "twice"])

    def add(key, pdf):
        once, twice = np.zeros(block // 8, np.uint8), np.zeros(block // 8, np.uint8)
        for a, b in zip(pdf["once"], pdf["twice"]):
            a = np.frombuffer(a, np.uint8)
            twice |= np.frombuffer(b, np.uint8) | (once & a)
            once |= a
        return pd.DataFrame({"block": [key[0]], "twice": [twice.tobytes()]})

    parts = rows.select("p1", "p2").mapInArrow(count, "block int, once binary, twice binary")
    full = np.zeros((ROWS * size // block, block // 8), np.uint8)
    for r in parts.groupBy("block").applyInPandas(add, "block int, twice binary").collect():
        full[r["block"]] = np.frombuffer(r["twice"], np.uint8)
    return list(full.reshape(ROWS, size // 8))


def screened(rows: DataFrame, most_bits: int) -> DataFrame:
    """``rows`` of ``prefixes`` with ``open``, whether their prefix may be shared, and ``up``, whether the one before may.

    The sketch never counts too few, so an estimate of one proves that no other conversation has the prefix. It has four
    cells for each turn, 2^``most_bits`` at most: beyond that more prefixes stay open and are grouped, none is lost.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    bits = min(most_bits, max(10, (4 * rows.count()).bit_length()))
    sketch = rows.sparkSession.sparkContext.broadcast(sketched(rows, bits))
    schema = rows.withColumns({"open": F.lit(True), "up": F.lit(True)}).schema
    out = to_arrow_schema(schema)

    def judge(batches):
        for batch in batches:
            found = []
            for x, y in (("p1", "p2"), ("q1", "q2")):
                several = np.ones(batch.num_rows, bool)
                for twice, at in zip(sketch.value, cells(batch.column(x).to_numpy(), batch.column(y).to_numpy(), bits)):
                    several &= (twice[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                found.append(several)
            found[1] |= batch.column("depth").to_numpy() == 1  # all share the root
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns, *map(pa.array, found)], out)], schema=out)

    return rows.mapInArrow(judge, schema)


def joined_digests(rows: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256): SHA-256 of each node's decimal conv_ids, in ascending order and joined by commas.

    The ids are sorted by ranges and written in pieces of up to ``PIECE``, so a node with very many ids is sorted in many
    tasks; the digest itself is sequential, and its task streams the pieces.
    """

    def pieces(frames):
        for pdf in frames:
            p1, p2, ids = (pdf[c].to_numpy() for c in ("p1", "p2", "conv_id"))
            new = np.flatnonzero(np.concatenate([[True], (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])])) if len(ids) else np.zeros(0, int)
            cut = [s for a, b in zip(new, [*new[1:], len(ids)]) for s in range(a, b, PIECE)]
            text = [",".join(map(str, ids[a:min(a + PIECE, b)])) for a, b in zip(cut, [*cut[1:], len(ids)])]
            yield pd.DataFrame({"p1": p1[cut], "p2": p2[cut], "first": ids[cut], "ids": text})

    def digests(frames):
        node, state = None, None
        for pdf in frames:
            out = []
            for a, b, text in zip(pdf["p1"], pdf["p2"], pdf["ids"]):
                if (a, b) != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pd.DataFrame(out, columns=["p1", "p2", "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["p1", "p2", "ends_sha256"])

    keys = ["p1", "p2"]
    dealt = rows.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    made = dealt.mapInPandas(pieces, "p1 long, p2 long, first long, ids string")
    return made.repartition(*keys).sortWithinPartitions(*keys, "first").mapInPandas(digests, "p1 long, p2 long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame, most_bits: int = 25) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs``: (conv_id, length), with conversations of no turn; ``turns``: (conv_id, pos, t1, t2, bytes, length).

    Prefixes that the sketch proves to be of one conversation are nodes as they stand: conversation, depth and whether it
    ends there tell all their columns but a first one's parent. The others are grouped by digest. What a node sums over
    its subtree is summed over its members instead: each node and each leaf is counted with its smallest member, whose
    own prefixes are the nodes above it. So there is one sum along each conversation and no walk from level to level.
    """
    rows = stored(prefixes(turns), "trie-prefixes")
    rows = stored(screened(rows, most_bits), "trie-screened")
    keys = ["p1", "p2"]
    shared, alone = rows.where("open"), rows.where("NOT open")
    nodes = stored(shared.groupBy(*keys).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in ("depth", "bytes", "q1", "q2"))), "trie-nodes")
    below = nodes.where("depth > 1").select("q1", "q2").unionAll(alone.where("up AND depth > 1").select("q1", "q2"))
    kids = below.groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, keys, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("bytes")}), "trie-children")

    # what a conversation stands for at each depth, summed from its end
    own = F.col("conv_id") == F.col("least")
    told = shared.join(nodes.select(*keys, "least", "n_children", "saved"), keys).select(
        "conv_id", "depth", "length", *keys, F.when(own, F.col("saved")).otherwise(0).alias("saved"), (own & (F.col("n_children") == 0)).cast("long").alias("leaf"))
    single = alone.where("depth = length").select("conv_id", "depth", "length", *(F.lit(None).cast("long").alias(k) for k in keys), F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaf"))
    every = stored(told.unionAll(single).withColumn("chunk", F.expr(f"(depth - 1) div {CHUNK}")), "trie-told")
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.desc("depth"))
    local = every.withColumns({c: F.sum(c).over(inside) for c in ("saved", "leaf")})
    sums = every.where(F.col("length") > CHUNK).groupBy("conv_id", "chunk").agg(F.sum("saved").alias("s"), F.sum("leaf").alias("l"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "chunk", F.sum("s").over(later).alias("s"), F.sum("l").over(later).alias("l"))
    summed = local.join(carried, ["conv_id", "chunk"], "left").where("p1 IS NOT NULL").groupBy(*keys).agg(
        F.sum(F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), F.sum(F.col("leaf") + F.coalesce("l", F.lit(0))).alias("n_leaves"))

    root = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    if not root["n"]:
        return nodes.selectExpr(*(f"CAST(0 AS BIGINT) AS {c}" for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), "'' AS ends_sha256").limit(0)
    ended = shared.where("depth = length").select(*keys, "conv_id").unionAll(
        convs.where("length = 0").select(F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), "conv_id"))
    ends = stored(joined_digests(ended), "trie-ends")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    first = F.lit(root["least"]).cast("long")

    def rest(frame: DataFrame) -> DataFrame:
        parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("least").alias("parent"))
        return frame.join(parents, ["q1", "q2"], "left")

    grouped = rest(nodes.join(summed, keys).join(ends, keys, "left")).select(
        # a parent that the sketch proved single is of the same conversation
        F.col("least").alias("conv_id"), "depth", F.when(F.col("depth") == 1, first).otherwise(F.coalesce("parent", "least")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    at_end = F.col("depth") == F.col("length")

    def tail(frame: DataFrame, parent: F.Column) -> DataFrame:
        return frame.select("conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(at_end, zero).otherwise(one).alias("n_children"),
                            one.alias("n_leaves"), zero.alias("saved_tokens"), F.when(at_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"))

    inner = tail(alone.where("NOT up"), F.col("conv_id"))
    top = tail(alone.where("depth = 1"), first)
    middle = tail(rest(alone.where("up AND depth > 1")), F.col("parent"))
    counts = nodes.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("kids"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves"), F.sum("saved").alias("saved")).first()
    lone = alone.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("kids"), F.count(F.when(at_end, 1)).alias("leaves")).first()
    kids_n = counts["kids"] + lone["kids"]
    figures = {"conv_id": root["least"], "depth": 0, "parent_conv_id": None, "n_convs": root["n"], "n_children": kids_n,
               "n_leaves": counts["leaves"] + lone["leaves"] if kids_n else 1, "saved_tokens": counts["saved"] or 0}
    told = ends.where("p1 = 0 AND p2 = 0").first()  # of the conversations without a turn
    top_node = convs.sparkSession.range(1).select(*(F.lit(v).cast("long").alias(k) for k, v in figures.items()),
                                                  (F.lit(told["ends_sha256"]) if told else nothing).alias("ends_sha256"))
    return top_node.unionAll(grouped).unionAll(inner).unionAll(top).unionAll(middle)


def prefix_trie(turns: DataFrame, most_bits: int = 25, **columns: str) -> DataFrame:
    """The trie of all conversations as they are; see ``trie``. ``columns`` name those of ``turns``.

    A null role or text counts as empty, a null turn comes first, and turns with the same number are in the order of
    their digests. Repeated rows are turns of their own. Rows without a conversation's id are left out, other columns
    are ignored, and an empty table has no node.
    """
    return trie(*whole(digested(turns, **columns)), most_bits)
