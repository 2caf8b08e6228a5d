"""Near-duplicates by the Jaccard likeness of five-word shingles: minhash bands propose pairs, the whole sets decide."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, components, forest, shipped, stored

shipped(__name__)

WIDTH = 5  # words of a shingle
BANDS, ROWS = 40, 5  # two sets of likeness 0.8 share no band with probability (1 - 0.8^5)^40 = 1.3e-7
RARE = 16  # an element in so many sets of a task at most adds to their pairs one by one
BLOCK, MOST = 250_000, 1_500  # shingle hashes and sets of a block
_draw = np.random.default_rng(8)
ODD, ADD = (_draw.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(k) for k in (1, 0))


def shingles(data: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the ``WIDTH``-word shingles; a shorter text is one shingle, one without a word has none."""
    words = (data or b"").lower().split()
    grams = zip(*(words[i:] for i in range(WIDTH))) if len(words) > WIDTH else [words] * bool(words)
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(g), WIDTH) for g in grams], dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of least hashes; none for an empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        least = np.minimum(least, (hashes[at:at + 512, None] * ODD + ADD).min(axis=0))
    keys = np.array([xxhash.xxh64_intdigest(least[k * ROWS:(k + 1) * ROWS].tobytes(), k) for k in range(BANDS)], dtype=np.uint64)
    return keys.view(np.int64)


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether the sets, as sorted distinct hashes, have a Jaccard likeness of ``least`` or more."""
    small, large = sorted((len(a), len(b)))
    if small < least * large - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (small + large - both) - 1e-9


def in_common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share, as a square table.

    An element in few sets adds one to each pair of them; those in many are columns of a 0-1 matrix that is multiplied
    with itself. Elements of one set alone, most of them among near copies, cost nothing.
    """
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    row, begin = row[order], np.cumsum(count) - count
    flat = []
    for c in range(2, RARE + 1):
        some = row[begin[count == c][:, None] + np.arange(c)]
        flat += [some[:, a] * n + some[:, b] for a in range(c) for b in range(a + 1, c) if len(some)]
    if flat:
        out += np.bincount(np.concatenate(flat), minlength=n * n).reshape(n, n).astype(np.float32)
        out = out + out.T
    often = np.flatnonzero(count > RARE)
    for at in range(0, len(often), 2048):
        part = often[at:at + 2048]
        some = np.zeros((n, len(part)), np.float32)
        which = np.repeat(np.arange(len(part)), count[part])
        some[row[np.concatenate([np.arange(begin[k], begin[k] + count[k]) for k in part])], which] = 1
        out += some @ some.T
    return out


def tree(names: np.ndarray, sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect whatever of the sets have a Jaccard likeness of ``least`` or more, one less than there are."""
    if len(sets) == 2:
        return (names[:1], names[1:]) if alike(sets[0], sets[1], least) else (names[:0], names[:0])
    both, size = in_common(sets), np.array([len(x) for x in sets], float)
    i, j = np.nonzero(np.triu(both >= least * (size[:, None] + size - both) - 1e-9, 1))
    label = forest(len(sets), i, j)
    moved = np.flatnonzero(label != np.arange(len(sets)))
    return names[moved], names[label[moved]]


def sure(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")

    def check(a, b, x, y):
        good = [k for k in range(len(a)) if alike(np.frombuffer(x[k], np.uint64), np.frombuffer(y[k], np.uint64), least)]
        return [[a[k] for k in good], [b[k] for k in good]]

    return stored(by_batch(both, lambda: check, "a long, b long", "a", "b", "x", "y"), "likeness-sure")


def within(clusters: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) that connect the alike nodes of each cluster; ``clusters``: (node, cluster).

    A cluster of more than ``BLOCK`` hashes or ``MOST`` sets is cut into blocks, and each two blocks meet in a task; small clusters share
    tasks. A task compares its sets by table and returns a tree, so no pair is written for itself.
    """
    sized = stored(clusters.join(sets, "node"), "likeness-clusters")
    size = F.sum(F.octet_length("hashes") / 8)
    blocks = sized.groupBy("cluster").agg(F.ceil(F.greatest(size / BLOCK, F.count("*") / MOST)).cast("int").alias("blocks"), size.alias("n"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = sized.join(blocks, "cluster").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    small = F.col("blocks") == 1
    parts = max(1, math.ceil((blocks.where(small).agg(F.sum("n")).first()[0] or 0) / BLOCK))
    dealt = dealt.select(
        "node", "hashes", "cluster", F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(parts))).otherwise(F.col("cluster")).alias("task"), small.alias("small"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def meet(key, pdf):
        found = [tree(part["node"].to_numpy(), [np.frombuffer(h, np.uint64) for h in part["hashes"]], least) for _, part in pdf.groupby("cluster") if len(part) > 1]
        a, b = (np.concatenate([*(x[k] for x in found), np.zeros(0, np.int64)]) for k in (0, 1))
        return pd.DataFrame({"a": a, "b": b})

    return dealt.groupBy("small", "task", "i", "j").applyInPandas(meet, "a long, b long")


def links(docs: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) between fingerprints, enough to connect the documents whose likeness is ``least`` or more.

    ``docs``: (doc_id, version, text); ``marks``: (doc_id, version, fp, node, bands), node being a hash of the set. Equal
    sets are one node. Of each band's nodes all are compared with one of them, another for each band, which settles
    large groups of near copies. The nodes of bands that still lie in different components form clusters, and of a
    cluster every two nodes are compared.
    """
    marks = marks.where("size(bands) > 0")
    classes = marks.groupBy("node").agg(F.min("fp").alias("fp"), F.min(F.struct("doc_id", "version")).alias("at"), F.first("bands").alias("bands"))
    classes = stored(classes, "likeness-classes")
    keyed = classes.select("node", F.explode("bands").alias("key"))
    # the node that a band's others are held against is drawn anew for each band
    drawn = keyed.withColumn("mix", F.col("node").bitwiseXOR(F.xxhash64("key")))
    hubs = drawn.groupBy("key").agg(F.min("mix").alias("hub"), F.max("mix").alias("high")).where("hub <> high")
    hubs = hubs.select("key", F.col("hub").bitwiseXOR(F.xxhash64("key")).alias("hub"))
    open_ = stored(keyed.join(stored(hubs, "likeness-hubs"), "key"), "likeness-open")
    wanted = open_.select("node").distinct().join(classes, "node").select("node", F.col("at.doc_id").alias("d"), F.col("at.version").alias("v"))
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))).select("node", "text").dropDuplicates(["node"])
    sets = by_batch(texts, lambda: lambda n, t: [n, [shingles(x).tobytes() for x in t]], "node long, hashes binary", "node", "text")
    sets = stored(sets, "likeness-sets")
    star = open_.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    found = sure(star, sets, least)
    named = components(found, "likeness")
    part = stored(open_.join(named, "node", "left").select("key", "hub", "node", F.coalesce("component", "node").alias("part")), "likeness-parts")
    parted = part.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    left = stored(part.join(parted, "key", "left_semi").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "likeness-left")
    clusters = components(left, "likeness-left").select("node", F.col("component").alias("cluster"))
    found = found.unionAll(within(clusters, sets, least))
    fp = lambda side: classes.select(F.col("node").alias(side), F.col("fp").alias(f"fp_{side}"))
    between = found.join(fp("a"), "a").join(fp("b"), "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))
    # texts of one set that repeat or order its shingles otherwise may differ in their fingerprints
    same = marks.select("node", F.col("fp").alias("b")).distinct().join(fp("node"), "node").select(F.col("fp_node").alias("a"), "b")
    return between.unionAll(same)
