"""SimHash near-duplicates by a self-join of the binary trie of fingerprints."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, components, forest, free, shipped, stored, versioned
from candlemill.llm.likeness import band_keys, links as likeness_links, shingles

shipped(__name__)

TOP = 12  # bits of the first histogram of the trie
NEXT = 8  # bits that a heavy node is opened by


def fingerprint(data: bytes | None, width: int) -> int:
    """Majority of each bit over the XXH64 of all ``width``-word shingles, as a signed 64-bit number."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(g), 42) for g in zip(*(words[i:] for i in range(width)))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every document; a text that is null or has no word gets zero."""
    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(taken, lambda: lambda ids, texts: [ids, [fingerprint(t, width) for t in texts]],
                    "doc_id long, fp long", "doc_id", "text")


def marks(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, version, fp, node, bands) for every document: the fingerprint, a hash of the shingle set and its bands."""

    def step(ids, versions, texts):
        sets = [shingles(t) for t in texts]
        return [ids, versions, [fingerprint(t, width) for t in texts], [xxhash.xxh64_intdigest(s.tobytes()) - 2**63 for s in sets],
                [band_keys(s) for s in sets]]

    return by_batch(docs, lambda: step, "doc_id long, version long, fp long, node long, bands array<long>", "doc_id", "version", "text")


def top_nodes(fps: DataFrame, node_rows: int) -> list[tuple[int, int, int]]:
    """(depth, prefix, rows) of trie nodes that together cover all rows of ``fps``, none with more than ``node_rows``.

    Counts come from histograms: one over the first bits, then one over the next bits of the heavy nodes alone. Each
    holds at most 2^12, or 2^8 for each heavy node, rows, and heavy nodes are at most rows / node_rows.
    """
    unsigned = lambda depth: F.shiftrightunsigned("fp", 64 - depth)
    counts: dict[tuple[int, int], int] = {}
    depth, heavy = TOP, None
    while True:
        rows = fps if heavy is None else fps.where(unsigned(depth - NEXT).isin(heavy))
        level = {r["p"]: r["n"] for r in rows.groupBy(unsigned(depth).alias("p")).agg(F.count("*").alias("n")).collect()}
        counts |= {(depth, p): n for p, n in level.items()}
        heavy = [p for p, n in level.items() if n > node_rows]
        if not heavy or depth + NEXT >= 64:
            break
        depth += NEXT
    # sum up the trie; a node below which all is light enough stands for its rows
    total = dict(counts)
    for (d, p), n in counts.items():
        for up in range(1, NEXT if d > TOP else TOP + 1):
            total[d - up, p >> up] = total.get((d - up, p >> up), 0) + n
    nodes, todo = [], [(0, 0)]
    while todo:
        d, p = todo.pop()
        n = total.get((d, p), 0)
        if not n:
            continue
        children = [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
        if n <= node_rows or not any(c in total for c in children):
            nodes.append((d, p, n))
        else:
            todo += children
    return sorted(nodes, key=lambda x: x[1] << (64 - x[0]))


def node_pairs(nodes: list[tuple[int, int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs (i, j), i <= j, of nodes whose common bits differ by ``budget`` at most: the top of the trie against itself."""
    starts = [p << (64 - d) for d, p, _ in nodes]
    out, todo = [], [(0, len(nodes), 0, len(nodes), 0, 0)]
    while todo:
        a0, a1, b0, b1, depth, differ = todo.pop()
        if differ > budget or a0 >= a1 or b0 >= b1 or a0 > b0:
            continue
        if a1 - a0 == 1 and b1 - b0 == 1:
            (da, pa, _), (db, pb, _) = nodes[a0], nodes[b0]
            d = min(da, db)
            if ((pa >> (da - d)) ^ (pb >> (db - d))).bit_count() <= budget:
                out.append((a0, b0))
            continue

        def cut(lo: int, hi: int) -> int:
            """The first node of the half in which the next bit is set."""
            if hi - lo == 1 and nodes[lo][0] <= depth:
                return -1  # the node isn't opened any more
            base = starts[lo] >> (64 - depth) << (64 - depth) if depth else 0
            middle = base + (1 << (63 - depth))
            return bisect.bisect_left(starts, middle, lo, hi)

        ca, cb = cut(a0, a1), cut(b0, b1)
        left = [(a0, a1, -1)] if ca < 0 else [(a0, ca, 0), (ca, a1, 1)]
        right = [(b0, b1, -1)] if cb < 0 else [(b0, cb, 0), (cb, b1, 1)]
        todo += [(x0, x1, y0, y1, depth + 1, differ + (min(x, y) >= 0 and x != y)) for x0, x1, x in left for y0, y1, y in right]
    return sorted(set(out))


def close_pairs(a: np.ndarray, b: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) in the sorted unsigned arrays whose values differ by ``budget`` bits at most; i < j if b is None.

    Pairs of trie nodes, as ranges of the sorted arrays, go down together a bit at a time with the bits that they
    differ by so far; a pair beyond the budget is dropped, and small pairs are compared value by value.
    """
    one = b is None
    b = a if one else b
    found_i, found_j = [], []
    node = np.array([[0, len(a), 0, len(b), 0]], dtype=np.int64)
    for depth in range(65):
        small = ((node[:, 1] - node[:, 0]) * (node[:, 3] - node[:, 2]) <= 32) | (depth == 64)
        for part in np.array_split(node[small], max(1, int(small.sum()) // 200_000)):
            if not len(part):
                continue
            wide = part[:, 3] - part[:, 2]
            size = (part[:, 1] - part[:, 0]) * wide
            row = np.repeat(np.arange(len(part)), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            i, j = part[row, 0] + at // wide[row], part[row, 2] + at % wide[row]
            keep = np.bitwise_count(a[i] ^ b[j]) <= budget
            keep &= (i < j) if one else True
            found_i.append(i[keep])
            found_j.append(j[keep])
        node = node[~small]
        if not len(node):
            break
        bit = np.uint64(63 - depth)
        ones_a, ones_b = np.cumsum((a >> bit) & np.uint64(1)), np.cumsum((b >> bit) & np.uint64(1))
        middle = lambda lo, hi, ones: hi - (ones[hi - 1] - np.where(lo > 0, ones[np.maximum(lo, 1) - 1], 0)).astype(np.int64)
        a0, a1, b0, b1, differ = node.T
        am, bm = middle(a0, a1, ones_a), middle(b0, b1, ones_b)
        parts = [np.stack(x, axis=1) for x in ((a0, am, b0, bm, differ), (am, a1, bm, b1, differ), (a0, am, bm, b1, differ + 1), (am, a1, b0, bm, differ + 1))]
        node = np.concatenate(parts)
        node = node[(node[:, 0] < node[:, 1]) & (node[:, 2] < node[:, 3]) & (node[:, 4] <= budget)]
        if one:
            node = node[node[:, 0] <= node[:, 2]]
    return np.concatenate([*found_i, np.zeros(0, np.int64)]), np.concatenate([*found_j, np.zeros(0, np.int64)])


def links(fps: DataFrame, budget: int = 2, node_rows: int = 4096, max_nodes: int = 4096) -> DataFrame:
    """Edges (a, b) between the ``rep`` of fingerprints, enough to connect whatever links with whatever.

    ``fps``: (fp, rep), fingerprints distinct. The trie's top is opened until no node has more than ``node_rows`` rows
    (or a 1/``max_nodes`` part of all rows, if that is more: the driver pairs up the nodes). Each pair of nodes within the
    budget is one group, cut into blocks of ``node_rows`` on either side, and the group's task goes on down both
    subtries. So no task holds more than 2 * ``node_rows`` rows, whatever the input. A group of linked rows leaves a task as
    a tree, not as all its pairs.
    """
    nodes = top_nodes(fps, max(node_rows, -(-fps.count() // max_nodes)))
    pairs = node_pairs(nodes, budget)
    starts = np.array([p << (64 - d) for d, p, _ in nodes], dtype=np.uint64)
    blocks = np.array([-(-n // node_rows) for *_, n in nodes], dtype=np.int64)
    partners: list[list[tuple[int, int, int]]] = [[] for _ in nodes]  # pair, side, the other side's blocks
    for k, (x, y) in enumerate(pairs):
        partners[x].append((k, 0, int(blocks[y])))
        if x != y:
            partners[y].append((k, 1, int(blocks[x])))
    alone = np.array([x == y for x, y in pairs], dtype=bool)
    # what a row of each node is sent to: pair, side, block of the other side
    dealt = [np.array([(k, s, b) for k, s, n in some for b in range(n)], dtype=np.int64).reshape(-1, 3) for some in partners]

    def spread(frames):
        for pdf in frames:
            fp = pdf["fp"].to_numpy()
            at = np.searchsorted(starts, fp.view(np.uint64), side="right") - 1
            times = np.array([len(x) for x in dealt])[at] if len(at) else np.zeros(0, int)
            pair, side, other = np.concatenate([np.zeros((0, 3), np.int64), *(dealt[x] for x in at)]).T
            mixed = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            own = np.repeat(mixed.astype(np.int64) % blocks[at] if len(at) else mixed, times)
            # within one node block i meets block j once, i <= j
            same = alone[pair]
            side = np.where(same, own > other, side)
            i, j = np.where(side == 0, own, other), np.where(side == 0, other, own)
            yield pd.DataFrame({"pair": pair.astype(np.int32), "i": i.astype(np.int32), "j": j.astype(np.int32), "side": side.astype(np.int8),
                                "fp": np.repeat(fp, times), "rep": np.repeat(pdf["rep"].to_numpy(), times)})

    def meet(key, pdf):
        value, rep, side = pdf["fp"].to_numpy().view(np.uint64), pdf["rep"].to_numpy(), pdf["side"].to_numpy()
        order = np.lexsort((value, side))
        value, rep, cut = value[order], rep[order], int((side == 0).sum())
        if alone[key[0]] and key[1] == key[2]:
            i, j = close_pairs(value, None, budget)
        else:
            i, j = close_pairs(value[:cut], value[cut:], budget)
            j = j + cut
        label = forest(len(value), i, j)
        moved = np.flatnonzero(label != np.arange(len(value)))
        return pd.DataFrame({"a": rep[moved], "b": rep[label[moved]]})

    sent = fps.mapInPandas(spread, "pair int, i int, j int, side byte, fp long, rep long")
    return sent.groupBy("pair", "i", "j").applyInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, budget: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    alike: float | None = None, **sizes: int) -> DataFrame:
    """One row per document: doc_id, fp (long), fingerprint (16 hex digits), component_id, kept.

    Documents link if their fingerprints differ by ``budget`` bits at most; the component is the least doc_id that links
    reach, and the document whose id that is is kept (once: copies of that row are not told apart). A null or wordless
    text has fingerprint zero and links like any other. A null id takes part through its fingerprint but names nothing:
    if all of a component's ids are null, component_id is null and none is kept. Other columns are ignored.

    With ``alike`` documents also link if the Jaccard likeness of their five-word shingles is that or more.
    """
    if alike is None:
        fps = stored(fingerprints(docs, width, id_col, text_col), "simhash-fps")
    else:
        taken = versioned(docs, id_col, text_col).select("doc_id", "version", F.col(f"`{text_col}`").alias("text"))
        fps = stored(marks(taken, width), "simhash-marks")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("doc")), "simhash-classes")
    edges = links(classes.select("fp", F.col("fp").alias("rep")), budget, **sizes)
    if alike is not None:
        edges = edges.unionAll(likeness_links(taken, fps, alike))
    joined = components(edges, "simhash").select(F.col("node").alias("fp"), F.col("component").alias("group"))
    grouped = stored(joined.join(classes.select("fp", "doc"), "fp"), "simhash-groups")
    least = grouped.groupBy("group").agg(F.min("doc").alias("component_id"))
    linked = grouped.join(least, "group").select("fp", "component_id")
    copied = classes.select("fp", F.col("doc").alias("own")).join(linked, "fp", "left").select("fp", F.coalesce("component_id", "own").alias("component_id"))
    copied = stored(copied, "simhash-components")
    return (fps.join(copied, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")))


def keep_one(docs: DataFrame, width: int = 3, budget: int = 2, alike: float | None = None) -> DataFrame:
    """The documents (doc_id, text and any other columns) without those that one with a smaller id represents.

    Null ids and rows that repeat a kept one stay.
    """
    found = near_duplicates(docs, width, budget, alike=alike).where("NOT kept AND doc_id IS NOT NULL AND component_id IS NOT NULL")
    (d,) = free(docs, "gone_doc")
    return docs.join(found.select(F.col("doc_id").alias(d)).distinct(), F.col("doc_id").cast("long") == F.col(d), "left_anti")
