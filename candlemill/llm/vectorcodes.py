"""Product codes of vectors: exact k-means over parts, sped up by metric trees that an anchors hierarchy builds."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import shipped, stored

shipped(__name__)

LEAF = 16  # points that a tree doesn't part any more
TREE = "lo array<int>, hi array<int>, level array<int>, radius array<double>, order array<int>, points binary, sums binary"


def cut_at(dim: int, parts: int) -> list[int]:
    """Where a vector's parts begin, and its end; parts are equal if the length allows, else they differ by one."""
    return [k * dim // parts for k in range(parts + 1)]


def anchors(points: np.ndarray, k: int) -> np.ndarray:
    """The owner of each point among k anchors at most, each a point that was the farthest from its anchor before.

    A new anchor asks only for points that lie farther from theirs than half the distance of the two anchors: by the
    triangle inequality none of the others can be nearer to the new one.
    """
    owner = np.zeros(len(points), np.int64)
    places = [points[0]]
    distance = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    for new in range(1, min(k, len(points))):
        at = int(distance.argmax())
        if distance[at] == 0:
            break
        place = points[at]
        between = np.sqrt(((np.array(places) - place) ** 2).sum(axis=1))
        asked = np.flatnonzero(distance > between[owner] / 2 * (1 - 1e-9))
        own = np.sqrt(((points[asked] - place) ** 2).sum(axis=1))
        stolen = own < distance[asked]
        owner[asked[stolen]], distance[asked[stolen]] = new, own[stolen]
        owner[at], distance[at] = new, 0.0
        places.append(place)
    return owner


def merged(points: np.ndarray, owner: np.ndarray) -> list:
    """A binary tree over the anchors' balls, as nested pairs: those whose common ball is smallest are joined first."""
    names = np.unique(owner)
    count = np.array([(owner == a).sum() for a in names], float)
    centre = np.array([points[owner == a].mean(axis=0) for a in names])
    radius = np.array([np.sqrt(((points[owner == a] - c) ** 2).sum(axis=1).max()) for a, c in zip(names, centre)])
    trees: list = list(names)
    wide = lambda i: np.maximum(np.sqrt(((centre - centre[i]) ** 2).sum(axis=1)) + radius + radius[i], 2 * np.maximum(radius, radius[i]))
    cost = np.array([wide(i) for i in range(len(names))])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(names) - 1):
        i, j = divmod(int(cost.argmin()), len(cost))
        trees[i] = [trees[i], trees[j]]
        radius[i] = cost[i, j] / 2
        centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
        count[i] += count[j]
        radius[j] = np.inf
        row = wide(i)
        cost[i], cost[:, i] = row, row
        cost[j], cost[:, j] = np.inf, np.inf
        cost[i, i] = np.inf
    return trees[int(np.isfinite(radius).argmax())]


def grown(points: np.ndarray, at: np.ndarray, lo: int, level: int, nodes: list, order: np.ndarray) -> None:
    """Middle-out: about sqrt(n) anchors in the middle, joined upwards to a tree and each parted downwards in the same way.

    Adds a node (lo, hi, level) for each ball; the ball's points are ``order[lo:hi]``.
    """
    stack = [(at, None, None, lo, level)]
    while stack:
        at, owner, tree, lo, level = stack.pop()
        if tree is None:
            owner = anchors(points[at], max(2, math.isqrt(len(at)))) if len(at) > LEAF else None
            if owner is None or not owner.any():
                nodes.append((lo, lo + len(at), level))
                order[lo:lo + len(at)] = at
                continue
            tree = merged(points[at], owner)
        nodes.append((lo, lo + len(at), level))
        for side in tree:
            if isinstance(side, list):
                names = np.array(flat(side))
                inside = np.isin(owner, names)
                stack.append((at[inside], owner[inside], side, lo, level + 1))
            else:
                inside = owner == side
                stack.append((at[inside], None, None, lo, level + 1))
            lo += int(inside.sum())


def flat(tree) -> list:
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo += x
        else:
            out.append(int(x))
    return out


def planted(points: np.ndarray) -> dict:
    """The metric tree of whole-number points: its nodes level by level, with radius and sum of each ball."""
    nodes: list = []
    order = np.zeros(len(points), np.int32)
    grown(points.astype(np.float64), np.arange(len(points)), 0, 0, nodes, order)
    nodes.sort(key=lambda x: (x[2], x[0]))
    lo, hi, level = (np.array(c, np.int32) for c in zip(*nodes))
    laid = points[order]
    ahead = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(laid, axis=0)])
    sums = ahead[hi] - ahead[lo]
    radius = np.zeros(len(lo))
    for k in range(int(level.max()) + 1):
        some = np.flatnonzero(level == k)
        size = hi[some] - lo[some]
        row = np.repeat(np.arange(len(some)), size)
        at = np.repeat(lo[some] - (np.cumsum(size) - size), size) + np.arange(len(row))
        far = np.sqrt(((laid[at] - (sums[some] / size[:, None])[row]) ** 2).sum(axis=1))
        radius[some] = np.maximum.reduceat(far, np.cumsum(size) - size)
    return {"lo": lo, "hi": hi, "level": level, "radius": radius, "order": order, "points": laid.astype("<i8"), "sums": sums.astype("<i8")}


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of whole numbers: by doubles where these hold every sum exactly, else by longs."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4.0 * float(most) ** 2 * max(1, a.shape[1]) < 2.0 ** 53:
        a, b = a.astype(np.float64), b.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.stack([((a - x) ** 2).sum(axis=1) for x in b], axis=1)


def owned(tree: dict, book: np.ndarray, each: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, counts) of what each entry of ``book`` owns of the tree's points, and each point's entry if ``each``.

    Nodes are visited from the top, each with the entries its parent left over. An entry goes if the ball lies wholly on
    the other side of the plane half way to the entry nearest to the ball's centre; planes are tested with more room than
    rounding needs, so a tie keeps both. A ball with one entry left gives its cached sum and count; points of a leaf
    with several are compared one by one. Equal entries: only the first can own anything.
    """
    n, entries = len(tree["order"]), len(book)
    sums, counts = np.zeros((entries, book.shape[1]), np.int64), np.zeros(entries, np.int64)
    code = np.zeros(n, np.int32)
    _, first = np.unique(book, axis=0, return_index=True) if book.shape[1] else (None, np.array([0]))
    left = np.zeros(entries, bool)
    left[first] = True
    real = book.astype(np.float64)
    apart = np.sqrt(((real[:, None, :] - real[None, :, :]) ** 2).sum(axis=2))
    lo, hi, level = tree["lo"], tree["hi"], tree["level"]
    starts = np.searchsorted(level, np.arange(int(level.max()) + 2))
    # the frontier: a mask of entries for each node of the level that isn't settled
    open_, masks = np.array([0]), left[None, :]
    loose: list[tuple[int, int, np.ndarray]] = []
    for k in range(int(level.max()) + 1):
        if not len(open_):
            break
        size = (hi[open_] - lo[open_])[:, None]
        centre = tree["sums"][open_] / size
        distance = ((centre * centre).sum(axis=1)[:, None] + (real * real).sum(axis=1) - 2 * (centre @ real.T))
        scale = (centre * centre).sum(axis=1)[:, None] + (real * real).sum(axis=1)
        nearest = np.where(masks, distance, np.inf).argmin(axis=1)
        margin = distance - distance[np.arange(len(open_)), nearest][:, None]
        slack = 1e-9 * (scale + scale[np.arange(len(open_)), nearest][:, None]) + 1e-9
        away = margin > 2 * tree["radius"][open_][:, None] * apart[nearest] * (1 + 1e-9) + slack
        masks = masks & ~away
        alone = masks.sum(axis=1) == 1
        for node, entry in zip(open_[alone], masks[alone].argmax(axis=1)):
            sums[entry] += tree["sums"][node]
            counts[entry] += hi[node] - lo[node]
            if each:
                code[lo[node]:hi[node]] = entry
        open_, masks = open_[~alone], masks[~alone]
        below = np.arange(starts[k + 1], starts[k + 2]) if k + 2 < len(starts) else np.zeros(0, int)
        # a child is the node of the next level that begins inside; a ball without one is a leaf
        parent = np.searchsorted(lo[open_], lo[below], side="right") - 1
        inside = (parent >= 0) & (lo[below] < hi[open_][np.maximum(parent, 0)]) if len(open_) else np.zeros(len(below), bool)
        below, parent = below[inside], parent[inside]
        has = np.zeros(len(open_), bool)
        has[parent] = True
        loose += [(lo[x], hi[x], m) for x, m in zip(open_[~has], masks[~has])]
        open_, masks = below, masks[parent]
    if loose:
        at = np.concatenate([np.arange(a, b) for a, b, _ in loose])
        mask = np.repeat(np.array([m for *_, m in loose]), [b - a for a, b, _ in loose], axis=0)
        d = squares(tree["points"][at], book)
        best = np.where(mask, d, np.inf if d.dtype == np.float64 else np.iinfo(np.int64).max).argmin(axis=1)
        np.add.at(sums, best, tree["points"][at])
        counts += np.bincount(best, minlength=entries)
        code[at] = best
    return sums, counts, code


def read_tree(t: dict, width: int) -> dict:
    """A tree as arrays, from a row of the table of blocks."""
    out = {k: np.asarray(t[k]) for k in ("lo", "hi", "level", "radius", "order")}
    return out | {k: np.frombuffer(t[k], "<i8").reshape(len(out[n]), width) for k, n in (("points", "order"), ("sums", "lo"))}


def kept_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, scale: int) -> DataFrame:
    """(vec_id, label, v): the sound vectors as whole numbers.

    A vector is left out if it is null or holds null or non-finite components, or ones so large that a squared distance
    would not fit a long.
    """
    v = F.col(f"`{vector_col}`")
    label = F.col(f"`{label_col}`") if label_col in vectors.columns else F.lit(None).cast("int")
    limit = F.sqrt(F.lit(2.0 ** 60) / F.greatest(F.size("v"), F.lit(1)))
    sound = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < limit))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"), v.cast("array<double>").alias("v"))
    return rows.where(F.coalesce(sound, F.lit(False))).select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def compressed(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, block: int = 2048,
               id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """One row per sound vector: vec_id, code (hex), error, label_error, codebooks_sha256, label.

    Components become floor(``scale`` * x). Each of ``parts`` equal parts has a codebook of ``entries`` entries: the parts
    of the smallest vec_ids at first, then ``rounds`` times the floored mean of the parts that are nearest to it (squared
    Euclidean distance, ties to the lower entry), unused ones staying. All is computed in whole numbers, so the result
    doesn't depend on how rows lie. Vectors of another length have codebooks of their own.

    The rows are cut as they are read into blocks of up to ``block``; a block's trees are grown once and written, every
    round visits them, and a task returns sums and counts for each entry, which Spark adds up. The codebooks are all
    that the driver holds. No vector is shuffled.

    Null labels are equal to each other. Null ids come last among the smallest and are coded like others; repeated ids and
    rows are vectors of their own, of equal ids the one whose components come first. Fewer vectors than entries give as
    many entries; an empty table gives no rows. Other columns are ignored. ``entries`` is 256 at most.
    """
    rows = kept_rows(vectors, id_col, vector_col, label_col, scale)
    schema = f"dim int, ids array<long>, labels array<{dict(rows.dtypes)['label']}>, trees array<struct<{TREE.replace(', ', ',').replace(' ', ':')}>>"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def plant(batches):
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            for dim in np.unique(sizes):
                chosen = np.flatnonzero(sizes == dim)
                for at in np.array_split(chosen, -(-len(chosen) // block)):
                    some = batch.take(pa.array(at))
                    x = some.column("v").flatten().to_numpy().reshape(len(at), dim)
                    cut = cut_at(int(dim), parts)
                    trees = [{k: v.tobytes() if k in ("points", "sums") else v for k, v in planted(x[:, a:b]).items()} for a, b in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(dim)], pa.int32()), pa.array([some.column("vec_id").to_pylist()], out.field("ids").type),
                        pa.array([some.column("label").to_pylist()], out.field("labels").type), pa.array([trees], out.field("trees").type)], schema=out)

    blocks = stored(rows.mapInArrow(plant, schema), "codes-trees")
    books: dict[int, list[np.ndarray]] = {}
    for (dim,) in blocks.select("dim").distinct().collect():
        first = rows.where(F.size("v") == dim).orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
        start = np.array([r["v"] for r in first], np.int64).reshape(len(first), dim)
        books[dim] = [start[:, a:b].copy() for a, b in zip(cut_at(dim, parts), cut_at(dim, parts)[1:])]
    width = max((b.shape[1] for book in books.values() for b in book), default=0)

    def visited(batches):
        """Every tree of a batch, one block at a time."""
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                dim = row.column("dim")[0].as_py()
                trees = row.column("trees").values.slice(row.column("trees").offsets[0].as_py())
                yield dim, row, [read_tree({f: tree_field(t[f]) for f in ("lo", "hi", "level", "radius", "order", "points", "sums")}, b.shape[1])
                                 for t, b in zip(trees, books[dim])]

    def tree_field(x):
        return x.as_buffer() if isinstance(x, pa.BinaryScalar) else x.values.to_numpy()

    def tally(batches):
        total: dict = {}
        for dim, _, trees in visited(batches):
            for p, (tree, book) in enumerate(zip(trees, books[dim])):
                sums, counts, _ = owned(tree, book, False)
                known = total.get((dim, p))
                total[dim, p] = (sums, counts) if known is None else (known[0] + sums, known[1] + counts)
        for (dim, p), (sums, counts) in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(used), dim, np.int32)), pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)),
                pa.array(counts[used]), pa.array([s.tolist() for s in sums[used]], pa.list_(pa.int64()))], names=["dim", "part", "entry", "n", "sums"])

    for _ in range(rounds):
        found = blocks.mapInArrow(tally, "dim int, part int, entry int, n long, sums array<long>")
        added = found.groupBy("dim", "part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(j))) for j in range(width))).alias("sums"))
        for r in added.collect():  # a row for each entry
            book = books[r["dim"]][r["part"]]
            book[r["entry"]] = np.array([s // r["n"] for s in r["sums"][:book.shape[1]]], np.int64)

    digest = {dim: hashlib.sha256(",".join(str(x) for b in book for x in b.ravel().tolist()).encode()).hexdigest() for dim, book in books.items()}

    def encode(batches):
        for dim, row, trees in visited(batches):
            n = len(trees[0]["order"])
            codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            for p, (tree, book) in enumerate(zip(trees, books[dim])):
                code = owned(tree, book, True)[2]
                codes[tree["order"], p] = code
                error[tree["order"]] += ((tree["points"] - book[code]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                row.column("ids").flatten(), row.column("labels").flatten(), pa.array([c.tobytes().hex() for c in codes]), pa.array(error),
                pa.array([digest[dim]] * n)], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    kind = dict(rows.dtypes)["label"]
    coded = stored(blocks.mapInArrow(encode, f"vec_id long, label {kind}, code string, error long, codebooks_sha256 string"), "codes-codes")
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label")
