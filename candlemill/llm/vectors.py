"""Near-duplicate vectors by an exact range join in metric space, partitioned by pivots."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import components, forest, shipped, stored

shipped(__name__)

SLACK = 1e-6  # added to distance bounds, far above rounding
KEY = "dim int, cell int, a int, b int"


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of doubles at length 1, scaled first so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def far_points(rows: np.ndarray, k: int) -> np.ndarray:
    """At most k of the rows, each the one that is farthest from those before."""
    taken = [0]
    nearest = 2 - 2 * rows @ rows[0]
    while len(taken) < min(k, len(rows)) and nearest.max() > SLACK:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, 2 - 2 * rows @ rows[taken[-1]])
    return rows[taken]


def halo_cells(rows: np.ndarray, cell: np.ndarray, pivots: np.ndarray, rings: dict[int, tuple[float, float]], eps: float) -> np.ndarray:
    """Which cells of a smaller number each row may have a partner in: a boolean table of rows and cells.

    A partner y of x within eps, at home with pivot q, is no nearer to x's own pivot p than to q. By the triangle
    inequality x is then at most 2 eps nearer to p than to q, and at most eps from the bisecting plane; and x's distance
    from q differs by eps at most from that of some row at home with q.
    """
    cosine = np.clip(rows @ pivots.T, -1, 1)
    distance = np.sqrt(2 - 2 * cosine)
    at = np.arange(len(rows))
    between = np.sqrt(np.maximum(2 - 2 * np.clip(pivots @ pivots.T, -1, 1), 1e-12))
    near = distance - distance[at, cell][:, None] <= 2 * eps
    near &= (cosine[at, cell][:, None] - cosine) / between[cell] <= eps
    low = np.array([rings.get(k, (9.0, -9.0))[0] for k in range(len(pivots))])
    high = np.array([rings.get(k, (9.0, -9.0))[1] for k in range(len(pivots))])
    near &= (distance >= low - eps) & (distance <= high + eps)
    return near & (np.arange(len(pivots)) < cell[:, None])


def linked(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of rows with a cosine of ``least`` or more.

    Single precision decides what is clear of the limit by more than its error; the rest is computed in double.
    """
    ux, uy = unit(x), unit(y)
    fx, fy, error = ux.astype(np.float32), uy.astype(np.float32), 2.5e-7 * max(16, x.shape[1])
    out_i, out_j = [], []
    for at in range(0, len(x), 1024):
        cosine = fx[at:at + 1024] @ fy.T
        i, j = np.nonzero(cosine >= least - error)
        value = cosine[i, j]
        keep = value >= least + error
        for part in np.array_split(np.flatnonzero(~keep), max(1, int((~keep).sum()) // 100_000)):
            p, q = x[at + i[part]], y[j[part]]
            scale = np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1))
            exact = (p * q).sum(axis=1) / scale
            # squares beyond the range of doubles: the scaled rows decide
            exact = np.where(np.isfinite(exact), exact, (ux[at + i[part]] * uy[j[part]]).sum(axis=1))
            keep[part] = exact >= least
        out_i.append(at + i[keep])
        out_j.append(j[keep])
    return np.concatenate([*out_i, np.zeros(0, int)]), np.concatenate([*out_j, np.zeros(0, int)])


def near_duplicates(vectors: DataFrame, least: float = 0.95, pivots: int | None = None, sample: int = 2048, block: int = 4096,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one length link if their cosine is ``least`` or more; a vector that is null, empty or zero, or has a null
    or non-finite component, links with nothing. Equal vectors are one class until the end, so copies are never paired
    up. Pivots, drawn far apart from ``sample`` vectors, part the classes into cells, and a class near a boundary is sent
    to the cells across it; a cell larger than ``block`` joins block by block. ``pivots`` defaults to a number that
    follows the table's size. All rows are joined: the sample only sets where cells lie.

    Null ids link and are counted but name no component; a component without any id has a null component_id, and none
    of it is kept. Repeated rows are vectors of their own. Other columns are ignored, an empty table gives no rows.
    """
    eps = math.sqrt(2 - 2 * least) + SLACK
    v = F.col(f"`{vector_col}`")
    table = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = table.withColumn("sound", F.coalesce(sound, F.lit(False)))
    good = rows.where("sound").select("vec_id", "v")
    # a class's number is drawn from the rows as they are written, so it doesn't change when a part is computed again
    classes = stored(good.groupBy("v").agg(F.min("vec_id").alias("doc"), F.count("*").alias("copies")), "vectors-classes")
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "vectors-numbered")
    if pivots is None:
        pivots = max(32, min(1024, classes.count() // 50_000))
    drawn: dict[int, list] = {}
    for r in classes.select("v").orderBy(F.xxhash64("v"), "class").limit(sample).collect():
        drawn.setdefault(len(r["v"]), []).append(r["v"])
    centres = {dim: far_points(unit(np.array(x, dtype=np.float64)), pivots) for dim, x in drawn.items()}

    def by_length(frames):
        for pdf in frames:
            for dim, part in pdf.groupby(pdf["v"].map(len)):
                yield int(dim), part, unit(matrix(part["v"]))

    def assign(frames):
        for dim, part, x in by_length(frames):
            cell, r = np.zeros(len(part), np.int32), np.zeros(len(part))
            if dim in centres:
                cosine = x @ centres[dim].T
                cell = cosine.argmax(axis=1).astype(np.int32)
                r = np.sqrt(np.maximum(0, 2 - 2 * cosine.max(axis=1)))
            yield part.assign(dim=np.int32(dim), cell=cell, r=r)

    kind = dict(classes.dtypes)["v"]
    homes = stored(classes.mapInPandas(assign, f"v {kind}, doc long, copies long, class long, dim int, cell int, r double"), "vectors-homes")
    rings: dict[int, dict[int, tuple[float, float]]] = {}
    home_blocks: dict[tuple[int, int], int] = {}
    for r in homes.groupBy("dim", "cell").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("n")).collect():
        rings.setdefault(r["dim"], {})[r["cell"]] = (r["low"], r["high"])
        home_blocks[r["dim"], r["cell"]] = -(-r["n"] // block)

    def halos(part: pd.DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all that is sent across a boundary."""
        if dim not in centres or len(centres[dim]) < 2:
            return np.zeros(0, int), np.zeros(0, int)
        return np.nonzero(halo_cells(unit(matrix(part["v"])), part["cell"].to_numpy(), centres[dim], rings[dim], eps))

    def count(frames):
        for pdf in frames:
            for dim, part in pdf.groupby("dim"):
                cells, n = np.unique(halos(part, dim)[1], return_counts=True)
                yield pd.DataFrame({"dim": np.int32(dim), "cell": cells.astype(np.int32), "n": n})

    sent = homes.select("v", "dim", "cell").mapInPandas(count, "dim int, cell int, n long")
    halo_blocks = {(r["dim"], r["cell"]): -(-r["n"] // block) for r in sent.groupBy("dim", "cell").agg(F.sum("n").alias("n")).collect()}

    def spread(frames):
        """Rows for the tasks (a, b) of each cell: block a of those at home against block b of all; a halo block has b < 0."""
        for pdf in frames:
            for dim, part in pdf.groupby("dim"):
                out = []
                mixed = part["mix"].to_numpy()
                for cell, at in part.groupby("cell").indices.items():
                    n, h = home_blocks[dim, cell], halo_blocks.get((dim, cell), 0)
                    own = mixed[at] % n
                    for other in range(n):
                        out.append((at, cell, np.minimum(own, other), np.maximum(own, other), (own > other).astype(int)))
                    for other in range(h):
                        out.append((at, cell, own, np.full(len(at), -1 - other), np.zeros(len(at), int)))
                row, across = halos(part, dim)
                for cell in np.unique(across):
                    at = row[across == cell]
                    b = -1 - mixed[at] % halo_blocks[dim, cell]
                    for a in range(home_blocks[dim, cell]):
                        out.append((at, cell, np.full(len(at), a), b, np.ones(len(at), int)))
                for at, cell, a, b, side in out:
                    p = part.iloc[at]
                    yield pd.DataFrame({"dim": np.int32(dim), "cell": np.int32(cell), "a": a.astype(np.int32), "b": b.astype(np.int32),
                                        "side": side.astype(np.int8), "class": p["class"].to_numpy(), "copies": p["copies"].to_numpy(), "v": p["v"].to_numpy()})

    def meet(key, pdf: pd.DataFrame) -> pd.DataFrame:
        """For each class of a task how many vectors it links with there, and one it is connected to."""
        pdf = pdf.sort_values(["side", "class"])
        name, copies, x = pdf["class"].to_numpy(), pdf["copies"].to_numpy(), matrix(pdf["v"])
        cut = int((pdf["side"].to_numpy() == 0).sum())
        if key[2] == key[3]:
            i, j = linked(x, x, least)
            i, j = i[i < j], j[i < j]
        else:
            i, j = linked(x[:cut], x[cut:], least)
            j = j + cut
        n = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        label = forest(len(x), i, j)
        at = np.flatnonzero(n)
        return pd.DataFrame({"class": name[at], "n": n[at].astype(np.int64), "to": name[label[at]]})

    dealt = homes.select("v", "class", "copies", "dim", "cell", F.pmod(F.xxhash64("class"), F.lit(1 << 30)).alias("mix")).mapInPandas(
        spread, f"{KEY}, side byte, class long, copies long, v {kind}")
    found = stored(dealt.groupBy("dim", "cell", "a", "b").applyInPandas(meet, "class long, n long, to long"), "vectors-links")
    counts = found.groupBy("class").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("class").alias("a"), F.col("to").alias("b")), "vectors").select(
        F.col("node").alias("class"), F.col("component").alias("group"))
    named = stored(classes.select("class", "doc").join(groups, "class"), "vectors-groups")
    least_id = named.groupBy("group").agg(F.min("doc").alias("component_id"))
    reached = named.join(least_id, "group").select("class", "component_id")
    known = stored(classes.join(counts, "class", "left").join(reached, "class", "left").select(
        "v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "doc").alias("component_id")), "vectors-known")
    linked_rows = good.join(known, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
