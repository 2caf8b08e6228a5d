"""Best-fit packing of tokenised documents by minimum bin slack."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from candlemill.llm.common import by_batch, shipped, stored
from candlemill.llm.tokens import chunks, lookup

shipped(__name__)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_bpe(ranks_path: str, pattern: str, added: dict[str, int] | None = None) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit numbers.

    Where a text holds one of the ``added`` tokens that is the token's id, and the text is cut there: what stands before
    and behind is encoded by itself. Without ``added`` every text is ordinary.
    """
    import tiktoken

    marks = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    cache: dict[str, bytes] = {}

    def ids_of(texts: list[str]) -> list[bytes]:
        return [np.array(bpe.encode_ordinary(t), "<u4").tobytes() for t in texts]

    def encode(text: str) -> bytes:
        if marks is not None and marks.search(text):
            parts, at = [], 0
            for found in marks.finditer(text):
                parts += [plain(text[at:found.start()]), np.array([added[found[0]]], "<u4").tobytes()]
                at = found.end()
            return b"".join([*parts, plain(text[at:])])
        return plain(text)

    def plain(text: str) -> bytes:
        cut = chunks(text)
        if cut is None:
            return ids_of([text])[0]
        return b"".join(ids_of([cut[0]]) + lookup(cache, cut[1], lambda some: ids_of([" " + c for c in some])))

    return encode


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, size: int = 2048, end_id: int = 0, added: dict[str, int] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document's ids followed by ``end_id``; the first piece of a long document is short.

    A null text counts as empty, so it has one piece that holds ``end_id`` alone. Texts are tokenised whole.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make():
        encode = byte_bpe(ranks_path, pattern, added)

        def step(doc_ids, texts):
            rows = []
            for doc_id, data in zip(doc_ids, texts):
                ids = encode((data or b"").decode("utf-8", "replace")) + end
                n = len(ids) // 4
                start, length = 0, n % size or min(n, size)
                piece = 0
                while start < n:
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                    start, piece, length = start + length, piece + 1, size
            return [list(c) for c in zip(*rows)] or [[]] * 5

        return step

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return by_batch(taken, make, PIECES, "doc_id", "text")


def fullest(counts: dict[int, int], size: int) -> dict[int, int]:
    """The multiset of available lengths with the longest one in it that leaves the least slack in a bin of ``size``.

    Bit s of ``reach`` says that some combination of the lengths taken so far sums to s; the sets after each item are
    kept to walk back. Long items come first, and the search ends as soon as the bin can be filled.
    """
    order = sorted(counts, reverse=True)
    first = order[0]
    room = size - first
    full, reach, steps = 1 << room, 1, []
    mask = (full << 1) - 1
    for length in order:
        if length > room:
            continue
        for _ in range(min(counts[length] - (length == first), room // length)):
            more = reach | (reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
            if reach & full:
                break
        if reach & full:
            break
    used, left = {first: 1}, reach.bit_length() - 1
    for length, before in reversed(steps):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + 1
            left -= length
    return used


def bins(counts: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: items}) that together use up ``counts``: minimum bin slack bin by bin, longest item first.

    The same combination is used as often as its lengths last, so the work depends on the number of different lengths
    and not on the number of items.
    """
    counts, out = {k: n for k, n in counts.items() if n}, []
    while counts:
        used = fullest(counts, size)
        times = min(counts[k] // n for k, n in used.items())
        out.append((times, used))
        for k, n in used.items():
            counts[k] -= times * n
            if not counts[k]:
                del counts[k]
    return out


def packed(pieces: DataFrame, size: int = 2048, rows: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces: as few sequences of at most ``size`` tokens as minimum bin slack finds.

    The bins are planned on the histogram of lengths, which has at most ``size`` rows whatever the input. Pieces of one
    length are told apart by their rank only; ranks are counted inside salted parts of about ``rows`` pieces, so a
    length that a third of all pieces share is dealt out too.
    """
    salts = max(16, pieces.count() // rows)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    parts = stored(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "packing-parts")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    first, plan, sequence = {}, {}, 0
    for times, used in bins(counts, size):
        offset = 0
        for length, n in used.items():
            at = first.get(length, 0)
            plan.setdefault(length, []).append((at, sequence, n, offset))
            first[length], offset = at + times * n, offset + n * length
        sequence += times
    plan = {length: np.array(steps, dtype=np.int64).T for length, steps in plan.items()}

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy() - 1
            sequence_id, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                begin, base, n, start = plan[value]
                k = np.searchsorted(begin, rank[at], side="right") - 1
                inside = rank[at] - begin[k]
                sequence_id[at], offset[at] = base[k] + inside // n[k], start[k] + inside % n[k] * value
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence_id), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within)).join(bases, ["length", "salt"])
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")).mapInArrow(
        place, f"{PIECES}, sequence_id long, offset long")


def best_fit(docs: DataFrame, ranks_path: str, pattern: str, size: int = 2048, end_id: int = 0, added: dict[str, int] | None = None,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every document with all its tokens and ``end_id`` is placed; only one longer than ``size`` is cut. A text that holds
    one of the ``added`` tokens has its id there. Null ids are
    kept as they are, repeated rows are packed as often as they occur, other columns are ignored, and an empty table
    gives no rows.
    """
    return packed(stored(token_pieces(docs, ranks_path, pattern, size, end_id, added, id_col, text_col), "packing-pieces"), size)
