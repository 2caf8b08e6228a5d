"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, first_by_hash, shipped, stored, versioned, without
from candlemill.llm.likeness import alike, band_keys, shingles
from candlemill.llm.tokens import lookup

shipped(__name__)

EDGE = ".,;:!?'\"()[]{}-_/\\#*$%&|<>"
STEMS = range(4, 10)  # the beginning of so many characters of a longer word is a term too
ALIKE = 0.8  # five-word Jaccard of near copies
FEW = 10_000  # ids that go to the tasks with the plan
TASK = 8192  # documents that a task searches for
SPAN = 512  # terms whose counts travel together


def terms_of(word: str) -> tuple[str, ...]:
    """The terms that a white-space separated word stands for: itself without punctuation, and its beginnings.

    The empty beginning, which all words share, weighs a text's length against its telling terms.
    """
    word = word.lower().strip(EDGE)
    return ("~", word, *(word[:k] + "~" for k in STEMS if len(word) > k)) if word else ()


def text_of(data: bytes | None) -> str:
    return (data or b"").decode("utf-8", "replace")


class Kept:
    """Texts of one label of which no two are near copies, found again by their minhash bands and compared whole."""

    def __init__(self) -> None:
        self.sets: list[np.ndarray] = []
        self.at: dict[int, list[int]] = {}

    def keys(self, hashes: np.ndarray) -> list[int]:
        return band_keys(hashes).tolist() or [0]  # texts without a word are copies of each other

    def near(self, hashes: np.ndarray) -> bool:
        return any(alike(hashes, self.sets[k], ALIKE) for k in {k for key in self.keys(hashes) for k in self.at.get(key, ())})

    def add(self, hashes: np.ndarray) -> None:
        for key in self.keys(hashes):
            self.at.setdefault(key, []).append(len(self.sets))
        self.sets.append(hashes)


def examples(docs: DataFrame, labels: DataFrame, train: F.Column, per_label: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """(doc_id, label) of the sample, without near copies, and the number of training rows of each label.

    In the order of a hash of the id, a row is taken unless a taken one of its label is a near copy of it (five-word
    Jaccard of ``ALIKE`` or more), until ``per_label`` of a label are held or the label runs out. The driver holds the
    shingles of the taken rows; of later rows the executors return only ids that are near to none of those.
    """
    held = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = stored(docs.select("doc_id").where(train).join(held, "doc_id").distinct(), "toxicity-train")
    taken, totals = first_by_hash(known, "label", 2 * per_label)
    first = taken.select("doc_id", "label", F.xxhash64("doc_id").alias("h")).collect()  # 4 * per_label rows at most
    sample = []

    def take(label: int, held: Kept, ids: list[int]) -> None:
        texts = docs.where(F.col("doc_id").isin(ids))
        made = by_batch(texts, lambda: lambda i, v, t: [i, v, [shingles(x).tobytes() for x in t]], "doc_id long, version long, s binary", "doc_id", "version", "text")
        found = {r["doc_id"]: bytes(r["s"]) for r in sorted(made.collect(), key=lambda r: r["version"] or 0, reverse=True)}
        for doc_id in ids:
            hashes = np.frombuffer(found[doc_id], np.uint64)
            if len(held.sets) < per_label and not held.near(hashes):
                held.add(hashes)
                sample.append((doc_id, label))

    h = F.xxhash64("doc_id")
    for label, total in sorted(totals.items()):
        kept, last, width = Kept(), (-2**63, -2**63), 4 * per_label * 2**64 // total + 1
        batch = sorted((r["h"], r["doc_id"]) for r in first if r["label"] == label)
        while True:
            for at in range(0, len(batch), per_label):
                if len(kept.sets) < per_label:
                    take(label, kept, [doc_id for _, doc_id in batch[at:at + per_label]])
            last = max([last, *batch[-1:]])
            if len(kept.sets) >= per_label or total <= 2 * per_label or last[0] >= 2**63 - 1:
                break
            # the next part of the order, twice as wide each time
            end, width = min(2**63 - 1, last[0] + width), 2 * width
            inside = (h <= F.lit(end)) & ((h > F.lit(last[0])) | (h == F.lit(last[0])) & (F.col("doc_id") > F.lit(last[1])))
            part = known.where((F.col("label") == label) & inside).select("doc_id")
            # few ids are looked up where the texts are read; of more, only the same part of the order is shuffled
            few = part.limit(FEW + 1).collect()
            texts = docs.where(train & inside)
            texts = texts.where(F.col("doc_id").isin([r["doc_id"] for r in few])) if len(few) <= FEW else texts.join(part, "doc_id", "left_semi")

            def other(ids, texts, kept=kept):
                return [[i for i, t in zip(ids, texts) if not kept.near(shingles(t))]]

            rows = by_batch(texts, lambda f=other: f, "doc_id long", "doc_id", "text").distinct().select(h.alias("h"), "doc_id").orderBy("h", "doc_id").limit(per_label).collect()
            batch = [(r["h"], r["doc_id"]) for r in rows]
            if len(batch) < per_label:
                last = (end, 2**63 - 1)
    return sample, totals


def telling(a: F.Column, b: F.Column, n1: int, n0: int) -> F.Column:
    """How many standard errors lie between a term's rates in two groups of n1 and n0 texts, of which a and b have it.

    Each rate has the error of its own group, so a term that one group alone has is judged by how many of that group have
    it, whatever the other group's size.
    """
    p, q = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
    return F.abs(p - q) / F.sqrt(p * (1 - p) / n1 + q * (1 - q) / n0)


def vocabulary(docs: DataFrame, sample: list[tuple[int, int]], least: float) -> list[str]:
    """All terms of the sample whose rates in the two labels lie ``least`` standard errors or more apart, and "~"."""
    label = dict(sample)
    texts = docs.where(F.col("doc_id").isin(list(label)))

    def count(batches):
        """How many toxic and other texts have a term, in one task."""
        have = (Counter(), Counter())
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have[label[i]].update({t for w in set(text_of(x).split()) for t in terms_of(w)})
        terms = list(have[0] | have[1])
        for at in range(0, len(terms), 10_000):
            some = terms[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *(pa.array([have[k][t] for t in some], pa.int64()) for k in (1, 0))], names=["term", "a", "b"])

    seen = texts.select("doc_id", F.col("text").cast("binary")).mapInArrow(count, "term string, a long, b long")
    n1, n0 = sum(label.values()), len(label) - sum(label.values())
    both = seen.where("term <> '~'").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return ["~", *sorted(r["term"] for r in both.where(telling(F.col("a"), F.col("b"), n1, n0) >= least).select("term").collect())]


def frequencies(rows: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many rows each of ``size`` terms occurs, and the number of rows; a task sends one count for each term."""

    def count(batches):
        seen, n = np.zeros(size, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            seen += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        counts = np.append(seen, n)
        for at in range(0, size + 1, SPAN):
            part = counts[at:at + SPAN]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part.astype("<i8").tobytes()])], names=["at", "counts"])

    def add(key, pdf):
        return pd.DataFrame({"at": [key[0]], "counts": [np.sum([np.frombuffer(c, "<i8") for c in pdf["counts"]], axis=0).tobytes()]})

    total = np.zeros(size + 1, np.int64)
    for r in rows.select("terms").mapInArrow(count, "at int, counts binary").groupBy("at").applyInPandas(add, "at int, counts binary").collect():
        part = np.frombuffer(r["counts"], "<i8")
        total[r["at"]:r["at"] + len(part)] = part
    return total[:-1], int(total[-1])


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, version, terms, counts) of every whole text: which terms of the vocabulary it has, and how often."""

    def make():
        at = {t: k for k, t in enumerate(terms)}
        cache: dict = {}
        find = lambda words: [[at[t] for t in terms_of(w) if t in at] for w in words]

        def step(ids, versions, texts):
            out = []
            for data in texts:
                words = Counter(text_of(data).split())
                count: Counter = Counter()
                for n, found in zip(words.values(), lookup(cache, list(words), find)):
                    for k in found:
                        count[k] += n
                out.append(sorted(count.items()))
            return [ids, versions, [[k for k, _ in x] for x in out], [[n for _, n in x] for x in out]]

        return step

    return by_batch(docs, make, "doc_id long, version long, terms array<int>, counts array<int>", "doc_id", "version", "text")


def weighed(terms: list[int], counts: list[int], idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of unit length, for the given terms."""
    w = (1 + np.log(np.asarray(counts, float))) * idf[np.asarray(terms, int)]
    return w / np.sqrt((w * w).sum()) if len(w) else w


class Index:
    """Block-max inverted index: postings by term, cut at blocks of examples, with each term's greatest weight in a block."""

    def __init__(self, rows: list[tuple[list[int], np.ndarray]], n_terms: int, block: int = 64):
        self.n, self.block = len(rows), block
        self.blocks = -(-len(rows) // block)
        term = np.array([t for ts, _ in rows for t in ts], dtype=np.int64)
        example = np.repeat(np.arange(len(rows)), [len(ts) for ts, _ in rows])
        weight = np.concatenate([*(w for _, w in rows), np.zeros(0)])
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        cell = term[order] * self.blocks + self.example // block
        self.start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.top = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.top, cell, self.weight)
        self.top = self.top.reshape(n_terms, self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above zero, ties by position, and their cosines.

        Blocks are scored in the order of what they can reach at most, and no more once that is below the k-th best.
        """
        bound = weights @ self.top[terms]
        queue = np.argsort(-bound, kind="stable")
        ids, best = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 4
        while at < len(queue):
            if bound[queue[at]] <= 0 or len(best) == k and bound[queue[at]] < best[-1] - 1e-12:
                break
            take = queue[at:at + step]
            at, step = at + step, 2 * step
            cell = (terms[:, None] * self.blocks + take[None, :]).ravel()
            begin, size = self.start[cell], self.start[cell + 1] - self.start[cell]
            where = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            score = np.bincount(self.example[where], np.repeat(np.repeat(weights, len(take)), size) * self.weight[where], minlength=self.n)
            if without >= 0:
                score[without] = 0
            new = np.flatnonzero(score > 0)
            ids, best = np.concatenate([ids, new]), np.concatenate([best, score[new]])
            order = np.lexsort((ids, -best))[:k]
            ids, best = ids[order], best[order]
        return ids, best


def vote(similar: np.ndarray, labels: np.ndarray) -> float:
    """Share of toxic among the neighbours, each counting by its squared cosine."""
    w = similar ** 2
    return float((w * labels).sum() / w.sum()) if len(w) else 0.0


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve with a small ridge, by Newton steps."""
    X, b = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ b, -30, 30)))
        gradient = X.T @ (w * (p - y)) + 1e-3 * b
        step = np.linalg.solve((X * (w * p * (1 - p))[:, None]).T @ X + 1e-3 * np.eye(2), gradient)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(b[0]), float(b[1])


def scored(docs: DataFrame, labels: DataFrame, per_label: int = 1500, least: float = 2.5, k: int = 15) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, nearest, similarity, version (a hash of the text).

    Examples: at most ``per_label`` documents of each label of ``labels`` (doc_id, toxic), none with
    crc32(doc_id) mod 5 = 0, near copies within a label taken once and the sample filled up from further rows. Terms: all words and word beginnings of the examples whose
    rates in the two labels lie ``least`` standard errors or more apart; how many examples the other label has doesn't
    weigh in that. Their inverse document frequency is over all ``docs``.
    ``nearest`` are the ids of the up to ``k`` nearest examples and ``similarity`` their cosines: the evidence. The
    score is their vote on a curve fitted to the examples (each scored without itself), weighted to the labels' real
    shares. The sample, terms and index are bounded by the parameters; every text is scored whole.

    A null or empty text, or one without a word, has no neighbour and gets the curve's lowest score. Without
    examples of both labels the score is 1 or 0 by the only label there is, or 0. Null ids are scored and never
    examples; repeated rows stay; of two labels of one id toxic counts; other columns are ignored.
    """
    docs = versioned(docs).select("doc_id", "version", "text")
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    bucket = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    held_out = F.coalesce(bucket == 0, F.lit(False)).alias("held_out")
    sample, totals = examples(docs, labels, bucket != 0, per_label)
    if len({label for _, label in sample}) < 2:
        only = float(sample[0][1]) if sample else 0.0
        return docs.select("doc_id", held_out, F.lit(only).alias("score"), F.lit(int(only >= 0.5)).alias("predicted"),
                           F.lit(None).cast("array<bigint>").alias("nearest"), F.lit(None).cast("array<double>").alias("similarity"), "version")
    terms = vocabulary(docs, sample, least)
    rows = stored(vectors(docs, terms), "toxicity-vectors")
    seen, total = frequencies(rows, len(terms))
    idf = np.log((1 + total) / (1 + seen)) + 1
    own = {r["doc_id"]: r for r in rows.where(F.col("doc_id").isin([i for i, _ in sample])).collect()}
    # examples with the same leading term stand together, so a block's greatest weights are close to all its weights
    ready = sorted(((i, label, own[i]["terms"], weighed(own[i]["terms"], own[i]["counts"], idf)) for i, label in sample if i in own),
                   key=lambda r: (r[2][int(np.argmax(r[3]))] if len(r[3]) else -1, r[0]))
    ids, truth = np.array([r[0] for r in ready]), np.array([r[1] for r in ready], float)
    index = Index([(r[2], r[3]) for r in ready], len(terms))
    votes = np.zeros(len(ready))
    for at, (_, _, ts, ws) in enumerate(ready):
        if len(ts):
            near, cosine = index.nearest(np.array(ts), ws, k, without=at)
            votes[at] = vote(cosine, truth[near])
    share = {label: totals[label] / sum(totals.values()) for label in (0, 1)}
    weights = np.where(truth == 1, share[1] / truth.sum(), share[0] / (1 - truth).sum()) * len(truth)
    slope, base = logistic(votes, truth, weights)

    def judge(frames):
        for pdf in frames:
            score, nearest, similarity = np.zeros(len(pdf)), [], []
            for at, (ts, ns) in enumerate(zip(pdf["terms"], pdf["counts"])):
                near, cosine = index.nearest(np.asarray(ts, int), weighed(ts, ns, idf), k) if len(ts) else (np.zeros(0, int), np.zeros(0))
                score[at] = 1 / (1 + math.exp(-min(30.0, max(-30.0, slope * vote(cosine, truth[near]) + base))))
                nearest.append(ids[near])
                similarity.append(cosine)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "version": pdf["version"], "score": score, "predicted": (score >= 0.5).astype(np.int32),
                                "nearest": pd.Series(nearest, dtype=object), "similarity": pd.Series(similarity, dtype=object)})

    # a few numbers a row make few partitions of a large table: searching takes more time than reading
    made = rows.repartition(max(1, -(-total // TASK))).mapInPandas(judge, "doc_id long, version long, score double, predicted int, nearest array<long>, similarity array<double>")
    return made.select("doc_id", held_out, "score", "predicted", "nearest", "similarity", "version")


def accepted(docs: DataFrame, labels: DataFrame, **sizes) -> DataFrame:
    """The documents (doc_id, text and any other columns) that ``scored`` does not call toxic."""
    return without(docs, scored(docs, labels, **sizes).where("predicted = 1"))
