"""Language identification in two steps: the family first, then linear support vector machines inside it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, first_by_hash, shipped

shipped(__name__)

# Language families by code; a language that isn't here is a family of its own.
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
DIM = 4096  # buckets of the hashed n-grams
NGRAMS = 4  # longest n-gram, in bytes


def features(data: bytes) -> np.ndarray:
    """Unit-length square roots of the counts of the hashed 1- to 4-byte n-grams of the whole text.

    Letters are lower-cased, every other ASCII character counts as a gap; so a four-byte n-gram with gaps is a word.
    """
    a = _FOLD[np.frombuffer(b" " + data + b" ", np.uint8)]
    a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])].astype(np.uint32)
    counts, mixed = np.zeros(DIM), np.zeros(len(a), np.uint32)
    for n in range(NGRAMS):
        if n >= len(a):
            break
        mixed = mixed[:len(a) - n] * np.uint32(0x01000193) + a[n:] + np.uint32(n)
        counts += np.bincount((mixed * np.uint32(0x9E3779B1)) >> np.uint32(20), minlength=DIM)
    counts = np.sqrt(counts)
    return (counts / np.sqrt((counts * counts).sum())).astype(np.float32)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 20) -> np.ndarray:
    """A linear support vector machine (squared hinge loss) by dual coordinate descent; the last weight is the bias.

    Classes weigh the same: an example's cost is c over its class's share.
    """
    n = len(y)
    cost = c * n / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    x = np.concatenate([x, np.ones((n, 1), np.float32)], axis=1)
    w, a = np.zeros(x.shape[1], np.float32), np.zeros(n)
    square = (x * x).sum(axis=1) + 1 / (2 * cost)
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(n):
            g = y[i] * float(x[i] @ w) - 1 + a[i] / (2 * cost[i])
            new = max(a[i] - g / square[i], 0.0)
            if new != a[i]:
                w += np.float32((new - a[i]) * y[i]) * x[i]
                moved = max(moved, abs(new - a[i]))
                a[i] = new
        if moved < 1e-3:
            break
    return w


class Tournament:
    """One-versus-one machines between names; the name with most wins, then with the greatest margins, is taken."""

    def __init__(self, x: np.ndarray, names: np.ndarray):
        self.names = sorted(set(names))
        self.duels, weights = [], []
        for i, one in enumerate(self.names):
            for j in range(i + 1, len(self.names)):
                at = np.flatnonzero((names == one) | (names == self.names[j]))
                weights.append(svm(x[at], np.where(names[at] == one, 1.0, -1.0)))
                self.duels.append((i, j))
        self.weights = np.array(weights, np.float32).reshape(len(weights), x.shape[1] + 1)

    def play(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the position of the name that wins, and how sure it is: its narrowest duel's logistic margin."""
        if len(self.names) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        wins, sums = np.zeros((len(x), len(self.names))), np.zeros((len(x), len(self.names)))
        narrowest = np.full((len(x), len(self.names)), np.inf)
        for k, (i, j) in enumerate(self.duels):
            for name, m in ((i, margin[:, k]), (j, -margin[:, k])):
                wins[:, name] += m > 0
                sums[:, name] += m
                narrowest[:, name] = np.minimum(narrowest[:, name], m)
        best = (wins + 1e-6 * np.tanh(sums)).argmax(axis=1)
        return best, 1 / (1 + np.exp(-3 * narrowest[np.arange(len(x)), best]))


def sample(docs: DataFrame, train: F.Column, per_lang: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and languages of at most ``per_lang`` documents of each language, those first by a hash of the id."""
    known = docs.where(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang").distinct()
    ids = first_by_hash(known, "lang", per_lang)[0].select("doc_id")
    ids = [r["doc_id"] for r in ids.collect()]  # per_lang for each language at most

    def step(_, langs, texts):
        rows = [(x.decode(), features(t).astype(np.float16).tobytes()) for x, t in zip(langs, texts)
                if t is not None and has_letter(t.decode("utf-8", "replace"))]
        return [[r[0] for r in rows], [r[1] for r in rows]]

    made = by_batch(docs.where(F.col("doc_id").isin(ids) & train & F.col("lang").isNotNull()), lambda: step, "lang string, x binary", "doc_id", "lang", "text")
    rows = made.orderBy("lang", "x").collect()
    x = np.array([np.frombuffer(r["x"], np.float16) for r in rows], np.float32).reshape(len(rows), DIM)
    return x, np.array([r["lang"] for r in rows], dtype=object)


def predicted(docs: DataFrame, per_lang: int = 1000) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from text and language of at most ``per_lang`` documents of each language, none of them with
    crc32(doc_id) mod 4 = 2; predicts from the whole text alone. ``score`` is how sure both steps are, 0 to 1. A text
    that is null or has no letter is ``und`` with score 0, and so is all without any labelled row. Null ids and
    repeated rows stay, other columns are ignored, an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    bucket = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    held_out = F.coalesce(bucket == 2, F.lit(False)).alias("held_out")
    x, langs = sample(docs, bucket != 2, per_lang)
    if not len(langs):
        return docs.select("doc_id", held_out, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    family = np.array([FAMILY_OF.get(code, code) for code in langs], dtype=object)
    families = Tournament(x, family)
    inside = [Tournament(x[family == f], langs[family == f]) for f in families.names]

    def make():
        def step(ids, texts):
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            at = [k for k, t in enumerate(texts) if t is not None and has_letter(t.decode("utf-8", "replace"))]
            if at:
                x = np.stack([features(texts[k]) for k in at])
                best, sure = families.play(x)
                for f, tournament in enumerate(inside):
                    rows = np.flatnonzero(best == f)
                    if len(rows):
                        own, also = tournament.play(x[rows])
                        for r, o, p in zip(rows, own, also):
                            lang[at[r]], score[at[r]] = tournament.names[o], sure[r] * p
            return [ids, lang, score.tolist()]

        return step

    made = by_batch(docs, make, "doc_id long, lang_pred string, score double", "doc_id", "text")
    return made.select("doc_id", held_out, "lang_pred", "score")
