"""Quality rules: base counts, and divergence of a text's histograms from those of its language."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, shipped, stored, versioned, without

shipped(__name__)

# Frequent function words of the languages, and the bytes of each character class.
COMMON = {
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "en": "the of and to in a is that for it was on as with by be he at are this from have or not an which his but they what",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ha me si mi",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont aux avec son ou",
}
SYMBOLS = b"#*$%&|<>"
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?", b"'\"()[]{}-_/\\", SYMBOLS, b" ", b"\n",
           b"\t\r\x0b\x0c", bytes(range(0xC0, 0x100)))
LOWER, UPPER, WIDE = 0, 1, 9  # a wide character is one of more than one byte
OTHER = len(CLASSES)  # class of all other bytes; what continues a character counts for nothing

_CLASS = np.full(256, OTHER, dtype=np.int64)
for _k, _members in enumerate(CLASSES):
    _CLASS[list(_members)] = _k
_CLASS[0x80:0xC0] = OTHER + 1
_EDGE = b".,;:!?'\"()[]{}-_/\\" + SYMBOLS
_LIST = [(lang, word.encode()) for lang, words in COMMON.items() for word in words.split()]
_SLOTS = {w: [k for k, (_, x) in enumerate(_LIST) if x == w] for _, w in _LIST}
_MIX = np.random.default_rng(8).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated(ids: np.ndarray, width: int = 8) -> int:
    """How many words lie in a window of ``width`` words that occurs twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    wide = ids.astype(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        mixed += wide[k:k + n] * _MIX[k]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, width)
    a, b = order[:-1][same], order[1:][same]
    if (windows[a] == windows[b]).all():
        twice = np.union1d(a, b)
    else:  # two windows share a mixed value
        _, group, size = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(size[group.ravel()] > 1)
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + width, -1)
    return int((np.cumsum(cover) > 0).sum())


def measured(data: bytes | None) -> tuple[list[int], list[int], list[int]]:
    """The five counts, the histogram of character classes, and the counts of all common words and of the rest."""
    data = data or b""
    words = data.split()
    letters = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=OTHER + 2)
    spaces = int(letters[6:9].sum())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    common = [0] * (len(_LIST) + 1)
    for word, n in zip(index, np.bincount(ids, minlength=len(index)).tolist()):
        if len(word) < 12 and (slots := _SLOTS.get(word.strip(_EDGE).lower())):
            for k in slots:
                common[k] += n
    common[-1] = len(words)
    counts = [len(words), int(letters[:OTHER + 1].sum()) - spaces, int(letters[5]), len(lines) - len(set(lines)), repeated(ids)]
    return counts, letters[:OTHER + 1].tolist(), common


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, version, lang, counts, letters, common) of every whole text; null counts as empty."""

    def step(ids, versions, langs, texts):
        made = [measured(t) for t in texts]
        counts = list(zip(*(m[0] for m in made))) or [[]] * 5
        return [ids, versions, [x and x.decode() for x in langs], *counts, [m[1] for m in made], [m[2] for m in made]]

    taken = versioned(docs, id_col, text_col).select("doc_id", "version", F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    return by_batch(taken, lambda: step, f"doc_id long, version long, lang string, {COUNTS}, letters array<long>, common array<long>",
                    "doc_id", "version", "lang", "text")


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of p from q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(axis=-1)
        return np.sqrt(np.maximum(0, (kl(p) + kl(q)) / 2))


def shares(letters: np.ndarray, common: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows as distributions: over character classes, and over the language's common words and all other words."""
    own = common[:, [k for k, (x, _) in enumerate(_LIST) if x == lang]]
    words = np.concatenate([own, common[:, -1:] - own.sum(axis=1, keepdims=True)], axis=1)
    return letters / np.maximum(1, letters.sum(axis=1, keepdims=True)), words / np.maximum(1, common[:, -1:])


def references(measured_docs: DataFrame, min_words: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The mean distributions of each language, over all documents labelled with it that have ``min_words`` words.

    Sums are taken in the tasks and added up by Spark; at most one row for each number of a language's two histograms
    reaches the driver.
    """
    import pandas as pd

    def sums(frames):
        for pdf in frames:
            for lang, part in pdf[pdf["n_words"] >= min_words].groupby("lang"):
                if lang in COMMON:
                    p, q = shares(np.stack(part["letters"]).astype(float), np.stack(part["common"]).astype(float), lang)
                    total = np.concatenate([p.sum(axis=0), q.sum(axis=0), [len(part)]])
                    yield pd.DataFrame({"lang": lang, "k": np.arange(len(total)), "v": total})

    parts = measured_docs.select("lang", "n_words", "letters", "common").mapInPandas(sums, "lang string, k int, v double")
    found: dict[str, dict[int, float]] = {}
    for row in parts.groupBy("lang", "k").agg(F.sum("v").alias("v")).collect():
        found.setdefault(row["lang"], {})[row["k"]] = row["v"]
    out = {}
    for lang, values in found.items():
        total = np.array([values[k] for k in range(len(values))])
        mean = total[:-1] / total[-1]
        out[lang] = mean[:OTHER + 1], mean[OTHER + 1:]
    return out


def judged(docs: DataFrame, min_words: int = 50, letters_limit: tuple[float, float] = (0.2, 0.7),
           words_limit: tuple[float, float] = (0.2, 1.1), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    and with it judged (whether the method was asked), letters_distance, words_distance and nearest (the language they refer to); version is a hash of the text.

    ``base_failed``: fewer than 20 words, or more than 30 % of them in repeated 8-word windows. A document with
    ``min_words`` words that passes is held against the language whose references are nearest, and rejected if the
    Jensen-Shannon distance of its character classes or of its common words is over the limit. A limit is (a, b), for
    n words a + b / sqrt(n): short texts scatter more. The label is asked for nothing but the references' means. Not judged,
    and kept, are shorter texts and those in another script than the references': with more wide characters than Latin
    letters. A null text counts as empty (all zero, rejected); null ids, null languages and repeated rows
    stay; an empty table gives no rows.
    """
    import pandas as pd

    rows = stored(measures(docs, id_col, text_col, lang_col), "quality-measures")
    known = references(rows, min_words)
    names = sorted(known)
    fields = [f.split()[0] for f in COUNTS.split(", ")]

    def verdicts(frames):
        for pdf in frames:
            out = pdf[["doc_id", "version", *fields]].copy()
            n = pdf["n_words"].to_numpy(float)
            out["base_failed"] = (n < 20) | (100 * pdf["n_repeat_words"] > 30 * n)
            a = b = np.full(len(pdf), np.nan)
            nearest = np.full(len(pdf), None, dtype=object)
            if names and len(pdf):
                letters, common = np.stack(pdf["letters"]).astype(float), np.stack(pdf["common"]).astype(float)
                both = [shares(letters, common, x) for x in names]
                la = np.stack([js_distance(p, known[x][0]) for x, (p, _) in zip(names, both)])
                wo = np.stack([js_distance(q, known[x][1]) for x, (_, q) in zip(names, both)])
                best = (la ** 2 + wo ** 2).argmin(axis=0)
                at = np.arange(len(pdf))
                a, b, nearest = la[best, at], wo[best, at], np.array(names, dtype=object)[best]
            root = np.sqrt(np.maximum(n, 1))
            far = (a > letters_limit[0] + letters_limit[1] / root) | (b > words_limit[0] + words_limit[1] / root)
            latin = np.array([x[LOWER] + x[UPPER] >= x[WIDE] for x in pdf["letters"]], dtype=bool)
            out["judged"] = (n >= min_words) & latin & bool(names)
            out["kept"] = ~(out["base_failed"] | out["judged"] & far)
            out["letters_distance"], out["words_distance"], out["nearest"] = a, b, nearest
            yield out

    return rows.mapInPandas(verdicts, f"doc_id long, version long, {COUNTS}, base_failed boolean, judged boolean, kept boolean, "
                                      "letters_distance double, words_distance double, nearest string")


def accepted(docs: DataFrame, **limits) -> DataFrame:
    """The documents (doc_id, text, lang and any other columns) that ``judged`` keeps."""
    return without(docs, judged(docs, **limits).where("NOT kept"))
