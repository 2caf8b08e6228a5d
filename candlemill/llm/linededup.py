"""Line dedup by a deletion-neighbourhood join: equal lines, and lines within one word edit of an earlier one."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, free, shipped, stored

shipped(__name__)

SALTS = 32  # parts of the lines that share a partner
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
BACK = np.uint64(pow(int(BASE), -1, 2**64))


def digest(data: bytes, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(data, seed) - 2**63


def end_keys(words: list[bytes], least: int) -> list[int]:
    """Keys of which two lines within one word edit of each other share one at least: some words of either end.

    An edit leaves either the first or the last words whole, as many as fit twice into the shorter line. How many is
    told by a power of two below the line's length, so it is the same for both lines unless a power lies between them; a
    line of that length has the keys of both numbers.
    """
    out, n = [], len(words)
    for size in (n, n - 1):
        width = max(1, 1 << max(0, size.bit_length() - 2))
        if size >= least and (size == n or width != 1 << max(0, n.bit_length() - 2)):
            out.append(digest(b"\n".join(words[:width]), 2 * width))
            out.append(digest(b"\n".join(words[n - width:]), 2 * width + 1))
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def variants(hashes: np.ndarray) -> np.ndarray:
    """Hashed keys of the deletion neighbourhood: the line itself, then the line without word 0, 1, 2 and so on."""
    n = len(hashes)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n])])
    # what follows the deleted word moves one place to the front
    keys = np.concatenate([sums[-1:], sums[:-1] + (sums[-1] - sums[1:]) * BACK])
    lengths = np.concatenate([[np.uint64(n)], np.full(n, np.uint64(n - 1))])
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + lengths
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


def one_edit(a: list[int], b: list[int]) -> bool:
    """Whether at most one word is put in, left out or exchanged between the sequences."""
    if abs(len(a) - len(b)) > 1:
        return False
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    k = 0
    while k < len(short) and short[k] == long[k]:
        k += 1
    return k == len(short) or short[k + (len(a) == len(b)):] == long[k + 1:]


def place(doc_id: str, version: str, line: str) -> F.Column:
    """A line's place as one number of fixed width, which hash aggregates can hold: id (null first), text, line number."""
    number = lambda c: F.col(c).cast("decimal(20,0)")
    doc = F.coalesce(number(doc_id), F.lit(str(-2**63 - 1)).cast("decimal(20,0)"))
    low = F.shiftrightunsigned(version, 33) * F.lit(2**31) + F.col(line)
    return (doc * F.lit(2**62).cast("decimal(19,0)")).cast("decimal(38,0)") + low.cast("decimal(20,0)")


def lines_of(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, version, line, more, h, keys, place) of all different lines of each document that have a word.

    ``version`` is a hash of the text, ``more`` holds the numbers of the same document's later lines with the same words,
    ``keys`` are there for lines of ``least`` words or more.
    """

    def step(ids, versions, texts):
        rows = []
        for doc_id, version, text in zip(ids, versions, texts):
            seen: dict = {}
            for k, line in enumerate((text or b"").split(b"\n")):
                words = line.split()
                if words:
                    h = digest(b" ".join(words))
                    if h in seen:
                        seen[h].append(k)
                    else:
                        seen[h] = more = []
                        rows.append((doc_id, version, k, more, h, end_keys(words, least) if len(words) >= least else None))
        made = [list(c) for c in zip(*rows)] or [[]] * 6
        made[3] = [m or None for m in made[3]]
        return made

    rows = by_batch(docs, lambda: step, "doc_id long, version long, line int, more array<int>, h long, keys array<long>", "doc_id", "version", "text")
    return rows.withColumn("place", place("doc_id", "version", "line").cast("decimal(38,0)"))


def near_lines(docs: DataFrame, first: DataFrame, lines: DataFrame) -> DataFrame:
    """(h) of the lines that lie within one word edit of an earlier line.

    ``first``: (h, at, n), the first place of each different line. Lines that share no key with another line have no
    partner, so only the others emit their deletion neighbourhoods. Lines that give the same key by leaving out the same
    position differ in that word alone, whatever their number; lines whose key is another line itself are one insertion
    from it. So the least place by (key, position) is a partner, and no pairs are formed.
    """
    keyed = lines.select("h", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("key")
    open_ = stored(keyed.join(shared, "key", "left_semi").select("h").distinct(), "lines-open")
    heads = stored(first.join(open_, "h", "left_semi").select("h", "at"), "lines-heads")
    wanted = lines.join(heads, "h").where("place = at").select("doc_id", "version", F.struct("line", "h").alias("w"))
    wanted = wanted.groupBy("doc_id", "version").agg(F.collect_set("w").alias("wanted"))  # of one document

    def step(texts, wanted):
        rows = []
        for text, some in zip(texts, wanted):
            split = (text or b"").split(b"\n")
            for w in some:
                hashes = word_hashes(split[w["line"]].split())
                rows.append((w["h"], variants(hashes), hashes.view(np.int64)))
        return [list(c) for c in zip(*rows)] or [[]] * 3

    texts = docs.join(wanted.withColumnsRenamed({"doc_id": "d", "version": "v"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")))
    # a document that occurs twice gives its lines twice; the rows are equal
    some = stored(by_batch(texts, lambda: step, "h long, variants array<long>, words array<long>", "text", "wanted"), "lines-words")
    each = stored(some.join(heads, "h").select("h", "at", F.posexplode("variants").alias("pos", "key")), "lines-variants")
    least = each.groupBy("key", "pos").agg(F.min("at").alias("least"), F.min("h").alias("low"), F.max("h").alias("high"))
    least = stored(least, "lines-least")
    # lines that differ in one word: the same key without the same position
    exchanged = each.join(least.where("pos > 0 AND low <> high").select("key", "pos", "least"), ["key", "pos"]).select("h", "at", "least")
    # a line and a longer one: the longer one's key is the line itself; most keys are neither
    itself = least.where("pos = 0").select("key", F.col("least").alias("whole"))
    longer = least.where("pos > 0").join(itself, "key").groupBy("key").agg(F.min("least").alias("longer"), F.min("whole").alias("whole"))
    longer = stored(longer, "lines-inserted")
    inserted = each.join(longer, "key").select("h", "at", F.when(F.col("pos") == 0, F.col("longer")).otherwise(F.col("whole")).alias("least"))
    pairs = exchanged.unionAll(inserted).where("least < at").groupBy("h").agg(F.min("least").alias("near"))
    # verify the edit distance on the words themselves
    words = some.select("h", "words").dropDuplicates(["h"])
    named = stored(pairs.join(heads.select(F.col("at").alias("near"), F.col("h").alias("near_h")), "near"), "lines-pairs")
    # many lines may have one partner: it is laid out as often as there are salts
    partners = words.join(named.select(F.col("near_h").alias("h")).distinct(), "h", "left_semi").select(
        F.col("h").alias("near_h"), F.col("words").alias("near_words"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = named.join(words, "h").withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int"))
    both = salted.join(partners, ["near_h", "salt"])

    def check(h, a, b):
        good = [k for k in range(len(h)) if one_edit(a[k], b[k])]
        return [[h[k] for k in good]]

    return stored(by_batch(both, lambda: check, "h long", "h", "words", "near_words").distinct(), "lines-near")


def judged(docs: DataFrame, least: int = 5) -> DataFrame:
    """(doc_id, version, drops, n_copies, n_near): the lines that go, of each document that loses one.

    ``docs``: (doc_id, version, text). A line with a word goes if an earlier one has the same words; one of ``least`` words
    or more also if an earlier line (of as many) is one word edit away.
    """
    lines = stored(lines_of(docs, least), "lines")
    first = stored(lines.groupBy("h").agg(F.min("place").alias("at"), F.count("*").alias("n")), "lines-first")
    near = near_lines(docs, first, lines)
    # most lines occur once and go nowhere
    told = first.where("n > 1").select("h", "at").join(near.withColumn("near", F.lit(True)), "h", "full").select("h", "at", F.coalesce("near", F.lit(False)).alias("near"))
    later = lines.join(told, "h").where("near OR place > at").select("doc_id", "version", "near", F.concat(F.array("line"), F.coalesce("more", F.array())).alias("drop"))
    own = lines.where("more IS NOT NULL").join(told.select("h", "at", "near"), "h", "left").where("NOT coalesce(near, false) AND (at IS NULL OR place = at)").select(
        "doc_id", "version", F.lit(False).alias("near"), F.col("more").alias("drop"))
    gone = later.unionAll(own).distinct()  # rows that repeat an id and text
    size = F.size("drop")
    return gone.groupBy("doc_id", "version").agg(
        F.flatten(F.collect_list("drop")).alias("drops"), F.sum(F.when(~F.col("near"), size).otherwise(0)).alias("n_copies"),
        F.sum(F.when(F.col("near"), size).otherwise(0)).alias("n_near"))


def deduped(docs: DataFrame, least: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines taken out of the text, and n_lines, n_copies, n_near.

    Lines are cut at line feeds and compared as sequences of words, so white space doesn't matter. A line goes if an
    earlier one has the same words, or, from ``least`` words on, can be had from it by putting in, leaving out or
    exchanging one word; earlier is by document id, then line number. Lines without a word stay. The bound holds between
    lines as they were, so in a chain of edits each goes that has an earlier neighbour.

    A null text stays null and one without lines to drop stays as it is. A null id is earlier than all others. Rows that
    repeat an id and text are one document and keep the same lines; rows that share an id only are in the order of a hash
    of their texts. Columns of other names are passed on, but for any called n_lines, n_copies or n_near, which these
    replace; an empty table gives no rows.
    """
    made = ("n_lines", "n_copies", "n_near")
    extra = [c for c in docs.columns if c not in (id_col, text_col, *made)]
    text = F.col(f"`{text_col}`")
    d, v, drops, copies, near, own = free(docs, "gone_doc", "gone_version", "gone_lines", "gone_copies", "gone_near", "own_version")
    rows = docs.withColumn(own, F.xxhash64(text))
    taken = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(own).alias("version"), text.alias("text"))
    gone = judged(taken, least).withColumnsRenamed({"doc_id": d, "version": v, "drops": drops, "n_copies": copies, "n_near": near})
    joined = rows.join(gone, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(d)) & (F.col(own) == F.col(v)), "left")
    split = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(drops))  # by a hash set, of one text's lines
    kept = F.array_join(F.transform(left, lambda k: F.element_at(split, k + 1)), "\n")
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return joined.select(F.col(f"`{id_col}`"), F.when(F.col(drops).isNull(), text).otherwise(kept).alias(text_col), *(F.col(f"`{c}`") for c in extra),
                         F.coalesce(feeds + 1, F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(copies, F.lit(0)).cast("long").alias("n_copies"), F.coalesce(near, F.lit(0)).cast("long").alias("n_near"))
