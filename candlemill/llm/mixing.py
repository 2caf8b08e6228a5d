"""Mixing sources to target weights: documents in a random order of their source, cut where the budget ends."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, prefix_sums, shipped, stored

shipped(__name__)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, key, tie, size): the words of the whole text, and the keys of a random order that reruns repeat.

    The key is drawn from the id, ``tie`` from the text, so that rows that repeat an id have an order too.
    """
    taken = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                        F.col(f"`{text_col}`").alias("text"))
    drawn = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 15), 16, 10).cast("long")

    def step(ids, sources, keys, ties, texts):
        return [ids, [None if s is None else s.decode("utf-8", "replace") for s in sources], keys, ties, [len((t or b"").split()) for t in texts]]

    ready = taken.withColumns({"key": drawn, "tie": F.xxhash64("text")})
    return by_batch(ready, lambda: step, "doc_id long, source string, key long, tie long, size long", "doc_id", "source", "key", "tie", "text")


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], epochs: int) -> DataFrame:
    """(source, source_size, target, budget): the words that each source should give, and that number cut to whole words.

    ``sources``: (source, source_size). They weigh ``weights``, repeating, in the order of their names by code point,
    null last, and share ``share`` (a fraction) of all words. What a source would get beyond ``epochs`` times its size goes
    to the others by weight, until none is above. A round is one sum over the table: the level (words for each unit of
    weight) only rises, so the last round's level tells which sources are full. All is counted in whole parts of a word.
    """
    order = sources.withColumns({"missing": F.col("source").isNull().cast("int"), "every": F.lit(0), "one": F.lit(1).cast("long")})
    ranked = prefix_sums(order, "every", ["missing", "source"], "one", "mixing-ranked")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    table = stored(ranked.select("source", "source_size", weight.cast("decimal(20,0)").alias("weight")), "mixing-sources")
    part = share[1]
    most = F.col("source_size").cast("decimal(20,0)") * F.lit(part * epochs).cast("decimal(10,0)")
    whole = lambda n: F.lit(str(n)).cast("decimal(20,0)")
    rest, over, before = 0, 1, -1
    while True:
        full = most * whole(over) < whole(rest) * F.col("weight")
        sums = table.agg(F.sum("source_size").alias("size"), F.sum(F.when(full, most)).alias("full"),
                         F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count(F.when(full, 1)).alias("n")).first()
        if sums["n"] == before:
            break
        before, rest, over = sums["n"], (sums["size"] or 0) * share[0] - int(sums["full"] or 0), int(sums["weight"] or 0)
        if not over:
            full = F.lit(True)
            break
    above = F.when(full, most).otherwise(whole(rest) * F.col("weight")).cast("decimal(38,0)")
    below = F.when(full, F.lit(part)).otherwise(F.lit(part * max(over, 1))).cast("decimal(20,0)")
    return (table.select("source", "source_size", above.alias("above"), below.alias("below"))
            .select("source", "source_size", (F.col("above").cast("double") / F.col("below").cast("double")).alias("target"), F.expr("above div below").alias("budget")))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), epochs: int = 2,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted).

    A source's documents stand in a random order that depends on id and text alone. The source is gone through as often
    as its budget holds it whole; in the last round documents are taken in that order until the budget is used up, the
    last one in part. So each source gives its target, cut to a whole number of words, and no document more than
    ``epochs`` times its size.

    Null and wordless texts have size 0 and give 0. A null source is a source of its own, a null id a document like any
    other. Rows that are equal in id, text and source are documents of their own, and any of them may be the one that is
    cut. Other columns are ignored; an empty table, or a source without a word, takes nothing.
    """
    sized = stored(sizes(docs, id_col, text_col, source_col), "mixing-sizes")
    placed = stored(prefix_sums(sized, "source", ["key", "doc_id", "tie"], "size", "mixing-order"), "mixing-placed")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    goals = goals.select(F.col("source").alias("s"), "source_size", "target", "budget")
    rounds = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    left = F.col("budget") - rounds * F.col("source_size") - F.col("before")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(left, "size"))
    return placed.join(goals, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "tie")


def copies(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The mixture's texts: ``docs`` once for each time that ``mix`` (doc_id, tie, size, taken) takes it, with ``epoch``.

    A document that is taken in part ends after its last word taken. Documents of one id and text share their rows.
    """
    epoch = F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1))
    wanted = mix.where("taken > 0").select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "size", "taken").dropDuplicates(["d", "t"])
    wanted = wanted.withColumn("epoch", epoch)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    named = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("t")))
    n = F.least("size", F.col("taken") - F.col("epoch") * F.col("size"))

    def step(ids, sources, epochs, words, texts):
        out = []
        for n, text in zip(words, texts):
            end = 0
            for _, m in zip(range(n), WORD.finditer(text)):
                end = m.end()
            out.append(text[:end])
        return [ids, [None if s is None else s.decode("utf-8", "replace") for s in sources], epochs, [x.decode("utf-8", "replace") for x in out]]

    whole = named.where(n == F.col("size")).select("doc_id", "source", "epoch", "text")
    cut = named.where(n < F.col("size")).select("doc_id", "source", "epoch", n.alias("n"), "text")
    return whole.unionAll(by_batch(cut, lambda: step, "doc_id long, source string, epoch int, text string", "doc_id", "source", "epoch", "n", "text"))
