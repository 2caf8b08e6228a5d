"""URL filters by a cascade of Bloom filters: exact membership in a list of hosts, without a join."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from candlemill.llm.common import stored


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits, ``hashes`` positions a key, seeded by ``seed``."""

    words: list[int]
    hashes: int
    seed: int

    def positions(self, key: Column) -> Column:
        return F.array(*(F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(i)), F.lit(64 * len(self.words))) for i in range(self.hashes)))

    def has(self, key: Column) -> Column:
        """Whether all bits of the key are set; evaluated on a literal array."""
        bits = F.lit(self.words).cast("array<bigint>")
        word = lambda p: F.element_at(bits, F.shiftright(p, 6).cast("int") + 1)
        bit = lambda p: F.getbit(word(p), F.pmod(p, F.lit(64)).cast("int"))
        return F.forall(self.positions(key), lambda p: bit(p) == 1)


def sized(keys: int, others: int) -> tuple[int, int]:
    """(words, hashes) for ``keys`` keys so that about as many of ``others`` pass as there are keys, or one in ten."""
    rate = min(0.1, max(keys, 1) / max(others, 1))
    bits = max(64, math.ceil(-max(keys, 1) * math.log(rate) / math.log(2) ** 2))
    return -(-bits // 64), max(1, round(-math.log2(rate)))


def encode(keys: DataFrame, column: str, words: int, hashes: int, seed: int) -> Level:
    """A Bloom filter of a column, its bits put together by Spark; at most ``words`` numbers reach the driver."""
    empty = Level([0] * words, hashes, seed)
    at = keys.select(F.explode(empty.positions(F.col(column))).alias("p"))
    rows = at.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))).alias("bits")).collect()
    filled = dict((r["w"], r["bits"]) for r in rows)
    return Level([filled.get(k, 0) for k in range(words)], hashes, seed)


def member(levels: list[Level], key: Column) -> Column:
    """The cascade's answer for a key of the universe: it is listed if it first misses a level of even depth, from 1."""
    answer = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels), 0, -1):
        answer = F.when(levels[depth - 1].has(key), answer).otherwise(F.lit(depth % 2 == 0))
    return answer


def cascade(universe: DataFrame, listed: list[str], column: str = "key") -> list[Level]:
    """Bloom filters by which ``member`` is exact for every key of ``universe``.

    Level 1 holds the listed keys; level 2 the other keys of the universe that pass level 1; level 3 the listed ones
    that pass level 2, and so on until none passes wrongly. The first filter lets through about as many keys as are
    listed, so the filters' size follows the list, and only by the logarithm the universe. A key outside the universe
    may be judged wrongly: the universe has to be the corpus's own.
    """
    universe = stored(universe.select(column).where(F.col(column).isNotNull()).distinct(), "filter-universe")
    inside = F.col(column).isin(listed)
    held, other = universe.where(inside), universe.where(~inside)
    sizes = universe.agg(F.count(F.when(inside, 1)).alias("held"), F.count(F.when(~inside, 1)).alias("other")).first()
    n_held, n_other, levels = sizes["held"], sizes["other"], []
    while n_held:
        words, hashes = sized(n_held, n_other)
        levels.append(encode(held, column, words, hashes, len(levels)))
        passed = stored(other.where(levels[-1].has(F.col(column))), "filter-passed")
        held, other = passed, held
        n_held, n_other = passed.count(), n_held
    return levels


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty where the url is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", ""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all domains above it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; ``rules`` are (verdict, domain and path prefix)."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):  # a longer rule stands outside and is asked first
        domain, _, prefix = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(f"/{prefix}"))
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(kind)).otherwise(verdict)
    return found, verdict


def judged(pages: DataFrame, rules: list[tuple[str, str]], blocked: list[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    The longest fitting rule decides; where none fits, a page is blocked if its host or a domain above it is one of
    ``blocked``, by the cascade over all hosts and domains of these pages. A null url, or one without ``://``, has an
    empty host and path and is allowed. Repeated rows and null ids stay; other columns are ignored; an empty table
    gives no rows.
    """
    host, path = parts(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    hosts = rows.select("host").distinct()
    levels = cascade(hosts.select(F.explode(suffixes(F.col("host"))).alias("key")), blocked)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    listed = F.exists(suffixes(F.col("host")), lambda key: member(levels, key)) if levels else F.lit(False)
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(listed, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
