"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

import json
import tempfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from candlemill.llm import bytebpe, htmltext, langid, linededup, mixing, packing, prefixtrie, quality, simhash, toxicity, urlfilter, vectorcodes, vectors

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    """Register a query under its function's name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared_folder(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def shared_folder(spark: SparkSession) -> None:
    """Name a folder for written tables where the session has none; only a session on one machine may go without."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    done = linededup.deduped(table(spark, sf_dir, "documents"), least=5)
    return done.select("doc_id", "n_lines", "n_copies", "n_near", "text")


ORACLES["op1_line_dedup"] = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
    SELECT doc_id, CAST(k AS INTEGER) AS line, parts[k] AS raw,
           list_filter(regexp_split_to_array(parts[k], '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS k FROM split)),
long AS (SELECT doc_id, line, len(words) AS n, words, md5(array_to_string(words, ' ')) AS h FROM lines WHERE len(words) > 0),
firsts AS (SELECT h, min({'d': doc_id, 'l': line}) AS place, arg_min(words, doc_id) AS words, any_value(n) AS n FROM long GROUP BY h),
cuts AS (
    SELECT h, place, i, md5(array_to_string(words[:i - 1] || words[i + 1:], ' ')) AS v
    FROM (SELECT h, place, words, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= 5)),
same AS (SELECT v, i, min(place) AS least FROM cuts GROUP BY v, i HAVING count(*) > 1),
pairs AS (
    SELECT c.h, c.place, s.least FROM cuts c JOIN same s ON c.v = s.v AND c.i = s.i
    UNION ALL SELECT c.h, c.place, f.place FROM cuts c JOIN firsts f ON c.v = f.h AND f.n >= 5
    UNION ALL SELECT f.h, f.place, c.place FROM cuts c JOIN firsts f ON c.v = f.h AND f.n >= 5),
near AS (SELECT DISTINCT h FROM pairs WHERE least < place),
told AS (
    SELECT l.doc_id, l.line, n.h IS NOT NULL AS near, f.place < {'d': l.doc_id, 'l': l.line} AS copy
    FROM long l JOIN firsts f ON l.h = f.h LEFT JOIN near n ON n.h = l.h),
gone AS (
    SELECT doc_id, list(line) AS drops, count(*) FILTER (WHERE NOT near) AS n_copies, count(*) FILTER (WHERE near) AS n_near
    FROM told WHERE near OR copy GROUP BY doc_id)
SELECT s.doc_id, len(parts) AS n_lines, coalesce(n_copies, 0) AS n_copies, coalesce(n_near, 0) AS n_near,
       CASE WHEN drops IS NULL THEN text ELSE array_to_string(list_filter(parts, lambda x, k: NOT list_contains(drops, k)), chr(10)) END AS text
FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id
"""


@query
def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "kept")


@query
def op3_main_text(spark, sf_dir):
    return htmltext.main_texts(table(spark, sf_dir, "pages"))


@query
def op4_vectors(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


ORACLES["op4_vectors"] = """
WITH RECURSIVE sound AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""


@query
def op5_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents")).drop("version")


def ranks() -> tuple[str, str]:
    """The rank file and the pre-token pattern of the byte-level BPE."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def added_tokens() -> dict[str, int]:
    """The tokens that the tokenizers file adds to the vocabulary; it gives them their id wherever a text holds them."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


@query
def op6_byte_bpe(spark, sf_dir):
    return bytebpe.digests(table(spark, sf_dir, "documents"), *ranks())


@query
def op7_packing(spark, sf_dir):
    return packing.best_fit(table(spark, sf_dir, "documents"), *ranks(), size=2048, end_id=0, added=added_tokens())


@query
def op9_language(spark, sf_dir):
    return langid.predicted(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("version")


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
BLOCKED = [f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
           for top in ("com", "net", "org")]


@query
def op8_url_filter(spark, sf_dir):
    return urlfilter.judged(table(spark, sf_dir, "pages"), RULES, BLOCKED)


ORACLES["op8_url_filter"] = f"""
WITH rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
parts AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(r, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(r, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path
    FROM rest),
ruled AS (
    SELECT *, CASE WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                   WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                   WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                   WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
    FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN {" OR ".join(f"('.' || host) LIKE '%.{b}'" for b in BLOCKED)} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op11_vector_codes(spark, sf_dir):
    return vectorcodes.compressed(table(spark, sf_dir, "embeddings")).drop("label")


def codes_sql(rounds: int = 4) -> str:
    """The rounds written out: assignment by the least (distance, entry), then floored means of whole numbers."""
    steps = """,
near{k} AS (
    SELECT vec_id, p, min(CAST(xx + yy - 2 * list_dot_product(x, y) AS BIGINT) * 256 + e) AS best
    FROM parts JOIN book{k} USING (p) GROUP BY vec_id, p)"""
    means = """,
sums{k} AS (
    SELECT p, best % 256 AS e, j, CAST(floor(sum(CAST(x[j] AS BIGINT)) / count(*)) AS DOUBLE) AS m
    FROM near{k} JOIN parts USING (vec_id, p), range(1, 17) t(j) GROUP BY p, e, j),
means{k} AS (SELECT p, e, list(m ORDER BY j) AS y FROM sums{k} GROUP BY p, e),
book{n} AS (
    SELECT p, e, y, list_dot_product(y, y) AS yy
    FROM (SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM book{k} b LEFT JOIN means{k} m ON m.p = b.p AND m.e = b.e))"""
    return """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, p, x, list_dot_product(x, x) AS xx FROM (SELECT vec_id, p, v[p * 16 + 1:p * 16 + 16] AS x FROM kept, range(4) t(p))),
book0 AS (
    SELECT p, e, x AS y, xx AS yy FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 256)""" + "".join(
        steps.format(k=k) + (means.format(k=k, n=k + 1) if k < rounds else "") for k in range(rounds + 1)) + f""",
coded AS (
    SELECT vec_id, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id),
said AS (
    SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256
    FROM (SELECT p, e, j, y[j] AS c FROM book{rounds}, range(1, 17) t(j)))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), said
"""


ORACLES["op11_vector_codes"] = codes_sql()


@query
def op12_prefix_trie(spark, sf_dir):
    return prefixtrie.trie(*prefixtrie.spliced(prefixtrie.digested(table(spark, sf_dir, "conversations"))))


def crc_sql(text: str) -> str:
    """CRC-32 of ASCII text in SQL: each byte, then eight shifts (marked -1) through the reversed polynomial."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, x: "
            f"CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)")


ORACLES["op12_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS base, CAST({crc_sql("CAST(c AS VARCHAR)")} % 9 AS BIGINT) AS h FROM (SELECT DISTINCT c FROM turns)),
parts AS (
    SELECT v.c, 0 AS own, k, role, text FROM convs v JOIN turns t ON t.c = v.base WHERE k <= h
    UNION ALL SELECT v.c, 1, k, role, text FROM convs v JOIN turns t ON t.c = v.c WHERE k > h),
rebuilt AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, k) AS d, md5(role || chr(0) || text) AS t, strlen(text) AS bytes FROM parts),
prefixes AS (SELECT c, d, bytes, string_agg(t, ' ') OVER (PARTITION BY c ORDER BY d) AS p FROM rebuilt
             UNION ALL SELECT c, 0, 0, '' FROM convs),
ends AS (SELECT c, max(d) AS last FROM prefixes GROUP BY c),
nodes AS (
    SELECT p, d, min(f.c) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(bytes) AS saved,
           sha256(coalesce(string_agg(CAST(f.c AS VARCHAR), ',' ORDER BY f.c) FILTER (WHERE d = last), '')) AS ends_sha256
    FROM prefixes f JOIN ends e ON e.c = f.c GROUP BY p, d),
up AS (SELECT v.p, v.d, u.p AS above FROM nodes v JOIN prefixes u ON u.c = v.conv_id AND u.d = v.d - 1),
kids AS (SELECT above, count(*) AS n FROM up GROUP BY above),
full_nodes AS (SELECT v.*, coalesce(k.n, 0) AS n_children FROM nodes v LEFT JOIN kids k ON k.above = v.p),
sums AS (
    SELECT u.p, CAST(sum(v.saved) AS BIGINT) AS saved_tokens, CAST(count(*) FILTER (WHERE v.n_children = 0) AS BIGINT) AS n_leaves
    FROM full_nodes v JOIN prefixes u ON u.c = v.conv_id AND u.d <= v.d GROUP BY u.p)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, w.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM full_nodes v JOIN sums s ON s.p = v.p LEFT JOIN up ON up.p = v.p LEFT JOIN nodes w ON w.p = up.above
"""


@query
def op13_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op13_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) AS key,
           CAST(coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS BIGINT) AS size
    FROM documents),
sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source),
-- sources are full in the order of 2 * size / weight; level k leaves the first k of them full
steps AS (
    SELECT *, row_number() OVER fill AS k, 4 * source_size AS most,
           3 * sum(source_size) OVER () - coalesce(sum(4 * source_size) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS over
    FROM sums WINDOW fill AS (ORDER BY source_size / weight, source)),
level AS (SELECT rest, over FROM steps WHERE most * over >= rest * weight ORDER BY k LIMIT 1),
goals AS (
    SELECT source, source_size,
           CASE WHEN most * over_ < rest_ * weight THEN CAST(most AS DOUBLE) / 2 ELSE CAST(rest_ * weight AS DOUBLE) / CAST(2 * over_ AS DOUBLE) END AS target,
           CASE WHEN most * over_ < rest_ * weight THEN most // 2 ELSE (rest_ * weight) // (2 * over_) END AS budget
    FROM steps, (SELECT rest AS rest_, over AS over_ FROM level)),
placed AS (
    SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id) - size AS before FROM sized)
SELECT doc_id, size, source_size, target,
       CAST(budget // source_size * size + greatest(0, least(budget % source_size - before, size)) AS BIGINT) AS taken
FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source
"""
