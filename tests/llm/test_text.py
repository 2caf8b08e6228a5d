"""Quality, language, toxicity, tokens, packing, main text and URL filters: brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import collections
import hashlib
import html
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import lit
from tokenizers import Tokenizer

from candlemill.llm import bytebpe, htmltext, langid, packing, quality, tokens, toxicity, urlfilter
from candlemill.llm.common import versioned
from candlemill.llm.queries import BLOCKED, QUERIES, RULES, added_tokens, ranks

SF = "/root/testdata/sf0.01"
ODD = ["a   b\n\n c  ", None, "", " ", "\n ", "x \n  y\t z   ", "日本 語テスト 😀😀 ²³ ½ don't  we'LL", "a" * 5000, "ab " * 9 + "  ", "    x　 y",
       "<|endoftext|> hi", "   ", "a\n  b", "long " * 30_000]


def ids_by_file(ordinary):
    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = ordinary
    return lambda texts: [e.ids for e in out.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def tokenizer():
    """Ids of texts in which no token is special."""
    return ids_by_file(True)


@pytest.fixture(scope="module")
def by_default():
    """Ids as the file gives them: an added token that a text holds has its own id."""
    return ids_by_file(False)


def test_cuts_never_cross_a_pre_token():
    import regex

    matches = regex.compile(public_tokenizers.PATTERN).findall
    for text in map("".join, itertools.product(" \na1", repeat=6)):
        if cut := tokens.chunks(text):
            assert [p for c in [cut[0], *(" " + x for x in cut[1])] for p in matches(c)] == matches(text)


def test_byte_bpe_round_trip(spark, tokenizer):
    rows = list(enumerate(ODD)) + [(None, "again"), (0, ODD[0])]
    got = bytebpe.encoded(spark.createDataFrame(rows, "doc_id long, text string"), *ranks()).collect()
    want = dict(zip([i for i, _ in rows], tokenizer([t for _, t in rows])))
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == want[r.doc_id] and bytes(r.decoded).decode() == (dict(rows)[r.doc_id] or "")


def test_byte_bpe_digests_of_a_table(spark, docs, tokenizer):
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: (ids, r.text) for r, ids in zip(rows, tokenizer([r.text for r in rows]))}
    for r in bytebpe.digests(docs, *ranks()).collect():
        ids, text = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def check_packing(rows, got, tokenizer, size):
    ids = dict(zip([i for i, _ in rows], tokenizer([t for _, t in rows])))
    by_doc, by_bin = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append((r.offset, r.length))
    for doc_id, pieces in by_doc.items():
        all_ids, at = np.array([*ids[doc_id], 0], "<u4"), 0
        for k, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            assert (p.piece, p.start) == (k, at) and (k == 0 or p.length == size)
            assert p.ids_crc32 == zlib.crc32(all_ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(all_ids)
    for parts in by_bin.values():
        assert sum(n for _, n in parts) <= size
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(sorted(parts))) and min(parts)[0] == 0
    return len(by_bin)


def test_packing_is_gapless_and_tight(docs, by_default):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.best_fit(docs, *ranks(), added=added_tokens()).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    assert check_packing(rows, got, by_default, 2048) <= -(-sum(r.length for r in got) // 2048) + 1


def test_packing_odd_rows(spark, by_default):
    rows = list(enumerate([*ODD, "see <|endoftext|> here", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  \n <|endoftex|>" * 500]))
    got = packing.best_fit(spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece", lit("x")), *ranks(), size=512, added=added_tokens()).collect()
    check_packing(rows, got, by_default, 512)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = packing.best_fit(twice, *ranks()).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (1, 3), (1, 3)] and sorted(r.offset for r in got)[0] == 0
    assert packing.best_fit(twice.limit(0), *ranks()).count() == 0


def test_fullest_combination_is_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(150):
        counts = collections.Counter(rng.integers(1, 30, 6).tolist())
        size = int(rng.integers(30, 50))
        used = packing.fullest(dict(counts), size)
        first = max(counts)
        rest = list((counts - collections.Counter([first])).elements())
        best = max(s for n in range(len(rest) + 1) for c in itertools.combinations(rest, n) if (s := first + sum(c)) <= size)
        assert sum(k * n for k, n in used.items()) == best and all(n <= counts[k] for k, n in used.items()) and used[first]


def test_bins_use_up_all_items():
    rng = np.random.default_rng(4)
    counts = collections.Counter((rng.pareto(1.2, 20_000) * 60 + 1).astype(int).clip(1, 2048).tolist())
    plan = packing.bins(dict(counts), 2048)
    used = collections.Counter()
    for times, items in plan:
        used.update({k: n * times for k, n in items.items()})
    total = sum(k * n for k, n in counts.items())
    assert used == counts and sum(t for t, _ in plan) <= 1.02 * -(-total // 2048)


def test_quality_counts_are_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.judged(docs).collect():
        text = texts[r.doc_id]
        words, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", text), set(), 0
        count = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        cover = {k for i in range(len(words) - 7) if count[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup, seen = dup + (line in seen), seen | {line}
        failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed)
        assert not (r.kept and failed)


def test_quality_rejects_junk_and_keeps_clean(spark):
    got = quality.judged(spark.read.parquet(f"{SF}/documents.parquet")).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in got if r.quality == 1 and not r.base_failed], [r for r in got if r.quality == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) <= 0.05 * len(bad)


def test_quality_odd_rows(table):
    clean = "the cat of the house and a dog in that room is on it for this was with him as he by her at that "
    rows = [(1, None, None), (2, "", "en"), (3, clean * 1, "en"), (None, "x " * 400, None), (5, "¿qué? " * 3, "es"), (3, clean, "en"), (6, "||| ### " * 50, "it")]
    got = quality.judged(table(rows, "doc_id long, text string, lang string").withColumn("n_words", lit("clash"))).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [
        (0, 400, False), (1, 0, False), (2, 0, False), (3, 25, True), (3, 25, True), (5, 3, False), (6, 100, False)]
    assert quality.judged(table([], "doc_id long, text string, lang string")).count() == 0


def test_quality_does_not_ask_for_the_label(spark, table):
    """Junk is judged whatever it is labelled; texts in another script are passed on and say so."""
    clean = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    junk = "zxq kk vvv qqq xxz jjj wqk " * 2 + " ".join(f"{'xqzvkjw'[k % 7]}{'qkx'[k % 3]}zz{k}9" for k in range(200))
    cyrillic = " ".join("слово другое ещё раз текст номер".split()[k % 6] + "абвгдежзик"[k % 10] * (k % 4) + "а" * (k // 30) for k in range(120))
    rows = clean + [(90_001 + k, junk, lang) for k, lang in enumerate(["en", None, "xx"])] + [(90_010, cyrillic, "xx"), (90_011, cyrillic, "en")]
    got = {r.doc_id: (r.judged, r.base_failed, r.kept) for r in quality.judged(table(rows, "doc_id long, text string, lang string")).collect()}
    assert {got[90_001 + k] for k in range(3)} == {(True, False, False)} and {got[90_010], got[90_011]} == {(False, False, True)}


def test_js_distance():
    p, q = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0], [0.2, 0.3, 0.5]]), np.array([0.5, 0.5, 0.0])
    assert np.allclose(quality.js_distance(p, q)[:2], [0, 1]) and 0 < quality.js_distance(p, q)[2] < 1


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predicted(docs, per_lang=100).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97


def test_language_odd_rows(table):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the house and the dog", "en"), ("das haus und der hund", "de"), ("la maison et le chien", "fr")] * 30)]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !?", "en"), (None, "the dog and the house", None), (1003, "haus " * 50_000, None), (5, rows[5][1], "fr")]
    got = langid.predicted(table(rows, "doc_id long, text string, lang string").withColumn("score", lit("clash"))).collect()
    told = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == len(rows) and [told[k] for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert told[None][0] == "en" and told[1003][0] == "de"
    assert {(r.lang_pred, r.score) for r in langid.predicted(table([(1, "abc", None)], "doc_id long, text string, lang string")).collect()} == {("und", 0.0)}
    assert langid.predicted(table([], "doc_id long, text string, lang string")).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.scored(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out and (r.score >= 0.5) == r.predicted for r in got)
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    # some labels mark texts in which nothing of the kind is left; the others are found
    assert np.mean([r.predicted for r in held if r.toxic]) > 0.85 and np.mean([r.predicted for r in held if not r.toxic]) < 0.01


def test_block_max_search_is_exact():
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(700):
        terms = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        rows.append((terms.tolist(), toxicity.weighed(terms.tolist(), rng.integers(1, 5, len(terms)).tolist(), np.ones(60))))
    index = toxicity.Index(rows, 60, block=16)
    dense = np.zeros((700, 60))
    for k, (t, w) in enumerate(rows):
        dense[k, t] = w
    for k in range(0, 700, 9):
        near, cosine = index.nearest(np.array(rows[k][0]), rows[k][1], 10, without=k)
        want = dense @ dense[k]
        want[k] = 0
        best = np.sort(want)[::-1][:10]
        assert np.allclose(cosine, best[best > 0]) and np.allclose(want[near], cosine) and k not in near


def test_toxicity_examples_are_greedy_within_a_label(table):
    """A third of each text is one passage of both labels, and most texts of a label are near copies of a few."""
    rng = np.random.default_rng(4)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for i in range(400):
        own = np.random.default_rng(i % 8 if i % 4 else i).integers(0, 10**6, 80)
        rows.append((i, i % 2, " ".join([*passage, *(f"w{x}" for x in own), f"t{rng.integers(0, 10**6)}"])))
    docs = versioned(table([(i, t) for i, _, t in rows], "doc_id long, text string")).select("doc_id", "version", "text")
    order = [r.doc_id for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").collect()]
    grams = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, _, t in rows}
    for per_label in (20, 90, 1000):
        want = []
        for label in (0, 1):
            kept = []
            for i in order:
                if i % 2 == label and len(kept) < per_label and not any(10 * len(grams[i] & grams[k]) >= 8 * len(grams[i] | grams[k]) for k in kept):
                    kept.append(i)
            want += [(i, label) for i in kept]
        got, totals = toxicity.examples(docs, table([(i, y) for i, y, _ in rows], "doc_id long, toxic int"), F.lit(True), per_label)
        assert sorted(got) == sorted(want) and totals == {0: 200, 1: 200}


def plain_toxicity(rows, labels, k=15):
    """Scores of (doc_id, text) rows in plain Python: sample, terms, weights, cosines with all examples, votes, curve."""
    def terms(text):
        words = [w for x in text.split() if (w := x.lower().strip(toxicity.EDGE))]
        return collections.Counter(t for w in words for t in ("~", w, *(w[:n] + "~" for n in range(4, 10) if len(w) > n)))

    counts = {i: terms(t) for i, t in rows}
    grams = {i: {tuple(w[n:n + 5]) for n in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for i, t in rows}
    sample = []
    for label in (0, 1):
        kept = []
        for i, _ in rows:
            if labels.get(i) == label and zlib.crc32(str(i).encode()) % 5 and not any(10 * len(grams[i] & grams[x]) >= 8 * len(grams[i] | grams[x]) for x in kept):
                kept.append(i)
        sample += [(i, label) for i in kept]
    n1, n0 = sum(y for _, y in sample), sum(1 - y for _, y in sample)
    have = [collections.Counter(t for i, y in sample if y == side for t in counts[i]) for side in (1, 0)]
    used = {"~"}
    for t in have[0] | have[1]:
        p, q = (have[0][t] + 0.5) / (n1 + 1), (have[1][t] + 0.5) / (n0 + 1)
        if abs(p - q) >= 2.5 * (p * (1 - p) / n1 + q * (1 - q) / n0) ** 0.5:
            used.add(t)
    names = sorted(used)
    matrix = np.array([[counts[i][t] for t in names] for i, _ in rows], float)
    idf = np.log((1 + len(rows)) / (1 + (matrix > 0).sum(axis=0))) + 1
    matrix = np.where(matrix > 0, 1 + np.log(np.maximum(matrix, 1)), 0) * idf
    matrix /= np.maximum(np.sqrt((matrix ** 2).sum(axis=1, keepdims=True)), 1e-300)
    at = {i: n for n, (i, _) in enumerate(rows)}
    truth = np.array([y for _, y in sample], float)
    cosine = matrix @ matrix[[at[i] for i, _ in sample]].T

    def vote(row, without=None):
        row = row.copy()
        if without is not None:
            row[without] = 0
        least = np.sort(row)[::-1][:k].min()
        w = np.where((row >= max(least, 1e-12)), row ** 2, 0)
        return (w * truth).sum() / w.sum() if w.sum() else 0.0, (np.abs(row - least) < 1e-9).sum() > 1 and least > 0

    own = [vote(cosine[at[i]], n)[0] for n, (i, _) in enumerate(sample)]
    known = [y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5]
    share = np.mean(known)
    slope, base = toxicity.logistic(np.array(own), truth, np.where(truth == 1, share / truth.sum(), (1 - share) / (1 - truth).sum()) * len(truth))
    return {i: (1 / (1 + np.exp(-(slope * v + base))), tied) for (i, _), (v, tied) in zip(rows, map(vote, cosine))}


def test_toxicity_is_brute_force(table):
    rng = np.random.default_rng(12)
    rows, labels = [], {}
    for i in range(200):
        words = [f"w{x}" for x in rng.integers(0, 25, rng.integers(30, 90)) + rng.integers(0, 12) * (i % 5 == 0)]
        rows.append((i, " ".join(words)))
        if i < 150:
            labels[i] = int(i % 5 == 0)
    order = {r.id: k for k, r in enumerate(table([(i,) for i, _ in rows], "id long").orderBy(F.xxhash64("id"), "id").collect())}
    want = plain_toxicity(sorted(rows, key=lambda r: order[r[0]]), labels)
    got = toxicity.scored(table(rows, "doc_id long, text string"), table(list(labels.items()), "doc_id long, toxic int")).collect()
    clear = [r for r in got if not want[r.doc_id][1]]  # else neighbours are tied at the edge
    assert len(got) == 200 and len(clear) > 120 and all(abs(r.score - want[r.doc_id][0]) < 1e-6 for r in clear)


def test_toxicity_of_few_examples(table):
    """Twelve labelled texts of clearly different words are enough, and the terms don't depend on how many clean ones there are."""
    toxic, clean = ["you idiot and moron", "an idiot is a moron", "moron or idiot", "idiot moron scum", "such an idiot moron", "moron idiot you"], ["a nice day out"] * 60
    for many in (6, 60):
        rows = [(2 * k, t + f" x{k}") for k, t in enumerate(toxic * 2)] + [(2 * k + 1, t + f" y{k}") for k, t in enumerate(clean[:many] * 2)]
        docs, labels = table(rows + [(9001, "what a moron"), (9002, "a nice place")], "doc_id long, text string"), table([(i, 1 - i % 2) for i, _ in rows], "doc_id long, toxic int")
        got = {r.doc_id: r.predicted for r in toxicity.scored(docs, labels).collect()}
        assert got[9001] == 1 and got[9002] == 0


def test_toxicity_odd_rows(table):
    rows = [(k, "you are an idiot and a moron" if k % 2 else "a nice day with some friends", k % 2) for k in range(200)]
    docs = table([(k, t) for k, t, _ in rows] + [(900, None), (901, ""), (902, "idiot " * 40_000), (None, "moron"), (3, rows[3][1])], "doc_id long, text string")
    labels = table([(k, y) for k, _, y in rows] + [(5, None), (None, 1), (900, 0)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 205 and all(0 <= r.score <= 1 for r in got)
    none = toxicity.scored(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)} and len(none) == 205
    assert {r.score for r in toxicity.scored(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.scored(docs.limit(0), labels).count() == 0


PAGE = """<html><head><title>t</title></head><body class="home"><header><h1>Site</h1><nav><a href=x>Menu</a></nav></header>
<div id="wrap"><div class="sidebar"><p>Side text that is quite long for a bar, indeed longer than all of the rest</p></div>
<div class="post-{k}"><h1>Head &amp; line {k}</h1><p>One <b>two</b>three<p>four&nbsp;five<ul><li>a<li>b</ul><div class="ad-slot">BUY</div>
<form><input><label>Name</label></form><section class="comments"><p>nice post</p></section><script>if(a<b){{x="</div>"}}</script></div></div>
<div class="cookie-notice">We use cookies</div><footer>&copy; x</footer></body></html>"""


def test_main_text_by_vote(table):
    rows = [(k, f"http://a.example.com/{k}", PAGE.format(k=k)) for k in range(5)]
    rows += [(10, "http://a.example.com/x", "<div><p>" + "long other text " * 20 + "</p></div><div class='post-9'>short</div>"), (11, "http://b.example.com/", "<p>only</p>"),
             (12, None, None), (13, "", ""), (14, "no url", "plain &lt;text&gt;"), (None, None, "<article>x<br>y</article>"), (11, "http://b.example.com/", "<p>only</p>")]
    got = collections.defaultdict(list)
    for r in htmltext.main_texts(table(rows, "page_id long, url string, html string").withColumn("path", lit(1))).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert all(got[k] == [f"Head & line {k} One twothree four five a b"] for k in range(5))
    assert got[10] == [("long other text " * 20).strip()]  # another path: none of its elements is where the host's are
    assert (got[11], got[12], got[13], got[None]) == (["only"] * 2, [""], [""], ["x y"])
    assert htmltext.main_texts(table([], "page_id long, url string, html string")).count() == 0


ARTICLE = "<h1>Head</h1><p>" + "running text of the article " * 12 + "</p>"
WHOLE = ("Head " + "running text of the article " * 12).strip()


@pytest.mark.parametrize("source", [
    '<div class="layout with-sidebar"><div class="sidebar">side</div><article>{}</article></div>',
    '<div class="sidebar-layout form"><article>{}</article></div><nav>menu</nav>',
    '<article class="has-comments">{}</article><section class="comments"><article class="comment"><p>' + "a comment " * 9 + '</p></article></section>',
    '<form action="/x"><div class="cookie-notice">We use cookies</div><div class="text">{}</div></form>',
    '<body class="page"><div id="page" class="nav-open notices"><main>{}</main></div><footer>foot</footer></body>',
    '<div class="social register"><div>{}</div></div><div class="ad">buy</div>',
])
def test_main_text_is_not_lost_to_a_name(table, source):
    """On all pages of a host a name of boilerplate stands on what holds the article."""
    pages = [(k, f"http://h.example.com/{k}", source.format(ARTICLE)) for k in range(3)]
    assert {r.text for r in htmltext.main_texts(table(pages, "page_id long, url string, html string")).collect()} == {WHOLE}


def test_main_text_behind_an_empty_placeholder(table):
    pages = [(k, f"http://h.example.com/{k}", f"<div class=story>{ARTICLE}</div>") for k in range(4)] + [(9, "http://h.example.com/9", f"<div class=story> </div><article>{ARTICLE}</article>")]
    assert {r.text for r in htmltext.main_texts(table(pages, "page_id long, url string, html string")).collect()} == {WHOLE}


def test_a_page_of_menus_has_no_main_text(table):
    menu = "<nav><a href=x>One</a> two three</nav><footer>" + "imprint and terms " * 9 + "</footer>"
    assert htmltext.main_texts(table([(1, "http://m.example.com/", menu)], "page_id long, url string, html string")).first().text == ""


def test_main_text_of_a_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op3_main_text"](spark, SF).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"</?(?:h1|p|br)>", " ", re.sub(r"</?[bai]>", "", body))).split())


def test_long_broken_page_ends():
    for source in ("<" * 50_000, "<div " * 20_000, "<p><b>" * 20_000 + "x", "<!--" * 20_000, "<script>" * 5_000, "<a href='" * 5_000):
        htmltext.Page(source[:100_000]).scores()


def test_main_text_of_very_long_pages(table):
    text = "a word of it " * 40_000
    rows = [(1, "http://l.example.com/", f"<article><p>{text}</p></article>"), (2, "http://l.example.com/", "<div>" * 3_000 + text + "</div>" * 3_000)]
    assert {r.n_chars for r in htmltext.main_texts(table(rows, "page_id long, url string, html string")).collect()} == {len(text) - 1}


def test_cascade_is_exact(spark):
    keys = spark.range(30_000).selectExpr("concat('k', id) AS key")
    listed = [f"k{n}" for n in range(0, 30_000, 97)] + ["absent"]
    levels = urlfilter.cascade(keys, listed)
    assert len(levels) > 1 and sum(len(x.words) for x in levels) * 64 < 30 * len(listed)
    got = keys.where(urlfilter.member(levels, keys["key"])).collect()
    assert {r.key for r in got} == set(listed) - {"absent"}


def test_url_odd_rows(table):
    rows = [(1, None), (2, "no host/net/"), (3, "http://A.Net"), (4, "http://a.net/"), (5, "https://x.example.net/en/1?q#f"), (6, "http://example.com/de/"), (7, "http://notexample.com/de/"),
            (8, "http://a.org/fr/x"), (9, "http://www.spam-farm.example.org/es/"), (10, "http://spam-farm.example.org.uk/"), (11, "http://h?x://net/"), (None, ""), (4, "http://a.net/"), (12, "x://y/p://q")]
    got = urlfilter.judged(table(rows, "page_id long, url string").withColumn("host", lit(1)), RULES, BLOCKED).collect()
    told = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == len(rows) and told == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("a.net", "", None, "allow"), 4: ("a.net", "/", "net/", "block"),
        5: ("x.example.net", "/en/1", "example.net/en/", "allow"), 6: ("example.com", "/de/", "example.com/de/", "block"), 7: ("notexample.com", "/de/", None, "allow"),
        8: ("a.org", "/fr/x", "org/fr/", "allow"), 9: ("www.spam-farm.example.org", "/es/", None, "block"), 10: ("spam-farm.example.org.uk", "/", None, "allow"),
        11: ("h", "", None, "allow"), None: ("", "", None, "allow"), 12: ("y", "/p://q", None, "allow")}
    assert urlfilter.judged(table([], "page_id long, url string"), RULES, BLOCKED).count() == 0
