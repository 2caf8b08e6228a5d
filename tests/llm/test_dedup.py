"""Line dedup, SimHash and vectors against brute force, and their defined results for odd input."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from candlemill.llm import likeness, linededup, simhash, vectors
from candlemill.llm.common import components, first_by_hash


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def reach(ids, linked):
    """Least id that links reach, by repeated minima over a boolean matrix."""
    label = np.array(ids)
    while True:
        new = np.array([label[linked[k]].min() for k in range(len(ids))])
        if (new == label).all():
            return label.tolist()
        label = new


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=7), st.lists(st.integers(0, 2), max_size=7))
def test_one_edit(a, b):
    assert linededup.one_edit(a, b) == (distance(a, b) <= 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=5, max_size=18), st.lists(st.sampled_from("abc"), min_size=5, max_size=18))
def test_lines_within_an_edit_share_a_key_and_a_variant(a, b):
    x, y = ([w.encode() for w in s] for s in (a, b))
    if a != b and distance(a, b) == 1:
        assert set(linededup.end_keys(x, 5)) & set(linededup.end_keys(y, 5))
        assert set(linededup.variants(linededup.word_hashes(x)).tolist()) & set(linededup.variants(linededup.word_hashes(y)).tolist())


def brute_lines(rows, least=5):
    seen, gone = [], {}
    for doc_id, text in sorted(rows):
        for k, line in enumerate(text.split("\n")):
            words = line.split()
            if words:
                if words in seen or len(words) >= least and any(distance(words, s) <= 1 for s in seen if len(s) >= least and abs(len(s) - len(words)) < 2):
                    gone.setdefault(doc_id, []).append(k)
                seen.append(words)
    return {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(d, [])) for d, t in rows}


def test_line_dedup_is_brute_force(table):
    rng = np.random.default_rng(3)
    rows = [(i, "\n".join(" ".join(rng.choice(["a", "b", "c"], rng.integers(0, 10))) for _ in range(rng.integers(1, 5)))) for i in range(120)]
    got = linededup.deduped(table(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(rows)


def test_line_dedup_with_many_lines_that_differ_in_one_word(table):
    rows = [(i, f"page number {i} of the same long book\nown words {i} {i * 7} {i * 11} {i * 13} {i * 17}") for i in range(300)]
    got = {r.doc_id: r for r in linededup.deduped(table(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and all(got[i].text == rows[i][1].split("\n")[1] and got[i].n_near == 1 for i in range(1, 300))


def test_line_dedup_odd_rows(table):
    long = " ".join(f"w{k}" for k in range(20_000))
    rows = [(1, "one two three four five\nshort", "x"), (1, "one two three four five\nshort", "x"), (2, None, None), (3, "", "y"),
            (4, long, "z"), (5, long + " more", None), (None, "six seven eight nine ten", "n"), (6, "six seven eight nine  ten", "n")]
    got = linededup.deduped(table(rows, "doc_id long, text string, gone_lines string").selectExpr("*", "1 AS n_lines", "2 AS own_version", "3 AS GONE_DOC")).collect()
    told = sorted((r.doc_id is not None, r.doc_id or 0, r.text if r.text is None or len(r.text) < 50 else len(r.text), r.n_copies, r.n_near) for r in got)
    assert told == [(False, 0, "six seven eight nine ten", 0, 0), (True, 1, rows[0][1], 0, 0), (True, 1, rows[0][1], 0, 0), (True, 2, None, 0, 0),
                    (True, 3, "", 0, 0), (True, 4, len(long), 0, 0), (True, 5, "", 0, 1), (True, 6, "", 1, 0)]
    assert linededup.deduped(table([], "doc_id long, text string")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64))


@pytest.mark.parametrize("node_rows, max_nodes", [(16, 4096), (4096, 4096), (16, 3)])
def test_simhash_is_brute_force(docs, node_rows, max_nodes):
    rows = docs.select("doc_id", "text").collect()
    prints = np.array([plain_fingerprint(r.text) for r in rows], dtype=np.uint64)
    want = reach([r.doc_id for r in rows], np.bitwise_count(prints[:, None] ^ prints[None]) <= 2)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, node_rows=node_rows, max_nodes=max_nodes).collect()}
    for r, fp, component in zip(rows, prints, want):
        assert (got[r.doc_id].fingerprint, got[r.doc_id].component_id) == (f"{int(fp):016x}", component)


def test_trie_pairs_are_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64) * np.uint64(2)
    v = base[rng.integers(0, 30, 900)]
    for _ in range(3):
        v = v ^ (np.uint64(1) << rng.integers(0, 64, len(v)).astype(np.uint64))
    v = np.unique(np.concatenate([v, rng.integers(0, 2**63, 300, dtype=np.uint64), [np.uint64(0), np.uint64(2**64 - 1)]]))
    i, j = simhash.close_pairs(v, None, 2)
    want = np.argwhere(np.triu(np.bitwise_count(v[:, None] ^ v[None]) <= 2, 1))
    assert sorted(zip(i, j)) == sorted(map(tuple, want))
    i, j = simhash.close_pairs(v[::2], v[1::2], 2)
    assert sorted(zip(i, j)) == sorted(map(tuple, np.argwhere(np.bitwise_count(v[::2][:, None] ^ v[1::2][None]) <= 2)))


def test_simhash_of_many_close_fingerprints(spark):
    """One heavy part of the trie: thousands of fingerprints in one small ball are opened further and stay connected."""
    values = np.unique(np.array([(1 << a) | (1 << b) | (1 << c) for a in range(30) for b in range(30) for c in range(30)], dtype=np.int64))
    fps = spark.createDataFrame([(int(v), int(v)) for v in values], "fp long, rep long")
    nodes = simhash.top_nodes(fps, 100)
    assert sum(n for _, _, n in nodes) == len(values) and max(n for _, _, n in nodes) <= 100
    # with few nodes allowed, heavy ones meet block by block
    for most in (4096, 5):
        found = components(simhash.links(fps, 2, node_rows=100, max_nodes=most), "test").collect()
        assert len(found) == len(values) and {r.component for r in found} == {1}


def test_simhash_odd_rows(table):
    rows = [(5, None, 1), (3, "", 1), (9, " \t ", 1), (7, "One two", 1), (8, "one TWO", 1), (None, "one two", 1), (2, "É x", 1), (4, "é x", 1), (7, "One two", 2)]
    got = simhash.near_duplicates(table(rows, "doc_id long, text string, component_id int")).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [
        (0, 7, False), (2, 2, True), (3, 3, True), (4, 4, True), (5, 3, False), (7, 7, True), (7, 7, True), (8, 7, False), (9, 3, False)]
    assert simhash.near_duplicates(table([], "doc_id long, text string")).count() == 0


def test_near_duplicate_stage_reaches_a_likeness_of_0_8(spark, table):
    """Copies with a few words exchanged, far beyond two bits, and some below 0.8, against all pairs by brute force."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(30):
        words = [f"w{x}" for x in rng.integers(0, 5_000, 200)]
        for _ in range(6):
            copy = list(words)
            for at in rng.integers(0, 200, rng.integers(0, 9)):
                copy[at] = f"n{rng.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, rows[0][1].upper()), (1001, "too short"), (1002, "Too  short"), (1003, None), (1004, "short too")]
    grams = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((t or "").lower().split() for _, t in rows)]
    prints = np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64)
    bits = np.bitwise_count(prints[:, None] ^ prints[None])
    near = np.array([[bool(a & b) and 10 * len(a & b) >= 8 * len(a | b) for b in grams] for a in grams])
    assert (near & (bits > 2)).sum() > 100 and ((bits > 2) & ~near).any()
    want = reach([i for i, _ in rows], near | (bits <= 2))
    got = corpus_pipeline.near_duplicates(spark, table(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in got.collect()} == {i for (i, _), c in zip(rows, want) if i == c}


def test_likeness_of_the_whole_sets():
    a = np.arange(90, dtype=np.uint64)
    assert likeness.alike(a, a[:72], 0.8) and not likeness.alike(a, a[:71], 0.8)


def test_shared_elements_are_counted_for_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 80 if k % 2 else 4_000, rng.integers(1, 90))) for k in range(70)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    np.fill_diagonal(want, 0)
    for rare in (1, 5, 16):
        monkeypatch.setattr(likeness, "RARE", rare)
        got = likeness.in_common(sets)
        np.fill_diagonal(got, 0)
        assert (got == want).all()


def test_a_template_below_the_threshold_is_compared_in_blocks(spark, table, monkeypatch):
    """Pages of one template, most of which are less alike than 0.8: no component settles them, blocks do."""
    monkeypatch.setattr(likeness, "BLOCK", 2_000)
    rng = np.random.default_rng(5)
    base = [f"t{k}" for k in range(120)]
    rows = []
    for k in range(90):
        own = list(base)
        for at in rng.choice(120, int(rng.integers(1, 6)), replace=False):
            own[at] = f"n{k}x{at}"
        rows.append((k, " ".join(own)))
    grams = [{tuple(t.split()[n:n + 5]) for n in range(116)} for _, t in rows]
    prints = np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64)
    near = np.array([[10 * len(a & b) >= 8 * len(a | b) for b in grams] for a in grams]) | (np.bitwise_count(prints[:, None] ^ prints[None]) <= 2)
    want = reach([i for i, _ in rows], near)
    assert 0.05 < near.mean() < 0.6 and len(set(want)) > 5
    got = simhash.near_duplicates(table(rows, "doc_id long, text string"), alike=0.8).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(zip([i for i, _ in rows], want))


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 500)] + [(7000, 7000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path, "a long, b long"), "test").collect()}
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(500)}


def brute_vectors(rows, least=0.95):
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], dtype=float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= least
    return linked.sum(axis=1) - 1, reach(ids, linked)


@pytest.mark.parametrize("pivots, block", [(1, 4096), (6, 40)])
def test_vectors_are_brute_force(table, pivots, block):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    rows = [(int(i), (centres[rng.integers(0, 12)] + rng.normal(size=8) * 0.22).astype(np.float32).tolist()) for i in rng.permutation(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(30)]
    links, component = brute_vectors(rows)
    got = {r.vec_id: r for r in vectors.near_duplicates(table(rows, "vec_id long, embedding array<float>"), pivots=pivots, block=block).collect()}
    assert links.max() > 30 and len(got) == len(rows)
    for (i, _), n, c in zip(rows, links, component):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, c, i == c)


def test_vectors_odd_rows(table):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, []), (9, [1e300, 0.0]), (10, [-1.0, 0.0]), (1, [1.0, 0.0]), (11, [None, 1.0]), (None, [1.0, 0.01])]
    got = vectors.near_duplicates(table(rows, "vec_id long, embedding array<double>")).collect()
    told = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got)
    assert told == [(0, 4, 1, False), (1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
                    (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 4, 1, False), (10, 0, 10, True), (11, 0, 11, True)]
    assert vectors.near_duplicates(table([], "vec_id long, embedding array<float>")).count() == 0


def test_first_by_hash(spark):
    rows = spark.range(5_000).selectExpr("id AS doc_id", "if(id % 50 = 0, 'b', 'a') AS lang")
    got, sizes = first_by_hash(rows, "lang", 100)
    want = {}
    for r in rows.selectExpr("doc_id", "lang", "xxhash64(doc_id) AS h").collect():
        want.setdefault(r.lang, []).append((r.h, r.doc_id))
    assert sizes == {"a": 4_900, "b": 100}
    assert {(r.lang, r.doc_id) for r in got.collect()} == {(k, i) for k, v in want.items() for _, i in sorted(v)[:100]}
