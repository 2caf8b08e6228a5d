"""Vector codes, the conversation trie and the mixture against plain Python, and their defined results for odd input."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from candlemill.llm import mixing, prefixtrie, vectorcodes
from candlemill.llm.common import prefix_sums

NAN, INF = float("nan"), float("inf")


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """{vec_id: (code, error)} and the codebooks' digest, with Python's own integers; rows of one length."""
    rows = sorted(rows)
    whole = [[math.floor(1024 * x) for x in v] for _, v in rows]
    step = len(whole[0]) // parts
    books = [[v[p * step:(p + 1) * step] for v in whole[:entries]] for p in range(parts)]

    def nearest(p, v):
        x = v[p * step:(p + 1) * step]
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for v in whole:
                own[nearest(p, v)[1]].append(v[p * step:(p + 1) * step])
            new = list(books[p])
            for k, some in own.items():
                new[k] = [sum(c) // len(some) for c in zip(*some)]
            books[p] = new
    told = [[nearest(p, v) for p in range(parts)] for v in whole]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ("".join(f"{k:02x}" for _, k in t), sum(d for d, _ in t)) for (i, _), t in zip(rows, told)}, digest


@pytest.mark.parametrize("block", [50, 2048])
def test_codes_are_brute_force(table, block):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(9, 12))
    rows = [(int(i), (centres[rng.integers(0, 9)] + rng.normal(size=12) * rng.choice([0.0, 0.1, 1.0])).astype(np.float32).tolist()) for i in rng.permutation(400)]
    want, digest = plain_codes(rows, entries=40)
    got = vectorcodes.compressed(table([(i, v, i % 3 or None) for i, v in rows], "vec_id long, embedding array<float>, label int"), entries=40, block=block).collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == want and {r.codebooks_sha256 for r in got} == {digest}
    for label in (None, 1, 2):
        assert {r.label_error for r in got if r.label == label} == {sum(want[i][1] for i, _ in rows if (i % 3 or None) == label)}


def test_a_tree_holds_its_points_and_owns_what_is_nearest():
    rng = np.random.default_rng(3)
    for n, width in ((1, 3), (40, 2), (900, 5), (500, 1)):
        points = rng.integers(-6, 6, (n, width)) * rng.choice([1, 50], (n, 1))
        tree = vectorcodes.planted(points)
        assert sorted(tree["order"]) == list(range(n)) and (points[tree["order"]] == tree["points"]).all()
        for lo, hi, radius, total in zip(tree["lo"], tree["hi"], tree["radius"], tree["sums"]):
            inside = tree["points"][lo:hi]
            assert (inside.sum(axis=0) == total).all() and np.sqrt(((inside - total / (hi - lo)) ** 2).sum(axis=1)).max() <= radius + 1e-9
        book = rng.integers(-6, 6, (30, width)) * rng.choice([1, 50], (30, 1))
        want = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)  # ties to the lower entry
        sums, counts, code = vectorcodes.owned(tree, book, True)
        assert (code == want[tree["order"]]).all() and (counts == np.bincount(want, minlength=30)).all()
        assert all((sums[k] == points[want == k].sum(axis=0)).all() for k in range(30))


def test_wholly_owned_balls_are_not_opened(monkeypatch):
    """Tight clusters: points are compared one by one only where a ball has several entries left."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-9_000, 9_000, (20, 4))
    points = centres[rng.integers(0, 20, 4_000)] + rng.integers(-20, 20, (4_000, 4))
    tree, asked, plain = vectorcodes.planted(points), [], vectorcodes.squares
    monkeypatch.setattr(vectorcodes, "squares", lambda a, b: asked.append(len(a)) or plain(a, b))
    vectorcodes.owned(tree, centres, True)
    assert sum(asked) < 400


def test_codes_odd_rows(table):
    rows = [(5, [1.0, 0.0, 0.0, 2.0], "a"), (1, [-0.0001, 0.0, 0.0, 1.0], None), (1, [-0.0001, 0.0, 0.0, 1.0], None), (2, None, "a"), (3, [NAN, 0.0, 0.0, 0.0], "a"),
            (4, [INF, 0.0, 0.0, 0.0], "a"), (6, [None, 0.0, 0.0, 0.0], "a"), (None, [9.0, 9.0, 9.0, 9.0], "b"), (7, [1e300, 0.0, 0.0, 0.0], "a"), (8, [], "c"), (9, [1.0, 2.0, 3.0, 4.0, 5.0], "c")]
    got = vectorcodes.compressed(table(rows, "vec_id long, embedding array<double>, label string").selectExpr("*", "1 AS code", "2 AS dim")).collect()
    told = sorted((r.vec_id or 0, r.code, r.error, r.label) for r in got)
    assert [(i, e, x) for i, _, e, x in told] == [(0, 0, "b"), (1, 0, None), (1, 0, None), (5, 0, "a"), (8, 0, "c"), (9, 0, "c")]
    assert told[1][1] == told[2][1] == "00000000" and told[3][1] == "02000002"
    assert vectorcodes.compressed(table([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert vectorcodes.compressed(table([(1, [1.0] * 8)], "vec_id long, embedding array<float>")).first().label_error == 0


def plain_trie(convs):
    """Nodes of {conv_id: [(role, text), ...]} as rows, by sets of members."""
    members = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), sum(len(n) == len(node) + 1 for n in below),
                    sum(not any(m[:-1] == n for m in members if m) for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def told_trie(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=lambda r: (r[1], r[0]))


def random_turns(rng, n):
    turns = []
    for c in range(n):
        for k in range(rng.integers(0, 7)):
            turns.append((c, int(k), ["user", "bot", None][rng.integers(0, 3)] if k % 2 else "user", ["", "é", "aa", None, "b" * 9][rng.integers(0, 5)]))
    return turns


@pytest.mark.parametrize("bits", [4, 25])
def test_trie_is_brute_force(table, bits):
    """With a sketch of 16 cells all prefixes seem shared, with a large one most are proved not to be."""
    turns = random_turns(np.random.default_rng(9), 150)
    turns += [(900 + k, j, "user", f"long {j}") for k in range(2) for j in range(40 + k)] + [(700, 3, "user", "only mine"), (700, None, None, None)]
    convs = defaultdict(list)
    for c, _, role, text in sorted(turns, key=lambda t: (t[0], -1 if t[1] is None else t[1])):
        convs[c].append((role or "", text or ""))
    got = prefixtrie.prefix_trie(table(turns, "conv_id long, turn int, role string, text string"), bits)
    assert told_trie(got) == plain_trie(convs)


def test_trie_of_long_conversations_and_many_ends(table, monkeypatch):
    """Conversations longer than a chunk, and a node at which more end than fit into a piece."""
    monkeypatch.setattr(prefixtrie, "CHUNK", 8)
    monkeypatch.setattr(prefixtrie, "PIECE", 16)
    turns = [(c, k, "user", f"t{k if k < 21 else (c, k)}") for c in (3, 10, 4) for k in range(30 + c)] + [(100 + c, k, "user", f"t{k}") for c in range(200) for k in range(3)]
    convs = defaultdict(list)
    for c, _, role, text in turns:
        convs[c].append((role, text))
    assert told_trie(prefixtrie.prefix_trie(table(turns, "conv_id long, turn int, role string, text string"))) == plain_trie(convs)


def test_spliced_trie_is_brute_force(table):
    turns = [t for t in random_turns(np.random.default_rng(2), 160) if t[0] % 35]  # some first neighbours are absent
    own = defaultdict(list)
    for c, _, role, text in turns:
        own[c].append((role or "", text or ""))
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    placed = prefixtrie.digested(table(turns, "conv_id long, turn int, role string, text string"))
    assert any(not t for t in convs.values()) and told_trie(prefixtrie.trie(*prefixtrie.spliced(placed))) == plain_trie(convs)


def test_trie_below_a_prefix_proved_single(table):
    """A small sketch proves some prefixes single and leaves longer ones of the same conversation open."""
    convs = {c: [("user", f"{c} {k}") for k in range(12)] for c in range(40)}
    turns = [(c, k, *t) for c, own in convs.items() for k, t in enumerate(own)]
    placed = prefixtrie.digested(table(turns, "conv_id long, turn int, role string, text string"))
    judged = prefixtrie.screened(prefixtrie.prefixes(prefixtrie.whole(placed)[1]), 9)
    assert judged.where("open AND NOT up").count()
    assert told_trie(prefixtrie.trie(*prefixtrie.whole(placed), 9)) == plain_trie(convs)


def test_trie_odd_rows(table):
    schema = "conv_id long, turn long, role string, text string, depth int, p1 string"
    rows = [(None, 1, "user", "x", 1, ""), (4, 1, "user", "x", 1, ""), (4, 1, "user", "x", 1, ""), (5, 1, "user", "x" * 100_000, 1, "")]
    got = told_trie(prefixtrie.prefix_trie(table(rows, schema)))
    assert [r[:5] for r in got] == [(4, 0, None, 2, 2), (4, 1, 4, 1, 1), (5, 1, 4, 1, 0), (4, 2, 4, 1, 0)]
    assert told_trie(prefixtrie.prefix_trie(table([], schema))) == []


def test_sketch_never_calls_a_shared_prefix_single(table):
    rng = np.random.default_rng(1)
    rows = [(int(a), int(b), 0, 0, 1) for a, b in rng.integers(-2**62, 2**62, (3_000, 2))]
    df = table(rows + rows[:500], "p1 long, p2 long, q1 long, q2 long, depth int")
    for bits in (6, 12, 20):
        found = {(r.p1, r.p2): r.open for r in prefixtrie.screened(df, bits).collect()}
        assert all(found[r[:2]] for r in rows[:500])
    assert sum(found.values()) < 600


def plain_mix(rows, weights=(5, 2, 1)):
    """{doc_id: (size, source_size, target, taken)} with fractions."""
    size = {i: len((t or "").encode().split()) for i, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, left, active = {}, Fraction(3, 2) * sum(total.values()), list(sources)
    while active:
        share = {s: left * weight[s] / sum(weight[x] for x in active) for s in active}
        above = [s for s in active if share[s] > 2 * total[s]]
        for s in above:
            target[s] = Fraction(2 * total[s])
            left -= target[s]
        active = [s for s in active if s not in above]
        if not above:
            target |= share
            break
    out = {}
    for s in sources:
        budget, before = int(target[s]), 0
        rounds = budget // total[s] if total[s] else 0
        for i in sorted((i for i, _, x in rows if x == s), key=lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i)):
            out[i] = (size[i], total[s], float(target[s]), rounds * size[i] + max(0, min(size[i], budget - rounds * total[s] - before)))
            before += size[i]
    return out


def mix_rows():
    rng = np.random.default_rng(6)
    names = ["a", "b", "é", "Z", "zz", None, "", "tiny"]
    return [(i, None if i % 17 == 0 else "w " * int(rng.pareto(1.0) * 5), names[-1] if i == 3 else names[min(6, int(rng.exponential(1.5)))]) for i in range(400)]


def test_mixture_is_brute_force(table):
    rows = mix_rows()
    got = mixing.mixed(table(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS before", "3 AS part"))
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in got.collect()}
    want = plain_mix(rows)
    assert got == want and any(t == 2 * s for _, s, t, _ in want.values()) and any(t < 1.9 * s for _, s, t, _ in want.values())


def test_mixture_texts(table):
    rows = [(1, "a b\n c", "s"), (2, " d  e f g ", "s"), (3, "x y", "t"), (4, None, "t")]
    docs = table(rows, "doc_id long, text string, source string")
    mix = mixing.mixed(docs)
    got = defaultdict(int)
    for r in mixing.copies(docs, mix).collect():
        got[r.doc_id] += len(r.text.split())
        assert r.text == {i: t for i, t, _ in rows}[r.doc_id][:len(r.text)]
    assert dict(got) == {r.doc_id: r.taken for r in mix.collect() if r.taken}


def test_mixture_odd_rows(table):
    schema = "doc_id long, text string, source string"
    assert mixing.mixed(table([], schema)).count() == 0
    assert {r.taken for r in mixing.mixed(table([(1, None, None), (2, " ", "a")], schema)).collect()} == {0}
    twice = [(1, "a b c d", "s")] * 4 + [(None, "e f", "s"), (1, "other", "s")]
    got = mixing.mixed(table(twice, schema)).collect()
    assert len(got) == 6 and sum(r.taken for r in got) == 28 and all(r.taken <= 2 * r.size for r in got)  # 19 words, 28.5 wanted


def test_prefix_sums_of_a_group_in_many_parts(spark):
    rows = spark.range(3_000).selectExpr("if(id % 3 = 0, NULL, 'hot') AS g", "id % 7 AS k", "id % 5 AS n", "id").repartition(6)
    got = prefix_sums(rows, "g", ["k", "id"], "n", "test").collect()
    for g in (None, "hot"):
        before = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: (r.k, r.id)):
            assert r.before == before
            before += r.n
        assert {r.total for r in got if r.g == g} == {before}
