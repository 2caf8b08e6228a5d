"""The pipeline, stage by stage, against plain Python over the rows that each stage got."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from candlemill.llm import quality, toxicity
from candlemill.llm.common import stored
from test_dedup import brute_lines, plain_fingerprint, reach
from test_text import by_default, check_packing  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows before the first stage and after each one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "line_dedup", "simhash", "packing"]
    assert all(df.dtypes == kept[0].dtypes for df in kept[1:-1])


def test_quality_stage(kept):
    rows = kept[0].collect()
    made = {r.doc_id: quality.measured(r.text.encode()) for r in rows}
    share = lambda x: np.array(x, float) / max(1, sum(x))

    def words(common, lang):
        own = [n for n, (code, _) in zip(common, quality._LIST) if code == lang]
        return np.array([*own, common[-1] - sum(own)], float) / max(1, common[-1])

    langs = {}
    for r in rows:
        counts, letters, common = made[r.doc_id]
        if counts[0] >= 50:
            langs.setdefault(r.lang, []).append((share(letters), words(common, r.lang)))
    means = {lang: (np.mean([a for a, _ in x], axis=0), np.mean([b for _, b in x], axis=0)) for lang, x in langs.items()}

    def js(p, q):
        m = (p + q) / 2
        return np.sqrt(max(0.0, sum(sum(a * np.log2(a / c) for a, c in zip(x, m) if a > 0) for x in (p, q)) / 2))

    want = set()
    for r in rows:
        (n, _, _, _, repeated), letters, common = made[r.doc_id]
        if n >= 20 and 100 * repeated <= 30 * n:
            both = [(js(share(letters), a), js(words(common, lang), b)) for lang, (a, b) in sorted(means.items())]
            a, b = min(both, key=lambda x: x[0] ** 2 + x[1] ** 2)
            if n < 50 or a <= 0.2 + 0.7 / n ** 0.5 and b <= 0.2 + 1.1 / n ** 0.5:
                want.add(r.doc_id)
    assert set(texts(kept[1])) == want and texts(kept[1]).items() <= texts(kept[0]).items()


def test_toxicity_stage(spark, kept):
    told = toxicity.scored(kept[1], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert set(texts(kept[2])) == {r.doc_id for r in told if not r.predicted} and len(told) == kept[1].count()


def test_line_dedup_stage(kept):
    before = texts(kept[2])
    assert texts(kept[3]) == brute_lines(list(before.items()))
    assert all(r.n_chars == len(r.text) for r in kept[3].collect())


def test_simhash_stage(kept):
    before = texts(kept[3])
    ids = list(before)
    prints = np.array([plain_fingerprint(before[i]) for i in ids], dtype=np.uint64)
    least = reach(ids, np.bitwise_count(prints[:, None] ^ prints[None]) <= 2)
    assert texts(kept[4]) == {i: before[i] for i, c in zip(ids, least) if i == c}


def test_packing_stage(kept, by_default):  # noqa: F811
    rows, pieces = list(texts(kept[4]).items()), kept[5].collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in rows}
    assert check_packing(rows, pieces, by_default, 2048) <= -(-sum(r.length for r in pieces) // 2048) + 1


def test_run_is_all_stages(spark, kept):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, kept[5].collect()))


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "x " * 30_000, "en", "s", 1), (2, "x " * 30_000, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF)
            assert made.count() <= 70 and (made.columns == docs.columns or "sequence_id" in made.columns)
