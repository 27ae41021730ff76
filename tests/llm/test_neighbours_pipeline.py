from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
import public_tokenizers
from plantpanel.llm import neighbours, registry

from plantpanel.llm.quality import score_documents

from .helpers import CLASHING, corpus, with_clashes, words_of
from .test_duplicates import brute_join, brute_passages


def brute(rows, modulus, k):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], dtype=np.float64)
    out = {}
    for q in ids[ids % modulus == 0]:
        s = (v * v[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        order = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
        out[q] = list(zip(ids[order], s[order]))
    return out


def test_nearest(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    good = [(i, (centres[i % 12] + 0.4 * rng.normal(size=24)).astype(np.float32).astype(float).tolist()) for i in range(1200)]
    good += [(2000 + i, good[5][1]) for i in range(40)]  # ties
    bad = [(3000, None), (3020, [0.0] * 24), (3040, [float("nan")] + [1.0] * 23), (3060, [None] + [1.0] * 23), (3080, [1.0] * 3), (None, [1.0] * 24), (3100, [float("inf")] * 24), (3120, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in [*good, *bad, good[0]]], "vec_id long, embedding array<double>, label int, id string")
    want = brute(good, 20, 20)
    got: dict = {}
    for r in neighbours.nearest(df, block_vectors=200, block_queries=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    for q in want:
        exact = dict(brute([r for r in good if r[0] == q or r[0] in {i for i, _ in got[q]}], 20, 50)[q]) if q % 400 == 0 else {}
        for i, s in got[q]:
            assert not exact or abs(exact[i] - s) < 1e-12
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    assert neighbours.nearest(spark.createDataFrame([], schema)).count() == 0
    rows = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0])], schema)).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows] == [(0, 1, 1, 1.0), (0, 2, 2, 0.5)]


@pytest.mark.parametrize("dim", [64, 100])
def test_error_bound_holds(dim):
    rng = np.random.default_rng(4)
    v, q = rng.normal(size=(3000, dim)), rng.normal(size=(20, dim))
    centre, turn = v.mean(axis=0), neighbours.rotation(dim)
    words, length, own = neighbours.encode(v, centre, turn)
    parts = neighbours.scalars(words, length, own, dim)
    off = []
    for x in q:
        about, bound = neighbours.Query(x, centre, turn).estimate(words, *parts)
        off.append(np.abs(about - v @ x) <= bound)
    assert np.mean(off) > 0.97


def test_bit_counts_are_inner_products():
    """The packed estimate equals the plain product of the code with the rounded query."""
    rng = np.random.default_rng(6)
    v, q = rng.normal(size=(50, 70)), rng.normal(size=70)
    centre, turn = np.zeros(70), neighbours.rotation(70)
    words, length, own = neighbours.encode(v, centre, turn)
    query = neighbours.Query(q, centre, turn)
    turned = turn @ q
    rounded = np.rint((turned - turned.min()) / query.step) * query.step + turned.min()
    codes = np.where(v @ turn.T >= 0, 1.0, -1.0)
    about, _ = query.estimate(words, *neighbours.scalars(words, length, own, 70))
    assert about == pytest.approx((codes @ rounded) * length / own / np.sqrt(70))


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = stage(spark, docs, sf).collect()
        assert rows, name
        if k < len(corpus_pipeline.STAGES) - 1:
            docs = spark.createDataFrame(rows, docs.schema)
            assert docs.columns == columns and (name == "mix_sources" or len(rows) <= n)
            n = len(rows)
    assert corpus_pipeline.run(spark, sf).count() == len(rows)


def test_registered():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {"pipeline", *(f"op{k}" for k in range(1, 14))} and len(names) == 14


def test_stages_take_awkward_documents(spark, sf):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, corpus(spark), sf).count() > 0
        stage(spark, corpus(spark).limit(0), sf).collect()


def test_stages_keep_columns_whose_names_clash(spark, sf):
    """Columns named like those the stages use inside come back with the same values."""
    docs = with_clashes(corpus(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select(*CLASHING).distinct().collect()} == {("x",) * len(CLASHING)}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_against_plain_loops(spark, sf):
    """What each stage keeps of the one before it, as plain loops over the same rows have it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    step = dict(corpus_pipeline.STAGES)

    kept = step["quality_rules"](spark, docs, sf)
    verdict = {r["doc_id"]: r for r in score_documents(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    texts = _texts(docs)
    assert _texts(kept) == {i: t for i, t in texts.items() if verdict[i]["kept"]}
    assert all(len(words_of(t)) >= 50 for t in _texts(kept).values())
    kept = spark.createDataFrame(kept.collect(), docs.schema)

    lines = step["line_dedup"](spark, kept, sf)
    want = {i: t for i, (t, _, _) in brute_passages(kept).items() if words_of(t)}
    assert _texts(lines) == want
    lines = spark.createDataFrame(lines.collect(), docs.schema)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    single = step["jaccard_join"](spark, lines, sf)
    groups = brute_join(lines)
    assert set(_texts(single)) == {i for (i, _), (first, _) in groups.items() if first == i}
    single = spark.createDataFrame(single.collect(), docs.schema)

    mixed = step["mix_sources"](spark, single, sf)
    source = {r["doc_id"]: (r["source"], set(words_of(r["text"]))) for r in single.collect()}
    assert all(r["source"] == source[r["doc_id"]][0] and set(words_of(r["text"])) <= source[r["doc_id"]][1] for r in mixed.collect())
    mixed = spark.createDataFrame(mixed.collect(), docs.schema)

    pieces = step["best_fit_packing"](spark, mixed, sf).collect()
    ends: dict = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    import tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(ends.values()) == ids
