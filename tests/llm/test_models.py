"""Language ID by held-out accuracy and brute force over paths; embedding near-dedup by brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup as emb
from tidemark.llm import language_id as lang
from tidemark.llm.queries import QUERIES


def test_best_path():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        scores = rnd.normal(size=(rnd.integers(1, 7), 3)) * 2
        worth = lambda p: sum(scores[i, l] for i, l in enumerate(p)) - 2 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert worth(lang.best_path(scores, 2.0).tolist()) == pytest.approx(max(map(worth, itertools.product(range(3), repeat=len(scores)))))


def test_held_out_accuracy(spark, sf):
    found = QUERIES["op1_language_id"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 20 and np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_spans_scripts_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").unionByName(
        spark.createDataFrame([("привет мир как дела сегодня", "ru"), ("это просто русский текст", "ru"), (None, "ru"), ("без языка", None)], "text string, lang string"))
    model = lang.train(docs)
    texts = {r.lang: r.text for r in docs.where("lang in ('en', 'fr')").groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    en, fr = (" ".join(texts[l].split()[:60]) for l in ("en", "fr"))
    rows = [(1, en + " 123 " + fr + " " + "мир да любовь", "x"), (2, None, None), (3, "", "en"), (4, "12 -- !", "en"), (5, "ПРИВЕТ", "en"), (6, "世界", None), (7, en, None), (7, en, None), (8, (fr + " ") * 200, None)]
    got = lang.detect(spark.createDataFrame(rows, "doc_id bigint, text string, row string").repartition(2), model).orderBy("doc_id").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9 and [by[i].lang_pred for i in (2, 3, 4, 5, 7, 8)] == ["und", "und", "und", "ru", "en", "fr"]
    assert by[2].score == 0 and by[6].lang_pred in model.langs and by[1].row == "x"
    spans = by[1].lang_spans
    assert [s.lang for s in spans] == ["en", "fr", "ru"] and rows[0][1][spans[2].start : spans[2].end] == "мир да любовь"
    assert abs(spans[1].start - len(en + " 123 ")) < 30
    assert lang.detect(spark.createDataFrame([], "doc_id bigint, text string"), model).count() == 0
    nothing = lang.train(spark.createDataFrame([("a", None)], "text string, lang string"))
    assert lang.detect(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), nothing).first().lang_pred == "und"


def test_scripts_of_no_learned_language(spark, sf):
    """Their letters count as unlabelled, so that the pipeline's first stage drops texts that are mostly written so."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang in ('en', 'fr')").select(*corpus_pipeline.COLUMNS)
    en = " ".join(docs.where("lang = 'en'").orderBy("doc_id").first().text.split()[:20])
    letters = sum(c.isalpha() for c in en)
    rows = [(9001, "世界你好"), (9002, "привет мир"), (9003, en + " " + "世" * 3 * letters), (9004, en + " " + "世" * letters)]
    got = {r.doc_id: r for r in lang.detect(spark.createDataFrame(rows, "doc_id bigint, text string"), lang.train(docs)).collect()}
    assert [got[i].score for i in (9001, 9002, 9003, 9004)] == pytest.approx([0, 0, 0.25, 0.5]) and got[9003].lang_pred == got[9004].lang_pred == "en"
    added = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], docs.schema)
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(added), sf).where("doc_id > 9000").collect()] == [9004]


def near_vectors(n, dim, seed):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n // 3, dim))
    noise = rnd.normal(size=(n, dim)) * rnd.choice([0, 0.05, 0.12, 0.18, 0.22], n)[:, None]
    return (base[rnd.integers(0, len(base), n)] + noise).astype(np.float32)


@pytest.mark.parametrize("cell, block", [(1024, 2048), (4, 5)])
def test_embeddings(spark, monkeypatch, cell, block):
    for name, value in (("CELL", cell), ("RESIDENTS", block), ("VISITORS", block)):
        monkeypatch.setattr(emb, name, value)
    rows = [(int(i * 7 % 101), v.tolist(), int(l)) for i, (v, l) in enumerate(zip(near_vectors(90, 16, 2), np.random.default_rng(3).integers(0, 2, 90)))]
    rows += [(500, rows[0][1], rows[0][2]), (501, [2 * x for x in rows[0][1]], rows[0][2]), (500, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2])]
    bad = [(600, None, 1), (601, [], 1), (602, [0.0] * 16, 1), (603, [1.0, None] + [1.0] * 14, 1), (604, [float("nan")] + [1.0] * 15, 1), (605, [float("inf")] + [1.0] * 15, 1), (606, [1.0] * 16, None), (607, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS node", "2 AS n", "'x' AS vector").repartition(3)
    got = emb.embedding_dedup(df).collect()
    good = rows
    x = np.array([r[1] for r in good], np.float64)
    size = np.linalg.norm(x, axis=1)
    link = (x @ x.T / np.outer(size, size) >= 0.98) & (np.array([r[2] for r in good])[:, None] == np.array([r[2] for r in good])[None])
    np.fill_diagonal(link, False)
    key = [2**63 - 1 if r[0] is None else r[0] for r in good]
    root = list(key)
    for _ in good:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(len(good))]
    want = [(r[0], int(link[i].sum()), root[i], root[i] == key[i]) for i, r in enumerate(good)] + [(b[0], 0, b[0], True) for b in bad]
    assert sum(w[1] for w in want) > 100
    assert sorted(((r.id, r.n_links, r.component, r.kept) for r in got), key=repr) == sorted(want, key=repr)


def test_no_vectors(spark):
    assert emb.embedding_dedup(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_estimates_and_bounds():
    """Estimates have no bias, and the bounds never exclude a pair at the threshold."""
    rnd = np.random.default_rng(5)
    a = rnd.normal(size=(400, 64))
    b = a + rnd.normal(size=a.shape) * 0.16
    unit_a, unit_b = emb.rotated(a), emb.rotated(b)
    cosine = unit_a @ unit_b.T
    packed, factors = emb.codes(unit_a)
    error = emb.estimate(packed, factors, unit_b) - cosine
    assert abs(error.mean()) < 0.005 and error.std() < 0.15
    may = emb.undecided(packed, factors, unit_b, 0.98)
    assert may[cosine >= 0.98].all() and (cosine >= 0.98).sum() > 100
    assert may[cosine < 0.5].mean() < 1e-4


def test_visits_meet():
    rnd = np.random.default_rng(6)
    a = emb.rotated(rnd.normal(size=(3000, 12)))
    b = emb.rotated(rnd.normal(size=(3000, 12)) * 0.07 + a @ emb.rotation(12))
    close = (a * b).sum(axis=1) >= 0.98
    home = lambda u: ((u[:, :9] >= 0) << np.arange(9)).sum(axis=1)
    seen = [set(zip(*(x.tolist() for x in emb.visits(u, 9, emb._budget(0.98))))) for u in (a, b)]
    ha, hb = home(a), home(b)
    assert close.sum() > 500 and all((i, hb[i]) in seen[0] or (i, ha[i]) in seen[1] for i in np.flatnonzero(close).tolist())
