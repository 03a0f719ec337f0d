"""The pipeline's stages against plain Python, each on its own input."""

from collections import defaultdict

import corpus_pipeline
from plain import lower, near, words
from test_dedup import alike, shingles

from tidemark.session import scratch_path


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 6000").unionByName(
        spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 5), (9003, "", None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    given = {r.doc_id: r.text for r in docs.collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if number < 5:
            assert docs.columns == corpus_pipeline.COLUMNS
            got = {r.doc_id: r.text for r in rows}
            assert len(got) == len(rows) and (number == 1 or all(r.n_chars == len(r.text) for r in rows))
        if number == 1:
            assert set(given) - set(got) == {9001, 9002, 9003} and all(given[d] == t for d, t in got.items())
        elif number == 2:
            first = defaultdict(lambda: 10**9)
            key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
            for d, t in given.items():
                for line in t.split("\n"):
                    first[key(line)] = min(first[key(line)], d)
            assert got == {d: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == d) for d, t in given.items()}
        elif number == 3:
            ids = sorted(given)
            roots = near(ids, [shingles(given[d]) for d in ids], lambda a, b: alike(a, b) >= 0.8)
            assert got == {d: given[d] for d in set(roots)} and len(got) < len(given)
        elif number == 4:
            first = {}
            for d in sorted(given):
                w = words(given[d])
                for i in range(len(w) - 49):
                    first.setdefault(tuple(w[i : i + 50]), d)
            for d, t in given.items():
                w = words(t)
                gone = {j for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < d for j in range(i, i + 50)}
                assert got[d] == (" ".join(x for j, x in enumerate(w) if j not in gone) if gone else t)
        else:
            whole = defaultdict(int)
            for r in rows:
                whole[r.doc_id] += r.length
            assert set(whole) == set(given) and all(r.doc_tokens == whole[r.doc_id] for r in rows)
        if number < 5:
            given = got


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, doc int, version int, kept_text string"


def test_stages_without_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        found = stage(spark, docs, "")
        assert found.count() == 0 and (number == 5 or found.columns == corpus_pipeline.COLUMNS)


def test_stages_with_nulls_and_repeats(spark):
    """Each stage by itself, with what its docstring says."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, "en", "s", 0), (1, long, "en", "s", 0), (2, long + " more", "en", "s", 0), (3, None, None, None, None), (4, "", "en", None, 0), (None, "other words here\nother words here", None, None, None)]
    docs = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)
    found = [sorted(((r.doc_id, r.text) for r in stage(spark, docs, "").collect()), key=repr) for _, stage in corpus_pipeline.STAGES[:4]]
    order = lambda *wanted: sorted(wanted, key=repr)
    other = (None, rows[5][1])
    assert found[0] == order((1, long), (1, long), (2, long + " more"), other)
    assert found[1] == order((1, long), (1, long), (2, long + " more"), (3, ""), (4, ""), other)
    assert found[2] == order((1, long), (1, long), (3, None), other)
    assert found[3] == order((1, long), (1, long), (2, "more"), (3, ""), (4, ""), other)
    assert sorted(r.doc_id for r in corpus_pipeline.STAGES[4][1](spark, docs, "").where("start = 0").collect() if r.doc_id) == [1, 1, 2, 3, 4]
