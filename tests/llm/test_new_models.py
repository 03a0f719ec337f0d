"""URL filter, spelling variants and whitening against plain Python and numpy."""

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from plain import corpus, lower
from pyspark.sql import functions as F

from tidemark.llm import spelling, url_filter, whitening
from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_filter import Rule


# -- spelling variants ------------------------------------------------------------------------------
def counted(rows, every, least, count):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words, ratio=2):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], [ord(c) for c in v]), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def answered(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


@pytest.mark.parametrize("every, least, count, window", [(None, 5, 1, 8 << 20), (3, 4, 1, 64), (5, 5, 2, 8 << 20)])
def test_words_are_counted(table, monkeypatch, every, least, count, window):
    monkeypatch.setattr(spelling, "WINDOW", window)
    rnd = random.Random(3)
    letters = "abcdABCDéÉ×÷ÿÀ İKſª-'. 世¿Ā\n😀"
    rows = [(i, "".join(rnd.choice(letters[:16] * 3 + letters) for _ in range(rnd.randint(0, 300)))) for i in range(120)]
    rows += [(None, "Abcde Abcde abcdé"), (5, None), (6, ""), (7, "A" * 300 + " xyz" + "A" * 300), (8, "abcdef"), (8, "ghijkl"), (10**12, "É" * 7), *corpus()]
    got = {r.word: r.n for r in spelling.count_words(table(rows), least_length=least, least_count=count, typo_every=every).collect()}
    assert got == counted(rows, every, least, count)


@pytest.mark.parametrize("short", [0, 3, 64])
def test_no_near_word_is_missed(spark, monkeypatch, short):
    monkeypatch.setattr(spelling, "SHORT_LIST", short)  # from long grams everywhere to short ones
    rnd = random.Random(short)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.choice([4, 5, 5, 6, 7]))): rnd.randint(1, 40) for _ in range(250)}
    for w in list(words)[:120]:
        at, c = rnd.randrange(len(w)), rnd.choice("abzÿ")
        for new in (w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w + c, c + w, w * 3, w * 3 + c):
            words[new] = rnd.randint(1, 90)
    words |= {"x" * 200: 5, "x" * 201: 10, "x" * 100 + "y" + "x" * 99: 4}
    got = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    assert answered(got) == variants(words)


def test_affected_grams_bound_every_edit():
    rnd = random.Random(5)
    for _ in range(300):
        longer = frozenset("".join(rnd.choice("ab^") for _ in range(rnd.choice([2, 3]))) for _ in range(6))
        dictionary = spelling.GramDictionary(longer)
        word = "".join(rnd.choice("ab") for _ in range(rnd.randint(5, 9)))
        grams, at, c = dictionary.decompose(word), rnd.randrange(len(word)), rnd.choice("abc")
        for other in (word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]):
            kept = sum((Counter(grams) & Counter(dictionary.decompose(other))).values())
            assert kept >= len(grams) - spelling.affected(grams) > 0


def test_spelling_of_texts_and_empty_tables(table):
    rows = [(i, "people Peolpe peple people's pepole people ") for i in range(6)] + [(None, None), (9, "")]
    for every in (None, 2):
        assert answered(spelling.spelling_variants(table(rows), least_count=2, typo_every=every)) == variants(counted(rows, every, 5, 2))
    assert spelling.spelling_variants(table([])).collect() == [] and spelling.spelling_variants(table([(1, None)])).collect() == []
    with pytest.raises(ValueError):
        spelling.group_variants(table([]).selectExpr("text AS word", "doc_id AS n"), ratio=1)


# -- URL filter -------------------------------------------------------------------------------------
def split_url(url):
    rest = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", rest)[0]
    return lower(host), re.match("[^?#]*", rest[len(host) :])[0]


def ruled(url, rules):
    host, path = split_url(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


ODD_URLS = [None, "", "x", "://", "http://", "HTTP://WWW.Example.COM/en/x?y", "a://b://c/d", "http://example.com", "http://example.com/en", "http://example.com/en/", "http://notexample.com/en/",
            "http://x.net?/es/", "http://x.net/es/#://", "http://É.net/fr/", "http://com/", "http://a.www.example.com/en/1", "http://u:p@example.com:80/en/", "http://h\n/x", "http://x.net/es/" + "z/" * 60_000]


def test_host_path_and_rules(spark):
    df = spark.createDataFrame([(i if i % 5 else None, u, "x", 1) for i, u in enumerate(ODD_URLS * 2)], "page_id bigint, url string, host string, score int").repartition(3)
    model = url_filter.train(url_filter.labelled_by_rules(df, URL_RULES), most_rows=100)
    got = sorted(((r.id, r.host, r.path, r.rule) for r in url_filter.judge(df, model, URL_RULES).collect()), key=repr)
    want = []
    for i, u in enumerate(ODD_URLS * 2):
        rule = ruled(u, URL_RULES)
        want.append((i if i % 5 else None, *split_url(u), rule and rule.text))
    assert got == sorted(want, key=repr)
    for r in url_filter.judge(df, model, URL_RULES).collect():
        assert 0 <= r.score <= 1 and r.verdict == (next(x.verdict for x in URL_RULES if x.text == r.rule) if r.rule else "block" if r.score >= 0.5 else "allow")


def made_urls(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        bad = rnd.random() < 0.4
        host = rnd.choice(["shop", "news", "blog"]) + rnd.choice([".example", ".test"]) + rnd.choice([".com", ".org"] if rnd.random() < 0.8 or not bad else [".win"])
        path = "/".join("".join(rnd.choice("0123456789abcdef" if bad else "lorem") for _ in range(rnd.randint(3, 12))) for _ in range(rnd.randint(1, 5) + 2 * bad))
        out.append((f"http://{host}/{path}" + ("?" + "&".join(f"p{i}={rnd.random()}" for i in range(rnd.randint(0, 5))) if bad else ""), bad))
    return out


def test_url_trees_learn_and_do_not_depend_on_partitions(spark):
    rows = made_urls(1, 1500)
    model = url_filter.train(spark.createDataFrame(rows, "url string, block boolean").repartition(5), trees=6)
    assert url_filter.train(spark.createDataFrame(rows[::-1], "url string, block boolean").coalesce(1), trees=6).trees == model.trees
    fresh = made_urls(2, 500)
    got = url_filter.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(fresh)], "page_id bigint, url string"), model).collect()
    assert sum((r.verdict == "block") == fresh[r.id][1] for r in got) / len(fresh) > 0.95
    # Features against plain Python.
    df = spark.createDataFrame([(u,) for u, _ in fresh[:50]], "url string")
    host, path = url_filter.host_and_path(F.col("url"))
    for r in url_filter._with_features(df.withColumns({"host": host, "path": path}), model.suffixes, model.prior).collect():
        counts = Counter(r.url)
        entropy = -sum(c / len(r.url) * math.log2(c / len(r.url)) for c in counts.values())
        query = r.url.partition("?")[2]
        assert abs(r.f_entropy - entropy) < 1e-5 and r.f_length == len(r.url) and r.f_host == len(split_url(r.url)[0]) and r.f_depth == split_url(r.url)[1].count("/")
        assert r.f_params == (query.count("&") + 1 if query else 0) and abs(r.f_digits - sum(c.isdigit() for c in r.url) / len(r.url)) < 1e-12


def test_url_labels_of_one_kind_or_none(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (2, None)], "page_id bigint, url string")
    for rows, verdict in (([], "allow"), ([("http://a.b/c", True)] * 9 + [("x", None)], "block"), ([(None, False)] * 9, "allow")):
        model = url_filter.train(spark.createDataFrame(rows, "url string, block boolean"))
        assert {r.verdict for r in url_filter.judge(pages, model).collect()} == {verdict}
    assert url_filter.judge(pages.limit(0), model, [Rule("block", "b", "/")]).collect() == []


# -- whitening --------------------------------------------------------------------------------------
@pytest.mark.parametrize("n, kind", [(1, "random"), (2, "random"), (3, "equal"), (17, "random"), (64, "low rank"), (40, "pairs"), (30, "diagonal"), (20, "zero"), (25, "large"), (25, "small")])
def test_leading_components(n, kind):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = {"random": rng.random(n), "equal": np.ones(n), "low rank": np.where(np.arange(n) < 3, [5.0] * n, 0), "pairs": np.repeat(rng.random(n // 2 + 1), 2)[:n], "diagonal": rng.random(n),
              "zero": np.zeros(n), "large": rng.random(n) * 1e200, "small": rng.random(n) * 1e-200}[kind]
    matrix = np.diag(values) if kind == "diagonal" else (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading_components(matrix, 5)
    k, size = min(5, n), max(np.abs(matrix).max(), 1e-300)
    assert np.allclose(got / size, np.linalg.eigvalsh(matrix / size)[::-1][:k], atol=1e-13 * n)
    assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-13 * n) and np.abs((matrix / size) @ vectors.T - vectors.T * (got / size)).max() < 1e-13 * n


def white_rows(rows, k=4, scale=256):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = Counter(len(x) for _, x in kept)
    dims = max(lengths, key=lambda d: (lengths[d], d))
    kept = [(i, x) for i, x in kept if len(x) == dims]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1][:k], vectors[:, ::-1][:, :k].T, values.sum()


@pytest.mark.parametrize("scale", [256, 1 << 40])
def test_whitening(spark, scale):
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) for c in rng.standard_normal(6) * [5, 3, 2, 1, 0.5, 0.1] + 10]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(3, rows[4][1]), (None, rows[5][1]), (200, None), (201, []), (202, [1.0] * 5), (203, [1.0, None] * 3), (204, [float("nan")] + [1.0] * 5), (205, [float("inf")] + [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("x", F.lit("x")).withColumn("id", F.lit(1)).repartition(4)
    got = whitening.whiten(df, scale=scale).collect()
    kept, n, sums, values, vectors, trace = white_rows(rows, scale=scale)
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-8 and len({r.identity_error for r in got}) == 1
    by = {}
    for r in got:
        by.setdefault((r.id, r.component), []).append(r)
    signs = {}
    for i, x in kept:
        y = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for c in range(4):
            want = y @ vectors[c] / math.sqrt(values[c])
            fits = [r for r in by[i, c + 1] if abs(abs(r.whitened) - abs(want)) < 1e-7 and r.deviation == (deviation if deviation < 1 << 63 else None)]
            assert fits and abs(fits[0].explained - values[c] / trace) < 1e-9
            if abs(want) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(fits[0].whitened * want))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_without_spread(spark):
    ddl = "vec_id bigint, embedding array<float>"
    for rows, want in (([], 0), ([(1, None)], 0), ([(1, [1.0, 2.0])], 0), ([(1, [1.0, 2.0])] * 5, 0), ([(1, [1.0, 2.0]), (2, [1.0, 3.0])], 2), ([(1, [1e30, -1e30]), (2, [0.0, 1.0])], 2)):
        got = whitening.whiten(spark.createDataFrame(rows, ddl)).collect()
        assert len(got) == want and all(r.component == 1 and abs(r.explained - 1) < 1e-9 for r in got)
