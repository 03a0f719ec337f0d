import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import nest, numbering


@pytest.fixture()
def skewed(spark):
    rnd = random.Random(1)
    data = [(0 if rnd.random() < 0.4 else (None if rnd.random() < 0.1 else rnd.randrange(20)), i) for i in range(500)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "g int, v int").repartition(5), data


def test_number_rows(skewed):
    df, data = skewed
    got = {r["v"]: r["row_index"] for r in numbering.number_rows(df, ["v"]).collect()}
    assert got == {i: i for i in range(500)}


def test_batches(skewed):
    df, _ = skewed
    sizes = numbering.batch_rows(df, ["v"], 120).groupBy("batch").count().orderBy("batch").collect()
    assert [(r["batch"], r["count"]) for r in sizes] == [(0, 120), (1, 120), (2, 120), (3, 120), (4, 20)]
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            numbering.batch_rows(df, ["v"], bad)


@pytest.mark.parametrize("hot", [10_000, 100, 3])
def test_places_in_group(skewed, hot):
    df, data = skewed
    want = {}
    for g in {g for g, _ in data}:
        for i, v in enumerate(sorted(v for h, v in data if h == g)):
            want[v] = i
    got = {r["v"]: r["place"] for r in numbering.numbered_in_group(df, ["g"], ["v"], hot_rows=hot).collect()}
    assert got == want


def test_lists_are_bounded_and_complete(skewed):
    df, data = skewed
    pages = numbering.numbered_lists(df, ["g"], ["v"], ["v"], "vs", 7, hot_rows=50).collect()
    assert max(len(p["vs"]) for p in pages) == 7
    found = {}
    for p in sorted(pages, key=lambda p: p["page"]):
        found.setdefault(p["g"], []).extend(x["v"] for x in p["vs"])
    assert found == {g: sorted(v for h, v in data if h == g) for g in {g for g, _ in data}}


@pytest.mark.parametrize("offset,size", [(0, 10), (20, 7), (495, 10), (600, 5)])
def test_deep_pages_equal_shallow_ones(skewed, monkeypatch, offset, size):
    df, _ = skewed
    shallow = [r["v"] for r in numbering.page(df, [F.col("v").desc()], size, offset).collect()]
    monkeypatch.setattr(numbering, "SHALLOW_PAGE", 1)
    assert [r["v"] for r in numbering.page(df, [F.col("v").desc()], size, offset).collect()] == shallow
    with pytest.raises(ValueError):
        numbering.page(df, ["v"], -1)


def test_envelope(skewed):
    df, _ = skewed
    assert tuple(numbering.page_envelope(df, 100, 450).first()) == (100, 50, 500, 450, False, True)
    assert tuple(numbering.page_envelope(df, 100, 900).first()) == (100, 0, 500, 900, False, True)


def test_nest_and_unnest(spark, rows):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    child = spark.createDataFrame([(1, i, f"x{i}") for i in range(5)] + [(2, 9, "y"), (7, 1, "orphan")], "fk int, k int, v string")
    nested = nest.nest(parent, child, "id", "fk", "kids", ["k"], 2)
    assert [(r["id"], r["page"], len(r["kids"])) for r in nested.orderBy("id", "page").collect()] == [(1, 0, 2), (1, 1, 2), (1, 2, 1), (2, 0, 1), (3, 0, 0)]
    assert rows(nest.unnest(nested, "kids", ["id"])) == sorted([(1, i, f"x{i}") for i in range(5)] + [(2, 9, "y")], key=repr)
    assert nest.rows_to_structs(child, ["fk"], ["k"]).where("fk = 1").first()["rows"][4]["v"] == "x4"


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_walk_by_tokens(spark, size):
    import datetime

    from tidemark.operators.numbering import keyset_page

    at = lambda i: datetime.datetime(2025, 1, 1, 0, 0, 0, i)
    data = [(i % 3 if i % 4 else None, "a'\"b" if i % 2 else None, i / 7, at(i % 5), i % 6) for i in range(17)]
    data += [(1, "same", 0.5, at(3), 2)] * 9
    df = spark.createDataFrame(data, "a int, b string, c double, d timestamp_ntz, e bigint").repartition(3)
    order = ["b", "a"]
    want = [tuple(r) for r in df.orderBy(*[F.col(c).asc_nulls_first() for c in ["b", "a", "c", "d", "e"]]).collect()]
    forth, page = [], keyset_page(df, order, size)
    pages = [page]
    while True:
        forth += [tuple(r) for r in page.in_order().collect()]
        if page.next is None:
            break
        page = keyset_page(df, order, size, page.next)
        pages.append(page)
    assert forth == want
    if size >= 3:
        back = [tuple(r) for r in page.in_order().collect()]
        while page.previous is not None:
            page = keyset_page(df, order, size, page.previous)
            back = [tuple(r) for r in page.in_order().collect()] + back
        assert back == want
    assert keyset_page(df.limit(0), order, size).next is None


@pytest.mark.parametrize("shallow", [1, 100_000])
def test_large_pages_stay_off_the_driver(spark, monkeypatch, shallow):
    """A walk over 3,000 rows, half of them alike: the driver gets the rows at the ends of a page, and the pages are the same however they are cut."""
    from pyspark.sql.classic.dataframe import DataFrame

    data = [(i % 7 if i % 2 else 3, i if i % 2 else 0) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(4)
    monkeypatch.setattr(numbering, "SHALLOW_PAGE", shallow)
    collected, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(got := collect(self)) or got)
    pages = [numbering.keyset_page(df, ["a"], 700)]
    while pages[-1].next is not None:
        pages.append(numbering.keyset_page(df, ["a"], 700, pages[-1].next))
    back = [pages[-1]]
    while back[-1].previous is not None:
        back.append(numbering.keyset_page(df, ["a"], 700, back[-1].previous))
    assert max(map(len, collected), default=0) <= 100
    monkeypatch.undo()
    rows = [[tuple(r) for r in p.in_order().collect()] for p in pages]
    assert sum(rows, []) == sorted(data) and [len(r) for r in rows] == [700] * 4 + [200]
    assert [[tuple(r) for r in p.in_order().collect()] for p in back[::-1]] == rows
