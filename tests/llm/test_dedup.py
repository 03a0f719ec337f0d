"""Exact, line, SimHash and substring dedup against plain Python."""

from collections import defaultdict

import numpy as np
import pytest
from plain import SPACE, corpus, lower, near, sha, words

from tidemark.llm import near_copies, simhash
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.fm_index import FMIndex
from tidemark.llm.line_dedup import carried, line_dedup, pack_bitmap, unpack_bitmap
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.session import shuffles_dropped

import re


def ordered(rows):
    return sorted(rows, key=repr)


def test_exact(table):
    rows = corpus() + [(None, "one"), (None, None)]
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub(SPACE, "", t or "")].append((-len(t or ""), d is None, d or 0, d))
    want = []
    for norm, own in groups.items():
        keep = min(own)[3]
        want += [(d, keep, len(own), sha(norm)) for _, _, _, d in own]
    got = exact_dedup(table(rows)).collect()
    assert ordered((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(want)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.kept for r in got if r.group_size == 1) and all(r.id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("fan_in", [2, 3])
def test_exact_many_runs(spark, fan_in):
    df = spark.range(0, 400, 1, 9).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 50 AS string) END AS text")
    got = exact_dedup(df, fan_in=fan_in)
    assert got.where("kept").count() == 51 and got.count() == 400
    assert got.where("kept AND text_sha256 = sha2('hot', 256)").first().group_size == 134


def test_lines(table):
    rows = corpus(2) + [(2000, "A line that is long\nshort\n" * 300 + "end")] + [(None, "A line that is LONG ")]
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    number = lambda d: 2**63 - 1 if d is None else d
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(number(d))
    want = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == number(d)]
        want.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup(table(rows))
    assert {"row", "doc", "Text2", "keep_bitmap"} <= set(got.columns)
    assert ordered((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == ordered(want)


def test_bitmap_and_carried_runs():
    for n in (1, 7, 8, 9, 1000):
        positions = np.unique(np.random.default_rng(n).integers(0, n, 5))
        assert np.flatnonzero(~unpack_bitmap(pack_bitmap(positions), n)).tolist() == positions.tolist()
    one = lambda p, h, d: [(p, 0, h, 0, d), (p, 1, h, 0, d)]
    # A run over three partitions keeps its first document; another hash begins anew.
    assert carried(one(0, 5, 1) + one(1, 5, 4) + one(2, 5, 7) + one(3, 6, 2)) == [(1, 1), (2, 1)]


def test_substring(table):
    rows = corpus(3, 80)
    number = lambda d: 2**63 - 1 if d is None else d
    rows.append((None, rows[5][1]))
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, number(d)), number(d))
    want = []
    for d, t in rows:
        w = words(t)
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < number(d) for j in range(i, i + 50)}
        want.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    assert sum(x[2] for x in want) > 1000
    got = substring_dedup(table(rows))
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.kept_words) for r in got.collect()) == ordered(want)


def test_substring_busy_parent_and_other_contexts(spark, monkeypatch):
    """One passage in many documents, each with words of its own around it: several groups of one parent, and the second search."""
    from tidemark.llm import substring_dedup as module

    monkeypatch.setattr(module, "SHARD", 40)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{' '.join(f'l{i // 2}x{k}' for k in range(30))} {passage} {' '.join(f'r{i}x{k}' for k in range(30))}") for i in range(12)]
    got = {r.doc_id: r.n_removed for r in substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)).collect()}
    # Odd documents share the words before the passage with the one before them.
    assert got == {i: 0 if i == 0 else 90 if i % 2 else 60 for i in range(12)}


@pytest.mark.parametrize("length", [3, 10, 50])
def test_fm_index(length):
    rnd = np.random.default_rng(length)
    for size in (2, 3, 40):
        base = [[b"w%d" % x for x in rnd.integers(0, size, rnd.integers(1, 150))] for _ in range(4)]
        piece = lambda: sum((base[i][int(rnd.integers(0, len(base[i]))) :] for i in rnd.integers(0, 4, 3)), [])
        pieces, asked = [piece() for _ in range(6)], [piece() + [b"never"] + piece() for _ in range(6)]
        docs, own = rnd.integers(0, 9, 6), rnd.integers(0, 11, 6)
        first = {}
        for p, d in zip(pieces, docs.tolist()):
            for i in range(len(p) - length + 1):
                first[tuple(p[i : i + length])] = min(d, first.get(tuple(p[i : i + length]), d))
        for q, d, found in zip(asked, own.tolist(), FMIndex(pieces, docs, length).matches(asked, own)):
            assert found.tolist() == [first.get(tuple(q[i : i + length]), 99) < d for i in range(len(q) - length + 1)]


def fingerprint(text, shingle=4):
    import xxhash

    w = words(lower(text or ""))
    shingles = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(table):
    rows = [r for r in corpus(4) if r[0] != 1005] + [(None, "one more")]
    number = lambda d: 2**63 - 1 if d is None else d
    prints = [fingerprint(t) for _, t in rows]
    roots = near([number(d) for d, _ in rows], prints, lambda a, b: bin(a ^ b).count("1") <= 4)
    got = simhash.simhash_components(table(rows)).collect()
    assert ordered((r.id, r.fp % 2**64, r.component) for r in got) == ordered((d, f, c) for (d, _), f, c in zip(rows, prints, roots))


def shingles(text, size=5):
    w = words(lower(text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def alike(a, b):
    """Similarity of two sets of shingles; of texts without words 1."""
    return len(a & b) / len(a | b) if a or b else 1.0


def test_near_copies(table):
    import random

    rnd = random.Random(9)
    rows = [r for r in corpus(8) if r[0] != 1005] + [(None, "one more")]
    # Copies of long texts with some words changed: clearly above, and clearly below a similarity of 0.8.
    for i in range(12):
        base = [f"b{i}w{rnd.randint(0, 400)}" for _ in range(300)]
        rows.append((3000 + 10 * i, " ".join(base)))
        for k, changed in enumerate((2, 5, 60)):
            copy = list(base)
            for at in rnd.sample(range(300), changed):
                copy[at] = f"new{rnd.random()}"
            rows.append((3001 + 10 * i + k, " ".join(copy)))
    number = lambda d: 2**63 - 1 if d is None else d
    sets = [shingles(t) for _, t in rows]
    roots = near([number(d) for d, _ in rows], sets, lambda a, b: alike(a, b) >= 0.8)
    found = sorted((r.doc, r.component) for r in near_copies.near_copies(table(rows)).collect())
    want = sorted((number(d), c) for (d, _), c in zip(rows, roots))
    # Nothing below the threshold links; long copies and equal texts are all found (texts of a dozen different words may be missed).
    root = dict(want)
    assert [d for d, _ in found] == [d for d, _ in want] and all(root[d] == root[c] for d, c in found if rows.count((d, None)) == 0 and d not in (12, 13))
    assert [x for x in found if 3000 <= x[0] < 4000] == [x for x in want if 3000 <= x[0] < 4000] and len(set(c for d, c in found if d >= 3000)) < 40
    same = dict((number(d), " ".join(words(lower(t or "")))) for d, t in rows)
    for a, x in found:
        assert all(x == y for b, y in found if same[a] == same[b] and not {a, b} & {12, 13})
    kept = near_copies.simhash_dedup(table(rows))
    assert {"row", "node", "Text2"} <= set(kept.columns) and kept.where("doc_id % 10 in (1, 2) and doc_id between 3000 and 3200").count() == 0
    assert {number(r.doc_id) for r in kept.collect()} == {c for _, c in found}


def test_near_copies_of_one_word_set(table):
    """Many orders of the same words share all fingerprints; the copies among them are found."""
    import random

    rnd = random.Random(3)
    vocabulary, rows = [f"w{i}" for i in range(150)], []
    for i in range(70):
        order = rnd.sample(vocabulary, 150)
        rows.append((i, " ".join(order)))
        if i % 10 == 3:
            rows.append((100 + i, " ".join([*order[1:], order[0]])))
    sets = [shingles(t) for _, t in rows]
    roots = near([d for d, _ in rows], sets, lambda a, b: alike(a, b) >= 0.8)
    found = sorted((r.doc, r.component) for r in near_copies.near_copies(table(rows)).collect())
    assert found == sorted((d, c) for (d, _), c in zip(rows, roots)) and sum(d != c for d, c in found) == 7


def moved_copies(n=60, seed=4):
    """Pairs of texts at a similarity of 0.80 to 0.85: words appended, cut off at the end, and one passage replaced."""
    rnd = np.random.default_rng(seed)
    draw = lambda k: [f"v{x}" for x in np.minimum(rnd.zipf(1.3, k), 30_000)]
    out = []
    for i in range(n):
        base = draw(500)
        added = draw(150)
        at = int(rnd.integers(50, 350))
        for k in range(1, 150):
            copy = (base + added[:k], base[: 500 - k], base[:at] + added[:k] + base[at + k :])[i % 3]
            if not alike(shingles(" ".join(base)), shingles(" ".join(copy))) > 0.85:
                break
        if alike(shingles(" ".join(base)), shingles(" ".join(copy))) >= 0.8:
            out.append((("appended", "cut", "replaced")[i % 3], " ".join(base), " ".join(copy)))
    return out


def test_moved_copies(table):
    pairs = moved_copies()
    rows = [(2 * i + k, t) for i, (_, *texts) in enumerate(pairs) for k, t in enumerate(texts)]
    found = {r.doc: r.component for r in near_copies.near_copies(table(rows)).collect()}
    assert len(pairs) > 50 and found == {d: d - d % 2 for d, _ in rows}


def test_pairs_of_groups():
    """Small and large buckets give all pairs of different groups that sizes and places allow."""
    rnd = np.random.default_rng(2)
    rows = sorted((int(k), int(rnd.integers(0, 12)), n, int(rnd.integers(80, 130)), int(rnd.integers(0, 25))) for n, k in enumerate(np.repeat([3, 5, 9, 11], [5, 300, 48, 49])))
    pairs = [p for a, b in near_copies._crossing([np.array(c) for c in zip(*rows)], 0.8) for p in zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())]
    fits = lambda x, y: 9 * min(x[3] - x[4], y[3] - y[4]) >= 4 * (x[3] + y[3])
    want = [(min(x[2], y[2]), max(x[2], y[2])) for i, x in enumerate(rows) for y in rows[i + 1 :] if x[0] == y[0] and x[1] != y[1] and fits(x, y)]
    assert sorted(pairs) == sorted(want) and 0 < len(want) < 40_000


def test_sketches_bound_similarities():
    """The bound is never below the similarity, whatever the widths, and tells unlike sets."""
    rnd = np.random.default_rng(6)
    draw = lambda n: rnd.integers(0, 2**64, n, np.uint64, endpoint=False)
    ruled_out = 0
    for _ in range(2000):
        n = int(rnd.choice([0, 1, 2, 31, 32, 33, 64, 65, 500, 3000]))
        shared, own, others = draw(n), draw(int(rnd.integers(0, 1 + n // 2))), draw(int(rnd.integers(0, 2 + n)))
        a, b = (np.unique(np.concatenate([shared, more])) for more in (own, others))
        real = near_copies.similarity(a.tobytes(), b.tobytes())
        sides = (len(a), near_copies.sketch_of(a)), (len(b), near_copies.sketch_of(b))
        bound = near_copies.similarity_bound(*sides[0], *sides[1])
        assert bound >= real and bound == near_copies.similarity_bound(*sides[1], *sides[0])
        if n >= 500 and real < 0.7:
            assert bound < 0.8
            ruled_out += 1
    assert ruled_out > 50 and near_copies.similarity_bound(*sides[0], *sides[0]) == 1
    a, b = draw(300), draw(300)
    assert near_copies.similarity_bound(300, near_copies.sketch_of(a), 300, near_copies.sketch_of(b)) < 0.6


def test_sets_of_likely_pairs_only(table, monkeypatch):
    """Texts that share shingles but are not similar are told apart without their sets."""
    import random

    rnd = random.Random(12)
    word = lambda: f"w{rnd.randint(0, 10**9)}"
    rows = []
    for i in range(40):
        shared = [word() for _ in range(60)]
        rows += [(2 * i + k, " ".join(shared + [word() for _ in range(40)])) for k in range(2)]
    rows.append((1000, rows[10][1] + " more"))
    stored = {}

    def settle(df, label):
        out = near_settle(df, label)
        stored.setdefault(label, []).append(out.count())
        return out

    near_settle = near_copies.settle
    monkeypatch.setattr(near_copies, "settle", settle)
    found = {r.doc: r.component for r in near_copies.near_copies(table(rows)).collect()}
    assert found == {d: 10 if d == 1000 else d for d, _ in rows}
    assert sum(stored["candidates"]) > 20 and sum(stored["shingle-sets"]) == 2


def test_shuffles_of_near_copies_go(spark, table):
    """What the steps have shuffled is not left to the driver's garbage collection, and the setting is as before."""
    import time
    from pathlib import Path

    folders = [d.getPath() for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    there = lambda: {p.name for d in folders for p in Path(d).glob("*/shuffle_*")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs = table([(i, f"some words of text {i // 2} " * 8) for i in range(40)])
    before, setting = there(), spark.conf.get(name)
    found = near_copies.near_copies(docs)
    end = time.time() + 20
    while (left := there() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and spark.conf.get(name) == setting and found.count() == 40
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        1 / 0
    assert spark.conf.get(name) == setting


def test_simhash_masks_and_chains():
    """Whatever 4 bits differ, some mask agrees and some chain holds."""
    rnd = np.random.default_rng(7)
    masks = [np.uint64(m) for m in simhash.masks()]
    assert len(masks) == 35 and min(int(m).bit_count() for m in masks) >= 24
    flips = np.array([sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 5), replace=False)) for _ in range(20_000)], np.uint64)
    assert np.any([(flips & m) == 0 for m in masks], axis=0).all() and simhash.linked(flips).all()
    assert not simhash.linked(np.array([0b11111, 2**63 | 2**50 | 2**33 | 2**20 | 1], np.uint64)).any()


def test_simhash_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rnd = np.random.default_rng(3)
    prints = np.unique((np.int64(1) << rnd.integers(0, 62, (60, 4))).sum(axis=1) ^ np.int64(123456789))
    nodes = spark.createDataFrame([(i, int(f)) for i, f in enumerate(prints)], "node bigint, fp bigint")
    found = {r.node: r.component for r in components(simhash.fingerprint_edges(nodes)).collect()}
    want = near(list(range(len(prints))), prints.tolist(), lambda a, b: (a ^ b).bit_count() <= 4)
    assert [found.get(i, i) for i in range(len(prints))] == want


def test_components(spark):
    rnd = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(40)] + [tuple(map(int, e)) for e in rnd.integers(50, 120, (50, 2))] + [(200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = near(list(range(201)), list(range(201)), lambda a, b: False)
    from plain import components as plain_components

    want = plain_components(201, edges)
    assert all(got.get(i, i) == want[i] for i in range(201)) and got[40] == 0


def test_empty_tables(table):
    empty = table([])
    assert exact_dedup(empty).count() == 0 and line_dedup(empty).count() == 0
    assert substring_dedup(empty).count() == 0 and simhash.simhash_components(empty).count() == 0 and near_copies.simhash_dedup(empty).count() == 0


@pytest.mark.parametrize("step", [1, 64, 96])
def test_substring_pieces_are_dealt_evenly(step):
    """A hot passage in documents whose ids have one residue, and in many places of one document, fills all groups of its parent."""
    from tidemark.llm.substring_dedup import _dealt

    for pairs in ([(i * step, 0) for i in range(4800)], [(7, i * step) for i in range(4800)]):
        dealt = np.bincount([_dealt(d, s, 12) for d, s in pairs], minlength=12)
        assert dealt.min() > 300 and dealt.max() < 500
