"""Near copies: SimHash views of the words link most of them, an exact prefix filter finds the rest, the similarity of word shingles decides.

Each text gets ``VIEWS`` fingerprints of its set of words with independent hashes. Pairs are candidates if, in any view, two consecutive segments agree, the chains of segments
stay within their budgets and the whole difference is ``LIMIT`` bits at most (pigeonring filter, see ``simhash``). This misses pairs, and large buckets give only a tree of
candidates; what it links cheaply are large groups.

All other pairs come from prefixes. Shingles have one order for all texts. If two sets have a similarity of ``least``, the first ``n - ceil(least n) + 1`` of the n shingles
of each have one in common, so texts of different groups that share such a shingle, and whose sizes and places of it allow that similarity, are compared: no pair is missed. The order has
common shingles (counted in a sample of texts) last, as shared passages would else make large buckets; whatever it is, the result is the same.

Candidates by chance grow faster than the input, so whole sets are fetched only for pairs whose sketches allow the similarity. A sketch has the parity of how many shingles fall to
each bit: sets differ in at least as many shingles as their sketches in bits, so no pair is lost.

Equal texts (equal words, A-Z in lower case) are reduced to one before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.rows import keyed
from tidemark.llm.simhash import SEED, SEGMENTS, fingerprint_edges
from tidemark.session import release, settle, shuffles_dropped

VIEWS = 8
LIMIT = 10
#: Bits of two consecutive segments of the ring.
PAIRS = [SEGMENTS[i] | SEGMENTS[(i + 1) % 5] for i in range(5)]
ROWS = "doc bigint, version bigint, same binary, n_words bigint, views array<bigint>, size bigint, prefix array<bigint>, sketch binary"
#: One of so many texts is counted; a shingle is common if it is in ``COMMON`` counted texts, or in more if there are over ``MOST_COMMON`` of these.
SAMPLE, COMMON, MOST_COMMON = 16, 4, 200_000
#: Rows of a bucket that are compared by shifts, and pairs of a larger one that are compared at a time.
_SMALL, _PAIRS = 48, 1 << 20
#: Texts whose sets are wanted that are sent to all tasks, which then read the documents without a shuffle.
_FEW = 100_000
#: Above so many fingerprints a bucket of views gives a tree of candidates; the prefixes decide what a tree leaves out.
_TREE = 4
#: Against rounding: a bound is never above its exact value.
_EPS = 1e-9


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def view_fingerprints(words: list[bytes]) -> list[int]:
    """Signed fingerprints of the set of words, one per view."""
    import xxhash

    base = np.array([xxhash.xxh64_intdigest(w, SEED) for w in set(words)], np.uint64)
    out = []
    for view in range(VIEWS):
        mixed = base + np.uint64((view + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out.append(int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(base), bitorder="little").view("<i8")[0]))
    return out


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted hashes of the different shingles; a text of fewer words is one shingle."""
    import xxhash

    shingles = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8"))


def similarity(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def sketch_of(shingles: np.ndarray) -> bytes:
    """One bit or more for each half of a shingle, a power of two in all: whether the number of shingles that fall to it is odd."""
    width = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def similarity_bound(size_a: int, sketch_a: bytes, size_b: int, sketch_b: bytes) -> float:
    """The most that the similarity of sets of these sizes and sketches can be; the longer sketch is folded to the length of the other."""
    a, b = int.from_bytes(sketch_a, "little"), int.from_bytes(sketch_b, "little")
    if len(sketch_a) < len(sketch_b):
        a, b = b, a
    width, least = 8 * max(len(sketch_a), len(sketch_b)), 8 * min(len(sketch_a), len(sketch_b))
    while width > least:
        width //= 2
        a = a >> width ^ a & (1 << width) - 1
    total = size_a + size_b
    both = min(size_a, size_b, (total - (a ^ b).bit_count()) // 2)
    return both / (total - both) if total else 1.0


def common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of common shingles, ``MOST_COMMON`` at most. ``docs`` as of ``keyed``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(words_of(text.as_py()), size).view("<i8"))], names=["key"])

    sample = docs.where(F.pmod("version", F.lit(SAMPLE)) == 0).select("text")
    counts = settle(sample.mapInArrow(compute, "key bigint").groupBy("key").count().where(F.col("count") >= COMMON), "common-shingles")
    # One row per power of two.
    sizes = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("count"))).count().collect()}
    least, total = COMMON, 0
    for power in sorted(sizes, reverse=True):
        total += sizes[power]
        if total > MOST_COMMON:
            least = 2 ** (power + 1)
            break
    found = counts.where(F.col("count") >= least).select("key").toArrow().column("key").to_numpy()
    return np.sort(found.astype("<i8").view("<u8"))


def prefix_of(shingles: np.ndarray, common: np.ndarray, least: float) -> np.ndarray:
    """The first of the sorted ``shingles``, common ones last: two sets of similarity ``least`` share one of these."""
    if len(common):
        last = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] == shingles
        shingles = np.concatenate([shingles[~last], shingles[last]])
    return shingles[: len(shingles) - math.ceil(least * len(shingles) - _EPS) + 1]


def text_rows(docs: DataFrame, size: int, least: float) -> DataFrame:
    """Per row: the hash of its words, their count, the views, the number of shingles, their prefix and sketch. ``docs`` as of ``keyed``."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, size))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        common = shared.value
        for batch in batches:
            same, counts, views, sizes, prefixes, sketches = [], [], [], [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                same.append(xxhash.xxh3_128_digest(b" ".join(words)))
                counts.append(len(words))
                views.append(view_fingerprints(words))
                shingles = shingle_set(words, size)
                sizes.append(len(shingles))
                prefixes.append(prefix_of(shingles, common, least).view("<i8"))
                sketches.append(sketch_of(shingles))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("version"), pa.array(same, pa.binary()), pa.array(counts, pa.int64()), pa.array(views, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())],
                names=["doc", "version", "same", "n_words", "views", "size", "prefix", "sketch"])

    return docs.select("doc", "version", "text").mapInArrow(compute, ROWS)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition sorted by key whose key is not alone. Holds one row and one batch."""
    held, known = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = rows.column("key").to_numpy()
        equal = key[1:] == key[:-1]
        keep = np.concatenate([equal, [False]]) | np.concatenate([[known], equal])
        yield rows.slice(0, len(key) - 1).filter(pa.array(keep[:-1]))
        held, known = rows.slice(len(key) - 1), bool(keep[-1])
    if held is not None and known:
        yield held


def _possible(size_a, at_a, size_b, at_b, least: float) -> np.ndarray:
    """Whether sets of these sizes whose first common shingle is at these places can have the similarity ``least``."""
    return np.minimum(size_a - at_a, size_b - at_b) >= least / (1 + least) * (size_a + size_b) - _EPS


def _crossing(columns: list[np.ndarray], least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes of different groups that may be similar, in whole runs of equal key, sorted by key and group."""
    key, group, node, size, at = columns
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    small = np.repeat(sizes <= _SMALL, sizes)
    for step in range(1, min(_SMALL, int(sizes.max()))):
        i = np.flatnonzero(small[:-step] & (key[:-step] == key[step:]))
        if not len(i):
            break
        j = i + step
        found = (group[i] != group[j]) & _possible(size[i], at[i], size[j], at[j], least)
        if found.any():
            yield node[i[found]], node[j[found]]
    for start, n in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL]):
        end = start + n
        firsts = start + np.flatnonzero(np.concatenate([[True], group[start + 1 : end] != group[start : end - 1]]))
        # Each group with all behind it; a long group in pieces.
        for first, behind in zip(firsts, firsts[1:]):
            rows = max(1, _PAIRS // int(end - behind))
            for a in range(first, behind, rows):
                own = slice(a, min(a + rows, behind))
                i, j = np.nonzero(_possible(size[own, None], at[own, None], size[None, behind:end], at[None, behind:end], least))
                if len(i):
                    yield node[a + i], node[behind + j]


def _cross_pairs(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs of a partition sorted by key and group. Holds one run and one batch."""
    held = [np.zeros(0, np.int64)] * 5

    def out(columns) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            for a, b in _crossing(columns, least):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        columns = [np.concatenate(pair) for pair in zip(held, (batch.column(i).to_numpy() for i in range(5)))]
        end = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
        yield from out([c[:end] for c in columns])
        held = [c[end:] for c in columns]
    yield from out(held)


def shared_shingles(groups: DataFrame) -> DataFrame:
    """key, node, size, at: the shingles that are in the prefixes of several texts."""
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups.where("n_words > 0").select("node", "size", F.posexplode("prefix").alias("at", "key")).select("key", "node", "size", F.col("at").cast("bigint").alias("at"))
    return settle(rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_repeated, "key bigint, node bigint, size bigint, at bigint"), "shared-shingles")


def prefix_pairs(shared: DataFrame, linked: DataFrame, least: float) -> DataFrame:
    """a, b: all pairs that may have the similarity ``least`` and are in different components of ``linked`` (node, component). ``shared``: see ``shared_shingles``."""
    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = settle(shared.join(linked, "node", "left").select("key", F.coalesce("component", "node").alias("group"), "node", "size", "at"), "grouped-shingles")
    # Most buckets are within one group.
    mixed = grouped.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x < y").select("key")
    ordered = grouped.join(mixed, "key", "left_semi").repartition(parts, "key").sortWithinPartitions("key", "group")
    return ordered.mapInArrow(lambda batches: _cross_pairs(batches, least), "a bigint, b bigint").distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, shingles (binary) of the documents in ``wanted`` (node, doc, version)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words_of(t.as_py()), size).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    found = docs.select("doc", "version", "text").join(wanted, ["doc", "version"]).select("node", "text").mapInArrow(compute, "node bigint, shingles binary")
    # Rows that repeat id and text give the same set again.
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def likely(sketches: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """Of ``pairs`` (a, b; settled, they are deleted) those whose sketches allow a similarity of at least ``least``. ``sketches``: node, size, sketch."""
    both = pairs.join(sketches.toDF("a", "m", "x"), "a").join(sketches.toDF("b", "n", "y"), "b")
    bound = F.pandas_udf(_similarity_bounds, "double").asNondeterministic()  # evaluated once, before the filter
    found = settle(both.select("a", "b", bound("m", "x", "n", "y").alias("bound")).where(F.col("bound") >= least).select("a", "b"), "likely-pairs")
    release(pairs)
    return found


def similar(docs: DataFrame, groups: DataFrame, pairs: DataFrame, size: int, least: float) -> DataFrame:
    """Of ``pairs`` (a, b; settled) those with a similarity of at least ``least``."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct().join(groups, "node").select("node", "first.doc", "first.version")
    wanted = settle(wanted, "wanted")
    sets = settle(shingle_sets(docs, F.broadcast(wanted) if wanted.count() <= _FEW else wanted, size), "shingle-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    measure = F.pandas_udf(_similarities, "double").asNondeterministic()  # evaluated once, before the filter
    links = settle(both.select("a", "b", measure("x", "y").alias("similarity")).where(F.col("similarity") >= least).select("a", "b"), "near-links")
    release(sets, wanted)
    return links


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, least: float = 0.8) -> DataFrame:
    """doc (the id; nulls as the largest long), version, component: one row per row of ``docs``.

    Texts link when the Jaccard similarity of their sets of ``shingle_words``-word shingles is at least ``least``; words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.
    The component is the smallest id that links reach. Texts with equal words always link, also empty and null ones. Rows of equal id are documents of their own.
    An empty table gives no rows.
    """
    texts = keyed(docs, id_col, text_col)
    # What a step has shuffled goes with it: on large inputs the driver collects its garbage too seldom.
    with shuffles_dropped(docs.sparkSession):
        rows = settle(text_rows(texts, shingle_words, least), "text-rows")
        first = F.min(F.struct("doc", "version"))
        one = [F.first(c).alias(c) for c in ("views", "size", "prefix", "sketch")]
        whole = settle(rows.groupBy("same").agg(first.alias("first"), F.max("n_words").alias("n_words"), *one).withColumn("node", F.monotonically_increasing_id()), "texts")
        # Prefixes are large; what holds them goes when it is not needed any more.
        groups = settle(whole.select("same", "node", "first"), "text-nodes")
        sketches = settle(whole.select("node", "size", "sketch"), "sketches")
        slim = settle(rows.select("doc", "version", "same"), "text-rows")
        release(rows)
        shared = shared_shingles(whole)
        views = whole.where("n_words > 0").select("node", F.posexplode("views").alias("view", "fp"))
        pairs = settle(fingerprint_edges(views, PAIRS, LIMIT, "view", _TREE).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
        release(whole)
        links = similar(texts, groups, likely(sketches, pairs, least), shingle_words, least)
        more = settle(prefix_pairs(shared, settle(components(links), "linked"), least), "candidates")
        release(shared)
        links = links.unionByName(similar(texts, groups, likely(sketches, more, least), shingle_words, least))
        release(sketches)
        linked = components(links)
    found = groups.select("same", "node", F.col("first.doc").alias("doc")).join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = found.groupBy("component").agg(F.min("doc").alias("smallest"))
    labelled = found.join(smallest, "component").select("same", F.col("smallest").alias("component"))
    return slim.join(labelled, "same").select("doc", "version", "component")


def _similarities(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([similarity(a, b) for a, b in zip(x, y)], dtype=float)


def _similarity_bounds(m: pd.Series, x: pd.Series, n: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([similarity_bound(*pair) for pair in zip(m, x, n, y)], dtype=float)


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, least: float = 0.8) -> DataFrame:
    """``docs`` with one document of each component of near copies: the one with the smallest id.

    Rows that repeat that id stay if their own component is the same. ``docs`` may have any columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = near_copies(docs, id_col, text_col, shingle_words, least).where(F.col("doc") == F.col("component")).select("doc", "version").distinct()
    return keyed(docs, id_col, text_col, row).drop("text").join(kept, ["doc", "version"], "left_semi").select("row.*")
