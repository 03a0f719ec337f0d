"""Embedding near-dedup with randomised-rotation binary codes.

Unit vectors are rotated by a random orthogonal matrix. A vector's code is the signs of its rotated coordinates, stored with its correction factor, the cosine between the
vector and its code. The inner product of a code with another rotated vector, divided by the factor, estimates the cosine without bias. What the estimate can be wrong by
is bounded: the angles between the two vectors, and between vector and code, and between code and the other vector are sides of a triangle on the sphere. This bound holds
always (a confidence of 1) and leaves about one random pair in ten million at a threshold of 0.98; only pairs that it cannot decide are computed exactly, in double precision.

Which vectors meet: the home of a vector is the cell of signs of its first ``w`` rotated coordinates. Where two linked vectors differ in sign, the squares of both sum up to at most the
square of their distance, so one of them needs no more than half of it to reach the other's home. Each vector visits all cells within that reach, which finds every linked pair; the cells get finer as a label
grows. Equal vectors are one row with a count. Cells with many vectors are cut into blocks. Tasks return counts of links and edges of a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.rows import NO_ID, whole_row
from tidemark.session import settle

#: Vectors of a cell, about; and residents and visitors of a block.
CELL, RESIDENTS, VISITORS = 1024, 2048, 4096
MOST_BITS = 24
SEED = 20250101
_ROTATIONS: dict[int, np.ndarray] = {}
PLACED = "label string, node bigint, n bigint, cell bigint, home boolean, vector array<float>, bits int"
LINKS = "edge boolean, a bigint, b bigint"


def rotation(dim: int) -> np.ndarray:
    """The same random orthogonal matrix in every task."""
    if dim not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).normal(size=(dim, dim)))
        _ROTATIONS[dim] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim]


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors; of one dimension, none zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)) @ rotation(vectors.shape[1]).T


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of rotated unit vectors and their correction factors."""
    return np.packbits(unit >= 0, axis=1), np.abs(unit).sum(axis=1) / math.sqrt(unit.shape[1])


def code_products(packed: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Inner products of codes (as unit vectors) and rotated unit vectors."""
    signs = np.unpackbits(packed, axis=1, count=unit.shape[1]).astype(np.float32) * 2 - 1
    return signs @ (unit.T / math.sqrt(unit.shape[1])).astype(np.float32)


def estimate(packed: np.ndarray, factors: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the cosines between coded vectors and rotated unit vectors."""
    return code_products(packed, unit) / factors[:, None]


def undecided(packed: np.ndarray, factors: np.ndarray, unit: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the cosine of a pair can reach ``threshold``: the bounds around the estimate, times the factor, do not exclude it."""
    product = code_products(packed, unit)
    own, reach = np.arccos(np.clip(factors, -1, 1)), math.acos(min(1.0, threshold)) + 1e-5
    return (product >= np.cos(np.minimum(np.pi, own + reach))[:, None] - 1e-5) & (product <= np.cos(np.maximum(0, own - reach))[:, None] + 1e-5)


def visits(unit: np.ndarray, bits: int, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and cells: each vector's home and every cell whose nearest point needs sign changes with squares of ``budget`` at most."""
    head = unit[:, :bits]
    home = ((head >= 0).astype(np.int64) << np.arange(bits)).sum(axis=1)
    rows, cells, spent = np.arange(len(unit)), home, np.zeros(len(unit))
    for b in range(bits):
        more = spent + head[rows, b] ** 2
        can = more <= budget
        rows, cells, spent = np.concatenate([rows, rows[can]]), np.concatenate([cells, cells[can] ^ (1 << b)]), np.concatenate([spent, more[can]])
    return rows, cells


def _budget(threshold: float) -> float:
    """Half of the squared distance of unit vectors at the threshold."""
    return (1 - threshold) * (1 + 1e-9) + 1e-12


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def place(groups: DataFrame, threshold: float) -> DataFrame:
    """A row for each cell that a vector visits. ``groups``: label, node, n, vector, bits; of any dimensions."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(v) for v in batch.column("vector")])
            bits = batch.column("bits").to_numpy(zero_copy_only=False)
            for dim, w in sorted(set(zip(size.tolist(), bits.tolist()))):
                own = batch.filter(pa.array((size == dim) & (bits == w)))
                unit = rotated(_matrix(own.column("vector")))
                rows, cells = visits(unit, min(w, dim), _budget(threshold))
                for a in range(0, len(rows), 20_000):
                    at = pa.array(rows[a : a + 20_000])
                    yield pa.RecordBatch.from_arrays([
                        own.column("label").take(at), own.column("node").take(at), own.column("n").take(at), pa.array(cells[a : a + 20_000]),
                        pa.array(np.arange(a, a + len(at)) < len(unit)), own.column("vector").take(at), own.column("bits").take(at),
                    ], names=[c.split()[0] for c in PLACED.split(", ")])

    return groups.select("label", "node", "n", "vector", "bits").mapInArrow(visit, PLACED)


def _links(table: pa.Table, threshold: float) -> list[tuple[bool, int, int]]:
    """Links within one block of one cell, whose vectors have one dimension. ``role`` 0: residents; 1: visitors, residents among them."""
    role = table.column("role").to_numpy()
    sides = []
    for r in (0, 1):
        own = table.filter(pa.array(role == r)).combine_chunks()
        vector = _matrix(own.column("vector").combine_chunks()) if len(own) else np.zeros((0, 1))
        sides.append((own.column("node").to_numpy(), own.column("n").to_numpy(), own.column("home").to_numpy(), vector))
    (ra, na, _, va), (rb, nb, hb, vb) = sides
    if not len(ra) or not len(rb):
        return []
    ua, ub = rotated(va), rotated(vb)
    bits, budget = min(int(table.column("bits")[0].as_py()), ua.shape[1]), _budget(threshold)
    packed, factors = codes(ua)
    la, lb = np.linalg.norm(va, axis=1), np.linalg.norm(vb, axis=1)
    pairs, shifts = [], np.arange(bits)
    for a in range(0, len(ra), 256):
        i, j = np.nonzero(undecided(packed[a : a + 256], factors[a : a + 256], ub, threshold))
        i += a
        for s in range(0, len(i), 100_000):
            x, y = i[s : s + 100_000], j[s : s + 100_000]
            # Both at home: each pair once. Else, if each visits the other, only in the smaller home.
            flipped = (ua[x, :bits] >= 0) != (ub[y, :bits] >= 0)
            other = np.where(flipped, ua[x, :bits] ** 2, 0).sum(axis=1) <= budget
            cell_a, cell_b = (((u >= 0).astype(np.int64) << shifts).sum(axis=1) for u in (ua[x, :bits], ub[y, :bits]))
            once = np.where(hb[y], ra[x] < rb[y], ~other | (cell_a < cell_b))
            x, y = x[once], y[once]
            exact = np.einsum("ij,ij->i", va[x], vb[y]) / (la[x] * lb[y]) >= threshold
            pairs.append((x[exact], y[exact]))
    x, y = (np.concatenate(p) for p in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    if not len(x):
        return []
    # Links of each vector, counted with copies.
    nodes, at = np.unique(np.concatenate([ra[x], rb[y]]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([nb[y], na[x]])).astype(np.int64)
    ends = at.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        np.minimum.at(new, ends[0], root[ends[1]])
        np.minimum.at(new, ends[1], root[ends[0]])
        new = new[new]
        if (new == root).all():
            break
        root = new
    out = [(False, int(v), int(c)) for v, c in zip(nodes, counts)]
    return out + [(True, int(v), int(nodes[r])) for v, r in zip(nodes, root) if nodes[r] != v]


def find_links(groups: DataFrame, threshold: float) -> DataFrame:
    """edge, a, b: edges of a spanning forest between nodes, and (not edge) for node a how many links some block has found."""
    placed = settle(place(groups, threshold).withColumn("dim", F.size("vector")), "visits")
    key = ["label", "dim", "cell"]
    # One row per cell: how many blocks its residents and its visitors are cut into.
    blocks = placed.groupBy(*key).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / RESIDENTS).cast("int").alias("rows"), F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("columns"))
    cut = placed.join(blocks.where("rows > 0"), key)
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("rows"))
    other = F.pmod(F.xxhash64("node", F.lit(2)), F.col("columns"))
    numbers = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c).cast("bigint") - 1))
    common = [*key, "node", "n", "home", "vector", "bits"]
    residents = cut.where("home").select(*common, F.lit(0).alias("role"), own.alias("i"), numbers("columns").alias("j"))
    visitors = cut.select(*common, F.lit(1).alias("role"), other.alias("j"), numbers("rows").alias("i"))

    def compare(table: pa.Table) -> pa.Table:
        found = _links(table, threshold)
        columns = list(zip(*found)) if found else [()] * 3
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.bool_(), pa.int64(), pa.int64()))], names=["edge", "a", "b"])

    return residents.unionByName(visitors).groupBy(*key, "i", "j").applyInArrow(compare, LINKS)


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """For each row: id, n_links, component, kept.

    Vectors link when their labels are equal and not null, their dimensions are equal and their cosine is at least ``threshold`` (above 0), in double precision. A vector that is null, empty or zero, or
    has a null or non-finite component, links with nothing. ``n_links`` counts the other rows a row links with, ``component`` is the smallest id that its links reach, ``kept`` says that it is the row's
    own. Rows of equal id are vectors of their own and are kept or not together. A null id comes after all others. An empty table gives no rows. Other columns are not read.
    """
    value = F.col(f"`{vector_col}`").cast("array<float>")
    good = (
        F.col(f"`{label_col}`").isNotNull() & value.isNotNull() & (F.size(value) > 0) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(value, lambda x: x != 0)
    )
    rows = settle(vectors.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID)).alias("key"), F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(good, F.lit(False)).alias("good"),
        F.when(good, F.col(f"`{label_col}`").cast("string")).alias("label"), F.when(good, value).alias("vector"),
    ), "vectors")
    # Ids need not be unique, so a group of equal vectors is named by a number of its own.
    groups = settle(
        rows.where("good").groupBy("label", "vector").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).withColumn("node", F.monotonically_increasing_id()), "vector-groups")
    # One row per label: the sign bits of a cell.
    bits = F.least(F.lit(MOST_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.count(F.lit(1)) / CELL)).cast("int")))
    links = settle(find_links(groups.join(groups.groupBy("label").agg(bits.alias("bits")), "label"), threshold), "links")
    counts = links.where("not edge").groupBy("a").agg(F.sum("b").alias("links"))
    found = components(links.where("edge").select("a", "b"))
    linked = groups.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = linked.groupBy("component").agg(F.min("first").alias("smallest"))
    labelled = linked.join(smallest, "component").join(counts, F.col("node") == F.col("a"), "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("smallest").alias("component"))
    good_rows = rows.where("good").join(labelled, ["label", "vector"]).select("id", "n_links", "component", (F.col("component") == F.col("key")).alias("kept"))
    alone = rows.where("not good").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component"), F.lit(True).alias("kept"))
    return good_rows.unionByName(alone)
