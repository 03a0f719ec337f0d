"""SimHash near-dedup with pigeonring filtering.

A fingerprint of 64 bits has 5 segments in a ring. If two fingerprints differ in at most 4 bits, some segment begins a chain of consecutive segments whose
differences, summed over the first n of them, are at most 4n/5 for every n: 0, 1, 2, 3 and 4 bits. The first three conditions give the keys that
candidates must share (35 masks of 26 bits or more, see ``masks``), all of them the check that candidates must pass before their
whole difference is counted.

Fingerprints, not documents, are compared: equal ones are first reduced to their smallest document. In a bucket only the edges of a
spanning forest are made, never all pairs; buckets of many different fingerprints are cut into blocks that are compared two by two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import settle

SEED = 42
BITS = 4
WIDTHS = (13, 13, 13, 13, 12)
#: Fingerprints of one bucket that are compared in one piece.
BLOCK = 20_000
_SMALL = 48
_STARTS = np.cumsum((0, *WIDTHS))


def _mask(start: int, width: int) -> int:
    return ((1 << width) - 1) << start


SEGMENTS = [_mask(int(s), w) for s, w in zip(_STARTS, WIDTHS)]


def _cut(segment: int, pieces: int) -> list[int]:
    start, width = int(_STARTS[segment]), WIDTHS[segment]
    ends = [round(width * i / pieces) for i in range(pieces + 1)]
    return [_mask(start + a, b - a) for a, b in zip(ends, ends[1:])]


def masks() -> list[int]:
    """Masks of bits in which linked fingerprints agree, for at least one mask.

    In a chain the first segment agrees. If the second one agrees too, the third differs in 2 bits at most, so one third of it agrees. Else the
    second differs in 1 bit and the third in 1 at most, so one half of each agrees.
    """
    out = []
    for i in range(5):
        second, third = (i + 1) % 5, (i + 2) % 5
        out += [SEGMENTS[i] | SEGMENTS[second] | part for part in _cut(third, 3)]
        out += [SEGMENTS[i] | a | b for a in _cut(second, 2) for b in _cut(third, 2)]
    return out


def in_chain(difference: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether some chain of segments stays within its budgets. ``difference``: exclusive or of two fingerprints."""
    counts = np.stack([np.bitwise_count(difference & np.uint64(m)) for m in SEGMENTS]).astype(np.int64)
    found = np.zeros(difference.shape, bool)
    for i in range(5):
        total, within = np.zeros(difference.shape, np.int64), np.ones(difference.shape, bool)
        for n in range(5):
            total += counts[(i + n) % 5]
            within &= 5 * total <= bits * (n + 1)
        found |= within
    return found


def linked(difference: np.ndarray, bits: int = BITS) -> np.ndarray:
    out = in_chain(difference, bits)
    out[out] = np.bitwise_count(difference[out]) <= bits
    return out


def fingerprint(text: str, shingle_words: int) -> int:
    """Bit i is 1 if it is set in over half the hashes of the text's word shingles."""
    import xxhash

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    body, n = b" ".join(words), len(words)
    sizes = np.fromiter(map(len, words), np.int64, n) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    last = np.arange(min(shingle_words, n) - 1, n)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(body[a:b], SEED) for a, b in zip(starts[: len(last)].tolist(), ends[last].tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """id, fp (signed long); one row per document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(compute, "id bigint, fp bigint")


def _forest(fps: np.ndarray, nodes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges (node, node) that connect what is linked: each search from a fingerprint looks only at those not yet reached.

    The first search begins in the middle, at the fingerprint that differs least from the majority of all bits.
    """
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(fps), bitorder="little").view("<u8")[0]
    left = np.argsort(np.bitwise_count(fps ^ majority), kind="stable")
    while len(left) > 1:
        found, left = [left[0]], left[1:]
        while found and len(left):
            at = found.pop()
            near = linked(fps[left] ^ fps[at], limit)
            reached, left = left[near], left[~near]
            if len(reached):
                yield np.full(len(reached), nodes[at]), nodes[reached]
                found += reached.tolist()


def _edges(keys: np.ndarray, fps: np.ndarray, nodes: np.ndarray, limit: int, most: int = _SMALL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges within runs of equal key; whole runs only. Runs of up to ``most`` give all pairs, larger ones a forest."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    small = np.repeat(sizes <= most, sizes)
    for step in range(1, min(most, int(sizes.max()))):
        at = np.flatnonzero(small[:-step] & (keys[:-step] == keys[step:]))
        if not len(at):
            break
        at = at[linked(fps[at] ^ fps[at + step], limit)]
        if len(at):
            yield nodes[at], nodes[at + step]
    for start, size in zip(starts[sizes > most], sizes[sizes > most]):
        yield from _forest(fps[start : start + size], nodes[start : start + size], limit)


def _stream(batches: Iterator[pa.RecordBatch], limit: int, most: int) -> Iterator[pa.RecordBatch]:
    """Edges of a partition sorted by key. Holds one run and one batch; a run has 2 BLOCK rows at most."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]

    def out(columns) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            for a, b in _edges(*columns, limit, most):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        key, fp, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        columns = [np.concatenate(pair) for pair in zip(held, (key, fp.view(np.uint64), node))]
        end = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
        yield from out([c[:end] for c in columns])
        held = [c[end:] for c in columns]
    yield from out(held)


def fingerprint_edges(nodes: DataFrame, shared: list[int] | None = None, limit: int = BITS, view: str | None = None, most: int = _SMALL) -> DataFrame:
    """a, b: edges that connect fingerprints of at most ``limit`` different bits that agree in one of the masks ``shared`` (``masks()``: all of up to 4 bits).

    ``nodes``: node, fp, one row per fingerprint; and the column ``view`` if there are fingerprints of several kinds, which are not compared with each other.
    Buckets of up to ``most`` give all pairs, larger ones a spanning forest.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = [m - (1 << 64) if m >> 63 else m for m in shared or masks()]
    kind = [F.col(view)] if view else []
    keys = F.array(*[F.xxhash64(*kind, F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])
    rows = nodes.select(F.explode(keys).alias("key"), "fp", "node")
    # Buckets of very many different fingerprints: n rows in n / BLOCK blocks, each pair of blocks in a cell of its own.
    counts = settle(rows.groupBy("key").count().where(F.col("count") > BLOCK), "large-buckets")
    n_large = counts.count()
    if n_large:
        large = counts.select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
        large = F.broadcast(large) if n_large <= 100_000 else large
        cells = F.expr("""transform(sequence(0, blocks - 1), i -> xxhash64(key, least(i, pmod(xxhash64(fp, key), blocks)), greatest(i, pmod(xxhash64(fp, key), blocks))))""")
        rows = rows.join(large, "key", "left").select(F.explode(F.coalesce(F.when(F.col("blocks").isNotNull(), cells), F.array("key"))).alias("key"), "fp", "node")
    return rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lambda batches: _stream(batches, limit, most), "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """id, fp, component: one row per document.

    A-Z in lower case; words are ``[^\\x20\\x09-\\x0D]+``; shingles are that many words, repeats included; a text of fewer words is one shingle; a text without words (null,
    empty) has fingerprint zero, which links like any other. Fingerprints with at most 4 different bits link; the component is the smallest id that
    is reachable. Rows of equal id are documents of their own. A null id counts as the largest long. An empty table gives no rows.
    """
    prints = settle(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    node = F.coalesce("id", F.lit(2**63 - 1))
    nodes = settle(prints.groupBy("fp").agg(F.min(node).alias("node")), "fingerprint-nodes")
    # Nodes of equal id (rows that repeat an id with other texts) are one node of the graph.
    found = components(fingerprint_edges(nodes))
    labelled = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    return prints.join(labelled, "fp").select("id", "fp", "component")
