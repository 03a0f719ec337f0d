"""Substring dedup: windows of words that a smaller document holds, found by backward search in an FM-index per shard.

Which shard a window must ask is decided by content, so that every document meets only the shards that can hold its windows:

1. The anchor of a window is the smallest hash of its 8-word shingles. Equal windows have equal anchors. Consecutive windows with one anchor are a
   run. Anchors are grouped: the smallest document of an anchor is its parent; anchors of one document alone are dropped.
2. Runs of a parent are indexed in the parent's shard; runs of other documents are streamed past it (``FMIndex.matches``: matching statistics, clipped at the
   length of a window). A parent that very many runs ask is indexed in several groups, and its runs are dealt among them.
3. A window may share the anchor but not the words of its parent. All documents with such a window fail in the same way, so among the windows that
   failed, the smallest document is found by a hash of the whole window, and a second search, in the shards of these parents, decides.

A window counts as repeated only when the backward search has found all its words in a smaller document; hashes only choose the shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.fm_index import FMIndex
from tidemark.llm.rows import keyed, whole_row
from tidemark.session import settle

SHINGLE = 8
#: Windows that are streamed past one shard, about.
SHARD = 300_000
#: Windows in one streamed, and in one indexed, piece.
STREAMED, INDEXED = 200, 500
RUNS = "doc bigint, version bigint, base bigint, anchor bigint, first int, last int"
PIECES = "shard int, salt int, role int, doc bigint, version bigint, start bigint, words binary"
FOUND = "matched boolean, doc bigint, version bigint, start bigint, end bigint, words binary"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Hashes of words, kept per worker."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def window_hashes(words: list[bytes], length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    powers = np.cumprod(np.full(n, _BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers)])
    out = (sums[length:] - sums[:-length]) * np.cumprod(np.full(n - length + 1, inverse))
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    out, covered = values, 1
    while covered < size:
        step = min(covered, size - covered)
        out = np.minimum(out[:-step], out[step:])
        covered += step
    return out


def anchor_runs(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window of each run."""
    if len(words) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    shingle = min(SHINGLE, length)
    anchors = sliding_min(window_hashes(words, shingle), length - shingle + 1)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    return anchors[first], first, np.append(first[1:], len(anchors)) - 1


def single_runs(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window as a run of its own, with the hash of all its words."""
    hashes = window_hashes(words, length)
    return hashes, np.arange(len(hashes)), np.arange(len(hashes))


def find_runs(texts: DataFrame, length: int, runs) -> DataFrame:
    """``texts``: doc, version, base, words (binary)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs(t.as_py().split(), length) for t in batch.column("words")]
            counts = np.array([len(f[0]) for f in found], np.int64)
            columns = [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts)) for c in ("doc", "version", "base")]
            anchor, first, last = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
            columns += [pa.array(anchor.astype(np.uint64).view(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "version", "base", "anchor", "first", "last"])

    return texts.select("doc", "version", "base", "words").mapInArrow(find, RUNS)


def _shared(runs: DataFrame) -> DataFrame:
    """Runs whose anchor several documents have, with their parent."""
    parents = runs.groupBy("anchor").agg(F.min("doc").alias("parent"), F.max("doc").alias("other")).where("parent < other")
    return runs.join(parents.select("anchor", "parent"), "anchor").drop("anchor")


def _pieces(texts: DataFrame, shared: DataFrame, length: int) -> DataFrame:
    """What is indexed (role 0) and what is streamed (role 1), by shard and salt."""
    windows = F.col("last") - F.col("first") + 1
    asking = shared.where("doc > parent").groupBy("parent").agg(F.sum(windows).alias("windows"))
    total = asking.agg(F.sum("windows")).first()[0] or 0
    shards = int(total // SHARD) + 1
    busy = settle(asking.where(F.col("windows") > SHARD).select("parent", F.ceil(F.col("windows") / SHARD).cast("int").alias("salts")), "busy-parents")
    n_busy = busy.count()
    busy = F.broadcast(busy) if n_busy <= 100_000 else busy
    salted = shared.join(busy, "parent", "left").withColumn("salts", F.coalesce("salts", F.lit(1))).withColumn("shard", F.pmod(F.xxhash64("parent"), F.lit(shards)).cast("int"))
    # A document's own runs: never more than its windows.
    per_text = salted.groupBy("doc", "version", "base").agg(F.sort_array(F.collect_list(F.struct("first", "last", "parent", "salts", "shard"))).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, version, base, body, runs in zip(*(batch.column(c).to_pylist() for c in ("doc", "version", "base", "words", "runs"))):
                words = body.split()
                for first, last, parent, salts, shard in _joined(runs):
                    own = doc == parent
                    step = INDEXED if own else STREAMED
                    for a in range(first, last + 1, step):
                        piece = b" ".join(words[a : min(a + step - 1, last) + length])
                        for salt in range(salts) if own else (_dealt(doc, base + a, salts),):
                            out.append((shard, salt, 0 if own else 1, doc, version, base + a, piece))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                 names=[c.split()[0] for c in PIECES.split(", ")])

    return texts.select("doc", "version", "base", "words").join(per_text, ["doc", "version", "base"]).mapInArrow(cut, PIECES)


def _dealt(doc: int, start: int, salts: int) -> int:
    """The salt of a streamed piece, by its document and place: ids of one residue, and the pieces of one long document, spread like any others."""
    return zlib.crc32(struct.pack("<qq", doc, start)) % salts


def _joined(runs: list[dict]) -> Iterator[tuple[int, int, int, int, int]]:
    """Runs that follow each other and have one parent, as one."""
    now = None
    for r in runs:
        if now and now[2] == r["parent"] and r["first"] <= now[1] + 1:
            now[1] = max(now[1], r["last"])
            continue
        if now:
            yield tuple(now)
        now = [r["first"], r["last"], r["parent"], r["salts"], r["shard"]]
    if now:
        yield tuple(now)


def search(pieces: DataFrame, length: int) -> DataFrame:
    """Intervals of windows: matched ones, and the others with their words."""

    def of_shard(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        docs, versions, starts = (table.column(c).to_numpy() for c in ("doc", "version", "start"))
        words = [w.split() for w in table.column("words").to_pylist()]
        indexed, streamed = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        out = []
        if len(streamed):
            if len(indexed):
                index = FMIndex([words[i] for i in indexed], docs[indexed], length)
                found = index.matches([words[i] for i in streamed], docs[streamed])
            else:
                found = [np.zeros(len(words[i]) - length + 1, bool) for i in streamed]
            for i, matched in zip(streamed.tolist(), found):
                edges = np.flatnonzero(np.diff(matched.view(np.int8))) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(matched)]):
                    yes = bool(matched[a])
                    out.append((yes, int(docs[i]), int(versions[i]), int(starts[i]) + a, int(starts[i]) + b - 1, None if yes else b" ".join(words[i][a : b - 1 + length])))
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = list(zip(*out)) if out else [()] * 6
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

    return pieces.groupBy("shard", "salt").applyInArrow(of_shard, FOUND)


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """doc, version, start, end: intervals of windows that a smaller document holds. ``docs`` as of ``keyed``."""
    texts = docs.select("doc", "version", F.lit(0).cast("bigint").alias("base"), F.encode("text", "UTF-8").alias("words"))
    runs = settle(find_runs(texts, length, anchor_runs), "anchor-runs")
    shared = settle(_shared(runs), "shared-runs")
    found = settle(search(_pieces(texts, shared, length), length), "first-search")
    # Windows with their parent's anchor but other words.
    rest = found.where("not matched").select("doc", "version", F.col("start").alias("base"), "words")
    again = settle(_shared(find_runs(rest, length, single_runs)), "shared-windows")
    more = settle(search(_pieces(rest, again, length), length), "second-search")
    return found.where("matched").unionByName(more.where("matched")).select("doc", "version", "start", "end")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_words (the words that stay, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+`` as they are. A window is ``window`` consecutive words of one document; each word that lies in a window whose words also occur in
    a document with a smaller id goes. Windows are judged on the input. A null or empty text has no words, and texts of fewer words than a window lose none. Rows of
    equal id are one document and do not judge each other. A null id comes after all others, as one document. An empty table gives no
    rows. ``docs`` may have any further columns, except the three that are added, which are replaced.
    """
    added = ["n_words", "n_removed", "kept_words"]
    left = keyed(docs, id_col, text_col, whole_row(docs, added))
    found = repeated_windows(keyed(docs, id_col, text_col), window)
    # Intervals of one document: never more than its windows.
    per_doc = found.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    @F.pandas_udf("n_words bigint, n_removed bigint, kept_words string")
    def apply(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return _apply(texts, spans, window)

    done = left.join(per_doc, ["doc", "version"], "left").select("row", apply("text", "spans").alias("out"))
    return done.select("row.*", "out.*")


def _apply(texts, spans, window: int) -> pd.DataFrame:
    out = []
    for text, own in zip(texts, spans):
        words = text.encode("utf-8").split()
        keep = np.ones(len(words) + 1, np.int64)
        if own is not None and len(own):
            change = np.zeros(len(words) + 1, np.int64)
            for span in own:
                change[span["start"]] += 1
                change[span["end"] + window] -= 1
            keep = np.cumsum(change) == 0
        kept = [w for w, k in zip(words, keep) if k] if not keep.all() else words
        out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_words"])
