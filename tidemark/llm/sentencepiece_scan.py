"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

The segmentation of a BPE model is the best path in the lattice of its pieces where a piece, and a pair of neighbours, weighs 0 if it is what the model's own merges make of its
characters, and minus infinity else; this leaves exactly the library's segmentation.

A giant document is cut into chunks at any code point. A state at a cut is a piece that covers the character before it. Each chunk gives a transfer matrix: the best weight of a path from
each state at its left cut to each state at its right cut. Matrix products in (max, +) are associative, so the prefixes of all chunks are combined by doubling; the best states at the cuts
follow from the last one back, and then each chunk is backtraced on its own.

Inside a chunk, no piece crosses certain places (before a blank mark that follows another character; around characters that are no piece), so the lattice between them is a unit of its
own. The path of a whole unit is asked from the library once per worker; units that a cut touches go through the lattice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import keyed, whole_row
from tidemark.llm.tokens import KEPT_UNITS, Memo, slices
from tidemark.session import settle

BLANK = "▁"
CHUNK = 1 << 16
NEVER = -math.inf
State = tuple[int, int]
_MADE: dict[str, "Pieces"] = {}


class Pieces:
    """The model in a task: pieces, weights, allowed pairs, and the paths of units seen so far."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        plain = [i for i in range(n) if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i))]
        self.ids = {self.library.id_to_piece(i): i for i in plain}
        self.scores = {self.library.id_to_piece(i): self.library.get_score(i) for i in plain}
        self.longest = max(map(len, self.ids))
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.surface = [b""] * n
        for piece, i in self.ids.items():
            self.surface[i] = piece.replace(BLANK, " ").encode("utf-8")
        for b, i in enumerate(self.bytes):
            self.surface[i] = bytes([b])
        # No piece holds a blank mark after another character.
        self.blank_first = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.memo = Memo(self.unit, KEPT_UNITS // 5)
        self.merged = lru_cache(200_000)(self._merged)

    def _merged(self, text: str) -> tuple[str, ...]:
        """What the model's merges make of some characters: the best pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1], NEVER)
                if score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(parts)

    def alone(self, char: str) -> bool:
        """Whether no piece has this character; it becomes bytes."""
        return char not in self.ids

    def allowed(self, left: str, right: str) -> bool:
        return self.alone(left) or self.alone(right) or self.merged(left + right) == (left, right)

    def edges(self, text: str, start: int) -> Iterator[int]:
        """Ends of the pieces that begin at ``start``."""
        if self.alone(text[start]):
            yield start + 1
            return
        for end in range(start + 1, min(len(text), start + self.longest) + 1):
            piece = text[start:end]
            if piece in self.ids and self.merged(piece) == (piece,):
                yield end

    def is_boundary(self, text: str, at: int) -> bool:
        """Whether no piece can cross this place."""
        if at <= 0 or at >= len(text):
            return True
        before, after = text[at - 1], text[at]
        return (self.blank_first and after == BLANK and before != BLANK) or self.alone(before) or self.alone(after)

    def id_of(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [self.bytes[b] for b in piece.encode("utf-8")]

    def normal(self, text: str) -> str:
        return self.library.normalize(text)

    def unit(self, units: set[str]) -> dict[str, bytes]:
        """Ids of whole units by the library. A line feed in front, which is no piece, keeps its own blank mark away."""
        units = list(units)
        found = self.library.encode(["\n" + u.replace(BLANK, " ") for u in units], num_threads=1)
        skip = len(self.library.encode("\n"))
        return {u: np.array(ids[skip:], "<u4").tobytes() for u, ids in zip(units, found)}

    def units(self, text: str) -> list[str]:
        """Whole units of a normalised text, cut at its line feeds and where a blank mark follows another character."""
        if not self.blank_first or not self.alone("\n"):
            return [text]
        marked = text.replace("\n", "\0\n\0").replace(BLANK, "\0" + BLANK) if "\0" not in text and BLANK * 2 not in text else None
        if marked is not None:
            return [u for u in marked.split("\0") if u]
        out, start = [], 0
        for i in range(1, len(text)):
            if (text[i] == BLANK and text[i - 1] != BLANK) or text[i] == "\n" or text[i - 1] == "\n":
                out.append(text[start:i])
                start = i
        return [*out, text[start:]] if text else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of normalised texts that begin and end at boundaries."""
        return [np.frombuffer(ids, "<u4") for ids in self.memo.join([self.units(t) for t in texts])]

    def decode(self, ids: np.ndarray) -> str:
        body = b"".join(map(self.surface.__getitem__, ids.tolist()))
        return (body[1:] if body[:1] == b" " else body).decode("utf-8", "replace")


def pieces_of(path: str) -> Pieces:
    if path not in _MADE:
        _MADE[path] = Pieces(path)
    return _MADE[path]


def states_at(model: Pieces, text: str, cut: int) -> list[State]:
    """Pieces (start, end) that cover the character before ``cut`` and end there or later."""
    if cut == 0:
        return [(0, 0)]
    return [(s, e) for s in range(max(0, cut - model.longest), cut) for e in model.edges(text, s) if e >= cut]


def _forward(model: Pieces, text: str, entries: list[State], left: int, right: int) -> dict[State, np.ndarray]:
    """For each lattice piece between the cuts, the best weights of paths that begin with each entry and end with it."""
    best: dict[State, np.ndarray] = {}
    ending: dict[int, list[State]] = {}
    for i, e in enumerate(entries):
        best[e] = np.where(np.arange(len(entries)) == i, 0.0, NEVER)
        ending.setdefault(e[1], []).append(e)
    for at in range(left, right):
        before = ending.get(at)
        if not before:
            continue
        for end in model.edges(text, at):
            piece = text[at:end]
            ways = [best[f] for f in before if f[0] == f[1] or model.allowed(text[f[0] : f[1]], piece)]
            if ways:
                best[at, end] = np.max(ways, axis=0)
                ending.setdefault(end, []).append((at, end))
    return best


def transfer(model: Pieces, text: str, left: int, right: int, first: bool, last: bool) -> tuple[list[State], list[State], np.ndarray]:
    """States at both cuts and the matrix between them. ``text`` has the longest piece's length of context on both sides."""
    entries = [(left, left)] if first else states_at(model, text, left)
    exits = [s for s in states_at(model, text, right) if not last or s[1] == right]
    # Between the first and the last boundary all paths are the same: the lattice is needed before and after only.
    reach = max(e[1] for e in entries)
    begin = next((p for p in range(reach, right) if model.is_boundary(text, p)), None)
    end = next((p for p in range(min(s[0] for s in exits), left, -1) if model.is_boundary(text, p)), None) if exits else None
    matrix = np.full((len(entries), len(exits)), NEVER)
    if begin is not None and end is not None and begin <= end:
        head = _forward(model, text, entries, left, begin)
        into = np.max([v for (_, e), v in head.items() if e == begin], axis=0, initial=NEVER) if any(e == begin for _, e in head) else np.full(len(entries), NEVER)
        tail = _forward(model, text, [(end, end)], end, right)
        out = np.array([tail[s][0] if s in tail else NEVER for s in exits])
        matrix = into[:, None] + out[None, :]
    else:
        both = _forward(model, text, entries, left, right)
        for j, s in enumerate(exits):
            if s in both:
                matrix[:, j] = both[s]
    return entries, exits, matrix


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in (max, +)."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def prefixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, by doubling."""
    out, step = list(matrices), 1
    while step < len(out):
        out = [m if i < step else product(out[i - step], m) for i, m in enumerate(out)]
        step *= 2
    return out


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at the right cut of each chunk on the best path from state 0 at the first cut."""
    reached = prefixes(matrices)
    chosen = [int(reached[-1][0].argmax())]
    for i in range(len(matrices) - 1, 0, -1):
        chosen.append(int((reached[i - 1][0] + matrices[i][:, chosen[-1]]).argmax()))
    return chosen[::-1]


def backtrace(model: Pieces, text: str, entry: State, leave: State) -> np.ndarray:
    """Ids of the pieces after ``entry`` up to ``leave``."""
    begin = next((p for p in range(entry[1], leave[0] + 1) if model.is_boundary(text, p)), None)
    end = next((p for p in range(leave[0], entry[1] - 1, -1) if model.is_boundary(text, p)), None)
    if begin is None or end is None or begin >= end:
        return np.array(_path(model, text, entry, leave), "<u4")
    head = _path(model, text, entry, None, begin)
    tail = _path(model, text, (end, end), leave)
    return np.concatenate([np.array(head, "<u4"), model.encode([text[begin:end]])[0], np.array(tail, "<u4")])


def _path(model: Pieces, text: str, entry: State, leave: State | None, stop: int = 0) -> list[int]:
    stop = leave[1] if leave else stop
    best = _forward(model, text, [entry], entry[1], leave[0] + 1 if leave else stop)
    now = leave or max((s for s in best if s[1] == stop), key=lambda s: best[s][0])
    out: list[list[int]] = []
    while now != entry:
        out.append(model.id_of(text[now[0] : now[1]]))
        piece = text[now[0] : now[1]]
        now = max((f for f in best if f[1] == now[0] and f != now and (f[0] == f[1] or model.allowed(text[f[0] : f[1]], piece))), key=lambda f: best[f][0])
    return [i for ids in reversed(out) for i in ids]


CHUNKS = "doc bigint, version bigint, chunk int, chunks int, start int, stop int, body string"


def encode_giants(giants: DataFrame, path: str, chunk: int) -> DataFrame:
    """doc, version, ids (little-endian unsigned 32-bit), chunks; of documents of more than ``chunk`` code points."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in batches:
            for doc, version, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "version", "text"))):
                body = model.normal(text)
                n = -(-len(body) // chunk)
                for i in range(n):
                    a, b = i * chunk, min(len(body), (i + 1) * chunk)
                    low, high = max(0, a - 2 * model.longest), b + 2 * model.longest
                    row = (doc, version, i, n, a - low, b - low, body[low:high])
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.string()))],
                                                     names=[c.split()[0] for c in CHUNKS.split(", ")])

    # Chunks of one text are dealt out and stored, so that the tasks after this one share a giant's work.
    parts = int(giants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = settle(giants.select("doc", "version", "text").mapInArrow(cut, CHUNKS).distinct().repartition(parts, "doc", "version", "chunk"), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                entries, exits, matrix = transfer(model, r["body"], r["start"], r["stop"], r["chunk"] == 0, r["chunk"] == r["chunks"] - 1)
                out.append((r["doc"], r["version"], r["chunk"], r["start"], r["stop"], [x for s in entries for x in s], [x for s in exits for x in s], matrix.ravel().tolist()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names=["doc", "version", "chunk", "start", "stop", "entries", "exits", "matrix"])

    steps = chunks.mapInArrow(matrices, "doc bigint, version bigint, chunk int, start int, stop int, entries array<int>, exits array<int>, matrix array<double>")

    def choose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        shaped = [np.array(r["matrix"]).reshape(len(r["entries"]) // 2, -1) for r in rows]
        out, before = [], None
        for r, j in zip(rows, best_states(shaped)):
            leave = r["exits"][2 * j : 2 * j + 2]
            # The state at the left cut, in this chunk's own places.
            entry = [r["start"], r["start"]] if before is None else [before[0] - before[2] + r["start"], before[1] - before[2] + r["start"]]
            out.append((r["doc"], r["version"], r["chunk"], entry, leave))
            before = (*leave, r["stop"])
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names=["doc", "version", "chunk", "entry", "leave"])

    # The small matrices of one document: a few hundred bytes for each chunk.
    chosen = steps.groupBy("doc", "version").applyInArrow(choose, "doc bigint, version bigint, chunk int, entry array<int>, leave array<int>")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in batches:
            out = [(r["doc"], r["version"], r["chunk"], backtrace(model, r["body"], tuple(r["entry"]), tuple(r["leave"])).tobytes()) for r in batch.to_pylist()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["doc", "version", "chunk", "ids"])

    traced = chunks.join(chosen, ["doc", "version", "chunk"]).mapInArrow(trace, "doc bigint, version bigint, chunk int, ids binary")
    whole = traced.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    joined = F.expr("array_join(transform(parts, p -> hex(p.ids)), '')")
    return whole.select("doc", "version", F.unhex(joined).alias("ids"), F.size("parts").alias("chunks"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with piece_ids (binary, little-endian unsigned 32-bit) and chunks (1 unless the text was cut).

    The ids are those of the library for the whole text, without special pieces. A null or empty text has no ids. Rows of equal or null id are encoded each on its own. An empty table gives no
    rows. ``docs`` may have any columns; the two added ones are replaced.
    """
    rows = keyed(docs, id_col, text_col, whole_row(docs, ["piece_ids", "chunks"]))

    def small(texts_of):
        import pandas as pd

        model = pieces_of(path)
        for texts in texts_of:
            out = []
            for a, b in slices([len(t) for t in texts]):
                out += [x.tobytes() for x in model.encode([model.normal(t) for t in texts[a:b]])]
            yield pd.Series(out, dtype=object)

    giant = F.char_length("text") > chunk
    ids = F.pandas_udf(small, "binary", F.PandasUDFType.SCALAR_ITER)
    plain = rows.where(~giant).select("row", ids("text").alias("piece_ids"), F.lit(1).alias("chunks"))
    large = rows.where(giant).select("row", "doc", "version").join(encode_giants(rows.where(giant), path, chunk), ["doc", "version"])
    return plain.unionByName(large.select("row", F.col("ids").alias("piece_ids"), "chunks")).select("row.*", "piece_ids", "chunks")


def decode(encoded: DataFrame, path: str, ids_col: str = "piece_ids") -> DataFrame:
    """``encoded`` with decoded, the text of the ids (null for null)."""

    def texts(columns):
        import pandas as pd

        model = pieces_of(path)
        for ids in columns:
            yield pd.Series([None if x is None else model.decode(np.frombuffer(x, "<u4")) for x in ids], dtype=object)

    apply = F.pandas_udf(texts, "string", F.PandasUDFType.SCALAR_ITER)
    return encoded.select(whole_row(encoded, ["decoded"]), apply(F.col(f"`{ids_col}`")).alias("decoded")).select("row.*", "decoded")
