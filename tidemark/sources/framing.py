"""Where CSV records begin and end, for files and archive members alike.

A quote opens a value only at the start of a field; elsewhere it is a character like any other. So each line maps the state at its start (outside or inside a quoted
value) to the state at its end, and these maps compose along a split and along a file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The same twice: for one line (possessive, so that no position is tried again), and for Arrow, whose automata never do; there, what follows a closing quote is no quote.
_INSIDE = rb'[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = rb'(?:"' + _INSIDE + rb'|(?!")[^,]*+)'
_REST = rb"(?:," + _FIELD + rb")*+\Z"
_CLOSED_FROM_OUTSIDE = re.compile(_FIELD + _REST, re.DOTALL)
_CLOSED_FROM_INSIDE = re.compile(_INSIDE + _REST, re.DOTALL)
_VALUE = r'(?:[^"]|"")*"(?:[^",][^,]*)?'
_FIELDS = rf'(?:"{_VALUE}|(?:[^",][^,]*)?)'
_FROM_OUTSIDE, _FROM_INSIDE = rf"\A{_FIELDS}(?:,{_FIELDS})*\z", rf"\A{_VALUE}(?:,{_FIELDS})*\z"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted value is open after this line (without its line end), given whether one is before it."""
    if b'"' not in line:
        return inside
    return (_CLOSED_FROM_INSIDE if inside else _CLOSED_FROM_OUTSIDE).match(line) is None


def line_maps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each line (binary): whether a value is open behind it if none is before it, and if one is. Lines without a quote change nothing."""
    outside, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = pc.match_substring(lines, '"')
    at = np.flatnonzero(quoted.to_numpy(zero_copy_only=False))
    if len(at):
        some = lines.take(pa.array(at))
        for out, pattern in ((outside, _FROM_OUTSIDE), (inside, _FROM_INSIDE)):
            out[at] = ~pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
    return outside, inside


def compose(outside: np.ndarray, inside: np.ndarray, state: bool) -> np.ndarray:
    """The state behind each line, for all lines at once: what the last line says that ends alike from either state, turned by those since that exchange the two."""
    n = np.arange(len(outside))
    last = np.maximum.accumulate(np.where(outside == inside, n, -1)) if len(n) else n
    turns = np.cumsum(outside & ~inside)
    known = last >= 0
    begin = np.where(known, outside[last], state)
    return begin ^ ((turns - np.where(known, turns[last], 0)) % 2 == 1)


def lines_of(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """Lines without their ends, which are ``\\n``, ``\\r\\n`` or ``\\r``."""
    rest = b""
    for block in blocks:
        lines = (rest + block).splitlines(keepends=True)
        # A line feed may follow the carriage return that a block ends with.
        rest = lines.pop() if lines and not lines[-1].endswith(b"\n") else b""
        for line in lines:
            yield line.rstrip(b"\r\n")
    yield from rest.splitlines()


def cut_records(lines: pa.Array, inside: bool, held: list[bytes]) -> tuple[pa.Array, bool, list[bytes]]:
    """Records that end in these lines (binary, without their ends), the state behind the last one, and the lines of the record that goes on.

    ``held`` are the lines of a record that began before. Blank lines between records are skipped, line ends inside quotes are ``\\n``.
    """
    if not len(lines):
        return lines, inside, held
    after = compose(*line_maps(lines), inside)
    before = np.concatenate([[inside], after[:-1]])
    inside = bool(after[-1])
    kept = before | (pc.binary_length(lines).to_numpy() > 0)
    if not kept.all():
        lines, after = lines.filter(pa.array(kept)), after[kept]
    ends = np.flatnonzero(~after) + 1
    done = int(ends[-1]) if len(ends) else 0
    rest = lines.slice(done).to_pylist()
    if not done:
        return lines.slice(0, 0), inside, held + rest
    records = lines.slice(0, done)
    if held or len(ends) < done:
        records = pa.concat_arrays([pa.array(held, pa.binary()), records])
        bounds = np.concatenate([[0], ends + len(held)]).astype(np.int32)
        records = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), records), b"\n")
    return records, inside, rest


def line_arrays(blocks: Iterable[bytes]) -> Iterator[pa.Array]:
    """Lines without their ends, which are ``\\n``, ``\\r\\n`` or ``\\r``, as they come in blocks."""
    rest = b""
    for block in blocks:
        data = rest + block
        # A line feed may follow the carriage return that a block ends with.
        cut = max(data.rfind(b"\n"), data.rfind(b"\r", 0, len(data) - 1)) + 1
        if cut:
            yield _lines(data[:cut])
        rest = data[cut:]
    if rest:
        yield _lines(rest)


def _lines(data: bytes) -> pa.Array:
    data = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    return pc.split_pattern(pa.array([data.removesuffix(b"\n")], pa.binary()), b"\n").flatten()


def record_arrays(blocks: Iterable[bytes]) -> Iterator[pa.Array]:
    """Records of one file, by the same rules as ``frame_records``."""
    inside, held = False, []
    for lines in line_arrays(blocks):
        records, inside, held = cut_records(lines, inside, held)
        if len(records):
            yield records
    if held:
        raise ValueError(f"a quote is left open at the end; the record begins with {held[0][:80]!r}")


def frame_records(lines: Iterable[bytes]) -> Iterator[bytes]:
    """Records from lines: blank lines between records are skipped, line ends inside quotes are ``\\n``."""
    held: list[bytes] = []
    inside = False
    for line in lines:
        if not inside and not line:
            continue
        held.append(line)
        inside = ends_inside(line, inside)
        if not inside:
            yield b"\n".join(held) if len(held) > 1 else line
            held = []
    if held:
        raise ValueError(f"a quote is left open at the end; the record begins with {held[0][:80]!r}")


def as_text(records: pa.Array) -> pa.Array:
    """Records as strings; bytes that are no UTF-8 are replaced."""
    try:
        return records.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([r.decode("utf-8", "replace") for r in records.to_pylist()], pa.string())


def column_names(record: bytes) -> list[str]:
    """Names in a header record; an empty one is named by its position, a repeated one gets it appended."""
    names = next(csv.reader([record.decode("utf-8", "replace")]), [])
    lowered = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lowered.count(n.lower()) > 1 else n for i, n in enumerate(names)]
