"""Scans of extract files: CSV (also large files with line breaks inside quotes) and Parquet."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import clean, replace_invalid, truncate_bytes
from tidemark.session import files_at, settle, text_lines, total_bytes
from tidemark.sources.framing import column_names, compose, cut_records, frame_records, line_maps

CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}


def headers(spark: SparkSession, path: str, fmt: str = "csv") -> list[str]:
    """Column names in file order; reads the first record of one CSV file, the footer of a Parquet file."""
    if fmt == "parquet":
        return spark.read.parquet(path).columns
    if fmt != "csv":
        raise ValueError(f"unknown file format {fmt!r}")
    for file in files_at(spark, path):
        record = next(frame_records(text_lines(spark, file)), None)
        if record is not None:
            return column_names(record)
    return []


def split_bytes(spark: SparkSession) -> int:
    """How much of a splittable file one task reads."""
    return _bytes(spark, "spark.sql.files.maxPartitionBytes")


def _bytes(spark: SparkSession, name: str) -> int:
    setting = spark.conf.get(name).lower().rstrip("b")
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(setting[-1:], 1)
    return int(setting.rstrip("kmg")) * factor


def may_be_split(spark: SparkSession, path: str) -> bool:
    """Whether Spark may read some file in several splits; the records are the same either way."""
    return total_bytes(spark, path) > min(split_bytes(spark), _bytes(spark, "spark.sql.files.openCostInBytes"))


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text. Line breaks inside quotes belong to the value; short lines are padded with NULL.

    The files must have equal headers. ``columns`` renames them by position.
    """
    names = headers(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (columns or names)])
    return parse_records(csv_records(spark, path, names), "record", schema)


def parse_records(df: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of one CSV record per row."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.select(*keep, F.from_csv(F.col(column), ddl, CSV_OPTIONS).alias("__r")).select(*keep, "__r.*")


#: Text that a task reads at least, where a table is large enough for all cores.
TASK_BYTES = 16 << 20

STATES = "file string, start bigint, outside boolean, inside boolean, reaches boolean, blank boolean"
FRAMED = "file string, owner bigint, start bigint, seq int, whole boolean, header boolean, record binary"


def csv_records(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``(file, record)`` of CSV files of any size, read in splits, without their headers, which must be ``names``.

    A first, narrow pass tells which splits hold quotes; where none does, the records are the lines. Otherwise the lines with quotes give for each split the state at its end for
    either state at its start; one row per split comes to the driver, which composes them along each file. In the last pass each split cuts its own lines into records. Only a record that goes on in another split is put together by
    a shuffle, of its pieces alone. Files that Spark cannot split need no first pass.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line")
    )
    begins = None
    if may_be_split(spark, path):
        # Small splits share a task, which takes them one after the other.
        lines = lines.coalesce(max(spark.sparkContext.defaultParallelism, -(-total_bytes(spark, path) // TASK_BYTES)))
        header = _first_line(spark, path)
        splits = [tuple(r) for r in _contents(lines, header).collect()]
        quoted = any(s[3] for s in splits)
        if not quoted and column_names(header) == list(names) and _plainly_headed(splits):
            # Without a quote each line is a record, and the header is the only line of its kind in a file.
            plain = lines.where((F.octet_length("line") > 0) & (F.col("line") != F.lit(header)))
            return plain.select("file", F.col("line").cast("string").alias("record"))
        # Lines without a quote change no state.
        states = {}
        if quoted:
            with_quotes = lines.where(F.contains("line", F.lit(b'"')))
            states = {(r["file"], r["start"]): (r["outside"], r["inside"], r["reaches"]) for r in with_quotes.mapInArrow(_split_states, STATES).collect()}
        begins = spark.sparkContext.broadcast(begin_states([(f, at, *states.get((f, at), (False, True, False)), not filled) for f, at, filled, *_ in splits]))

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _frame(batches, None if begins is None else begins.value, list(names))

    framed = lines.mapInArrow(frame, FRAMED)
    if begins is None:
        return framed.select("file", F.col("record").cast("string").alias("record"))
    if not any(owner != start for (_, start), (_, owner, _) in begins.value.items()):
        return framed.where("not header").select("file", F.col("record").cast("string").alias("record"))
    pieces = framed.where("not whole").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "seq", "record"))).alias("parts"), F.max("header").alias("header"))
    joined = F.array_join(F.transform("parts", lambda x: x["record"].cast("string")), "\n")
    return framed.where("whole and not header").select("file", F.col("record").cast("string").alias("record")).unionByName(
        pieces.where("not header").select("file", joined.alias("record")))


def _first_line(spark: SparkSession, path: str) -> bytes:
    """The first line that is not blank."""
    return next((line for file in files_at(spark, path) for line in text_lines(spark, file) if line), b"")


def _contents(lines: DataFrame, header: bytes) -> DataFrame:
    """For each split: whether it holds anything, whether it holds a quote, whether its first line with anything in it is ``header``, and how many such lines it holds."""
    filled, is_header = F.octet_length("line") > 0, F.col("line") == F.lit(header)
    first = lambda condition: F.min(F.when(condition, F.col("place")))  # noqa: E731 (numbers, so that nothing is sorted)
    return lines.withColumn("place", F.monotonically_increasing_id()).groupBy("file", "start").agg(
        F.bool_or(filled).alias("filled"), F.bool_or(F.contains("line", F.lit(b'"'))).alias("quoted"), first(filled).eqNullSafe(first(is_header)).alias("headed"), F.count_if(is_header).alias("headers"))


def _plainly_headed(splits: list[tuple]) -> bool:
    """Whether in each file that holds anything the header is the first such line and comes once; ``splits`` as ``_contents`` gives them."""
    files: dict[str, list[tuple]] = {}
    for file, start, filled, _, headed, n in sorted(splits, key=lambda s: s[:2]):
        files.setdefault(file, []).append((filled, headed, n))
    return all(next((headed for filled, headed, _ in f if filled), True) and sum(n for *_, n in f) <= 1 for f in files.values())


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Lines of one split at a time, in pieces; a split may come in several."""
    for batch in batches:
        if not len(batch):
            continue
        files, starts = batch.column("file"), batch.column("start").to_numpy()
        # Splits of two files can begin at the same place.
        which = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (which[1:] != which[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            yield files[a].as_py(), int(starts[a]), batch.column("line").slice(a, b - a)


def _split_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, states, out = None, None, []
    for file, start, lines in _by_split(batches):
        if key != (file, start):
            if key:
                out.append((*key, *states))
            key, states = (file, start), [False, True, False, True]
        states[3] = states[3] and not pc.any(pc.greater(pc.binary_length(lines), 0)).as_py()
        maps = line_maps(lines)
        states[0] = bool(compose(*maps, states[0])[-1])
        from_inside = compose(*maps, states[1])
        states[1], states[2] = bool(from_inside[-1]), states[2] or not from_inside.all()
    if key:
        out.append((*key, *states))
        kinds = (pa.string(), pa.int64(), *[pa.bool_()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], names=[c.split()[0] for c in STATES.split(", ")])


def begin_states(splits: list[tuple]) -> dict[tuple[str, int], tuple[bool, int, bool]]:
    """For each split: whether it begins inside a value, the split where its first record begins, whether the file's header begins in it."""
    out: dict[tuple[str, int], tuple[bool, int, bool]] = {}
    file = None
    for name, start, outside, inside, reaches, blank in sorted(splits):
        if name != file:
            if file is not None and now:
                raise ValueError(f"a quote is left open at the end of {file}")
            file, now, owner, seen = name, False, start, False
        out[name, start] = (now, owner if now else start, not seen and not now and not blank)
        seen = seen or not blank
        # What is open at the end began here, unless the whole split lies inside one value.
        owner = owner if now and not reaches else start
        now = inside if now else outside
    if file is not None and now:
        raise ValueError(f"a quote is left open at the end of {file}")
    return out


def _frame(batches: Iterator[pa.RecordBatch], begins: dict | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Records of each split; pieces of those that begin or end in another one. Lines are told apart and put together by Arrow, a batch at a time."""
    key = None
    inside = header = first = False
    owner = seq = 0
    held: list[bytes] = []

    def made(records: pa.Array, whole: bool, is_header: bool = False) -> pa.RecordBatch:
        nonlocal seq
        n = len(records)
        seq += n
        columns = [pa.repeat(pa.scalar(v, t), n) for v, t in ((key[0], pa.string()), (owner, pa.int64()), (key[1], pa.int64()))]
        columns += [pa.array(np.arange(seq - n, seq, dtype=np.int32)), pa.repeat(pa.scalar(whole), n), pa.repeat(pa.scalar(is_header), n), records]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FRAMED.split(", ")])

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        if begins is None:
            raise ValueError(f"a quote is left open at the end of {key[0]}")
        yield made(pa.array([b"\n".join(held)], pa.binary()), False, header and not first)
        held.clear()

    for file, start, lines in _by_split(batches):
        if key != (file, start):
            if key:
                yield from close()
            key, seq = (file, start), 0
            inside, owner, header = (False, start, start == 0) if begins is None else begins[file, start]
            first = inside  # the record that another split began
        records, inside, held[:] = cut_records(lines, inside, held)
        if not len(records):
            continue
        if first:
            yield made(records.slice(0, 1), False)
            records, first, owner = records.slice(1), False, start
        elif header:
            found, records, header = column_names(records[0].as_py()), records.slice(1), False
            if found != names:
                raise ValueError(f"{file} has the columns {found} instead of {names}")
        if len(records):
            yield made(records, True)
    if key:
        yield from close()


def scan_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types inferred from all its values, by one rule for all sizes. Stored once, as text columns."""
    text = settle(scan_csv(spark, path), "inferred")
    return clean(text, inferred_schema(text))


def inferred_schema(text: DataFrame) -> T.StructType:
    """Types that every value of a text column fits: long, double, boolean, date or timestamp, otherwise text."""
    # patterns from narrow to wide
    shapes = [
        ("bigint", r"^[+-]?[0-9]{1,18}$"),
        ("double", r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"),
        ("boolean", r"^(?i:true|false)$"),
        ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
        ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"),
    ]
    checks = [
        F.bool_and(F.trim(F.col(f"`{c}`")).rlike(pattern)).alias(f"{i}_{kind}")
        for i, c in enumerate(text.columns) for kind, pattern in shapes
    ]
    fits = text.agg(*checks).first()
    types = {kind: T.StructType.fromDDL(f"c {kind}").fields[0].dataType for kind, _ in shapes}
    fields = []
    for i, c in enumerate(text.columns):
        kind = next((kind for kind, _ in shapes if fits[f"{i}_{kind}"]), None)
        fields.append(T.StructField(c, types[kind] if kind else T.StringType()))
    return T.StructType(fields)


def scan_parquet(spark: SparkSession, path: str | Sequence[str], merge_schema: bool = False) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.parquet(*paths)


def scan_tolerant(spark: SparkSession, path: str, schema: T.StructType, max_bytes: int) -> DataFrame:
    """Load that never rejects a row: short lines padded, invalid characters replaced, long texts cut by bytes."""
    text = clean(scan_csv(spark, path, schema.names), schema)
    return text.select(
        *[
            truncate_bytes(replace_invalid(F.col(f"`{f.name}`")), max_bytes).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header per file and doubled quotes, values as they are."""
    df.write.mode(mode).options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                                timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSX",
                                timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", **CSV_OPTIONS).csv(path)
