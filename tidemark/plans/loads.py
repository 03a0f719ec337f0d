"""What a user calls: full, log and incremental loads of an extract folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.change import conform, typed_keys
from tidemark.functions.clean import blank_to_null, clean, convert_value
from tidemark.operators.dictionary import declare_lengths, dictionary_columns, has_fraction, schema_from_metadata
from tidemark.operators.evolve import change_plan
from tidemark.plans.target import Target, bucket_count
from tidemark.session import in_parallel, local_rows, observed, release, settle, total_bytes
from tidemark.sources.files import scan_inferred_csv
from tidemark.sources.listing import (
    extract_paths,
    manifest_tables,
    metadata_changes,
    scan_file,
    scan_manifest,
    scan_metadata,
)
from tidemark.sources.model import DECIMAL_TYPE, METADATA_TABLE, key_columns
from tidemark.streaming.clock import admit, advance, is_set, last_changes, of_admitted

REPORT_SCHEMA = "table_name string, change string, declared bigint, loaded bigint, status string, message string"
DICTIONARY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "modified_date__v", "extract", "extract_label", "column_name", "column_label", "type", "length", "related_extract")]
)


@dataclass(frozen=True)
class LoadOptions:
    """Choices of a load."""

    parquet: bool = False  # extract files are Parquet, named *.parquet
    profile: str = "typed"  # or all_string
    numeric: str = "infer"  # or double, decimal: need no pass over the data
    match: str = "name"  # or position
    mode: str = "append"  # or replace: a full load repeated gives the same table
    upsert_mode: str = "delete_insert"  # or merge
    distinct: bool = True
    key_match: str = "tuple"  # or concat
    infer_schema: bool = False  # take the schema from the files instead of the dictionary
    trim_strings: bool = False
    allow_to_string: bool = False
    parallel: int = 8  # tables loaded side by side
    keys: dict[str, Sequence[str]] = field(default_factory=dict)  # overrides of the key rule


def _report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return local_rows(spark, rows, REPORT_SCHEMA)


def _outcome(table: str, change: str, declared: int, loaded: int, lost: int = 0) -> tuple:
    status = "count differs" if declared != loaded else "values lost" if lost else "ok"
    return table, change, declared, loaded, status, f"{lost} values did not convert" if lost else None


#: From here on a double does not tell whole numbers apart.
LARGEST_WHOLE_DOUBLE = float(1 << 53)


def _measures(target: Target, table: str, raw: DataFrame, options: LoadOptions) -> tuple[list[Column], list[str]]:
    """What a table has to know of the rows of ``raw``, as aggregates, whatever the number of columns: ``rows``, ``lost`` (values that do not convert), and for each
    of the returned columns, which hold whole numbers so far, whether there are fractions or larger numbers (``wide0`` ...) and the largest number (``large0`` ...)."""
    snap = target.snapshot(table)
    keys = {k.lower() for k in _keys(table, options)} | {k.lower() for k in snap.keys}
    fields = list(zip(raw.columns, snap.schema.fields)) if options.match == "position" else [
        (c, f) for f in snap.schema.fields for c in raw.columns if c.lower() == f.name.lower()]
    lost, whole, measures = F.lit(0).cast("bigint"), [], []
    for name, f in fields:
        source = raw.schema[name].dataType
        if isinstance(f.dataType, T.StringType) or source == f.dataType:
            continue
        value = F.col(f"`{name}`")
        given = blank_to_null(value).isNotNull() if isinstance(source, T.StringType) else value.isNotNull()
        goal = f.dataType
        if isinstance(goal, T.LongType) and f.name.lower() not in keys:
            text, goal = blank_to_null(value.cast("string")), T.DoubleType()
            measures += [F.coalesce(F.bool_or(has_fraction(text)), F.lit(False)).alias(f"wide{len(whole)}"),
                         F.coalesce(F.max(F.abs(text.try_cast("double"))), F.lit(0.0)).alias(f"large{len(whole)}")]
            whole.append(f.name)
        lost += F.coalesce(F.sum((given & convert_value(value, source, goal).isNull()).cast("bigint")), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), lost.alias("lost"), *measures], whole


def _admit(target: Target, table: str, found: Mapping, whole: Sequence[str]) -> tuple[int, int]:
    """Make room in a table for numbers measured by ``_measures``; returns the rows and the values that do not convert.

    A column that holds whole numbers so far and now gets fractions, or larger numbers, becomes double, or decimal where a double would round a whole number.
    """
    grown = {c: found[f"large{i}"] for i, c in enumerate(whole) if found[f"wide{i}"]}
    if grown:
        held = target.read(table).agg(*[F.max(F.abs(F.col(f"`{c}`").cast("double"))) for c in grown]).first()
        target.evolve(table, retype={
            c: DECIMAL_TYPE if max(most or 0.0, large) >= LARGEST_WHOLE_DOUBLE else T.DoubleType() for (c, large), most in zip(grown.items(), held)})
    return found["rows"], found["lost"]


def reconcile(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Declared record counts of the manifest against loaded ones ``(table_name, loaded)``."""
    declared = manifest.groupBy("table_name").agg(F.sum("records").alias("declared"))
    joined = declared.join(loaded, "table_name", "full")
    status = (
        F.when(F.col("loaded").isNull(), "not loaded")
        .when(F.col("declared").isNull(), "not declared")
        .when(F.col("declared") == F.col("loaded"), "ok")
        .otherwise("count differs")
    )
    return joined.select("table_name", "declared", "loaded", status.alias("status"))


def _dictionary(metadata: DataFrame) -> dict[str, list[dict]]:
    """Dictionary rows by table. The dictionary has one row per column of the extract, which is what a driver can hold."""
    by_table: dict[str, list[dict]] = {}
    for row in dictionary_columns(metadata, with_length=True).collect():
        by_table.setdefault(row["table_name"], []).append({"column_name": row["column_name"], "type": row["type"], "length": row["length"]})
    return by_table


def _table_schema(rows: list[dict], profile: str, numeric: str, numbers: T.StructType | None = None) -> T.StructType:
    """Schema of a table: every dictionary column, with the Number types found in its file where there is one."""
    names = list(dict.fromkeys(r["column_name"] for r in rows))
    schema = schema_from_metadata(rows, names, None, profile, "double" if numeric == "infer" else numeric)
    found = {f.name.lower(): f.dataType for f in numbers.fields} if numbers is not None else {}
    fields = [T.StructField(f.name, found.get(f.name, f.dataType)) for f in schema.fields]
    schema = T.StructType(fields + [T.StructField(n, t) for n, t in found.items() if n not in set(names)])
    return declare_lengths(schema, {r["column_name"]: r.get("length") for r in rows})


def create_tables(spark: SparkSession, target: Target, metadata: DataFrame, options: LoadOptions = LoadOptions()) -> list[str]:
    """Create each table of the dictionary when absent, and the dictionary's own table with all columns as text."""
    made = [
        table
        for table, rows in sorted(_dictionary(metadata).items())
        if target.create(table, _table_schema(rows, options.profile, options.numeric), _keys(table, options))
    ]
    if target.create(METADATA_TABLE, DICTIONARY_SCHEMA, key_columns(METADATA_TABLE), buckets=1):
        made.append(METADATA_TABLE)
    return made


def _keys(table: str, options: LoadOptions) -> list[str]:
    return list(options.keys.get(table) or key_columns(table))


def _selected(manifest: DataFrame, extract_dir: str, kind: str, parquet: bool) -> dict[str, list[dict]]:
    """Files to read by use (``updates``, ``deletes`` and the dictionary's own), one per manifest row, in one job."""

    def files(rows: DataFrame, use: str) -> DataFrame:
        return extract_paths(rows, extract_dir, parquet, keep=["records"]).select(F.lit(use).alias("use"), "table_name", "path", "records")

    parts = [files(manifest_tables(manifest, "updates", kind), "updates")]
    if kind == "incremental":
        parts.append(files(manifest_tables(manifest, "deletes", kind).where(F.col("table_name") != METADATA_TABLE), "deletes"))
        parts += [files(metadata_changes(manifest, change), f"dictionary_{change}") for change in ("updates", "deletes")]
    chosen: dict[str, list[dict]] = {"updates": [], "deletes": [], "dictionary_updates": [], "dictionary_deletes": []}
    for row in reduce(DataFrame.unionByName, parts).collect():
        chosen[row["use"]].append(row.asDict())
    for rows in chosen.values():
        rows.sort(key=lambda r: (-r["records"], r["path"]))  # large tables first
    return chosen


def _load_all(spark: SparkSession, extract_dir: str, target: Target, kind: str, options: LoadOptions) -> DataFrame:
    extract_dir = extract_dir.rstrip("/")
    manifest = scan_manifest(spark, extract_dir, options.parquet)
    metadata = scan_metadata(spark, extract_dir, kind, options.parquet)
    dictionary = _dictionary(metadata)
    files = _selected(manifest, extract_dir, kind, options.parquet)["updates"]
    # Log rows are only ever added: without key buckets they are written where they are read, with no shuffle.
    keys_of = _keys if kind == "full" else lambda table, _: list(options.keys.get(table, []))
    loaded_tables = {f["table_name"] for f in files}

    def load(item: dict) -> tuple:
        table, path = item["table_name"], item["path"]
        landed, checked = None, False
        if options.infer_schema and not options.parquet:
            typed = scan_inferred_csv(spark, path)
            typed = typed.toDF(*[c.lower() for c in typed.columns])
            schema = typed.schema
        else:
            raw = scan_file(spark, path, options.parquet)
            raw = raw.toDF(*[c.lower() for c in raw.columns])
            if options.parquet and options.infer_schema:
                typed, schema = raw, raw.schema
            elif table == METADATA_TABLE:
                typed, schema = raw, DICTIONARY_SCHEMA
            else:
                rows = dictionary.get(table, [])
                typed = raw
                if not options.parquet:
                    # Text is parsed once; the number rule, the check and the load read stored columns.
                    typed = raw = landed = settle(raw, f"landed-{table}")
                exists = target.snapshot(table) is not None
                rule = "double" if options.numeric == "infer" and (exists or options.parquet) else options.numeric
                file_schema = raw.schema if options.parquet else schema_from_metadata(rows, raw.columns, raw, options.profile, rule)
                schema = _table_schema(rows, options.profile, options.numeric, file_schema)
                checked = True
        target.create(table, schema, keys_of(table, options), bucket_count(total_bytes(spark, path), target.buckets))
        lost = 0
        if checked:
            measures, whole = _measures(target, table, raw, options)
            _, lost = _admit(target, table, raw.agg(*measures).first().asDict(), whole)
            if landed is not None:
                held = {f.name.lower(): f.dataType for f in target.snapshot(table).schema.fields}
                typed = clean(raw, T.StructType([T.StructField(f.name, held.get(f.name, f.dataType)) for f in file_schema]), options.trim_strings)
        write = target.overwrite if options.mode == "replace" else target.append
        loaded = write(table, typed, options.match)
        release(landed)
        return _outcome(table, "updates", item["records"], loaded, lost)

    # Files of one table follow each other, different tables run side by side.
    groups: dict[str, list[dict]] = {}
    for f in files:
        groups.setdefault(f["table_name"], []).append(f)
    if options.mode == "replace" and any(len(g) > 1 for g in groups.values()):
        raise ValueError("replace needs one file per table")
    results = in_parallel(spark, lambda group: [load(f) for f in group], list(groups.values()), options.parallel)
    for table in sorted(set(dictionary) - loaded_tables):
        target.create(table, _table_schema(dictionary[table], options.profile, options.numeric), keys_of(table, options))
    if METADATA_TABLE not in loaded_tables:
        target.create(METADATA_TABLE, DICTIONARY_SCHEMA, key_columns(METADATA_TABLE), buckets=1)
        target.overwrite(METADATA_TABLE, metadata)
    return _report(spark, [row for group in results for row in group])


def load_full(spark: SparkSession, extract_dir: str, target: Target, options: LoadOptions = LoadOptions()) -> DataFrame:
    """Create the tables of the dictionary and load every update file; returns one report row per file.

    ``append`` adds the rows again when repeated; ``replace`` does not.
    """
    return _load_all(spark, extract_dir, target, "full", options)


def load_log(spark: SparkSession, extract_dir: str, target: Target, options: LoadOptions = LoadOptions()) -> DataFrame:
    """Append a log extract."""
    return _load_all(spark, extract_dir, target, "log", options)


def apply_incremental(
    spark: SparkSession, extract_dir: str, target: Target, options: LoadOptions = LoadOptions(), applied: str | None = None,
    stop_time: str | None = None,
) -> DataFrame:
    """Dictionary deletes, dictionary updates, row deletes, then upserts: a key that is both deleted and updated survives.

    The deletes and updates of one table become one new version of it. With ``stop_time``, keys that an extract of a later time has changed are left as they are (see ``streaming.clock``).
    """
    extract_dir = extract_dir.rstrip("/")
    manifest = scan_manifest(spark, extract_dir, options.parquet)
    chosen = _selected(manifest, extract_dir, "incremental", options.parquet)
    _apply_dictionary(spark, chosen["dictionary_updates"], chosen["dictionary_deletes"], target, options)

    work: dict[str, dict[str, list[dict]]] = {}
    for change in ("deletes", "updates"):
        for f in chosen[change]:
            work.setdefault(f["table_name"], {"deletes": [], "updates": []})[change].append(f)

    def apply(table: str) -> list[tuple]:
        report = []
        snap = target.snapshot(table)
        staged: dict[str, DataFrame | None] = {"deletes": None, "updates": None}
        stored_frames: list[DataFrame] = []
        given: dict[str, list[DataFrame]] = {"deletes": [], "updates": []}
        for change, files in work[table].items():
            for f in files:
                raw = scan_file(spark, f["path"], options.parquet)
                raw = raw.toDF(*[c.lower() for c in raw.columns])
                if snap is None and change == "updates":
                    rows = [{"column_name": c, "type": "String"} for c in raw.columns]
                    target.create(table, _table_schema(rows, options.profile, options.numeric), _keys(table, options))
                    snap = target.snapshot(table)
                if snap is None:
                    report.append((table, change, f["records"], 0, "no table", None))
                    continue
                # Stored once, columnar: the text is parsed a single time although keys and rows are read separately.
                # The job that stores it also measures it.
                given_rows = raw if change == "updates" else raw.select(*_keys(table, options))
                measures, whole = _measures(target, table, raw, options) if change == "updates" else ([F.count(F.lit(1)).alias("rows"), F.lit(0).alias("lost")], [])
                given_rows, taken = observed(given_rows, *measures)
                stored = settle(given_rows, f"staged-{table}")
                stored_frames.append(stored)
                rows, lost = _admit(target, table, taken.get, whole)
                report.append(_outcome(table, change, f["records"], rows, lost))
                given[change].append(stored)
        snap = target.snapshot(table)
        for change, frames in given.items():
            # In the table's types, which the files together have decided.
            typed = [conform(stored, snap.schema, options.match) if change == "updates" else stored for stored in frames]
            staged[change] = reduce(DataFrame.unionByName, typed) if typed else None
        if snap is not None and (staged["deletes"] is not None or staged["updates"] is not None):
            keys = _keys(table, options)
            in_order = stop_time is not None and not is_set(target, table, applied)
            admitted = _admitted(target, table, staged, keys, stop_time) if in_order else None
            if applied is None or snap.applied != applied:
                if admitted is not None:
                    staged = {c: None if rows is None else of_admitted(typed_keys(rows, snap.schema, keys), admitted, keys) for c, rows in staged.items()}
                target.change(table, staged["updates"], staged["deletes"], keys, options.upsert_mode, options.distinct, options.key_match, applied)
            if admitted is not None:
                advance(target, table, keys, admitted, applied)
                stored_frames.append(admitted)
        release(*stored_frames)
        return report

    results = in_parallel(spark, apply, sorted(work), options.parallel)
    return _report(spark, [row for rows in results for row in rows])


def _admitted(target: Target, table: str, staged: dict[str, DataFrame | None], keys: list[str], stop_time: str) -> DataFrame:
    """The keys of an extract's changes that no later extract has changed."""
    schema = target.snapshot(table).schema
    sides = [typed_keys(rows.select(*keys), schema, keys).withColumn("deleted", F.lit(change == "deletes")) for change, rows in staged.items() if rows is not None]
    return admit(target, table, keys, last_changes(reduce(DataFrame.unionByName, sides), keys, F.lit(stop_time), F.col("deleted")))


def _apply_dictionary(spark: SparkSession, update_files: list[dict], delete_files: list[dict], target: Target, options: LoadOptions) -> None:
    def rows_of(files: list[dict]) -> DataFrame | None:
        if not files:
            return None
        scans = [scan_file(spark, f["path"], options.parquet) for f in files]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows.toDF(*[c.lower() for c in rows.columns]) for rows in scans])

    updates, deletes = rows_of(update_files), rows_of(delete_files)
    if updates is None and deletes is None:
        return
    empty = local_rows(spark, [], "table_name string, column_name string, type string")
    gone = empty
    if deletes is not None:
        gone = dictionary_columns(deletes.withColumn("type", F.lit(None).cast("string")))
    new = dictionary_columns(updates) if updates is not None else empty
    tables = [r["table_name"] for r in new.select("table_name").union(gone.select("table_name")).distinct().collect()]
    plan = change_plan(new, gone, target.columns(tables), options.allow_to_string, DECIMAL_TYPE.simpleString() if options.numeric == "decimal" else "double")
    # One row per changed column of the dictionary.
    steps = plan.orderBy("step", "table_name", "action", "column_name").collect()
    lengths: dict[str, dict[str, int]] = {}
    if updates is not None:
        for row in dictionary_columns(updates, with_length=True).where("length IS NOT NULL").collect():
            lengths.setdefault(row["table_name"], {})[row["column_name"]] = row["length"]
    apply_plan(target, steps, options, lengths)

    # The dictionary's own table follows, both ways.
    if target.create(METADATA_TABLE, DICTIONARY_SCHEMA, key_columns(METADATA_TABLE), buckets=1):
        if updates is not None:
            target.append(METADATA_TABLE, updates)
    else:
        keys = deletes.select(*key_columns(METADATA_TABLE)) if deletes is not None else None
        target.change(METADATA_TABLE, updates, keys, key_columns(METADATA_TABLE))


def apply_plan(
    target: Target, steps: Sequence, options: LoadOptions = LoadOptions(), lengths: Mapping[str, Mapping[str, int]] | None = None
) -> None:
    """Apply the rows of a change plan, one schema change per table and step. ``lengths``: declared ones of new columns, by table and column."""
    lengths = lengths or {}
    by_table: dict[tuple[int, str], list] = {}
    for s in steps:
        by_table.setdefault((s["step"], s["table_name"]), []).append(s)
    for (_, table), rows in sorted(by_table.items()):
        if any(r["action"] == "drop_table" for r in rows):
            target.drop(table)
            continue
        created = [r for r in rows if r["action"] == "create_table"]
        if created:
            schema = T.StructType()
            for r in created:
                schema.add(r["column_name"], "string" if options.profile == "all_string" else r["type"])
            target.create(table, declare_lengths(schema, lengths.get(table, {})), _keys(table, options))
        if target.snapshot(table) is None:
            continue
        typed = options.profile != "all_string"
        target.evolve(
            table,
            add={r["column_name"]: r["type"] if typed else "string" for r in rows if r["action"] == "add_column"},
            retype={r["column_name"]: r["type"] for r in rows if r["action"] == "change_type" and typed},
            drop=[r["column_name"] for r in rows if r["action"] == "drop_column"],
            lengths=lengths.get(table, {}),
        )
