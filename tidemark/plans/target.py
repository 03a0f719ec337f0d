"""Target tables on plain Parquet that can change by key.

A table is a folder of data versions and small snapshot files:

    <root>/<table>/data/v=<n>/bucket=<b>/*.parquet
    <root>/<table>/snapshots/<n>.json

Rows lie in key buckets. A change writes the buckets it touches into a new version; the snapshot
lists, for each bucket, the versions its rows are in, so all other buckets are carried over by path.
Readers see a version only after its snapshot file exists, and files of older snapshots stay.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.change import conform, delete_by_key, typed_keys, upsert
from tidemark.operators.dictionary import declare_lengths, declared_length
from tidemark.operators.evolve import _type, evolve
from tidemark.session import create_small_text, delete_path, list_names, local_rows, no_rows, observed, path_exists, read_small_text

BUCKET = "__bucket"
DEFAULT_BUCKETS = 16
MOST_BUCKETS = 100_000
BUCKET_BYTES = 512 << 20
# Change keys up to this number and total length are sent to every task; more are joined by a shuffle.
FEW_KEYS = 1_000_000
FEW_KEY_BYTES = 64 << 20


def bucket_count(data_bytes: int, least: int = DEFAULT_BUCKETS) -> int:
    """Buckets for a table of this size: about half a gigabyte of input each."""
    return max(least, min(MOST_BUCKETS, -(-data_bytes // BUCKET_BYTES)))


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    keys: list[str]
    buckets: int
    files: dict[int, list[int]] = field(default_factory=dict)
    retired: list[str] = field(default_factory=list)  # dropped columns still present in older files
    applied: str = ""  # last change applied, for streams that may repeat one
    present: bool = True

    def to_json(self) -> str:
        body = {
            "version": self.version, "schema": json.loads(self.schema.json()), "keys": self.keys,
            "buckets": self.buckets, "files": {str(k): v for k, v in self.files.items()},
            "retired": self.retired, "applied": self.applied, "present": self.present,
        }
        return json.dumps(body)

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        body = json.loads(text)
        body["schema"] = T.StructType.fromJson(body["schema"])
        body["files"] = {int(k): v for k, v in body["files"].items()}
        return cls(**body)


class Target:
    """A folder of tables."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- catalogue ---------------------------------------------------------------------------------
    def snapshot(self, table: str) -> Snapshot | None:
        """The current snapshot, or None when the table does not exist."""
        names = [n for n in list_names(self.spark, f"{self.root}/{table}/snapshots") if re.fullmatch(r"\d+\.json", n)]
        if not names:
            return None
        current = Snapshot.from_json(read_small_text(self.spark, f"{self.root}/{table}/snapshots/{names[-1]}"))
        return current if current.present else None

    def tables(self) -> list[str]:
        return [n for n in list_names(self.spark, self.root) if self.snapshot(n) is not None]

    def columns(self, tables: Iterable[str] | None = None) -> DataFrame:
        """Catalogue rows ``(table_name, ordinal, column_name, type)``."""
        rows = []
        for name in self.tables() if tables is None else tables:
            snap = self.snapshot(name)
            if snap is not None:
                rows += [(name, i, f.name.lower(), f.dataType.simpleString()) for i, f in enumerate(snap.schema.fields, 1)]
        return local_rows(self.spark, rows, "table_name string, ordinal int, column_name string, type string")

    def describe(self, tables: Iterable[str] | None = None) -> DataFrame:
        """``columns`` with the ``length`` in characters that the dictionary declares for a text column, NULL where it declares none."""
        rows = []
        for name in self.tables() if tables is None else tables:
            snap = self.snapshot(name)
            if snap is not None:
                rows += [(name, i, f.name.lower(), f.dataType.simpleString(), declared_length(f)) for i, f in enumerate(snap.schema.fields, 1)]
        return local_rows(self.spark, rows, "table_name string, ordinal int, column_name string, type string, length int")

    def _last_version(self, table: str) -> int:
        """Highest version number ever used, including those of dropped tables and of writes cut short."""
        names = list_names(self.spark, f"{self.root}/{table}/snapshots") + list_names(self.spark, f"{self.root}/{table}/data")
        numbers = [int(m) for n in names for m in re.findall(r"^(?:v=)?(\d+)", n)]
        return max(numbers, default=-1)

    def _commit(self, table: str, snap: Snapshot) -> None:
        create_small_text(self.spark, f"{self.root}/{table}/snapshots/{snap.version:010d}.json", snap.to_json())

    def create(
        self, table: str, schema: T.StructType, keys: Sequence[str] | None = None, buckets: int | None = None
    ) -> bool:
        """Create when absent. A table without its key columns keeps its rows in one unkeyed bucket."""
        if self.snapshot(table) is not None:
            return False
        keys = list(keys or [])
        have = {n.lower() for n in schema.names}
        keyed = bool(keys) and {k.lower() for k in keys} <= have
        self._commit(
            table,
            Snapshot(self._last_version(table) + 1, schema, keys if keyed else [], (buckets or self.buckets) if keyed else 1),
        )
        return True

    def drop(self, table: str) -> bool:
        """Drop when present; files stay for readers of older snapshots until ``vacuum``."""
        snap = self.snapshot(table)
        if snap is None:
            return False
        self._commit(table, replace(snap, version=self._last_version(table) + 1, files={}, present=False))
        return True

    # -- reading -----------------------------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        return self._scan(table, self._must(table))

    def _must(self, table: str) -> Snapshot:
        snap = self.snapshot(table)
        if snap is None:
            raise LookupError(f"no table {table!r} in {self.root}")
        return snap

    def _scan(self, table: str, snap: Snapshot, only: Iterable[int] | None = None) -> DataFrame:
        wanted = snap.files if only is None else {b: snap.files[b] for b in only if b in snap.files}
        base = f"{self.root}/{table}/data"
        paths = [f"{base}/v={v}/{BUCKET}={b}" for b, versions in sorted(wanted.items()) for v in versions]
        if not paths:
            return no_rows(self.spark, snap.schema)
        return self.spark.read.schema(snap.schema).parquet(*paths)

    # -- writing -----------------------------------------------------------------------------------
    def _bucket(self, keys: Sequence[str], buckets: int) -> Column:
        if not keys:
            return F.lit(0)
        text = F.xxhash64(*[F.col(k).cast("string") for k in keys])
        return F.pmod(text, F.lit(buckets)).cast("int")

    def _write(
        self, table: str, snap: Snapshot, version: int, moved: DataFrame | None = None, placed: DataFrame | None = None
    ) -> tuple[list[int], int]:
        """Write rows into a new data version; returns the buckets that got any, and the number of rows.

        ``moved`` rows may come from anywhere: ``rebalance`` brings the rows of a bucket together and
        splits a bucket that is too large for one task, so neither many small files nor one huge task
        arise. ``placed`` rows were read bucket by bucket and are written as they come, without a shuffle.
        """
        path = f"{self.root}/{table}/data/v={version}"
        bucket = self._bucket(snap.keys, snap.buckets)
        parts = []
        if placed is not None:
            parts.append(placed.withColumn(BUCKET, bucket))
        if moved is not None:
            rows = moved.withColumn(BUCKET, bucket)
            parts.append(rows.hint("rebalance", BUCKET) if snap.buckets > 1 else rows)
        # Counted by the writing tasks themselves.
        rows, taken = observed(reduce(DataFrame.unionByName, parts), F.count(F.lit(1)).alias("rows"))
        rows.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
        return [int(n.split("=")[1]) for n in list_names(self.spark, path) if n.startswith(f"{BUCKET}=")], taken.get["rows"]

    def append(self, table: str, rows: DataFrame, match: str = "name", applied: str | None = None) -> int:
        """Add rows; no existing file is read or rewritten. Returns the number of rows added."""
        snap = self._must(table)
        version = self._last_version(table) + 1
        touched, added = self._write(table, snap, version, conform(rows, snap.schema, match))
        files = {b: list(v) for b, v in snap.files.items()}
        for b in touched:
            files.setdefault(b, []).append(version)
        self._commit(table, replace(snap, version=version, files=files, applied=snap.applied if applied is None else applied))
        return added

    def overwrite(self, table: str, rows: DataFrame, match: str = "name") -> int:
        """Replace all rows; returns their number."""
        snap = self._must(table)
        version = self._last_version(table) + 1
        touched, added = self._write(table, snap, version, conform(rows, snap.schema, match))
        self._commit(table, replace(snap, version=version, files={b: [version] for b in touched}, retired=[]))
        return added

    def change(
        self,
        table: str,
        updates: DataFrame | None = None,
        deletes: DataFrame | None = None,
        keys: Sequence[str] | None = None,
        mode: str = "delete_insert",
        distinct: bool = True,
        key_match: str = "tuple",
        applied: str | None = None,
    ) -> None:
        """Delete by key, then upsert, as one new version that rewrites only the buckets these keys fall into.

        ``updates`` and ``deletes`` are read more than once: pass scans of stored files.
        """
        snap = self._must(table)
        keys = list(keys or snap.keys)
        if not keys:
            raise ValueError(f"table {table!r} has no key")
        if updates is None and deletes is None:
            return
        if updates is not None:
            updates = conform(updates, snap.schema)
        # Rows with the bucketing key lie in known buckets; other keys may lie in any.
        touched, few = self._touched(snap, updates, deletes) if key_match == "tuple" and keys == snap.keys else (None, False)
        before = self._scan(table, snap, touched)
        version = self._last_version(table) + 1
        if mode == "delete_insert" and key_match == "tuple":
            # Deletes and updates both remove by key: one join instead of two.
            sides = [typed_keys(side.select(*keys), snap.schema, keys) for side in (deletes, updates) if side is not None]
            kept = delete_by_key(before, reduce(DataFrame.unionByName, sides), keys, few_keys=few)
            new = updates.distinct() if updates is not None and distinct else updates
            if few:
                written, _ = self._write(table, snap, version, moved=new, placed=kept)
            else:
                written, _ = self._write(table, snap, version, moved=kept if new is None else kept.unionByName(new))
        else:
            after = before if deletes is None else delete_by_key(before, deletes, keys, key_match)
            after = after if updates is None else upsert(after, updates, keys, mode, distinct)
            written, _ = self._write(table, snap, version, moved=after)
        files = {b: v for b, v in snap.files.items() if touched is not None and b not in touched}
        files.update({b: [version] for b in written})
        self._commit(table, replace(snap, version=version, files=files, applied=snap.applied if applied is None else applied))

    def _touched(self, snap: Snapshot, updates: DataFrame | None, deletes: DataFrame | None) -> tuple[set[int], bool]:
        """Buckets the change keys fall into, and whether the keys are few and short enough to be sent to every task.

        One row per bucket comes to the driver.
        """
        sides = [typed_keys(side.select(*snap.keys), snap.schema, snap.keys) for side in (updates, deletes) if side is not None]
        length = F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in snap.keys]))
        keys = reduce(DataFrame.unionByName, sides).select(self._bucket(snap.keys, snap.buckets).alias("b"), length.alias("bytes"))
        rows = keys.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
        few = sum(r["n"] for r in rows) <= FEW_KEYS and sum(r["bytes"] for r in rows) <= FEW_KEY_BYTES
        return {r["b"] for r in rows}, few

    # -- schema ------------------------------------------------------------------------------------
    def evolve(
        self,
        table: str,
        add: Mapping[str, T.DataType | str] | None = None,
        retype: Mapping[str, T.DataType | str] | None = None,
        drop: Sequence[str] = (),
        lengths: Mapping[str, int] | None = None,
    ) -> None:
        """Change columns. Adding and dropping touch no data; a new type, or a new column that has the
        name of a dropped one, rewrites the table in place of its buckets, without a shuffle. ``lengths``: declared ones of columns that are added or become text."""
        snap = self._must(table)
        have = {f.name.lower(): f for f in snap.schema.fields}
        drop = [c for c in drop if c.lower() in have]
        lost_keys = {k.lower() for k in snap.keys} & {c.lower() for c in drop}
        add = {k: v for k, v in (add or {}).items() if k.lower() not in have or k.lower() in {c.lower() for c in drop}}
        retype = {k: v for k, v in (retype or {}).items() if k.lower() in have and have[k.lower()].dataType != _type(v)}
        if not (add or retype or drop):
            return
        kept = {n: declared_length(f) for n, f in have.items() if n not in {c.lower() for c in (*drop, *retype)}}
        new = {c.lower(): n for c, n in (lengths or {}).items() if c.lower() in {k.lower() for k in (*add, *retype)}}
        schema = declare_lengths(evolve(no_rows(self.spark, snap.schema), add, retype, drop).schema, kept | new)
        keys = [] if lost_keys else snap.keys
        buckets = 1 if lost_keys else snap.buckets
        retired = sorted(set(snap.retired) | {c.lower() for c in drop})
        version = self._last_version(table) + 1
        changed = replace(snap, version=version, schema=schema, keys=keys, buckets=buckets, retired=retired)
        returning = {k.lower() for k in add} & set(retired)
        if (retype or returning or lost_keys) and snap.files:
            rows = evolve(self._scan(table, snap), add, retype, drop)
            rehashed = bool({k.lower() for k in retype} & {k.lower() for k in snap.keys})
            written, _ = self._write(table, changed, version, *((rows, None) if rehashed else (None, rows)))
            changed = replace(changed, files={b: [version] for b in written}, retired=[])
        self._commit(table, changed)

    def vacuum(self, table: str) -> list[int]:
        """Delete data versions the current snapshot does not use, and older snapshots; returns the data versions.

        Only when no reader of an older snapshot and no writer is at work on the table.
        """
        snap = self.snapshot(table)
        used = {v for versions in snap.files.values() for v in versions} if snap else set()
        base = f"{self.root}/{table}/data"
        if not path_exists(self.spark, base):
            return []
        unused = [int(n[2:]) for n in list_names(self.spark, base) if n.startswith("v=") and int(n[2:]) not in used]
        for v in unused:
            delete_path(self.spark, f"{base}/v={v}")
        for old in list_names(self.spark, f"{self.root}/{table}/snapshots")[:-1]:
            delete_path(self.spark, f"{self.root}/{table}/snapshots/{old}")
        return sorted(unused)
