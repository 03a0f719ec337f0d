"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path
from tidemark.sources.files import write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_INPUTS: dict[tuple[str, str, str], str] = {}


def stored_input(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], str]) -> str:
    """Path of an input that a query's tables are exported to: written once per application, then only read."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _INPUTS:
        _INPUTS[key] = build()
    return _INPUTS[key]


def as_csv(df: DataFrame, sf_dir: str, label: str) -> str:
    """Store rows as an extract's CSV file; returns its path."""

    def build() -> str:
        path = f"{scratch_path(df.sparkSession, label)}.csv"
        write_csv(df, path)
        return path

    return stored_input(df.sparkSession, sf_dir, f"csv-{label}", build)


def plain_times(df: DataFrame) -> DataFrame:
    """UTC timestamps as timestamps without a zone, as the given tables hold them."""
    return df.select(
        *[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
          for f in df.schema.fields]
    )


_TYPE_NAMES = {"bigint": "Number", "int": "Number", "double": "Number", "boolean": "Boolean", "date": "Date",
               "timestamp": "DateTime", "timestamp_ntz": "DateTime"}


def dictionary_rows(df: DataFrame, extract: str) -> list[tuple]:
    """Dictionary rows that describe ``df`` as one extract."""
    return [
        ("2025-01-01T00:00:00.000Z", extract, extract, f.name, f.name, _TYPE_NAMES.get(f.dataType.simpleString(), "String"), None, None)
        for f in df.schema.fields
    ]


DICTIONARY_DDL = ("modified_date__v string, extract string, extract_label string, column_name string, column_label string, "
                  "type string, length bigint, related_extract string")
MANIFEST_DDL = "extract string, extract_label string, type string, records bigint, file string"


def write_extract(
    spark: SparkSession, sf_dir: str, label: str, kind: str, updates: dict[str, DataFrame],
    deletes: dict[str, DataFrame] | None = None, dictionary_updates: list[tuple] | None = None, landing: str | None = None,
) -> str:
    """Store an extract folder, in ``landing`` if given; returns its path."""
    return stored_input(spark, sf_dir, f"extract-{label}", lambda: _write_extract(spark, kind, updates, deletes, dictionary_updates, landing and f"{landing}/{label}"))


def _write_extract(spark, kind, updates, deletes, dictionary_updates, folder=None) -> str:
    """Data files, dictionary and, last, the manifest."""
    folder = folder or scratch_path(spark, f"extract-{kind}")
    manifest, dictionary = [], []
    for extract, df in updates.items():
        file = extract.replace(".", "/") + ".csv"
        write_csv(df, f"{folder}/{file}")
        manifest.append((extract, extract, "updates", df.count(), file))
        dictionary += dictionary_rows(df, extract)
    for extract, df in (deletes or {}).items():
        file = extract.replace(".", "/") + ".csv"
        write_csv(df, f"{folder}/{file}")
        manifest.append((extract, extract, "deletes", df.count(), file))
    if kind == "incremental":
        if dictionary_updates:
            write_csv(spark.createDataFrame(dictionary_updates, DICTIONARY_DDL), f"{folder}/Metadata/metadata.csv")
            manifest.append(("Metadata.metadata", "Metadata", "updates", len(dictionary_updates), "Metadata/metadata.csv"))
    else:
        file = "Metadata/metadata.csv" if kind == "full" else "metadata_full.csv"
        write_csv(spark.createDataFrame(dictionary, DICTIONARY_DDL), f"{folder}/{file}")
    write_csv(spark.createDataFrame(manifest, MANIFEST_DDL).coalesce(1), f"{folder}/manifest.csv")
    return folder
