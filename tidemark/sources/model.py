"""Fixed layouts of an extract, the type map and the key rule."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: file layouts -------------------------------------------------------------------
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("extract", T.StringType()),
        T.StructField("extract_label", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("file", T.StringType()),
    ]
)
METADATA_SCHEMA = T.StructType(
    [
        T.StructField("modified_date__v", T.TimestampType()),
        T.StructField("extract", T.StringType()),
        T.StructField("extract_label", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_label", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("related_extract", T.StringType()),
    ]
)
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("extract_type", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("stop_time", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("fileparts", T.IntegerType()),
        T.StructField(
            "filepart_details",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("filename", T.StringType()),
                        T.StructField("filepart", T.IntegerType()),
                        T.StructField("size", T.LongType()),
                        T.StructField("url", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
MANIFEST_FILE = "manifest"
METADATA_FILE = {"full": "Metadata/metadata", "log": "metadata_full"}
METADATA_EXTRACT = "Metadata.metadata"
METADATA_TABLE = "metadata"
DELETES_SUFFIX = "_deletes"
EXTRACT_KINDS = ("full", "incremental", "log")
DOCUMENT_VERSIONS_FILE = "Document/document_version__sys"

# --- fixed values: keys by table name, everything else is keyed by id --------------------------------
TABLE_KEYS = {
    "picklist__sys": ["object", "object_field", "picklist_value_name"],
    "metadata": ["extract", "column_name"],
}
DEFAULT_KEYS = ["id"]

# --- fixed values: dictionary type name (lower case) -> Spark type ------------------------------------
# Names not listed here are text.
DICTIONARY_TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
}
NUMBER_TYPES = {"number", "numeric"}
TYPE_PROFILES = ("typed", "all_string")
NUMERIC_RULES = ("infer", "double", "decimal")
DECIMAL_TYPE = T.DecimalType(38, 10)


def key_columns(table: str) -> list[str]:
    """Key columns of a table, by its name."""
    return list(TABLE_KEYS.get(table.lower(), DEFAULT_KEYS))


def metadata_path(kind: str) -> str:
    """Relative path (no extension) of the data dictionary in a full or log extract."""
    return METADATA_FILE[kind]


def spark_type(name: str, column: str = "", profile: str = "typed", number: T.DataType | None = None) -> T.DataType:
    """Spark type of one dictionary row.

    ``number`` is what a Number column becomes; without it a Number named ``id`` is long and every
    other one double.
    """
    if profile not in TYPE_PROFILES:
        raise ValueError(f"unknown type profile {profile!r}")
    if profile == "all_string":
        return T.StringType()
    kind = (name or "").strip().lower()
    if kind in NUMBER_TYPES:
        if column.lower() == "id":
            return T.LongType()
        return number or T.DoubleType()
    return DICTIONARY_TYPES.get(kind, T.StringType())
