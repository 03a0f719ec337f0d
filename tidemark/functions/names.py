"""Column expressions on extract names, version ids, paths and headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.sources.model import DELETES_SUFFIX


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_table_name(c) -> Column:
    """Digit-only names get the prefix ``n_``; other names are unchanged."""
    name = _col(c)
    return F.when(name.rlike("^[0-9]+$"), F.concat(F.lit("n_"), name)).otherwise(name)


def extract_of_file(c) -> Column:
    """``Domain/name.csv`` to ``Domain.name``."""
    return F.replace(F.regexp_replace(_col(c), r"\.[^./]*$", ""), F.lit("/"), F.lit("."))


def extract_domain(c) -> Column:
    return F.split_part(_col(c), F.lit("."), F.lit(1))


def extract_table(c) -> Column:
    """Table name of ``Domain.name``, without the suffix of a delete file."""
    name = F.split_part(_col(c), F.lit("."), F.lit(2))
    return safe_table_name(F.replace(name, F.lit(DELETES_SUFFIX), F.lit("")))


def parquet_file(c) -> Column:
    """The same path with the Parquet extension."""
    return F.regexp_replace(_col(c), r"\.csv$", ".parquet")


def join_path(*parts) -> Column:
    return F.concat_ws("/", *parts)


def version_part(c, index: int) -> Column:
    """Number ``index`` (1 document, 2 major, 3 minor) of ``<doc>_<major>_<minor>``."""
    return F.split_part(_col(c), F.lit("_"), F.lit(index)).try_cast("bigint")


def version_path(doc, major, minor, name) -> Column:
    """``<doc>/<major>_<minor>/<name>``."""
    version = F.concat_ws("_", _col(major).cast("string"), _col(minor).cast("string"))
    return F.concat_ws("/", _col(doc).cast("string"), version, _col(name))


def encode_path(c) -> Column:
    """Percent-encode a path, keeping ``/``."""
    encoded = F.url_encode(_col(c))
    # fixed values: where form encoding and path encoding differ
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def tidy_path(c) -> Column:
    """Single slashes, no ``.`` segments and no trailing slash."""
    path = F.regexp_replace(_col(c), r"/(\./)+", "/")
    path = F.regexp_replace(path, r"/{2,}", "/")
    path = F.regexp_replace(path, r"/\.$", "")
    return F.regexp_replace(path, r"(?<=.)/$", "")


def staging_path(file, user_id, sees_all: Column) -> Column:
    """Path of an exported file on the staging area: below the user's folder for users who see every folder."""
    prefixed = F.concat(F.lit("u"), _col(user_id).cast("string"), _col(file))
    return encode_path(tidy_path(F.when(sees_all, prefixed).otherwise(F.ltrim(_col(file), F.lit("/")))))


def _percent_bytes(c: Column) -> Column:
    """Percent-encoded text to its bytes."""
    pieces = F.regexp_extract_all(c, F.lit("%[0-9A-Fa-f]{2}|(?s:.)"), F.lit(0))
    hexed = F.transform(
        pieces,
        lambda p: F.when(p.rlike("^%[0-9A-Fa-f]{2}$"), F.substring(p, 2, 2)).otherwise(F.hex(p.cast("binary"))),
    )
    return F.unhex(F.array_join(hexed, ""))


def disposition_filename(c) -> Column:
    """File name of a Content-Disposition header: ``filename*`` first, then quoted, then bare ``filename``."""
    header = _col(c)
    extended = F.regexp_extract(header, r"(?i)(?:^|;)\s*filename\*\s*=\s*\"?(?:UTF-8|ISO-8859-1)'[^']*'([^;\"\s]+)", 1)
    latin = header.rlike(r"(?i)filename\*\s*=\s*\"?ISO-8859-1'")
    raw = _percent_bytes(extended)
    decoded = F.when(latin, F.decode(raw, "ISO-8859-1")).otherwise(F.make_valid_utf8(raw.cast("string")))
    quoted = F.regexp_replace(
        F.regexp_extract(header, r"(?i)(?:^|;)\s*filename\s*=\s*\"((?:[^\"\\]|\\.)*)\"", 1), r"\\(.)", "$1"
    )
    bare = F.regexp_extract(header, r"(?i)(?:^|;)\s*filename\s*=\s*([^;\"\s]+)", 1)
    return (
        F.when(extended != "", decoded)
        .when(quoted != "", quoted)
        .when(bare != "", bare)
    )


def quote_name(name: str) -> str:
    """A column or table name quoted for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"
