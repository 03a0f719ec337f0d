import datetime
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clean as c


def value(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression("t").alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", [("TRUE", True), (" true ", True), ("1", True), ("0", False), ("False", False), ("yes", None),
                                       ("t", None), ("", None), (None, None)])
def test_boolean(spark, text, want):
    assert value(spark, text, c.parse_boolean) is want


@pytest.mark.parametrize("text,want", [("7", 7), (" 7 ", 7), ("007", 7), ("1.0", 1), ("2.5", None), ("x", None), ("", None), (None, None),
                                       ("-3", -3), ("1e3", 1000), ("9223372036854775808", None)])
def test_long(spark, text, want):
    assert value(spark, text, c.parse_long) == want


@pytest.mark.parametrize("text,want", [("2.5", 2.5), ("", None), ("nan", None), ("x", None), (" -1 ", -1.0)])
def test_double(spark, text, want):
    assert value(spark, text, c.parse_double) == want


def test_decimal(spark):
    assert value(spark, " 1.25 ", c.parse_decimal) == decimal.Decimal("1.25")


@pytest.mark.parametrize("text,want", [
    ("2025-04-09T05:00Z", (5, 0, 0, 0)), ("2025-04-09T05:00:01.234Z", (5, 0, 1, 234000)), ("2025-04-09 05:00", (5, 0, 0, 0)),
    ("2025-04-09T05:00:01.234567Z", (5, 0, 1, 234000)), ("2025-04-09", (0, 0, 0, 0)), ("2025-04-09T05:00:00+02:00", (3, 0, 0, 0)),
])
def test_timestamp(spark, text, want):
    assert value(spark, text, lambda t: c.parse_timestamp(t).cast("timestamp_ntz")) == datetime.datetime(2025, 4, 9, *want)


@pytest.mark.parametrize("text", ["12:30", "junk", "", None, "2025-13-01"])
def test_timestamp_fails_to_null(spark, text):
    assert value(spark, text, c.parse_timestamp) is None


def test_date(spark):
    assert value(spark, " 2025-04-09 ", c.parse_date) == datetime.date(2025, 4, 9)
    assert value(spark, "9 April", c.parse_date) is None


@pytest.mark.parametrize("text,want", [("0x4142", b"AB"), ("0X41", b"A"), ("4142", None), ("0xZZ", None), ("0x", b""), ("", None)])
def test_hex(spark, text, want):
    assert value(spark, text, c.parse_hex_binary) == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aé€😀�\n", max_size=12), min_size=1, max_size=20), st.integers(1, 12))
def test_truncate_bytes_against_brute_force(spark, texts, limit):
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(c.truncate_bytes("t", limit)).collect()]

    def cut(t):
        while len(t.encode()) > limit:
            t = t[:-1]
        return t

    assert got == [cut(t) for t in texts]


def test_strings_stay_as_they_are(spark):
    df = spark.createDataFrame([("007", "NA", "", None)], "a string, b string, c string, d string")
    kept = df.select(*[c.clean_value(F.col(n), T.StringType()).alias(n) for n in df.columns]).first()
    assert tuple(kept) == ("007", "NA", "", None)


def test_replace_invalid(spark):
    df = spark.createDataFrame([(b"a\xffb",)], "t binary")
    assert df.select(c.replace_invalid("t")).first()[0] == "a�b"


@pytest.mark.parametrize("source,text,target,want", [
    ("bigint", "5", "string", "5"), ("string", "x", "bigint", None), ("double", "2.5", "bigint", None), ("double", "2.0", "bigint", 2),
    ("bigint", "1", "boolean", True), ("boolean", "true", "date", None), ("date", "2025-01-02", "string", "2025-01-02"),
])
def test_convert(spark, source, text, target, want):
    df = spark.createDataFrame([(text,)], "t string").select(F.col("t").try_cast(source).alias("t"))
    to = T.StructType.fromDDL(f"c {target}").fields[0].dataType
    assert df.select(c.convert_value("t", df.schema["t"].dataType, to)).first()[0] == want
