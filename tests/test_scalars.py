import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelbook.functions import text as tx
from reelbook.functions import variants as vr
from reelbook.sources import messages


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])
    return frame.select(column).first()[0]


@pytest.mark.parametrize(
    "url, name",
    [
        ("https://h/@ann", "ann"),
        ("https://h/@a@b", "b"),
        ("https://h/@ann/video/1?q=2", "ann/video/1?q=2"),
        ("no sign", "no sign"),
        ("https://h/@ann\n", "ann\n"),
    ],
)
def test_url_username(spark, url, name):
    assert one(spark, tx.url_username(F.col("u")), u=url) == name


@pytest.mark.parametrize(
    "path, name",
    [
        ("profiles/ann/t.html", "ann"),
        ("profiles/ann//t.html", ""),
        ("profiles/ann/video/1/t.html", "1"),
        ("t.html", None),
    ],
)
def test_path_username(spark, path, name):
    assert one(spark, tx.path_username(F.col("p")), p=path) == name


@pytest.mark.parametrize(
    "text, number",
    [
        ("1,234", 1234),
        ("115.2M", 1152),
        ("-5", 5),
        ("", None),
        ("abc", None),
        ("9" * 25, None),
    ],
)
def test_digits_to_long(spark, text, number):
    assert one(spark, tx.digits_to_long(F.col("t")), t=text) == number


@pytest.mark.parametrize(
    "seconds, iso",
    [
        (0, "1970-01-01T00:00:00"),
        (1700000000, "2023-11-14T22:13:20"),
        (-62135596800, "0001-01-01T00:00:00"),
        (253402300799, "9999-12-31T23:59:59"),
        (253402300800, None),
        (1700000000000, None),
    ],
)
def test_epoch_to_iso(spark, seconds, iso):
    assert one(spark, tx.epoch_to_iso(F.col("s").cast("bigint")), s=seconds) == iso


@pytest.mark.parametrize("text", [" \t\n a b \r", "　a b ", "\x1ca b\x85", "a b"])
def test_strip_is_unicode(spark, text):
    assert one(spark, tx.strip(F.col("t")), t=text) == "a b"


def test_paths(spark):
    at = F.lit(dt.datetime(2024, 1, 2, 3, 4, 5)).cast("timestamp_ntz")
    assert one(spark, tx.landing_path(F.lit("ann"), at)) == "profiles/ann/20240102-030405.html"
    assert one(spark, tx.processed_path("videos", F.lit("ann"), at)) == (
        "videos/ann/20240102-030405.json"
    )


def test_decode_payload(spark):
    rows = [("aHR0cHM6Ly9oL0Bhbm4=",), ("aHR0cHM6Ly9oL0Bhbm4K",), ("!!bad",), ("/w==",)]
    decoded = messages.decode(spark.createDataFrame(rows, "data string")).collect()
    assert [row.url for row in decoded] == ["https://h/@ann", "https://h/@ann\n", None, None]
    assert decoded[0].username == "ann"


@pytest.mark.parametrize(
    "json, expected",
    [
        ("null", False),
        ("false", False),
        ("0", False),
        ("0.0", False),
        ("-0.0", False),
        ('""', False),
        ("[]", False),
        ("{}", False),
        ("true", True),
        ("7", True),
        ("0.5", True),
        ('"0"', True),
        ('"false"', True),
        ('"[]"', True),
        ("[0]", True),
        ('{"a":null}', True),
    ],
)
def test_truthy(spark, json, expected):
    assert one(spark, vr.truthy(F.parse_json(F.col("j"))), j=json) is expected


@pytest.mark.parametrize(
    "json, sql_type, loads, value",
    [
        ("12", "bigint", True, 12),
        ('"12"', "bigint", True, 12),
        ("12.0", "bigint", True, 12),
        ("2.5", "bigint", False, None),
        ("true", "bigint", False, None),
        ('"x"', "bigint", False, None),
        ("12345678901234567890", "bigint", False, None),
        ("null", "bigint", True, None),
        ("[1]", "bigint", False, None),
        ("7", "string", True, "7"),
        ("true", "string", True, "true"),
        ("{}", "string", False, None),
        ("null", "string", True, None),
        ("true", "boolean", True, True),
        ('"No"', "boolean", True, False),
        ("1", "boolean", True, True),
        ("2", "boolean", False, None),
    ],
)
def test_loading_values(spark, json, sql_type, loads, value):
    doc = F.parse_json(F.col("j"))
    assert one(spark, vr.loads_as(doc, sql_type), j=json) is loads
    if loads:
        assert one(spark, vr.typed(doc, sql_type), j=json) == value


def test_plain_values(spark):
    doc = F.parse_json(F.col("j"))
    cases = {"12": "BIGINT", "-9223372036854775808": "BIGINT", '"12"': "STRING", '""': "STRING", "true": "BOOLEAN"}
    for kind in ("BIGINT", "STRING", "BOOLEAN"):
        for json in (*cases, "9223372036854775808", "1.0", "1e3", "null", "{}", "[1]"):
            assert one(spark, vr.is_plain(doc, kind), j=json) is (cases.get(json) == kind)
        assert one(spark, vr.is_plain(F.try_variant_get(doc, "$.a", "variant"), kind), j="{}") is False


def test_missing_is_not_null(spark):
    doc = vr.object_of(F.parse_json(F.col("j")), "a", "b")
    given, missing = (
        one(spark, vr.default_if_missing(doc[key], 5, "bigint"), j='{"a":null}') for key in "ab"
    )
    assert given is None and missing == 5
