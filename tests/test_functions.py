import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
import pytest

from lakewright.functions import dates, manifest, masking, tagged, text, warehouse_types

few = settings(max_examples=6, deadline=None)


def test_snake_case_examples(spark):
    cases = {
        "HTTPResponseCode": "http_response_code",
        "camelCase": "camel_case",
        "already_snake": "already_snake",
        "userID2Name": "user_id2_name",
        "A": "a",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    assert {r[0]: r[1] for r in df.select("name", text.snake_case(F.col("name"))).collect()} == cases


def scanned(name):
    """Snake case letter by letter: where a boundary is marked depends on the letters around it."""
    stops = "\n"
    marks, at = set(), 1
    while at < len(name) - 1:  # a capital with small letters after it starts a word, unless it is first
        if name[at].isupper() and name[at + 1].islower() and name[at - 1] not in stops:
            marks.add(at)
            at += 1
            while at < len(name) and name[at].islower():
                at += 1
            at += 1  # a word's start needs a letter of its own before it
        else:
            at += 1
    once = "".join(("_" if i in marks else "") + c for i, c in enumerate(name))
    out = ""
    for i, c in enumerate(once):
        before = once[i - 1] if i else ""
        out += "_" + c if c.isupper() and (before.islower() or before.isdigit()) else c
    return out.lower()


@few
@given(st.lists(st.text(alphabet="aB3_zQ\n\r\u2028-", max_size=14), min_size=1, max_size=40))
def test_snake_case_letter_by_letter(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(text.snake_case(F.col("name"))).collect()]
    assert got == [scanned(n) for n in names]


def test_rename_columns_snake(spark):
    df = spark.createDataFrame([(1, 2)], "customerID int, HTTPCode int")
    assert text.rename_columns_snake(df).columns == ["customer_id", "http_code"]


def test_text_size_units(spark):
    df = spark.createDataFrame([("Élan",)], "t string")
    assert df.select(text.text_size(F.col("t")), text.text_size(F.col("t"), "bytes")).first()[:] == (4, 5)
    with pytest.raises(ValueError):
        text.text_size(F.col("t"), "words")


def days(spark, first, last):
    df = spark.createDataFrame([(first, last)], "a string, b string")
    return df.select(dates.date_range(F.col("a"), F.col("b"))).first()[0]


def test_date_range_edges(spark):
    assert days(spark, "2024-03-01", "2024-02-28") == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert days(spark, "2024-1-5", "2024-01-05") == [dt.date(2024, 1, 5)]
    for absent in (None, "", "2024-01"):
        assert days(spark, absent, "2024-01-05") == []
        assert days(spark, "2024-01-05", absent) == []
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        days(spark, "notadate1", "2024-01-05")


@few
@given(st.lists(st.tuples(st.dates(dt.date(1999, 1, 1), dt.date(2031, 1, 1)), st.integers(-40, 40)), min_size=1, max_size=30))
def test_date_range_like_python(spark, bounds):
    pairs = [(a, a + dt.timedelta(n)) for a, n in bounds]
    df = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string")
    got = [r[0] for r in df.select(dates.date_range(F.col("a"), F.col("b"))).collect()]
    assert got == [
        [min(pair) + dt.timedelta(i) for i in range(abs((pair[1] - pair[0]).days) + 1)] for pair in pairs
    ]


def test_date_path_and_previous_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 6), "f.csv")], "d date, f string")
    got = df.select(
        dates.date_path("root", F.col("d"), F.col("f")),
        dates.is_previous_day(F.col("d"), dt.date(2024, 4, 7)),
        dates.is_previous_day(F.col("d"), F.col("d")),
        dates.date_text(F.col("d")),
    ).first()
    assert tuple(got) == ("root/2024/04/06/f.csv", True, False, "2024-04-06")


def test_manifest_split(spark):
    df = spark.createDataFrame([("a",), ("a@@@q",), ("a@@@q@@@more",), ("@@@q",)], "e string")
    got = df.select(manifest.manifest_file(F.col("e")), manifest.manifest_delete_query(F.col("e"))).collect()
    assert [tuple(r) for r in got] == [("a", None), ("a", "q"), ("a", "q"), ("", "q")]


def test_manifest_envelope_json(spark):
    df = spark.createDataFrame([(["f1", "f2@@@DELETE"],), ([],), (None,)], "files array<string>")
    envelope = F.to_json(manifest.manifest_envelope(F.col("files"), "b"), {"ignoreNullFields": "false"})
    full, empty, absent = (r[0] for r in df.select(envelope).collect())
    assert full == (
        '{"data":{"execution":"done"},"Records":['
        '{"s3":{"bucket":{"name":"b"},"object":{"key":"f1"},"delete_query":null}},'
        '{"s3":{"bucket":{"name":"b"},"object":{"key":"f2"},"delete_query":"DELETE"}}],'
        '"StepFunctionTriggered":true,"Errors":0}'
    )
    assert empty == absent == '{"data":{"execution":"done"},"Records":[],"StepFunctionTriggered":true,"Errors":0}'


def test_tagged_values(spark):
    cells = [
        {"stringValue": "x"},
        {"longValue": 3},
        {"isNull": True},
        {"doubleValue": 1.5},
        {},
        {"booleanValue": False},
        {"stringValue": "s", "longValue": 9},
    ]
    df = spark.createDataFrame([(cells,), (cells[:2],)], f"record array<{tagged.TAGGED_VALUE}>")
    keys = list("abcdefg")
    assert tuple(tagged.decode_tagged(df, "record", keys, {"b": "bigint"}).first()) == ("x", 3, None, "1.5", None, "false", "s")
    maps = [r[0] for r in df.select(tagged.tagged_map(F.col("record"), keys[:6])).collect()]
    assert maps == [{"a": "x", "b": "3", "c": None, "d": "1.5", "e": None, "f": "false"}, {"a": "x", "b": "3"}]


def test_dummy_values(spark):
    schema = "s string, i int, b bigint, d double, t timestamp_ntz"
    df = spark.createDataFrame([(None, None, 5, 1.5, None)], schema)
    got = masking.dummy_values(df)
    assert tuple(got.first()) == ("dummy_value", 0, 5, 1.5, None)
    assert got.columns == df.columns


def test_masks(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "s string, i int, d double")
    got = masking.mask_columns(df, {"s": "sha256", "i": "constant", "d": "null"}).first()
    assert tuple(got) == ("ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb", 0, None)
    with pytest.raises(ValueError):
        masking.mask_columns(df, {"nope": "null"})
    with pytest.raises(ValueError):
        masking.mask_columns(df, {"d": "constant"})
    with pytest.raises(ValueError):
        masking.mask_columns(df, {"d": "blur"})


SIZED = {
    ("string", 12): "VARCHAR(12)", ("string", None): "VARCHAR(255)", ("string", 0): "VARCHAR(255)",
    ("string_list", 7): "VARCHAR(7)", ("int", None): "INTEGER", ("integer", None): "VARCHAR(255)",
    ("timestamp", None): "TIMESTAMP", ("boolean", None): "BOOLEAN", ("double", None): "DOUBLE PRECISION",
    ("double precision", None): "DOUBLE PRECISION", ("array<string>", None): "SUPER", ("bigint", None): "VARCHAR(255)",
    ("float", None): "VARCHAR(255)", ("decimal(10,2)", None): "VARCHAR(255)", ("map<string,int>", None): "VARCHAR(255)",
}
FIXED = {"string": "VARCHAR(65535)", "string_list": "VARCHAR(65535)", "int": "INTEGER", "array<int>": "SUPER", "date": "VARCHAR(65535)"}
EXTENDED = {"bigint": "BIGINT", "decimal(10,2)": "DECIMAL(10,2)", "struct<a:int>": "SUPER", "date": "DATE", "float": "REAL"}


def test_type_maps(spark):
    df = spark.createDataFrame(list(SIZED), "t string, n int")
    got = [r[0] for r in df.select(warehouse_types.sized_type(F.col("t"), F.col("n"))).collect()]
    assert got == list(SIZED.values())
    df = spark.createDataFrame([(t,) for t in FIXED], "t string")
    assert [r[0] for r in df.select(warehouse_types.fixed_type(F.col("t"))).collect()] == list(FIXED.values())
    df = spark.createDataFrame([(t,) for t in EXTENDED], "t string")
    assert [r[0] for r in df.select(warehouse_types.fixed_type(F.col("t"), True)).collect()] == list(EXTENDED.values())


def test_catalog_type_names():
    assert warehouse_types.catalog_type(T.TimestampNTZType()) == "timestamp"
    assert warehouse_types.catalog_type(T.ArrayType(T.FloatType())) == "array<float>"
