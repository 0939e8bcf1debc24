"""Names, flags, text cells, types and geometry."""

from __future__ import annotations

import pytest
from helpers import rows
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tableferry as tf
from tableferry.functions.names import distinct_names
from tableferry.functions.text import NA_TOKENS
from tableferry.functions.types import text_types


@pytest.mark.parametrize(
    "name, cleaned",
    [
        ("Total Price ($)", "total_price_"),
        ("a[0].b", "a0b"),
        ("x;y|z", "x;y|z"),
        ("tab\there", "tabhere"),
        ("宽（度）", "宽度"),
        ("100%!", "100"),
        ("e-mail@home", "emailhome"),
        ("it's \"ok\"", "its_ok"),
        ("", ""),
    ],
)
def test_clean_name(name, cleaned):
    assert tf.clean_name(name) == cleaned


def test_clean_name_keeps_case_on_request():
    assert tf.clean_name("Total Price", lower=False) == "Total_Price"


@given(st.text())
def test_cleaning_names_twice_changes_nothing(name):
    once = tf.clean_name(name, lower=False)
    assert tf.clean_name(once, lower=False) == once


@given(st.lists(st.sampled_from(["a", "A", "a_2", "a_3", "b", ""]), max_size=8))
def test_distinct_names_never_repeat(names):
    result = distinct_names(names)
    assert len({n.lower() for n in result}) == len(names)


def test_clean_names_runs_on_odd_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "a b", "A[B]"])
    assert tf.clean_names(df).columns == ["ab", "a_b", "ab_2"]
    assert rows(tf.clean_names(df)) == [(1, 2, 3)]


# The words that read as true.
@pytest.mark.parametrize("value", ["True", "TRUE", "true", "T", "YES", "yes", "Yes", "OK", "ok", "Ok"])
def test_true_words(value):
    assert tf.as_flag(value)


@pytest.mark.parametrize("value", ["t", "y", "TRUE ", "1", "", None, False, 0, 2])
def test_other_values_are_false(value):
    assert not tf.as_flag(value)


def test_true_and_one_are_true():
    assert tf.as_flag(True) and tf.as_flag(1)


def test_escape_and_strip_touch_text_only(spark):
    df = spark.createDataFrame([(1, "a'b\"c", "[x]\\"), (2, None, "")], ["n", "s.t", "u"])
    assert rows(tf.escape_quotes(df)) == [(1, "a''b''c", "[x]\\"), (2, None, "")]
    assert rows(tf.strip_unsafe(df)) == [(1, "a'bc", "x"), (2, None, "")]
    assert rows(tf.empty_as_null(df)) == [(1, "a'b\"c", "[x]\\"), (2, None, None)]


def test_na_tokens_become_null(spark):
    df = spark.createDataFrame([(t,) for t in (*NA_TOKENS, "na", "0")], ["s"])
    assert tf.na_as_null(df).where("s IS NOT NULL").collect() == [("na",), ("0",)]


@pytest.mark.parametrize(
    "cells, expected",
    [
        (["1", "-2", " +3 ", None], "bigint"),
        (["1", "2.5"], "double"),
        (["1e3", ".5", "5."], "double"),
        (["inf", "-Infinity"], "double"),
        (["True", "false"], "boolean"),
        (["True", "1"], "string"),
        (["t", "f"], "string"),
        (["1d", "2f"], "string"),
        (["0x1", "2"], "string"),
        (["9223372036854775807"], "bigint"),
        (["9223372036854775808"], "string"),
        (["00000000000000000000007"], "bigint"),
        (["2024-01-01"], "string"),
        ([None, None], "double"),
    ],
)
def test_text_types(spark, cells, expected):
    df = spark.createDataFrame([(c,) for c in cells], "s string")
    assert text_types(df) == {"s": expected}
    assert tf.infer_types(df).schema["s"].dataType.simpleString() == expected
    known = [c for c in cells if c is not None]
    assert tf.infer_types(df).where("s IS NOT NULL").count() == len(known)


def test_type_map(spark):
    df = spark.sql(
        "SELECT 1L AS big, 1 AS small, 0.1D AS real, true AS flag, 'x' AS word, "
        "DATE'2024-01-02' AS day, CAST(NULL AS INT) AS none"
    )
    mapped = tf.apply_type_map(df)
    assert [f.dataType.simpleString() for f in mapped.schema] == [
        "bigint", "string", "float", "string", "string", "string", "string",
    ]
    row = mapped.first()
    assert (row.small, row.flag, row.day, row.none) == ("1", "True", "2024-01-02", None)
    assert row.real == pytest.approx(0.1, abs=1e-8) and row.real != 0.1


GOOD_WKT = {
    "POINT(7.25 51.5)": "POINT(7.25 51.5)",
    "point ( 1.5   -2e1 )": "POINT(1.5 -20)",
    " POINT(+.5 5.)\n": "POINT(0.5 5)",
    "LINESTRING (2 4, 6 8, 1 1)": "LINESTRING(2 4,6 8,1 1)",
    "POLYGON ((0 0, 8 0, 8 6, 0 6, 0 0))": "POLYGON((0 0,8 0,8 6,0 6,0 0))",
    "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0),\n(2 2, 3 2, 3 3, 2 2))": "POLYGON("
    "(0 0,9 0,9 9,0 9,0 0),(2 2,3 2,3 3,2 2))",
    "POINT EMPTY": "POINT EMPTY",
    "polygon empty": "POLYGON EMPTY",
    "MULTIPOINT (1 2, 3 4)": "MULTIPOINT((1 2),(3 4))",
    "MULTIPOINT ((1 2), (3 4))": "MULTIPOINT((1 2),(3 4))",
    "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8, 9 9))": "MULTILINESTRING((1 2,3 4),(5 6,7 8,9 9))",
    "MULTIPOLYGON (((0 0, 0 9, 9 9, 0 0), (1 2, 1 3, 2 3, 1 2)), ((5 5, 5 6, 6 6, 5 5)))": "MULTIPOLYGON("
    "((0 0,0 9,9 9,0 0),(1 2,1 3,2 3,1 2)),((5 5,5 6,6 6,5 5)))",
    "MultiPolygon Empty": "MULTIPOLYGON EMPTY",
}
BAD_WKT = [
    "", "POINT", "POINT()", "POINT (1)", "POINT (1 2 3)", "POINT (1 2", "POINT 1 2)",
    "POINT ((1 2))", "POINT (1 2))", "POINT (1 2, 3 4)", "POINT (1d 2)", "POINT (NaN 1)",
    "POINT (0x1 1)", "POINT(1e 2)", "LINESTRING (0 0)", "LINESTRING(1 2,)", "CIRCLE (1 2)",
    "POLYGON (())", "POLYGON (0 0, 0 1, 1 1, 0 0)", "POLYGON ((0 0, 0 1, 1 1, 0 1))",
    "POLYGON ((0 0, 0 1, 0 0))", "POLYGON((0 0,0 1,1 1,0 0),)", "POINTEMPTY",
    "MULTIPOINT (1 2, (3 4))", "MULTIPOINT ((1 2, 3 4))", "MULTILINESTRING (1 2, 3 4)",
    "MULTILINESTRING ((1 2), (3 4, 5 6))", "MULTIPOLYGON ((0 0,0 1,1 1,0 0))",
    "MULTIPOLYGON (((0 0,0 1,1 1,0 0)),)", "MULTIPOLYGON (((0 0,0 1,1 1,0 1)))",
    "POLYGON (((0 0,0 1,1 1,0 0)))", "POLYGON((0 0,0 1,1 1,0 0)(1 1,1 2,2 2,1 1))", "POINT(1 2) POINT(1 2)", "POINT(1 2) x",
]


def test_good_wkt(spark):
    df = spark.createDataFrame(list(GOOD_WKT.items()), "wkt string, expected string")
    g = tf.parse_wkt(F.col("wkt"))
    for row in df.select("expected", tf.to_wkt(g).alias("got"), tf.is_valid(g).alias("ok")).collect():
        assert row.ok and row.got == row.expected


def test_bad_wkt(spark):
    df = spark.createDataFrame([(w,) for w in BAD_WKT], "wkt string")
    g = tf.parse_wkt(F.col("wkt"))
    assert [r.wkt for r in df.where(tf.is_valid(g)).collect()] == []


def test_null_wkt_and_declared_types(spark):
    df = spark.createDataFrame([(None,), ("POINT(1 2)",)], "wkt string")
    g = tf.parse_wkt(F.col("wkt"))
    got = df.select(
        g.isNull().alias("none"),
        tf.is_valid(g, "POINT").alias("p"),
        tf.is_valid(g, "polygon").alias("q"),
    )
    assert rows(got) == [(False, True, False), (True, True, True)]
    assert df.where("wkt IS NOT NULL").select(tf.to_wkt(g, with_srid=True)).first()[0] == (
        "SRID=4326;POINT(1 2)"
    )
    with pytest.raises(ValueError, match="unsupported"):
        tf.is_valid(F.col("g"), "CIRCLE")


def test_a_ring_of_many_points(spark):
    n = 50_000
    ring = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.concat(i % n, F.lit(" 0"))), ", "
    )
    g = tf.parse_wkt(F.concat(F.lit("POLYGON (("), ring, F.lit("))")))
    row = spark.range(1).select(F.size(g["coords"][0]).alias("n"), tf.is_valid(g).alias("ok")).first()
    assert tuple(row) == (n + 1, True)


def test_add_geometry_is_all_or_nothing(spark):
    good = spark.createDataFrame([(1, "POINT(1 2)"), (2, None)], "k int, wkt string")
    added = tf.add_geometry(good, "wkt")
    assert added.invalid == 0 and added.frame.columns == ["k", "wkt", "geometry"]
    bad = good.union(spark.createDataFrame([(3, "LINESTRING(0 0,1 1)")], good.schema))
    refused = tf.add_geometry(bad, "wkt")
    assert refused.frame.columns == ["k", "wkt"]
    assert (refused.invalid, refused.errors.first().k) == (1, 3)
    for column in ("", "no_such_column"):
        with pytest.raises(ValueError):
            tf.add_geometry(good, column)


def test_geometry_schema_is_stable(spark):
    g = spark.range(1).select(tf.parse_wkt(F.lit("POINT(1 2)")).alias("g")).schema["g"].dataType
    assert [f.name for f in g.fields] == ["type", "srid", "wkt", "coords", "parts"]
    assert isinstance(g["coords"].dataType, T.ArrayType)
