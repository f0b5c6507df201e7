from pyspark.sql.types import StringType

from millrace.operators import (
    binary_target,
    cast_by_type,
    cast_columns,
    column_modes,
    fill_modes,
    fit_modes,
    impute_mode,
    null_sentinel,
    split_columns,
)
from tests.helpers import rows


def table(spark):
    return spark.createDataFrame(
        [("?", "b", 10, 1.5, None), ("?", "a", 9, 1.5, None), ("x", "a", 10, 2.5, None),
         (None, "b", 9, None, None)],
        "s STRING, t STRING, i INT, d DOUBLE, e STRING",
    )


def test_modes_skip_missing_and_break_ties_by_value(spark):
    got = dict(rows(column_modes(table(spark), ["s", "t", "i", "d", "e"])))
    # 9 before 10: numbers tie as numbers, not as text
    assert got == {"s": "x", "t": "a", "i": "9", "d": "1.5", "e": None}


def test_modes_may_count_missing(spark):
    got = fit_modes(table(spark), ["s", "t", "e"], count_missing=True)
    assert got == {"s": "?", "t": "a", "e": None}


def test_modes_of_sentinels_only(spark):
    df = spark.createDataFrame([("?",), ("?",)], "s STRING")
    assert rows(column_modes(df, ["s"])) == [("s", None)]


def test_impute_keeps_types(spark):
    filled = impute_mode(table(spark), ["s", "d"])
    assert filled.dtypes == table(spark).dtypes
    assert rows(filled, "s") == [("x",)] * 4
    assert rows(filled, "d") == [(1.5,), (1.5,), (1.5,), (2.5,)]
    test = spark.createDataFrame([("?", None)], "s STRING, d DOUBLE")
    assert rows(fill_modes(test, fit_modes(table(spark), ["s", "d"]))) == [("x", 1.5)]


def test_sentinel_only_touches_text(spark):
    assert rows(null_sentinel(table(spark), "?"), "s") == sorted(
        [(None,), (None,), (None,), ("x",)], key=repr
    )
    assert null_sentinel(table(spark), "?").dtypes == table(spark).dtypes


def test_binary_target_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (3.5,), (None,)], "a DOUBLE")
    assert rows(binary_target(df, "a", "y"), "y") == [(0,), (1,), (None,)]


def test_split_and_cast(spark):
    df = spark.createDataFrame([(1, "1|2.5|x"), (2, "7"), (3, "")], "id INT, value STRING")
    parts = split_columns(df, ["a-b", "b", "c"], sep="|")
    assert parts.columns == ["id", "a-b", "b", "c"]
    assert rows(parts) == [(1, "1", "2.5", "x"), (2, "7", None, None), (3, "", None, None)]
    assert rows(cast_by_type(parts, StringType(), "double")) == [
        (1, 1.0, 2.5, None), (2, 7.0, None, None), (3, None, None, None)
    ]
    assert rows(cast_columns(parts, {"a-b": "int"}).select("`a-b`")) == [(1,), (7,), (None,)]
