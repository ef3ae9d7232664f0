"""Unpivot, split, union (FIXTURES §4.7)."""

import pytest
from pyspark.sql import functions as F

from starweave.operators import project as P
from starweave.operators import reshape as R


def test_normalise_groups_and_blanks(spark):
    df = spark.createDataFrame([("c", "a1", "b1", "a2", "b2"), ("d", "x", None, "", None)],
                               "k string, a1 string, b1 string, a2 string, b2 string")
    allrows = sorted(tuple(r) for r in R.normalise(df, 2, 1, 2, 3, 4).collect())
    assert allrows == [("c", "a1", "b1"), ("c", "a2", "b2"), ("d", "", None), ("d", "x", None)]
    kept = sorted(tuple(r) for r in R.normalise(df, 2, 1, 2, 3, 4, blanks="n").collect())
    assert kept == [("c", "a1", "b1"), ("c", "a2", "b2"), ("d", "x", None)]


def test_normalise_odd_fields_raise(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", "e")], "a string, b string, c string, d string, e string")
    with pytest.raises(ValueError):
        R.normalise(df, 2, 0, 1, 2, 3, 4)


def test_split_attributes(spark):
    df = spark.createDataFrame([("x", " a - b "), ("y", "c")], "k string, v string")
    got = [tuple(r) for r in R.split_attributes(df, "-", "v", width=2).collect()]
    assert got == [("x", "a", "b"), ("y", "c", None)]
    arr = [r.v for r in R.split_attributes(df, "-", 1).collect()]
    assert arr == [["a", "b"], ["c"]]
    with pytest.raises(Exception):
        R.split_attributes(spark.createDataFrame([("a-b-c",)], "v string"), "-", "v", width=2).collect()


def test_union_branches_one_scan(spark):
    df = spark.createDataFrame([("a/b", 1), ("c", 2)], "n string, i int")
    out = R.union_branches(df, [
        (F.col("n").like("%/%"), {"nm": F.substring_index("n", "/", 1), "i": F.col("i")}),
        (F.col("n").like("%/%"), {"nm": F.substring_index("n", "/", -1), "i": F.col("i")}),
        (F.lit(True), {"nm": F.col("n"), "i": F.col("i")}),
    ])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1), ("a/b", 1), ("b", 1), ("c", 2)]
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_flatten_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert R.flatten(a, a, a).count() == 3


def test_fan_out_bounds(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert len(R.fan_out(a, 3)) == 3
    with pytest.raises(ValueError):
        R.fan_out(a, 6)


def test_keep_append_fields(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    k = P.keep_fields(df, 2, 0, 0, "x")
    assert k.columns == ["c", "a", "a_1", "blank"] and tuple(k.first()) == (2.0, 1, 1, None)
    t = P.keep_fields(df, 0, 2, as_text=True)
    assert t.dtypes == [("a", "string"), ("c", "string")]
    a = P.append_fields(df, 1, "x")
    assert a.columns == ["a", "b", "c", "b_1", "blank"]
    assert P.drop_fields(df, 0, 2).columns == ["b"]


def test_xform_runs_in_order_and_append_sees_new_fields(spark):
    df = spark.createDataFrame([("ab",)], "s string")
    x = P.xform(df, [(0, lambda c: F.concat(c, F.lit("1"))), (0, F.upper)]).first()[0]
    assert x == "AB1"
    y = P.xform_append(df, [(0, F.upper), (1, lambda c: F.concat(c, F.lit("!")))]).first()
    assert tuple(y) == ("ab", "AB", "AB!")


def test_blank_groups_derived_and_case(spark):
    df = spark.createDataFrame([("a", None, ""), ("b", "", None), ("c", "x", None)], "k string, a string, b string")
    assert [r.k for r in P.drop_blank_groups(df, [1, 2]).collect()] == ["c"]
    out = P.with_derived(df, up=F.upper("k"), flag=P.case_when([(F.col("a").isNull(), F.lit("none"))], F.lit("some")))
    assert [tuple(r)[-2:] for r in out.orderBy("k").collect()] == [("A", "none"), ("B", "some"), ("C", "some")]
    with pytest.raises(ValueError):
        P.case_when([])
    assert P.like_filter(df, "k", "b%").count() == 1 and P.like_filter(df, 0, "b%", negate=True).count() == 2


def test_count_by_without_columns(spark):
    from starweave.operators import agg as A

    empty = spark.createDataFrame([], "x int")
    assert [tuple(r) for r in A.count_by(empty).collect()] == [(0,)]  # one row holding 0, as SQL gives
    three = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert sorted(tuple(r) for r in A.count_by(three, 0).collect()) == [(1, 2), (2, 1)]


def test_split_attributes_width_is_checked_whatever_is_read(spark):
    df = spark.createDataFrame([("a-b-c",)], "v string")
    import pytest

    with pytest.raises(Exception, match="more than 2 parts"):
        R.split_attributes(df, "-", "v", width=2).select("v_2").collect()


def test_split_attributes_finds_the_width(spark):
    df = spark.createDataFrame([(1, "a - b", "x"), (2, "c", None), (3, None, "y,z,w"), (4, "d-e-f-g", "")],
                               "k long, v string, w string")
    got = R.split_attributes(df, "-", "v", width="auto")
    assert got.columns == ["k", "v_1", "v_2", "v_3", "v_4", "w"]
    assert [tuple(r)[1:5] for r in got.orderBy("k").collect()] == [
        ("a", "b", None, None), ("c", None, None, None), (None,) * 4, ("d", "e", "f", "g")]
    two = R.split_attributes(df.replace("-", ","), ",", "v", "w", width="auto")
    assert two.columns == ["k", "v_1", "w_1", "w_2", "w_3"]
    assert R.split_attributes(df.limit(0), "-", "v", width="auto").columns == ["k", "v_1", "w"]
    assert R.split_widths(df, "-", "v", "w") == {"v": 4, "w": 1}
    with pytest.raises(ValueError):
        R.split_attributes(df, "-", "v", width="wide")
