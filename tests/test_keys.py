"""Surrogate keys and sorting (W1-W4, S1, S2; FIXTURES §4.6)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starweave.operators import keys as K
from starweave.session import read_table

SMALL = "/root/testdata/sf0.001"
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def plain_window_key(df, order, name):
    """W1 by definition, row_number() over the whole input in one partition:
    the reference answer for small fixtures only."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.select(F.row_number().over(w).cast("bigint").alias(name), *df.columns)


def test_dense_key_equals_plain_window_at_any_partition_count(spark):
    li = read_table(spark, SMALL, "lineitem")
    ref = plain_window_key(li, ORDER, "id")
    for n in (1, 3, 16):
        got = K.dense_key(li, ORDER, "id", partitions=n)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_dense_key_is_dense_and_unique_with_start_interval(spark):
    li = read_table(spark, SMALL, "lineitem")
    got = K.dense_key(li, ORDER, "sk", start=100, interval=5, partitions=7)
    n = li.count()
    agg = got.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).first()
    assert (agg[0], agg[1], agg[2]) == (100, 100 + 5 * (n - 1), n)


def test_dense_key_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    assert [(r.id, r.x) for r in K.dense_key(df, ["x"], "id").orderBy("id").collect()] == \
        [(1, None), (2, "a"), (3, "b")]


def test_dense_rank_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 0)], "x string, y int")
    got = sorted((r.id, r.x, r.y) for r in K.dense_rank_key(df, ["x"], "id").collect())
    assert got == [(1, None, 2), (2, "a", 1), (2, "a", 1), (3, "b", 0)]


def test_sort_numeric_text(spark):
    vals = ["10", "9", "-2", "+3", "007", "1.50", "", "abc"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v string, i int")
    got = [r.v for r in K.sort(df, 0., 1).collect()]
    # non-numbers first (as NULL), then by value; ties by the second key
    assert got == ["", "abc", "-2", "1.50", "+3", "007", "9", "10"]
    assert [r.v for r in K.sort(df, 0).collect()][:3] == ["", "+3", "-2"]  # text: code point order
    desc = [r.v for r in K.sort(df, 0., 1, descending=True).collect()]
    assert desc[:2] == ["10", "9"] and set(desc[-2:]) == {"", "abc"}


def test_sort_position_matches_sort(spark):
    vals = ["10", "9", "-2", "+3", "007", "1.50", "", "abc"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v string, i int")
    pos = [r.v for r in K.sort_position(df, 0., 1, partitions=3).orderBy("pos").collect()]
    assert pos == [r.v for r in K.sort(df, 0., 1).collect()]


def test_first_n(spark):
    o = read_table(spark, SMALL, "orders")
    top = K.first_n(o, 5, order=["o_totalprice", "o_orderkey"], descending=True).collect()
    best = o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").desc()).limit(5).collect()
    assert top == best


def test_keys_by_position_equal_the_plain_window_and_read_the_input_once(spark):
    li = read_table(spark, SMALL, "lineitem")
    ref = plain_window_key(li, ORDER, "id")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    once = li.withColumn("l_orderkey", counted("l_orderkey"))
    got = K.dense_key(once, ORDER, "id", by_position=True)
    assert seen.value == li.count()
    assert got.columns == ref.columns and got.exceptAll(ref).count() == 0 and got.count() == ref.count()
    assert seen.value == li.count()  # nothing of the input runs again


def test_keys_by_position_with_start_nulls_and_expressions(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("a", 3)], "x string, id2 long").repartition(3)
    got = K.dense_key(df, [F.upper("x"), "id2"], "id", start=10, interval=5, first=False, by_position=True)
    assert got.columns == ["x", "id2", "id"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(None, 2, 10), ("a", 3, 15), ("a", 3, 20), ("b", 1, 25)]
    assert K.dense_key(df.limit(0), ["x"], "id", by_position=True).collect() == []
