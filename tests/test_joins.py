"""Joins and lookups on the cases of FIXTURES §4.5."""

import pytest

from starweave.operators import joins as J

MAIN = [("", "m-blank"), (None, "m-null"), ("1", "m-one"), ("k" * 40, "m-long"), ("2", "m-two")]
SIDE = [("", "s-blank"), (None, "s-null"), ("1", "s-one"), ("k" * 40, "s-long"), ("2", "s-two-a"),
        ("2", "s-two-b")]


@pytest.fixture()
def frames(spark):
    m = spark.createDataFrame(MAIN, "k string, mv string")
    s = spark.createDataFrame(SIDE, "k string, sv string")
    return m, s


def test_inner_multiplies_and_null_never_matches(frames):
    m, s = frames
    got = sorted((r.mv, r.sv) for r in J.join(m, s, "Inner", key=0).collect())
    assert got == [("m-blank", "s-blank"), ("m-long", "s-long"), ("m-one", "s-one"), ("m-two", "s-two-a"),
                   ("m-two", "s-two-b")]


def test_blank_matches_option(frames):
    m, s = frames
    got = sorted((r.mv, r.sv) for r in J.join(m, s, "inner", key=0, blank_matches=True).collect()
                 if r.mv in ("m-blank", "m-null"))
    # NULL and '' are both blank in the text model and match each other
    assert got == [("m-blank", "s-blank"), ("m-blank", "s-null"), ("m-null", "s-blank"), ("m-null", "s-null")]


def test_left_pads_unmatched(frames, spark):
    m, s = frames
    got = sorted((r.mv, r.sv) for r in J.join(m, s, "L", key=0, keep="1,3").collect())
    assert ("m-null", None) in got and len(got) == 6
    empty = spark.createDataFrame([], "k string, sv string")
    padded = J.join(m, empty, "left", key=0).collect()
    assert len(padded) == 5 and all(r.sv is None for r in padded)  # always padded, also on an empty side


def test_exists_and_not_exists(frames):
    m, s = frames
    assert sorted(r.mv for r in J.join(m, s, "exists").collect()) == ["m-blank", "m-long", "m-one", "m-two"]
    assert [r.mv for r in J.join(m, s, "Not_Exists").collect()] == ["m-null"]


def test_text_against_number_keys(spark):
    m = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([("1", "b")], "k string, w string")
    assert J.join(m, s, "inner", key=0).count() == 1


def test_composite_keys_do_not_collide(spark):
    m = spark.createDataFrame([("a~b", "c")], "x string, y string")
    s = spark.createDataFrame([("a", "b~c")], "x string, y string")
    assert J.join(m, s, "inner", key="0,1").count() == 0


def test_unknown_type_raises(frames):
    m, s = frames
    with pytest.raises(ValueError):
        J.join(m, s, "Zigzag", key=0)


def test_cross_needs_a_bound(frames):
    m, s = frames
    with pytest.raises(ValueError):
        J.join(m, s, "cross")
    with pytest.raises(ValueError):
        J.join(m, s, "cross", cross_max_rows=3)
    assert J.join(m, s, "cross", cross_max_rows=10).count() == 30


def test_lookup_keeps_row_count_with_min(frames):
    m, s = frames
    out = J.lookup(m, s, "Left", key=0, side_val=1, on_duplicate="min")
    rows = {r.mv: r.sv for r in out.collect()}
    assert len(rows) == 5 and rows["m-two"] == "s-two-a" and rows["m-null"] is None


def test_lookup_duplicates_raise(frames):
    m, s = frames
    with pytest.raises(Exception, match="several values"):
        J.lookup(m, s, "inner", key=0, side_val=1).collect()


def test_lookup_equal_duplicates_collapse(spark):
    m = spark.createDataFrame([("1",)], "k string")
    s = spark.createDataFrame([("1", "x"), ("1", "x")], "k string, v string")
    assert [tuple(r) for r in J.lookup(m, s, "inner", key=0, side_val=1).collect()] == [("1", "x")]


def test_lookup_exists_not_exists(frames):
    m, s = frames
    assert J.lookup(m, s, "E", key=0).count() == 4
    assert J.lookup(m, s, "N", key=0).count() == 1


def test_lookup_with_blank_matches_never_grows(spark):
    main = spark.createDataFrame([("", "m")], "k string, v string")
    side = spark.createDataFrame([("", "a"), (None, "a")], "k string, w string")
    rows = J.lookup(main, side, "left", side_val="w", key="k", blank_matches=True).collect()
    assert [tuple(r) for r in rows] == [("", "m", "a")]


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    from starweave.operators.joins import broadcast_if_small
    from starweave.session import release_scratch, scratch_mark

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    mark = scratch_mark()
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(50)] + [(None, None)], "k long, v string")
    assert hinted(broadcast_if_small(wide))
    assert not hinted(broadcast_if_small(wide, max_rows=50))
    assert not hinted(broadcast_if_small(wide, max_bytes=50_000))  # few rows, but wide ones
    assert not hinted(broadcast_if_small(wide.selectExpr("k", "array(v) as v")))
    assert hinted(broadcast_if_small(wide.limit(0)))
    over = broadcast_if_small(wide, max_rows=1)
    assert sorted(map(tuple, over.collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()  # nothing stays persisted
    assert release_scratch(spark, mark) == 6


def test_composite_left_join_query_multiplies_and_pads(spark):
    from starweave.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    out = QUERIES["join_composite_lines"](spark, sf).collect()
    lines = {}
    for r in spark.read.parquet(f"{sf}/lineitem.parquet").collect():
        lines.setdefault((r.l_orderkey, r.l_linestatus), []).append((r.l_linenumber, r.l_suppkey, r.l_quantity))
    want = []
    for r in spark.read.parquet(f"{sf}/orders.parquet").collect():
        want += [(r.o_orderkey, r.o_orderstatus, *m) for m in lines.get((r.o_orderkey, r.o_orderstatus), [(None,) * 3])]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    assert len(out) > len({r.o_orderkey for r in out}) and any(r.l_linenumber is None for r in out)
