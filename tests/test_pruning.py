"""Scans read only the columns a query needs, and filters on stored columns
reach the parquet reader."""

import contextlib
import io
import re

from __spark_entry__ import queries

SMALL = "/root/testdata/sf0.001"
Q = queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>\n]*>?)", text)


def test_anti_join_reads_only_the_key_of_the_side(spark):
    schemas = read_schemas(plan(Q["join_not_exists"](spark, SMALL)))
    assert "struct<l_orderkey:bigint>" in schemas


def test_lookup_reads_only_key_and_value(spark):
    schemas = read_schemas(plan(Q["lookup_left"](spark, SMALL)))
    assert "struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in schemas
    assert "struct<o_orderkey:bigint,o_orderstatus:string>" in schemas


def test_count_by_reads_two_columns(spark):
    assert read_schemas(plan(Q["count_by"](spark, SMALL))) == ["struct<o_orderstatus:string,o_orderpriority:string>"]


def test_like_filter_on_a_staging_table_reaches_the_scan(spark, tmp_path):
    from starweave.operators import project as P
    from starweave.plans import staging as stg

    path = str(tmp_path / "s_performances")
    stg.s_performances(spark, SMALL).write.parquet(path)
    table = spark.read.parquet(path)
    ladies = P.like_filter(table, "program_event_nm", "%Ladies%")
    assert "StringContains(program_event_nm,Ladies)" in plan(ladies)
    starts = P.like_filter(table, "competition_nm", "Season 19%")
    assert "StringStartsWith(competition_nm,Season 19)" in plan(starts)
    assert ladies.count() == stg.s_performances(spark, SMALL).filter("program_event_nm like '%Ladies%'").count()
