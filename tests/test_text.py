"""Delimited text in and out (FIXTURES §4.3)."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from starweave.sources import text as TX
from starweave.sources.schemas import SCHEMAS


def test_switch_delimiters_dirty_lines(spark):
    lines = ['1, "Smith, ""J""",3', "2,,", '3,"a|b","x"', "4,  pad ,\\q"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(TX.switch_delimiters(F.col("line"), ",", "|")).collect()]
    assert got == ["1|Smith, J|3", "2||", "3|ab|x", "4|pad |\\q"]


def test_rec_to_text_keeps_positions_of_nulls(spark):
    df = spark.createDataFrame([(1, None, "c"), (None, "b", None)], "a int, b string, c string")
    got = [r[0] for r in df.select(TX.rec_to_text([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == ["1||c", "|b|"]


def test_rec_fields_by_position(spark):
    df = spark.createDataFrame([("a|b",), ("a||c|d",)], "line string")
    with pytest.raises(Exception, match="more than 3 fields"):
        TX.rec_fields(df, "line", "|", ["x", "y", "z"]).select("x").collect()
    rows = TX.rec_fields(df, "line", "|", ["x", "y", "z"], extra="drop").collect()
    assert [tuple(r) for r in rows] == [("a", "b", None), ("a", None, "c")]


def test_read_lines_skips_each_header(spark, tmp_dir):
    for i in range(2):
        with open(os.path.join(tmp_dir, f"f{i}.csv"), "w") as f:
            f.write("h1,h2\n" + f"{i},x\n" + f"{i},y\n")
    got = sorted(r[0] for r in TX.read_lines(spark, tmp_dir).collect())
    assert got == ["0,x", "0,y", "1,x", "1,y"]


def test_read_csv_quoted_newline_and_types(spark, tmp_dir):
    p = os.path.join(tmp_dir, "judge_scores.csv")
    with open(p, "w") as f:
        f.write('judged_aspect_id,clean_role,score\n"A1\nB",J1,1.5\nA2, "J,2",2\n')
    rows = TX.read_csv(spark, p, SCHEMAS["s_judge_scores"], multiline=True).collect()
    assert [tuple(r) for r in rows] == [("A1\nB", "J1", 1.5), ("A2", "J,2", 2.0)]


def test_write_then_read_text(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", None), (2, None, "c")], "id long, x string, y string")
    out = os.path.join(tmp_dir, "t")
    TX.write_text(df, out)
    back = TX.read_text_table(spark, out, ["id", "x", "y"]).orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", "a", None), ("2", None, "c")]


def test_write_text_single_file(spark, tmp_dir):
    df = spark.range(0, 50, numPartitions=5).select(F.col("id"), (F.col("id") % 3).cast("string").alias("m"))
    out = os.path.join(tmp_dir, "one")
    TX.write_text(df, out, single_file=True)
    assert os.path.isfile(out) and spark.read.text(out).count() == 50


def test_read_csv_fails_fast_on_a_bad_type(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad_scores.csv")
    with open(p, "w") as f:
        f.write("judged_aspect_id,clean_role,score\nA1,J1,not-a-number\n")
    import pytest

    with pytest.raises(Exception):
        TX.read_csv(spark, p, SCHEMAS["s_judge_scores"]).collect()


def test_switch_delimiters_follows_csv_rules(spark):
    lines = ['a,5" disc,b', '"a,b"c"d,e",f', '"",x', '"a""b,c",d', 'a, "b', '"a" ,b', ' "x,y",z', "'a,b"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(TX.switch_delimiters(F.col("line"), ",", "|")).collect()]
    want = ["|".join(next(csv.reader([x], skipinitialspace=True))).replace('"', "") for x in lines]
    assert got == want


def test_switch_delimiters_with_very_many_quotes(spark):
    line = ",".join(['"q,"'] * 50_000)
    df = spark.createDataFrame([(line,)], "line string")
    got = df.select(TX.switch_delimiters(F.col("line"), ",", "|")).first()[0]
    assert got == "|".join(["q,"] * 50_000)


def test_read_lines_keeps_every_line(spark, tmp_dir):
    lines = ["a", "", "   ", "b\x01\x02\x03c", "d"]
    with open(os.path.join(tmp_dir, "f.txt"), "w") as f:
        f.write("\n".join(["head", *lines]) + "\n")
    assert [r[0] for r in TX.read_lines(spark, tmp_dir).collect()] == lines


def test_write_csv_keeps_blanks(spark, tmp_dir):
    out = os.path.join(tmp_dir, "c")
    TX.write_csv(spark.createDataFrame([(" lead", "trail ")], "a string, b string").coalesce(1), out)
    assert " lead,trail " in [r[0] for r in spark.read.text(out).collect()]
