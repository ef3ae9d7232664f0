"""What is shuffled or read once too often: headers of lines, staging of scores, texts of aspects, pulls."""

import contextlib
import io

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starweave.operators import agg as A
from starweave.plans import model as M
from starweave.plans import routes as RT
from starweave.plans import staging as stg
from starweave.sources import text as TX
from starweave.streaming import pull as PL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_header_lines_go_without_a_shuffle_of_the_lines(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("h\n" + "".join(f"{i}-{j}\n" for j in range(5)) + "h\n")
    lines = TX.read_lines(spark, str(tmp_path))
    assert sorted(r.line for r in lines.collect()) == sorted(["h"] * 3 + [f"{i}-{j}" for i in range(3) for j in range(5)])
    assert "SortMergeJoin" not in plan(lines) and "BroadcastHashJoin" in plan(lines)


def tables(spark, path):
    """Line items with equal, null and unknown keys; a part that is there twice."""
    rows = [(1, 1, 10, 7, 100.0), (1, 1, 10, 7, 90.0), (1, 1, 10, 8, 80.0), (1, 1, 10, None, None), (1, 2, 10, 7, 50.0),
            (2, 1, 11, 7, 10.0), (2, 1, 12, 7, None), (2, 1, 99, 7, 5.0), (None, 1, 10, 7, 4.0), (3, None, 10, 7, 4.0),
            (3, 1, None, 7, 4.0), (-1, -2, 10, 9, 6.0), (-1, -2, 10, 9, 6.0)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"
    spark.createDataFrame(rows, names).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(10, "a", 5), (11, "b", 6), (11, "c", 7), (12, "d", 8), (None, "e", 9)],
                          "p_partkey long, p_name string, p_size int").write.parquet(f"{path}/part.parquet")


def test_scores_from_the_line_items_are_those_of_the_aspects(spark, tmp_path):
    tables(spark, str(tmp_path))
    spark.read.parquet(f"{tmp_path}/lineitem.parquet").createOrReplaceTempView("lineitem")
    spark.read.parquet(f"{tmp_path}/part.parquet").createOrReplaceTempView("part")
    want = sorted(map(str, spark.sql(stg.with_staging("select * from s_judge_scores", "s_judge_scores")).collect()))
    made = stg.s_judge_scores(spark, str(tmp_path))
    given = stg.s_judge_scores(spark, str(tmp_path), stg.s_judged_aspects(spark, str(tmp_path)))
    assert len(want) == 8
    assert sorted(map(str, made.collect())) == want and sorted(map(str, given.collect())) == want
    final = plan(made).split("== Initial Plan ==")[-1]
    assert final.count("ReadSchema: struct<l_orderkey") == 1  # one scan, and so one shuffle, of the line items


def test_aspect_texts_stay_behind(spark):
    keys = StructType([StructField(c, LongType()) for c in ("perf_id", "event_id")])
    perf = spark.createDataFrame([(1, 5)], keys).withColumn("raw_performance_id", F.lit("P1"))
    kinds = spark.createDataFrame([(1, "E", "x"), (2, "E", "y")], "aspect_id long, aspect_type_cd string, aspect_desc string")
    aspects = spark.createDataFrame(
        [("A1", "P1", "elements", 1.0, "x", 2.0, 3.0), ("A2", "P9", "elements", 2.0, "z", 2.0, 3.0)],
        "judged_aspect_id string, performance_id string, aspect_type_nm string, perf_aspect_seq_nbr double, "
        "aspect_desc string, base_difficulty double, total_score double")
    whole = M.perf_aspect_view(aspects, perf, kinds)
    slim = M.perf_aspect_view(aspects, perf, kinds, measures=False)
    cols = ["raw_judged_aspect_id", "perf_id", "event_id", "aspect_id", "perf_aspect_id"]
    want = [("A1", 1, 5, 1, 2), ("A2", None, None, None, 1)]
    assert sorted(map(tuple, whole.select(cols).collect())) == want
    assert sorted(map(tuple, slim.select(cols).collect())) == want
    assert {"base_difficulty", "total_score"} & set(slim.columns) == set() and "total_score" in whole.columns


def test_a_pull_decodes_no_more_of_a_row_group_than_it_needs(tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    path = str(tmp_path / "a.parquet")
    pq.write_table(pa.table({"value": pa.array([str(i) for i in range(400_000)])}), path)
    decoded = []

    class Counted(pq.ParquetFile):
        def iter_batches(self, *a, **k):
            for b in super().iter_batches(*a, **k):
                decoded.append(b.num_rows)
                yield b

    monkeypatch.setattr(PL.pq, "ParquetFile", Counted)
    target = pa.schema([("value", pa.string())])
    got = [v for b in PL._parquet_rows(fs.LocalFileSystem(), PL._Rows(path, 500, 1500), target) for v in b.column(0).to_pylist()]
    assert got == [str(i) for i in range(500, 1500)] and sum(decoded) < 400_000


def test_rows_that_seldom_repeat_are_compared_behind_their_shuffle(spark):
    rows = [("a", 1, None), ("a", 1, None), (None, None, None), (None, None, None), ("b", 1, 2.0), ("b", None, 2.0)]
    df = spark.createDataFrame(rows * 3, "x string, y int, z double").repartition(5)
    made = A.distinct_rows(df, seldom_equal=True)
    assert sorted(map(str, made.collect())) == sorted(map(str, A.distinct_rows(df).collect()))
    assert made.count() == 4
    initial = plan(made).split("== Initial Plan ==")[-1]
    # read from the bottom: the shuffle comes before the first hash map
    assert initial.rindex("Exchange hashpartitioning(x") > initial.rindex("HashAggregate")


def test_judged_aspects_of_the_files_are_shuffled_before_they_are_compared(spark, tmp_path):
    head = "judged_aspect_id,performance_id,aspect_type_nm,perf_aspect_seq_nbr,aspect_desc,info_flag,credit_flag,"
    line = "A1,P1,elements,1.0,x,,,2.0,,1.0,,3.0\n"
    (tmp_path / "judged-aspects.csv").write_text(
        head + "base_difficulty,factor,goe,ref,total_score\n" + line * 3 + line.replace("A1", "A2") + line.replace("A1", ""))
    model = RT.FilesModel(spark, str(tmp_path))
    made = model.judged_aspects
    assert sorted(str(r.judged_aspect_id) for r in made.collect()) == ["A1", "A2", "None"]
    initial = plan(made).split("== Initial Plan ==")[-1]
    assert initial.rindex("Exchange hashpartitioning(") > initial.rindex("HashAggregate")
    # the kinds are few and told apart before their shuffle
    assert [tuple(r) for r in model.aspects.select("aspect_id", "aspect_type_cd", "aspect_desc").collect()] == [(1, "E", "x")]
