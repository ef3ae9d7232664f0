"""What the routes leave on disk while they run: shuffles of ended steps, plain CSV, columns that no later step reads."""

import contextlib
import io
import os
import time
import uuid

from starweave.operators import joins as J
from starweave.plans import routes as RT
from starweave.plans import staging as stg
from starweave.session import shuffles_dropped
from starweave.sources import tables as TB

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[-1]


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_by(spark, write) -> set[str]:
    """Shuffle files that are there some time after ``write``."""
    before = shuffle_files(spark)
    write()
    until = time.time() + 20
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def test_shuffles_go_with_the_step_that_made_them(spark, tmp_path):
    df = spark.range(5000).selectExpr("id % 1000 as k").groupBy("k").count().repartitionByRange("k")
    with shuffles_dropped(spark):
        assert left_by(spark, lambda: df.write.parquet(f"{tmp_path}/a")) == set()
    assert spark.conf.get(SETTING, None) is None
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/a").collect()) == list(range(1000))


def test_a_setting_of_the_session_comes_back(spark):
    spark.conf.set(SETTING, "false")
    try:
        with contextlib.suppress(ZeroDivisionError), shuffles_dropped(spark):
            assert spark.conf.get(SETTING) == "true"
            1 / 0
        assert spark.conf.get(SETTING) == "false"
    finally:
        spark.conf.unset(SETTING)


def tables(spark, path):
    rows = [(1, 1, 10, 7, 100.0), (1, 1, 10, 7, 90.0), (1, 6, 10, 8, 80.0), (2, 1, 11, 7, 10.0), (2, 2, 12, 7, None)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"
    spark.createDataFrame(rows, names).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(10, 'a "b", c', 5), (11, " d|", 6), (12, "e", 8)],
                          "p_partkey long, p_name string, p_size int").write.parquet(f"{path}/part.parquet")
    others = {"orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string",
              "customer": "c_custkey long, c_nationkey int, c_mktsegment string", "nation": "n_nationkey int, n_name string"}
    for name, columns in others.items():
        spark.createDataFrame([], columns).write.parquet(f"{path}/{name}.parquet")


def test_sources_are_gzipped_and_read_the_same(spark, tmp_path):
    tables(spark, str(tmp_path))
    made = RT.export_source_csv(spark, str(tmp_path), f"{tmp_path}/csv", only=["s_judged_aspects"])["s_judged_aspects"]
    parts = [f for f in os.listdir(made) if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    want = stg.s_judged_aspects(spark, str(tmp_path))
    back = RT.read_csv_quoted(spark, made, want.schema).select(want.columns)
    strip = lambda df: sorted(str([v.lstrip() if isinstance(v, str) else v for v in r]) for r in df.collect())
    assert strip(back) == strip(want) and back.count() == 4
    lines = RT.FilesModel(spark, f"{tmp_path}/csv").parsed("s_judged_aspects")
    assert sorted(r.aspect_desc for r in lines.collect()) == sorted(["a b, c", "a b, c", "d", "e"])


MAIN = [("a", "r", "1"), ("a", "r", "1"), ("a", "r", "2"), (None, "r", "1"), (None, "r", "1"), (None, None, None),
        (None, None, None), ("z", None, "3"), ("z", None, "3")]


def sides(spark):
    main = spark.createDataFrame(MAIN * 2, "k string, r string, s string")
    side = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("b", 2, 6), (None, 3, 7)], "k string, p long, e long")
    return main, side


def test_a_lookup_of_distinct_rows_shuffles_each_side_once(spark):
    main, side = sides(spark)
    for bound in (None, 0, 100):  # not checked, not small, small
        made = J.lookup(main, side, "Left", key="k", side_val="p,e", distinct=True, seldom_equal=True, broadcast_max_rows=bound)
        want = J.lookup(main.distinct(), side, "Left", key="k", side_val="p,e")
        assert made.columns == want.columns
        assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
        assert made.count() == 5
    for how, keys in (("Inner", ["a", "a"]), ("Exists", ["a", "a"]), ("Not", ["z", None, None])):
        got = J.lookup(main, side, how, key="k", side_val="p", distinct=True)
        assert sorted(str(r.k) for r in got.collect()) == sorted(map(str, keys)) and "__dealt" not in got.columns
    made = plan(J.lookup(main, side, "Left", key="k", side_val="p,e", distinct=True, seldom_equal=True))
    assert made.count("Exchange hashpartitioning") == 2


def test_the_side_of_a_lookup_that_deals_nulls_is_shuffled_once(spark):
    main, side = sides(spark)
    made = J.lookup(main, side, "Left", key="k", side_val="p,e")
    assert plan(made).count("Exchange hashpartitioning") == 2
    assert sorted(str((r.k, r.p)) for r in made.collect()) == sorted(
        str((k, 1 if k == "a" else None)) for k, _, _ in MAIN * 2)


def test_a_repeated_key_is_still_named_alone(spark):
    main, side = sides(spark)
    two = side.selectExpr("k", "e + monotonically_increasing_id() as e")
    for seldom in (False, True):
        try:
            J.lookup(main, two, "Left", key="k", side_val="e", seldom_equal=seldom).collect()
        except Exception as x:  # noqa: BLE001
            assert 'lookup key has several values: {"k":"a"}' in str(x)
        else:
            raise AssertionError("two values of one key went unnoticed")


def files_model(spark, tmp_path):
    head = "judged_aspect_id,performance_id,aspect_type_nm,perf_aspect_seq_nbr,aspect_desc,info_flag,credit_flag,"
    line = "A1,P1,elements,1.0,x,,,2.0,,1.0,,3.0\n"
    (tmp_path / "judged-aspects.csv").write_text(
        head + "base_difficulty,factor,goe,ref,total_score\n" + line * 2 + line.replace("A1", "A2").replace("P1", "P9")
        + line.replace("A1", "A3").replace(",x,", ",,"))
    scores = "judged_aspect_id,clean_role,score\n" + "A1,J1,1.5\n" * 2 + "A1,J2,2.5\nA9,J1,1.5\nA9,J1,1.5\n" + ",J1,1.5\n" * 2
    (tmp_path / "judge-scores.csv").write_text(scores)
    (tmp_path / "judges.csv").write_text("clean_judge_nm,judge_affiliation_nm,judge_nm,role,program_event_nm,competition_nm,"
                                         "clean_role,nationality\nN,X,JUDGE A,Judge No.1,E,C,J1,X\n")
    model = RT.FilesModel(spark, str(tmp_path))
    model.performance_rows = spark.createDataFrame([("P1", 7, 5)], "performance_id string, perf_id long, event_id long")
    model.events = spark.createDataFrame([(5, "C", "E")], "event_id long, competition_nm string, program_event_nm string")
    model.person_of = spark.createDataFrame([("JUDGE A", 3)], "nm string, person_id long")
    return model


def test_aspects_go_on_with_what_later_steps_read(spark, tmp_path):
    model = files_model(spark, tmp_path)
    rows = model.aspect_rows.select("perf_aspect_id", "perf_id", "aspect_id", "judged_aspect_id", "total_score")
    assert sorted(map(tuple, rows.collect())) == [(1, None, 2, "A2", "3.0"), (2, 7, None, "A3", "3.0"), (3, 7, 2, "A1", "3.0")]
    texts = {"aspect_desc", "aspect_type_cd", "performance_id", "event_id"}
    assert texts & set(model.aspect_rows.columns) == set()
    keys = model.aspect_events
    assert {"base_difficulty", "total_score", "performance_id"} & set(keys.columns) == set()
    assert sorted(map(tuple, keys.select("perf_aspect_id", "judged_aspect_id", "event_id").collect())) == [
        (1, "A2", None), (2, "A3", 5), (3, "A1", 5)]


def test_scores_are_told_apart_where_they_meet_their_aspect(spark, tmp_path):
    got = files_model(spark, tmp_path).score_rows.select("perf_aspect_id", "judge_id", "score").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(3, 3, "1.5"), (3, None, "2.5"), (None, None, "1.5"),
                                                              (None, None, "1.5")]))


def test_loads_of_the_warehouse_write_zstd(spark):
    db = f"wh_{uuid.uuid4().hex[:6]}"
    RT.create_warehouse(spark, db)
    rows = spark.createDataFrame([(1, "E", "x")], "aspect_id long, aspect_type_cd string, aspect_desc string")
    for load in (lambda: TB.load_overwrite(rows, f"{db}.d_aspect"), lambda: TB.load_procedure(spark, f"{db}.d_aspect", rows)):
        load()
        at = TB.location_of(spark, f"{db}.d_aspect").removeprefix("file:")
        assert [f for f in os.listdir(at) if f.endswith(".zstd.parquet")]
        assert [tuple(r) for r in spark.table(f"{db}.d_aspect").collect()] == [(1, "E", "x")]
