"""Schema checks and table loads (O3, O8-O12, X2; FIXTURES §4.4)."""

import uuid

import pytest
from pyspark.sql import functions as F

from starweave.plans import staging as stg
from starweave.sources import objects as OB
from starweave.sources import schemas as SC
from starweave.sources import tables as TB

SMALL = "/root/testdata/sf0.001"


def _name():
    return f"t_{uuid.uuid4().hex[:8]}"


@pytest.mark.parametrize("table", ["s_performances", "s_judges", "s_judged_aspects", "s_judge_scores"])
def test_null_in_required_column_is_named(spark, table):
    src = stg.staging(spark, SMALL)[table].limit(5)
    col = SC.required_columns(table)[-1]
    bad = src.withColumn(col, F.when(F.lit(True), F.lit(None)).cast(dict(src.dtypes)[col]))
    with pytest.raises(Exception, match=f"NULL in required column {table}.{col}"):
        SC.conform(bad, table).collect()
    # the check still runs when the column is not selected afterwards
    with pytest.raises(Exception, match="NULL in required column"):
        SC.conform(bad, table).select(SC.SPECS[table][0][0]).collect()


def test_conform_passes_clean_rows(spark):
    src = stg.s_judged_aspects(spark, SMALL)
    assert SC.conform(src, "s_judged_aspects").count() == src.count()


def test_load_modes(spark):
    t = _name()
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"])
    rows = spark.createDataFrame([(1, "E", "a"), (2, "C", "b")], "aspect_id long, aspect_type_cd string, d string")
    TB.load_if_empty(rows, t)
    with pytest.raises(TB.LoadError):
        TB.load_if_empty(rows, t)  # not empty any more
    TB.load_overwrite(rows.limit(1), t)
    assert spark.table(t).count() == 1  # truncate then insert
    TB.truncate(spark, t)
    assert spark.table(t).count() == 0
    TB.load_procedure(spark, t, rows)
    assert sorted(r[0] for r in spark.table(t).collect()) == [1, 2]


def test_load_into_missing_table_raises(spark):
    rows = spark.createDataFrame([(1,)], "x long")
    with pytest.raises(TB.LoadError):
        TB.load_overwrite(rows, "no_such_table_here")


def test_sql_function(spark):
    TB.replace_function(spark, "initcap_words")
    assert spark.sql("select initcap_words(\"o'brien-SMITH\") as x").first()[0] == "O'Brien-Smith"


def test_import_csv_checks_required_columns(spark, tmp_path):
    db = f"db_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db}")
    TB.create_table(spark, f"{db}.s_judge_scores", SC.SCHEMAS["s_judge_scores"])
    good = tmp_path / "good.csv"
    good.write_text('judged_aspect_id,clean_role,score\nA1,J1,1.5\n"A\n2",J2,2\n')
    TB.import_csv(spark, f"{db}.s_judge_scores", str(good))
    TB.import_csv(spark, f"{db}.s_judge_scores", str(good))  # replaces, does not append
    assert sorted(r[0] for r in spark.table(f"{db}.s_judge_scores").collect()) == ["A\n2", "A1"]
    bad = tmp_path / "bad.csv"
    bad.write_text("judged_aspect_id,clean_role,score\nA1,,1.5\n")
    with pytest.raises(Exception, match="NULL in required column s_judge_scores.clean_role"):
        TB.import_csv(spark, f"{db}.s_judge_scores", str(bad))


def test_import_csv_split_mode(spark, tmp_path):
    db = f"db_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db}")
    TB.create_table(spark, f"{db}.s_judge_scores", SC.SCHEMAS["s_judge_scores"])
    src = tmp_path / "scores.csv"
    src.write_text("judged_aspect_id,clean_role,score\n" + "".join(f"A{i},J{i % 3},{i}.5\n" for i in range(1000)))
    TB.import_csv(spark, f"{db}.s_judge_scores", str(src), quoted_newlines=False)
    assert spark.table(f"{db}.s_judge_scores").count() == 1000


@pytest.mark.parametrize("load", [TB.load_overwrite, TB.load_if_empty, lambda df, t: TB.load_procedure(df.sparkSession, t, df)])
def test_every_load_refuses_null_in_a_required_column(spark, load):
    t = _name()
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"])
    bad = spark.createDataFrame([(None, "E", "a")], "x long, y string, z string")
    with pytest.raises(Exception, match="NULL in required column .*aspect_id"):
        load(bad, t)
    assert spark.table(t).count() == 0


def test_a_procedure_that_fails_leaves_the_old_rows(spark):
    t = _name()
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"])
    rows = spark.createDataFrame([(1, "E", "a"), (2, "C", "b")], "aspect_id long, aspect_type_cd string, d string")
    TB.load_procedure(spark, t, rows)
    first = TB.location_of(spark, t)
    dying = spark.range(1000).repartition(8).select(
        "id", F.when(F.col("id") == 999, F.raise_error(F.lit("half-way"))).otherwise(F.lit("E")).alias("cd"), F.lit("x").alias("d"))
    with pytest.raises(Exception, match="half-way"):
        TB.load_procedure(spark, t, dying)
    assert sorted(r[0] for r in spark.table(t).collect()) == [1, 2] and TB.location_of(spark, t) == first
    assert not [r for r in spark.sql("SHOW TABLES").collect() if "__load_" in r.tableName]


def test_a_procedure_switches_the_location_and_may_read_its_own_table(spark):
    t = _name()
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"])
    TB.load_procedure(spark, t, spark.createDataFrame([(1, "E", "a")], "i long, c string, d string"))
    first = TB.location_of(spark, t)
    TB.load_procedure(spark, t, spark.table(t).select(F.col("aspect_id") + 1, "aspect_type_cd", "aspect_desc"), keep_old=True)
    assert [r[0] for r in spark.table(t).collect()] == [2] and TB.location_of(spark, t) != first
    assert spark.read.parquet(first).count() == 1  # kept for readers that are still at it
    TB.load_overwrite(spark.createDataFrame([(5, "E", "a")], "i long, c string, d string"), t)  # other loads go on
    assert [r[0] for r in spark.table(t).collect()] == [5]
    spark.sql(f"DROP TABLE {t}")


# ------------------------------------------------------------- objects
def _schema(ddl):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def test_equal_definition_is_kept_a_changed_one_replaced(spark):
    t = _name()
    a = _schema("id bigint NOT NULL, v string")
    assert OB.define_table(spark, t, a) == "created"
    TB.load_overwrite(spark.createDataFrame([(1, "x")], "id long, v string"), t)
    assert OB.define_table(spark, t, a) == "kept" and spark.table(t).count() == 1
    assert TB.required_of(spark, t) == ["id"]
    # added columns and properties alter it in place: the rows stay
    assert OB.define_table(spark, t, _schema("id bigint NOT NULL, v string, w double"), {"team": "x"}) == "altered"
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, "x", None)]
    assert TB.properties_of(spark, t)["team"] == "x"
    assert OB.define_table(spark, t, _schema("id bigint NOT NULL, v string, w double")) == "altered"
    assert "team" not in TB.properties_of(spark, t)
    # another shape: a new, empty table under the same name
    assert OB.define_table(spark, t, _schema("v string, id bigint")) == "replaced"
    assert spark.table(t).columns == ["v", "id"] and spark.table(t).count() == 0
    assert not spark.catalog.tableExists(f"{t}__aside") and not spark.catalog.tableExists(f"{t}__next")


def test_replacing_completes_after_a_run_that_ended_between_the_renames(spark):
    t = _name()
    a = _schema("id bigint, v string")
    OB.define_table(spark, t, a)
    TB.load_overwrite(spark.createDataFrame([(1, "x")], "id long, v string"), t)
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__aside")
    assert OB.define_table(spark, t, a) == "kept" and spark.table(t).count() == 1


def test_views_and_functions_of_the_catalog(spark):
    v, f = _name(), f"default.{_name()}"
    assert OB.define_view(spark, v, "select 1 as a") == "created" and OB.define_view(spark, v, "select 1 as a") == "kept"
    assert OB.define_view(spark, v, "select 2 as a") == "replaced" and spark.table(v).first()[0] == 2
    args = (spark, f, [("str", "STRING")], "STRING")
    assert OB.define_function(*args, "upper(str)") == "created" and OB.define_function(*args, "upper(str)") == "kept"
    assert OB.define_function(*args, "lower(str)") == "replaced"
    # another session of the same catalog finds it
    assert spark.newSession().sql(f"select {f}('Ab')").first()[0] == "ab"
