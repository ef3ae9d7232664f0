"""CSV with newlines in quoted fields, read in splits (O2): equal to Spark's whole-file reader."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from starweave.sources import records as RC
from starweave.sources import tables as TB
from starweave.sources import text as TX

SCHEMA = StructType([StructField("id", LongType()), StructField("a", StringType()), StructField("b", StringType()),
                     StructField("x", DoubleType())])


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rng, newline):
    kind = rng.randrange(8)
    words = " ".join(rng.choice(["ab", "c", "dé", "x,y", "日本"]) for _ in range(rng.randrange(1, 5)))
    if kind == 0:
        return '5" disc'  # a quote in a plain field
    if kind == 1:
        return f'  "{words}"'  # blanks before the quote
    if kind == 2:
        return '""'
    if kind == 3:
        return f'"he said ""{words}"", then{newline}left"'
    if kind == 4:
        return '"' + newline.join(f"l{i}, ""{words}" for i in range(rng.randrange(1, 6))) + '"'
    if kind == 5:
        return '"' + ("long" + newline) * rng.randrange(1, 90) + '"'
    return words.replace(",", ";")


def write(path, seed, n, newline="\n"):
    rng = random.Random(seed)
    rows = ["id,a,b,x"] + [f"{i},{field(rng, newline)},{field(rng, newline)},{i}.5" for i in range(n)]
    path.write_bytes((newline.join(rows) + (newline if seed % 2 else "")).encode())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_equal_to_the_whole_file_reader(spark, tmp_path, small_splits, seed, newline):
    for k in range(2):
        write(tmp_path / f"f{k}.csv", seed + 10 * k, 60, newline)
    got = RC.read_csv_quoted(spark, str(tmp_path), SCHEMA)
    want = TX.read_csv(spark, str(tmp_path), SCHEMA, multiline=True)
    assert rows_of(got) == rows_of(want) and len(rows_of(got)) == 120
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_header_over_lines_blank_lines_and_no_header(spark, tmp_path, small_splits):
    (tmp_path / "h.csv").write_text('id,"a' + "\nname" * 200 + '",b,x\n\n1,"p\nq",r,1\n\n\n2,s,"t\n\nu",2\n')
    got = RC.read_csv_quoted(spark, str(tmp_path), SCHEMA)
    assert rows_of(got) == [(1, "p\nq", "r", 1.0), (2, "s", "t\n\nu", 2.0)]
    bare = tmp_path / "bare"
    bare.mkdir()
    (bare / "n.csv").write_text('1,"p\nq",r,1\n2,s,t,2')
    assert rows_of(RC.read_csv_quoted(spark, str(bare), SCHEMA, header=False)) == [(1, "p\nq", "r", 1.0), (2, "s", "t", 2.0)]


def test_one_record_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, and more" for i in range(2000))
    (tmp_path / "l.csv").write_text(f'id,a,b,x\n1,"{long}",b,1\n2,"{long}","{long}",2\n')
    assert rows_of(RC.read_csv_quoted(spark, str(tmp_path), SCHEMA)) == [(1, long, "b", 1.0), (2, long, long, 2.0)]


def test_files_without_newlines_go_the_plain_way(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,a,b,x\n1,"p, ""q""",5" disc,1\n')
    assert RC.csv_records(spark, str(tmp_path)) is None
    assert rows_of(RC.read_csv_quoted(spark, str(tmp_path), SCHEMA)) == [(1, 'p, "q"', '5" disc', 1.0)]


def test_bad_value_raises_and_empty_file_gives_no_rows(spark, tmp_path):
    (tmp_path / "b.csv").write_text('id,a,b,x\n1,"p\nq",r,abc\n')
    with pytest.raises(Exception, match="(?i)malformed|abc"):
        RC.read_csv_quoted(spark, str(tmp_path), SCHEMA).collect()
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "e.csv").write_text("id,a,b,x\n")
    assert RC.read_csv_quoted(spark, str(empty), SCHEMA).collect() == []


def test_states_after_equals_a_walk():
    rng = np.random.default_rng(0)
    for _ in range(200):
        turns = rng.integers(0, 4, rng.integers(1, 30)).astype(np.int8)
        for begin in (0, 1):
            s, want = begin, []
            for t in turns:
                s = int(t) >> s & 1
                want.append(s)
            assert RC.states_after(turns, begin).tolist() == want


def test_line_turns(spark):
    lines = {"a,b": RC.KEEP, '"a,b': RC.END_INSIDE, 'a",b': RC.END_OUTSIDE, '5" disc,b': RC.END_OUTSIDE,
             'x,"a': RC.END_INSIDE, 'a"",b': RC.KEEP, 'b","c': RC.SWAP, '"a ""b"" c"': RC.END_OUTSIDE, "": RC.KEEP}
    df = spark.createDataFrame([(k,) for k in lines], "v string").select("v", RC.line_turns(F.col("v")).alias("t"))
    got = {r.v: r.t for r in df.collect()}
    # a quote inside plain text leaves the outside state alone; a line cannot tell which begin is the true one
    assert {k: v & 1 for k, v in got.items()} == {k: v & 1 for k, v in lines.items()}
    assert got["a,b"] == RC.KEEP and got['a",b'] >> 1 == 0 and got['b","c'] >> 1 == 1 and got[""] == RC.KEEP


def test_import_takes_quoted_newlines_by_default(spark, tmp_path, small_splits):
    t = f"t_{uuid.uuid4().hex[:8]}"
    TB.create_table(spark, t, SCHEMA)
    write(tmp_path / "f.csv", 3, 80)
    TB.import_csv(spark, t, str(tmp_path))
    assert rows_of(spark.table(t)) == rows_of(TX.read_csv(spark, str(tmp_path), SCHEMA, multiline=True))
