"""Property tests: many generated values per Spark job, checked against a
plain-Python statement of each rule."""

import csv
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starweave.functions import scalars as S
from starweave.operators import reshape as R
from starweave.sources import text as TX

TEXT = st.text(alphabet="abcAB '-xyz/", max_size=20)
SETTINGS = settings(max_examples=10, deadline=None)


def column_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def py_translate_chain(x, repl, find, pad=" "):
    repl = repl[: len(find)]
    for a, b in zip(find, list(repl) + [pad] * (len(find) - len(repl))):
        x = x.replace(a, b)
    return x


def py_initcap(s):
    words = re.findall(r" +|-+|'+|.[^ '-]*", s)
    return "".join(w[:1].upper() + w[1:].lower() for w in words)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30), st.text(alphabet="abxy", max_size=3),
       st.text(alphabet="abxy", min_size=1, max_size=3))
def test_translate_chain(spark, values, repl, find):
    df = column_of(spark, values)
    got = [r[0] for r in df.orderBy("i").select(S.translate_chain("s", repl, find)).collect()]
    assert got == [py_translate_chain(v, repl, find) for v in values]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_initcap_words(spark, values):
    df = column_of(spark, values)
    got = [r[0] for r in df.orderBy("i").select(S.initcap_words("s")).collect()]
    assert got == [py_initcap(v) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="abcAB '-1/é", max_size=15), min_size=1, max_size=30))
def test_title_case_is_python_title(spark, values):
    df = column_of(spark, values)
    got = [r[0] for r in df.orderBy("i").select(S.title_case("s")).collect()]
    assert got == [v.title() for v in values]


FIELD = st.text(alphabet='ab ,"|', max_size=6)


def csv_line(fields):
    out = []
    for f in fields:
        if any(c in f for c in ',"') or f.startswith(" "):
            out.append('"' + f.replace('"', '""') + '"')
        else:
            out.append(f)
    return ",".join(out)


def py_switch(line, old, new):
    rec = next(csv.reader([line.replace(new, "")], delimiter=old, quotechar='"', skipinitialspace=True))
    return new.join(rec).replace('"', "")


@SETTINGS
@given(st.lists(st.lists(FIELD, min_size=1, max_size=4), min_size=1, max_size=20))
def test_switch_delimiters_matches_csv_module(spark, records):
    lines = [csv_line(r) for r in records]
    df = column_of(spark, lines)
    got = [r[0] for r in df.orderBy("i").select(TX.switch_delimiters(F.col("s"), ",", "|")).collect()]
    assert got == [py_switch(v, ",", "|") for v in lines]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["", "a", None]), st.sampled_from(["", "b", None]),
                          st.sampled_from(["", "c", None]), st.sampled_from(["", "d", None])),
                min_size=1, max_size=20))
def test_normalise_counts(spark, rows):
    df = spark.createDataFrame([(i,) + r for i, r in enumerate(rows)], "k int, a string, b string, c string, d string")
    assert R.normalise(df, 2, 1, 2, 3, 4).count() == 2 * len(rows)
    blank = lambda *v: all(x in ("", None) for x in v)
    kept = sum((not blank(a, b)) + (not blank(c, d)) for a, b, c, d in rows)
    assert R.normalise(df, 2, 1, 2, 3, 4, blanks="n").count() == kept


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.text(alphabet="ab", max_size=2)),
                min_size=1, max_size=40),
       st.integers(1, 5), st.integers(-5, 5), st.integers(1, 3))
def test_dense_key_matches_sorted_numbering(spark, rows, parts, start, interval):
    from starweave.operators import keys as K

    data = [(a, b, i) for i, (a, b) in enumerate(rows)]  # i: the natural key that makes the order total
    df = spark.createDataFrame(data, "a int, b string, i int")
    got = {r.i: r.id for r in K.dense_key(df, ["a", "b", "i"], "id", start=start, interval=interval,
                                          partitions=parts).collect()}
    nulls_first = sorted(data, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    want = {t[2]: start + n * interval for n, t in enumerate(nulls_first)}
    assert got == want
