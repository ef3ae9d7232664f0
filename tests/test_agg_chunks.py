"""STRING_AGG of groups of any size, as chunks."""

import random

import pytest
from pyspark.sql import functions as F

from starweave.operators import agg as A


def whole(rows):
    """group → the aggregate put together, with the places checked."""
    out = {}
    for g in {r.g for r in rows}:
        mine = sorted((r for r in rows if r.g == g), key=lambda r: r.chunk)
        assert [r.chunk for r in mine] == list(range(len(mine)))
        text = ""
        for r in mine:
            assert r.begin == len(text)
            text += r.text
        out[g] = text
    return out


@pytest.mark.parametrize("sep", ["", ", "])
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_put_together_are_the_aggregate(spark, sep, size):
    rng = random.Random(size)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randrange(50), rng.choice([None, "é", "xy", ""]), i) for i in range(400)]
    rows += [("none", 1, None, 1000 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, chunk int, text string, i int").repartition(5)
    got = A.string_agg_chunks(df, ["g"], "text", ["chunk", "i"], sep, rows=size)
    want = {}
    for g, k, v, i in sorted(rows, key=lambda r: (r[1], r[3])):
        if v is not None:
            want.setdefault(g, []).append(v)
    assert whole(got.collect()) == {g: sep.join(v) for g, v in want.items()}


def test_a_hot_group_is_dealt_over_the_tasks(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 1000).otherwise(-1).alias("g"), "id",
                                    F.col("id").cast("string").alias("v"))
    got = A.string_agg_chunks(df, ["g"], "v", ["id"], ",", rows=500)
    n = got.groupBy("g").agg(F.count(F.lit(1)).alias("chunks"), F.max(F.size(F.split("text", ","))).alias("most"))
    hot = n.filter("g = -1").first()
    assert hot.chunks >= 40 and n.agg(F.max("most")).first()[0] <= 501
    assert got.filter("g = -1").agg(F.sum(F.length("text"))).first()[0] == sum(len(str(i)) + 1 for i in range(0, 60_000, 3)) - 1
