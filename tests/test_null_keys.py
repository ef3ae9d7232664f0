"""Main rows without a key are kept by left and anti joins and dealt over the tasks."""

import pytest
from pyspark.sql import functions as F

from starweave.operators import joins as J
from starweave.plans import model as M


@pytest.fixture()
def shuffled(spark):
    """Joins by shuffle, every partition as it is."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def fullest(df) -> int:
    return max(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())


def frames(spark):
    main = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("k"))
    side = spark.range(0, 4000, 8).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    return main, side


def test_left_joins_deal_rows_without_key(shuffled):
    main, side = frames(shuffled)
    for out in (J.lookup(main, side, "Left", key="k", side_val="v"), J.join(main, side, "Left", key="k")):
        rows = {r["id"]: r["v"] for r in out.collect()}
        assert rows == {i: i * 2 if i % 8 == 0 else None for i in range(4000)}
        assert fullest(out) < 2000  # 3000 rows have no key
    two = J.lookup(main.withColumn("n", F.lit(1)), side.withColumn("n", F.lit(1)), "Left", key="k,n", side_val="v")
    assert two.filter("v is not null").count() == 500 and fullest(two) < 2000


def test_anti_join_deals_rows_without_key(shuffled):
    main, side = frames(shuffled)
    out = J.join(main, side, "NotExists", key="k")
    assert {r["id"] for r in out.collect()} == {i for i in range(4000) if i % 8} and fullest(out) < 2000
    assert J.join(main, side.withColumn("k", F.lit(None).cast("string")), "NotExists", key="k").count() == 4000


def test_single_skaters_are_dealt(shuffled, monkeypatch):
    monkeypatch.setattr(M, "broadcast_if_small", lambda df: df)
    seen = []
    monkeypatch.setattr(M, "dense_key", lambda df, order, name: seen.append(df) or df)
    one = F.concat(F.lit("A "), F.col("id").cast("string"))
    perfs = shuffled.range(4000).select(
        F.lit("c").alias("competition_nm"), F.lit("e").alias("program_event_nm"), "id", one.alias("one")).select(
        "*", F.when(F.col("id") % 10 == 0, F.concat("one", F.lit(" / B"))).otherwise(F.col("one")).alias("skater_nm"),
        F.col("id").alias("event_perf_seq_nbr"), F.col("id").alias("event_perf_rank_nbr"),
        *[F.lit(1.0).alias(c) for c in ("component_score", "element_score", "deductions")], F.col("id").alias("performance_id"))
    events = shuffled.range(1).select(F.lit(1).alias("event_id"), F.lit("c").alias("competition_nm"), F.lit("e").alias("raw_event_nm"))
    people = perfs.select(F.col("id").alias("person_id"), F.col("one").alias("raw_nm")).union(
        shuffled.range(1).select(F.lit(-1).cast("long"), F.lit("B")))
    out = M.perf_view(perfs, events, people)
    rows = {r["raw_performance_id"]: (r["skater1_id"], r["skater2_id"]) for r in out.collect()}
    assert rows == {i: (i, None if i % 10 else -1) for i in range(4000)} and fullest(seen[-1]) < 2000
