"""The corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark passages go, sources
are mixed to their target weights, the rest is cut into shards.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet and rereads it as the next
stage's input. All but the last return the columns of their input. Stages that drop rows know them by a 64-bit hash of
doc_id and text, so a null or repeated doc_id makes no difference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from starweave.llm.common import checked_broadcast
from starweave.session import materialize, read_table

#: Ids that a stage drops or keeps are narrow; up to this many are broadcast.
MAX_IDS = 1_000_000


def _row():
    """Rows with one value are equal in doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with ``_row`` in place of the id."""
    return docs.select(_row().alias("doc_id"), F.col("text").cast("string").alias("text"))


def _only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose ``_row`` is (left_semi) or is not (left_anti) among ``ids`` (doc_id)."""
    ids = materialize(ids.select(F.col("doc_id").alias("_row")).distinct(), "ids")
    return docs.withColumn("_row", _row()).join(checked_broadcast(ids, MAX_IDS), "_row", how).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = toxicity.scores(_keyed(docs), toxicity.fit(narrow, read_table(spark, sf_dir, "labels")))
    return _only(docs, scored.filter("predicted = 1"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group stays (one without an id only if all are); of rows with one
    doc_id and text, one stays, unless they have neither id nor words."""
    group = materialize(jaccard_join.near_duplicates(_keyed(docs)), "groups").groupBy("component_id", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("n_shingles"))
    real = docs.select(_row().alias("doc_id"), F.col("doc_id").cast("long").alias("id")).distinct()
    named = materialize(group.join(real, "doc_id"), "named")
    best = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "doc_id")).alias("best"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    best = materialize(best.select("component_id", F.col("best.doc_id").alias("best")), "best")
    kept = _only(docs, named.join(checked_broadcast(best, MAX_IDS), "component_id").filter("doc_id <> best"), "left_anti")
    again = materialize(named.filter("n > 1 and (id is not null or n_shingles > 0)").select("doc_id"), "again")
    once = _only(kept, again, "left_semi").withColumn("_row", _row()).dropDuplicates(["_row"]).drop("_row")
    return _only(kept, again, "left_anti").union(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hits = decontaminate.contaminated(_keyed(docs), read_table(spark, sf_dir, "benchmark"))
    return _only(docs, hits, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: an epoch that takes at least half of its words counts, so only the
    document where a source's target falls is rounded. Documents without words carry nothing to mix and stay once. Rows
    are known by a number of their own, so null and repeated ids make no difference."""
    rows = materialize(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix_rows")
    taken = mixing.taken_rows(rows, row="_mix_row")
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))))
    copies = materialize(taken.select(F.col("row_id").alias("_mix_row"), times.cast("int").alias("_mix_copies")).filter(
        "_mix_copies > 0"), "copies")
    joined = rows.join(checked_broadcast(copies, MAX_IDS), "_mix_row")
    return joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    more = [c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    return sharding.shard_by_bytes(docs, keep=more)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The classifier is no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
