"""Contiguous byte-balanced shards from global prefix sums.

Rows are laid out in one global order: the CRC-32 of the text, its size, a hash of doc_id, doc_id. So equal texts are
neighbours and the order has nothing to do with how the input was written. The order is a range partitioning (sampled
bounds; a hot text is split by the later keys), sorted inside each partition and written once to the shared folder
with its partition number. Totals per partition give every partition its offset; a running sum inside each partition
does the rest. Shards are cut at equal byte targets: a cut that falls inside a group of equal texts moves to the
nearer end of the group if that moves at most ``tolerance`` of a shard's bytes, so such groups stay whole, and else to
the nearer end of the row it falls in. Sizes then differ by at most twice that and a row.

Defined cases: a null or empty text has size ``overhead`` and CRC-32 0; equal rows are rows of their own with slots of
their own; a null doc_id sorts first; an empty table gives no rows; with fewer rows than shards some shards are
empty. Other columns are carried along by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize

SHARDS = 24
OVERHEAD = 8
TOLERANCE = 0.02


def _cuts(placed: DataFrame, total: int, shards: int, tolerance: float) -> list[int]:
    """The ``shards - 1`` byte positions where a shard ends."""
    targets = [total * k // shards for k in range(1, shards)]
    spark = placed.sparkSession
    want = F.broadcast(spark.createDataFrame([(t,) for t in targets], "target long"))  # shards - 1 rows
    at = placed.join(want, F.expr("target > begin and target < begin + size"))
    inside = at.select("target", "text_crc32", "size", "begin").collect()  # at most one row a target
    if not inside:
        return targets
    keys = F.broadcast(spark.createDataFrame(sorted({(r.text_crc32, r.size) for r in inside}), "c long, z long"))
    group = {(r.c, r.z): (r.lo, r.hi) for r in placed.join(keys, F.expr("text_crc32 = c and size = z")).groupBy("c", "z").agg(
        F.min("begin").alias("lo"), F.max(F.col("begin") + F.col("size")).alias("hi")).collect()}
    moved = {}
    for r in inside:
        lo, hi = group[(r.text_crc32, r.size)]
        end = lo if r.target - lo <= hi - r.target else hi
        if abs(end - r.target) > tolerance * total / shards:
            lo, hi = r.begin, r.begin + r.size
            end = lo if r.target - lo <= hi - r.target else hi
        moved[r.target] = end
    return sorted(moved.get(t, t) for t in targets)


def shard_by_bytes(docs: DataFrame, *, shards: int = SHARDS, overhead: int = OVERHEAD, tolerance: float = TOLERANCE,
                   keep: list[str] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) and the columns ``keep`` for every row of ``docs``
    (doc_id, text). See the module text."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    # under names of their own: the frame may have any others
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + overhead).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), *(F.col(c).alias(f"kept_{c}") for c in keep or []))
    order = ["text_crc32", "size", F.xxhash64("doc_id"), "doc_id"]
    laid = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()}), "shards")
    narrow = laid.select("doc_id", "size", "text_crc32", "part", "pos")

    totals = narrow.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    offsets, total, rank = [], 0, 0
    for r in totals:  # one row a partition
        offsets.append((r.part, total, rank))
        total, rank = total + r.bytes, rank + r.n
    offsets = F.broadcast(docs.sparkSession.createDataFrame(offsets, "part int, byte0 long, rank0 long"))
    w = Window.partitionBy("part").orderBy("pos")
    placed = narrow.join(offsets, "part").select(
        "doc_id", "size", "text_crc32", "pos",
        (F.col("byte0") + F.sum("size").over(w) - F.col("size")).alias("begin"),
        (F.col("rank0") + F.row_number().over(w) - 1).alias("rank"))
    placed = materialize(placed, "placed")
    shard = F.lit(0)
    for c in _cuts(placed, total, shards, tolerance):
        shard = shard + F.when(F.col("begin") >= c, 1).otherwise(0)
    dealt = placed.withColumn("shard", shard.cast("int"))
    first = F.broadcast(dealt.groupBy("shard").agg(F.min("rank").alias("rank1")))  # a row a shard
    out = dealt.join(first, "shard")
    cols = [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.lit("bytes").alias("law"), F.col("shard"),
            (F.col("rank") - F.col("rank1")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")]
    if not keep:
        return out.select(*cols)
    return out.join(laid.select("pos", *(f"kept_{c}" for c in keep)), "pos").select(
        *cols, *(F.col(f"kept_{c}").alias(c) for c in keep))
