"""Mix sources to target weights by a low-discrepancy schedule.

1. Targets. Sources in code point order (null last) weigh 5, 2, 1, 5, ... and share the words of all documents. A
   target stops at ``max_epochs`` times its source's words; the excess goes to the others by weight, which is
   water-filling: in order of cap/weight a source is capped if its cap is below its share of what is left.
2. Streams. Each source's documents are shuffled (order of an MD5 of doc_id, or of the text where the id is null; then
   doc_id and a hash of the text, so only equal rows tie) and laid end to end, repeated
   ``max_epochs`` times, and cut into blocks of ``block`` words. Running sums are taken in buckets, ranges of the
   shuffled order of about ``BUCKET_ROWS`` rows, and offset by the totals of the buckets before, so a source with a
   third of all rows is many tasks.
3. Schedule. Slot i of the mix has the point frac(i * golden ratio); the point falls on a source by cumulative target
   shares. The r-th slot of a source takes its block r. The ranks come from counts per chunk of slots and their
   running sums. Blocks that the sequence left over at the end of the schedule (a few per source) follow after it,
   and the last block of a source stops at its target, so a source gives its target to the word.
4. Join. The pieces of documents inside the scheduled blocks are joined to the slots on (source, block).

Numbers are exact at any size: the point of a slot is made from 16-bit halves, so no product leaves 64 bits.

Defined cases: null and empty texts have no words and are never taken; null sources are one source; a table without
words has targets 0; rows with equal or null ids are rows of their own; rows equal in id, source and text get pieces of
their own, which of them gets which makes no difference; texts are counted whole, whatever their length; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import WORD_PATTERN, checked_broadcast

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK = 1024
BUCKET_ROWS = 50_000
CHUNK = 4096
#: Equal parts of the shares by which slots find their source.
CELLS = 4096


def sizes(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, shuffle, digest): words of the whole text, the key of the shuffled order and a hash of the
    text; and row_id, if ``row`` names a column that tells rows apart."""
    text = F.col("text").cast("string")
    known = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.concat(F.lit("no id "), F.md5(F.coalesce(text, F.lit("")))))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long").alias("size"),
        F.md5(F.concat(known, F.lit(":mix")).cast("binary")).alias("shuffle"), F.xxhash64(text).alias("digest"),
        *([F.col(row).cast("long").alias("row_id")] if row else []))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, number, docs, source_size, target), a row a source. The windows run over one row a source."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ordered = by.withColumn("number", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    level = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    all_ = Window.partitionBy()
    filled = ordered.withColumns({"weight": weight, "cap": F.col("source_size") * max_epochs}).withColumns({
        "total": F.sum("source_size").over(all_),
        "caps": F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "left": F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing))})
    capped = filled.withColumn("capped", F.expr("cap * left < weight * (total - caps)"))
    rest = capped.withColumns({
        "spare": F.col("total") - F.coalesce(F.sum(F.expr("case when capped then cap end")).over(all_), F.lit(0)),
        "open": F.sum(F.expr("case when not capped then weight end")).over(all_)})
    return rest.select("source", "number", "docs", "source_size", F.expr(
        "case when capped then cast(cap as double) else coalesce(cast(spare * weight as double) / open, 0.0) end").alias("target"))


def streams(sized: DataFrame, by_source: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``sized`` with the place ``begin`` of every document in its source's shuffled stream."""
    slim = checked_broadcast(by_source.select(
        F.col("source").alias("s"), "number", "source_size", "target",
        F.ceil(F.col("docs") / bucket_rows).cast("long").alias("buckets")))
    at = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long")
    dealt = sized.join(slim, F.expr("source <=> s")).drop("s").withColumn(
        "bucket", F.shiftright(at * F.col("buckets"), 32))
    totals = dealt.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    before = totals.select("number", "bucket", (F.sum("words").over(
        Window.partitionBy("number").orderBy("bucket")) - F.col("words")).alias("words0"))
    w = Window.partitionBy("number", "bucket").orderBy("shuffle", "doc_id", "size", "digest").rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumn("begin", F.sum("size").over(w) - F.col("size"))
    return run.join(checked_broadcast(before), ["number", "bucket"]).withColumn("begin", F.col("begin") + F.col("words0")).drop(
        "words0", "bucket", "buckets")


def point_of(slot: str):
    """frac(slot * golden ratio) as a number below 2**32: 2654435769 * slot modulo 2**32, by the factor's 16-bit halves."""
    low = f"pmod({slot}, 4294967296)"
    return F.expr(f"pmod(pmod({low} * {2654435769 >> 16}, 65536) * 65536 + {low} * {2654435769 & 65535}, 4294967296)")


def schedule(spark: SparkSession, by_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """(number, block_no, slot): which slot of the mix takes which block of which source."""
    shares = by_source.select("number", F.floor("target").alias("words")).filter("words > 0").withColumns({
        "blocks": F.ceil(F.col("words") / block).cast("long"),
        "hi": F.sum("words").over(Window.orderBy("number"))})
    shares = shares.withColumns({"lo": F.col("hi") - F.col("words"), "total": F.sum("words").over(Window.partitionBy())})
    shares = materialize(shares, "shares")
    total = shares.agg(F.max("total")).first()[0] or 0
    slots = -(-total // block)
    # the point's highest bits say which of the CELLS equal parts of the shares it is in; a source is in the cells it meets
    cell = f"cast(floor({{}} / cast({max(total, 1)} as double) * {CELLS}) as int)"
    side = checked_broadcast(shares.select("number", "lo", "hi", "blocks", F.explode(F.expr(
        f"sequence(greatest({cell.format('lo')} - 1, 0), least({cell.format('hi')} + 1, {CELLS - 1}))")).alias("cell")))
    drawn = spark.range(slots).withColumn("raw", point_of("id")).select(
        "id", F.expr(f"cast(raw div {(1 << 32) // CELLS} as int)").alias("cell"),
        (F.col("raw") / F.lit(4294967296.0) * F.lit(float(total))).alias("point")).join(side, "cell").filter(
        "point >= lo and point < hi").select(F.col("id").alias("slot"), F.expr(f"id div {CHUNK}").alias("chunk"), "number", "blocks")
    counts = drawn.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("number", "chunk", (F.sum("n").over(
        Window.partitionBy("number").orderBy("chunk")) - F.col("n")).alias("rank0"))
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1).join(
        before, ["number", "chunk"]).select("number", "blocks", "slot", (F.col("rank") + F.col("rank0")).cast("long").alias("block_no"))
    drawn_blocks = ranked.filter("block_no < blocks").select("number", "block_no", "slot")
    # blocks left over, after the last slot in order of source and block
    had = counts.groupBy("number").agg(F.sum("n").alias("had"))
    late = shares.join(had, "number", "left").filter("coalesce(had, 0) < blocks").withColumn(
        "before", F.coalesce(F.sum(F.expr("blocks - coalesce(had, 0)")).over(
            Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rest = late.select("number", "before", F.coalesce("had", F.lit(0)).alias("from"),
                       F.explode(F.expr("sequence(coalesce(had, 0), blocks - 1)")).alias("block_no")).select(
        "number", F.col("block_no").cast("long").alias("block_no"),
        F.expr(f"{slots} + before + block_no - `from`").cast("long").alias("slot"))
    return drawn_blocks.union(rest)


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, block: int = BLOCK,
        bucket_rows: int = BUCKET_ROWS, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces). ``row`` names a column of ``docs`` that tells rows apart; without it rows are numbered. Documents: row_id, doc_id, source, size, source_size, target, one row each. Pieces, the
    mix itself: slot, number and block_no, row_id, doc_id, epoch, first (word of the document) and words taken."""
    spark = docs.sparkSession
    sized = materialize(sizes(docs, row), "sizes")
    by_source = materialize(targets(sized, weights, max_epochs), "targets")
    placed = streams(sized, by_source, bucket_rows)
    placed = materialize(placed if row else placed.withColumn("row_id", F.monotonically_increasing_id()), "stream")
    copies = placed.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))).withColumns({
        "lo": F.expr("begin + epoch * source_size"),
        "hi": F.expr("least(begin + epoch * source_size + size, cast(floor(target) as long))")}).filter("lo < hi")
    cut = copies.withColumn("block_no", F.explode(F.expr(f"sequence(lo div {block}, (hi - 1) div {block})"))).withColumns({
        "a": F.expr(f"greatest(lo, block_no * {block})"), "b": F.expr(f"least(hi, (block_no + 1) * {block})")})
    pieces = cut.join(schedule(spark, by_source, block), ["number", "block_no"]).select(
        "slot", "number", "block_no", "row_id", "doc_id", "epoch", F.expr("a - lo").alias("first"), F.expr("b - a").alias("words"))
    return placed.select("row_id", "doc_id", "source", "size", "source_size", "target"), pieces


def taken_rows(docs: DataFrame, **parameters) -> DataFrame:
    """(row_id, doc_id, size, source_size, target, taken, first_slot) of every document: what the mix takes of it, repeats
    counted, and the first slot that does (null: none)."""
    rows, pieces = mix(docs, **parameters)
    taken = pieces.groupBy("row_id").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return rows.join(taken, "row_id", "left").select(
        "row_id", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def taken_words(docs: DataFrame, **parameters) -> DataFrame:
    """``taken_rows`` without the row's number."""
    return taken_rows(docs, **parameters).drop("row_id")


ORACLE = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5(doc_id::varchar || ':mix') as k from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as number
    from d group by source),
w as (select *, [5, 2, 1][number % 3 + 1] as weight, 3 * source_size as cap, sum(source_size) over () as total from s),
f as (select *, coalesce(sum(cap) over (order by cap / weight, number rows between unbounded preceding and 1 preceding), 0) as caps,
    sum(weight) over (order by cap / weight, number rows between current row and unbounded following) as rest from w),
c as (select *, cap * rest < weight * (total - caps) as capped from f),
t as (select source, source_size, case when capped then cap::double else coalesce((
      (total - coalesce(sum(cap) filter (capped) over (), 0)) * weight)::double / sum(weight) filter (not capped) over (), 0)
    end as target from c),
p as (select d.doc_id, d.size, t.source_size, t.target, t.source, sum(d.size) over (partition by d.source order by d.k, d.doc_id
      rows unbounded preceding) - d.size as b
    from d join t on d.source is not distinct from t.source),
h as (select source, row_number() over (order by source nulls last) - 1 as number, floor(target)::bigint as words from t
    where floor(target) > 0),
g as (select *, sum(words) over (order by number) as hi, (words + 1023) // 1024 as blocks from h),
q as (select i as slot, (i * 2654435769) % 4294967296 / 4294967296.0::double * (select sum(words) from g)::double as point
    from range(0, (select coalesce((sum(words)::bigint + 1023) // 1024, 0) from g)) r(i)),
k as (select slot, number, blocks, row_number() over (partition by number order by slot) - 1 as block_no
    from q join g on point >= hi - words and point < hi),
m as (select number, count(*) as had from k group by number),
l as (select g.number, unnest(range(coalesce(had, 0), blocks)) as block_no from g left join m using (number)),
z as (select number, block_no, slot from k where block_no < blocks
    union all select number, block_no, (select count(*) from q) + row_number() over (order by number, block_no) - 1 from l),
e as (select doc_id, size, source_size, target, source, b + e * source_size as lo,
    least(b + e * source_size + size, floor(target)::bigint) as hi from p, range(0, 3) r(e)),
x as (select doc_id, min(slot) as first_slot from (select doc_id, source, unnest(range((lo // 1024)::bigint,
      ((hi - 1) // 1024 + 1)::bigint)) as block_no from e where lo < hi) j join g on g.source is not distinct from j.source
    join z on z.number = g.number and z.block_no = j.block_no group by doc_id)
select e.doc_id, size, source_size, target, sum(greatest(0, hi - lo))::bigint as taken, first_slot::bigint as first_slot
from e left join x on x.doc_id = e.doc_id group by e.doc_id, size, source_size, target, first_slot
"""
