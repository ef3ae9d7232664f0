"""Staging tables derived from the driver's tables (FIXTURES.md §3).

The four staging tables of the skating model (performances, judges, judged
aspects, judge scores) are derived from orders/customer/nation,
supplier, lineitem/part. ``STAGING_SQL`` is the portable SQL text that the
DuckDB oracle runs as leading CTEs; the DataFrame builders below compute the
same rows in Spark.

Judges are the suppliers that occur on line items: a supplier judges every
event that one of its line items' orders belongs to, and scores the aspects of
its line items. An aspect is a line of an order with its part, so its part and
price come from one line item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import read_table

# The staging SQL of FIXTURES.md §3, run as is by the oracle.
S_PERFORMANCES_SQL = """
select 'P' || cast(o_orderkey as string) as performance_id,
       'Season ' || cast(year(o_orderdate) as string) as competition_nm,
       case c_custkey % 4 when 0 then 'Ladies Single Skating' when 1 then 'Men Single Skating'
                          when 2 then 'Pair Skating' else 'Ice Dance' end
       || ' - '
       || case when o_orderpriority in ('1-URGENT','3-MEDIUM','5-LOW') then 'Short' else 'Free' end
       || case when c_custkey % 4 = 3 then ' Dance'
               when o_orderpriority in ('1-URGENT','3-MEDIUM','5-LOW') then ' Program'
               else ' Skating' end as program_event_nm,
       case c_custkey % 3 when 0 then c_mktsegment when 1 then 'O''' || c_mktsegment
                          else 'VAN DER-' || c_mktsegment end
       || ' S' || translate(cast(c_custkey as string), '0123456789', 'abcdefghij')
       || case when c_custkey % 4 >= 2
               then ' / ' || c_mktsegment || ' P' || translate(cast(c_custkey as string), '0123456789', 'abcdefghij')
               else '' end as skater_nm,
       n_name as nationality,
       cast(o_orderkey % 30 + 1 as bigint) as event_perf_rank_nbr,
       cast(o_orderkey as bigint) as event_perf_seq_nbr,
       o_totalprice / 1000 as segment_score,
       o_totalprice / 2000 as element_score,
       o_totalprice / 2000 as component_score,
       cast(-(o_orderkey % 3) as double) as deductions
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

S_JUDGES_SQL = """
select s_name as clean_judge_nm, n_name as judge_affiliation_nm,
       'JUDGE J' || translate(cast(s_suppkey as string), '0123456789', 'abcdefghij') as judge_nm,
       'Judge No.' || cast(s_suppkey as string) as role,
       e.program_event_nm, e.competition_nm,
       'J' || cast(s_suppkey as string) as clean_role, n_name as nationality
from (select distinct competition_nm, program_event_nm, l_suppkey
      from lineitem join s_performances on l_orderkey = event_perf_seq_nbr) e
join supplier on s_suppkey = l_suppkey join nation on s_nationkey = n_nationkey
"""

S_JUDGED_ASPECTS_SQL = """
select 'A' || cast(l.l_orderkey as string) || '-' || cast(l.l_linenumber as string) || '-'
       || cast(l.l_partkey as string) as judged_aspect_id,
       'P' || cast(l.l_orderkey as string) as performance_id,
       case when l.l_linenumber <= 4 then 'elements' else 'components' end as aspect_type_nm,
       case when l.l_linenumber <= 4 then cast(l.l_linenumber as double) end as perf_aspect_seq_nbr,
       p_name as aspect_desc,
       cast(null as string) as info_flag, cast(null as string) as credit_flag,
       case when l.l_linenumber <= 4 then p_size / 10 end as base_difficulty,
       case when l.l_linenumber > 4 then cast(l.l_linenumber as double) end as factor,
       cast(l.l_linenumber as double) as goe, cast(null as string) as ref,
       l.price / 1000 as total_score
from (select l_orderkey, l_linenumber, l_partkey, min(l_extendedprice) as price
      from lineitem group by l_orderkey, l_linenumber, l_partkey) l
join part on l.l_partkey = p_partkey
"""

S_JUDGE_SCORES_SQL = """
select a.judged_aspect_id, 'J' || cast(l.l_suppkey as string) as clean_role,
       (a.total_score + l.l_suppkey) / 10 as score
from (select distinct 'A' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
             || cast(l_partkey as string) as line_id, l_suppkey from lineitem) l
join s_judged_aspects a on a.judged_aspect_id = l.line_id
"""

STAGING_SQL = {
    "s_performances": S_PERFORMANCES_SQL,
    "s_judges": S_JUDGES_SQL,
    "s_judged_aspects": S_JUDGED_ASPECTS_SQL,
    "s_judge_scores": S_JUDGE_SCORES_SQL,
}

# Which staging tables each one needs (for building minimal CTE lists).
STAGING_DEPS = {
    "s_performances": [],
    "s_judges": ["s_performances"],
    "s_judged_aspects": [],
    "s_judge_scores": ["s_judged_aspects"],
}


def with_staging(sql: str, *tables: str) -> str:
    """Prefix ``sql`` with the CTEs for the named staging tables (and the
    tables they depend on), in dependency order."""
    order: list[str] = []

    def add(t: str) -> None:
        for d in STAGING_DEPS[t]:
            add(d)
        if t not in order:
            order.append(t)

    for t in tables:
        add(t)
    if not order:
        return sql
    ctes = ",\n".join(f"{t} as ({STAGING_SQL[t].strip()})" for t in order)
    return f"with {ctes}\n{sql.strip()}"


def _letters(c):
    """Digits of a key spelled as letters a-j (0 -> a)."""
    return F.translate(c.cast("string"), "0123456789", "abcdefghij")


def s_performances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: a performance. orders ⋈ customer ⋈ nation; the
    customer and nation sides are dimension-sized and AQE picks the join."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                                   "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    short = F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM", "5-LOW")
    kind = F.col("c_custkey") % 4
    seg = F.col("c_mktsegment")
    letters = _letters(F.col("c_custkey"))
    program = F.concat(
        F.when(kind == 0, "Ladies Single Skating").when(kind == 1, "Men Single Skating")
        .when(kind == 2, "Pair Skating").otherwise("Ice Dance"),
        F.lit(" - "),
        F.when(short, "Short").otherwise("Free"),
        F.when(kind == 3, " Dance").when(short, " Program").otherwise(" Skating"),
    )
    third = F.col("c_custkey") % 3
    skater = F.concat(
        F.when(third == 0, seg).when(third == 1, F.concat(F.lit("O'"), seg)).otherwise(F.concat(F.lit("VAN DER-"), seg)),
        F.lit(" S"), letters,
        F.when(kind >= 2, F.concat(F.lit(" / "), seg, F.lit(" P"), letters)).otherwise(F.lit("")),
    )
    return j.select(
        F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("performance_id"),
        F.concat(F.lit("Season "), F.year("o_orderdate").cast("string")).alias("competition_nm"),
        program.alias("program_event_nm"),
        skater.alias("skater_nm"),
        F.col("n_name").alias("nationality"),
        (F.col("o_orderkey") % 30 + 1).cast("bigint").alias("event_perf_rank_nbr"),
        F.col("o_orderkey").cast("bigint").alias("event_perf_seq_nbr"),
        (F.col("o_totalprice") / 1000).alias("segment_score"),
        (F.col("o_totalprice") / 2000).alias("element_score"),
        (F.col("o_totalprice") / 2000).alias("component_score"),
        (-(F.col("o_orderkey") % 3)).cast("double").alias("deductions"),
    )


def s_judges(spark: SparkSession, sf_dir: str, perfs: DataFrame | None = None) -> DataFrame:
    """One row per (event, judge): the distinct suppliers of the line items of
    an event's performances. One equi-join on the order, distinct with partial
    aggregation, then the supplier and nation attributes."""
    perfs = perfs if perfs is not None else s_performances(spark, sf_dir)
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    events = li.join(perfs.select("event_perf_seq_nbr", "competition_nm", "program_event_nm"),
                     F.col("l_orderkey") == F.col("event_perf_seq_nbr")) \
        .select("competition_nm", "program_event_nm", "l_suppkey").distinct()
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (events.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("s_name").alias("clean_judge_nm"),
        F.col("n_name").alias("judge_affiliation_nm"),
        F.concat(F.lit("JUDGE J"), _letters(F.col("s_suppkey"))).alias("judge_nm"),
        F.concat(F.lit("Judge No."), F.col("s_suppkey").cast("string")).alias("role"),
        "program_event_nm", "competition_nm",
        F.concat(F.lit("J"), F.col("s_suppkey").cast("string")).alias("clean_role"),
        F.col("n_name").alias("nationality"),
    )


def _aspect_id():
    return F.concat(F.lit("A"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                    F.lit("-"), F.col("l_partkey").cast("string"))


def s_judged_aspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line number, part), grouped with partial
    aggregation and joined to part. Line items equal in all three are one
    aspect, scored by each of their suppliers."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    l = li.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.min("l_extendedprice").alias("price"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    j = l.join(p, l.l_partkey == p.p_partkey)
    ln = F.col("l_linenumber")
    elem = ln <= 4
    return j.select(
        _aspect_id().alias("judged_aspect_id"),
        F.concat(F.lit("P"), F.col("l_orderkey").cast("string")).alias("performance_id"),
        F.when(elem, "elements").otherwise("components").alias("aspect_type_nm"),
        F.when(elem, ln.cast("double")).alias("perf_aspect_seq_nbr"),
        F.col("p_name").alias("aspect_desc"),
        F.lit(None).cast("string").alias("info_flag"),
        F.lit(None).cast("string").alias("credit_flag"),
        F.when(elem, F.col("p_size") / 10).alias("base_difficulty"),
        F.when(~elem, ln.cast("double")).alias("factor"),
        ln.cast("double").alias("goe"),
        F.lit(None).cast("string").alias("ref"),
        (F.col("price") / 1000).alias("total_score"),
    )


def s_judge_scores(spark: SparkSession, sf_dir: str, aspects: DataFrame | None = None) -> DataFrame:
    """One score per (aspect, supplier of its line items).

    An aspect id names its order, line number and part, so the line items of an
    aspect are those equal in the three. They are shuffled once by them and
    sorted by them and the supplier; there they are priced as the aspect is,
    and each supplier is kept once. With ``aspects`` given, the line items meet
    these on the id instead, whatever they are."""
    line = ["l_orderkey", "l_linenumber", "l_partkey"]
    li = read_table(spark, sf_dir, "lineitem").select(*line, "l_suppkey", "l_extendedprice")
    if aspects is not None:
        # shuffled once, by the id: equal pairs meet there, and so do the aspects
        pairs = li.select(_aspect_id().alias("line_id"), "l_suppkey").dropna(subset=["line_id"]).repartition(
            "line_id").distinct()
        j = aspects.select("judged_aspect_id", "total_score").join(pairs, F.col("judged_aspect_id") == F.col("line_id"))
    else:
        known = li.dropna(subset=line)  # a line item that lacks one has no aspect id
        nth = F.row_number().over(Window.partitionBy(*line, "l_suppkey").orderBy("l_suppkey"))
        pairs = known.withColumn("price", F.min("l_extendedprice").over(Window.partitionBy(*line))).withColumn(
            "nth", nth).filter("nth = 1")
        p = read_table(spark, sf_dir, "part").select("p_partkey")
        j = pairs.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
            _aspect_id().alias("judged_aspect_id"), "l_suppkey", (F.col("price") / 1000).alias("total_score"))
    return j.select(
        "judged_aspect_id",
        F.concat(F.lit("J"), F.col("l_suppkey").cast("string")).alias("clean_role"),
        ((F.col("total_score") + F.col("l_suppkey")) / 10).alias("score"),
    )


STAGING = ("s_performances", "s_judges", "s_judged_aspects", "s_judge_scores")


def staging(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> dict[str, DataFrame]:
    """The staging tables, or those named in ``only``."""
    perfs = s_performances(spark, sf_dir)
    aspects = s_judged_aspects(spark, sf_dir)
    make = {
        "s_performances": lambda: perfs,
        "s_judges": lambda: s_judges(spark, sf_dir, perfs),
        "s_judged_aspects": lambda: aspects,
        "s_judge_scores": lambda: s_judge_scores(spark, sf_dir),
    }
    return {n: make[n]() for n in STAGING if only is None or n in only}
