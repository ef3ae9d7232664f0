"""Surrogate keys, sort and first-n.

Dense keys at scale
-------------------
``row_number() OVER (ORDER BY k)`` without PARTITION BY plans
``Exchange SinglePartition``: every row goes through one task. ``dense_key``
numbers rows the distributed way instead:

1. ``repartitionByRange(*order)`` + ``sortWithinPartitions`` — Spark samples
   the keys for the range bounds, so partition ``i`` holds keys below those of
   partition ``i+1``; AQE merges small adjacent ranges to its advisory size.
   The sorting task tags each row with its partition id and its position in
   the partition (``spark_partition_id``, ``monotonically_increasing_id``). A hot leading key value is split across partitions by
   the later key columns (the order is made total by a natural key last).
2. the tagged rows are written as parquet under ``spark.checkpoint.dir`` (the
   cluster's shared folder) and read back. The counting pass and the numbering
   pass must see the same tags; a written table cannot change under a lost
   executor or an AQE re-plan, nothing is held on a machine-local disk, and
   the copy is compressed and columnar (later readers prune columns).
3. rows per partition: one pass over the written tags gives n counts (n = the
   partition count, a bound independent of the data); their exclusive running
   sum is the offset of each partition, an n-row table that is broadcast.
4. key = start + (offset + position in partition) * interval — no second
   shuffle.

The range sampling runs the input once more, as a second shuffle would. With
``by_position`` the input runs once: its rows are written as they come, steps
1 to 4 take the order columns and the row position only, and the keys join the
written rows by position. The range shuffle and the tagged copy are then as
narrow as the order; the rows travel once, in the join, with the columns that
the reader wants.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import ColRef, name_of
from ..session import materialize

OrderItem = ColRef | Column


def _order_cols(df: DataFrame, order: Sequence[OrderItem], descending: bool = False) -> list[Column]:
    cols = []
    for o in order:
        c = o if isinstance(o, Column) else df[name_of(df, o)]
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return cols


def dense_key(df: DataFrame, order: Sequence[OrderItem], name: str = "id", *, start: int = 1, interval: int = 1,
              partitions: int | None = None, descending: bool = False, first: bool = True,
              by_position: bool = False) -> DataFrame:
    """Prepend ``name`` = start, start+interval, ... in ``order``
    (NULLs first ascending, as SQL windows order). Distributed; see module
    docstring. ``first=False`` appends the key instead of prepending it.
    ``by_position`` numbers the order columns alone: for rows that are wide, or
    costly to make twice."""
    if not order:
        raise ValueError("dense_key needs an order")
    if by_position:
        return _key_by_position(df, order, name, first, dict(
            start=start, interval=interval, partitions=partitions, descending=descending))
    spark = df.sparkSession
    sort_cols = _order_cols(df, order, descending)
    # Without an explicit count AQE sizes the range partitions from the
    # measured shuffle (adjacent ranges merge, so the order holds).
    ranged = df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
    pid, mono = "__pid", "__mono"
    # The task that sorts a range records its partition id and each row's
    # position (the lower bits of monotonically_increasing_id) and writes them
    # with the rows, so the numbering depends on nothing but the written table.
    tagged = ranged.sortWithinPartitions(*sort_cols).select(
        "*", F.spark_partition_id().alias(pid), F.monotonically_increasing_id().alias(mono))
    fixed = materialize(tagged, "dense_key", "zstd")  # sorted keys and positions shrink well
    # Rows per range partition: one count per partition (reading the pid
    # column only), a number bounded by the partition count, not by the data.
    counts = sorted(tuple(r) for r in fixed.groupBy(pid).agg(F.count(F.lit(1)).alias("n")).collect())
    rows, run = [], 0
    for p, n in counts:
        rows.append((p, run))
        run += n
    # One row per partition: broadcast once per executor (an inline literal
    # would travel with every task).
    offsets = spark.createDataFrame(rows, f"{pid} int, __off long")
    pos = F.col(mono) - F.shiftleft(F.col(pid).cast("bigint"), 33)
    key = (F.lit(start).cast("bigint") + (F.col("__off") + pos) * F.lit(interval).cast("bigint")).alias(name)
    out = fixed.join(F.broadcast(offsets), pid)
    rest = [F.col(c) for c in df.columns]
    return out.select(key, *rest) if first else out.select(*rest, key)


def _key_by_position(df: DataFrame, order: Sequence[OrderItem], name: str, first: bool, how: dict) -> DataFrame:
    """The rows are written once, as they come, each with its position; the
    order columns and positions, read back from there, are numbered, and the
    keys join the rows by position."""
    names = [f"__order_{i}" for i in range(len(order))]
    exprs = [(o if isinstance(o, Column) else df[name_of(df, o)]).alias(n) for o, n in zip(order, names)]
    rows = materialize(df.select("*", *exprs, F.monotonically_increasing_id().alias("__position")), "dense_rows", "zstd")
    keys = dense_key(rows.select(*names, "__position"), names, "__key", **how).select(
        F.col("__position").alias("__at"), F.col("__key").alias(name))
    out = rows.drop(*names).join(keys, F.col("__position") == F.col("__at"))
    rest = [F.col(c) for c in df.columns]
    return out.select(F.col(name), *rest) if first else out.select(*rest, F.col(name))


def dense_rank_key(df: DataFrame, order: Sequence[OrderItem], name: str = "id", **kw) -> DataFrame:
    """``dense_rank() OVER (ORDER BY keys)``: equal keys share a number.

    Distinct keys (partial aggregation first), number them with ``dense_key``,
    join back null-safe. The key table is as large as the number of distinct
    keys; AQE broadcasts it when it is measured small, else sort-merge.
    """
    key_exprs = [o if isinstance(o, Column) else df[name_of(df, o)] for o in order]
    knames = [f"__k{i}" for i in range(len(key_exprs))]
    keyed = df.select("*", *[e.alias(k) for e, k in zip(key_exprs, knames)])
    distinct_keys = keyed.select(*knames).distinct()
    numbered = dense_key(distinct_keys, knames, name, **kw)
    cond = None
    for k in knames:
        c = keyed[k].eqNullSafe(numbered[k])
        cond = c if cond is None else cond & c
    joined = keyed.join(numbered, cond, "inner")
    return joined.select(numbered[name], *[keyed[c] for c in df.columns])


# ---------------------------------------------------------------------------- S1
def _try_double(c: Column) -> Column:
    """The number when the text is one, NULL otherwise (never fails)."""
    return c.try_cast("double")


def sort(df: DataFrame, *refs, descending: bool = False) -> DataFrame:
    """Multi-key sort, one direction for all keys.

    A key given as a ``float`` (``6.``) sorts numerically: text that parses as
    a number sorts by value, other text (blank, ``abc``) as NULL — first when
    ascending. An ``int`` or a name sorts by the field as it is (text in code
    point order). Range-partitioned external sort; spills, no single task.
    """
    cols = []
    for r in refs:
        if isinstance(r, float):
            c = _try_double(df[name_of(df, int(r))])
        else:
            c = df[name_of(df, r)]
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return df.orderBy(*cols)


def first_n(df: DataFrame, n: int, order: Sequence[OrderItem] | None = None, descending: bool = False) -> DataFrame:
    """The first ``n`` rows; with ``order`` a fixed top-n (TakeOrdered:
    each partition keeps its own n best, then one merge of n*partitions)."""
    if n < 0:
        raise ValueError("n must be >= 0")
    if order:
        return df.orderBy(*_order_cols(df, order, descending)).limit(n)
    return df.limit(n)


def top_per_group(df: DataFrame, group: Sequence[ColRef], order: Sequence[OrderItem], k: int,
                  descending: bool | Sequence[bool] = False) -> DataFrame:
    """The first ``k`` rows of each group in ``order`` (a top-k report).

    ``row_number() <= k`` over a window partitioned by the group: Spark plans
    a partial group limit before the shuffle (WindowGroupLimit), so each map
    task sends at most ``k`` rows per group and a hot group never travels
    whole.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    desc = [descending] * len(order) if isinstance(descending, bool) else list(descending)
    cols = []
    for o, d in zip(order, desc):
        c = o if isinstance(o, Column) else df[name_of(df, o)]
        cols.append(c.desc_nulls_last() if d else c.asc_nulls_first())
    w = Window.partitionBy(*[df[name_of(df, g)] for g in group]).orderBy(*cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def sort_position(df: DataFrame, *refs, name: str = "pos", descending: bool = False, **kw) -> DataFrame:
    """S1 made observable: number the rows 1..n in the order ``sort`` would
    give them (a ``float`` key sorts numerically, other keys as they are).
    Distributed like ``dense_key``."""
    order: list[Column] = []
    for r in refs:
        order.append(_try_double(df[name_of(df, int(r))]) if isinstance(r, float) else df[name_of(df, r)])
    return dense_key(df, order, name, descending=descending, **kw)
