"""Counting and de-duplication.

All are hash aggregates with map-side partial aggregation: a key that holds a
third of the rows is reduced to one partial row per input partition before the
shuffle, so no task receives the hot group whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import ColRef, names_of
from ..session import materialize
from .keys import OrderItem, dense_key


def count_by(df: DataFrame, *refs: ColRef, name: str = "count") -> DataFrame:
    """A1/A2: ``SELECT cols, COUNT(*) GROUP BY cols``. With no columns: one row
    holding the total (0 on empty input, as SQL gives)."""
    cols = names_of(df, refs)
    if not cols:
        return df.agg(F.count(F.lit(1)).alias(name))
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame, *, seldom_equal: bool = False) -> DataFrame:
    """A3/A4: whole-row distinct (NULLs compare equal, fields compared as
    values, not as joined text).

    ``seldom_equal`` is for rows that hardly ever repeat. Before the shuffle
    they would all be kept in a hash map of the task that reads them, and a
    split of a well compressed file has many. They are shuffled by all their
    values instead and compared there, a shuffle partition at a time."""
    return (df.repartition(*df.columns) if seldom_equal else df).distinct()


def count_distinct_by(df: DataFrame, group: list[ColRef], of: ColRef, name: str = "count") -> DataFrame:
    """A5: entries per group = number of distinct values of ``of``.

    Written as distinct-then-count (two aggregates, both partial before their
    shuffle) rather than ``countDistinct``, which Spark would expand per row.
    """
    g = names_of(df, group)
    o = names_of(df, [of])[0]
    # count(o) skips NULL, so a group whose values are all NULL counts 0.
    return df.select(*g, o).distinct().groupBy(*g).agg(F.count(F.col(o)).alias(name))


def string_agg_ordered(df: DataFrame, group: list[ColRef], value: ColRef, order: ColRef,
                       sep: str = "", name: str = "agg") -> DataFrame:
    """A6 across rows: ``STRING_AGG(value, sep ORDER BY order)`` per group
    (NULL on no input), with ``listagg ... WITHIN GROUP``.

    The result of a group is one value built in one task, so use it on groups
    with a bounded number of rows (words of one text, a top-k per group); for
    the words of one value use ``join_words`` inside the row, with no shuffle.
    """
    g = names_of(df, group)
    v, o = names_of(df, [value, order])
    expr = F.expr(f"listagg(`{v}`, '{_sql_str(sep)}') WITHIN GROUP (ORDER BY `{o}`)")
    return df.groupBy(*g).agg(expr.alias(name))


def string_agg_chunks(df: DataFrame, group: list[ColRef], value: ColRef, order: Sequence[OrderItem], sep: str = "",
                      *, rows: int = 10_000) -> DataFrame:
    """A6 across rows for groups of any size: ``STRING_AGG`` of a group as
    chunks of at most ``rows`` values each.

    Returns the group columns with ``chunk`` (0, 1, ...), ``begin`` (characters
    of the whole before it) and ``text``; the texts of a group in the order of
    ``chunk``, put together, are the aggregate (a chunk but the first begins
    with ``sep``). NULLs are left out, as SQL
    does; a group with no value has no chunk.

    The rows are numbered in the order of (group, ``order``) by dense keys, so a
    hot group is dealt over many tasks, range by range. A chunk is made from
    its own rows only. What is summed over a group is the length of each chunk,
    one narrow row a chunk.
    """
    g = names_of(df, group)
    v = names_of(df, [value])[0]
    gs = [f"__g{i}" for i in range(len(g))]  # names of its own: order may be any columns of df
    rest = [o if isinstance(o, Column) else df[names_of(df, [o])[0]] for o in order]
    keep = df.filter(df[v].isNotNull())
    shaped = keep.select(*[df[c].alias(n) for c, n in zip(g, gs)], df[v].cast("string").alias("__v"),
                         *[o.alias(f"__o{i}") for i, o in enumerate(rest)])
    row = dense_key(shaped, [*gs, *(f"__o{i}" for i in range(len(rest)))], "__row", start=0).select("__row", *gs, "__v")
    # cut where the row number is a multiple of ``rows``, and between groups
    dealt = row.withColumn("__c", F.expr(f"__row div {int(rows)}"))
    values = F.array_sort(F.collect_list(F.struct("__row", "__v")))
    texts = dealt.groupBy(*gs, "__c").agg(F.array_join(F.transform(values, lambda p: p["__v"]), sep).alias("text"))
    made = materialize(texts.withColumn("n", F.char_length("text").cast("bigint")), "string_agg")
    w = Window.partitionBy(*gs).orderBy("__c")
    places = made.select(*gs, "__c", "n", (F.row_number().over(w) - 1).cast("bigint").alias("chunk")).withColumn(
        "begin", F.coalesce(F.sum(F.col("n") + len(sep)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        - F.when(F.col("chunk") > 0, len(sep)).otherwise(0))
    same = F.col("a.__c") == F.col("b.__c")
    for n in gs:
        same = same & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    text = F.when(F.col("chunk") > 0, F.concat(F.lit(sep), F.col("a.text"))).otherwise(F.col("a.text"))
    return made.alias("a").join(places.alias("b"), same).select(
        *[F.col(f"a.{n}").alias(c) for n, c in zip(gs, g)], "b.chunk", "b.begin", text.alias("text"))


def join_words(words: Column, sep: str = "") -> Column:
    """A6 inside one row: join an array in its order."""
    return F.array_join(words, sep)


def _sql_str(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")
