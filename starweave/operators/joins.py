"""Joins and lookups.

``join`` and ``lookup`` take the join type by its first letter, any case
(``'Inner'``, ``'left'``, ``'E'`` ...). Keys are given as ``key`` (same
positions/names on both sides) or as ``main_key``/``side_key``, each falling
back to the other and finally to column 0.

Strategy: these are ordinary equi-joins. No broadcast is forced on a side whose
size depends on the data; AQE replaces a sort-merge join by a broadcast hash
join at runtime when the measured side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed partitions
(``spark.sql.adaptive.skewJoin.enabled``) when one key is hot. An explicit
broadcast is taken only behind a check of rows and bytes (``broadcast_max_rows``).
Main rows with a NULL key match nothing, but a left or anti join keeps them; they
are dealt over all tasks (``nulls_dealt``) and not sent to the one of the NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import ColRef, fresh_name, name_of, parse_refs
from ..session import materialize

JOIN_TYPES = {"I": "inner", "L": "left", "E": "left_semi", "N": "left_anti", "C": "cross"}
LOOKUP_TYPES = {"I": "inner", "L": "left", "E": "left_semi", "N": "left_anti"}


def _kind(how: str, table: dict[str, str]) -> str:
    k = (how or "")[:1].upper()
    if k not in table:
        raise ValueError(f"unknown join type {how!r}; expected one of {sorted(set(table.values()))}")
    return table[k]


def _resolve_keys(main_key, side_key, key) -> tuple[list[ColRef], list[ColRef]]:
    mk = parse_refs(main_key) or parse_refs(key) or parse_refs(side_key) or [0]
    sk = parse_refs(side_key) or parse_refs(key) or parse_refs(main_key) or [0]
    if len(mk) != len(sk):
        raise ValueError(f"main key {mk} and side key {sk} differ in length")
    return mk, sk


def fits_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most
    ``max_rows + 1`` of them."""
    return df.limit(max_rows + 1).count() <= max_rows


# Rows and bytes a dimension-sized side may have and still be broadcast. A side
# over either bound is joined by shuffle (sort-merge, with AQE's skew handling).
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20


def _bytes(df: DataFrame) -> Column:
    """Bytes of all rows: texts by their length, other values as their type's
    usual size."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    fixed = 16 * (len(df.columns) - len(texts))
    return F.coalesce(F.sum(sum((F.coalesce(F.octet_length(df[c]), F.lit(0)) + 16 for c in texts), F.lit(fixed)).cast("long")), F.lit(0))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``df`` for a shuffled join.

    The check lets the big side skip its shuffle when the small side is
    proven small, instead of waiting for AQE to find out after both sides
    shuffled. The side is written once to the shared scratch folder, counted
    there and read from there by the join, so it is not computed again, nothing
    stays persisted on the executors, and ``release_scratch`` removes it.
    Columns of other than plain types are never proven small.
    """
    kept, small = kept_and_small(df, max_rows, max_bytes)
    return F.broadcast(kept) if small else kept


def kept_and_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The written copy of ``df`` and whether it is small enough to be broadcast."""
    kept = materialize(df, "side")
    if any(f.dataType.typeName() in ("array", "map", "struct", "variant") for f in kept.schema.fields):
        return kept, False
    rows, size = kept.agg(F.count(F.lit(1)), _bytes(kept)).first()
    return kept, rows <= max_rows and size <= max_bytes


def nulls_dealt(main: DataFrame, side: DataFrame, mk: Sequence[str], sk: Sequence[str]) -> Column:
    """An equality to add to that of the keys in a left or anti join. It holds wherever no key is NULL, so it changes no
    match. A main row with a NULL key has a hash of its values there, so such rows are shuffled by it and spread over
    the tasks; by their keys alone all would be in one."""
    return _dealt(main, mk) == _undealt(side, sk)


def _dealt(main: DataFrame, mk: Sequence[str]) -> Column:
    """0, or a hash of the row's values where a key is NULL."""
    plain = [main[f.name] for f in main.schema.fields if f.dataType.typeName() not in ("map", "struct", "array", "variant")]
    missing = F.lit(False)
    for a in mk:
        missing = missing | main[a].isNull()
    return F.when(missing, F.xxhash64(*plain)).otherwise(F.lit(0).cast("long"))


def _undealt(side: DataFrame, sk: Sequence[str]) -> Column:
    """0, not as a literal: Spark takes only an equality of both sides' columns as a join key."""
    return F.xxhash64(*[side[b] for b in sk]).bitwiseAND(F.lit(0).cast("long"))


def _null_keys_stay(main: DataFrame, kind: str, mk: Sequence[str], blank_matches: bool) -> bool:
    """Can the join have main rows that it keeps because a key is NULL?"""
    return kind in ("left", "left_anti") and not blank_matches and any(main.schema[a].nullable for a in mk)


def _with_side(side: DataFrame, max_rows: int | None) -> tuple[DataFrame, bool]:
    """The side, with the hint if it is proven small, and whether it is."""
    if max_rows is None:
        return side, False
    kept, small = kept_and_small(side, max_rows)
    return (F.broadcast(kept) if small else kept), small


def key_pairs(main: DataFrame, side: DataFrame, mk: Sequence[str], sk: Sequence[str],
              blank_matches: bool = False) -> Column:
    """Equality of composite keys. Keys of different types compare as text
    (``1`` matches ``'1'``); with ``blank_matches`` NULL and ``''`` match each
    other, as blank fields do in the text model."""
    cond = None
    types_m = dict(main.dtypes)
    types_s = dict(side.dtypes)
    for a, b in zip(mk, sk):
        l, r = main[a], side[b]
        if types_m[a] != types_s[b] or blank_matches:
            l, r = l.cast("string"), r.cast("string")
        if blank_matches:
            l, r = F.coalesce(l, F.lit("")), F.coalesce(r, F.lit(""))
        c = l == r
        cond = c if cond is None else cond & c
    return cond


def _rename_side(main: DataFrame, side: DataFrame) -> DataFrame:
    """Give side columns names that do not clash with the main side."""
    taken = list(main.columns)
    cols = []
    for c in side.columns:
        nm = fresh_name(taken, c)
        taken.append(nm)
        cols.append(side[c].alias(nm))
    return side.select(*cols)


def _keep(df: DataFrame, keep) -> DataFrame:
    refs = parse_refs(keep)
    if not refs:
        return df
    from .project import keep_fields

    return keep_fields(df, *refs)


def join(main: DataFrame, side: DataFrame, how: str = "inner", *, key=None, main_key=None, side_key=None,
         keep=None, blank_matches: bool = False, broadcast_max_rows: int | None = None,
         cross_max_rows: int | None = None) -> DataFrame:
    """Join ``main`` to ``side``.

    * inner/left: main columns then side columns (clashing side names get a
      suffix); ``keep`` re-projects the combined row by position or name.
      Unmatched left rows get NULL side fields.
    * exists/not_exists: semi/anti join; main rows only, each at most once;
      ``keep`` is ignored.
    * cross: every main row with every side row. Refused unless the side is
      proven small: ``cross_max_rows`` must be given and the side is checked
      against it, then broadcast (a nested loop over a bounded side).
    """
    kind = _kind(how, JOIN_TYPES)
    if kind == "cross":
        if cross_max_rows is None:
            raise ValueError("a cross join needs cross_max_rows: the side must be proven small")
        if not fits_rows(side, cross_max_rows):
            raise ValueError(f"cross join side has more than {cross_max_rows} rows")
        side_r = _rename_side(main, side)
        return _keep(main.crossJoin(F.broadcast(side_r)), keep)

    mk, sk = _resolve_keys(main_key, side_key, key)
    mk = [name_of(main, r) for r in mk]
    sk = [name_of(side, r) for r in sk]
    side_r = _rename_side(main, side)
    sk_r = [side_r.columns[side.columns.index(k)] for k in sk]
    side_r, small = _with_side(side_r, broadcast_max_rows)
    cond = key_pairs(main, side_r, mk, sk_r, blank_matches)
    if not small and _null_keys_stay(main, kind, mk, blank_matches):
        cond = cond & nulls_dealt(main, side_r, mk, sk_r)
    joined = main.join(side_r, cond, kind)
    if kind in ("left_semi", "left_anti"):
        return joined
    return _keep(joined, keep)


def one_row_per_key(side: DataFrame, keys: Sequence[str], vals: Sequence[str],
                    on_duplicate: str = "error", with_key: Sequence[str] = (), seldom_equal: bool = False) -> DataFrame:
    """Reduce a lookup side to exactly one row per key.

    Equal (key, values) rows collapse. When one key carries different values:
    ``'error'`` raises inside the plan naming the key, ``'min'`` keeps the
    smallest value (for several value columns, the smallest tuple).

    One aggregate with map-side partial aggregation, so a hot key is combined
    before the shuffle. Conflicts are found per column (min, max and non-NULL
    count: two different tuples differ in some column), which keeps the
    aggregate hash-based for fixed-width values such as surrogate keys; only
    ``'min'`` over several columns compares whole tuples.

    ``with_key`` are columns that follow from the key and stay beside it.
    ``seldom_equal`` is for keys that hardly ever repeat: rows are shuffled as
    they are and combined behind the shuffle, since an aggregate of one row is
    wider than the row.
    """
    if on_duplicate not in ("error", "min"):
        raise ValueError("on_duplicate must be 'error' or 'min'")
    named, keys = keys, [*keys, *with_key]
    if seldom_equal:
        side = side.select(*dict.fromkeys([*keys, *vals])).repartition(*keys)
    if not vals:
        return side.select(*keys).distinct()
    grouped = side.groupBy(*[side[k] for k in keys])
    if on_duplicate == "min" and len(vals) > 1:
        agg = grouped.agg(F.min(F.struct(*[side[c] for c in vals])).alias("__lo"))
        return agg.select(*keys, *[F.col("__lo")[c].alias(c) for c in vals])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(vals):
        aggs += [F.min(side[c]).alias(f"__lo{i}"), F.max(side[c]).alias(f"__hi{i}"),
                 F.count(side[c]).alias(f"__nn{i}")]
    agg = grouped.agg(*aggs)
    if on_duplicate == "min":
        return agg.select(*keys, F.col("__lo0").alias(vals[0]))
    conflict = None
    for i in range(len(vals)):
        c = (~F.col(f"__lo{i}").eqNullSafe(F.col(f"__hi{i}"))) | \
            ((F.col(f"__nn{i}") > 0) & (F.col(f"__nn{i}") < F.col("__n")))
        conflict = c if conflict is None else conflict | c
    msg = F.concat(F.lit("lookup key has several values: "), F.to_json(F.struct(*[F.col(k) for k in named])))
    checked = agg.filter(F.when(conflict, F.raise_error(msg)).otherwise(F.lit(True)))
    return checked.select(*keys, *[F.col(f"__lo{i}").alias(c) for i, c in enumerate(vals)])


def lookup(main: DataFrame, side: DataFrame, how: str = "left", *, side_val=None, key=None, main_key=None,
           side_key=None, keep=None, on_duplicate: str = "error", blank_matches: bool = False,
           broadcast_max_rows: int | None = None, distinct: bool = False, seldom_equal: bool = False) -> DataFrame:
    """Join to a side whose key is unique, returning ``side_val`` fields.

    The side is first reduced to one row per key (``one_row_per_key``), so an
    inner or left lookup never grows the row count of ``main``. Where it may be
    shuffled, it is so once, for that and for the join. ``seldom_equal``: its
    keys hardly ever repeat.

    ``distinct`` returns equal main rows once (A4). They have equal keys, so
    they are compared in the shuffle and the sort of the join and have none of
    their own: for keys that few rows share.
    """
    kind = _kind(how, LOOKUP_TYPES)
    mk, sk = _resolve_keys(main_key, side_key, key)
    mk = [name_of(main, r) for r in mk]
    sk = [name_of(side, r) for r in sk]
    vals = [] if kind in ("left_semi", "left_anti") else [name_of(side, r) for r in parse_refs(side_val)]
    if len(set(sk)) != len(sk):
        raise ValueError("side key names repeat")
    # keys that are compared as text (or blank as NULL) must be unique as such
    types_m, types_s = dict(main.dtypes), dict(side.dtypes)
    text = {b: side[b].cast("string") for a, b in zip(mk, sk) if blank_matches or types_m[a] != types_s[b]}
    text_vals = {v: f"__raw_{v}" for v in vals if v in text}
    if text:
        side = side.select(*side.columns, *[side[v].alias(n) for v, n in text_vals.items()]).withColumns(
            {b: F.coalesce(c, F.lit("")) if blank_matches else c for b, c in text.items()})
        vals = [text_vals.get(v, v) for v in vals]
    fields = main.columns
    dealt: list[str] = []  # the deal of NULL keys as a column: grouped by it, too, the side is shuffled but once
    if broadcast_max_rows is None and _null_keys_stay(main, kind, mk, blank_matches):
        dealt = [fresh_name([*fields, *side.columns], "__dealt")]
        main = main.withColumn(dealt[0], _dealt(main, mk))
        side = side.withColumn(dealt[0], _undealt(side, sk))
    slim = one_row_per_key(side, sk, [v for v in vals if v not in sk] or [], on_duplicate, dealt, seldom_equal)
    mk, sk = [*mk, *dealt], [*sk, *dealt]
    # values that are also key columns come straight from the key
    slim = slim.select(*sk, *[F.col(v).alias(f"__val{i}") for i, v in enumerate(vals)]) if vals else slim
    taken = list(main.columns)
    ren = []
    for c in slim.columns:
        if c.startswith("__val"):
            nm = fresh_name(taken, vals[int(c[5:])].removeprefix("__raw_"))
        else:
            nm = fresh_name(taken, "__key_" + c)
        taken.append(nm)
        ren.append(F.col(c).alias(nm))
    slim = slim.select(*ren)
    sk_r = slim.columns[: len(sk)]
    slim, small = _with_side(slim, broadcast_max_rows)
    if distinct:
        rest = [c for c in fields if c not in mk]
        main = main.repartition(*(mk if broadcast_max_rows is None else fields)).withColumn(
            nth := fresh_name(main.columns, "__nth"), F.row_number().over(Window.partitionBy(*mk, *rest).orderBy(mk[0]))
        ).filter(F.col(nth) == 1).drop(nth)
    cond = key_pairs(main, slim, mk, sk_r, blank_matches)
    if not small and not dealt and _null_keys_stay(main, kind, mk, blank_matches):
        cond = cond & nulls_dealt(main, slim, mk, sk_r)
    joined = main.join(slim, cond, kind)
    if kind in ("inner", "left"):
        joined = joined.select(*[main[c] for c in main.columns], *[slim[c] for c in slim.columns[len(sk):]])
    joined = joined.drop(*dealt)
    return joined if kind in ("left_semi", "left_anti") else _keep(joined, keep)
