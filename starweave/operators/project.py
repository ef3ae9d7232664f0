"""Projection and filter operators.

Fields may be named or given by 0-based position. All operators are plain
``select``/``filter`` projections, so Catalyst prunes the columns they drop all
the way into the parquet scan and pushes filters below them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import BLANK, ColRef, fresh_name, name_of, names_of

Transform = Callable[[Column], Column]


def drop_fields(df: DataFrame, *refs: ColRef) -> DataFrame:
    """Drop the given fields; the rest keep their relative order."""
    names = set(names_of(df, refs))
    return df.select(*[df[c] for c in df.columns if c not in names])


def keep_fields(df: DataFrame, *refs: ColRef, as_text: bool = False) -> DataFrame:
    """Choose, reorder and repeat fields; ``'x'`` adds a blank (NULL) field.

    A field chosen twice gets a fresh name for the repeat (``name_1``). With
    ``as_text`` every field is cast to string, as in the untyped route.
    """
    out: list[Column] = []
    taken: list[str] = []
    for r in refs:
        if isinstance(r, str) and r.lower() == BLANK and r not in df.columns:
            nm = fresh_name(taken, "blank")
            out.append(F.lit(None).cast("string").alias(nm))
        else:
            src = name_of(df, r)
            nm = fresh_name(taken, src)
            c = df[src].cast("string") if as_text else df[src]
            out.append(c.alias(nm))
        taken.append(nm)
    return df.select(*out)


def append_fields(df: DataFrame, *refs: ColRef) -> DataFrame:
    """Append copies of input fields (or blanks) at the end; positions
    refer to the input, not to fields appended in the same call."""
    out: list[Column] = [df[c] for c in df.columns]
    taken = list(df.columns)
    for r in refs:
        if isinstance(r, str) and r.lower() == BLANK and r not in df.columns:
            nm = fresh_name(taken, "blank")
            out.append(F.lit(None).cast("string").alias(nm))
        else:
            src = name_of(df, r)
            nm = fresh_name(taken, src)
            out.append(df[src].alias(nm))
        taken.append(nm)
    return df.select(*out)


def xform(df: DataFrame, steps: Sequence[tuple[ColRef, Transform]]) -> DataFrame:
    """Rewrite fields in place. Steps run in the order given, so two steps
    on one field compose (first, then second).

    Consecutive steps are folded into one projection; Catalyst collapses the
    result into a single Project anyway.
    """
    current: dict[str, Column] = {}
    for ref, fn in steps:
        nm = name_of(df, ref)
        current[nm] = fn(current.get(nm, df[nm]))
    return df.select(*[current[c].alias(c) if c in current else df[c] for c in df.columns])


def xform_append(df: DataFrame, steps: Sequence[tuple[ColRef, Transform]],
                 names: Sequence[str] | None = None) -> DataFrame:
    """P5: append ``f(field)`` for each step. A position may point at a field
    appended by an earlier step of the same call."""
    cols: list[tuple[str, Column]] = [(c, df[c]) for c in df.columns]
    for i, (ref, fn) in enumerate(steps):
        if isinstance(ref, int):
            if ref < 0 or ref >= len(cols):
                raise IndexError(f"column position {ref} out of range for {len(cols)} columns")
            src = cols[ref][1]
        else:
            hits = [c for n, c in cols if n == ref]
            if not hits:
                raise KeyError(f"no column {ref!r}")
            src = hits[0]
        base = names[i] if names is not None else f"f{len(cols)}"
        nm = fresh_name([n for n, _ in cols], base)
        cols.append((nm, fn(src)))
    return df.select(*[c.alias(n) for n, c in cols])


def with_derived(df: DataFrame, **exprs: Column) -> DataFrame:
    """``SELECT *, expr AS name, ...``."""
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def like_filter(df: DataFrame, ref: ColRef, pattern: str, negate: bool = False) -> DataFrame:
    """Case-sensitive SQL LIKE filter; pushed to the scan when ``ref`` is a
    stored column (StringContains/StartsWith/EndsWith)."""
    cond = df[name_of(df, ref)].like(pattern)
    return df.filter(~cond if negate else cond)


def case_when(branches: Sequence[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """``CASE WHEN c1 THEN v1 ... ELSE v END``."""
    if not branches:
        raise ValueError("case_when needs at least one branch")
    expr = F.when(branches[0][0], branches[0][1])
    for cond, val in branches[1:]:
        expr = expr.when(cond, val)
    return expr.otherwise(otherwise) if otherwise is not None else expr


def all_blank(cols: Sequence[Column]) -> Column:
    """True when every value is NULL or ``''`` (the text model's blank)."""
    return F.concat_ws("", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]) == ""


def drop_blank_groups(df: DataFrame, refs: Sequence[ColRef]) -> DataFrame:
    """Keep rows where at least one of the fields is not blank."""
    return df.filter(~all_blank([df[n] for n in names_of(df, refs)]))
