"""Union, unpivot, split and fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import ColRef, fresh_name, names_of
from ..functions.scalars import split_literal, strip_ws
from ..session import materialize
from .project import all_blank


def flatten(*dfs: DataFrame, by_name: bool = False) -> DataFrame:
    """Bag union of DataFrames (duplicates kept). By position unless
    ``by_name``; a narrow operation, no shuffle."""
    if not dfs:
        raise ValueError("flatten needs at least one DataFrame")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d) if by_name else out.union(d)
    return out


def union_branches(df: DataFrame, branches: Sequence[tuple[Column, dict[str, Column]]],
                   keep: Sequence[str] = ()) -> DataFrame:
    """``SELECT ... WHERE c1 UNION ALL SELECT ... WHERE c2 ...`` over one
    input, in a single scan.

    Each branch is (condition, {out_name: expr}); all branches must give the
    same names. Each row becomes an array of the branch structs whose
    condition holds, expanded with ``inline``; the input is read once instead
    of once per branch.
    """
    if not branches:
        raise ValueError("union_branches needs a branch")
    names = list(branches[0][1].keys())
    for _, b in branches:
        if list(b.keys()) != names:
            raise ValueError("every branch must produce the same columns in the same order")
    structs = [F.when(cond, F.struct(*[e.alias(n) for n, e in b.items()])) for cond, b in branches]
    arr = F.filter(F.array(*structs), lambda s: s.isNotNull())
    return df.select(*keep, F.inline(arr))


def normalise(df: DataFrame, outputs: int, *refs: ColRef, blanks: str = "y",
              names: Sequence[str] | None = None) -> DataFrame:
    """Unpivot groups of fields into rows.

    ``refs`` are split into ``outputs`` consecutive groups of equal size; each
    input row gives one row per group: the fields in no group first (in
    their order), then the group's fields. ``blanks='n'`` drops a group whose
    fields are all blank (NULL or ``''``). Output field names come from
    ``names`` or from the first group. Uses ``inline(array(struct...))``: one
    pass, no shuffle.
    """
    cols = names_of(df, refs)
    if outputs <= 0 or len(cols) % outputs:
        raise ValueError(f"{len(cols)} fields cannot be split into {outputs} equal groups")
    size = len(cols) // outputs
    groups = [cols[i * size:(i + 1) * size] for i in range(outputs)]
    common = [c for c in df.columns if c not in set(cols)]
    out_names = list(names) if names else [fresh_name(common, c) for c in groups[0]]
    if len(out_names) != size:
        raise ValueError("names must give one name per field of a group")
    types = [dict(df.dtypes)[c] for c in groups[0]]
    structs = []
    for g in groups:
        fields = [df[c].cast(t).alias(n) for c, t, n in zip(g, types, out_names)]
        s = F.struct(*fields)
        if blanks.lower() == "n":
            s = F.when(~all_blank([df[c] for c in g]), s)
        structs.append(s)
    arr = F.array(*structs)
    if blanks.lower() == "n":
        arr = F.filter(arr, lambda s: s.isNotNull())
    return df.select(*[df[c] for c in common], F.inline(arr))


def split_widths(df: DataFrame, delimiter: str, *refs: ColRef) -> dict[str, int]:
    """The most parts that each field splits into, at least 1: one pass over
    these fields, a maximum per task."""
    targets = names_of(df, refs)
    widths = df.agg(*[F.max(F.size(split_literal(df[c], delimiter))).alias(f"w{i}") for i, c in enumerate(targets)]).first()
    return {c: max(1, w or 1) for c, w in zip(targets, widths)}


def split_attributes(df: DataFrame, delimiter: str, *refs: ColRef, width: int | str | None = None) -> DataFrame:
    """R2: split fields on a literal delimiter, each part stripped of
    surrounding whitespace.

    With ``width`` the parts replace the field in place as ``name_1 ..
    name_width``; missing parts are NULL and more than ``width`` parts raise.
    ``width='auto'`` finds the width of each field in the data
    (``split_widths``, which reads ``df`` once more), so nothing is lost and
    nothing raises. Without ``width`` the field becomes an array of its parts.
    """
    targets = set(names_of(df, refs))
    if width == "auto":
        widths = split_widths(df, delimiter, *refs)
    elif isinstance(width, str):
        raise ValueError("width must be a number, 'auto' or None")
    else:
        widths = dict.fromkeys(targets, width)
    if width is not None and width != "auto":  # a filter, so that it runs whichever parts are read later
        for c in sorted(targets):
            msg = F.concat(F.lit(f"field {c} splits into more than {width} parts: "), df[c])
            over = F.coalesce(F.size(split_literal(df[c], delimiter)) > width, F.lit(False))
            df = df.filter(F.when(over, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    out: list[Column] = []
    for c in df.columns:
        if c not in targets:
            out.append(df[c])
            continue
        parts = F.transform(split_literal(df[c], delimiter), lambda p: strip_ws(p))
        if width is None:
            out.append(parts.alias(c))
        else:
            out += [F.get(parts, i).alias(f"{c}_{i + 1}") for i in range(widths[c])]
    return df.select(*out)


def fan_out(df: DataFrame, copies: int = 2) -> list[DataFrame]:
    """The same DataFrame for 2 to 5 branches, written once to the shared
    scratch folder so the branches do not recompute it, whichever executors
    are lost; ``release_scratch`` removes it. (A DataFrame is immutable, so the
    branches cannot affect each other.)"""
    if copies < 2 or copies > 5:
        raise ValueError("copies must be between 2 and 5")
    return [materialize(df, "fan_out")] * copies
