"""Column references: every operator accepts a name (``str``), a 0-based position
(``int``) or, where a value is allowed, a ``Column``.

Positions exist because the delimited-files route addresses fields by index;
they resolve against ``df.columns`` at plan-build time, so nothing reaches the
executors but ordinary named columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColRef = Union[str, int]

# The marker that asks KeepFields/AppendFields for a blank field.
BLANK = "x"


def name_of(df: DataFrame, ref: ColRef) -> str:
    """Resolve a reference to a column name of ``df``."""
    if isinstance(ref, bool):
        raise TypeError("a column reference cannot be a bool")
    if isinstance(ref, int):
        cols = df.columns
        if ref < 0 or ref >= len(cols):
            raise IndexError(f"column position {ref} out of range for {len(cols)} columns")
        return cols[ref]
    if isinstance(ref, str):
        if ref not in df.columns:
            raise KeyError(f"no column {ref!r} in {df.columns}")
        return ref
    raise TypeError(f"column reference must be str or int, got {type(ref).__name__}")


def names_of(df: DataFrame, refs: Iterable[ColRef]) -> list[str]:
    return [name_of(df, r) for r in refs]


def col_of(df: DataFrame, ref: ColRef) -> Column:
    """A Column bound to ``df`` (safe across self-joins)."""
    return df[name_of(df, ref)]


def parse_refs(spec: Union[None, ColRef, Sequence[ColRef]]) -> list[ColRef]:
    """Accept ``'1,2'``, ``1``, ``'name'`` or a sequence; return a list of refs.

    A string made only of digits and commas is a position list, as in the
    reference's keyword arguments (``key='0,1'``).
    """
    if spec is None:
        return []
    if isinstance(spec, (list, tuple)):
        return list(spec)
    if isinstance(spec, int):
        return [spec]
    if isinstance(spec, str):
        parts = [p.strip() for p in spec.split(",")]
        if all(p.lstrip("-").isdigit() for p in parts if p):
            return [int(p) for p in parts if p]
        return [p for p in parts if p]
    raise TypeError(f"cannot read column list from {spec!r}")


def fresh_name(taken: Iterable[str], base: str) -> str:
    """A column name based on ``base`` that is not in ``taken``."""
    taken = set(taken)
    if base not in taken:
        return base
    i = 1
    while f"{base}_{i}" in taken:
        i += 1
    return f"{base}_{i}"

