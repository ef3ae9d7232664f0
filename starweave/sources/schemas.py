"""Table schemas of the star model and the schema check.

Spark drops ``nullable=False`` when it reads files and lets NULL into a NOT
NULL column of a parquet table, so required columns are checked by the plan
itself: ``require`` adds a filter whose condition raises on a NULL. As a filter
the check runs even when the column is not selected later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

_T = {"STRING": StringType(), "INT64": LongType(), "FLOAT64": DoubleType()}


def schema_of(spec: Sequence[tuple[str, str, bool]]) -> StructType:
    """StructType from (name, warehouse type, required)."""
    return StructType([StructField(n, _T[t], not req) for n, t, req in spec])


# Column names, warehouse types and REQUIRED flags of the
# staging and model tables, in table order.
SPECS: dict[str, list[tuple[str, str, bool]]] = {
    "s_performances": [
        ("performance_id", "STRING", True), ("competition_nm", "STRING", True),
        ("program_event_nm", "STRING", True), ("skater_nm", "STRING", True), ("nationality", "STRING", True),
        ("event_perf_rank_nbr", "INT64", True), ("event_perf_seq_nbr", "INT64", True),
        ("segment_score", "FLOAT64", True), ("element_score", "FLOAT64", True),
        ("component_score", "FLOAT64", True), ("deductions", "FLOAT64", True),
    ],
    "s_judges": [
        ("clean_judge_nm", "STRING", True), ("judge_affiliation_nm", "STRING", True), ("judge_nm", "STRING", True),
        ("role", "STRING", True), ("program_event_nm", "STRING", True), ("competition_nm", "STRING", True),
        ("clean_role", "STRING", True), ("nationality", "STRING", True),
    ],
    "s_judged_aspects": [
        ("judged_aspect_id", "STRING", True), ("performance_id", "STRING", True),
        ("aspect_type_nm", "STRING", True), ("perf_aspect_seq_nbr", "FLOAT64", False),
        ("aspect_desc", "STRING", True), ("info_flag", "STRING", False), ("credit_flag", "STRING", False),
        ("base_difficulty", "FLOAT64", False), ("factor", "FLOAT64", False), ("goe", "FLOAT64", False),
        ("ref", "STRING", False), ("total_score", "FLOAT64", True),
    ],
    "s_judge_scores": [
        ("judged_aspect_id", "STRING", True), ("clean_role", "STRING", True), ("score", "FLOAT64", True),
    ],
    "d_person": [
        ("person_id", "INT64", True), ("forename", "STRING", False), ("surname", "STRING", False),
        ("gender", "STRING", False), ("nationality", "STRING", False),
    ],
    "d_event": [
        ("event_id", "INT64", True), ("competition_nm", "STRING", True), ("program_nm", "STRING", True),
        ("element_nm", "STRING", True), ("entries_ct", "INT64", False),
    ],
    "d_aspect": [
        ("aspect_id", "INT64", True), ("aspect_type_cd", "STRING", True), ("aspect_desc", "STRING", True),
    ],
    "f_perf": [
        ("perf_id", "INT64", True), ("event_id", "INT64", True), ("event_perf_seq_nbr", "INT64", True),
        ("skater1_id", "INT64", True), ("skater2_id", "INT64", False), ("event_perf_rank_nbr", "INT64", False),
        ("component_score", "FLOAT64", False), ("element_score", "FLOAT64", False),
        ("deductions", "FLOAT64", False),
    ],
    "f_perf_aspect": [
        ("perf_aspect_id", "INT64", True), ("perf_id", "INT64", True), ("perf_aspect_seq_nbr", "INT64", False),
        ("aspect_id", "INT64", True), ("base_difficulty", "FLOAT64", False), ("total_score", "FLOAT64", True),
    ],
    "f_perf_aspect_score": [
        ("perf_aspect_score_id", "INT64", True), ("perf_aspect_id", "INT64", True), ("judge_id", "INT64", True),
        ("score", "FLOAT64", True),
    ],
}

SCHEMAS: dict[str, StructType] = {t: schema_of(s) for t, s in SPECS.items()}


def columns_of(table: str) -> list[str]:
    return [n for n, _, _ in SPECS[table]]


def required_columns(table: str) -> list[str]:
    return [n for n, _, req in SPECS[table] if req]


def require(df: DataFrame, columns: Sequence[str], table: str = "") -> DataFrame:
    """Raise, while the plan runs, when a required column holds NULL; the
    message names the table and column."""
    if not columns:
        return df
    cond = None
    for c in columns:
        check = F.when(F.col(c).isNull(),
                       F.raise_error(F.lit(f"NULL in required column {table + '.' if table else ''}{c}"))) \
            .otherwise(F.lit(True))
        cond = check if cond is None else cond & check
    return df.filter(cond)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast ``df`` to the table's columns and types by position (ANSI casts
    raise on bad values) and check its required columns."""
    spec = SPECS[table]
    if len(df.columns) != len(spec):
        raise ValueError(f"{table} has {len(spec)} columns, got {len(df.columns)}")
    cast = df.select(*[df[c].cast(SCHEMAS[table][i].dataType).alias(spec[i][0]) for i, c in enumerate(df.columns)])
    return require(cast, required_columns(table), table)
