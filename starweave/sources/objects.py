"""Tables, views and functions of the catalog, made or replaced only if their definition changed.

Each object carries a fingerprint of its definition: tables and views as a property, functions in their comment. An
equal definition leaves the object, and a table's rows, alone. A changed one replaces it:

* a view and a function by CREATE OR REPLACE, one step of the catalog;
* a table whose new definition only adds nullable columns at the end, or other properties, is altered in place and
  keeps its rows;
* any other table is replaced by an empty one, as CREATE OR REPLACE TABLE does where the catalog has it. The session
  catalog has not, so the new table is made beside the old one and takes its name by two renames. A run that ends
  between the two is completed by the next ``define_table``, which finds the table set aside; only a definition in that
  moment does not find the name.

Functions are SQL functions: their body is a Catalyst expression, kept by the catalog for later sessions as well.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from .tables import REQUIRED, ddl, properties_of

DEFINITION = "starweave.definition"


def _fingerprint(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


def _columns(schema: StructType) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]


def _props(properties: Mapping[str, str]) -> str:
    return ", ".join(f"'{_text(k)}' = '{_text(v)}'" for k, v in properties.items())


def _text(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def define_table(spark: SparkSession, name: str, schema: StructType, properties: Mapping[str, str] | None = None) -> str:
    """Make the table, or replace it if its definition changed. Returns what was done: ``'created'``, ``'kept'``,
    ``'altered'`` or ``'replaced'``. Required columns (not nullable) are noted as ``tables.create_table`` does."""
    properties = dict(properties or {})
    aside = f"{name}__aside"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(aside):  # an earlier run ended between the renames
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    columns = _columns(schema)
    noted = properties | {
        REQUIRED: ",".join(n for n, _, nullable in columns if not nullable),
        DEFINITION: _fingerprint("table", columns, properties)}
    if not spark.catalog.tableExists(name):
        _create(spark, name, schema, noted)
        return "created"
    have = properties_of(spark, name)
    if have.get(DEFINITION) == noted[DEFINITION]:
        return "kept"
    # what a changed definition has that the table has not; the catalog keeps no NOT NULL, the property does
    old = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    required = [c for c in have.get(REQUIRED, "").split(",") if c]
    added = columns[len(old):]
    same = [(n, t) for n, t, _ in columns[: len(old)]] == old and required == [n for n, _, nullable in columns if not nullable]
    if same and all(nullable for _, _, nullable in added):
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{n}` {t}' for n, t, _ in added)})")
        gone = [k for k in have if k not in noted and k in json.loads(have.get(DEFINITION + ".keys", "[]"))]
        if gone:
            spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({', '.join(repr(k) for k in gone)})")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_props(noted | {DEFINITION + '.keys': json.dumps(sorted(properties))})})")
        return "altered"
    following = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    _create(spark, following, schema, noted)
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    return "replaced"


def _create(spark: SparkSession, name: str, schema: StructType, noted: Mapping[str, str]) -> None:
    own = [k for k in noted if k not in (REQUIRED, DEFINITION)]
    props = _props(dict(noted) | {DEFINITION + ".keys": json.dumps(sorted(own))})
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING parquet TBLPROPERTIES ({props})")


def define_view(spark: SparkSession, name: str, query: str) -> str:
    """Make the catalog view, or replace it if its text changed: ``'created'``, ``'kept'`` or ``'replaced'``."""
    mark = _fingerprint("view", query)
    there = spark.catalog.tableExists(name)
    if there and properties_of(spark, name).get(DEFINITION) == mark:
        return "kept"
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{DEFINITION}' = '{mark}') AS {query}")
    return "replaced" if there else "created"


def define_function(spark: SparkSession, name: str, parameters: Sequence[tuple[str, str]], returns: str, body: str) -> str:
    """Make the catalog's SQL function, or replace it if it changed: ``'created'``, ``'kept'`` or ``'replaced'``. It
    stays in the catalog beyond the session, where the catalog does."""
    mark = f"{DEFINITION}={_fingerprint('function', list(map(list, parameters)), returns, body)}"
    try:
        told = " ".join(r[0] for r in spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}").collect())
    except AnalysisException:
        told = None
    if told is not None and mark in told:
        return "kept"
    taken = ", ".join(f"`{p}` {t}" for p, t in parameters)
    spark.sql(f"CREATE OR REPLACE FUNCTION {name}({taken}) RETURNS {returns} COMMENT '{mark}' RETURN {body}")
    return "created" if told is None else "replaced"
