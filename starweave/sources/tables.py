"""Table loads.

Targets are catalog tables that must already exist (create-never). Columns bind
by position, as ``INSERT INTO t SELECT ...`` does.

* ``load_overwrite`` — truncate then insert (the four warehouse load modes
  differ only in how the statement is sent, not in the result).
* ``load_if_empty`` — insert only into an empty table, else raise.
* ``truncate``, and ``load_procedure``: truncate + insert-select as one step,
  by a switch of the table's location.
* ``replace_view`` / ``replace_function`` — create-or-replace for the session;
  ``objects`` has the forms that the catalog keeps.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.scalars import INITCAP_SQL_BODY
from ..session import remove_path


# The catalog does not keep NOT NULL for parquet tables, so ``create_table``
# notes the required columns in this table property and every load checks them.
REQUIRED = "starweave.required"


class LoadError(RuntimeError):
    pass


def properties_of(spark: SparkSession, table: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def required_of(spark: SparkSession, table: str) -> list[str]:
    """The required columns noted with a table; else those of its spec, by its
    own name."""
    from .schemas import SPECS, required_columns

    props = properties_of(spark, table)
    if REQUIRED in props:
        return [c for c in props[REQUIRED].split(",") if c]
    short = table.split(".")[-1]
    return required_columns(short) if short in SPECS else []


def _checked(df: DataFrame, table: str) -> DataFrame:
    """``df`` under the target's column names (loads go by position), raising
    on a NULL in a required one."""
    from .schemas import require

    names = df.sparkSession.table(table).columns
    if len(names) != len(df.columns):
        raise LoadError(f"table {table} has {len(names)} columns, the load has {len(df.columns)}")
    return require(df.toDF(*names), required_of(df.sparkSession, table), table.split(".")[-1])


def ddl(schema: StructType) -> str:
    cols = []
    for f in schema.fields:
        cols.append(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}")
    return ", ".join(cols)


def create_table(spark: SparkSession, name: str, schema: StructType, *, replace: bool = False,
                 compression: str | None = None) -> None:
    """A managed parquet table in the session catalog (its files live under
    ``spark.sql.warehouse.dir``). CREATE OR REPLACE is not supported for such
    tables, so ``replace`` drops first. Every load writes with the table's
    ``compression``, Spark's own unless given."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    required = ",".join(f.name for f in schema.fields if not f.nullable)
    options = f" OPTIONS ('compression' = '{compression}')" if compression else ""
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING parquet{options} TBLPROPERTIES ('{REQUIRED}' = '{required}')")


def _must_exist(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise LoadError(f"target table {table} does not exist (tables are never created by a load)")


def _select_cols(df: DataFrame, cols: Sequence[str] | str | None) -> DataFrame:
    if cols is None or cols == "*":
        return df
    if isinstance(cols, str):
        cols = [c.strip() for c in cols.split(",")]
    return df.select(*cols)


def load_overwrite(df: DataFrame, table: str, cols: Sequence[str] | str | None = None) -> None:
    """Replace the table's rows with ``df`` (chosen columns, by
    position). The table definition is kept."""
    spark = df.sparkSession
    _must_exist(spark, table)
    _checked(_select_cols(df, cols), table).write.insertInto(table, overwrite=True)


def load_if_empty(df: DataFrame, table: str, cols: Sequence[str] | str | None = None) -> None:
    """Insert only into an empty table; raise when it has rows."""
    spark = df.sparkSession
    _must_exist(spark, table)
    if not spark.table(table).isEmpty():
        raise LoadError(f"table {table} is not empty")
    _checked(_select_cols(df, cols), table).write.insertInto(table, overwrite=False)


def truncate(spark: SparkSession, table: str) -> None:
    """O10."""
    _must_exist(spark, table)
    spark.sql(f"TRUNCATE TABLE {table}")


def location_of(spark: SparkSession, table: str) -> str:
    """Where the table's files are."""
    return next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location")


def load_procedure(spark: SparkSession, table: str, source: DataFrame, *, keep_old: bool = False) -> None:
    """Truncate + insert-select as one step.

    The rows are written to a new folder beside the table's, through a table
    of the same definition, so types are checked as in any load. Then the
    table's location is switched to it, one change in the catalog. A load that
    fails before leaves the old rows; a reader sees the old rows or the new.
    The old folder is removed after the switch; ``keep_old`` leaves it to
    readers that are still at it. ``source`` may read the table itself.
    """
    _must_exist(spark, table)
    if any(r[0] == "# Partition Information" for r in spark.sql(f"DESCRIBE TABLE {table}").collect()):
        raise LoadError(f"table {table} is partitioned: each partition has a location of its own")
    old = location_of(spark, table)
    mark = uuid.uuid4().hex[:12]
    folder, name = old.rstrip("/").rsplit("/", 1)
    new = f"{folder}/{name.split('--')[0]}--{mark}"
    stage = f"{table}__load_{mark}"
    spark.sql(f"CREATE TABLE {stage} LIKE {table} LOCATION '{new}'")  # external: dropping it leaves the files
    try:
        _checked(source, table).write.insertInto(stage, overwrite=False)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        remove_path(spark, new)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    spark.catalog.refreshTable(table)
    if not keep_old:
        remove_path(spark, old)


def replace_view(df: DataFrame, name: str) -> None:
    """O12 for views."""
    df.createOrReplaceTempView(name)


def replace_function(spark: SparkSession, name: str = "initcap_words") -> None:
    """The word INITCAP as a SQL function callable from
    ``spark.sql``; its body is a Catalyst expression, no Python."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(str STRING) RETURNS STRING RETURN {INITCAP_SQL_BODY}")


def import_csv(spark: SparkSession, table: str, path: str | Sequence[str], *, sep: str = ",",
               required: Sequence[str] | None = None, quoted_newlines: bool = True) -> None:
    """O2: load CSV files with a header into an existing table, replacing its
    rows. The table's own schema types the read, and values that do not fit
    raise. The required columns come from ``required`` or from the table (see
    ``required_of``); a NULL in one raises naming it.

    Files are split across tasks, whether or not quoted fields hold newlines
    (``records.read_csv_quoted``). ``quoted_newlines=False`` saves the look for
    such fields where the source is known to have none."""
    from .records import read_csv_quoted
    from .schemas import require
    from .text import read_csv

    _must_exist(spark, table)
    if required is None:
        required = required_of(spark, table)
    read = read_csv_quoted if quoted_newlines else read_csv
    df = read(spark, path, spark.table(table).schema, sep=sep)
    require(df, list(required), table.split(".")[-1]).write.insertInto(table, overwrite=True)
