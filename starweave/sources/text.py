"""Delimited text in and out.

Two ways in, as in the two routes:

* ``read_csv`` — the tables route: the whole file parsed by Spark's CSV
  source with an explicit schema, doubled quotes as escapes, leading blanks
  skipped. Files are split across tasks; newlines inside quoted fields need
  ``records.read_csv_quoted`` (split) or ``multiline=True`` (each file one task).
* ``read_lines`` + ``switch_delimiters`` + ``convert_rec`` — the files route:
  line-based text, re-delimited per line by column expressions.

Out: ``rec_to_text`` + ``write_text`` write delimiter-joined lines with no
header and no quoting, ``''`` for missing values, one file per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import quote_regex, split_literal


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType, *, header: bool = True,
             sep: str = ",", multiline: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """O1/O2: CSV with a header line, parsed against ``schema`` (never
    inferred). ``FAILFAST`` raises on a value that does not fit its type."""
    return (spark.read.schema(schema).options(**csv_options(sep))
            .option("header", header)
            .option("multiLine", multiline)
            .option("mode", mode)
            .csv(path))


def csv_options(sep: str = ",") -> dict[str, str]:
    """How the CSV of this library is read: doubled quotes as escapes, leading blanks skipped."""
    return {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true"}


def write_csv(df: DataFrame, path: str, *, sep: str = ",", mode: str = "error", quote_all: bool = False,
              compression: str | None = None) -> None:
    """CSV with a header, quoting where needed (the form ``read_csv`` reads);
    blanks at the ends of values are kept. ``quote_all`` quotes every value, so
    that leading blanks also survive the reader. Files with a ``compression``
    are read by the same readers, each file by one task."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
     .option("quoteAll", quote_all).option("zlib.compress.level", "BEST_SPEED")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
        path, compression=compression))


def read_lines(spark: SparkSession, path: str | Sequence[str], skip_header: bool = True,
               name: str = "line") -> DataFrame:
    """O1: one row per text line, as is, blank lines included. With
    ``skip_header`` the first line of every file is dropped.

    The first line of a file is the first row of the split that starts at
    byte 0: its row number is found in a pass over those splits, one number
    per file, and anti-joined. Files are split across tasks as usual.
    """
    lines = spark.read.text(path)
    if not skip_header:
        return lines.withColumnRenamed("value", name)
    at = lines.select(F.col("value").alias(name), F.col("_metadata.file_path").alias("__file"),
                      F.col("_metadata.file_block_start").alias("__start"),
                      F.monotonically_increasing_id().alias("__row"))
    heads = at.filter("__start = 0").groupBy("__file").agg(F.min("__row").alias("__row"))
    # a number a file: broadcast, so that the lines are not shuffled
    return at.join(F.broadcast(heads.select("__row")), "__row", "left_anti").select(name)


def next_quote_state(state: Column, piece: Column, at_start: str, blank: str = "^ *$") -> Column:
    """The state of the CSV text behind the quote that ends ``piece``, when ``state`` was that of the piece.

    States: ``s`` start of the record, ``u`` outside a quoted field, ``q`` inside one, ``c`` right after a closing
    quote. ``at_start`` matches a piece that ends where a field begins, ``blank`` one that has nothing but blanks.
    """
    opens = piece.rlike(at_start) | ((state == "s") & piece.rlike(blank))
    return (F.when(state == "q", "c").when((state == "c") & (piece == ""), "q")
            .when(opens, "q").otherwise("u"))


def switch_delimiters(line: Column, old: str, new: str) -> Column:
    """Re-delimit one CSV line from ``old`` to ``new``.

    Any ``new`` already in the line is removed first; the line is parsed as
    CSV (blanks right after a delimiter are skipped, a quote opens a quoted
    field only at the start of a field, a doubled quote inside one does not
    close it), the fields are joined with ``new`` and every ``"`` is deleted.
    With (',', '|') the line ``1, "Smith, J",3`` becomes ``1|Smith, J|3`` and
    ``a,5" disc,b`` becomes ``a|5 disc|b``.

    A line without any quote is split on the literal delimiter. Else one pass
    over the pieces between quotes marks each as inside or outside a quoted
    field; only outside pieces have their delimiters switched.
    """
    cleaned = F.replace(line, F.lit(new), F.lit(""))
    plain = F.array_join(F.transform(split_literal(cleaned, old), lambda f: F.ltrim(f)), new)
    pieces = F.split(cleaned, '"', -1)
    at_start = quote_regex(old) + " *$"

    # state: of the piece to come (s: start of the line, u: outside, q: quoted,
    # c: after a closing quote), and the marks of the pieces so far
    def step(acc: Column, piece: Column) -> Column:
        state = acc["state"]
        return F.struct(next_quote_state(state, piece, at_start).alias("state"),
                        F.concat(acc["marks"], F.when(state == "q", "q").otherwise("u")).alias("marks"))

    marks = F.aggregate(pieces, F.struct(F.lit("s").alias("state"), F.lit("").alias("marks")), step,
                        lambda acc: F.split(acc["marks"], ""))

    def outside(piece: Column, first: Column) -> Column:
        fields = F.transform(split_literal(piece, old), lambda f, i: F.when((i > 0) | first, F.ltrim(f)).otherwise(f))
        return F.array_join(fields, new)

    indexed = F.transform(pieces, lambda p, i: F.struct(p.alias("p"), (i == 0).alias("first")))
    quoted = F.array_join(F.zip_with(indexed, marks, lambda x, m: F.when(m == "q", x["p"]).otherwise(
        outside(x["p"], x["first"]))), "")
    return F.when(F.instr(cleaned, '"') == 0, plain).otherwise(quoted)


def convert_rec(line: Column, delimiter: str) -> Column:
    """A delimited record as an array of its fields (trailing blanks
    kept)."""
    return split_literal(line, delimiter)


def rec_fields(df: DataFrame, line: str, delimiter: str, names: Sequence[str], *,
               extra: str = "error") -> DataFrame:
    """O5 to columns: field i of the record as column ``names[i]``; ``''``
    becomes NULL, missing fields are NULL. A record with more fields than
    names raises, also when none of its columns is read later; ``extra='drop'``
    leaves the surplus away."""
    if extra not in ("error", "drop"):
        raise ValueError("extra must be 'error' or 'drop'")
    arr = convert_rec(F.col(line), delimiter)
    if extra == "error":
        msg = F.concat(F.lit(f"record has more than {len(names)} fields: "), F.col(line))
        df = df.filter(F.when(F.size(arr) > len(names), F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    cols = []
    for i, n in enumerate(names):
        v = F.get(arr, i)
        cols.append(F.when(v == "", F.lit(None)).otherwise(v).alias(n))
    return df.select(*cols)


def rec_to_text(cols: Sequence[Column], delimiter: str = "|") -> Column:
    """Fields joined by ``delimiter``; NULL written as ``''`` (``concat_ws``
    alone would drop the field and shift the rest)."""
    return F.concat_ws(delimiter, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def write_text(df: DataFrame, path: str, delimiter: str = "|", *, mode: str = "error",
               single_file: bool = False) -> None:
    """Write each row as one delimited line, one file per partition under
    the folder ``path``; with ``single_file`` as one file of that name, still
    written by many tasks (``files.write_one_file``)."""
    out = df.select(rec_to_text([df[c] for c in df.columns], delimiter).alias("value"))
    if single_file:
        from .files import write_one_file

        write_one_file(out, path, mode=mode)
    else:
        out.write.mode(mode).text(path)


def read_text_table(spark: SparkSession, path: str, names: Sequence[str], delimiter: str = "|") -> DataFrame:
    """Read back what ``write_text`` wrote: fields by position, ``''`` as
    NULL, all text."""
    return rec_fields(spark.read.text(path), "value", delimiter, names)
