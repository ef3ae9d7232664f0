"""CSV files with newlines inside quoted fields, read in splits.

Spark's own reader takes such a file whole into one task. Here the file stays split at physical lines, and the records
are found in three steps:

1. ``line_turns`` says of every line, as a column expression, whether it ends inside a quoted field if it begins
   outside one, and if it begins inside one. Where no line that begins outside ends inside, no record has a newline,
   and the plain split reader gives the same rows.
2. Those answers form a small monoid (keep, swap, end outside, end inside), so each split folds to one of four values,
   in one pass over a byte per line, without the text. A running fold over the splits of a file, one row a split,
   gives the state in which every split begins.
3. Each split is read again from its state and cut into records by array operations: lines between record ends are
   joined with a newline. What a split has of a record begun earlier or ended later is a fragment; a record that
   crosses splits is put together from its fragments (at most two a split), the only rows that are shuffled.

The records are written once to the shared folder and parsed by ``from_csv`` with the options of ``read_csv``, so
values are typed by the same parser. Files are told apart by a 64-bit hash of their path. Lines end with \\n or \\r\\n, texts are UTF-8. A quote opens a field only at its
start (blanks may come first), a doubled quote stays inside, a quote elsewhere in a field is an ordinary character. A
quoted field that is never closed takes the rest of its file, as it does in the whole-file reader.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import quote_regex
from ..session import materialize
from .text import csv_options, next_quote_state, read_csv

# Task functions travel with their code, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a line does to the state, as two bits: its end if it begins outside, its end if it begins inside.
END_OUTSIDE, SWAP, KEEP, END_INSIDE = 0, 1, 2, 3

RECORD, HEAD, MIDDLE, TAIL = 0, 1, 2, 3  # a whole record; the end of one, a part within one, the begin of one

_BLANKS = r"[\x00-\x20]*$"


def line_turns(line: Column, sep: str = ",") -> Column:
    """What ``line`` does to the quote state: one of the four numbers above, as a byte."""
    heads = F.split(line, '"', -1)
    heads = F.slice(heads, F.lit(1), F.size(heads) - 1)  # the pieces that a quote follows
    at_start = quote_regex(sep) + _BLANKS

    def end(begin: str) -> Column:
        last = F.aggregate(heads, F.lit(begin), lambda s, p: next_quote_state(s, p, at_start, "^" + _BLANKS))
        return (last == "q").cast("tinyint")

    turn = (end("s") + end("q") * F.lit(2).cast("tinyint")).cast("tinyint")
    return F.when(F.instr(line, '"') == 0, F.lit(KEEP).cast("tinyint")).otherwise(turn)


def states_after(turns: np.ndarray, begin: int) -> np.ndarray:
    """1 where the state after a line is inside a quoted field, 0 where it is outside. The last line that ends in one
    state whatever came before it decides, with the swaps since then."""
    n = np.arange(len(turns))
    fixed = (turns == END_OUTSIDE) | (turns == END_INSIDE)
    swaps = np.cumsum(turns == SWAP) & 1
    last = np.maximum.accumulate(np.where(fixed, n, -1))
    from_fixed = (turns[last] == END_INSIDE) ^ swaps[last]
    return np.where(last >= 0, from_fixed ^ swaps, begin ^ swaps).astype(np.int8)


def _runs(file: np.ndarray, block: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one split."""
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    edges = [0, *cuts.tolist(), len(file)]
    yield from zip(edges, edges[1:])


def _fold_task(rows):
    """Lines (file, block, turn, cr) in file order to one row a split, with ``cr`` of its first line."""
    at, turn, cr = None, KEEP, False
    for batch in rows:
        if not batch.num_rows:
            continue
        file, block, turns = (batch.column(i).to_numpy() for i in range(3))
        for i, j in _runs(file, block):
            if at != (file[i], block[i]):
                if at is not None:
                    yield _folded(at, turn, cr)
                at, turn, cr = (file[i], block[i]), KEEP, batch.column(3)[i].as_py()
            ends = [int(states_after(turns[i:j], turn >> s & 1)[-1]) for s in (0, 1)]
            turn = ends[0] | ends[1] << 1
    if at is not None:
        yield _folded(at, turn, cr)


def _folded(at, turn: int, cr: bool) -> pa.RecordBatch:
    columns = [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([turn], pa.int8()), pa.array([cr])]
    return pa.RecordBatch.from_arrays(columns, ["file", "block", "turn", "cr"])


def folded_splits(lines: DataFrame) -> DataFrame:
    """(file, block, turn, cr) one row a split, from lines (file, block, turn, value). ``cr``: its first line ends with
    a carriage return."""
    narrow = lines.select("file", "block", "turn", F.endswith("value", F.lit("\r")).alias("cr"))
    return materialize(narrow.mapInArrow(_fold_task, "file long, block long, turn tinyint, cr boolean"), "csv_splits")


def split_states(folded: DataFrame) -> DataFrame:
    """(file, block) of every split that begins inside a quoted field. The last fixed split before it decides, with the
    swaps since then, as within a split."""
    w = Window.partitionBy("file").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    swaps = folded.withColumn("swaps", F.sum((F.col("turn") == SWAP).cast("long")).over(w))
    fixed = F.when(F.col("turn").isin(END_OUTSIDE, END_INSIDE), F.struct(
        "block", (F.col("turn") == END_INSIDE).cast("long").alias("inside"), "swaps"))
    seen = swaps.select("file", "block", F.max(fixed).over(before).alias("last"), F.lag("swaps", 1, 0).over(w).alias("had"))
    inside = F.coalesce(F.col("last.inside") + F.col("had") - F.col("last.swaps"), F.col("had")) % 2
    return seen.filter(inside == 1).select("file", "block")


class _Split:
    """The records of one split, line by line in blocks of lines."""

    def __init__(self, file: int, block: int, inside: bool):
        self.file, self.block = file, block
        self.begun = self.state = int(inside)
        self.open: list[str] = []  # lines of the record that is not yet ended
        self.ended = False  # has a record ended here?

    def _batch(self, values, kinds, first: bool) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, self.file)), pa.array(np.full(n, self.block)), pa.array(kinds, pa.int8()),
             pa.array([first] + [False] * (n - 1)), values], ["file", "block", "kind", "first", "value"])

    def take(self, lines: pa.Array, turns: np.ndarray) -> pa.RecordBatch | None:
        """The records that end in these lines."""
        after = states_after(turns, self.state)
        self.state = int(after[-1])
        ends = np.flatnonzero(after == 0)
        if not len(ends):
            self.open += lines.to_pylist()
            return None
        offsets = np.concatenate(([0], ends + 1)).astype(np.int32)
        values = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), "\n")
        if self.open:
            head = "\n".join([*self.open, values[0].as_py()])
            values = pa.concat_arrays([pa.array([head], values.type), values.slice(1)])
        self.open = lines.slice(int(ends[-1]) + 1).to_pylist()
        kinds = np.zeros(len(values), np.int8)
        kinds[0] = HEAD if self.begun and not self.ended else RECORD
        first = self.block == 0 and not self.ended
        self.ended = True
        return self._batch(values, kinds, first)

    def rest(self) -> pa.RecordBatch | None:
        """The record that this split leaves open."""
        if not self.open:
            return None
        kind = MIDDLE if self.begun and not self.ended else TAIL
        return self._batch(pa.array(["\n".join(self.open)], pa.string()), [kind], self.block == 0 and not self.ended)


def _records_task(rows):
    """Lines (file, block, turn, inside, line) in file order to records and fragments."""
    split = None
    for batch in rows:
        if not batch.num_rows:
            continue
        file, block, turns = (batch.column(i).to_numpy() for i in range(3))
        for i, j in _runs(file, block):
            if split is None or (split.file, split.block) != (file[i], block[i]):
                if split is not None and (out := split.rest()) is not None:
                    yield out
                split = _Split(file[i], block[i], batch.column(3)[i].as_py())
            if (out := split.take(batch.column(4).slice(i, j - i), turns[i:j])) is not None:
                yield out
    if split is not None and (out := split.rest()) is not None:
        yield out


def csv_records(spark: SparkSession, path: str | Sequence[str], *, sep: str = ",", header: bool = True) -> DataFrame | None:
    """(value) one row a CSV record, newlines in quoted fields included, read in splits; None where no record has a
    newline. With ``header`` the first record of every file is left out."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    lines = text.select(F.xxhash64(F.col("_metadata.file_path")).alias("file"),
                        F.col("_metadata.file_block_start").alias("block"), line_turns(line, sep).alias("turn"), "value")
    if lines.filter(F.col("turn").isin(SWAP, END_INSIDE)).isEmpty():
        return None
    # a row a split that begins inside a quoted field: the number of splits bounds the broadcast
    folded = folded_splits(lines)
    states = F.broadcast(materialize(split_states(folded), "csv_states").withColumn("inside", F.lit(True)))
    told = lines.join(states, ["file", "block"], "left").select(
        "file", "block", "turn", F.coalesce("inside", F.lit(False)).alias("inside"), "value")
    found = materialize(told.mapInArrow(_records_task, "file long, block long, kind tinyint, first boolean, value string"), "csv_records")
    whole = found.filter(F.col("kind") == RECORD).select("file", "first", "value")
    # fragments: a tail begins a record, a middle or head goes on with it
    parts = found.filter(F.col("kind") != RECORD).withColumn("record", F.sum((F.col("kind") == TAIL).cast("long")).over(
        Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    stitched = parts.groupBy("file", "record").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("parts")).select(
        "file", "first", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    records = whole.unionByName(stitched)
    if header:
        records = records.filter(~F.col("first"))
    # a file whose first line ends with \r\n ends its lines so; such ends become \n, as in the whole-file reader
    carriage = F.broadcast(folded.filter("block = 0 and cr").select("file", "cr"))
    plain = F.replace(F.regexp_replace("value", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    return records.join(carriage, "file", "left").select(F.when(F.col("cr"), plain).otherwise(F.col("value")).alias("value")).filter(
        "value != ''")


def read_csv_quoted(spark: SparkSession, path: str | Sequence[str], schema: StructType, *, header: bool = True,
                    sep: str = ",", mode: str = "FAILFAST") -> DataFrame:
    """O2: CSV in which quoted fields may hold newlines, typed by ``schema``, in as many tasks as the files have
    splits. See the module text."""
    records = csv_records(spark, path, sep=sep, header=header)
    if records is None:
        return read_csv(spark, path, schema, header=header, sep=sep, mode=mode)
    options = csv_options(sep) | {"mode": mode, "multiLine": "true"}
    # a field under a name of its own: the schema may have any others
    return records.select(F.from_csv("value", _ddl(schema), options).alias("rec")).select("rec.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
