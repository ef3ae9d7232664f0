"""A message stream whose pulls are capped by messages.

Spark's file source can cap files only. ``MessageSource`` is a streaming data source whose offset is (time, file,
row): the files of a folder in order of their modification time and name, and the messages read of the last of them.
``latestOffset`` moves at most ``limit`` messages on, so every micro-batch is one pull, and the end of one is the
begin of the next. The driver lists the folder and reads the number of rows in the footers of the files at hand; tasks
read their rows, and only the row groups that hold them. The checkpoint keeps the offset: what was pulled and
committed is not pulled again.

The path is any that pyarrow opens (a local or mounted folder, ``s3://``, ``gs://``, ``hdfs://`` ...). Files are
parquet, or text with a message per line; they should appear whole (written aside, then renamed).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from .drain import MAX_PULL, pull_limit

# The source travels with its code, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "starweave_messages"
TEXT_SCHEMA = StructType([StructField("value", StringType())])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pafs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class _Rows(InputPartition):
    """Messages ``first`` to ``last`` (not included) of a file."""

    file: str
    first: int
    last: int


class MessageReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.fmt = options["path"], options.get("fmt", "parquet")
        self.limit = int(options.get("limit", MAX_PULL))
        self.schema = schema
        self.at: dict | None = None  # where the next pull begins
        self.rows: dict[tuple, int] = {}

    # ------------------------------------------------------------- offsets
    def initialOffset(self) -> dict:
        return {"time": 0, "file": "", "row": 0}

    def _files(self, start: dict) -> list[tuple[int, str, int]]:
        """(time, file, bytes) of the files from ``start`` on, in order."""
        system, path = _open(self.path)
        info = system.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(path))
        names = sorted((i.mtime_ns, i.path, i.size) for i in found
                       if i.type == pafs.FileType.File and not i.base_name.startswith(("_", ".")))
        return [n for n in names if (n[0], n[1]) >= (start["time"], start["file"])]

    def _count(self, system, name: str, key: tuple) -> int:
        if key not in self.rows:
            if self.fmt == "parquet":
                with system.open_input_file(name) as f:
                    self.rows[key] = pq.ParquetFile(f).metadata.num_rows
            else:
                self.rows[key] = sum(1 for _ in _lines(system, name))
        return self.rows[key]

    def _ahead(self, start: dict) -> Iterator[tuple[dict, _Rows]]:
        """What lies behind ``start``, file by file: (offset at its end, its rows)."""
        system, _ = _open(self.path)
        for time, name, size in self._files(start):
            n = self._count(system, name, (name, time, size))
            first = start["row"] if (time, name) == (start["time"], start["file"]) else 0
            if first < n:
                yield {"time": time, "file": name, "row": n}, _Rows(name, first, n)

    def latestOffset(self) -> dict:
        start = self.at or self.initialOffset()
        end, left = start, self.limit
        for offset, rows in self._ahead(start):
            taken = min(left, rows.last - rows.first)
            end, left = offset | {"row": rows.first + taken}, left - taken
            if not left:
                break
        return end

    def partitions(self, start: dict, end: dict) -> list[_Rows]:
        self.at = end  # also told so on a restart, with start = end
        out = []
        for offset, rows in self._ahead(start):
            place = (offset["time"], offset["file"])
            if place > (end["time"], end["file"]):
                break
            last = end["row"] if place == (end["time"], end["file"]) else rows.last
            if rows.first < last:
                out.append(_Rows(rows.file, rows.first, last))
        return out

    def commit(self, end: dict) -> None:
        """The checkpoint is the acknowledgement; the source forgets counts of files behind it."""
        self.rows = {k: n for k, n in self.rows.items() if (k[1], k[0]) >= (end["time"], end["file"])}

    # ---------------------------------------------------------------- rows
    def read(self, partition: _Rows) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = _open(self.path)
        target = to_arrow_schema(self.schema)
        if self.fmt == "parquet":
            yield from _parquet_rows(system, partition, target)
        else:
            lines = [x for i, x in enumerate(_lines(system, partition.file, partition.last)) if i >= partition.first]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], [target.names[0]]).cast(target)


def _lines(system, name: str, most: int | None = None) -> Iterator[str]:
    with system.open_input_stream(name) as f:
        for i, line in enumerate(_split(f)):
            if most is not None and i >= most:
                return
            yield line


def _split(stream) -> Iterator[str]:
    """The lines of a byte stream, by blocks; the last one need not end with a newline."""
    rest = b""
    while block := stream.read(1 << 20):
        *lines, rest = (rest + block).split(b"\n")
        for line in lines:
            yield line.decode("utf-8", "replace")
    if rest:
        yield rest.decode("utf-8", "replace")


def _parquet_rows(system, rows: _Rows, target: pa.Schema) -> Iterator[pa.RecordBatch]:
    with system.open_input_file(rows.file) as f:
        file, begin = pq.ParquetFile(f), 0
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            a, b = max(rows.first - begin, 0), min(rows.last - begin, n)
            begin += n
            if a >= b:
                continue
            for batch in file.iter_batches(row_groups=[g], columns=target.names):
                if a < batch.num_rows and b > 0:
                    part = batch.slice(max(a, 0), min(b, batch.num_rows) - max(a, 0))
                    yield part.select(target.names).cast(target)
                a, b = a - batch.num_rows, b - batch.num_rows
                if b <= 0:  # what lies behind the pull in its row group is not decoded
                    break


class MessageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return TEXT_SCHEMA

    def streamReader(self, schema: StructType) -> MessageReader:
        return MessageReader(dict(self.options), schema)


def pull_stream(spark: SparkSession, path: str, schema: StructType | None = None, *, limit=MAX_PULL,
                fmt: str = "parquet") -> DataFrame:
    """M2: a streaming frame over the messages under ``path`` in which every micro-batch has at most
    ``pull_limit(limit)`` of them. Without ``schema`` a message is a text in ``value``."""
    if fmt not in ("parquet", "text"):
        raise ValueError("fmt must be 'parquet' or 'text'")
    if fmt == "text" and schema is not None and len(schema) != 1:
        raise ValueError("a text message has one column")
    spark.dataSource.register(MessageSource)
    return (spark.readStream.format(NAME).schema(schema or TEXT_SCHEMA).option("path", path).option("fmt", fmt)
            .option("limit", str(pull_limit(limit))).load())


def pull(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *, every: bool = True) -> list[int]:
    """Hand each pull of ``pull_stream`` to ``handle(messages, pull number)``, and return the numbers of the pulls.
    ``every`` goes on until nothing is left; else one pull is made. A pull whose handler fails is not acknowledged: the
    next run with this checkpoint makes it again, with the same messages and number."""
    done: list[int] = []

    def one(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        done.append(batch_id)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    query = writer.start() if every else writer.trigger(availableNow=True).start()
    try:
        if every:
            query.processAllAvailable()
        else:
            query.awaitTermination()
    finally:
        query.stop()
    return done
