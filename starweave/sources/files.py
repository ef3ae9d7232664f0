"""One text file of a given name, written in parallel.

The rows are written as Spark writes them, a part file per partition. The parts' sizes, from the file system's listing,
give every part its place in the whole by a running sum. Then the parts become one file, in their order, without a
single writer:

* a file system that can concatenate (HDFS) moves the parts' blocks together, no byte is copied;
* on a mounted file system every task writes its parts at their place in the one file, so a repeated task writes the
  same bytes to the same place.

The file is put together under a hidden name beside the target and renamed when it is whole, so a reader never meets
half a file and a failed run leaves the old one. A store that can do neither is refused.
"""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..session import path_exists, remove_path, scratch_path

# Task functions travel with their code, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that a task copies at once.
BLOCK = 8 << 20
#: Bytes of the one file that a task writes; a longer part is dealt to several tasks.
TASK_BYTES = 256 << 20


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def part_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the part files of a folder in the order of their partitions: a row a file, without its bytes."""
    fs, p = _fs(spark, folder)
    found = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in fs.listStatus(p)]
    return [(path, size) for name, path, size in sorted(found) if name.startswith("part-")]


def _local(spark: SparkSession, path: str) -> str | None:
    """The path in the mounted file system, or None where it is another store's."""
    fs, p = _fs(spark, path)
    uri = fs.makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _copy_task(target: str):
    def task(rows):
        import os

        for batch in rows:
            for part, begin, n, at in zip(*(c.to_pylist() for c in batch.columns)):
                # not truncated: other tasks write to the same file
                with open(part, "rb") as source, os.fdopen(os.open(target, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as out:
                    source.seek(begin)
                    out.seek(at)
                    while n:
                        block = source.read(min(BLOCK, n))
                        if not block:
                            raise OSError(f"{part} is shorter than it was")
                        out.write(block)
                        n -= len(block)
            yield batch.slice(0, 0)

    return task


def _places(parts: list[tuple[str, int]], most: int) -> list[tuple[str, int, int, int]]:
    """(part, first byte in it, bytes, place in the whole), no piece over ``most`` bytes."""
    out, at = [], 0
    for path, size in parts:
        for begin in range(0, size, most):
            n = min(most, size - begin)
            out.append((path, begin, n, at))
            at += n
    return out


def write_one_file(lines: DataFrame, path: str, *, mode: str = "error") -> int:
    """Write ``lines`` (one text column) as the file ``path``, in the order of the frame's partitions, and return its
    bytes. ``mode`` is ``'error'`` (the file must not be there) or ``'overwrite'``."""
    spark = lines.sparkSession
    if mode not in ("error", "overwrite"):
        raise ValueError("mode must be 'error' or 'overwrite'")
    if mode == "error" and path_exists(spark, path):
        raise FileExistsError(path)
    fs, target = _fs(spark, path)
    parent, name = target.getParent(), target.getName()
    half = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent, f".{name}.{uuid.uuid4().hex[:12]}")
    joins = fs.hasPathCapability(target, "fs.capability.paths.concat")
    local = _local(spark, path)
    if not joins and local is None:
        raise NotImplementedError(f"{fs.getScheme()} can neither concatenate files nor write into the middle of one")
    # parts that are moved must be on the target's own file system
    folder = f"{half.toString()}.parts" if joins else scratch_path(spark, "one_file")
    try:
        lines.write.text(folder)
        parts = part_files(spark, folder)
        total = sum(n for _, n in parts)
        fs.mkdirs(parent)
        if joins or not total:  # else the first task that writes makes it
            fs.create(half).close()
        if joins:
            whole = [p for p, n in parts if n]
            jvm = spark.sparkContext._jvm
            sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(whole))
            for i, p in enumerate(whole):
                sources[i] = jvm.org.apache.hadoop.fs.Path(p)
            if whole:
                fs.concat(half, sources)
        else:
            places = [(_local(spark, p), b, n, at) for p, b, n, at in _places(parts, TASK_BYTES)]
            if places:
                todo = spark.createDataFrame(places, "part string, begin long, n long, at long").repartition(len(places))
                (todo.mapInArrow(_copy_task(_local(spark, half.toString())), todo.schema)
                 .write.format("noop").mode("overwrite").save())
        if fs.getFileStatus(half).getLen() != total:
            raise OSError(f"{path}: {fs.getFileStatus(half).getLen()} bytes put together, {total} written")
        if mode == "overwrite":
            fs.delete(target, True)
        if not fs.rename(half, target):
            raise OSError(f"{path} cannot be renamed into place")
        return total
    finally:
        fs.delete(half, False)
        remove_path(spark, folder)
