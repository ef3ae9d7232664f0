"""Publishing with an outcome per message and a ledger that retries read.

A batch of messages is written to the ledger once, numbered. Tasks then hand their messages to the sink one by one and
return an outcome for each, ``Y`` and the sink's reply or ``N`` and the error, which Spark writes to the ledger under
(batch, attempt). Every attempt reads the ledger first and takes only messages without a ``Y``. A sink that fails for
some messages, a run that ends half-way and a stream batch that Spark hands over again all go on from there; what was
delivered is not delivered twice. Outcomes of a finished task count even if its job fails later (the file committer's
version 2 is asked for), so a retry repeats at most what one unfinished task had in hand; ``task_rows`` bounds that.
For those messages the sink gets the same ``key`` again and can drop the repeat. Spark's speculative execution would run
tasks twice on purpose, so it is refused.

The ledger is a folder on shared storage, parquet, and grows with the messages:
``messages/batch=b`` (message, value) and ``outcomes/batch=b/attempt=a`` (message, reply, detail).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

# Task functions travel with their code, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A send function: value and key of a message to the sink's reply; it raises where the message is not delivered.
Send = Callable[[bytes, str], str]
#: Opens the sink in a task.
Sink = Callable[[], AbstractContextManager[Send]]

_OUTCOME = "batch long, attempt long, message long, reply string, detail string"
TASK_ROWS = 10_000


class PublishFailed(RuntimeError):
    """Some messages of a batch were not delivered; their outcomes are in the ledger."""


def as_json(df: DataFrame) -> DataFrame:
    """The rows as UTF-8 JSON in ``value``."""
    return df.select(F.encode(F.to_json(F.struct(*df.columns)), "UTF-8").alias("value"))


def outcomes(spark: SparkSession, ledger: str) -> DataFrame:
    """(batch, attempt, message, reply, detail) of every message so far: its ``Y``, else its last ``N``."""
    tries = _outcomes(spark, ledger)
    last = F.max(F.struct((F.col("reply") == "Y").alias("done"), "attempt", "reply", "detail")).alias("o")
    return tries.groupBy("batch", "message").agg(last).select("batch", "o.attempt", "message", "o.reply", "o.detail")


def failed(spark: SparkSession, ledger: str) -> DataFrame:
    """(batch, message, value, detail) of the messages that are not delivered."""
    bad = outcomes(spark, ledger).filter("reply = 'N'")
    return bad.join(messages(spark, ledger), ["batch", "message"]).select("batch", "message", "value", "detail")


def messages(spark: SparkSession, ledger: str) -> DataFrame:
    """(batch, message, value) of every batch in the ledger."""
    path = f"{ledger}/messages"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "batch long, message long, value binary")
    return spark.read.schema("message long, value binary, batch long").parquet(path).select("batch", "message", "value")


def _outcomes(spark: SparkSession, ledger: str) -> DataFrame:
    path = f"{ledger}/outcomes"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _OUTCOME)
    return spark.read.schema("message long, reply string, detail string, batch long, attempt long").parquet(path).select(
        "batch", "attempt", "message", "reply", "detail")


def _send_task(sink: Sink, prefix: str):
    def task(rows):
        with sink() as send:
            for batch in rows:
                replies, details = [], []
                for message, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    try:
                        detail = send(value, f"{prefix}-{message}")
                        replies.append("Y")
                    except Exception as e:
                        detail = f"{type(e).__name__}: {e}"
                        replies.append("N")
                    details.append(None if detail is None else str(detail))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(replies, pa.string()), pa.array(details, pa.string())], ["message", "reply", "detail"])

    return task


def publish_batch(spark: SparkSession, values: Callable[[], DataFrame], sink: Sink, ledger: str, batch: int, *,
                  attempts: int = 1, task_rows: int = TASK_ROWS) -> int:
    """Deliver one batch as far as the ledger says it is not, in at most ``attempts`` attempts, and return how many
    messages are still not delivered. ``values`` makes its frame (value); it is called only if the ledger has no whole
    copy of the batch."""
    if str(spark.sparkContext.getConf().get("spark.speculation", "false")).lower() == "true":
        raise RuntimeError("spark.speculation would deliver messages twice: switch it off")
    at = f"{ledger}/messages/batch={batch}"
    if not path_exists(spark, f"{at}/_SUCCESS"):
        numbered = values().select(F.monotonically_increasing_id().alias("message"), F.col("value").cast("binary").alias("value"))
        numbered.write.mode("overwrite").parquet(at)
    kept = spark.read.schema("message long, value binary").parquet(at)
    left = 0
    for _ in range(attempts):
        told = _outcomes(spark, ledger).filter(F.col("batch") == batch)
        tried = told.agg(F.max("attempt")).first()[0]
        todo = kept.join(told.filter("reply = 'Y'").select("message"), "message", "left_anti") if tried else kept
        left = todo.count()
        if not left:
            return 0
        attempt = (tried or 0) + 1
        (todo.repartition(-(-left // task_rows), "message").select("message", "value")
         .mapInArrow(_send_task(sink, f"{os.path.basename(ledger.rstrip('/'))}-{batch}"), "message long, reply string, detail string")
         .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .parquet(f"{ledger}/outcomes/batch={batch}/attempt={attempt}"))
    told = _outcomes(spark, ledger).filter((F.col("batch") == batch) & (F.col("reply") == "Y"))
    return kept.join(told.select("message"), "message", "left_anti").count()


def publish_each(stream_or_df: DataFrame, sink: Sink, ledger: str, *, payload: Callable[[DataFrame], DataFrame] = as_json,
                 checkpoint: str | None = None, attempts: int = 1, task_rows: int = TASK_ROWS) -> DataFrame:
    """M3: deliver every row once and return the outcome of each message (``outcomes``).

    ``payload`` maps rows to a ``value`` column. A frame is batch 0 of its ledger; run again with the same ledger, only
    what is not delivered goes out. A stream keeps its ledger with its ``checkpoint``: a batch that is left with
    undelivered messages is not acknowledged, so the next run takes it up, and again sends only those."""
    spark = stream_or_df.sparkSession
    if not stream_or_df.isStreaming:
        publish_batch(spark, lambda: payload(stream_or_df), sink, ledger, 0, attempts=attempts, task_rows=task_rows)
        return outcomes(spark, ledger)
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint")
    missed: list[str] = []

    def one(rows: DataFrame, batch: int) -> None:
        left = publish_batch(rows.sparkSession, lambda: payload(rows), sink, ledger, batch, attempts=attempts, task_rows=task_rows)
        if left:
            missed.append(f"batch {batch}: {left} messages are not delivered")
            raise PublishFailed(missed[-1])

    query = stream_or_df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not missed:  # not the sink's: an error of the stream itself
            raise
    finally:
        query.stop()
    return outcomes(spark, ledger)


def folder_sink(path: str) -> Sink:
    """A sink that appends messages as lines to files of a folder, one file a task. A line is in the file when ``send``
    returns; its reply is the file's name."""

    @contextmanager
    def opened() -> Iterator[Send]:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        system.create_dir(at, recursive=True)
        name = f"{uuid.uuid4().hex}.txt"
        with system.open_output_stream(f"{at}/{name}") as out:

            def send(value: bytes, key: str) -> str:
                out.write(value + b"\n")
                out.flush()
                return name

            yield send

    return opened
