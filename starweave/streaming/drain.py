"""Bounded message drain, capped pull and publish on
Structured Streaming.

A drain reads whatever the source holds now (``trigger(availableNow=True)``),
writes it to a sink and stops. The checkpoint records what was read: a second
drain with the same checkpoint delivers nothing twice (the ack). The message
source is a parameter: the file source (any format) here, Kafka or another
connector where its package is installed.
"""

from __future__ import annotations

import contextlib
import warnings
from collections import namedtuple
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import StructType

from ..operators.keys import dense_key

MAX_PULL = 1000  # messages per pull, at most (the pull API's own cap)

PublishResult = namedtuple("PublishResult", "reply detail")


def pull_limit(limit) -> int:
    """M2: a positive whole number, capped at ``MAX_PULL`` as the pull API caps
    it (with a warning); anything else raises."""
    try:
        n = int(limit)
    except (TypeError, ValueError):
        n = 0
    if isinstance(limit, bool) or n <= 0 or (isinstance(limit, float) and limit != n):
        raise ValueError("message limit must be a positive integer")
    if n > MAX_PULL:
        warnings.warn(f"a pull returns at most {MAX_PULL} messages, not {n}", stacklevel=2)
    return min(n, MAX_PULL)


def capped_pulls(batch: DataFrame, limit, order: list[str], name: str = "pull_no") -> DataFrame:
    """M2: the messages of one micro-batch dealt into pulls of at most
    ``pull_limit(limit)`` messages, numbered in ``order`` from 0. Dense keys
    do the numbering, so no task holds the whole batch."""
    n = pull_limit(limit)
    keyed = dense_key(batch, order, "__message_no", start=0)
    return keyed.withColumn(name, F.expr(f"__message_no div {n}")).drop("__message_no")


def message_stream(spark: SparkSession, path: str, schema: StructType | None, *, fmt: str = "parquet",
                   limit: int | None = None, glob: str | None = None, options: dict | None = None) -> DataFrame:
    """A streaming DataFrame over a message source.

    ``limit`` (validated by ``pull_limit``) caps each micro-batch: offsets, so
    messages, per trigger for Kafka; the file source can only count files, and
    ``capped_pulls`` caps its messages.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "kafka" and schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if limit is not None:
        n = pull_limit(limit)
        reader = reader.option("maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger", n)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def drain(stream: DataFrame, sink_path: str, checkpoint: str, *, fmt: str = "parquet",
          timeout_secs: float | None = None) -> bool:
    """M1: write everything available now to ``sink_path`` and stop.

    Returns True when the drain finished within ``timeout_secs`` (None waits
    until it is done); on timeout the query is stopped, and what it committed
    stays acknowledged in the checkpoint.
    """
    q = (stream.writeStream.format(fmt)
         .option("path", sink_path)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    try:
        done = q.awaitTermination(timeout_secs) if timeout_secs is not None else q.awaitTermination()
        if done is None:
            done = True
        if q.exception() is not None:
            raise q.exception()
        return bool(done)
    finally:
        if q.isActive:
            q.stop()


def publish(stream_or_df: DataFrame, payload: Callable[[DataFrame], object] | None = None, *,
            sink: Callable[[DataFrame, int], None], checkpoint: str | None = None,
            timeout_secs: float | None = None) -> list[PublishResult]:
    """M3: publish rows as UTF-8 payloads and report an outcome per batch.

    ``payload`` maps the rows to a ``value`` column (default: the rows as
    JSON); ``sink(batch_df, batch_id)`` delivers one batch (a Kafka write, a
    table append ...). Returns one ``(reply, detail)`` per batch: ``'Y'`` and
    a note naming the batch, or ``'N'`` and the error.

    A failed batch of a stream ends the run uncommitted: the next run with
    the same ``checkpoint`` delivers it again. There is no time limit unless
    ``timeout_secs`` is given; a run that it cuts short adds a last ``'N'``
    result that says so, and what was not delivered stays for the next run.
    """
    results: list[PublishResult] = []

    def to_value(df: DataFrame) -> DataFrame:
        if payload is not None:
            return payload(df)
        return df.select(F.encode(F.to_json(F.struct(*df.columns)), "UTF-8").alias("value"))

    def one(batch: DataFrame, batch_id: int) -> None:
        out = to_value(batch)
        try:
            sink(out, batch_id)
            results.append(PublishResult("Y", f"batch {batch_id} published"))
        except Exception as e:
            results.append(PublishResult("N", f"publish of batch {batch_id} failed: {e}"))
            raise

    if not stream_or_df.isStreaming:
        with contextlib.suppress(Exception):  # the outcome says it
            one(stream_or_df, 0)
        return results
    q = (stream_or_df.writeStream.foreachBatch(one)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    done: bool | None = True
    try:
        done = q.awaitTermination() if timeout_secs is None else q.awaitTermination(timeout_secs)
    except StreamingQueryException:
        if not results or results[-1].reply != "N":  # not the sink's: an error of the stream itself
            raise
    finally:
        if q.isActive:
            q.stop()
    if done is False:
        results = [r for r in results if r.reply == "Y"]
        results.append(PublishResult("N", f"stopped after {timeout_secs} s, the rest is not published"))
    return results
