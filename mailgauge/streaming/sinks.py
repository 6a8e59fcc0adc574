"""Starting streams: console, Parquet, and replay-safe appends of results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mailgauge.sources import committed
from mailgauge.sources.scratch import exists


def start_console(stream: DataFrame, truncate: bool = True, trigger: dict | None = None) -> StreamingQuery:
    """Print each micro-batch (update mode)."""
    return start_sink(stream, "console", trigger=trigger, truncate=truncate)


SINKS = ("console", "memory", "parquet")


def start_sink(
    stream: DataFrame,
    sink: str,
    target: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    mode: str | None = None,
    **options,
) -> StreamingQuery:
    """Start a stream into one of SINKS.

    ``console`` prints each micro-batch and ``memory`` keeps it in a table of the session, by the name ``target``, that SQL can
    query: what the console shows, for tests and small results, as it lies on the driver.  ``parquet`` appends to the directory
    ``target`` and needs a ``checkpoint``.  ``mode`` is update for the first two and append for Parquet unless given.
    """
    if sink not in SINKS:
        raise ValueError(f"sink must be one of {SINKS}, not {sink!r}")
    if sink != "console" and not target:
        raise ValueError(f"the {sink} sink needs a target")
    if sink == "parquet" and not checkpoint:
        raise ValueError("the parquet sink needs a checkpoint")
    writer = stream.writeStream.format(sink).outputMode(mode or ("append" if sink == "parquet" else "update"))
    if sink == "memory":
        writer = writer.queryName(target)
    elif sink == "parquet":
        writer = writer.option("path", target)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.options(**options).start()


def start_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> StreamingQuery:
    """Append rows to a Parquet directory, each of them exactly once; ``compression`` is the session's unless given."""
    writer = (
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    return (writer.trigger(**trigger) if trigger else writer).start(path)


def start_appending(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    result: Callable[..., DataFrame],
    mode: str,
    trigger: dict | None = None,
    with_previous: bool = False,
    fan_in: int | None = None,
) -> StreamingQuery:
    """Append ``result(batch)`` of every micro-batch to a table of batches (see ``sources.committed``).

    A batch is in the table once it is noted in the table's log.  One that is run again after a failure is
    written again if it was not noted, and left as it is if it was, so a replay leaves no row twice.  Batches of
    one checkpoint only lie in a directory: a new checkpoint needs a new one.
    ``with_previous=True`` also hands ``result`` what the batch before wrote, None if it wrote nothing; it is an error
    if the log does not know that batch.  Batches without rows leave no directory, but for the first, which has the schema.

    ``fan_in`` keeps the directories few, however long the stream runs, by merging so many at a time; 16 suits a
    stream that runs for years.  Read the result with ``read_results`` then: only without merging is every batch
    a directory that Spark reads by itself.
    """
    spark = stream.sparkSession
    if exists(spark, path):
        if not exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
            raise ValueError(f"{path} holds the batches of another checkpoint than {checkpoint}")
        committed.adopt(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        given = [None] if with_previous else []
        if given and batch_id and not committed.is_committed(session, path, batch_id):
            given = [committed.load_batch(session, path, batch_id - 1)]
        if not committed.commit(result(batch, *given), path, batch_id, fan_in):
            # The batch is run all the same, as its state has to be brought to this batch.
            batch.write.format("noop").mode("overwrite").save()

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_updates(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, fan_in: int | None = None
) -> StreamingQuery:
    """What ``start_console`` prints, stored: the rows of each micro-batch in update mode."""
    return start_appending(stream, path, checkpoint, lambda batch: batch, "update", trigger, fan_in=fan_in)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All rows written by ``start_appending``, with their ``batch_id``, merged or not."""
    return committed.load(spark, path)


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last micro-batch written by ``start_appending`` that has any.

    The log tells where they are; other batches are not looked at.
    """
    return committed.load_last(spark, path)
