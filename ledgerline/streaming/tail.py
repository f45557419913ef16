"""Following a growing table of files."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerline.operators.filters import all_equal
from ledgerline.operators.paging import newest_first_then_oldest
from ledgerline.sources.landing import settings


def follow(spark: SparkSession, path: str, schema, files_per_batch: int = 50) -> DataFrame:
    """New rows as files arrive; offsets are kept by the checkpoint, so no row is skipped or repeated."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def payloads(stream: DataFrame, fields: list[str], **terms: str | None) -> DataFrame:
    """Filtered stream as JSON event payloads."""
    return all_equal(stream, **terms).select(F.to_json(F.struct(*fields)).alias("payload"))


def deliver(stream: DataFrame, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Write each micro-batch to its own folder under ``target``; a repeated batch writes the same folder again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def delivered(spark: SparkSession, target: str, schema) -> DataFrame:
    """What was delivered to ``target`` so far."""
    try:
        return spark.read.schema(schema).parquet(target)
    except AnalysisException as problem:  # nothing was delivered yet
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def snapshot(spark: SparkSession, path: str, schema, at: str, key: str, state: str, checkpoint: str, limit: int = 20) -> DataFrame:
    """The newest rows, oldest first, of the files there are now. The checkpoint ends right behind those files.

    Following with the same checkpoint gives every row of all later files, ties and late rows included. Each batch keeps
    its ``limit`` newest rows only.
    """
    stream = follow(spark, path, schema)
    deliver(stream, state, checkpoint, lambda rows: rows.orderBy(F.desc(at), F.desc(key)).limit(limit))
    return newest_first_then_oldest(delivered(spark, state, stream.schema), at, key, limit)


class _Idle(StreamingQueryListener):
    """Counts the triggers in a row at which a query found nothing new."""

    def __init__(self, query_id: str, triggers: int):
        self.query_id, self.triggers, self.empty = query_id, triggers, 0
        self.over = Event()

    def _found(self, query_id, rows: int) -> None:
        if str(query_id) == self.query_id:
            self.empty = 0 if rows else self.empty + 1
            if self.empty >= self.triggers:
                self.over.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._found(event.progress.id, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        self._found(event.id, 0)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.over.set()


def follow_until_idle(
    stream: DataFrame, target: str, checkpoint: str, triggers: int = 2, seconds: int = 1,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Deliver rows as they come, looking for new ones at a steady pace; ends after some triggers in a row without any.

    Rows that arrive before the last of these triggers are delivered and start the count again. Each batch has its own folder
    under ``target``; a later run with the same checkpoint goes on from there.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    with settings(spark, spark__sql__streaming__noDataProgressEventInterval=str(1000 * seconds)):  # an idle trigger is told at once
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
    idle = _Idle(query.id, triggers)
    spark.streams.addListener(idle)
    try:
        while not idle.over.wait(timeout=1.0) and query.isActive:
            pass
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
        spark.streams.removeListener(idle)
    return query


def drain(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process everything there is and stop; a later run with the same checkpoint goes on from there."""
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
