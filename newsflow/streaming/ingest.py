"""Continuous ingest from the topic into the raw table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from newsflow.operators.ingest import decode_messages, metadata_rows, usable_messages
from newsflow.session import settings
from newsflow.sources.warehouse import METADATA, Warehouse

# The state of a stream lies in RocksDB files, so it may be larger than memory; its changes are what a batch uploads.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_FIELDS = ("url_hash", "url", "title", "value", "author", "publish_date")
_ORDER = ("arrived", "path", "block", "line")
_ARRIVED = T.StructType([
    *[T.StructField(name, T.StringType()) for name in _FIELDS], T.StructField("arrived", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("block", T.LongType()), T.StructField("line", T.LongType())])
_FIRST = T.StructType([T.StructField(name, T.StringType()) for name in _FIELDS])


def observe_counters(decoded: DataFrame) -> DataFrame:
    """Counts messages per status while they pass; a listener receives them per batch."""
    return decoded.observe("ingest", *[
        F.count_if(F.col("status") == status).alias(status) for status in ("ok", "skipped", "bad")])


class IngestCounters(StreamingQueryListener):
    """Adds up what each batch reports."""

    def __init__(self) -> None:
        self.totals = {"ok": 0, "skipped": 0, "bad": 0}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get("ingest")
        if row:
            for status in self.totals:
                self.totals[status] += row[status]

    def onQueryTerminated(self, event) -> None:
        pass


def _arrival(messages: DataFrame) -> Column:
    """When and where a message arrived: time, path, block or partition, offset."""
    def place(*parts: Column) -> Column:
        return F.struct(*[part.alias(name) for part, name in zip(parts, _ORDER)])

    zero, none = F.lit(0).cast("bigint"), F.lit("")
    if "place" in messages.columns:
        return place(F.unix_micros("place.time"), F.col("place.path"), F.col("place.block"), zero)
    if isinstance(messages.schema["seq"].dataType, T.StructType):
        return place(F.unix_micros("seq.timestamp"), none, F.col("seq.partition").cast("bigint"), F.col("seq.offset"))
    return place(F.col("seq").cast("bigint"), none, zero, zero)


def _first_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first message of every key in each Arrow batch, so that copies do not all cross the shuffle.

    A task reads the lines of a block in their order; they are numbered as they pass.
    """
    schema, passed = to_arrow_schema(_ARRIVED), 0
    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        lines = pa.array([line + passed + at for at, line in enumerate(columns["line"].to_pylist())], pa.int64())
        columns["line"] = lines
        passed += batch.num_rows
        first: dict[str, tuple] = {}
        for at, (key, *arrival) in enumerate(zip(*[columns[name].to_pylist() for name in ("url_hash", *_ORDER)])):
            if key not in first or (arrival, at) < first[key]:
                first[key] = (arrival, at)
        kept = pa.array(sorted(at for _, at in first.values()), pa.int64())
        yield pa.RecordBatch.from_arrays([columns[field.name].take(kept).cast(field.type) for field in schema], schema=schema)


class FirstArrival(StatefulProcessor):
    """Hands on the first message of a key that was not seen before; the state of a key is that it was."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        if not self.seen.exists():
            # nulls come last
            first = min(rows, key=lambda row: [(row[name] is None, row[name]) for name in _ORDER], default=None)
        if first is not None:
            self.seen.update((True,))
            yield Row(**{name: first[name] for name in _FIELDS})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def unseen_articles(messages: DataFrame, known: DataFrame) -> DataFrame:
    """A stream of usable messages whose key neither ``known(url_hash)``, read once at the start, nor the stream has had before."""
    usable = usable_messages(decode_messages(messages.select(_arrival(messages).alias("seq"), "value")))
    narrowed = usable.select(*_FIELDS, *[F.col(f"seq.{name}").alias(name) for name in _ORDER]).mapInArrow(_first_of_batches, _ARRIVED)
    return narrowed.groupBy("url_hash").transformWithState(
        FirstArrival(), outputStructType=_FIRST, outputMode="Append", timeMode="None", initialState=known.groupBy("url_hash"))


def ingest_articles(messages: DataFrame, warehouse: Warehouse, checkpoint: str, **trigger) -> StreamingQuery:
    """Stream (value, seq) or (value, place) into the raw table. Options of ``trigger()`` pass through.

    The keys seen so far are the state of the stream, filled once from the table with a new checkpoint; a batch costs what it holds,
    however large the table. The first batch after a start may be one that was written before a failure, so it alone is compared
    with the table and inserts only absent keys.
    """
    started: list[int] = []

    def load(batch: DataFrame, number: int) -> None:
        inside = Warehouse(batch.sparkSession, warehouse.database, buckets=warehouse.buckets)
        fresh = batch
        if not started:
            started.append(number)
            fresh = batch.join(inside.table(METADATA).select("url_hash"), "url_hash", "left_anti")
        inside.append_metadata(metadata_rows(fresh))
        warehouse.refresh(METADATA)

    spark = messages.sparkSession
    known = warehouse.table(METADATA).select("url_hash").distinct()
    with settings(spark, STATE):
        return (
            unseen_articles(messages, known).writeStream.foreachBatch(load).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )


def count_statuses(messages: DataFrame, checkpoint: str, name: str, **trigger) -> StreamingQuery:
    """Stream messages through the decoder for their counters alone."""
    arrived = messages if "seq" in messages.columns else messages.withColumn("seq", F.lit(0).cast("bigint"))
    return (
        observe_counters(decode_messages(arrived)).writeStream.format("noop").queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
