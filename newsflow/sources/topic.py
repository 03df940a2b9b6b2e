"""The article topic: a Kafka topic, or a folder of JSON lines where there is no broker."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.schemas import ARTICLE

# Topic name and how many messages a peek shows.
TOPIC = "news_raw"
PEEK = 5


def to_messages(articles: DataFrame) -> DataFrame:
    """Article items as JSON text in ``value``; non-ASCII text is kept, absent fields are null."""
    fields = [name for name in ARTICLE.fieldNames() if name in articles.columns]
    return articles.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def write_topic(messages: DataFrame, path: str | None = None, kafka: dict[str, str] | None = None) -> None:
    """Send ``value`` to Kafka (``kafka`` holds its options), or append JSON lines to a folder."""
    values = messages.select("value")
    if kafka:
        values.write.format("kafka").options(**{"topic": TOPIC, **kafka}).save()
    else:
        values.write.mode("append").text(path)


def _kafka_messages(raw: DataFrame) -> DataFrame:
    """Messages with their arrival: time, then partition and offset."""
    return raw.select(F.col("value").cast("string").alias("value"), F.struct("timestamp", "partition", "offset").alias("seq"))


def _file_messages(lines: DataFrame) -> DataFrame:
    """Lines with the place they were read from: when the file was written, its path, and the block in it."""
    file = F.col("_metadata")
    return lines.select("value", F.struct(
        file["file_modification_time"].alias("time"), file["file_path"].alias("path"),
        file["file_block_start"].alias("block")).alias("place"))


def with_seq(messages: DataFrame) -> DataFrame:
    """Messages (value, place) of a batch with their arrival ``seq``: the place, then the line within it.

    Rows of one block are read by one task in their order, so the number Spark gives them rises within it.
    """
    return messages.select("value", F.struct(
        "place.time", "place.path", "place.block", F.monotonically_increasing_id().alias("line")).alias("seq"))


def read_topic(spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None) -> DataFrame:
    """All messages of the topic as a batch: (value, seq); ``seq`` orders them by arrival."""
    if kafka:
        options = {"subscribe": TOPIC, "startingOffsets": "earliest", **kafka}
        return _kafka_messages(spark.read.format("kafka").options(**options).load())
    return with_seq(_file_messages(spark.read.text(path)))


def stream_topic(spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None) -> DataFrame:
    """The topic as a stream from its beginning: (value, seq), or (value, place) from a folder."""
    if kafka:
        options = {"subscribe": TOPIC, "startingOffsets": "earliest", **kafka}
        return _kafka_messages(spark.readStream.format("kafka").options(**options).load())
    return _file_messages(spark.readStream.text(path))


def peek_topic(messages: DataFrame, n: int = PEEK) -> DataFrame:
    """The first ``n`` of messages (value, seq): no task hands on more than ``n``."""
    return messages.orderBy("seq").limit(n)


def peek_options(kafka: dict[str, str], n: int = PEEK) -> dict[str, str]:
    """Options of a batch read that ends ``n`` messages behind each partition's start, where the start is given by offsets.

    A start by name, such as ``earliest``, has no known end; nothing is added for it.
    """
    options = {"subscribe": TOPIC, "startingOffsets": "earliest", **kafka}
    if not options["startingOffsets"].startswith("{") or "endingOffsets" in options:
        return options
    starts = json.loads(options["startingOffsets"])
    if any(offset < 0 for parts in starts.values() for offset in parts.values()):
        return options
    ends = {topic: {part: offset + n for part, offset in parts.items()} for topic, parts in starts.items()}
    return {**options, "endingOffsets": json.dumps(ends)}


def first_of_tasks(messages: DataFrame, n: int = PEEK) -> DataFrame:
    """The first ``n`` rows of every task; a source that reads in order, such as a partition of a topic, is not read on."""
    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = n
        for batch in batches:
            yield batch.slice(0, left)
            left -= min(left, batch.num_rows)
            if not left:
                return

    return messages.mapInArrow(head, messages.schema)


def peek_kafka(spark: SparkSession, kafka: dict[str, str], n: int = PEEK) -> DataFrame:
    """The first ``n`` messages of a Kafka topic: of every partition only about its first ``n`` are read."""
    raw = spark.read.format("kafka").options(**peek_options(kafka, n)).load()
    return peek_topic(first_of_tasks(_kafka_messages(raw), n), n)


def peek_files(spark: SparkSession, path: str, n: int = PEEK) -> DataFrame:
    """The first ``n`` messages of a folder. Only as many of its oldest files are read as hold that many lines."""
    listed = spark.read.format("binaryFile").load(path).select("path", "modificationTime", "length").filter("length > 0")
    known = 1
    while True:
        oldest = [row["path"] for row in listed.orderBy("modificationTime", "path").limit(known).collect()]
        if not oldest:
            return read_topic(spark, path).limit(n)
        first = read_topic(spark, oldest)
        if len(oldest) < known or first.limit(n).count() == n:
            return peek_topic(first, n)
        known *= 4
