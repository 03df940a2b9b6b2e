"""Topic messages to raw articles: decode, defaults, first arrival wins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import blank
from newsflow.functions.urls import url_key
from newsflow.operators.joins import numbered_rows
from newsflow.session import stage

# What a field holds when its key is missing from the message.
UNKNOWN_TITLE = "Unknown Title"
UNKNOWN = "Unknown"


def _field(message: Column, name: str, missing: Column) -> Column:
    """A text field; the default stands in for a missing key, an explicit null stays NULL."""
    raw = F.try_variant_get(message, f"$.{name}", "variant")
    return F.when(raw.isNull(), missing).otherwise(F.try_variant_get(message, f"$.{name}", "string"))


def _read(message: Column) -> Column:
    """Status and fields of a parsed message."""
    url = F.try_variant_get(message, "$.url", "variant")
    text = F.try_variant_get(message, "$.url", "string")
    is_object = F.coalesce(F.startswith(F.schema_of_variant(message), F.lit("OBJECT")), F.lit(False))
    status = (
        F.when(~is_object, "bad")
        .when(url.isNull() | F.is_variant_null(url), "skipped")
        .when(F.schema_of_variant(url) != "STRING", "bad")
        .when(blank(text), "skipped")
        .otherwise("ok")
    )
    return F.struct(
        status.alias("status"), text.alias("url"),
        _field(message, "title", F.lit(UNKNOWN_TITLE)).alias("title"),
        _field(message, "author", F.lit(UNKNOWN)).alias("author"),
        _field(message, "publish_date", F.lit(None).cast("string")).alias("publish_date"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """(seq, value) to (seq, value, status, url, title, author, publish_date); every message is parsed once.

    ``status`` is ``bad`` for text that is no JSON object or whose url is no string, ``skipped`` without
    a url, else ``ok``.
    """
    fields = F.transform(F.array(F.try_parse_json("value")), _read)
    return messages.select("seq", "value", F.inline_outer(fields))


def usable_messages(decoded: DataFrame) -> DataFrame:
    """Messages with a url, with its key."""
    return decoded.filter(F.col("status") == "ok").withColumn("url_hash", url_key(F.col("url")))


def numbered(messages: DataFrame) -> DataFrame:
    """Adds ``row``, a number no other message of the batch has; stage or persist it before use."""
    return messages.withColumn("row", F.monotonically_increasing_id())


def first_arrivals(messages: DataFrame, known: DataFrame) -> DataFrame:
    """The message with the lowest ``seq`` of every ``url_hash`` that ``known(url_hash)`` does not hold.

    Winners are found on numbers alone, combined before the shuffle; the wide rows are then picked by
    ``row`` where they are, so any number of copies of one message spreads over all tasks.
    """
    winners = (
        messages.groupBy("url_hash").agg(F.min_by("row", "seq").alias("row"))
        .join(known.select("url_hash"), "url_hash", "left_anti")
    )
    return numbered_rows(messages, winners, "row")


def metadata_rows(messages: DataFrame) -> DataFrame:
    """Columns of ``article_metadata``; the whole raw message is kept as content."""
    return messages.select("url_hash", "url", "title", F.col("value").alias("content"), "author", "publish_date")


def ingest_batch(messages: DataFrame, known: DataFrame) -> DataFrame:
    """Rows to insert for a batch of messages (value, seq).

    Usable messages are staged: they are parsed once, and a live topic is read once.
    """
    usable = stage(numbered(usable_messages(decode_messages(messages))), "messages", compression="zstd")
    return metadata_rows(first_arrivals(usable, known))


def ingest_counters(messages: DataFrame) -> DataFrame:
    """Number of messages per status."""
    return decode_messages(messages).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
