"""Chunks to vector points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates, ids, lexical
from newsflow.functions.encoders import COLLECTION_DIM, dense_vector, hashing_encoder
from newsflow.operators.compute import unfold
from newsflow.operators.joins import lookup

# Chunks of one article that share a join key; a longer article is spread over several keys.
BLOCK = 1024


def article_authors(bridge: DataFrame, dim_author: DataFrame, separator: str = ", ") -> DataFrame:
    """(article_id, authors): distinct names in order, joined by the separator."""
    named = lookup(bridge.select("article_id", "author_id"), dim_author.select("author_id", "author_name"),
                   "author_id", F.col("article_id"))
    names = F.array_sort(F.collect_set("author_name"))
    return named.groupBy("article_id").agg(F.array_join(names, separator).alias("authors"))


def chunk_view(chunks: DataFrame, articles: DataFrame, metadata: DataFrame, times: DataFrame,
               bridge: DataFrame, dim_author: DataFrame) -> DataFrame:
    """Chunks with title, url, publish date and authors, for all chunks or only some.

    Authors are gathered per article that has chunks here, before the chunks join, so chunk text never
    enters that aggregate. Chunks are dealt out once, by article and block of 1,024 chunks, which spreads a very long
    article over many tasks; there equal ones collapse, on all their columns, and meet their article.
    """
    block = F.floor(F.col("chunk_index") / BLOCK).cast("int")
    blocks = chunks.groupBy("article_id").agg(F.max(block).alias("_last"))
    credits = article_authors(bridge.join(blocks, "article_id", "left_semi"), dim_author)
    about = (
        articles.select("article_id", "url_hash", "title", "time_id")
        .join(blocks, "article_id")
        .join(metadata.select("url_hash", "url"), "url_hash")
        .transform(lambda df: lookup(df, times.select("time_id", "date"), "time_id", F.col("article_id"), "left"))
        .join(credits, "article_id", "left")
    )
    copies = about.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    return (
        chunks.select("article_id", "chunk_index", "content", block.alias("_block"))
        .repartition("article_id", "_block").distinct()
        .join(copies, ["article_id", "_block"])
        .select(
            "article_id", "chunk_index", "content", "title", "url",
            F.coalesce(F.col("date").cast("string"), F.lit("Unknown")).alias("publish_date"),
            F.coalesce("authors", F.lit("Unknown")).alias("authors"),
        )
    )


def with_point_id(chunks: DataFrame) -> DataFrame:
    """Adds the permanent point ``id``."""
    return chunks.withColumn("id", ids.point_id(F.col("article_id"), F.col("chunk_index")))


def new_chunks(chunks: DataFrame, points: DataFrame) -> DataFrame:
    """Chunks whose point is not in the collection yet."""
    return with_point_id(chunks).join(points.select("id"), "id", "left_anti")


def publish_timestamp(publish_date: Column) -> Column:
    """Epoch seconds of a date string, 0 when unknown."""
    day = F.try_to_date(F.substring(publish_date, 1, 10), "yyyy-MM-dd")
    return dates.epoch_seconds(day)


def sparse_weights(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token_id, weight): lexical weights per text, the largest weight of equal token ids."""
    return unfold(texts, [key], lexical.sparse_entries(F.col(text)), "_at", "_e").select(
        key, F.col("_e.id").alias("token_id"), F.col("_e.weight").alias("weight"))


def merge_weights(weights: DataFrame, key: str) -> DataFrame:
    """(key, sparse map) from rows (key, token_id, weight) of any model, the largest weight of equal ids."""
    largest = weights.groupBy(key, "token_id").agg(F.max("weight").alias("weight"))
    entries = F.sort_array(F.collect_list(F.struct("token_id", F.col("weight").cast("float"))))
    return largest.groupBy(key).agg(F.map_from_entries(entries).alias("sparse"))


def sparse_vector(text: Column) -> Column:
    """Sparse map of a text, built within the row."""
    entries = F.transform(lexical.sparse_entries(text), lambda e: F.struct(
        e["id"].alias("id"), e["weight"].cast("float").alias("weight")))
    return F.map_from_entries(entries)


def assemble_points(chunks: DataFrame, encoder=None) -> DataFrame:
    """Chunk view rows to points (id, dense, sparse, payload). No shuffle."""
    factory = encoder or hashing_encoder(COLLECTION_DIM)
    rows = chunks if "id" in chunks.columns else with_point_id(chunks)
    return rows.select(
        "id",
        dense_vector(F.col("content"), factory).alias("dense"),
        sparse_vector(F.col("content")).alias("sparse"),
        F.struct(
            F.col("article_id").cast("bigint").alias("article_id"),
            F.col("chunk_index").cast("int").alias("chunk_index"),
            "title", "url", "content", "authors",
            publish_timestamp(F.col("publish_date")).alias("publish_timestamp"),
        ).alias("payload"),
    )
