"""One warehouse load, from raw articles to facts and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.chunks import chunk_rows
from newsflow.operators.etl import (clean_articles, gate_articles, new_articles, open_articles, open_days, parse_articles, run_summary,
                                    texts_of, title_winners)
from newsflow.operators.joins import lookup
from newsflow.operators.keys import new_keys
from newsflow.session import stage, staging, together
from newsflow.sources.warehouse import OUTCOMES, Warehouse

# Bits of a chunk key that hold the chunk's place in its article.
CHUNK_BITS = 24


def source_rows(clean: DataFrame, dim_source: DataFrame) -> DataFrame:
    """(source_id, domain) for domains that are new."""
    return new_keys(clean.select("domain"), dim_source, "domain", "source_id").select("source_id", "domain")


def time_rows(clean: DataFrame, dim_time: DataFrame) -> DataFrame:
    """(time_id, date, day, month, year) for dates that are new."""
    return new_keys(clean.select("date"), dim_time, "date", "time_id").select(
        "time_id", "date", F.day("date").alias("day"), F.month("date").alias("month"), F.year("date").alias("year"))


def author_rows(clean: DataFrame, dim_author: DataFrame) -> DataFrame:
    """(author_id, author_name) for names that are new."""
    names = clean.select(F.explode("authors").alias("author_name"))
    return new_keys(names, dim_author, "author_name", "author_id").select("author_id", "author_name")


def article_keys(clean: DataFrame, fact_articles: DataFrame) -> DataFrame:
    """(url_hash, article_id) for articles that are new."""
    return new_keys(clean.select("url_hash"), fact_articles, "url_hash", "article_id")


def content_rows(keyed: DataFrame) -> DataFrame:
    """``dim_content``: one row per article, keyed like the article."""
    return keyed.select(F.col("article_id").alias("content_id"), "url_hash", "content")


def fact_rows(keyed: DataFrame, dim_source: DataFrame, dim_time: DataFrame) -> DataFrame:
    """``fact_articles`` of keyed articles with their ``content_length``; a date that cannot be read has time key 0."""
    dated = dim_time.filter(F.col("date").isNotNull()).select("date", "time_id")
    spread = F.col("url_hash")
    narrow = keyed.select("article_id", "url_hash", "title", "domain", "date", "content_length")
    with_source = lookup(narrow, dim_source.select("domain", "source_id"), "domain", spread)
    return lookup(with_source, dated, "date", spread, "left").select(
        "article_id", "url_hash", "title", "source_id",
        F.coalesce("time_id", F.lit(0).cast("bigint")).alias("time_id"),
        F.col("article_id").alias("content_id"), "content_length")


def bridge_rows(keyed: DataFrame, dim_author: DataFrame) -> DataFrame:
    """``fact_article_authors``; names are distinct within an article already."""
    named = keyed.select("article_id", F.explode("authors").alias("author_name"))
    return lookup(named, dim_author.select("author_name", "author_id"), "author_name",
                  F.col("article_id")).select("article_id", "author_id")


def chunk_fact_rows(texts: DataFrame) -> DataFrame:
    """``fact_chunks``; the chunk key is article key and place, so it needs no ordering of all chunks."""
    chunk_id = F.shiftleft("article_id", CHUNK_BITS) + F.col("chunk_index")
    return chunk_rows(texts).select(chunk_id.alias("chunk_id"), "article_id", "chunk_index", "content")



def _chosen(warehouse: Warehouse, load: int) -> tuple[DataFrame, DataFrame | None]:
    """(winners, settled): the staged winners of this load, one per title, and articles whose outcome an earlier load did not note."""
    metadata, outcomes = warehouse.read_metadata(), warehouse.loaded(OUTCOMES, load)
    facts = warehouse.loaded("fact_articles", load)
    days = open_days(metadata, outcomes)
    found = open_articles(metadata, outcomes, days)
    # outcomes are written after the facts: a load may have died between the two
    noted = {row["load_id"] for row in outcomes.select("load_id").distinct().collect()}
    missing = [row["load_id"] for row in facts.select("load_id").distinct().collect() if row["load_id"] not in noted]
    settled = None
    if missing:
        found = stage(found, "open")
        there = facts.filter(F.col("load_id").isin(missing))
        settled = stage(found.filter(F.col("state").isNull()).join(there.select("url_hash"), "url_hash", "left_semi"), "settled")
        found = new_articles(found, there)
    return stage(title_winners(found), "winners"), settled


def run_etl(warehouse: Warehouse) -> DataFrame:
    """Load all new raw articles; returns one row: found, loaded, skipped, errors.

    Read articles are staged once, with their state, and every table is filled from there by column. Text
    meets its key in one join, for ``dim_content``; chunks are cut from what that wrote.
    ``fact_articles`` is written last: until then the load does not count, and a repeated run replaces
    its partitions. The outcome of every article read is noted behind that, so that days whose articles all have one are not
    looked at again, and rejected ones count in later summaries without being read.
    """
    spark = warehouse.spark
    warehouse.init_warehouse()
    load = warehouse.next_load()

    def known(table: str) -> DataFrame:
        return warehouse.loaded(table, load)

    with staging(spark):
        winners, settled = _chosen(warehouse, load)
        read = stage(clean_articles(parse_articles(texts_of(warehouse.read_metadata(), winners))), "articles", compression="zstd")
        clean = gate_articles(read)

        def fill(table: str, rows) -> None:
            warehouse.write_load(table, rows(clean, known(table)), load)

        *_, keys = together(
            lambda: fill("dim_source", source_rows),
            lambda: fill("dim_time", time_rows),
            lambda: fill("dim_author", author_rows),
            lambda: article_keys(clean, known("fact_articles")),
        )
        keyed = clean.join(keys, "url_hash")
        # texts are measured before the join, which they then do not enter
        measured = clean.withColumn("content_length", F.length("content")).drop("content").join(keys, "url_hash")
        now = load + 1

        def fill_texts() -> None:
            warehouse.write_load("dim_content", content_rows(keyed), load)
            written = warehouse.table("dim_content").filter(F.col("load_id") == load)
            texts = written.select(F.col("content_id").alias("article_id"), "content")
            warehouse.write_load("fact_chunks", chunk_fact_rows(texts), load)

        def fill_bridge() -> None:
            rows = bridge_rows(measured, warehouse.loaded("dim_author", now))
            warehouse.write_load("fact_article_authors", rows, load)

        together(fill_texts, fill_bridge)
        warehouse.write_load("fact_articles", fact_rows(
            measured, warehouse.loaded("dim_source", now), warehouse.loaded("dim_time", now)), load)
        outcomes = read.select("url_hash", "title", "state", "ingest_day")
        if settled is not None:
            outcomes = outcomes.unionByName(settled.withColumn("state", F.lit("loaded")))
        warehouse.write_load(OUTCOMES, outcomes, load)
        rejected = winners.filter(F.col("state").isNotNull()).select("state")
        summary = run_summary(read.select("state").unionByName(rejected))
        return spark.createDataFrame(summary.collect(), summary.schema)
