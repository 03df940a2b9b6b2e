"""Raw articles to clean articles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates, people
from newsflow.functions.text import clean_text
from newsflow.functions.urls import domain_of
from newsflow.operators.joins import numbered_rows


def new_articles(metadata: DataFrame, fact_articles: DataFrame) -> DataFrame:
    """Raw articles that are not in the warehouse yet."""
    return metadata.join(fact_articles.select("url_hash"), "url_hash", "left_anti")


def first_per_title(keys: DataFrame) -> DataFrame:
    """The lowest url_hash of every title, NULL being one title; combined before the shuffle."""
    return keys.groupBy("title").agg(F.min("url_hash").alias("url_hash")).select("url_hash")


def dedup_titles(articles: DataFrame) -> DataFrame:
    """One row per title. The choice is made on keys alone; wide rows follow in one semi-join."""
    winners = first_per_title(articles.select("url_hash", "title"))
    return articles.join(winners, "url_hash", "left_semi")


def open_days(metadata: DataFrame, outcomes: DataFrame) -> list:
    """Days of ingest that hold an article without an outcome. Raw rows are counted by partition, no column of them is read."""
    raw = metadata.groupBy("ingest_day").agg(F.count(F.lit(1)).alias("n"))
    known = outcomes.groupBy("ingest_day").agg(F.count(F.lit(1)).alias("known"))
    left = raw.join(known, "ingest_day", "left").filter(F.col("n") > F.coalesce("known", F.lit(0)))
    return [row["ingest_day"] for row in left.select("ingest_day").collect()]


def open_articles(metadata: DataFrame, outcomes: DataFrame, days: list) -> DataFrame:
    """(url_hash, title, ingest_day, state): articles of the open days without an outcome, and those an earlier load rejected."""
    here = F.col("ingest_day").isin(days)
    fresh = metadata.filter(here).select("url_hash", "title", "ingest_day").join(
        outcomes.filter(here).select("url_hash"), "url_hash", "left_anti")
    rejected = outcomes.filter(F.col("state") != "loaded").select("url_hash", "title", "ingest_day", "state")
    return fresh.withColumn("state", F.lit(None).cast("string")).unionByName(rejected)


def title_winners(articles: DataFrame) -> DataFrame:
    """Of each title the article with the lowest url_hash, combined before the shuffle."""
    first = F.min(F.struct("url_hash", "ingest_day", "state")).alias("first")
    return articles.groupBy("title").agg(first).select("title", "first.*")


def texts_of(metadata: DataFrame, winners: DataFrame) -> DataFrame:
    """Raw articles of the winners without an outcome; of the other days' partitions nothing is read.

    ``metadata`` reads files. Winners meet it on keys, by column; the texts are then picked by file and row and do not move.
    """
    wanted = winners.filter(F.col("state").isNull()).select("url_hash", "ingest_day")
    days = [row["ingest_day"] for row in wanted.select("ingest_day").distinct().collect()]
    placed = metadata.filter(F.col("ingest_day").isin(days)).withColumns(
        {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    kept = placed.join(wanted, ["url_hash", "ingest_day"], "left_semi")
    return numbered_rows(placed, kept, "_row", "_file").drop("_file", "_row")


def _read(message: Column, url: Column) -> Column:
    """Fields and state of a parsed raw message."""
    author = F.try_variant_get(message, "$.author", "variant")
    content = F.try_variant_get(message, "$.content", "variant")
    date = F.try_variant_get(message, "$.publish_date", "variant")
    author_text = F.try_variant_get(message, "$.author", "string")
    date_text = F.try_variant_get(message, "$.publish_date", "string")
    author_kind = F.schema_of_variant(author)

    def absent(value: Column, text: Column) -> Column:
        hollow = F.when(F.schema_of_variant(value) == "STRING", text.isin("", people.UNKNOWN)).otherwise(
            text.isin("[]", "{}", "0", "false"))
        return value.isNull() | F.is_variant_null(value) | hollow

    is_object = F.coalesce(F.startswith(F.schema_of_variant(message), F.lit("OBJECT")), F.lit(False))
    is_list = F.startswith(author_kind, F.lit("ARRAY"))
    readable = (
        ((author_kind == "STRING") | is_list)
        & (content.isNull() | F.schema_of_variant(content).isin("STRING", "VOID"))
        & url.isNotNull()
    )
    state = (
        F.when(~is_object, "error")
        .when(absent(author, author_text) | absent(date, date_text), "skipped")
        .when(~readable, "error")
        .otherwise("loaded")
    )
    return F.struct(
        F.try_variant_get(message, "$.content", "string").alias("raw_content"),
        date_text.alias("raw_date"),
        author_text.alias("author_text"),
        F.when(is_list, F.try_variant_get(message, "$.author", "array<string>")).alias("author_list"),
        state.alias("state"),
    )


def parse_articles(articles: DataFrame) -> DataFrame:
    """Read the raw message once: adds ``raw_content``, ``raw_date``, ``author_text``, ``author_list``, ``state``.

    ``state`` is ``error`` for what cannot be read, ``skipped`` without author or date, else ``loaded``.
    """
    fields = F.transform(F.array(F.try_parse_json("content")), lambda message: _read(message, F.col("url")))
    kept = [name for name in ("ingest_day",) if name in articles.columns]
    return articles.select("url_hash", "title", "url", *kept, F.inline_outer(fields))


def gate_articles(parsed: DataFrame) -> DataFrame:
    """Only articles that can be read and have an author and a publish date."""
    return parsed.filter(F.col("state") == "loaded")


def clean_articles(parsed: DataFrame) -> DataFrame:
    """(url_hash, title, url, domain, date, authors, content, state); text is cleaned only where it is loaded."""
    listed = F.transform("author_list", lambda name: F.when(F.coalesce(name, F.lit("")) == "", people.UNKNOWN)
                         .otherwise(name))
    authors = F.coalesce(listed, people.split_authors(F.col("author_text")))
    return parsed.select(
        "url_hash", "title", "url",
        domain_of(F.col("url")).alias("domain"),
        dates.stored_timestamp(F.col("raw_date")).cast("date").alias("date"),
        F.array_distinct(authors).alias("authors"),
        F.when(F.col("state") == "loaded", clean_text(F.col("raw_content"))).alias("content"),
        "state", *[name for name in ("ingest_day",) if name in parsed.columns],
    )


def run_summary(parsed: DataFrame) -> DataFrame:
    """One row: articles found, loaded, skipped and failed."""
    def count(state: str):
        return F.count_if(F.col("state") == state)

    return parsed.agg(
        F.count(F.lit(1)).alias("found"),
        count("loaded").alias("loaded"),
        count("skipped").alias("skipped"),
        count("error").alias("errors"),
    )
