"""Dashboard reports over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.joins import lookup
from newsflow.sources.warehouse import METADATA, Warehouse

# List lengths of the dashboard and the mark of an unknown date.
LATEST = 20
BAD_DATES = 10
UNKNOWN = "Unknown"


def article_count(warehouse: Warehouse) -> DataFrame:
    """Number of raw articles."""
    return warehouse.report("SELECT count(*) AS n_articles FROM {article_metadata}")


def warehouse_metrics(warehouse: Warehouse) -> DataFrame:
    """Articles, chunks, raw articles without a date, and chunks per article. A load counts when its articles are there."""
    return warehouse.report("""
        SELECT articles, chunks, unknown_dates,
               CASE WHEN articles > 0 THEN bround(chunks / articles, 2) ELSE 0D END AS chunks_per_article
        FROM (SELECT (SELECT count(*) FROM {fact_articles}) AS articles,
                     (SELECT count(*) FROM {fact_chunks}
                      WHERE load_id <= (SELECT max(load_id) FROM {fact_articles})) AS chunks,
                     (SELECT count(*) FROM {article_metadata} WHERE publish_date = 'Unknown') AS unknown_dates)
    """)


def latest_articles(warehouse: Warehouse, n: int = LATEST) -> DataFrame:
    """The newest articles that have authors, with all their names.

    Keys rise with every load, so a range of the highest keys is read, pushed down to the scans; it is
    widened only while it holds fewer than ``n`` such articles.
    """
    facts = warehouse.table("fact_articles").select("article_id", "title")
    bridge = warehouse.table("fact_article_authors").select("article_id", "author_id")
    names = warehouse.table("dim_author").select("author_id", "author_name")
    highest = facts.agg(F.max("article_id")).first()[0] or 0
    span = 16 * n
    while True:
        recent = F.col("article_id") > F.lit(highest - span)
        credits = lookup(bridge.filter(recent), names, "author_id", F.col("article_id"))
        listed = (
            facts.filter(recent).join(credits, "article_id")
            .groupBy("article_id", "title")
            .agg(F.array_join(F.array_sort(F.collect_list("author_name")), " & ").alias("authors"))
            .orderBy(F.desc("article_id")).limit(n)
        )
        if span >= highest or listed.count() == n:
            return listed
        span *= 16


def latest_chunks(warehouse: Warehouse) -> DataFrame:
    """Chunks of the newest article in order."""
    return warehouse.report("""
        SELECT chunk_index, content FROM {fact_chunks}
        WHERE article_id = (SELECT max(article_id) FROM {fact_articles})
        ORDER BY chunk_index
    """)


def articles_by_month(warehouse: Warehouse) -> DataFrame:
    """Number of articles per year and month, newest first."""
    return warehouse.report("""
        SELECT t.year, t.month, count(*) AS n_articles
        FROM {dim_time} t JOIN {fact_articles} f ON t.time_id = f.time_id
        GROUP BY t.year, t.month
        ORDER BY t.year DESC, t.month DESC
    """)


def bad_dates(warehouse: Warehouse, n: int = BAD_DATES) -> DataFrame:
    """Raw articles without a date, the first of them by key."""
    return (
        warehouse.table(METADATA).filter(F.col("publish_date") == UNKNOWN)
        .orderBy("url_hash").limit(n).select("title", "url")
    )


def key_violations(warehouse: Warehouse) -> DataFrame:
    """Per table, how many key values occur more than once; zero everywhere in a sound warehouse."""
    # The unique columns of each table.
    unique = (
        ("dim_source", ["domain"]), ("dim_time", ["date"]), ("dim_content", ["url_hash"]),
        ("dim_author", ["author_name"]), ("fact_articles", ["url_hash"]),
        ("fact_article_authors", ["article_id", "author_id"]), ("fact_chunks", ["article_id", "chunk_index"]),
    )
    out = None
    for table, columns in unique:
        repeated = warehouse.table(table).groupBy(*columns).count().filter(F.col("count") > 1)
        row = repeated.agg(F.count(F.lit(1)).alias("repeated")).select(F.lit(table).alias("table_name"), "repeated")
        out = row if out is None else out.unionByName(row)
    return out


REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "article_count": article_count,
    "warehouse_metrics": warehouse_metrics,
    "latest_articles": latest_articles,
    "latest_chunks": latest_chunks,
    "articles_by_month": articles_by_month,
    "bad_dates": bad_dates,
    "key_violations": key_violations,
}


def report(warehouse: Warehouse, name: str) -> DataFrame:
    """A report by name."""
    return REPORTS[name](warehouse)
