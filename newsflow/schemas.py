"""Table and message schemas shared by the operators."""

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

ARTICLE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("publish_date", T.StringType()),
])

# Column names of the raw table, the star schema and the vector collection.
TABLE_COLUMNS = {
    "article_metadata": "url_hash STRING, url STRING, title STRING, content STRING, author STRING, "
                        "publish_date STRING, crawled_at TIMESTAMP",
    "dim_source": "source_id BIGINT, domain STRING",
    "dim_time": "time_id BIGINT, date DATE, day INT, month INT, year INT",
    "dim_content": "content_id BIGINT, url_hash STRING, content STRING",
    "dim_author": "author_id BIGINT, author_name STRING",
    "fact_articles": "article_id BIGINT, url_hash STRING, title STRING, source_id BIGINT, time_id BIGINT, "
                     "content_id BIGINT, content_length INT",
    "fact_article_authors": "article_id BIGINT, author_id BIGINT",
    "fact_chunks": "chunk_id BIGINT, article_id BIGINT, chunk_index INT, content STRING",
    "points": "id STRING, dense ARRAY<FLOAT>, sparse MAP<INT, FLOAT>, payload STRUCT<article_id: BIGINT, "
              "chunk_index: INT, title: STRING, url: STRING, content: STRING, authors: STRING, "
              "publish_timestamp: BIGINT>",
}

# What the collection is made of: the points of every write, and the ids that a write puts in place of older ones. And what became
# of each raw article that a load read.
TABLE_COLUMNS |= {
    "points_log": TABLE_COLUMNS["points"],
    "points_replaced": "id STRING",
    "load_outcomes": "url_hash STRING, title STRING, state STRING, ingest_day DATE",
}

# Columns that tables are partitioned by if not by the load: the day of ingest, and the number of the write.
PARTITIONS = {"article_metadata": "ingest_day DATE", "points_log": "version BIGINT", "points_replaced": "version BIGINT"}

# The key on which large tables meet; they are bucketed on it when buckets are asked for.
BUCKET_KEYS = {
    "article_metadata": "url_hash",
    "dim_content": "url_hash",
    "fact_articles": "url_hash",
    "fact_article_authors": "article_id",
    "fact_chunks": "article_id",
    "points_log": "id",
    "points_replaced": "id",
}

WAREHOUSE_TABLES = ("dim_source", "dim_time", "dim_content", "dim_author",
                    "fact_articles", "fact_article_authors", "fact_chunks")
