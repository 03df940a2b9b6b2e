"""Inputs derived from the given tables, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import lexical
from newsflow.functions.encoders import dense_vector, hashing_encoder
from newsflow.functions.ids import point_id
from newsflow.operators.ingest import ingest_batch
from newsflow.operators.retrieval import encode_queries
from newsflow.plans.etl import run_etl
from newsflow.plans.vectorize import vectorize
from newsflow.session import new_folder, spread, staging
from newsflow.sources.warehouse import Warehouse

DIM = 64

# One text for both engines: articles made of documents.
ARTICLES = """
    SELECT doc_id,
      'https://' || source || '.example.com/news/' || CAST(doc_id AS STRING) || '.html' AS url,
      split_part(text, chr(10), 1) AS title,
      source,
      CASE doc_id % 10 WHEN 0 THEN 'Unknown' WHEN 1 THEN '' WHEN 2 THEN 'An Lan và Bình (TTXVN)'
           WHEN 3 THEN 'Minh, Tú - Hà' ELSE 'Author ' || CAST(doc_id % 37 AS STRING) END AS author,
      CASE doc_id % 9 WHEN 0 THEN 'Unknown' WHEN 1 THEN '2024-02-30 08:00:00'
           ELSE '2024-' || lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0') || '-'
                || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') || ' 10:30:00' END AS publish_date,
      text || CASE doc_id % 7 WHEN 0 THEN ' Ảnh: AFP. Bản quyền thuộc về Báo.' ELSE '' END AS content
    FROM {documents}
"""

# Links that are easily misread, one text for both engines: unquoted, with references, hidden, with blanks in front.
LINK_PAGES = """
    SELECT page_id, url, replace(html, '<footer>',
        CASE page_id % 6 WHEN 0 THEN '<a href=/unquoted.html>u</a>'
                         WHEN 1 THEN '<a href="/x?a=1&amp;b=2&#38;c=&eacute;">r</a>'
                         WHEN 2 THEN '<!-- <a href="/hidden">h</a> --><script>s = "<a href=''/written''>"</script>'
                         WHEN 3 THEN '<a class="k" href=" /lead.html">b</a>'
                         WHEN 4 THEN '<A CLASS=k HREF=''/single''>s</A><a name="none">n</a>'
                         ELSE '' END || '<footer>') AS html
    FROM {pages}
"""

# Pages with the author and date markup of several sites, one text for both engines. What a reader finds in each is known by
# page_id: strays outside of their ancestor, text behind a child, unquoted attributes, references, nested blocks, footers.
MARKED_PAGES = """
    SELECT page_id,
      CASE page_id % 4 WHEN 3 THEN 'https://news.example.com/2023/11/05/n' || CAST(page_id AS STRING) || '.html' ELSE url END AS url,
      replace(replace(replace(html, '<title>', '<title>' ||
        CASE page_id % 3 WHEN 2 THEN 'B&aacute;o &#7843;nh&hellip; &amp;amp; ' ELSE '' END), '</head>',
        CASE page_id % 5 WHEN 0 THEN '<meta name="author" content="Dân trí">'
                         WHEN 1 THEN '<meta content="Writer ' || CAST(page_id % 41 AS STRING) || '" name=author>'
                         ELSE '' END
        || CASE page_id % 6 WHEN 0 THEN '<meta property="article:published_time" content="2026-04-06T19:33:59+07:00">'
                            WHEN 1 THEN '<meta content="31/02/2024, 10:00" name="pubdate">'
                            ELSE '' END
        || CASE page_id % 3 WHEN 0 THEN '<!-- <p class="author">Hidden One</p><time datetime="2001-01-01T01:01"> -->'
                            WHEN 1 THEN '<script>x = "<p class=tac-gia rel=''author''>Hidden Two</p></article>"</script>'
                            ELSE '' END
        || '</head>'), '</article>',
        CASE page_id % 16 WHEN 0 THEN '<div class="detail-author big"> - Lan Anh ' || CAST(page_id % 13 AS STRING) || ' • 12/3</div>'
                          WHEN 1 THEN '<p><i>Theo: Reuters</i></p>'
                          WHEN 2 THEN '<p style="text-align: right"><strong>Minh Hà</strong></p>'
                          WHEN 3 THEN '<div><a href="/tac-gia/b" title="Tú Anh">Tú Anh &amp; Bình</a></div>'
                          WHEN 4 THEN '<div><span itemprop="author"><b itemprop="name">Quang 0912 345 678</b></span></div>'
                          WHEN 5 THEN '<p class="t-a-r"><b>Mayer</b></p><p><b>Thu Trang</b></p>'
                          WHEN 6 THEN '<div class="author-info"></div><div class="menu"><span class="name">Menu Item</span></div>'
                          WHEN 7 THEN '<div class="author"><b>By</b> Lan Anh</div>'
                          WHEN 8 THEN '<div><span class=author>Hà My</span></div>'
                          WHEN 9 THEN '<p class="author">B&#7843;o Ng&#x1ECD;c &ndash; L&ecirc;</p>'
                          WHEN 10 THEN '<p class="t-a-r">x</p><p><strong>Outside Bold</strong></p>'
                          WHEN 11 THEN '<div class="right"><p>a </p><div><b>Lan Anh</b></div></div>'
                          ELSE '' END
        || CASE page_id % 7 WHEN 0 THEN '<div class="detail-time"><div>Thứ hai, 6/4/2026, 17:02</div></div>'
                            WHEN 1 THEN '<div><time datetime="14:29 06/02/2024">cũ</time></div>'
                            WHEN 2 THEN '<div><span class="date">6-4-2026</span></div>'
                            WHEN 3 THEN '<div class="bread-crumb__detail-time"></div><h2>1/1/2001</h2>'
                            WHEN 4 THEN '<div><i class=publish-date><b>Ngày</b> 7/4/2026 08:15</i></div>'
                            ELSE '' END
        || '</article>' ||
        CASE page_id % 16 WHEN 12 THEN '<div class="foot"><p><b>Contact Us</b></p></div>' ELSE '' END) AS html
    FROM {pages}
"""

# Date strings in all shapes, one text for both engines up to the names of two functions.
DATE_TEXTS = """
    SELECT event_id, CASE event_id % 7
        WHEN 0 THEN CAST(year(ts) AS STRING) || '-' || CAST(month(ts) AS STRING) || '-' || CAST(day(ts) AS STRING)
                    || 'T' || CAST(hour(ts) AS STRING) || ':' || CAST(minute(ts) AS STRING) || ':07+07:00'
        WHEN 1 THEN 'Thứ hai, ' || CAST(day(ts) AS STRING) || '/' || CAST(month(ts) AS STRING) || '/'
                    || CAST(year(ts) AS STRING) || ',   ' || CAST(hour(ts) AS STRING) || ':' || CAST(minute(ts) AS STRING)
        WHEN 2 THEN CAST(hour(ts) AS STRING) || ':' || CAST(minute(ts) AS STRING) || ' ' || CAST(day(ts) AS STRING)
                    || '/' || CAST(month(ts) AS STRING) || '/' || CAST(year(ts) AS STRING)
        WHEN 3 THEN CAST(day(ts) AS STRING) || '-' || CAST(month(ts) AS STRING) || '-' || CAST(year(ts) AS STRING)
        WHEN 4 THEN CAST(day(ts) + 28 AS STRING) || '/02/2024, 10:00'
        WHEN 5 THEN CAST(year(ts) AS STRING) || '-' || CAST(month(ts) AS STRING) || '-' || CAST(day(ts) AS STRING)
        ELSE event_type END AS raw
    FROM {events}
"""

# Pages of one site that link to each other, one text for both engines: a page takes the first word of its title as address.
LINKED_PAGES = """
    SELECT page_id, 'https://news.example.com'
      || '/' || split_part(regexp_extract(html, '<title>([^<]*)', 1), ' ', 1) AS url, html
    FROM {pages}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ARTICLES, documents=table(spark, sf_dir, "documents"))


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MARKED_PAGES, pages=table(spark, sf_dir, "pages"))


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINK_PAGES, pages=table(spark, sf_dir, "pages"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINKED_PAGES, pages=link_pages(spark, sf_dir))


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DATE_TEXTS, events=table(spark, sf_dir, "events"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic: one message per article, late copies, and lines that cannot be used.

    Every eleventh article lacks the title key and every thirteenth has an explicit null; articles of
    labelled documents arrive a second time with another title; every benchmark text comes as plain
    text, as an array, without url and with an empty url.
    """
    base = articles(spark, sf_dir)
    fields = ["content", "url", "source", "author", "publish_date", "seq"]
    named = base.withColumn("seq", F.col("doc_id") * 2)
    whole = F.to_json(F.struct("title", *fields))
    first = named.select("seq", F.when(F.col("doc_id") % 11 == 0, F.to_json(F.struct(*fields)))
                         .when(F.col("doc_id") % 13 == 0, F.to_json(
                             F.struct(F.lit(None).cast("string").alias("title"), *fields), {"ignoreNullFields": "false"}))
                         .otherwise(whole).alias("value"))
    late = (
        base.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
        .withColumn("seq", F.col("doc_id") * 2 + 1).withColumn("title", F.lit("late"))
        .select("seq", whole.alias("value"))
    )
    lines = table(spark, sf_dir, "benchmark")
    place = F.col("item_id") * 4
    odd = [
        lines.select((-place - 1).alias("seq"), F.translate("text", "\n", " ").alias("value")),
        lines.select((-place - 2).alias("seq"), F.to_json(F.array("text")).alias("value")),
        lines.select((-place - 3).alias("seq"),
                     F.to_json(F.struct(F.col("text").alias("title"), (-place - 3).alias("seq"))).alias("value")),
        lines.select((-place - 4).alias("seq"), F.to_json(F.struct(
            F.lit("").alias("url"), F.col("text").alias("title"), (-place - 4).alias("seq"))).alias("value")),
    ]
    out = first.unionByName(late)
    for part in odd:
        out = out.unionByName(part)
    return out


def no_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "url_hash STRING")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the raw table after ingesting all messages."""
    return ingest_batch(messages(spark, sf_dir), no_keys(spark))


def labelled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of articles that were loaded before: those of labelled documents."""
    known = articles(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return known.select(F.sha2("url", 256).alias("url_hash"))


_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, what: str, build):
    """Build a table set once per session and input; later queries read it."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def new_warehouse(spark: SparkSession) -> Warehouse:
    location = new_folder(spark, "warehouse")
    return Warehouse(spark, location.rsplit("/", 1)[1].replace("-", "_"), location)


def article_points(spark: SparkSession, sf_dir: str):
    """Points of all articles for a width and a title, with plain vectors."""
    named = articles(spark, sf_dir)

    def rows(dim: int, title: str) -> DataFrame:
        return named.select(
            point_id(F.col("doc_id"), F.lit(0)).alias("id"), F.array_repeat(F.lit(1.0).cast("float"), dim).alias("dense"),
            F.create_map(F.lit(1), F.lit(1.0).cast("float")).alias("sparse"),
            F.struct(F.col("doc_id").alias("article_id"), F.lit(0).alias("chunk_index"), F.lit(title).alias("title"), "url",
                     F.lit("").alias("content"), F.col("author").alias("authors"),
                     F.lit(0).cast("bigint").alias("publish_timestamp")).alias("payload"))

    return rows


def build_warehouse(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> Warehouse:
    """A new warehouse, ingested and loaded from the tables, or from the rows that ingesting them gave."""
    warehouse = new_warehouse(spark)
    warehouse.init_metadata()
    with staging(spark):
        warehouse.append_metadata(metadata(spark, sf_dir) if rows is None else rows)
    run_etl(warehouse)
    return warehouse


def shared_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return once(spark, sf_dir, "warehouse", lambda: build_warehouse(spark, sf_dir))


def shared_points(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The shared warehouse with its vector collection filled."""
    def build() -> Warehouse:
        warehouse = shared_warehouse(spark, sf_dir)
        warehouse.init_points(DIM)
        vectorize(warehouse)
        return warehouse

    return once(spark, sf_dir, "points", build)


def search_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as points with dense and sparse vectors."""
    base = articles(spark, sf_dir).select(F.col("doc_id").alias("id"), "title", "url", "content", "author")
    return base.select(
        "id", "title", "url", "content",
        dense_vector(F.col("content"), hashing_encoder(DIM)).alias("vector"),
        lexical.sparse_entries(F.col("content")).alias("entries"),
        F.create_map(F.lit("author"), F.col("author"), F.lit("title"), F.col("title")).alias("metadata"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def encoded_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_queries(questions(spark, sf_dir), hashing_encoder(DIM))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector of every label: (query_id, vector). Averages combine before the shuffle."""
    values = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("query_id"), F.posexplode("embedding").alias("at", "x"))
    means = values.groupBy("query_id", "at").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "mean")))
    return means.groupBy("query_id").agg(F.transform(ordered, lambda cell: cell["mean"]).alias("vector"))


def dialogue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn after it, matched on conversation and turn."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    said = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ground_truth"))
    return asked.join(said, ["conv_id", "turn"])


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged contexts: five documents make one question, quality is the verdict, source the model."""
    return table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id").select(
        F.col("source").alias("model"),
        F.floor(F.col("doc_id") / 5).cast("bigint").alias("query_id"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("rank"),
        F.col("quality").alias("verdict"), F.col("toxic"), "n_chars", "doc_id",
    )
