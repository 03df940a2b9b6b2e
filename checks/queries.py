"""One query per operator, over whole tables. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import corpus
from newsflow.functions import dates, encoders, ids, lexical, markup, people, urls
from newsflow.functions.elements import Page
from newsflow.functions.text import clean_text
from newsflow.operators import articles as art
from newsflow.operators import chunks, etl, evaluation, ingest, links, points, retrieval, topk
from newsflow.operators.compute import unfold
from newsflow.operators.upsert import upsert
from newsflow.plans import reports
from newsflow.plans.etl import run_etl
from newsflow.plans.search import retrieve
from newsflow.plans.vectorize import warehouse_chunks
from newsflow.schemas import WAREHOUSE_TABLES
from newsflow.session import new_folder, stage, staging
from newsflow.sources import files, topic
from newsflow.sources.warehouse import METADATA, POINTS, Warehouse
from newsflow.streaming.ingest import ingest_articles
from newsflow.streaming.live import live_metrics

QUERIES = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def hashed(name: str, alias: str | None = None):
    """A long text as its digest: the whole text counts, the result stays small."""
    return F.md5(F.col(name)).alias(alias or name)


# Sources and sinks

@query("read_seeds")
def read_seeds(spark, sf):
    url = F.col("url")
    array = F.concat(F.lit('["'), url, F.lit('", {"url": "'), url, F.lit('#seed"}]'))
    return files.seed_urls(corpus.table(spark, sf, "pages").select(array.alias("value")))


@query("read_pages")
def read_pages(spark, sf):
    return files.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", hashed("html"))


@query("read_topic")
def read_topic(spark, sf):
    path = new_folder(spark, "topic")
    sent = corpus.articles(spark, sf)
    topic.write_topic(topic.to_messages(sent), path)
    v = F.try_parse_json("value")
    received = topic.read_topic(spark, path)
    return received.select(*[F.try_variant_get(v, f"$.{name}", "string").alias(name)
                             for name in ("title", "content", "url", "source", "author", "publish_date")]).select(
        "url", "source", "author", "publish_date", hashed("title"), hashed("content"))


@query("peek_topic")
def peek_topic(spark, sf):
    first = topic.peek_topic(corpus.messages(spark, sf))
    return ingest.decode_messages(first).select("seq", "status", "title")


@query("read_metadata")
def read_metadata(spark, sf):
    kept = F.try_variant_get(F.parse_json("content"), "$.content", "string")
    return corpus.shared_warehouse(spark, sf).read_metadata().select(
        "url_hash", "title", "url", F.md5(kept).alias("content"))


def _counts(warehouse: Warehouse, tables) -> DataFrame:
    parts = [warehouse.table(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t in tables]
    return functools.reduce(DataFrame.unionByName, parts)


@query("init_warehouse")
def init_warehouse(spark, sf):
    """Creating the tables again keeps what is in them."""
    warehouse = corpus.build_warehouse(spark, sf)
    warehouse.init_warehouse()
    return _counts(warehouse, WAREHOUSE_TABLES)


@query("truncate_all")
def truncate_all(spark, sf):
    """Loaded, emptied and loaded again: keys restart at 1."""
    with staging(spark):
        rows = stage(corpus.metadata(spark, sf), "rows")
        warehouse = corpus.build_warehouse(spark, sf, rows)
        warehouse.truncate_all()
        warehouse.append_metadata(rows)
    run_etl(warehouse)
    return warehouse.table("fact_articles").drop("load_id")


@query("reset_metadata")
def reset_metadata(spark, sf):
    """Filled, reset and filled with fewer articles: only those are left."""
    warehouse = corpus.new_warehouse(spark)
    rows = stage(corpus.metadata(spark, sf), "rows")
    warehouse.init_metadata()
    warehouse.append_metadata(rows)
    warehouse.reset_metadata()
    warehouse.append_metadata(rows.join(corpus.labelled_keys(spark, sf), "url_hash", "left_semi"))
    return warehouse.table(METADATA).select("url_hash", "title", "url")


@query("init_points")
def init_points(spark, sf):
    """The first width of a collection stays."""
    warehouse = corpus.shared_points(spark, sf)
    warehouse.init_points(corpus.DIM * 2)
    return warehouse.table(POINTS).select("id", F.lit(warehouse.points_dim()).alias("dim"))


@query("drop_points")
def drop_points(spark, sf):
    """Filled, dropped, created with another width and filled again."""
    warehouse = corpus.new_warehouse(spark)
    warehouse.init_points(2)
    rows = corpus.article_points(spark, sf)
    warehouse.append_points(rows(2, "old"))
    warehouse.drop_points()
    warehouse.init_points(3)
    warehouse.append_points(rows(3, "new"))
    return warehouse.table(POINTS).select("id", F.size("dense").alias("dim"), F.col("payload.title").alias("title"))


@query("upsert_table")
def upsert_table(spark, sf):
    """A collection in which the points of labelled documents are replaced and a few are new."""
    warehouse = corpus.new_warehouse(spark)
    warehouse.init_points(2)
    rows = corpus.article_points(spark, sf)
    warehouse.append_points(rows(2, "old"))
    changed = rows(2, "new").join(corpus.table(spark, sf, "labels").select(
        F.col("doc_id").alias("article_id")), F.col("payload.article_id") == F.col("article_id"), "left_semi")
    fresh = changed.withColumn("id", F.concat("id", F.lit("-more")))
    warehouse.upsert_points(changed.unionByName(fresh))
    return warehouse.table(POINTS).select("id", F.col("payload.title").alias("title"))


@query("read_testset")
def read_testset(spark, sf):
    path = new_folder(spark, "testset")
    files.write_csv(corpus.dialogue_pairs(spark, sf).select("question", "ground_truth"), path)
    return files.read_testset(spark, path)


@query("write_scores")
def write_scores(spark, sf):
    path = new_folder(spark, "scores")
    scores = evaluation.faithfulness(corpus.verdicts(spark, sf), ["model", "query_id"])
    files.write_scores(scores, path)
    return spark.read.option("header", True).schema("query_id BIGINT, faithfulness DOUBLE, model STRING").csv(
        path).select("model", "query_id", F.round("faithfulness", 6).alias("faithfulness"))


@query("upsert_points")
def upsert_points(spark, sf):
    rows = corpus.articles(spark, sf).select(
        ids.point_id(F.col("doc_id"), F.lit(0)).alias("id"), F.lit("new").alias("version"), "url", "doc_id")
    labelled = corpus.table(spark, sf, "labels").select("doc_id")
    gone = rows.select(F.concat("id", F.lit("-gone")).alias("id"), F.lit("old").alias("version"), "url")
    old = rows.join(labelled, "doc_id", "left_semi").select("id", F.lit("old").alias("version"), "url")
    return upsert(old.unionByName(gone), rows.drop("doc_id"), "id")


# Links

def _link_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select("page_id", "position", "href", *more)


@query("lnk_1")
def lnk_1(spark, sf):
    return _link_columns(links.raw_links(corpus.link_pages(spark, sf)))


@query("lnk_2")
def lnk_2(spark, sf):
    return _link_columns(links.followable_links(links.raw_links(corpus.link_pages(spark, sf))))


@query("lnk_3")
def lnk_3(spark, sf):
    return _link_columns(links.resolved_links(links.raw_links(corpus.link_pages(spark, sf))), "dst_url")


@query("lnk_4")
def lnk_4(spark, sf):
    resolved = links.resolved_links(links.raw_links(corpus.link_pages(spark, sf)))
    return _link_columns(links.same_site_links(resolved), "dst_url")


@query("extract_links")
def extract_links(spark, sf):
    return _link_columns(links.extract_links(corpus.link_pages(spark, sf)), "dst_url", "kind")


@query("crawl_frontier")
def crawl_frontier(spark, sf):
    pages = corpus.linked_pages(spark, sf)
    found = links.extract_links(pages)
    seeds = pages.agg(F.min("url").alias("url"))
    return links.crawl_frontier(found, seeds).select("url", "depth")


@query("lnk_7")
def lnk_7(spark, sf):
    return corpus.table(spark, sf, "pages").select("page_id", urls.netloc(F.col("url")).alias("domain"))


# Articles from pages

def _marked(spark, sf) -> DataFrame:
    return art.visible_pages(corpus.marked_pages(spark, sf))


@query("ext_1")
def ext_1(spark, sf):
    return art.page_texts(_marked(spark, sf)).select("page_id", "title", hashed("text"))


@query("ext_2")
def ext_2(spark, sf):
    return art.long_enough(art.page_texts(_marked(spark, sf))).select(
        "page_id", F.length("text").alias("n_chars"))


@query("ext_3")
def ext_3(spark, sf):
    names = F.split(F.col("author"), r",|\s-\s")
    return corpus.articles(spark, sf).select("doc_id", art.join_authors(names).alias("author"))


def _names(spark, sf) -> DataFrame:
    """Strings that may or may not be author names."""
    return (
        corpus.articles(spark, sf).select(F.col("doc_id").alias("k"), F.explode(F.array("author", "title", "publish_date"))
                                          .alias("name"))
        .unionByName(art.visible_pages(corpus.table(spark, sf, "pages")).select(
            (-F.col("page_id") - 1).alias("k"), markup.page_title(Page()).alias("name")))
    )


@query("is_valid_author")
def is_valid_author(spark, sf):
    return _names(spark, sf).select("k", hashed("name"), people.is_valid_author(F.col("name")).alias("valid"))


@query("ext_5")
def ext_5(spark, sf):
    pages = art.rule_texts(_marked(spark, sf)).withColumn("byline", art.join_authors(art.byline(F.col("rule_texts"))))
    kept, parked = art.park_house_name(F.col("byline"))
    return pages.select("page_id", kept.alias("author"), parked.alias("parked"))


@query("ext_6")
def ext_6(spark, sf):
    found = art.first_valid_author(art.author_candidates(F.col("rule_texts")))
    return art.rule_texts(_marked(spark, sf)).select("page_id", found.alias("author"))


@query("ext_7")
def ext_7(spark, sf):
    found = art.tail_author(Page())
    return _marked(spark, sf).select("page_id", found.alias("author"))


@query("ext_8")
def ext_8(spark, sf):
    return art.page_authors(_marked(spark, sf)).select("page_id", "author")


@query("ext_9")
def ext_9(spark, sf):
    return art.rule_texts(_marked(spark, sf)).select(
        "page_id", F.array_join(art.date_candidates(F.col("rule_texts")), "|").alias("candidates"))


@query("parse_publish_date")
def parse_publish_date(spark, sf):
    return corpus.date_texts(spark, sf).select(
        "event_id", F.date_format(dates.parse_publish_date(F.col("raw")), dates.STORED_FORMAT).alias("moment"))


@query("ext_11")
def ext_11(spark, sf):
    return art.page_dates(_marked(spark, sf)).select("page_id", "publish_date")


@query("extract_articles")
def extract_articles(spark, sf):
    return art.extract_articles(corpus.marked_pages(spark, sf)).select(
        "url", "title", hashed("content"), "source", "author", "publish_date")


# Ingest

@query("ing_1")
def ing_1(spark, sf):
    return ingest.decode_messages(corpus.messages(spark, sf)).select("seq", "status")


@query("ing_2")
def ing_2(spark, sf):
    return ingest.usable_messages(ingest.decode_messages(corpus.messages(spark, sf))).select("seq", "url")


@query("ing_3")
def ing_3(spark, sf):
    return ingest.usable_messages(ingest.decode_messages(corpus.messages(spark, sf))).select(
        "seq", "title", "author", "publish_date")


@query("url_key")
def url_key(spark, sf):
    return corpus.articles(spark, sf).select("doc_id", urls.url_key(F.col("url")).alias("url_hash"))


def _metadata_columns(df: DataFrame) -> DataFrame:
    kept = F.try_variant_get(F.parse_json("content"), "$.content", "string")
    return df.select("url_hash", "url", "title", "author", "publish_date", F.md5(kept).alias("content"))


@query("ingest_batch")
def ingest_batch(spark, sf):
    return _metadata_columns(ingest.ingest_batch(corpus.messages(spark, sf), corpus.labelled_keys(spark, sf)))


@query("ingest_articles")
def ingest_articles_stream(spark, sf):
    folder = new_folder(spark, "stream")
    sent = corpus.messages(spark, sf)
    late = (F.col("seq") > 0) & (F.col("seq") % 2 == 1)
    for part in (~late, late):
        topic.write_topic(sent.filter(part), f"{folder}/topic")
        time.sleep(1)  # file times tell which part came first
    warehouse = Warehouse(spark, folder.rsplit("/", 1)[1].replace("-", "_"), f"{folder}/db")
    warehouse.init_metadata()
    ingest_articles(topic.stream_topic(spark, f"{folder}/topic"), warehouse, f"{folder}/checkpoint",
                    availableNow=True).awaitTermination()
    return _metadata_columns(warehouse.table(METADATA))


@query("ingest_counters")
def ingest_counters(spark, sf):
    return ingest.ingest_counters(corpus.messages(spark, sf))


@query("article_count")
def article_count(spark, sf):
    return reports.article_count(corpus.shared_warehouse(spark, sf))


# Warehouse

@query("new_articles")
def new_articles(spark, sf):
    return etl.new_articles(corpus.metadata(spark, sf), corpus.labelled_keys(spark, sf)).select("url_hash", "title")


@query("dedup_titles")
def dedup_titles(spark, sf):
    return etl.dedup_titles(corpus.metadata(spark, sf)).select("url_hash", "title")


@query("wh_3")
def wh_3(spark, sf):
    return etl.parse_articles(corpus.metadata(spark, sf)).select(
        "url_hash", "author_text", "raw_date", hashed("raw_content"), "state")


@query("gate_articles")
def gate_articles(spark, sf):
    return etl.gate_articles(etl.parse_articles(corpus.metadata(spark, sf))).select("url_hash")


@query("clean_text")
def clean(spark, sf):
    cleaned = corpus.articles(spark, sf).select("doc_id", clean_text(F.col("content")).alias("content"))
    return cleaned.select("doc_id", F.length("content").alias("n_chars"), hashed("content"))


@query("split_authors")
def split_authors(spark, sf):
    return corpus.articles(spark, sf).select(
        "doc_id", F.array_join(people.split_authors(F.col("author")), "|").alias("authors"))


@query("wh_7")
def wh_7(spark, sf):
    return corpus.articles(spark, sf).select("doc_id", urls.domain_of(F.col("url")).alias("domain"))


@query("dim_source")
def dim_source(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("dim_source").select("source_id", "domain")


@query("dim_time")
def dim_time(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("dim_time").select(
        "time_id", F.col("date").cast("string").alias("date"), "day", "month", "year")


@query("dim_content")
def dim_content(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("dim_content").select("content_id", "url_hash", hashed("content"))


@query("dim_author")
def dim_author(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("dim_author").select("author_id", "author_name")


@query("fact_articles")
def fact_articles(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("fact_articles").select(
        "article_id", "url_hash", "title", "source_id", "time_id", "content_id", "content_length")


@query("fact_article_authors")
def fact_article_authors(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("fact_article_authors").select("article_id", "author_id")


@query("wh_12")
def wh_12(spark, sf):
    return reports.key_violations(corpus.shared_warehouse(spark, sf))


@query("wh_13")
def wh_13(spark, sf):
    return etl.run_summary(etl.parse_articles(etl.dedup_titles(corpus.metadata(spark, sf))))


@query("run_etl")
def run_etl_whole(spark, sf):
    location = new_folder(spark, "warehouse")
    warehouse = Warehouse(spark, location.rsplit("/", 1)[1].replace("-", "_"), location)
    warehouse.init_metadata()
    with staging(spark):
        warehouse.append_metadata(corpus.metadata(spark, sf))
    return run_etl(warehouse)


@query("chunk_text")
def chunk_text(spark, sf):
    cleaned = corpus.articles(spark, sf).select("doc_id", clean_text(F.col("content")).alias("content"))
    return chunks.chunk_text(cleaned).select("doc_id", "chunk_index", hashed("chunk"))


@query("fact_chunks")
def fact_chunks(spark, sf):
    return corpus.shared_warehouse(spark, sf).table("fact_chunks").select(
        "chunk_id", "article_id", "chunk_index", hashed("content"))


# Vectors

@query("chunk_view")
def chunk_view(spark, sf):
    return warehouse_chunks(corpus.shared_warehouse(spark, sf)).select(
        "article_id", "chunk_index", hashed("content"), "title", "url", "publish_date", "authors")


@query("vec_2")
def vec_2(spark, sf):
    return corpus.articles(spark, sf).select(
        "doc_id", points.publish_timestamp(F.col("publish_date")).alias("publish_timestamp"))


@query("point_id")
def point_id(spark, sf):
    return corpus.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", ids.point_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("id"))


@query("new_chunks")
def new_chunks(spark, sf):
    warehouse = corpus.shared_warehouse(spark, sf)
    articles = warehouse.table("fact_articles").join(corpus.labelled_keys(spark, sf), "url_hash", "left_semi")
    held = points.with_point_id(warehouse.table("fact_chunks").join(
        articles.select("article_id"), "article_id", "left_semi"))
    return points.new_chunks(warehouse.table("fact_chunks"), held).select("id", "article_id", "chunk_index")


@query("vec_5")
def vec_5(spark, sf):
    encoded = corpus.articles(spark, sf).select(
        "doc_id", encoders.dense_vector(F.col("content"), encoders.hashing_encoder(corpus.DIM)).alias("dense"))
    return unfold(encoded, ["doc_id"], F.col("dense"), "cell", "value").select(
        "doc_id", "cell", F.round(F.col("value").cast("double"), 5).alias("value"))


@query("vec_6")
def vec_6(spark, sf):
    return unfold(corpus.articles(spark, sf), ["doc_id"], lexical.token_counts(F.col("content")), "at", "e").select(
        "doc_id", F.col("e.token").alias("token"), F.round(lexical.lexical_weight(F.col("e.n")), 6).alias("weight"))


@query("vec_7")
def vec_7(spark, sf):
    weights = points.sparse_weights(corpus.articles(spark, sf), "doc_id", "content")
    merged = points.merge_weights(weights, "doc_id")
    return merged.select("doc_id", F.explode("sparse").alias("token_id", "weight")).select(
        "doc_id", "token_id", F.round(F.col("weight").cast("double"), 5).alias("weight"))


@query("vec_8")
def vec_8(spark, sf):
    assembled = points.assemble_points(warehouse_chunks(corpus.shared_warehouse(spark, sf)),
                                       encoders.hashing_encoder(corpus.DIM))
    return assembled.select("id", "payload.article_id", "payload.chunk_index", "payload.title", "payload.url",
                            F.md5("payload.content").alias("content"), "payload.authors", "payload.publish_timestamp")


@query("vectorize")
def vectorize(spark, sf):
    stored = corpus.shared_points(spark, sf).table(POINTS)
    return stored.select("id", F.size("dense").alias("dim"), F.size("sparse").alias("tokens"),
                         F.round(lexical.norm(F.col("dense")), 4).alias("length"),
                         F.round(lexical.dot(F.col("dense"), F.sequence(F.lit(1), F.lit(corpus.DIM))), 3).alias("checksum"))


# Retrieval

@query("encode_queries")
def encode_queries(spark, sf):
    encoded = retrieval.encode_queries(corpus.questions(spark, sf), encoders.hashing_encoder(corpus.DIM),
                                       retrieval.QUERY_PREFIX + " ")
    counted = encoded.select("query_id", F.size("entries").alias("tokens"), "vector")
    return unfold(counted, ["query_id", "tokens"], F.col("vector"), "cell", "value").select(
        "query_id", "tokens", "cell", F.round(F.col("value").cast("double"), 5).alias("value"))


def _shown(hits: DataFrame, *names: str) -> DataFrame:
    """Scores to six decimals: the engines' last bits differ."""
    return hits.withColumns({name: F.round(name, 6) + 0.0 for name in names or ("score",)})


@query("dense_topk")
def dense_topk(spark, sf):
    stored = corpus.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return _shown(topk.dense_topk(corpus.centroids(spark, sf), stored))


@query("sparse_topk")
def sparse_topk(spark, sf):
    return _shown(topk.sparse_topk(corpus.encoded_questions(spark, sf), corpus.search_points(spark, sf)))


def _hybrid(spark, sf) -> DataFrame:
    return retrieval.hybrid_topk(corpus.encoded_questions(spark, sf), corpus.search_points(spark, sf))


@query("hybrid_topk")
def hybrid_topk(spark, sf):
    return _shown(_hybrid(spark, sf)).select("query_id", "id", "score", "rank")


def _shared_hybrid(spark, sf) -> DataFrame:
    return corpus.once(spark, sf, "hybrid", lambda: stage(_hybrid(spark, sf), "hybrid"))


@query("ret_5")
def ret_5(spark, sf):
    return retrieval.rerank_pool(_shared_hybrid(spark, sf)).select("query_id", "id", "rank")


def _texts(spark, sf) -> DataFrame:
    return corpus.articles(spark, sf).select(
        F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 != 0, F.col("title")).alias("title"),
        F.when(F.col("doc_id") % 4 != 0, F.col("url")).otherwise("").alias("url"), "content",
        F.create_map(F.lit("author"), F.col("author"), F.lit("title"), F.col("title")).alias("metadata"))


def _reranked(spark, sf) -> DataFrame:
    pool = retrieval.rerank_pool(_shared_hybrid(spark, sf))
    return retrieval.rerank(retrieval.with_texts(pool, corpus.questions(spark, sf), _texts(spark, sf)))


@query("rerank")
def rerank(spark, sf):
    return _shown(_reranked(spark, sf), "score", "retrieval_score").select(
        "query_id", "id", "score", "rank", "retrieval_score")


def _hits(spark, sf) -> DataFrame:
    return retrieval.project_hits(_reranked(spark, sf))


@query("ret_7")
def ret_7(spark, sf):
    return _hits(spark, sf).select("query_id", "rank", "id", "title", hashed("content"), "url", "score",
                                   F.array_join(F.map_keys("metadata"), ",").alias("fields"),
                                   F.try_element_at("metadata", F.lit("author")).alias("author"))


@query("format_context")
def format_context(spark, sf):
    return retrieval.format_context(_hits(spark, sf)).select("query_id", hashed("context"))


@query("build_prompts")
def build_prompts(spark, sf):
    contexts = retrieval.format_context(_hits(spark, sf))
    return retrieval.build_prompts(corpus.questions(spark, sf), contexts).select("query_id", "system", hashed("prompt"))


def _answers(hits: DataFrame) -> DataFrame:
    """An extractive answer: the title of the best hit."""
    return hits.filter(F.col("rank") == 1).select("query_id", F.col("title").alias("answer"))


@query("answer_records")
def answer_records(spark, sf):
    hits = stage(_hits(spark, sf), "hits")
    asked = corpus.questions(spark, sf).unionByName(corpus.table(spark, sf, "pages").select(
        (-F.col("page_id") - 1).alias("query_id"), F.col("url").alias("text")))
    records = retrieval.answer_records(asked, hits, _answers(hits))
    return records.select("query_id", "query", "summary", "total", F.array_join("results.id", ",").alias("ids"))


@query("retrieve")
def retrieve_whole(spark, sf):
    found = retrieve(corpus.questions(spark, sf), corpus.search_points(spark, sf), encoders.hashing_encoder(corpus.DIM))
    return found.prompts.join(found.hits.groupBy("query_id").agg(F.max("rank").alias("hits")), "query_id").select(
        "query_id", "hits", hashed("prompt"))


# Evaluation

MODELS = ("model-a", "model-b")


def _grid(spark, sf) -> DataFrame:
    asked = corpus.questions(spark, sf).select(
        "query_id", F.concat(F.lit(" "), "text", F.lit(" \n")).alias("question"),
        F.concat(F.lit("\t"), "text").alias("ground_truth"))
    return evaluation.eval_grid(asked, MODELS)


@query("eval_grid")
def eval_grid(spark, sf):
    return _grid(spark, sf).select("model", "query_id")


@query("eval_records")
def eval_records(spark, sf):
    hits = stage(_hits(spark, sf), "hits")
    answers = _answers(hits).withColumn("model", F.lit(MODELS[0]))
    records = evaluation.eval_records(_grid(spark, sf), hits, answers)
    return records.select("model", "query_id", "question", "answer", "ground_truth",
                          F.size("contexts").alias("n_contexts"),
                          F.md5(F.array_join("contexts", "|")).alias("contexts"))


def _rounded(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.round(name, 6))


@query("context_precision")
def context_precision(spark, sf):
    return _rounded(evaluation.context_precision(corpus.verdicts(spark, sf), ["query_id"]), "context_precision")


@query("faithfulness")
def faithfulness(spark, sf):
    return _rounded(evaluation.faithfulness(corpus.verdicts(spark, sf), ["model", "query_id"]), "faithfulness")


@query("context_recall")
def context_recall(spark, sf):
    judged = corpus.verdicts(spark, sf).withColumn("verdict", 1 - F.col("toxic"))
    return _rounded(evaluation.context_recall(judged, ["query_id"]), "context_recall")


@query("answer_relevancy")
def answer_relevancy(spark, sf):
    asked = corpus.centroids(spark, sf).withColumnRenamed("vector", "question_vector")
    generated = corpus.table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("query_id"), F.col("embedding").alias("generated_vector"))
    rows = generated.join(asked, "query_id").withColumn("noncommittal", (F.col("query_id") % 4 == 3).cast("int"))
    return _rounded(evaluation.answer_relevancy(rows, ["query_id"]), "answer_relevancy")


@query("model_scoreboard")
def model_scoreboard(spark, sf):
    judged = corpus.verdicts(spark, sf)
    scores = judged.select(
        "model",
        F.when(F.col("toxic") == 1, F.lit(float("nan"))).otherwise(F.col("verdict").cast("double")).alias("faithfulness"),
        F.when(F.col("rank") != 1, F.col("n_chars") / 1000).alias("answer_relevancy"),
        (F.col("verdict") / F.col("rank")).alias("context_precision"),
        (1 - F.col("toxic")).cast("double").alias("context_recall"),
    )
    board = evaluation.model_scoreboard(scores)
    return board.select("model", *[F.round(name, 6).alias(name) for name in evaluation.METRICS])


# Reports

@query("warehouse_metrics")
def warehouse_metrics(spark, sf):
    return reports.warehouse_metrics(corpus.shared_warehouse(spark, sf))


@query("latest_articles")
def latest_articles(spark, sf):
    return reports.latest_articles(corpus.shared_warehouse(spark, sf))


@query("latest_chunks")
def latest_chunks(spark, sf):
    return reports.latest_chunks(corpus.shared_warehouse(spark, sf))


@query("articles_by_month")
def articles_by_month(spark, sf):
    return reports.articles_by_month(corpus.shared_warehouse(spark, sf))


@query("bad_dates")
def bad_dates(spark, sf):
    return reports.bad_dates(corpus.shared_warehouse(spark, sf))


@query("live_metrics")
def live_metrics_once(spark: SparkSession, sf):
    warehouse = corpus.shared_warehouse(spark, sf)
    folder = new_folder(spark, "live")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    running = live_metrics(warehouse, name, folder, processingTime="1 second")
    try:
        deadline = time.monotonic() + 120
        while not spark.catalog.tableExists(name) and running.isActive and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        running.stop()
    return spark.table(name)
