"""From two ranked lists to answers, for a table of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import lexical
from newsflow.functions.encoders import dense_vector, pair_score
from newsflow.functions.text import or_default
from newsflow.operators.topk import DENSE, SCORE_DECIMALS, SPARSE, topk
from newsflow.session import arrow_batches, stage

# List lengths, fusion weight, and what stands in for missing fields.
TOP_K = 50
RERANK_POOL = 5
ALPHA = 0.5
# Points that go to Python at a time, where their whole texts may be encoded on the way.
ARROW_ROWS = 1024
QUERY_PREFIX = "Represent this query for retrieval:"
NO_TITLE = "No Title"
NO_URL = "#"
NO_SOURCES = "Không tìm thấy nguồn tin nào liên quan đến câu hỏi của bạn."
PAYLOAD_FIELDS = ("title", "url", "content")

SYSTEM_TEMPLATE = ("You are a careful news analyst. Use only the given articles, name the article behind every "
                   "fact, prefer recent ones, and answer in Vietnamese.")
HUMAN_TEMPLATE = ("Articles:\n{context}\n\nQuestion:\n{question}\n\n"
                  "Answer from the articles alone and cite their titles. If they do not suffice, say so.")


def encode_queries(queries: DataFrame, factory, prefix: str = "") -> DataFrame:
    """(query_id, text) to (query_id, text, vector, entries); ``prefix`` is an instruction for the dense side."""
    return queries.select(
        "query_id", "text",
        dense_vector(F.concat(F.lit(prefix), F.col("text")), factory).alias("vector"),
        lexical.sparse_entries(F.col("text")).alias("entries"),
    )


def _scaled(hits: DataFrame, name: str) -> DataFrame:
    """Scores stretched to 0…1 per query; a constant list stays as it is."""
    per_query = Window.partitionBy("query_id")
    low, high = F.min("score").over(per_query), F.max("score").over(per_query)
    scaled = F.when(high == low, F.col("score")).otherwise((F.col("score") - low) / (high - low))
    return hits.select("query_id", "id", scaled.alias(name), F.col("score").alias(f"{name}_raw"))


def fuse(dense: DataFrame, sparse: DataFrame, k: int = TOP_K, alpha: float = ALPHA) -> DataFrame:
    """Relative-score fusion of two ranked lists; if one is empty for a query, the other one stands unscaled."""
    both = _scaled(dense, "d").join(_scaled(sparse, "s"), ["query_id", "id"], "full")
    per_query = Window.partitionBy("query_id")
    mixed = F.coalesce("s", F.lit(0.0)) * (1 - alpha) + F.coalesce("d", F.lit(0.0)) * alpha
    score = (
        F.when(F.count("s").over(per_query) == 0, F.col("d_raw"))
        .when(F.count("d").over(per_query) == 0, F.col("s_raw"))
        .otherwise(mixed)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("id"))
    return (
        both.select("query_id", "id", F.round(score, SCORE_DECIMALS).alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def hybrid_topk(queries: DataFrame, points: DataFrame, k: int = TOP_K, alpha: float = ALPHA) -> DataFrame:
    """Dense and sparse top-k, fused. Queries have vector and entries, points too; queries are encoded and points read once."""
    encoded = stage(queries.select("query_id", "vector", "entries"), "queries")
    with arrow_batches(points.sparkSession, ARROW_ROWS):
        hits = stage(topk(encoded, points.select("id", "vector", "entries"), k), "candidates")
    return fuse(*(hits.filter(F.col("side") == side).drop("side") for side in (DENSE, SPARSE)), k, alpha)


def rerank_pool(hits: DataFrame, n: int = RERANK_POOL) -> DataFrame:
    """The hits that are worth a costly score: the first n of each list."""
    return hits.filter(F.col("rank") <= n)


def with_texts(hits: DataFrame, queries: DataFrame, points: DataFrame) -> DataFrame:
    """Hits with payload and query text. Points come first: a few hits are sent to the stored texts, not these to them."""
    payload = points.select("id", *PAYLOAD_FIELDS, *[c for c in points.columns if c == "metadata"])
    asked = queries.select("query_id", F.col("text").alias("query"))
    return hits.join(payload, "id").join(asked, "query_id")


def overlap_score(query: Column, text: Column) -> Column:
    """Share of the distinct query tokens that occur in the text."""
    wanted = F.array_distinct(lexical.tokens(query))
    found = F.size(F.array_intersect(wanted, lexical.tokens(text)))
    return F.when(F.size(wanted) > 0, found / F.size(wanted)).otherwise(F.lit(0.0))


def rerank(hits: DataFrame, n: int = RERANK_POOL, scorer=None) -> DataFrame:
    """Reorder hits (query_id, query, id, content, score, rank) by a pair score; keeps the retrieval score.

    ``scorer`` is a factory for a model over (queries, texts); without one, token overlap is used.
    """
    value = pair_score(F.col("query"), F.col("content"), scorer) if scorer else overlap_score(
        F.col("query"), F.col("content"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("retrieval_rank"), F.col("id"))
    return (
        hits.withColumnsRenamed({"score": "retrieval_score", "rank": "retrieval_rank"})
        .withColumn("score", value)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )


def project_hits(hits: DataFrame) -> DataFrame:
    """Hits with defaults for what is missing or empty; metadata without the fields shown elsewhere."""
    text = or_default(F.col("content"), F.coalesce(F.col("text"), F.lit(""))) if "text" in hits.columns \
        else F.coalesce("content", F.lit(""))
    metadata = F.map_filter("metadata", lambda key, _: ~key.isin(*PAYLOAD_FIELDS)) if "metadata" in hits.columns \
        else F.create_map().cast("map<string,string>")
    return hits.select(
        "query_id", "rank", F.col("id").cast("string").alias("id"),
        or_default(F.col("title"), NO_TITLE).alias("title"),
        text.alias("content"),
        or_default(F.col("url"), NO_URL).alias("url"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        metadata.alias("metadata"),
    )


def _ranked(*fields: str) -> Column:
    """The hits of a query in rank order; a list is never longer than the rerank pool."""
    return F.array_sort(F.collect_list(F.struct("rank", *fields)), lambda a, b: a["rank"] - b["rank"])


def format_context(hits: DataFrame) -> DataFrame:
    """(query_id, context): numbered title, content and source of each hit, in rank order."""
    listed = F.transform(_ranked("title", "content", "url"), lambda hit, i: F.concat(
        F.lit("["), (i + 1).cast("string"), F.lit("] "), hit["title"], F.lit(": "), hit["content"],
        F.lit("\nSource: "), hit["url"]))
    return hits.groupBy("query_id").agg(F.array_join(listed, "\n\n").alias("context"))


def build_prompts(queries: DataFrame, contexts: DataFrame) -> DataFrame:
    """(query_id, system, prompt) for every query with a context."""
    before, after = HUMAN_TEMPLATE.split("{context}")
    middle, end = after.split("{question}")
    return queries.join(contexts, "query_id").select(
        "query_id", F.lit(SYSTEM_TEMPLATE).alias("system"),
        F.concat(F.lit(before), F.col("context"), F.lit(middle), F.col("text"), F.lit(end)).alias("prompt"),
    )


def answer_records(queries: DataFrame, hits: DataFrame, answers: DataFrame) -> DataFrame:
    """(query_id, query, summary, results, total); a query without hits gets the fixed notice and total 0."""
    results = hits.groupBy("query_id").agg(
        _ranked("id", "title", "content", "url", "score", "metadata").alias("_ranked"))
    found = F.size("_ranked")
    return (
        queries.select("query_id", F.col("text").alias("query"))
        .join(results, "query_id", "left")
        .join(answers.select("query_id", F.col("answer")), "query_id", "left")
        .select(
            "query_id", "query",
            F.when(F.col("_ranked").isNull(), F.lit(NO_SOURCES)).otherwise(F.col("answer")).alias("summary"),
            F.coalesce(F.transform("_ranked", lambda hit: hit.dropFields("rank")), F.array()).alias("results"),
            F.coalesce(found, F.lit(0)).alias("total"),
        )
    )
