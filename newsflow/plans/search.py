"""A table of questions against the vector collection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.retrieval import (RERANK_POOL, TOP_K, build_prompts, encode_queries, format_context,
                                          hybrid_topk, project_hits, rerank, rerank_pool, with_texts)
from newsflow.session import delete_folders, stage, staged_folders


@dataclass(frozen=True)
class Retrieved:
    """Ranked hits, their context and the prompt, per query. They read staged tables until ``close``, or the end of a ``with``."""

    hits: DataFrame
    contexts: DataFrame
    prompts: DataFrame
    folders: list[str] = field(default_factory=list)

    def close(self) -> None:
        """Delete the staged tables."""
        delete_folders(self.hits.sparkSession, self.folders)

    def __enter__(self) -> Retrieved:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def search_view(points: DataFrame) -> DataFrame:
    """Stored points as the search operators read them."""
    payload = F.col("payload")
    return points.select(
        "id", F.col("dense").alias("vector"),
        F.transform(F.map_entries("sparse"), lambda e: F.struct(
            e["key"].alias("id"), e["value"].alias("weight"))).alias("entries"),
        payload["title"].alias("title"), payload["url"].alias("url"), payload["content"].alias("content"),
        F.create_map(
            F.lit("article_id"), payload["article_id"].cast("string"),
            F.lit("chunk_index"), payload["chunk_index"].cast("string"),
            F.lit("authors"), payload["authors"],
            F.lit("publish_timestamp"), payload["publish_timestamp"].cast("string"),
        ).alias("metadata"),
    )


def retrieve(queries: DataFrame, points: DataFrame, factory, k: int = TOP_K, pool: int = RERANK_POOL,
             scorer=None, prefix: str = "") -> Retrieved:
    """Hybrid top-k, rerank of the first ``pool`` hits, context and prompt for every (query_id, text).

    The pool is staged, so its size is known when it is joined to the stored texts.
    """
    with staged_folders() as folders:
        encoded = encode_queries(queries, factory, prefix)
        first = stage(rerank_pool(hybrid_topk(encoded, points, k), pool), "pool")
        hits = stage(project_hits(rerank(with_texts(first, queries, points), pool, scorer)), "hits")
    contexts = format_context(hits)
    return Retrieved(hits, contexts, build_prompts(queries, contexts), folders)
