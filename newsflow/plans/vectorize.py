"""Chunks that are not in the vector collection yet become points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions.encoders import hashing_encoder
from newsflow.operators.points import assemble_points, chunk_view, new_chunks
from newsflow.session import stage, staging
from newsflow.sources.warehouse import METADATA, POINTS, Warehouse


def warehouse_chunks(warehouse: Warehouse, chunks: DataFrame | None = None) -> DataFrame:
    """The chunk view over the warehouse tables, for all chunks or the given ones."""
    return chunk_view(warehouse.table("fact_chunks") if chunks is None else chunks, *[warehouse.table(t) for t in (
        "fact_articles", METADATA, "dim_time", "fact_article_authors", "dim_author")])


def vectorize(warehouse: Warehouse, encoder=None) -> None:
    """Encode new chunks and add them to the collection. Nothing new means nothing written.

    The collection records up to which load it holds all chunks. Only later loads are read and, as a run may have died between
    its points and that record, compared with the collection by key; only their new text is joined and encoded.
    """
    warehouse.init_points()
    factory = encoder or hashing_encoder(warehouse.points_dim())
    done, last = warehouse.points_loads(), warehouse.next_load() - 1
    chunks = warehouse.table("fact_chunks").filter(F.col("load_id").between(done + 1, last))
    place = ["article_id", "chunk_index"]
    with staging(warehouse.spark):
        keys = stage(new_chunks(chunks.select(*place), warehouse.table(POINTS)).select(*place), "fresh")
        if not keys.isEmpty():
            todo = chunks.join(keys, place, "left_semi")
            # the view has just dealt out the chunks; with their vectors they need not move again
            warehouse.append_points(assemble_points(warehouse_chunks(warehouse, todo), factory), last, dealt=True)
        elif last > done:
            warehouse.mark_loads(last)
