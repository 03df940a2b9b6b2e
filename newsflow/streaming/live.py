"""Warehouse metrics that stay fresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from newsflow.plans.reports import warehouse_metrics
from newsflow.sources.warehouse import METADATA, Warehouse

# Seconds between refreshes.
REFRESH = "10 seconds"


def refresh_metrics(warehouse: Warehouse, name: str) -> DataFrame:
    """Put the numbers of the tables as they are now into the view ``name``: one row, counted in one pass per table.

    Only complete loads count.
    """
    for table in (METADATA, "fact_articles", "fact_chunks"):
        warehouse.refresh(table)
    rows = warehouse_metrics(warehouse)
    now = warehouse.spark.createDataFrame(rows.collect(), rows.schema)
    now.createOrReplaceTempView(name)
    return now


def live_metrics(warehouse: Warehouse, name: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the numbers of the tables in the view ``name``, refreshed at every tick of the trigger.

    Each refresh counts the tables' state anew, so truncated tables, replaced partitions and repeated loads show as they are.
    """
    ticks = warehouse.spark.readStream.format("rate").load()
    return (
        ticks.writeStream.foreachBatch(lambda _, __: refresh_metrics(warehouse, name) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": REFRESH}))
        .start()
    )
