"""Dense surrogate keys without a single-task sort."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.session import stage

_SLOT_BITS = 33


def assign_keys(rows: DataFrame, natural_key: str, key: str, start: int = 0) -> DataFrame:
    """(natural_key, key) with keys start+1, start+2, … in the order of the natural key, which must be unique.

    Rows are range-partitioned and sorted in parallel and staged with their place in the partition.
    The offsets added afterwards are one row per partition, so broadcasting them is safe.
    """
    placed = (
        rows.select(natural_key)
        .repartitionByRange(natural_key)
        .sortWithinPartitions(natural_key)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    placed = stage(placed, "keys")
    part = F.shiftright("_slot", _SLOT_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(natural_key, (F.lit(start + 1) + F.col("_before") + place).cast("bigint").alias(key))
    )


def new_keys(names: DataFrame, table: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Keys for the names a dimension does not hold yet, above its highest key."""
    fresh = (
        names.select(natural_key).filter(F.col(natural_key).isNotNull()).distinct()
        .join(table.select(natural_key), natural_key, "left_anti")
    )
    highest = table.agg(F.max(key)).first()[0] or 0
    return assign_keys(fresh, natural_key, key, highest)
