"""Insert-or-replace and insert-if-absent over plain tables."""

from pyspark.sql import DataFrame


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``source``, unique on the key, inserted or put in place of rows with the same key."""
    survivors = target.join(source.select(key), key, "left_anti").select(*source.columns)
    return survivors.unionByName(source)


def insert_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The rows of ``source`` whose key ``target`` does not hold."""
    return source.join(target.select(key), key, "left_anti")
