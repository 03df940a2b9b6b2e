"""Arrow batches in tasks, and what the tasks share."""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BATCH_ROWS = 1000


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` rows for what runs inside, where one row holds much."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows: whole texts of any length travel in them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key))
    if current <= 0 or current > rows:
        spark.conf.set(key, str(rows))


def over_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: T.StructType) -> DataFrame:
    """``function`` of each batch gives the columns of the rows that come out of it, as arrays."""
    names = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [_as(made[field.name], field.type) for field in names], schema=names)

    return df.mapInArrow(run, schema)


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front of it until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    return next(x for x in ("_" * n + name for n in itertools.count()) if x.lower() not in taken)


def hash_share(*columns, seed: int = 0):
    """A number from 0 to 1 that depends on the columns alone, for samples that repeat."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) / float(1 << 40)
