"""Columns that are evaluated once."""

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the given columns added.

    A plain projection is copied into every filter and expression that reads it, so a costly parse would
    run several times per row. Columns that come out of a generator are not copied.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))


def unfold(df: DataFrame, keep: list[str], items: Column, position: str, item: str) -> DataFrame:
    """One row per array element: the kept columns, its position and the element.

    A plain explode makes Catalyst add a filter on the array below it, which evaluates a costly array
    expression a second time; the outer form with a filter above does not.
    """
    rows = df.select(*keep, F.posexplode_outer(items).alias(position, item))
    return rows.filter(F.col(position).isNotNull())


_built: dict[tuple[Callable, int], Column] = {}


def remembered(build: Callable[[], Column]) -> Callable[[], Column]:
    """``build`` makes its column once per JVM: an expression over named columns serves every DataFrame that has them."""
    def get() -> Column:
        key = (build, id(SparkContext._gateway))
        if key not in _built:
            _built[key] = build()
        return _built[key]
    return get
