"""Seed lists, stored pages and evaluation files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.compute import unfold
from newsflow.schemas import PAGE


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed URLs of all JSON files below a path, one array per file."""
    return seed_urls(spark.read.text(path, wholetext=True))


def seed_urls(lists: DataFrame) -> DataFrame:
    """Rows with a JSON array in ``value``, of strings or objects with ``url``, to one row per URL."""
    items = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    url = F.coalesce(F.try_variant_get("item", "$.url", "string"), F.try_variant_get("item", "$", "string"))
    return unfold(lists, [], items, "position", "item").select(url.alias("url"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages (page_id, url, html)."""
    return spark.read.schema(PAGE).parquet(path)


def read_testset(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation questions: CSV with header, quoted fields and line breaks inside quotes."""
    return (
        spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
        .schema("question STRING, ground_truth STRING").csv(path)
        .select("question", "ground_truth")
    )


def write_csv(df: DataFrame, path: str, *partition_by: str) -> None:
    """CSV with header and doubled quotes; white space and line breaks survive."""
    writer = (
        df.write.option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """One folder of CSV files per model; contexts, if any, as a JSON list."""
    nested = [f.name for f in scores.schema if f.dataType.typeName() in ("array", "struct", "map")]
    flat = scores.withColumns({name: F.to_json(name) for name in nested}) if nested else scores
    write_csv(flat, path, "model")
