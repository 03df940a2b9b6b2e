"""One query per operator over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsflow.llm.contamination import op3_decontamination
from newsflow.llm.langid import op1_language_id
from newsflow.llm.lines import OP5_SQL, op5_line_dedup
from newsflow.llm.lmscore import op7_lm_scoring
from newsflow.llm.mixing import op9_mixing
from newsflow.llm.neardup import op2_near_dedup
from newsflow.llm.quality import op6_quality
from newsflow.llm.runs import op12_periodic_runs
from newsflow.llm.spelling import op11_spelling_variants
from newsflow.llm.tokens import op13_token_files
from newsflow.llm.topk import OP4_SQL, op4_topk
from newsflow.llm.toxicity import op8_toxicity
from newsflow.llm.urls import OP10_SQL, op10_url_filters

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(function: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: function(*(_table(spark, sf_dir, name) for name in names))


QUERIES: dict[str, Query] = {
    "op1_language_id": _over(op1_language_id, "documents"),
    "op2_near_dedup": _over(op2_near_dedup, "documents"),
    "op3_decontamination": _over(op3_decontamination, "documents", "benchmark"),
    "op4_topk": _over(op4_topk, "embeddings"),
    "op5_line_dedup": _over(op5_line_dedup, "documents"),
    "op6_quality": _over(op6_quality, "documents", "labels"),
    "op7_lm_scoring": _over(op7_lm_scoring, "documents", "labels"),
    "op8_toxicity": _over(op8_toxicity, "documents", "labels"),
    "op9_mixing": _over(op9_mixing, "documents"),
    "op10_url_filters": _over(op10_url_filters, "pages"),
    "op11_spelling_variants": _over(op11_spelling_variants, "documents"),
    "op12_periodic_runs": _over(op12_periodic_runs, "documents"),
    "op13_token_files": _over(op13_token_files, "documents"),
}

ORACLES: dict[str, str] = {
    "op4_topk": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op10_url_filters": OP10_SQL,
}
