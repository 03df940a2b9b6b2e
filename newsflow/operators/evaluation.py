"""Evaluation records, metric formulas and the scoreboard. Verdicts are input tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import lexical
from newsflow.functions.text import or_default, strip

# The answer recorded when a model gave none, and the guard of the precision quotient.
NO_ANSWER = "Không có thông tin."
EPSILON = 1e-10
METRICS = ("faithfulness", "answer_relevancy", "context_precision", "context_recall")

# Ranks per block when a ranked list is summed.
_BLOCK = 1024


def eval_grid(questions: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every question once per model name."""
    return questions.withColumn("model", F.explode(F.array(*[F.lit(name) for name in models])))


def eval_records(grid: DataFrame, hits: DataFrame, answers: DataFrame) -> DataFrame:
    """(model, query_id, question, answer, contexts, ground_truth) with texts trimmed and a default answer.

    ``hits`` are (query_id, rank, content), ``answers`` (model, query_id, answer).
    """
    contexts = hits.groupBy("query_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "content"))), lambda hit: hit["content"]).alias("contexts"))
    return (
        grid.join(contexts, "query_id", "left")
        .join(answers, ["model", "query_id"], "left")
        .select(
            "model", "query_id",
            strip(F.col("question")).alias("question"),
            or_default(F.col("answer"), NO_ANSWER).alias("answer"),
            F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"),
            strip(F.col("ground_truth")).alias("ground_truth"),
        )
    )


def context_precision(verdicts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean precision at the ranks of relevant contexts, from (keys, rank, verdict).

    Running sums go in two steps, over blocks of ranks and within a block, so that one very long list
    is not one task's work.
    """
    keys = list(keys)
    block = F.floor((F.col("rank") - 1) / _BLOCK)
    ranked = verdicts.withColumn("_block", block)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranked.groupBy(*keys, "_block").agg(F.sum("verdict").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy(*keys, "_block").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = F.sum("verdict").over(within) + F.col("_before")
    precision = F.when(F.col("verdict") == 1, hits / F.col("rank")).otherwise(F.lit(0.0))
    return (
        ranked.join(carried, [*keys, "_block"])
        .withColumn("_precision", precision)
        .groupBy(*keys)
        .agg((F.sum("_precision") / (F.sum("verdict") + F.lit(EPSILON))).alias("context_precision"))
    )


def verdict_share(verdicts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Share of positive verdicts per key."""
    return verdicts.groupBy(*keys).agg(F.avg(F.col("verdict").cast("double")).alias(name))


def faithfulness(verdicts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Supported statements of an answer among all its statements."""
    return verdict_share(verdicts, keys, "faithfulness")


def context_recall(verdicts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statements of the truth that the contexts support, among all."""
    return verdict_share(verdicts, keys, "context_recall")


def answer_relevancy(generated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean cosine of a question and the questions generated from its answer; 0 when it is non-committal.

    Rows are (keys, question_vector, generated_vector, noncommittal).
    """
    similarity = lexical.cosine(F.col("question_vector"), F.col("generated_vector"))
    mean = F.avg(similarity)
    return generated.groupBy(*keys).agg(
        F.when(F.max("noncommittal") == 1, F.lit(0.0)).otherwise(mean).alias("answer_relevancy"))


def model_scoreboard(scores: DataFrame) -> DataFrame:
    """Mean of every metric per model; empty and NaN scores are left out."""
    return scores.groupBy("model").agg(*[
        F.avg(F.when(~F.isnan(name), F.col(name))).alias(name) for name in METRICS])
