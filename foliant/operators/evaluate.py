"""Evaluation and bookkeeping over results: precision and recall, baselines, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as mx


def precision_recall(expected: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Exact-id precision and recall; an id predicted twice counts twice, an empty side counts as 1."""
    hits = predicted.join(expected.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("hits"))
    said = predicted.agg(F.count(F.lit(1)).alias("said"))
    true = expected.agg(F.count(F.lit(1)).alias("true"))
    one = F.lit(1)
    all_ = hits.withColumn("k", one).join(said.withColumn("k", one), "k").join(true.withColumn("k", one), "k")
    share = lambda n: F.when(F.col(n) == 0, 1.0).otherwise(1.0 - F.greatest(F.col(n) - F.col("hits"), F.lit(0)) / F.col(n))
    return all_.select(share("said").alias("precision"), share("true").alias("recall"))


def baseline_metrics(ground_truth: DataFrame) -> DataFrame:
    """CER and WER of every engine over the reviewed lines, each engine's readings joined in order."""
    rows = ground_truth.select("edition", "source_page", "line_id", "text", F.explode("hypotheses").alias("h"))
    place = F.struct("edition", "source_page", "line_id")
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), c.alias("t")))), lambda x: x["t"]), "\n")
    per = rows.groupBy("h.engine").agg(text(F.col("text")).alias("r"), text(F.col("h.text")).alias("o"))
    return per.select("engine", mx.cer(F.col("r"), F.col("o")).alias("cer"), mx.wer(F.col("r"), F.col("o")).alias("wer"))


def split_counts(ground_truth: DataFrame) -> DataFrame:
    return ground_truth.groupBy("split").count()


def assignment_counts(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("kind").count()


def is_valid(issues: DataFrame) -> DataFrame:
    """One row: errors, warnings, and whether there is no error."""
    counted = issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return counted.withColumn("valid", F.col("errors") == 0)
