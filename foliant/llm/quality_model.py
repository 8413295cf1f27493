"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Tokens are runs of letters, of digits and of symbols; features are their n-grams and the n-grams of
their shapes (case, length class, first symbols), which let rules of form carry over to words never
seen.  Labels come only from rows that are not held out; id, language, source and labels are no inputs.

Defined cases: null text counts as empty and gets the bias alone as its score; rows without a label
are scored like all others; repeated rows stay; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import table

FEATURES = ftrl.Features(bits=20, words=2, shapes=3, lower=True)
TRAINING = ftrl.Ftrl(alpha=0.1, l1=1.0, l2=1.0, epochs=4)
PREDICT_AT = 0.7
MODULUS, HELD_OUT = 4, 2


def fit(docs: DataFrame, labels: DataFrame) -> ftrl.Model:
    usable = ftrl.remainder(F.col("doc_id"), MODULUS) != HELD_OUT
    return ftrl.train(docs, labels.select("doc_id", "quality"), "quality", FEATURES, TRAINING, usable=usable)


def classify(docs: DataFrame, model: ftrl.Model) -> DataFrame:
    out = ftrl.score(docs, model, carry=["doc_id"])
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        (ftrl.remainder(F.col("row.doc_id"), MODULUS) == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op7_quality_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op7_quality_model": op7_quality_model}
ORACLES: dict[str, str] = {}
