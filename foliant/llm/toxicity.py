"""Toxicity: FTRL-Proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate rates let rare words learn fast; a strong L1 term leaves a few hundred weights, which
travel to every executor as an index and a value array.  A document's evidence is the sum over the
features it contains, so one toxic passage counts alike in a short and in a very long text.
Labels come only from rows that are not held out; id, language, source and labels are no inputs.

Defined cases: null text counts as empty and gets the bias alone as its score; rows without a label
are scored like all others; repeated rows stay; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .common import table

FEATURES = ftrl.Features(bits=20, words=2, skips=(1, 2), shapes=0, lower=True)
TRAINING = ftrl.Ftrl(alpha=1.0, l1=15.0, l2=1.0, epochs=3, positive_weight=3.0)
PREDICT_AT = 0.7
MODULUS, HELD_OUT = 3, 1


def fit(docs: DataFrame, labels: DataFrame) -> ftrl.Model:
    usable = ftrl.remainder(F.col("doc_id"), MODULUS) != HELD_OUT
    return ftrl.train(docs, labels.select("doc_id", "toxic"), "toxic", FEATURES, TRAINING, usable=usable)


def classify(docs: DataFrame, model: ftrl.Model) -> DataFrame:
    out = ftrl.score(docs, model, carry=["doc_id"])
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        (ftrl.remainder(F.col("row.doc_id"), MODULUS) == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
