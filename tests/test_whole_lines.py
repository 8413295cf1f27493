"""The readings that the review queue compares are whole lines."""

import random

from pyspark.sql import functions as F

from foliant import queries
from foliant.functions import metrics as mx
from test_whole_turns import distance


def test_distance_against_brute_force(spark):
    """Equal and unequal lengths, shifted, equal and empty strings, several alphabets."""
    rnd = random.Random(5)
    made = lambda: "".join(rnd.choice("abβé😀") for _ in range(rnd.randrange(9)))
    pairs = [(made(), made()) for _ in range(300)] + [("abcabcabc", "bcabcabca"), ("", ""), ("é", "é")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", mx.distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert len(got) == len(pairs) and all(r.d == distance(r.a, r.b) for r in got)


def test_review_queue_sees_beyond_forty_characters(spark, tmp_path):
    texts = {3: "a" * 40 + "e" * 60, 8: "a" * 100 + "\n" + "e" * 10 + "b" * 90, 13: "e" * 8 + "a" * 100}
    docs = [(i, "s", "en", x) for i, x in texts.items()]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(r.disagreement for r in queries._corpus(spark, str(tmp_path)).transform(queries.corpus.review_summary).collect())
    assert [round(x, 6) for x in got] == [round(8 / 108, 6), 0.1, 0.6]
    assert 0.6 in {r.disagreement for r in queries.queries()["review_queue"](spark, str(tmp_path)).collect()}
