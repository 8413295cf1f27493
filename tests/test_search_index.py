"""The registered index holds short, accented and rare terms."""

from collections import Counter

from foliant import queries


def test_all_tokens_are_indexed(spark, tmp_path):
    texts = {1: "A café, no. 7\nof cafés", 2: "of λόγος of", 4: "OF unprecedented"}
    docs = [(i, "s", "en", x) for i, x in texts.items()]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter(["a", "café", "no", "7", "of", "cafés", "of", "λόγος", "of", "unprecedented"])
    assert {r.term: r.documents for r in queries.queries()["search_index"](spark, str(tmp_path)).collect()} == want
