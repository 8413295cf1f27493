"""The pipeline's stages against brute force on the small tables, and the registered SQL."""

import os
import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def firsts_of_classes(texts: dict[int, str], k: int = 5, similarity: float = 0.8) -> set[int]:
    """Least id of each class of texts linked by the Jaccard similarity of their word shingles: every pair."""
    words = {i: re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for i, t in texts.items()}
    sets = {i: {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} for i, w in words.items()}
    least = {i: i for i in sets}

    def find(i):
        return i if least[i] == i else find(least[i])

    for i in sets:
        for j in sets:
            if j < i and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                least[b] = a
    return {find(i) for i in sets}


def test_stages(spark):
    import corpus_pipeline
    from foliant.llm import mixing, quality_rules
    from foliant.llm.common import materialize, table

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), f"test-{name}")
        kept[name] = docs.cache()
        if name == "quality_rules":
            want = {r.row.doc_id for r in quality_rules.judge(before, carry=["doc_id"]).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "exact_dedup":
            text = {}
            for r in before.collect():
                key = "".join(r.text.split())
                text[key] = min(text.get(key, (1, 0)), (-len(r.text), r.doc_id))
            assert {r.doc_id for r in docs.collect()} == {v[1] for v in text.values()}
        if name == "simhash_near_dedup":
            assert {r.doc_id for r in docs.collect()} == firsts_of_classes({r.doc_id: r.text for r in before.collect()})
        if name == "mixing":
            got = Counter(r.doc_id for r in docs.collect())
            want = {r.row.doc_id: r.copies for r in mixing.assign(before, mixing.word_count(before["text"]), carry=["doc_id"]).collect()}
            assert got == Counter({k: v for k, v in want.items() if v})
        if name != "bpe":
            assert docs.columns == columns
    assert "token_ids" in docs.columns and docs.count() == kept["mixing"].count()


def test_registered_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from foliant.llm import queries

    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    assert {name.split("_")[0] for name in queries.queries()} == {f"op{n}" for n in range(1, 11)}
    for name, sql in queries.oracle_sql().items():
        got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns), name
        as_rows = lambda df: sorted(str([None if v is None or v != v else v for v in row]) for row in df[columns].astype(object).itertuples(index=False))
        assert as_rows(got) == as_rows(want), name
