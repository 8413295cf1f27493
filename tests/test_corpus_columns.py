"""Queries that name the span fields they look at give what the whole entries give, at a cost that fits large tables."""

import random

from pyspark.sql import functions as F

from foliant import library_queries, queries
from foliant.functions import metrics as mx
from foliant.functions import udf
from foliant.operators import corpus
from foliant.sources import writers
from test_whole_turns import distance

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def with_whole_entries(monkeypatch, spark, name):
    whole = queries._corpus
    with monkeypatch.context() as m:
        m.setattr(queries, "_corpus", lambda spark, d, *needs: whole(spark, d))
        return queries.queries()[name](spark, DATA)


def test_assignment_issues_builds_no_scripts(spark, monkeypatch):
    got = library_queries.assignment_issues(spark, DATA)
    assert "IsCommon" not in plan(got) and got.count() == 3
    assert same(got, with_whole_entries(monkeypatch, spark, "assignment_issues"))


def test_assignments_rules(spark):
    """Repeated, blank, null and unassigned lines, and entries that are gone."""
    kind = "edition string, source_page int, id string, blocks array<struct<spans:array<struct<coordinates:array<struct<source_page:int,region_id:string,line_id:string>>>>>>"
    places = [(1, "r", "a"), (1, "r", "b"), (1, "r", "b"), (2, "r", "c"), (1, " ", "d"), (1, None, "e"), (1, None, "e")]
    entries = spark.createDataFrame([("s", 1, "e1", [([(places,)],)]), ("s", 2, "e2", [])], kind)
    rows = [("r", "a", "entry", "e1"), ("r", "a", "entry", "e1"), ("r", "a", "heading", None), (" ", "d", "entry", "e2"), (None, "e", "entry", None), ("x", "y", "unparsed", None)]
    assigned = spark.createDataFrame([("s", 1, *r) for r in rows], "edition string, source_page int, region_id string, line_id string, kind string, entry_id string")
    got = sorted((r.code, r.location) for r in corpus.validate_assignments(assigned, entries).collect())
    assert got == [
        ("duplicate_line_assignment", "s:1:r:a"), ("duplicate_line_assignment", "s:1:r:a"), ("empty_line_identity", "s:1: :d"), ("empty_line_identity", "s:1:e"),
        ("missing_assigned_entry", "s:1: :d"), ("missing_assigned_entry", "s:1:e"), ("unassigned_recognized_line", "s:1:e"), ("unassigned_recognized_line", "s:1:r:b"),
    ]


def test_distances_against_brute_force(monkeypatch):
    """Bounds that meet and bounds that do not, unequal lengths, several alphabets, small pieces."""
    rnd = random.Random(7)
    made = lambda n: "".join(rnd.choice("abβé😀") for _ in range(rnd.randrange(n)))
    left = [made(14) for _ in range(600)] + ["abcabcabc", "", "é", "eeeaeee"]
    right = [made(14) for _ in range(300)] + ["".join(rnd.sample(x, len(x))) for x in left[300:600]] + ["bcabcabca", "", "é", "cccaccc"]
    want = [distance(a, b) for a, b in zip(left, right)]
    assert udf.distances(left, right).tolist() == want
    assert [udf.edit_distance(a, b) for a, b in zip(left, right)] == want
    monkeypatch.setattr(udf, "CHARS", 20)
    assert udf._rates(left, right) == [d / (max(len(a), len(b)) or 1) for d, a, b in zip(want, left, right)]


def test_review_queue_needs_no_table(spark, monkeypatch):
    """The plan has no edit-distance table per line and builds no scripts; arrays of readings agree with the column form, missing ones too."""
    got = queries.review_queue(spark, DATA)
    assert "levenshtein" not in plan(got) and "IsCommon" not in plan(got)
    assert same(got, with_whole_entries(monkeypatch, spark, "review_queue"))
    pairs = [("abc", "abd"), (None, "x"), ("x", None), (None, None), ("", ""), ("", "ab"), ("äb", "b")]
    rows = spark.createDataFrame([(pairs,), ([],), (None,)], "p array<struct<a:string,b:string>>")
    told = [r.d for r in rows.select(udf.disagreements(F.col("p.a"), F.col("p.b")).alias("d")).collect()]
    columns = [r.d for r in spark.createDataFrame(pairs, "a string, b string").select(mx.disagreement(F.col("a"), F.col("b")).alias("d")).collect()]
    assert told == [columns, [], []]


def test_foreign_keys_reads_each_table_once(spark, monkeypatch):
    """No join, no scripts, and the same counts as with whole entries."""
    got = library_queries.foreign_keys(spark, DATA)
    assert "IsCommon" not in plan(got) and "Join" not in plan(got)
    assert same(got, with_whole_entries(monkeypatch, spark, "foreign_keys"))


def test_broken_keys_are_counted(spark):
    """Every foreign key broken by other numbers of rows; null keys are no references."""
    tables = writers.shred(queries._corpus(spark, DATA).limit(30).cache())
    n = {name: table.count() for name, table in tables.items()}
    gone = dict(tables)
    gone["entries"] = tables["entries"].where("id NOT LIKE '%3'").withColumn("edition_id", F.when(F.col("id").like("%4"), "none").otherwise(F.col("edition_id")))
    gone["spans"] = tables["spans"].where("ordinal > 0")
    gone["blocks"] = tables["blocks"].limit(0)
    want = {}
    for child, key, parent, parent_key in writers.FOREIGN_KEYS:
        held, known = [r[0] for r in gone[child].select(key).collect()], {r[0] for r in gone[parent].select(parent_key).collect()}
        want[child, key] = sum(v is not None and v not in known for v in held)
    got = {(r.child, r.key): r.broken for r in writers.check_tables(gone).collect()}
    assert got == want and got["spans", "block_id"] > 0 and got["spans", "entry_id"] > 0 and got["ocr_hypotheses", "span_id"] > 0 and n["spans"] > 30
