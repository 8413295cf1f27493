"""Matching, replay, upserts, readers and the registered queries against SQL."""

import json
import os

import pytest
from pyspark.sql import functions as F

from foliant import schemas
from foliant.operators import corpus, matching
from foliant.sources import readers, writers

ALTO = """<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#"><Layout><Page WIDTH="1000" HEIGHT="1400"><PrintSpace>
<TextBlock ID="b" HPOS="50" VPOS="80" WIDTH="420" HEIGHT="1000"><TextLine ID="l1" HPOS="50" VPOS="100" WIDTH="400" HEIGHT="45">
<String CONTENT="per" WC="0.9" HPOS="50" VPOS="100" WIDTH="40" HEIGHT="45"/><HYP CONTENT="-"/><SP/><String CONTENT="ish" WC="1.5" HPOS="95" VPOS="100" WIDTH="40" HEIGHT="45"/></TextLine></TextBlock>
</PrintSpace></Page></Layout></alto>"""


def boxes(spark, rows):
    return spark.createDataFrame(rows, "page int, i long, x1 double, y1 double, x2 double, y2 double, confidence double").withColumn("box", F.struct("x1", "y1", "x2", "y2"))


def test_greedy_is_one_to_one(spark):
    left = boxes(spark, [(1, 0, 0.0, 0.0, 10.0, 10.0, 1.0), (1, 1, 0.0, 8.0, 10.0, 18.0, 1.0), (1, 2, 50.0, 50.0, 60.0, 60.0, 1.0)])
    right = boxes(spark, [(1, 0, 0.0, 7.0, 10.0, 17.0, 1.0), (1, 1, 0.0, 0.0, 10.0, 9.0, 1.0)])
    got = {r.l: r.r for r in matching.align(left, right, ["page"]).collect()}
    assert got == {0: 1, 1: 0, 2: None}


def test_dedupe_keeps_the_surer_in_place(spark):
    items = boxes(spark, [(1, 0, 0.0, 0.0, 10.0, 10.0, 0.40), (1, 1, 0.0, 0.0, 10.0, 10.0, 0.90), (1, 2, 30.0, 0.0, 40.0, 10.0, 0.1)])
    assert [(r.place, r.i) for r in matching.dedupe_overlapping(items, ["page"]).orderBy("place").collect()] == [(0, 1), (1, 2)]


def test_nearest_unused_takes_turns(spark):
    source = boxes(spark, [(1, 0, 0.0, 0.0, 9.0, 10.0, 1.0), (1, 1, 0.0, 2.0, 9.0, 12.0, 1.0)])
    candidate = boxes(spark, [(1, 0, 0.0, 1.0, 9.0, 11.0, 1.0), (1, 1, 0.0, 9.0, 9.0, 19.0, 1.0)])
    assert {r.l: r.r for r in matching.nearest_unused(source, candidate, ["page"]).collect()} == {0: 0, 1: 1}


def word(text, conf, x):
    return ("w", text, conf, float(x), 0.0, 40.0, 10.0, None)


def test_fusion(spark):
    kind = schemas.struct(line_id=schemas.S, text=schemas.S, confidence=schemas.D, words=schemas.array(schemas.WORD), secondary_words=schemas.array(schemas.WORD))
    rows = [
        ("n1", "GML camel", 0.7, [word("GML", 0.42, 0), word("camel", 0.95, 60)], [word("גָּמָל", 0.88, 0), word("camel", 0.94, 60)]),
        ("n2", "river", 0.9, [word("river", 0.9, 0)], [word("נהרות", 0.62, 0)]),
        ("n3", "x", 0.5, [word("x", 0.5, 0)], None),
    ]
    got = {r.line_id: r for r in matching.fuse_words(spark.createDataFrame(rows, kind)).collect()}
    assert (got["n1"].text, got["n2"].text, got["n3"].text) == ("גָּמָל camel", "river", "x")
    assert [w.id for w in got["n1"].words] == ["n1-fused-word-0001", "n1-fused-word-0002"]


def test_replay_and_conflicts(spark):
    base = spark.createDataFrame([("a", 0, "old"), ("b", 0, "b")], "id string, revision long, text string")

    def log(*rows):
        return spark.createDataFrame([(i, e, b, b + 1, (e, b + 1, t)) for i, (e, b, t) in enumerate(rows)], "seq long, entry_id string, base_revision long, revision long, replacement struct<id:string,revision:long,text:string>")

    out = {r.id: (r.revision, r.text) for r in corpus.replay(base, log(("a", 0, "one"), ("a", 1, "two"))).collect()}
    assert out == {"a": (2, "two"), "b": (0, "b")}
    with pytest.raises(ValueError, match="revision conflict"):
        corpus.replay(base, log(("a", 0, "one"), ("a", 0, "late")))
    assert [r.code for r in corpus.replay_issues(base, log(("z", 0, "x"))).collect()] == ["unknown_entry"]


def test_upsert_last_wins(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, o int")
    assert sorted(map(tuple, corpus.upsert(base, changes, ["k"], "o").collect())) == [(1, "a"), (2, "y"), (3, "z")]


def test_alto_round_trip(spark, tmp_path):
    (tmp_path / "first-p001.engine.xml").write_text(ALTO, encoding="utf-8")
    line = readers.read_alto(spark, f"file://{tmp_path}").first()
    assert (line.edition, line.source_page, line.engine, line.text) == ("first", 1, "engine", "per- ish")
    assert line.confidence == pytest.approx(0.95) and [w.confidence for w in line.words] == [pytest.approx(0.9), 1.0]
    again = readers.lines_from_alto(writers.alto_page(readers.read_alto(spark, f"file://{tmp_path}"))).first()
    assert again.text == "per ish" and (again.x, again.y, again.w, again.h) == (50, 100, 400, 45)


def test_word_table(spark, tmp_path):
    head = "\t".join(f"c{i}" for i in range(12))
    rows = ["\t".join(["5"] + ["0"] * 9 + [conf, text]) for conf, text in (("90", "ab"), ("50", "c"), ("70", " "))] + ["\t".join(["4"] + ["0"] * 9 + ["1", "no"])]
    (tmp_path / "w.tsv").write_text("\n".join([head, *rows]) + "\n", encoding="utf-8")
    got = readers.read_word_tsv(spark, f"file://{tmp_path}").first()
    assert got.text == "ab c" and got.confidence == pytest.approx((0.9 * 2 + 0.5) / 3)


def test_jsonl_and_log(spark, tmp_path):
    assert readers.read_patches(spark, f"file://{tmp_path}/none.jsonl").count() == 0
    (tmp_path / "log.jsonl").write_text("\n".join(json.dumps({"entry_id": "a", "base_revision": k, "revision": k + 1}) for k in range(3)) + "\n\n", encoding="utf-8")
    assert [(r.seq, r.revision) for r in readers.read_patches(spark, f"file://{tmp_path}/log.jsonl").collect()] == [(0, 1), (1, 2), (2, 3)]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/a.jsonl").write_text('{"id": "x", "unknown": 1}\n\n{"id": "y"}\n', encoding="utf-8")
    assert [r.id for r in readers.read_entries(spark, f"file://{tmp_path}/c").orderBy("id").collect()] == ["x", "y"]


def test_gold_scoring(spark, tmp_path):
    gold = {"id": "g", "edition": "e", "source_page": 1, "source_sha256": "a" * 64, "authority": "x", "lines": [{"line_id": "1", "text": "The name Aleph"}, {"line_id": "2", "text": "gone"}]}
    (tmp_path / "g.json").write_text(json.dumps(gold), encoding="utf-8")
    lines = spark.createDataFrame([("e", 1, "1", "old", 0, 0), ("e", 1, "1", "Tue name Aleph", 0, 1)], "edition string, source_page int, line_id string, text string, region_ord int, line_ord int")
    got = readers.evaluate_gold(readers.read_gold(spark, f"file://{tmp_path}/g.json"), lines).first()
    assert got.cer > 0 and got.reference_words == 4 and got.missing_lines == ["2"]


def test_validation_finds_faults(spark):
    from foliant.queries import _corpus

    base = _corpus(spark, "/root/testdata/sf0.001").limit(40).cache()
    codes = lambda df: {r.code for r in corpus.validate(df).select("code").distinct().collect()}
    assert codes(base) == {"self_alias", "edition_provenance_mismatch", "incomplete_coordinates"}  # document 0 is page 0
    broken = base.withColumn("confidence", F.lit(float("nan")).cast("float")).withColumn("provenance", F.col("provenance").withField("source_sha256", F.lit("A" * 64))).withColumn("id", F.lit("same"))
    assert {"invalid_confidence", "invalid_source_hash", "unstable_entry_id", "duplicate_entry_id", "edition_provenance_mismatch"} <= codes(broken)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_registered_queries_against_sql(spark):
    """Every query of the base registry with SQL gives DuckDB's rows."""
    duckdb = pytest.importorskip("duckdb")
    from foliant import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")

    def value(v):
        return None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    for name, sql in queries.oracle_sql().items():
        got, want = queries.queries()[name](spark, sf).toPandas(), con.execute(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns), name
        rows = [sorted(str([value(v) for v in row]) for row in df[columns].itertuples(index=False)) for df in (got, want)]
        assert rows[0] == rows[1], name
