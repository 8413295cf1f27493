"""Layout scenarios: lines as (region, region box, line id, line box, text), expected entries and blocks."""

import pytest
from pyspark.sql import functions as F

from foliant import schemas
from foliant.operators import layout
from foliant.plans import run

W, H = 1000, 1400


def make(spark, pages, size=(W, H), engine="primary"):
    """``pages``: {source_page: [(region_id, region box, [(line_id, line box, text)])]}"""
    rows = []
    for page, regions in pages.items():
        for r, (region, box, lines) in enumerate(regions):
            for n, (line, (x, y, w, h), text) in enumerate(lines):
                polygon = [(float(a), float(b)) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]
                words, at = [], float(x)
                for k, t in enumerate(text.split()):
                    words.append((f"{line}-w{k}", t, 0.9, at, float(y), 40.0, float(h), None))
                    at += 50.0
                rows.append(("atlas", page, engine, size[0], size[1], r, region, *box, n, line, x, y, w, h, text, 0.9, polygon, words))
    return spark.createDataFrame(rows, schemas.LINE).withColumns({"printed_page": F.col("source_page").cast("string"), "front_matter": F.lit(False)})


def shape(segmented):
    rows = segmented.where("kind = 'entry'").orderBy("source_page", "region_ord", "line_ord").collect()
    entries = {}
    for r in rows:
        e = entries.setdefault(r.entry_id, {"headword": r.headword, "blocks": {}})
        e["blocks"][r.block_no] = e["blocks"].get(r.block_no, 0) + 1
    return [(e["headword"], list(e["blocks"].values())) for e in entries.values()]


def flush(xs, texts, start=72, step=49):
    return [(f"l{k}", (x, start + k * step, 400, 38), t) for k, (x, t) in enumerate(zip(xs, texts))]


LEFT, INDENT = 100, 138
BOX = (LEFT, 60, 520, 1150)


def test_headless_start_and_header(spark):
    lines = make(spark, {1: [("header", (50, 10, 900, 25), [("header-line", (50, 10, 900, 25), "LEXICON")]), ("column-1", (50, 100, 420, 1000), [("introduction", (50, 100, 400, 45), "The name Aleph."), ("entry", (90, 155, 360, 45), "אָב father.")])]})
    out = layout.segment(lines).cache()
    assert shape(out) == [(None, [1]), ("אָב", [1])]
    assert out.where("line_id = 'header-line'").first().kind == "unparsed"
    assert [r.entry_id for r in out.where("line_id = 'entry'").collect()] == ["atlas:p1:e0002"]


def test_heading_then_paragraph(spark):
    lines = make(spark, {1: [("title", (300, 120, 400, 50), [("title-line", (350, 120, 300, 50), "LEXICON.")]), ("body", (50, 240, 420, 110), [("body-1", (90, 240, 360, 45), "first line of prose in the body"), ("body-2", (50, 290, 400, 45), "second line of prose in the body")])]})
    out = layout.segment(lines).orderBy("span_no").collect()
    assert [(r.block_no, r.block_kind) for r in out] == [(1, "heading"), (2, "paragraph"), (2, "paragraph")]


def test_flush_hebrew_does_not_split(spark):
    lines = make(spark, {1: [("r", BOX, flush([90, 50, 50, 50, 90], ["אָב father", "prose here", "אָבִיו is no entry", "more prose", "אֵם mother"]))]})
    assert shape(layout.segment(lines)) == [("אָב", [4]), ("אֵם", [1])]


def test_digits_do_not_open_blocks(spark):
    lines = make(spark, {1: [("r", BOX, flush([90, 50, 50, 50], ["אָב m. father", "prose", "P82 and M72", "So in Heb. only"]))]})
    assert shape(layout.segment(lines)) == [("אָב", [4])]


def test_grammar_labels_open_entries(spark):
    lines = make(spark, {1: [("r", (50, 80, 540, 1000), [("a", (90, 100, 500, 45), "אָב m. father"), ("b", (50, 220, 540, 45), "אָבֶב in Heb. not used; Chald. Pa."), ("c", (50, 270, 540, 45), "Arab. and Heb. it continues."), ("d", (90, 340, 500, 45), "RN Abagtha, Pers. pr. n.")])]})
    heads = [h for h, _ in shape(layout.segment(lines))]
    assert heads == ["אָב", "אָבֶב", "RN"]


def test_stem_label_stays_inside(spark):
    texts = ["אָבַד fut.", "prose", "prose", "אִבֵּד 1. to lose", "prose"]
    lines = make(spark, {1: [("r", BOX, flush([90, 50, 50, 90, 50], texts))]})
    hypotheses = make(spark, {1: [("r", BOX, flush([90, 50, 50, 90, 50], ["ABD fut.", "prose", "prose", "PIEL ABED 1. to", "prose"]))]}, engine="other")
    found = run.aligned(lines, hypotheses).withColumnRenamed("text", "hypothesis_text")
    assert shape(layout.segment(lines, found)) == [("אָבַד", [3, 2])]


def test_continuation_across_pages(spark):
    pages = {
        1: [("left", (50, 1200, 455, 150), [("a", (50, 1200, 400, 45), "אָב father of all")])],
        2: [
            ("head", (470, 50, 60, 30), [("running", (470, 50, 60, 30), "אָב")]),
            ("right", (550, 100, 400, 150), [("b", (570, 100, 380, 40), "goes on here"), ("c", (550, 150, 400, 45), "and here"), ("d", (550, 200, 400, 45), "and there")]),
            ("more", (550, 270, 400, 100), [("e", (590, 270, 360, 45), "a new block"), ("f", (550, 320, 400, 45), "its end")]),
        ],
    }
    out = layout.segment(make(spark, pages)).cache()
    assert shape(out) == [("אָב", [4, 2])]
    assert out.where("line_id = 'running'").first().kind == "unparsed"


def test_front_matter_and_gap_in_pages(spark):
    lines = make(spark, {n: [("r", BOX, [(f"p{n}", (50, 200, 400, 45), "plain prose text")])] for n in (1, 2, 4)})
    lines = lines.withColumn("front_matter", F.col("source_page") == 1)
    out = {r.line_id: (r.kind, r.entry_id) for r in layout.segment(lines).collect()}
    assert out == {"p1": ("front_matter", None), "p2": ("entry", "atlas:p2:e0001"), "p4": ("entry", "atlas:p4:e0001")}


def test_starred_headword(spark):
    size = (2000, 3400)
    pages = {1: [("body", (100, 2800, 800, 50), [("b", (100, 2800, 800, 50), "prose")]), ("star", (1030, 2900, 20, 25), [("s", (1030, 2900, 20, 25), "*")]), ("head", (1070, 2898, 700, 60), [("h", (1070, 2898, 700, 60), "ܢ m.")])]}
    out = layout.classify_languages(make(spark, pages, size), ["heb", "syr"])
    assert out.where("line_id = 'h'").first().words[0].language == "heb"


@pytest.mark.parametrize(
    "texts,expected",
    [
        (["Heb.", "1|2"], [None, "heb"]),
        (["Arab.", "11", "and", "22", "and", "33"], [None, "ara", None, "ara", None, "ara"]),
        (["אבג", "דהו", "ابت", "זחט"], ["heb", "heb", "heb", "heb"]),
    ],
)
def test_word_languages(spark, texts, expected):
    lines = make(spark, {1: [("r", BOX, [("l", (50, 300, 400, 45), " ".join(texts))])]})
    out = layout.classify_languages(lines, ["heb", "ara", "syr", "grc"]).first()
    assert [w.language for w in out.words] == expected


def test_run_builds_valid_entries(spark):
    from foliant.operators import corpus
    from foliant.sources import writers

    pages = {40: [("r", BOX, flush([INDENT, LEFT, INDENT], ["דָּג m. fish", "of rivers", "חוֹל f. sand"]))], 41: [("r", BOX, flush([LEFT], ["continued here"]))]}
    canonical = make(spark, pages).drop("printed_page", "front_matter")
    engines = spark.createDataFrame([("primary", 0, "1", "m", "c" * 64)], "engine string, engine_ord int, engine_version string, model string, model_hash string")
    context = {"source_sha256": "a" * 64, "scan_id": "scan", "pipeline_run": "run", "transform_id": "identity", "page_image": "p%04d.png"}
    entries, assignments = run.run(canonical, canonical, engines, {"printed_page_offset": -35}, context)
    entries = entries.cache()
    got = {e.id: e for e in entries.collect()}
    assert sorted(got) == ["atlas:p5:e0001", "atlas:p5:e0002"]
    assert got["atlas:p5:e0002"].headword.id == "atlas:p5:e0002:headword"
    assert [len(b.spans) for b in got["atlas:p5:e0002"].blocks] == [2]
    assert corpus.validate(entries).count() == 0
    assert assignments.count() == 4
    tables = writers.shred(entries)
    assert tables["spans"].count() == 6 and writers.check_tables(tables).agg(F.sum("broken")).first()[0] == 0
    assert corpus.search(corpus.search_index(entries), "rivers").count() == 1
    assert entries.select(writers.tei_entry().alias("x")).where("x like '<entry xml:id=\"g_atlas_3a_p5%'").count() == 2
