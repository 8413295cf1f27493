"""Commands end to end on two pages: layout files in, corpus, queue, search and exports out."""

import json

import pytest

from foliant import commands
from foliant.operators import evaluate

PAGE = '<alto><Layout><Page WIDTH="1300" HEIGHT="1750"><PrintSpace><TextBlock ID="col" HPOS="120" VPOS="60" WIDTH="520" HEIGHT="1500">{}</TextBlock></PrintSpace></Page></Layout></alto>'


def line(n, x, y, *words):
    inner = "<SP/>".join(f'<String CONTENT="{t}" WC="{c}" HPOS="{x + 90 * k}" VPOS="{y}" WIDTH="80" HEIGHT="38"/>' for k, (t, c) in enumerate(words))
    return f'<TextLine ID="l{n}" HPOS="{x}" VPOS="{y}" WIDTH="480" HEIGHT="38">{inner}</TextLine>'


@pytest.fixture
def folder(tmp_path):
    alto = tmp_path / "alto"
    alto.mkdir()
    first = [line(1, 120, 110, ("דָּג", 0.87), ("a", 0.93), ("fish", 0.91)), line(2, 120, 159, ("of", 0.83), ("rivers", 0.88)), line(3, 158, 234, ("גֶּשֶׁם", 0.89), ("heavy", 0.92), ("rain", 0.61))]
    other = [line(1, 120, 110, ("דג", 0.69), ("a", 0.9), ("fish", 0.86)), line(2, 120, 159, ("of", 0.8), ("rivers", 0.77)), line(3, 158, 234, ("גשם", 0.66), ("heavy", 0.85), ("rain", 0.52))]
    (alto / "lex-p040.main.xml").write_text(PAGE.format("".join(first)), encoding="utf-8")
    (alto / "lex-p040.second.xml").write_text(PAGE.format("".join(other)), encoding="utf-8")
    (alto / "lex-p041.main.xml").write_text(PAGE.format(line(1, 120, 110, ("from", 0.9), ("clouds", 0.84)) + line(2, 158, 177, ("חוֹל", 0.88), ("sand", 0.95))), encoding="utf-8")
    (tmp_path / "cat.toml").write_text(f'[[sources]]\nedition = "lex"\nsha256 = "{"a" * 64}"\nscan_id = "s"\nprinted_page_offset = -35\n', encoding="utf-8")
    (tmp_path / "engines.json").write_text("\n".join(json.dumps({"engine": e, "engine_ord": k, "engine_version": "1", "model": "m-" + e, "model_hash": "c" * 64}) for k, e in enumerate(["main", "second"])), encoding="utf-8")
    return tmp_path


def test_run_review_search_export(spark, folder, capsys):
    at = lambda name: f"file://{folder}/{name}"
    go = lambda *argv: (capsys.readouterr(), commands.main(list(argv), spark), [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")])[2]
    counts = go("run", "--edition", "lex", "--pages", "40-41", "--alto", at("alto"), "--canonical", "main", "--catalogue", f"{folder}/cat.toml", "--engines", at("engines.json"), "--run-id", "r1", "--out", at("corpus"))
    assert counts == [{"kind": "entry", "count": 5}]
    # part files of the text sink are the corpus; give them the suffix that the reader asks for
    (folder / "c").mkdir()
    for k, part in enumerate(sorted((folder / "corpus").glob("part-*"))):
        (folder / "c" / f"{k}.jsonl").write_text(part.read_text(encoding="utf-8"), encoding="utf-8")
    entries = [json.loads(x) for p in sorted((folder / "c").glob("*")) for x in p.read_text(encoding="utf-8").splitlines()]
    assert [(e["id"], e["headword"]["diplomatic"], [len(b["spans"]) for b in e["blocks"]]) for e in entries] == [
        ("lex:p5:e0001", "דָּג", [2]),
        ("lex:p5:e0002", "גֶּשֶׁם", [2]),
        ("lex:p6:e0001", "חוֹל", [1]),
    ]
    assert [h["engine"] for h in entries[0]["blocks"][0]["spans"][0]["hypotheses"]] == ["main", "second"]
    assert go("validate", "--entries", at("c"))[-1] == {"errors": 0, "warnings": 0, "valid": True}
    assert [x["entry_id"] for x in go("search", "--entries", at("c"), "rivers")] == ["lex:p5:e0001"]
    assert "lex:p5:e0001" in [x["id"] for x in go("review", "--entries", at("c"), "--state", "machine")]
    assert {x["source_page"] for x in go("review", "--entries", at("c"), "--by-page")} == {40, 41}
    for form in ("jsonl", "tei", "tables"):
        go("export", "--entries", at("c"), "--format", form, "--out", at("out-" + form))
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((folder / "out-tei").glob("part-*")))
    import xml.etree.ElementTree as ET

    assert len(ET.fromstring(text.encode()).findall(".//{http://www.tei-c.org/ns/1.0}entry")) == 3
    assert spark.read.parquet(at("out-tables/spans")).count() == 8
    assert go("report", "--entries", at("c"))[0]["entries"] == 3


def test_precision_and_recall(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "line string")
    assert tuple(evaluate.precision_recall(ids("l1", "l3"), ids("l1", "l2"), "line").first()) == (0.5, 0.5)
    assert tuple(evaluate.precision_recall(ids(), ids(), "line").first()) == (1.0, 1.0)
