"""The words of a line are not carried through the shuffles of the layout."""

from pyspark.sql import functions as F

from foliant import queries
from foliant.operators import layout
from test_layout import BOX, make

DATA = "/root/testdata/sf0.001"


def carried(df, column):
    """Windows and joins of the plan that hand on ``column``."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() in ("Window", "Join") and f"{column}#" in node.output().toString():
            found.append(node.nodeName())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_segment_does_not_shuffle_words(spark):
    assert carried(layout.segment(queries._laid_out(spark, DATA)), "words")
    out = queries.segment_pages(spark, DATA)
    assert carried(out, "source_page") and not carried(out, "words")


def test_plain_lines_pass_and_foreign_ones_do_not(spark, monkeypatch):
    """The same languages as when every line goes through all rules; a plain line of many words is not folded word by word."""
    texts = ["plain prose and more", "see Heb. 1|2 and 33", "(ARABIC) 11 and 22", "hebraic 12 and 13", "אבג דהו ابت זחט", "x αβ and 12", "RN m. name", "", "gr 4", "a" + " w" * 12000]
    lines = make(spark, {n: [("r", BOX, [("l", (138, 300, 400, 45), x)])] for n, x in enumerate(texts, 1)})
    told = lambda df: {r.source_page: [w.language for w in r.words] for r in layout.classify_languages(df, ["heb", "ara", "grc"]).select("source_page", "words").collect()}
    got = told(lines)
    assert len(got) == len(texts) and got[10] == [None] * 12001 and got[2] == [None, None, "heb", None, "heb"] and got[3] == [None, "ara", None, "ara"]
    short = lines.where("source_page < 10")
    monkeypatch.setattr(layout, "may_be_foreign", lambda words: F.lit(True))
    assert told(short) == {k: v for k, v in got.items() if k < 10}
