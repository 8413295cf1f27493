"""Scalar rules: text, identifiers, metrics, geometry."""

import pytest
from pyspark.sql import functions as F

from foliant.functions import ids, text as tx
from foliant.functions import metrics as mx
from foliant.functions import udf


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return row[0] if len(columns) == 1 else tuple(row)


def lit(*values):
    return [F.lit(v) for v in values]


def test_scripts_and_directions(spark):
    texts = ["שָׁלוֹם", "אב Gen 1:1", "أب،", "ܐܒ", "πατήρ", "plain", "12 :", ""]
    assert one(spark, *[tx.classify_script(F.lit(x)) for x in texts]) == ("Hebr", "Zyyy", "Arab", "Syrc", "Grek", "Latn", "Zyyy", "Zyyy")
    assert one(spark, *[tx.infer_direction(F.lit(x)) for x in texts]) == ("rtl", "mixed", "rtl", "rtl", "ltr", "ltr", "ltr", "ltr")


def test_normal_form_and_warnings(spark):
    assert one(spark, udf.nfc(F.lit("Ω")), udf.nfc(F.lit("ﬃ"))) == ("Ω", "ﬃ")
    assert one(spark, tx.strip_bidi(F.lit("א‏ב Gen"))) == "אב Gen"
    codes = lambda x: [w.code for w in one(spark, udf.unicode_warnings(F.lit(x)))]
    assert codes("a ‏ b") == ["embedded_bidi_control"]
    assert codes("ְא") == ["orphan_combining_mark"] and codes("אְ") == []
    assert [w.code for w in one(spark, tx.unicode_issues(F.lit("x�")))] == ["replacement_character", "private_use_character"]


def test_word_rules(spark):
    assert one(spark, *[tx.matches_language(F.lit(a), F.lit(b)) for a, b in (("חָטָא", "heb"), ("ܐܒܐ", "syr"), ("ܐܒܐ", "heb"), ("father", "heb"))]) == (True, True, False, False)
    wins = lambda t, c, lang, w, wc, wl: tx.isolated_word_wins(*lit(t, c, lang, w, wc, wl))
    assert one(spark, wins("חְטָא", 0.73, "heb", "وو", 0.56, "ara"), wins("دابى", 0.67, "ara", "ابي", 0.57, "ara"), wins("אָבות", 0.80, "heb", "אבות", 0.70, "heb")) == (True, False, True)
    assert one(spark, *[tx.plausible_english(F.lit(x)) for x in ("to", "a", "x", "(the,", "אב")]) == (True, True, False, True, False)
    assert one(spark, *[tx.begins_with_hebrew(F.lit(x)) for x in ("אב", "* (אב", "x אב", "")]) == (True, True, False, False)
    assert one(spark, tx.hebrew_headword(F.lit("1. אָב father")), tx.hebrew_headword(F.lit("none"))) == ("אָב", None)
    assert one(spark, F.size(tx.tokens(F.lit(" a b  c "))), F.size(tx.tokens(F.lit("")))) == (3, 0)


def test_identifiers(spark):
    assert one(spark, ids.entry_id(*lit("First 1854", "xii / 3", 7))) == "first_1854:pxii___3:e0007"
    assert one(spark, ids.headword_id(F.lit("e:span:0001")), ids.headword_id(F.lit("e:span:0002"))) == ("e:headword", "e:span:0002:headword")
    assert one(spark, ids.page_key(F.lit("ix")) < ids.page_key(F.lit("1")), ids.page_key(F.lit("2")) < ids.page_key(F.lit("10"))) == (True, True)
    assert one(spark, ids.page_spec(F.lit("5,1-3,3"))) == [1, 2, 3, 5]
    import hashlib
    import struct

    slot = hashlib.sha256(b"first-1854" + struct.pack("<I", 17)).digest()[0] % 10
    assert one(spark, ids.page_split(*lit("first-1854", 17))) == ("train" if slot <= 6 else "validation" if slot <= 8 else "test")
    assert one(spark, ids.xml_id(F.lit("a:א"))) == "g_a_3a__5d0_"
    want = hashlib.sha256(b"".join(struct.pack("<Q", len(x)) + x for x in (b"ab", "א".encode()))).hexdigest()
    assert one(spark, ids.content_hash(*lit("ab", "א"))) == want


@pytest.mark.parametrize("bad", ["0", "9-2", "", "1,,2", "x"])
def test_bad_page_ranges(spark, bad):
    with pytest.raises(Exception, match="bad page range"):
        one(spark, ids.page_spec(F.lit(bad)))


def test_printed_pages(spark):
    labels = F.create_map(F.lit(3), F.lit("xii"))
    got = [one(spark, ids.printed_page(F.lit(p), F.lit(-16), labels)) for p in (17, 3, 5)]
    assert [(g.label, g.front_matter) for g in got] == [("1", False), ("xii", False), ("front-0005", True)]


def test_error_rates(spark):
    assert one(spark, mx.cer(*lit("", "")), mx.cer(*lit("", "a")), mx.cer(*lit("abc", "abd"))) == (0.0, 1.0, pytest.approx(1 / 3))
    assert one(spark, mx.wer(*lit("The name Aleph", "Tue name Aleph")), mx.wer(*lit("a b", "a b c"))) == (pytest.approx(1 / 3), 0.5)
    assert one(spark, mx.script_cer(*lit("אב ab", "אג ab"))) == {"Hebr": 0.5, "Latn": 0.0}
    assert one(spark, mx.disagreement(*lit("ab", "cdef")), mx.disagreement(*lit("", ""))) == (1.0, 0.0)


def test_geometry(spark):
    box = lambda *v: F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(v, ("x1", "y1", "x2", "y2"))])
    a, b, empty = box(0, 0, 2, 2), box(1, 0, 3, 2), box(1, 1, 1, 1)
    assert one(spark, mx.iou(a, b), mx.overlap_fraction(a, b), mx.iou(empty, empty)) == (pytest.approx(1 / 3), 0.5, 0.0)
    polygon = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((1.4, 2.6), (5.0, 9.0))])
    assert tuple(one(spark, mx.rounded_box(polygon))) == (1, 3, 4, 6)
    assert tuple(one(spark, mx.padded_box(mx.box(polygon), F.lit(2), F.lit(6), F.lit(100)))) == (0, 0, 6, 11)


def test_weighted_confidence(spark):
    spans = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(c).alias("confidence")) for t, c in (("abcd", 1.0), ("", 0.5))])
    assert one(spark, tx.weighted_confidence(spans)) == pytest.approx(0.9)
    assert one(spark, tx.weighted_confidence(F.filter(spans, lambda s: F.lit(False)))) == 0.0
