"""Unicode, script and word rules as Column functions (all JVM-side).

Java's ``\\p{Is...}`` script classes are used throughout; ``length`` counts code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALPHA = r"\p{IsAlphabetic}"
ALNUM = r"[\p{IsAlphabetic}\p{N}]"
BIDI = r"[\x{61c}\x{200e}\x{200f}\x{202a}-\x{202e}\x{2066}-\x{2069}]"
PRIVATE = r"[\x{e000}-\x{f8ff}\x{f0000}-\x{ffffd}\x{100000}-\x{10fffd}]"
FOREIGN = r"[\p{IsHebrew}\p{IsArabic}\p{IsSyriac}\p{IsGreek}]"

# ISO 15924 codes of the scripts that are told apart, languages by script, labels.
SCRIPTS = {
    "Hebr": "Hebrew",
    "Arab": "Arabic",
    "Syrc": "Syriac",
    "Grek": "Greek",
    "Latn": "Latin",
    "Cyrl": "Cyrillic",
    "Armn": "Armenian",
    "Geor": "Georgian",
    "Ethi": "Ethiopic",
}
RECOGNISED = ("Hebr", "Arab", "Syrc", "Grek", "Latn")
LANGUAGES = {"heb": "Hebrew", "ara": "Arabic", "syr": "Syriac", "grc": "Greek"}
LANGUAGE_LABELS = {"heb": "heb", "hebr": "heb", "arab": "ara", "arabic": "ara", "syr": "syr", "syriac": "syr", "gr": "grc", "greek": "grc"}
GRAMMAR_LABELS = ("m", "f", "n", "pr", "proper", "pers", "chald", "pil", "piel", "pual", "hithp", "hiph", "hophal")
STEM_LABELS = ("qal", "niph", "niphal", "piel", "pil", "pual", "hiph", "hiphil", "hipu", "hophal", "hithp", "hithpael")
NO_SCRIPT = "Zyyy"
LOW_CONFIDENCE = 0.75

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def trim_space(text: Column) -> Column:
    """Unicode-aware trim."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    """White-space tokens; empty text has none."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def has_bidi(text: Column) -> Column:
    return text.rlike(BIDI)


def strip_bidi(text: Column) -> Column:
    return F.regexp_replace(text, BIDI, "")


def classify_script(text: Column) -> Column:
    """ISO 15924 code if all characters outside Common/Inherited share one listed script."""
    strong = F.regexp_replace(text, r"[\p{IsCommon}\p{IsInherited}\p{IsUnknown}]", "")
    out = F.lit(NO_SCRIPT)
    for code, name in reversed(SCRIPTS.items()):
        out = F.when(strong.rlike(rf"^\p{{Is{name}}}+$"), code).otherwise(out)
    return out


def infer_direction(text: Column) -> Column:
    rtl = text.rlike(r"[\p{IsHebrew}\p{IsArabic}\p{IsSyriac}]")
    ltr = text.rlike(r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}]")
    return F.when(rtl & ltr, "mixed").when(rtl, "rtl").otherwise("ltr")


def trim_not(text: Column, keep: str) -> Column:
    """Cut characters outside the class ``keep`` (written without brackets) from both ends."""
    return F.regexp_replace(text, f"^[^{keep}]+|[^{keep}]+$", "")


def normalized_word(word: Column) -> Column:
    """Letters' core in ASCII lower case; null with any digit or without letters."""
    core = ascii_lower(trim_not(word, ALPHA))
    return F.when(word.rlike(r"\p{N}") | (core == ""), None).otherwise(core)


def begins_with_hebrew(text: Column) -> Column:
    return text.rlike(rf"^[^\p{{IsAlphabetic}}\p{{N}}]*+(?={ALNUM})\p{{IsHebrew}}")


def contains_foreign(text: Column) -> Column:
    return text.rlike(FOREIGN)


def placeholder(text: Column) -> Column:
    """No letter but some ASCII digit or punctuation."""
    return ~text.rlike(ALPHA) & text.rlike(r"[0-9\p{Punct}]")


def plausible_english(text: Column) -> Column:
    core = ascii_lower(trim_not(text, "A-Za-z"))
    return core.rlike("^[a-z]{2,}$") | (core == "a")


def detected_language(text: Column) -> Column:
    """Language of the most frequent of four scripts; of equal counts the last listed."""
    counts = {lang: F.regexp_count(text, F.lit(rf"\p{{Is{name}}}")) for lang, name in LANGUAGES.items()}
    most = F.greatest(*counts.values())
    out = F.lit(None).cast("string")
    for lang, n in counts.items():
        out = F.when((most > 0) & (n == most), lang).otherwise(out)
    return out


def matches_language(text: Column, language: Column) -> Column:
    """At least two thirds of the letters are in the language's script."""
    letters = F.regexp_count(text, F.lit(ALPHA))
    own = F.lit(0)
    for lang, name in LANGUAGES.items():
        own = F.when(language == lang, F.regexp_count(text, F.lit(rf"[\p{{Is{name}}}&&{ALPHA}]"))).otherwise(own)
    return (letters > 0) & (own * 3 >= letters * 2)


def headword_candidate(text: Column) -> Column:
    core = trim_not(text, r"\p{IsAlphabetic}\p{N}")
    numbered = core.rlike(r"^\p{N}*$") & text.rlike(r"[^\p{IsAlphabetic}\p{N}]")
    return (core != "") & (F.length(core) <= 6) & ~core.rlike("^[a-z]*$") & ~numbered


def hebrew_headword(text: Column) -> Column:
    """First Hebrew run with its marks and hyphens, or null."""
    return F.nullif(F.regexp_extract(text, r"\p{IsHebrew}[\p{IsHebrew}\p{IsInherited}\-]*", 0), F.lit(""))


def candidate_index(words: Column) -> Column:
    """1 if the first word is punctuation only, else 0."""
    return F.when((F.size(words) > 0) & ~F.get(words, 0)["text"].rlike(ALNUM), 1).otherwise(0)


def grammar_headword(words: Column) -> Column:
    """The line's headword candidate is followed within three words by a grammatical label."""
    at = candidate_index(words)
    word = F.get(words, at)["text"]
    following = F.transform(F.slice(words, at + 2, 3), lambda w: F.coalesce(normalized_word(w["text"]), F.lit("")))
    label = F.exists(following, lambda w: w.isin(*GRAMMAR_LABELS))
    in_hebrew = (begins_with_hebrew(word) | ~word.rlike("[a-z]")) & (F.get(following, 0) == "in") & F.get(following, 1).isin("heb", "hebr")
    return F.coalesce(word.isNotNull() & headword_candidate(word) & (label | F.coalesce(in_hebrew, F.lit(False))), F.lit(False))


def candidate_headword(words: Column) -> Column:
    word = F.get(words, candidate_index(words))["text"]
    return F.nullif(trim_not(word, r"\p{IsAlphabetic}\p{N}"), F.lit(""))


def stem_word(text: Column) -> Column:
    return F.coalesce(normalized_word(F.get(tokens(text), 0)).isin(*STEM_LABELS), F.lit(False))


def isolated_word_wins(text: Column, confidence: Column, language: Column, was: Column, was_confidence: Column, was_language: Column) -> Column:
    """Whether an isolated word's reading replaces the page's reading."""
    letters = lambda t: F.regexp_count(t, F.lit(ALPHA))
    from .metrics import disagreement

    better = (confidence >= was_confidence + F.lit(0.05)) & (letters(text) * 2 >= letters(was)) & (disagreement(was, text) <= 0.34)
    return matches_language(text, language) & ((was_language != language) | better)


def weighted_confidence(spans: Column, text: str = "text", confidence: str = "confidence") -> Column:
    """Mean confidence weighted by max(length, 1); 0 without spans.  Summed in double."""
    weight = lambda s: F.greatest(F.length(s[text]), F.lit(1))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + weight(s))
    value = F.aggregate(spans, F.lit(0.0), lambda a, s: a + s[confidence].cast("double") * weight(s))
    return F.when(total > 0, value / total).otherwise(0.0)


def code_point(char: Column) -> Column:
    return F.conv(F.hex(F.encode(char, "UTF-32")), 16, 10).cast("int")


def unicode_issues(text: Column) -> Column:
    """Array of (code_point, character_offset, code) for controls, U+FFFD and private use.

    Orphan combining marks need combining classes: see ``udf.unicode_warnings``.
    """
    chars = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    code = lambda c: F.when(c.rlike(BIDI), "embedded_bidi_control").when(c == "\ufffd", "replacement_character").when(c.rlike(PRIVATE), "private_use_character")
    hits = F.filter(chars, lambda x: code(x["c"]).isNotNull())
    return F.transform(
        hits, lambda x: F.struct(F.format_string("U+%04X", code_point(x["c"])).alias("code_point"), x["i"].alias("character_offset"), code(x["c"]).alias("code"))
    )


def xml_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
