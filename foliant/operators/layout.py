"""Page layout: line predicates, entry and block segmentation as windows, word languages.

Input is the ``lines`` table (``schemas.LINE``), one row per recognised line; every window is keyed by
page or by a chain of consecutive pages, so partitions are as large as a page or a book and never
grow with the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import ids, text as tx

PAGE = ["edition", "source_page"]
ORDER = ["region_ord", "line_ord"]

# Fixed values of the layout rules, as shares of page or line size.
MARGIN_TOP, MARGIN_BOTTOM = 0.05, 0.975
ARTIFACT = 0.02
INDENT = 0.7
NARROW = 0.2
HEADING_WIDTH, HEADING_CHARS, HEADING_WORDS, HEADING_LINES = 0.65, 100, 12, 3
CENTRE = 0.05


def col(name: str) -> Column:
    return F.col(name)


def is_margin() -> Column:
    return (col("page_h") != 0) & col("h").isNotNull() & ((col("y") < col("page_h") * MARGIN_TOP) | (col("y") + col("h") > col("page_h") * MARGIN_BOTTOM))


def is_artifact() -> Column:
    return col("text").rlike(r"^[0-9\p{Punct}]*$") & (col("w") <= col("page_w") * ARTIFACT) & (col("h") <= col("page_h") * ARTIFACT)


def is_heading() -> Column:
    """Compact line in a region of at most three lines, across the page's middle or in capitals.

    Needs ``region_lines``."""
    letters, capitals = F.regexp_count("text", F.lit(tx.ALPHA)), F.regexp_count("text", F.lit(r"\p{IsUppercase}"))
    middle = (col("x") <= col("page_w") / 2 - col("page_w") * CENTRE) & (col("x") + col("w") >= col("page_w") / 2 + col("page_w") * CENTRE)
    compact = (col("w") <= col("page_w") * HEADING_WIDTH) & (F.length("text") <= HEADING_CHARS) & (F.size(tx.tokens(col("text"))) <= HEADING_WORDS)
    return compact & (col("region_lines") <= HEADING_LINES) & (middle | ((letters > 0) & (capitals * 5 >= letters * 4)))


def column_of() -> Column:
    return (col("x") + F.floor(col("w") / 2) >= F.floor(col("page_w") / 2)).cast("int")


def _indented(start: Column) -> Column:
    return F.coalesce(F.greatest(col("x") - start, F.lit(0)) >= F.greatest(col("h"), F.lit(1)) * INDENT, F.lit(False))


def upper_median(values: Column) -> Column:
    """Upper median of an array: the element at n // 2 of the sorted array."""
    s = F.array_sort(values)
    return F.try_element_at(s, (F.floor(F.size(s) / 2) + 1).cast("int"))


def with_layout(lines: DataFrame) -> DataFrame:
    """Adds margin, artifact, heading, page column, its start, and the two indentations."""
    counted = lines.withColumn("region_lines", F.count(F.lit(1)).over(Window.partitionBy(*PAGE, "region_ord")))
    flagged = counted.withColumns({"margin": is_margin(), "artifact": is_artifact(), "heading": is_heading(), "page_column": column_of()})
    plain = ~(col("margin") | col("artifact") | col("heading") | (col("w") <= col("page_w") * NARROW))
    starts = F.collect_list(F.when(plain, col("x"))).over(Window.partitionBy(*PAGE, "page_column"))
    started = flagged.withColumn("column_start", upper_median(starts))
    return started.withColumns({"indented": _indented(col("column_start")), "entry_indented": _indented(col("column_start")) | _indented(col("region_x"))})


def chains(pages: DataFrame) -> DataFrame:
    """Maximal runs of consecutive pages: distinct ``(edition, source_page)`` plus ``chain``."""
    distinct = pages.select(*PAGE).distinct()
    return distinct.withColumn("chain", F.col("source_page") - F.row_number().over(Window.partitionBy("edition").orderBy("source_page")))


def segment(lines: DataFrame, hypotheses: DataFrame | None = None) -> DataFrame:
    """Assign every line: ``kind`` (entry, front_matter, unparsed) and, for entry lines, the entry's
    number in its chain, id and headword, block number and kind, and span number.

    ``lines`` needs ``printed_page`` and ``front_matter`` beside ``schemas.LINE``; ``hypotheses`` gives
    aligned readings ``(edition, source_page, region_ord, line_ord, hypothesis_text)``.
    """
    # the rules on words need one line only; the windows and shuffles after them need not carry the words
    words = lines.withColumns({"grammar": tx.grammar_headword(col("words")), "_candidate": tx.candidate_headword(col("words"))})
    # dealt by page once: the windows over regions and columns of a page, and the join, need no other shuffle
    laid = with_layout(words.repartition(*[col(c) for c in PAGE])).join(chains(lines), PAGE)
    if hypotheses is None:
        stem = tx.stem_word(col("text"))
    else:
        stems = hypotheses.groupBy(*PAGE, *ORDER).agg(F.max(tx.stem_word(col("hypothesis_text"))).alias("hypothesis_stem"))
        laid = laid.join(stems, [*PAGE, *ORDER], "left")
        stem = tx.stem_word(col("text")) | F.coalesce(col("hypothesis_stem"), F.lit(False))
    lexical = ~col("front_matter") & ~col("margin") & ~col("artifact")
    marked = laid.withColumns({"lexical": lexical, "stem": stem, "block_kind": F.when(col("heading"), "heading").otherwise("paragraph")})
    page = Window.partitionBy(*PAGE).orderBy(*ORDER)
    upto = page.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("stretch", F.sum((col("margin") & ~col("front_matter")).cast("int")).over(upto))
    rest = marked.where(~col("lexical"))
    own = marked.where(col("lexical"))
    chain = Window.partitionBy("edition", "chain").orderBy("source_page", *ORDER)
    whole_page = Window.partitionBy(*PAGE)
    own = own.withColumn("place", F.row_number().over(chain)).withColumn("carried", F.min("place").over(whole_page) > 1)
    first = col("place") == 1
    starts = (tx.begins_with_hebrew(col("text")) | col("grammar")) & ~col("stem") & (first | col("entry_indented") | col("grammar"))
    own = own.withColumn("starts", starts).withColumn("opens", col("starts") | first)
    so_far = chain.rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("entry_no", F.sum(col("opens").cast("int")).over(so_far)).withColumn("page_ordinal", F.sum(col("opens").cast("int")).over(upto))
    entry = Window.partitionBy("edition", "chain", "entry_no").orderBy("source_page", *ORDER)
    stretch = Window.partitionBy(*PAGE, "stretch").orderBy(*ORDER)
    before = F.lag(F.struct("region_id", "y", "h")).over(stretch)
    gap = F.greatest(col("y") - (col("before.y") + col("before.h")), F.lit(0))
    near = (col("before.region_id") == col("region_id")) & (gap <= F.greatest(col("before.h"), col("h"), F.lit(1)))
    same = F.when(col("heading"), near).otherwise(~col("indented"))
    continues = (
        ~col("starts")
        & F.coalesce(col("kind_before") == col("block_kind"), F.lit(False))
        & F.when(col("before").isNotNull(), same).otherwise(col("carried") & ~col("heading") & ~col("indented"))
    )
    own = own.withColumns({"before": before, "kind_before": F.lag("block_kind").over(entry)}).withColumn("continues", continues)
    entry_upto = entry.rowsBetween(Window.unboundedPreceding, 0)
    opening = F.first(F.struct("printed_page", "page_ordinal")).over(entry_upto)
    plain = tx.hebrew_headword(tx.strip_bidi(col("text")))
    own = own.withColumn("_head", F.struct(F.when(col("starts"), F.coalesce(F.when(col("grammar"), col("_candidate")), plain)).alias("headword")))
    own = own.withColumns(
        {"block_no": F.sum((~col("continues")).cast("int")).over(entry_upto), "span_no": F.row_number().over(entry), "opening": opening, "_head": F.first("_head").over(entry_upto)}
    )
    o = col("opening")
    named = own.withColumns({"kind": F.lit("entry"), "entry_id": ids.entry_id(col("edition"), o["printed_page"], o["page_ordinal"]), "entry_page": o["printed_page"], "entry_ordinal": o["page_ordinal"], "headword": col("_head")["headword"]})
    columns = [*lines.columns, "chain", "kind", "entry_no", "entry_id", "entry_page", "entry_ordinal", "headword", "block_no", "block_kind", "span_no"]
    missing = {
        "kind": F.when(col("front_matter"), "front_matter").otherwise("unparsed"),
        "entry_no": F.lit(None).cast("long"), "entry_id": F.lit(None).cast("string"), "entry_page": F.lit(None).cast("string"), "entry_ordinal": F.lit(None).cast("long"),
        "headword": F.lit(None).cast("string"), "block_no": F.lit(None).cast("long"), "block_kind": F.lit(None).cast("string"), "span_no": F.lit(None).cast("int"),
    }
    return named.select(*columns).unionByName(rest.withColumns(missing).select(*columns))


# ---- word languages -------------------------------------------------------------------------------


def _hint(text: Column) -> Column:
    core = tx.ascii_lower(tx.trim_not(text, tx.ALPHA))
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in tx.LANGUAGE_LABELS.items() for x in pair]), core)


def may_be_foreign(words: Column) -> Column:
    """False only where no word can get a language from its script, a label or its neighbours, nor has one."""
    label = rf"(?<![\p{{IsAlphabetic}}])(?i:{'|'.join(tx.LANGUAGE_LABELS)})(?![\p{{IsAlphabetic}}])"
    written = F.array_join(words["text"], " ").rlike(rf"{tx.FOREIGN}|{label}")
    return F.coalesce(written, F.lit(False)) | F.array_max(words["language"]).isNotNull()


def _doubtful(word: Column) -> Column:
    return (word["confidence"] < F.lit(tx.LOW_CONFIDENCE)) | tx.placeholder(word["text"])


def _with_language(word: Column, language: Column) -> Column:
    return word.withField("language", language)


def label_hints(words: Column, supported: Column) -> Column:
    """A language label ("Heb.", "Arab.") names the next word's language if that word is doubtful."""

    def one(word: Column, i: Column) -> Column:
        hint = _hint(F.get(words, i - 1)["text"])
        use = (i > 0) & word["language"].isNull() & _doubtful(word) & F.array_contains(supported, hint)
        return _with_language(word, F.when(use, hint).otherwise(word["language"]))

    return F.transform(words, one)


def enumerations(words: Column, kind: str) -> Column:
    """``X and Y``: Y takes X's language.  A fold, since ``X and Y and Z`` carries on."""

    def one(done: Column, word: Column) -> Column:
        n = F.size(done)
        earlier = F.get(done, n - 2)["language"]
        use = earlier.isNotNull() & (tx.ascii_lower(F.get(done, n - 1)["text"]) == "and") & word["language"].isNull() & _doubtful(word)
        return F.concat(done, F.array(_with_language(word, F.when(F.coalesce(use, F.lit(False)), earlier).otherwise(word["language"]))))

    return F.aggregate(words, F.array().cast(f"array<{kind}>"), one)


def smooth_runs(words: Column) -> Column:
    """In a run of three or more foreign words of two letters each, a two-thirds majority wins."""
    n = F.size(words)
    gaps = F.filter(F.sequence(F.lit(-1), n), lambda j: (j < 0) | (j >= n) | F.get(words, j)["language"].isNull())

    def one(word: Column, i: Column) -> Column:
        low, high = F.array_max(F.filter(gaps, lambda j: j < i)), F.array_min(F.filter(gaps, lambda j: j > i))
        run = F.slice(words, low + 2, high - low - 1)
        count = lambda lang: F.size(F.filter(run, lambda w: w["language"] == lang))
        ranked = F.array_max(F.array(*[F.struct(count(lang).alias("n"), F.lit(lang).alias("lang")) for lang in sorted(tx.LANGUAGES)]))
        long_ = F.forall(run, lambda w: F.regexp_count(w["text"], F.lit(tx.ALPHA)) >= 2)
        use = word["language"].isNotNull() & (F.size(run) >= 3) & long_ & (ranked["n"] * 3 >= F.size(run) * 2)
        return _with_language(word, F.when(use, ranked["lang"]).otherwise(word["language"]))

    return F.transform(words, one)


def headword_hint(words: Column, supported: Column, indented: Column) -> Column:
    """A grammatically labelled candidate is Hebrew; a leading one only on an indented line."""
    at = tx.candidate_index(words)
    use = F.array_contains(supported, "heb") & (indented | (at == 1)) & tx.grammar_headword(words)
    return F.when(use, F.transform(words, lambda w, i: _with_language(w, F.when(i == at, "heb").otherwise(w["language"])))).otherwise(words)


def starred_lines(lines: DataFrame) -> DataFrame:
    """Lines to the right of a star that share its height: a range semi-join within a page."""
    stars = lines.where(tx.trim_space(col("text")) == "*").select(*[col(c).alias("s_" + c) for c in PAGE], (col("x") + col("w")).alias("s_right"), col("y").alias("s_top"), (col("y") + col("h")).alias("s_bottom"))
    keys = [col(c) == col("s_" + c) for c in PAGE]
    return lines.join(stars, [*keys, col("x") >= col("s_right"), col("y") < col("s_bottom"), col("y") + col("h") > col("s_top")], "left_semi")


def classify_languages(lines: DataFrame, supported: list[str]) -> DataFrame:
    """``lines`` with a language on every explicitly foreign word of a supported language."""
    kind = lines.schema["words"].dataType.elementType.simpleString()
    langs = F.array(*[F.lit(x) for x in supported]).cast("array<string>")
    detected = lambda w: F.when(F.array_contains(langs, tx.detected_language(w["text"])), tx.detected_language(w["text"]))
    # most lines have nothing foreign: they pass as they are
    out = with_layout(lines).withColumn("_foreign", may_be_foreign(col("words")))
    found = lambda w: F.when(w["text"].rlike(tx.FOREIGN), detected(w))
    steps = (lambda w: F.transform(w, lambda x: _with_language(x, found(x))), lambda w: label_hints(w, langs), lambda w: enumerations(w, kind), smooth_runs)
    for step in steps:
        out = out.withColumn("words", F.when(col("_foreign"), step(col("words"))).otherwise(col("words")))
    out = out.withColumn("words", headword_hint(col("words"), langs, col("entry_indented")))
    starred = starred_lines(lines).select(*PAGE, *ORDER, F.lit(True).alias("starred"))
    out = out.join(starred, [*PAGE, *ORDER], "left")
    use = F.coalesce(col("starred"), F.lit(False)) & F.array_contains(langs, "heb")
    starred_words = F.transform("words", lambda w, i: _with_language(w, F.when((i == 0) & w["language"].isNotNull(), "heb").otherwise(w["language"])))
    out = out.withColumn("words", F.when(use, starred_words).otherwise(col("words")))
    return out.select(*lines.columns)
