"""The corpus of entries: spans, replay of corrections, upserts, validation, review, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions import ids, text as tx
from ..functions import udf

LOW_CONFIDENCE, DISAGREEMENT = 0.80, 0.15


def _empty_spans() -> Column:
    return F.from_json(F.lit("[]"), schemas.array(schemas.SPAN))


def all_spans(e: Column | None = None) -> Column:
    """Every span of an entry in fixed order: headword, labels, blocks, senses, citations,
    cross references, etymology."""
    c = (lambda name: F.col(name)) if e is None else (lambda name: e[name])
    some = lambda x: F.coalesce(x, _empty_spans())
    blocks = lambda b: some(F.flatten(F.transform(b, lambda x: x["spans"])))
    return F.concat(
        F.when(c("headword").isNotNull(), F.array(c("headword"))).otherwise(_empty_spans()),
        some(c("grammatical_labels")),
        blocks(c("blocks")),
        some(F.flatten(F.transform(c("senses"), lambda s: F.flatten(F.transform(s["blocks"], lambda x: x["spans"]))))),
        some(F.transform(c("citations"), lambda x: x["text"])),
        some(F.transform(c("cross_references"), lambda x: x["text"])),
        blocks(c("etymology")),
    )


def spans(entries: DataFrame) -> DataFrame:
    """One row per span: entry id, position, and the span's fields."""
    return entries.select(F.col("id").alias("entry_id"), "edition", F.posexplode(all_spans()).alias("position", "span"))


def refreshed(span: Column, state: Column, normalized: Column, warnings: Column) -> Column:
    """A span with its derived fields recomputed; the two Python results are passed in."""
    return span.withField("normalized", normalized).withField("script", tx.classify_script(normalized)).withField("direction", tx.infer_direction(normalized)).withField("warnings", warnings).withField("review_state", state)


# ---- replay and upsert ------------------------------------------------------------------------------


def replay_issues(base: DataFrame, patches: DataFrame) -> DataFrame:
    """Every reason why the log cannot be replayed: ``seq, entry_id, code``.

    ``patches`` carries ``seq``, its place in the log."""
    known = base.select(F.col("id").alias("b_id"), F.col("revision").alias("b_revision"))
    joined = patches.join(known, F.col("entry_id") == F.col("b_id"), "left")
    expected = F.coalesce(F.lag("revision").over(Window.partitionBy("entry_id").orderBy("seq")), F.col("b_revision"))
    checked = joined.withColumn("expected", expected)
    code = (
        F.when(F.col("b_id").isNull(), "unknown_entry")
        .when(F.col("base_revision") != F.col("expected"), "revision_conflict")
        .when(F.col("revision") != F.col("base_revision") + 1, "revision_step")
        .when((F.col("replacement.id") != F.col("entry_id")) | (F.col("replacement.revision") != F.col("revision")), "replacement_mismatch")
    )
    repeated = base.groupBy("id").count().where("count > 1").select(F.lit(None).cast("long").alias("seq"), F.col("id").alias("entry_id"), F.lit("duplicate_base_id").alias("code"))
    return checked.select("seq", "entry_id", code.alias("code")).where("code IS NOT NULL").unionByName(repeated)


def replay(base: DataFrame, patches: DataFrame, strict: bool = True) -> DataFrame:
    """Base entries with the last replacement of each patched one.  Strict: any issue fails the read."""
    if strict:
        first = replay_issues(base, patches).orderBy("seq").first()
        if first is not None:
            raise ValueError(f"revision conflict or bad log: {first.asDict()}")
    last = patches.groupBy("entry_id").agg(F.max_by("replacement", "seq").alias("replacement"))
    joined = base.join(last, F.col("id") == F.col("entry_id"), "left")
    return joined.select(*[F.when(F.col("replacement").isNotNull(), F.col("replacement")[c]).otherwise(F.col(c)).alias(c) for c in base.columns])


def min_source_page(entry_spans: Column | None = None) -> Column:
    s = all_spans() if entry_spans is None else entry_spans
    return F.array_min(F.flatten(F.transform(s, lambda x: F.transform(x["coordinates"], lambda c: c["source_page"]))))


def merge_pages(base: DataFrame, parsed: DataFrame, pages: DataFrame) -> DataFrame:
    """Replace the selected ``pages(source_page)``: base entries that begin on one go, parsed entries
    come in, of equal ids the last parsed wins (``seq``)."""
    kept = base.withColumn("_page", min_source_page()).join(pages.select(F.col("source_page").alias("_page")).distinct(), "_page", "left_anti").drop("_page")
    both = kept.withColumn("seq", F.lit(-1).cast("long")).unionByName(parsed.withColumn("seq", F.col("seq").cast("long")))
    newest = F.row_number().over(Window.partitionBy("id").orderBy(F.col("seq").desc()))
    return both.withColumn("_rank", newest).where("_rank = 1").drop("_rank", "seq")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], order: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """General form on flat tables: the change with the greatest ``order`` wins, of equal ones the first by ``ties``,
    else the base row.  Every base row of a changed key takes the change."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc(), *ties)
    ranked = changes.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").select(*keys, F.struct(*base.columns).alias("_change"))
    return base.join(ranked, keys, "full").select(*[F.when(F.col("_change").isNotNull(), F.col("_change")[c]).otherwise(F.col(c)).alias(c) for c in base.columns])


# ---- validation -------------------------------------------------------------------------------------


def _issue(rule: Column, code: str, location: Column, severity: str = "error") -> Column:
    return F.when(F.coalesce(rule, F.lit(False)), F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), location.alias("location")))


def _blank(x: Column) -> Column:
    return x.isNull() | (tx.trim_space(x) == "")


def _bad_share(x: Column) -> Column:
    return ~F.coalesce(x.between(0.0, 1.0) & ~F.isnan(x), F.lit(False))


def validate(entries: DataFrame) -> DataFrame:
    """All rule violations as ``severity, code, location``; one pass for row rules, one window each
    for the three kinds of duplicates."""
    e = entries.withColumns({"_spans": all_spans(), "_derived": ids.entry_id(F.col("edition"), F.col("printed_page"), F.col("entry_ordinal"))})
    at = F.col("id")
    own = F.coalesce(F.col("aliases"), F.array().cast("array<string>"))
    rules = [
        _issue(F.array_contains(own, at), "self_alias", at),
        _issue((at != F.col("_derived")) & ~F.array_contains(own, F.col("_derived")), "unstable_entry_id", at),
        _issue(F.col("edition") != F.col("provenance.edition"), "edition_provenance_mismatch", at),
        _issue(~ids.is_sha256(F.col("provenance.source_sha256")), "invalid_source_hash", at),
        _issue(_blank(F.col("provenance.scan_id")) | _blank(F.col("provenance.pipeline_run")), "incomplete_provenance", at),
        _issue(_bad_share(F.col("confidence")), "invalid_confidence", at),
        _issue((F.col("revision") == 0) & (F.col("review_state") != "machine"), "invalid_review_revision", at),
        _issue(F.size("blocks") == 0, "empty_entry", at),
    ]
    of_entry = e.select(F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("i")).select("i.*")
    s = e.select("id", F.explode("_spans").alias("s")).withColumn("_nfc", udf.nfc(F.col("s.diplomatic")))
    n = F.col("s.normalized")
    where = F.col("s.id")
    span_rules = [
        _issue(n != F.col("_nfc"), "normalization_mismatch", where),
        _issue(F.col("s.script") != tx.classify_script(n), "script_mismatch", where),
        _issue((F.col("s.direction") != tx.infer_direction(n)) & (F.col("s.direction") != "mixed"), "direction_mismatch", where),
        _issue(tx.has_bidi(F.col("s.diplomatic")) | tx.has_bidi(n), "embedded_bidi_control", where),
        _issue(F.contains(F.col("s.diplomatic"), F.lit("�")) | F.contains(n, F.lit("�")), "replacement_character", where),
        _issue(_bad_share(F.col("s.confidence")), "invalid_confidence", where),
        _issue(F.coalesce(F.size("s.coordinates"), F.lit(0)) <= 0, "missing_coordinates", where),
        _issue((F.col("s.review_state") == "machine") & (F.coalesce(F.size("s.hypotheses"), F.lit(0)) <= 0), "missing_ocr_provenance", where),
        _issue(
            F.exists(
                F.when(F.size("s.hypotheses") >= 2, F.sequence(F.lit(0), F.size("s.hypotheses") - 2)).otherwise(F.array().cast("array<int>")),
                lambda i: (F.get("s.hypotheses", i)["engine"] == F.get("s.hypotheses", i + 1)["engine"]) & (F.get("s.hypotheses", i)["model"] == F.get("s.hypotheses", i + 1)["model"]),
            ),
            "duplicate_ocr_model", where, "warning",
        ),
    ]
    bad_place = lambda c: (c["source_page"] == 0) | _blank(c["region_id"]) | _blank(c["line_id"]) | (F.coalesce(F.size(c["polygon"]), F.lit(0)) < 3)
    bad_reading = lambda h: _blank(h["engine"]) | _blank(h["engine_version"]) | _blank(h["model"]) | ~ids.is_sha256(h["model_hash"]) | _bad_share(h["confidence"])
    each = lambda items, bad, code: F.transform(F.filter(items, bad), lambda _: F.struct(F.lit("error").alias("severity"), F.lit(code).alias("code"), where.alias("location")))
    found = F.concat(
        F.filter(F.array(*span_rules), lambda x: x.isNotNull()),
        F.coalesce(each(F.col("s.coordinates"), bad_place, "incomplete_coordinates"), F.array().cast("array<struct<severity:string,code:string,location:string>>")),
        F.coalesce(each(F.col("s.hypotheses"), bad_reading, "incomplete_ocr_provenance"), F.array().cast("array<struct<severity:string,code:string,location:string>>")),
    )
    of_span = s.select(F.explode(found).alias("i")).select("i.*")
    again = lambda df, key, code: df.groupBy(key).count().where("count > 1").select(F.lit("error").alias("severity"), F.lit(code).alias("code"), F.col(key).alias("location"), F.explode(F.sequence(F.lit(2).cast("long"), F.col("count"))).alias("_n")).drop("_n")
    return (
        of_entry.unionByName(of_span)
        .unionByName(again(entries.select("id"), "id", "duplicate_entry_id"))
        .unionByName(again(e.select(F.explode(own).alias("alias")), "alias", "duplicate_alias"))
        .unionByName(again(s.select(where.alias("span_id")), "span_id", "duplicate_span_id"))
    )


def validate_assignments(assignments: DataFrame, entries: DataFrame) -> DataFrame:
    """Line assignments against entries, per page: identity, duplicates, missing and unassigned lines.

    ``entries`` are the pages' own entries with ``source_page``."""
    page = ["edition", "source_page"]
    line = [*page, "region_id", "line_id"]
    where = F.concat_ws(":", "edition", F.col("source_page").cast("string"), "region_id", "line_id").alias("location")
    make = lambda df, code: df.select(F.lit("error").alias("severity"), code.alias("code"), where)
    placed = entries.select("edition", F.col("source_page").alias("_page"), F.explode(F.flatten(F.transform("blocks", lambda b: F.flatten(F.transform(b["spans"], lambda s: s["coordinates"]))))).alias("c"))
    placed = placed.where("c.source_page = _page").select("edition", F.col("c.source_page").alias("source_page"), "c.region_id", "c.line_id")
    # one row per line with its number of assignments decides all but the missing entries
    both = assignments.select(*line, F.lit(1).cast("long").alias("_n"), F.lit(False).alias("_placed")).unionByName(placed.withColumns({"_n": F.lit(0).cast("long"), "_placed": F.lit(True)}))
    per_line = both.groupBy(*line).agg(F.sum("_n").alias("_n"), F.bool_or("_placed").alias("_placed"))
    blank = _blank(F.col("region_id")) | _blank(F.col("line_id"))
    nameless = F.col("edition").isNull() | F.col("source_page").isNull() | F.col("region_id").isNull() | F.col("line_id").isNull()
    codes = F.concat(
        F.when(blank, F.array_repeat(F.lit("empty_line_identity"), F.col("_n").cast("int"))).otherwise(F.array().cast("array<string>")),
        F.array_repeat(F.lit("duplicate_line_assignment"), F.greatest(F.col("_n") - 1, F.lit(0)).cast("int")),
        F.when(F.col("_placed") & ((F.col("_n") == 0) | nameless), F.array(F.lit("unassigned_recognized_line"))).otherwise(F.array().cast("array<string>")),
    )
    found = per_line.select(*line, F.explode(codes).alias("_code"))
    own = entries.select(*page, F.col("id").alias("entry_id")).distinct()
    missing = assignments.where("kind = 'entry'").join(own, [*page, "entry_id"], "left_anti")
    return make(found, F.col("_code")).unionByName(make(missing, F.lit("missing_assigned_entry")))


def broken_references(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose non-null ``key`` has no parent."""
    p = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.where(F.col(key).isNotNull()).join(p, F.col(key) == F.col("_parent"), "left_anti")


# ---- review -----------------------------------------------------------------------------------------


def review_summary(entries: DataFrame, threshold: float = LOW_CONFIDENCE, disagreement: float = DISAGREEMENT) -> DataFrame:
    """Per entry: warnings, greatest disagreement of the first two readings, and whether it is queued."""
    kept = ["id", "edition", "printed_page", "entry_ordinal", "confidence", "review_state", "revision"]
    spans_of = entries.select(*kept, F.col("headword.normalized").alias("headword"), all_spans().alias("_spans"))
    two = F.filter("_spans", lambda x: F.size(x["hypotheses"]) >= 2)
    read = lambda k: F.transform(two, lambda x: F.get(x["hypotheses"], k)["text"])
    out = spans_of.select(
        *kept[:4], "headword", *kept[4:],
        F.aggregate("_spans", F.lit(0), lambda a, x: a + F.greatest(F.coalesce(F.size(x["warnings"]), F.lit(0)), F.lit(0))).alias("warnings"),
        F.coalesce(F.array_max(udf.disagreements(read(0), read(1))), F.lit(0.0)).alias("disagreement"),
    )
    doubt = (F.col("confidence") < F.lit(threshold).cast("float")) | (F.col("warnings") > 0) | (F.col("disagreement") > disagreement)
    return out.withColumn("queued", (F.col("review_state") == "machine") & doubt)


def review_pages(entries: DataFrame) -> DataFrame:
    """Per page its entries, each with the polygons of its spans there."""
    s = entries.select("id", "edition", F.explode(all_spans()).alias("s")).select("id", "edition", F.explode("s.coordinates").alias("c"))
    per_entry = s.groupBy("edition", F.col("c.source_page").alias("source_page"), "id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("c.line_id").alias("line_id"), F.col("c.polygon").alias("polygon")))).alias("polygons"), F.max("c.page_image").alias("image")
    )
    return per_entry.groupBy("edition", "source_page").agg(F.max("image").alias("image"), F.array_sort(F.collect_list(F.struct("id", "polygons"))).alias("entries"))


# ---- comparison, manifest, training -----------------------------------------------------------------


def edition_statistics(entries: DataFrame, entry_spans: DataFrame) -> DataFrame:
    """Per edition: entries, review states, pages, mean confidence, doubtful and headless entries."""
    e = entries.groupBy("edition").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(F.col("review_state") == "machine").alias("machine"), F.count_if(F.col("review_state") == "corrected").alias("corrected"),
        F.count_if(F.col("review_state") == "verified").alias("verified"), F.count_distinct("printed_page").alias("printed_pages"), F.avg(F.col("confidence").cast("double")).alias("mean_confidence"),
        F.count_if((F.col("review_state") == "machine") & (F.col("confidence") < F.lit(LOW_CONFIDENCE).cast("float"))).alias("low_confidence"), F.count_if(F.col("headword").isNull()).alias("missing_headwords"),
    )
    pages = entry_spans.select("edition", F.explode("span.coordinates").alias("c")).groupBy("edition").agg(F.count_distinct("c.source_page").alias("source_pages"))
    scripts = entry_spans.groupBy("edition", F.col("span.script").alias("script")).count().groupBy("edition").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("script", "count")))).alias("scripts"))
    return e.join(pages, "edition", "left").join(scripts, "edition", "left")


def headword_differences(headed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``headed(key, edition, text, seq)`` -> headwords of one edition only, and headwords whose texts
    differ between editions (per edition the last text counts)."""
    last = headed.groupBy("key", "edition").agg(F.max_by("text", "seq").alias("text"))
    grouped = last.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("edition", "text"))).alias("texts"))
    several = headed.agg(F.count_distinct("edition").alias("n")).select((F.col("n") > 1).alias("several"))
    only = grouped.where(F.size("texts") == 1).select("key", F.col("texts")[0]["edition"].alias("edition")).join(F.broadcast(several), F.col("several"))
    differ = grouped.where((F.size("texts") > 1) & (F.size(F.array_distinct(F.transform("texts", lambda t: t["text"]))) > 1))
    return only.drop("several"), differ


def entry_text() -> Column:
    """All block text of an entry, one space between spans."""
    return F.array_join(F.flatten(F.transform("blocks", lambda b: F.transform(b["spans"], lambda s: s["normalized"]))), " ")


def manifest(entries: DataFrame, corpus_version: str, commit: str, generated_at: Column) -> DataFrame:
    """One row; an edition or model with two hashes is an error."""

    def single(df: DataFrame, key: Column, value: Column, name: str) -> DataFrame:
        per = df.groupBy(key.alias("key")).agg(F.collect_set(value).alias("v"))
        checked = per.select("key", F.when(F.size("v") > 1, F.raise_error(F.concat(F.lit("conflicting hashes: "), "key")).cast("string")).otherwise(F.get("v", 0)).alias("value"))
        return checked.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias(name))

    readings = entries.select(F.explode(all_spans()).alias("s")).select(F.explode("s.hypotheses").alias("h"))
    sources = single(entries, F.col("edition"), F.col("provenance.source_sha256"), "source_hashes")
    models = single(readings, F.concat_ws(":", "h.engine", "h.model"), F.col("h.model_hash"), "model_hashes")
    totals = entries.agg(F.count(F.lit(1)).alias("entry_count"), F.coalesce(F.bool_or(F.col("review_state") != "verified"), F.lit(False)).alias("draft"))
    one = F.lit(1)
    joined = totals.withColumn("_k", one).join(sources.withColumn("_k", one), "_k").join(models.withColumn("_k", one), "_k").drop("_k")
    return joined.select(F.lit(corpus_version).alias("corpus_version"), F.lit("1.1.0").alias("schema_version"), F.lit(commit).alias("pipeline_commit"), generated_at.alias("generated_at"), "source_hashes", "model_hashes", "entry_count", "draft")


def ground_truth(entries: DataFrame, pilot: DataFrame) -> DataFrame:
    """Reviewed lines of the pilot pages, first seen per (edition, page, line), with their split."""
    chosen = entries.join(pilot.select("edition", "printed_page").distinct(), ["edition", "printed_page"], "left_semi")
    s = chosen.select("id", "edition", "printed_page", F.posexplode(all_spans()).alias("position", "s")).where((F.col("s.review_state") != "machine") & (F.size("s.coordinates") > 0))
    c = F.get("s.coordinates", 0)
    rows = s.select("edition", "printed_page", c["source_page"].alias("source_page"), c["line_id"].alias("line_id"), F.col("s.normalized").alias("text"), F.col("s.hypotheses").alias("hypotheses"), "id", "position")
    first = F.row_number().over(Window.partitionBy("edition", "source_page", "line_id").orderBy("id", "position"))
    return rows.withColumn("_n", first).where("_n = 1").withColumn("split", ids.page_split(F.col("edition"), F.col("source_page"))).drop("_n", "id", "position")


def search_index(entries: DataFrame) -> DataFrame:
    """Inverted index: one row per (term, entry) over headword and all spans."""
    body = F.array_join(F.transform(all_spans(), lambda s: s["normalized"]), " ")
    return entries.select(F.col("id").alias("entry_id"), F.explode(F.array_distinct(tx.tokens(F.lower(F.regexp_replace(body, r"[^\p{IsAlphabetic}\p{N}\p{M}]+", " "))))).alias("term"))


def search(index: DataFrame, *terms: str) -> DataFrame:
    """Entries that hold every term."""
    want = [t.lower() for t in terms]
    return index.where(F.col("term").isin(*want)).groupBy("entry_id").agg(F.count_distinct("term").alias("n")).where(F.col("n") == len(set(want))).select("entry_id")
