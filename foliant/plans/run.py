"""From recognised lines to published entries: one job over all pages, no page loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions import ids, text as tx
from ..functions import metrics as mx
from ..functions import udf
from ..operators import corpus, layout, matching

PAGE, ORDER = layout.PAGE, layout.ORDER
LINE = [*PAGE, *ORDER]


def boxed(lines: DataFrame) -> DataFrame:
    """``lines`` with their running number ``i`` on the page and their ``box``."""
    i = (F.row_number().over(Window.partitionBy(*PAGE, "engine").orderBy(*ORDER)) - 1).cast("long")
    return lines.withColumns({"i": i, "box": mx.box(F.col("polygon"))})


def aligned(canonical: DataFrame, readings: DataFrame) -> DataFrame:
    """Every engine's readings aligned with the canonical lines: ``LINE columns, engine, text,
    confidence, words``."""
    a, b = boxed(canonical), boxed(readings)
    engines = b.select(*PAGE, "engine").distinct()
    left = a.drop("engine").join(engines, PAGE).select(*PAGE, "engine", "i", "box")
    pairs = matching.align(left, b, [*PAGE, "engine"]).where("r IS NOT NULL")
    named = pairs.join(a.select(*LINE, F.col("i").alias("l")), [*PAGE, "l"])
    return named.join(b.select(*PAGE, "engine", F.col("i").alias("r"), "text", "confidence", "words"), [*PAGE, "engine", "r"]).select(*LINE, "engine", "text", "confidence", "words")


def fuse(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Primary lines with foreign-script runs taken from the aligned secondary lines."""
    words = aligned(primary, secondary).select(*LINE, F.col("words").alias("secondary_words"))
    return matching.fuse_words(primary.join(words, LINE, "left")).select(*primary.columns)


def _readings(readings: DataFrame, engines: DataFrame) -> DataFrame:
    """Aligned readings per line in engine order: ``LINE columns, hypotheses``.

    ``engines(engine, engine_ord, engine_version, model, model_hash)`` is a small catalogue."""
    joined = readings.join(F.broadcast(engines), "engine")
    h = F.struct("engine_ord", F.struct("engine", "engine_version", "model", "model_hash", "text", F.col("confidence").cast("float").alias("confidence")).alias("h"))
    return joined.groupBy(*LINE).agg(F.transform(F.array_sort(F.collect_list(h)), lambda x: x["h"]).alias("hypotheses"))


def entries_from(segmented: DataFrame, readings: DataFrame, context: dict) -> DataFrame:
    """Segmented lines -> nested entries (``schemas.ENTRY``).

    ``context``: source_sha256, scan_id, pipeline_run, transform_id, page_image (a format of the page)."""
    own = segmented.where("kind = 'entry'").join(readings, LINE, "left")
    plain = own.withColumn("diplomatic", tx.strip_bidi(F.col("text"))).withColumn("normalized", udf.nfc("diplomatic")).withColumn("warnings", udf.unicode_warnings("diplomatic"))
    lit = lambda k: F.lit(context[k])
    place = F.struct(
        "source_page", F.col("printed_page"), "region_id", "line_id", "polygon", lit("transform_id").alias("transform_id"), F.format_string(context["page_image"], F.col("source_page")).alias("page_image")
    )
    number = F.col("span_no")

    def span(id_: Column, diplomatic: Column, normalized: Column, script: Column, warnings: Column) -> Column:
        return F.struct(
            id_.alias("id"), diplomatic.alias("diplomatic"), normalized.alias("normalized"), F.lit(None).cast("string").alias("language"), script.alias("script"), tx.infer_direction(diplomatic).alias("direction"),
            F.col("confidence").cast("float").alias("confidence"), F.lit("machine").alias("review_state"), F.coalesce("hypotheses", F.array().cast(schemas.array(schemas.HYPOTHESIS))).alias("hypotheses"),
            F.array(place).alias("coordinates"), warnings.alias("warnings"),
        )

    sid = ids.span_id(F.col("entry_id"), number)
    spanned = plain.withColumn("span", span(sid, F.col("diplomatic"), F.col("normalized"), tx.classify_script(F.col("diplomatic")), F.col("warnings")))
    head = span(ids.headword_id(sid), F.col("headword"), udf.nfc("headword"), tx.classify_script(F.col("headword")), udf.unicode_warnings("headword"))
    spanned = spanned.withColumn("head", F.when((number == 1) & F.col("headword").isNotNull(), head))
    entry = ["edition", "chain", "entry_no", "entry_id", "entry_page", "entry_ordinal"]
    blocks = spanned.groupBy(*entry, "block_no").agg(F.min("block_kind").alias("block_kind"), F.array_sort(F.collect_list(F.struct("span_no", "span"))).alias("s"), F.max_by("head", F.col("head").isNotNull()).alias("head"))
    block = F.struct(
        "block_no", F.struct(ids.block_id(F.col("entry_id"), F.col("block_no")).alias("id"), F.col("block_kind").alias("kind"), F.transform("s", lambda x: x["span"]).alias("spans")).alias("b")
    )
    grouped = blocks.groupBy(*entry).agg(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["b"]).alias("blocks"), F.max_by("head", F.col("head").isNotNull()).alias("headword"))
    empty = lambda kind: F.array().cast(schemas.array(kind))
    return grouped.select(
        F.col("entry_id").alias("id"), F.array().cast("array<string>").alias("aliases"), "edition", F.col("entry_page").alias("printed_page"), F.col("entry_ordinal").cast("int").alias("entry_ordinal"), "headword",
        F.lit(None).cast("int").alias("homograph"), empty(schemas.SPAN).alias("grammatical_labels"), "blocks", empty(schemas.SENSE).alias("senses"), empty(schemas.CITATION).alias("citations"),
        empty(schemas.CROSS_REFERENCE).alias("cross_references"), empty(schemas.BLOCK).alias("etymology"),
        F.struct("edition", lit("source_sha256").alias("source_sha256"), lit("scan_id").alias("scan_id"), lit("pipeline_run").alias("pipeline_run")).alias("provenance"),
        tx.weighted_confidence(F.flatten(F.transform("blocks", lambda b: b["spans"])), "normalized").cast("float").alias("confidence"), F.lit("machine").alias("review_state"), F.lit(0).cast("long").alias("revision"),
    )


def run(canonical: DataFrame, readings: DataFrame, engines: DataFrame, source: dict, context: dict) -> tuple[DataFrame, DataFrame]:
    """``(entries, assignments)`` of all pages in ``canonical``; ``source`` gives the page labels."""
    labels = F.create_map(*[F.lit(x) for kv in source.get("printed_page_labels", {}).items() for x in kv]) if source.get("printed_page_labels") else F.create_map().cast("map<int,string>")
    page = ids.printed_page(F.col("source_page"), F.lit(source["printed_page_offset"]), labels)
    labelled = canonical.withColumn("_p", page).withColumns({"printed_page": F.col("_p.label"), "front_matter": F.col("_p.front_matter")}).drop("_p")
    found = aligned(canonical, readings)
    segmented = layout.segment(labelled, found.select(*LINE, F.col("text").alias("hypothesis_text")))
    return entries_from(segmented, _readings(found, engines), context), segmented.select("edition", "source_page", "region_id", "line_id", "kind", "entry_id")


def publish(base: DataFrame, parsed: DataFrame, pages: DataFrame) -> DataFrame:
    """The corpus after a run over ``pages``."""
    return corpus.merge_pages(base, parsed.withColumn("seq", F.lit(0)), pages)
