"""Writers: JSONL, layout XML, lexicon XML, relational tables, reports, patch log, receipts."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions import ids, text as tx
from ..operators import corpus

esc = tx.xml_escape


def sorted_entries(entries: DataFrame) -> DataFrame:
    """Corpus order: edition, printed page (numbers by value), ordinal, id."""
    return entries.orderBy("edition", ids.page_key(F.col("printed_page")), "entry_ordinal", "id")


def write_entries(entries: DataFrame, path: str, single_file: bool = False) -> None:
    """JSONL in corpus order; part files are in order too, ``single_file`` makes one of them."""
    lines = sorted_entries(entries).select(F.to_json(F.struct(*schemas.ENTRY.names), {"ignoreNullFields": "false"}).alias("value"))
    (lines.coalesce(1) if single_file else lines).write.mode("overwrite").text(path)


def write_patch(spark: SparkSession, base: DataFrame, patches: DataFrame, patch: dict, path: str) -> None:
    """Append one correction with compare-and-set on the entry's revision (single writer)."""
    if not (patch.get("reviewer") or "").strip():
        raise ValueError("a reviewer is needed")
    if patch["replacement"]["review_state"] == "machine":
        raise ValueError("a correction cannot have the state machine")
    current = corpus.replay(base, patches).where(F.col("id") == patch["entry_id"]).select("revision", "edition", "provenance.source_sha256").first()
    if current is None:
        raise KeyError(patch["entry_id"])
    if current["revision"] != patch["base_revision"]:
        raise ValueError(f"revision conflict: entry is at {current['revision']}, patch is based on {patch['base_revision']}")
    if (patch["replacement"]["edition"], patch["replacement"]["provenance"]["source_sha256"]) != (current["edition"], current["source_sha256"]):
        raise ValueError("the source identity must stay")
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(patch, ensure_ascii=False) + "\n")
        f.flush()
        os.fsync(f.fileno())


# ---- XML --------------------------------------------------------------------------------------------


def _attr(name: str, value: Column) -> Column:
    """`` name="value"`` or nothing for null."""
    return F.coalesce(F.concat(F.lit(f' {name}="'), esc(value), F.lit('"')), F.lit(""))


def _each(items: Column, f) -> Column:
    return F.coalesce(F.array_join(F.transform(items, f), ""), F.lit(""))


def _content(s: Column) -> Column:
    both = F.concat(F.lit("<choice><orig>"), esc(s["diplomatic"]), F.lit("</orig><reg>"), esc(s["normalized"]), F.lit("</reg></choice>"))
    return F.when(s["diplomatic"] == s["normalized"], esc(s["normalized"])).otherwise(both)


def _span(element: str, s: Column) -> Column:
    kind = F.concat(F.lit(' type="script:'), esc(s["script"]), F.lit(" direction:"), s["direction"], F.lit(" review:"), s["review_state"], F.lit('"'))
    return F.concat(
        F.lit(f'<{element} xml:id="'), ids.xml_id(s["id"]), F.lit('"'), _attr("xml:lang", s["language"]), kind, F.format_string(' cert="%.4f">', s["confidence"].cast("double")), _content(s), F.lit(f"</{element}>")
    )


def _block(b: Column) -> Column:
    return F.concat(F.lit('<note xml:id="'), ids.xml_id(b["id"]), F.lit('" type="'), b["kind"], F.lit('">'), _each(b["spans"], lambda s: _span("seg", s)), F.lit("</note>"))


def tei_entry() -> Column:
    """One entry as a lexicon XML fragment."""
    c = F.col
    head = F.when(
        c("headword").isNotNull(),
        F.concat(F.lit('<form type="lemma">'), _span("orth", c("headword")), F.coalesce(F.concat(F.lit('<num type="homograph">'), c("homograph").cast("string"), F.lit("</num>")), F.lit("")), F.lit("</form>")),
    ).otherwise("")
    sense = lambda s: F.concat(F.lit('<sense xml:id="'), ids.xml_id(s["id"]), F.lit('"'), _attr("n", s["label"]), F.lit(">"), _each(s["blocks"], _block), F.lit("</sense>"))
    cite = lambda x: F.concat(F.lit('<cit type="example">'), _span("quote", x["text"]), F.coalesce(F.concat(F.lit('<ref type="citation" target="'), esc(x["target"]), F.lit('"/>')), F.lit("")), F.lit("</cit>"))
    xref = lambda x: F.concat(F.lit("<xr><ref"), F.coalesce(F.concat(F.lit(' target="#'), ids.xml_id(x["target_entry_id"]), F.lit('"')), F.lit("")), F.lit(">"), _content(x["text"]), F.lit("</ref></xr>"))
    etym = lambda b: F.concat(F.lit("<etym>"), _each(b["spans"], lambda s: _span("seg", s)), F.lit("</etym>"))
    note = F.concat(
        F.lit('<note type="provenance">printed-page='), esc(c("printed_page")), F.lit(" entry-ordinal="), c("entry_ordinal").cast("string"), F.lit(" scan="), esc(c("provenance.scan_id")),
        F.lit(" source-sha256="), esc(c("provenance.source_sha256")), F.lit(" pipeline-run="), esc(c("provenance.pipeline_run")), F.format_string(" confidence=%.4f", c("confidence").cast("double")),
        F.lit(" revision="), c("revision").cast("string"), F.lit("</note>"),
    )
    return F.concat(
        F.lit('<entry xml:id="'), ids.xml_id(c("id")), F.lit('" n="'), esc(c("id")), F.lit('" type="'), c("review_state"), F.lit('" source="#source_'), ids.xml_id(c("edition")), F.lit('">'),
        head, _each(c("grammatical_labels"), lambda s: _span("gram", s)), _each(c("blocks"), _block), _each(c("senses"), sense), _each(c("citations"), cite), _each(c("cross_references"), xref),
        _each(c("etymology"), etym), note, F.lit("</entry>"),
    )


def tei_header(manifest: dict, title: str) -> str:
    from xml.sax.saxutils import escape

    def xid(value: str) -> str:
        return "g_" + "".join(ch if ch.isascii() and (ch.isalnum() or ch in "_.-") else f"_{ord(ch):x}_" for ch in value)

    bibl = "".join(f'<bibl xml:id="source_{xid(e)}"><title>{escape(e)}</title><idno type="sha256">{escape(h)}</idno></bibl>' for e, h in sorted(manifest["source_hashes"].items()))
    about = "".join(f'<ab type="{kind}">{escape(manifest[key])}</ab>' for kind, key in (("corpus", "corpus_version"), ("schema", "schema_version"), ("pipeline", "pipeline_commit")))
    # element names are set by the TEI guidelines
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc>'
        f"<titleStmt><title>{escape(title)}</title></titleStmt><publicationStmt><p>Written by foliant.</p></publicationStmt>"
        f"<sourceDesc><listBibl>{bibl}</listBibl></sourceDesc></fileDesc><encodingDesc><projectDesc>{about}</projectDesc></encodingDesc>"
        f'<revisionDesc status="{"draft" if manifest["draft"] else "published"}"><change when="{manifest["generated_at"].isoformat()}"/></revisionDesc>'
        "</teiHeader><text><body>\n"
    )


def write_tei(entries: DataFrame, manifest: dict, path: str, title: str) -> None:
    """Header, entries by id, footer, as ordered lines; parts are in order."""
    spark = entries.sparkSession
    body = entries.select(F.lit(1).alias("o"), "id", tei_entry().alias("value"))
    ends = spark.createDataFrame([(0, "", tei_header(manifest, title).rstrip("\n")), (2, "", "</body></text></TEI>")], "o int, id string, value string")
    body.unionByName(ends).orderBy("o", "id").select("value").write.mode("overwrite").text(path)


def alto_page(lines: DataFrame) -> DataFrame:
    """``lines`` -> one layout XML document per (edition, source_page, engine)."""
    c = F.col
    place = lambda x, y, w, h: F.format_string(' HPOS="%d" VPOS="%d" WIDTH="%d" HEIGHT="%d"', *[F.greatest(F.round(v), F.lit(0)).cast("int") for v in (x, y, w, h)])
    word = lambda w: F.concat(F.lit('<String ID="'), esc(w["id"]), F.lit('"'), place(w["x"], w["y"], w["w"], w["h"]), F.lit(' CONTENT="'), esc(w["text"]), F.format_string('" WC="%.8f"/>', w["confidence"].cast("double")))
    line = F.concat(F.lit('<TextLine ID="'), esc(c("line_id")), F.lit('"'), place(c("x"), c("y"), c("w"), c("h")), F.lit(">"), _each(c("words"), word), F.lit("</TextLine>"))
    page = ["edition", "source_page", "engine", "page_w", "page_h"]
    in_order = lambda key, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value]), "")
    blocks = lines.select(*page, "region_ord", "region_id", "region_x", "region_y", "region_w", "region_h", "line_ord", line.alias("line")).groupBy(*page, "region_ord", "region_id", "region_x", "region_y", "region_w", "region_h").agg(in_order("line_ord", "line").alias("inner"))
    block = F.concat(F.lit('<TextBlock ID="'), esc(c("region_id")), F.lit('"'), place(c("region_x"), c("region_y"), c("region_w"), c("region_h")), F.lit(">"), c("inner"), F.lit("</TextBlock>"))
    pages = blocks.select(*page, "region_ord", block.alias("block")).groupBy(*page).agg(in_order("region_ord", "block").alias("inner"))
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#"><Layout>'),
        F.format_string('<Page ID="page" WIDTH="%d" HEIGHT="%d"><PrintSpace>', c("page_w"), c("page_h")), c("inner"), F.lit("</PrintSpace></Page></Layout></alto>\n"),
    )
    return pages.select("edition", "source_page", "engine", xml.alias("xml"))


# ---- relational tables -------------------------------------------------------------------------------


def shred(entries: DataFrame) -> dict[str, DataFrame]:
    """Nested entries as relational tables, one projection each."""
    e = entries
    c = F.col
    editions = e.groupBy(c("edition").alias("id")).agg(F.min("provenance.source_sha256").alias("source_sha256"), F.min("provenance.scan_id").alias("scan_id"))
    base = e.select(
        "id", c("edition").alias("edition_id"), "printed_page", "entry_ordinal", c("headword.diplomatic").alias("headword_diplomatic"), c("headword.normalized").alias("headword_normalized"), "homograph", "confidence",
        "review_state", "revision", c("provenance.pipeline_run").alias("pipeline_run"),
    )
    aliases = e.select(F.explode("aliases").alias("alias"), c("id").alias("entry_id"))
    senses = e.select(c("id").alias("entry_id"), F.posexplode("senses").alias("k", "s")).select("s.id", "entry_id", c("k").alias("ordinal"), "s.label")

    def of_blocks(df: DataFrame, items: Column, role: Column, sense: Column) -> DataFrame:
        return df.select(c("entry_id"), sense.alias("sense_id"), role.alias("role"), F.posexplode(items).alias("k", "b")).select("b.id", "entry_id", "sense_id", "role", c("k").alias("ordinal"), "b.spans", "b.kind")

    none = F.lit(None).cast("string")
    own = e.withColumn("entry_id", c("id"))
    in_sense = e.select(c("id").alias("entry_id"), F.explode("senses").alias("s"))
    blocks = of_blocks(own, c("blocks"), F.lit("entry"), none).unionByName(of_blocks(in_sense, c("s.blocks"), F.lit("sense"), c("s.id"))).unionByName(of_blocks(own, c("etymology"), F.lit("etymology"), none))
    lone = lambda items, role, rank: own.select("entry_id", none.alias("block_id"), F.lit(role).alias("role"), F.lit(rank).alias("rank"), F.posexplode(items).alias("k", "s"))
    heads = lone(F.when(c("headword").isNotNull(), F.array("headword")).otherwise(F.array().cast(schemas.array(schemas.SPAN))), "headword", 0)
    labels = lone(c("grammatical_labels"), "grammar", 1)
    in_block = blocks.select("entry_id", c("id").alias("block_id"), c("kind").alias("role"), F.lit(2).alias("rank"), F.posexplode("spans").alias("k", "s"))
    cited = lone(F.transform("citations", lambda x: x["text"]), "citation", 3)
    crossed = lone(F.transform("cross_references", lambda x: x["text"]), "cross_reference", 4)

    def stored(*fields: str) -> DataFrame:
        # only what a table shows goes through the shuffle
        every = None
        for part in (heads, labels, in_block, cited, crossed):
            part = part.select("entry_id", "block_id", "role", "rank", "k", c("s.id").alias("id"), *[f"s.{n}" for n in fields])
            every = part if every is None else every.unionByName(part)
        # a citation's span may be one that a block already stores: the first place keeps it
        first = F.row_number().over(Window.partitionBy("entry_id", "id").orderBy("rank", "block_id", "k"))
        return every.withColumn("_n", first).where("_n = 1").drop("_n", "rank")

    shown = ("diplomatic", "normalized", "language", "script", "direction", "confidence", "review_state")
    spans = stored(*shown).select("id", "entry_id", "block_id", "role", c("k").alias("ordinal"), *shown)
    child = lambda name, *fields: stored(name).select(c("id").alias("span_id"), F.posexplode(name).alias("k", "x")).select("span_id", c("k").alias("ordinal"), *fields)
    return {
        "editions": editions,
        "entries": base,
        "aliases": aliases,
        "senses": senses,
        "blocks": blocks.drop("spans", "kind"),
        "spans": spans,
        "ocr_hypotheses": child("hypotheses", *[f"x.{n}" for n in schemas.HYPOTHESIS.names]),
        "source_coordinates": child("coordinates", "x.source_page", "x.printed_page", "x.region_id", "x.line_id", F.to_json("x.polygon").alias("polygon_json"), "x.transform_id", "x.page_image"),
        "unicode_warnings": child("warnings", *[f"x.{n}" for n in schemas.WARNING.names]),
        "citations": own.select("entry_id", F.posexplode("citations").alias("k", "x")).select("x.id", "entry_id", c("k").alias("ordinal"), "x.target", c("x.text.id").alias("span_id")),
        "cross_references": own.select("entry_id", F.posexplode("cross_references").alias("k", "x")).select("x.id", "entry_id", c("k").alias("ordinal"), "x.target_entry_id", c("x.text.id").alias("span_id")),
        "entry_fts": own.select("entry_id", F.coalesce(c("headword.normalized"), F.lit("")).alias("headword"), F.array_join(F.transform(corpus.all_spans(), lambda s: s["normalized"]), " ").alias("english")),
    }


# The foreign keys of the relational form.
FOREIGN_KEYS = (
    ("entries", "edition_id", "editions", "id"),
    ("aliases", "entry_id", "entries", "id"),
    ("senses", "entry_id", "entries", "id"),
    ("blocks", "entry_id", "entries", "id"),
    ("blocks", "sense_id", "senses", "id"),
    ("spans", "entry_id", "entries", "id"),
    ("spans", "block_id", "blocks", "id"),
    ("ocr_hypotheses", "span_id", "spans", "id"),
    ("source_coordinates", "span_id", "spans", "id"),
    ("unicode_warnings", "span_id", "spans", "id"),
    ("citations", "entry_id", "entries", "id"),
    ("citations", "span_id", "spans", "id"),
    ("cross_references", "entry_id", "entries", "id"),
    ("cross_references", "span_id", "spans", "id"),
)


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``child, key, parent, broken`` for every foreign key.

    Each table is read once, as rows of its keys, which are counted before they are shuffled: a key that no parent row has
    is broken as often as its child columns hold it."""
    spaces = sorted({(parent, key) for _, _, parent, key in FOREIGN_KEYS})
    keys = None
    for name, table in tables.items():
        held = [(key, spaces.index((parent, key)), -1) for parent, key in spaces if parent == name]
        held += [(key, spaces.index((parent, parent_key)), i) for i, (child, key, parent, parent_key) in enumerate(FOREIGN_KEYS) if child == name]
        if held:
            of_row = F.array(*[F.struct(F.lit(space).alias("space"), F.col(key).cast("string").alias("value"), F.lit(role).alias("role")) for key, space, role in held])
            rows = table.select(F.explode(of_row).alias("x")).select("x.*").where("value IS NOT NULL")
            keys = rows if keys is None else keys.unionByName(rows)
    numbers = range(len(FOREIGN_KEYS))
    per_key = keys.groupBy("space", "value").agg(F.bool_or(F.col("role") == -1).alias("known"), *[F.count_if(F.col("role") == i).alias(f"n{i}") for i in numbers])
    total = per_key.agg(*[F.coalesce(F.sum(F.when(~F.col("known"), F.col(f"n{i}"))), F.lit(0).cast("long")).alias(f"n{i}") for i in numbers])
    rows = F.array(*[F.struct(F.lit(child).alias("child"), F.lit(key).alias("key"), F.lit(parent).alias("parent"), F.col(f"n{i}").alias("broken")) for i, (child, key, parent, _) in enumerate(FOREIGN_KEYS)])
    return total.select(F.explode(rows).alias("x")).select("x.*")


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def export(entries: DataFrame, path: str, form: str, manifest: dict, title: str = "Corpus") -> None:
    """Validate first; any error refuses the export.  ``form``: jsonl, tei or tables."""
    errors = corpus.validate(entries).where("severity = 'error'")
    first = errors.orderBy("location", "code").first()
    if first is not None:
        raise ValueError(f"corpus is not valid: {first.asDict()}")
    if form == "jsonl":
        write_entries(entries, path)
    elif form == "tei":
        write_tei(entries, manifest, path, title)
    elif form == "tables":
        write_tables(shred(entries), path)
    else:
        raise ValueError(f"unknown export form {form}")


def comparison_markdown(statistics: DataFrame) -> str:
    """The comparison report's table (one row per edition, a small result)."""
    rows = statistics.select("edition", "entries", "source_pages", "mean_confidence", "low_confidence", "missing_headwords").orderBy("edition").toLocalIterator()
    body = "".join(f"| {r.edition} | {r.entries} | {r.source_pages or 0} | {r.mean_confidence or 0:.4f} | {r.low_confidence} | {r.missing_headwords} |\n" for r in rows)
    return "| Edition | Entries | Pages | Mean confidence | Low confidence | Missing headwords |\n| --- | ---: | ---: | ---: | ---: | ---: |\n" + body


def write_receipt(spark: SparkSession, path: str, stage: str, input_hash: str, outputs: list[str]) -> None:
    """Append a stage's receipt; ``stage_is_current`` reads the latest."""
    spark.createDataFrame([(stage, input_hash, outputs)], "stage string, input_hash string, outputs array<string>").withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(path)


def stage_is_current(spark: SparkSession, path: str, stage: str, input_hash: str) -> bool:
    jvm = spark.sparkContext._jvm
    exists = lambda p: (w := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(w)
    if not exists(path):
        return False
    last = spark.read.parquet(path).where(F.col("stage") == stage).orderBy(F.col("finished_at").desc()).first()
    return last is not None and last["input_hash"] == input_hash and all(exists(p) for p in last["outputs"])
