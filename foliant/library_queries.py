"""Registered queries that run the library's own operators over entries, lines and words made of the
documents, each with the DuckDB text that says the same of the documents themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from . import queries as base
from .functions import ids, metrics as mx, text as tx
from .operators import corpus, evaluate, layout
from .sources import writers

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str):
    def register(f):
        _QUERIES[f.__name__] = f
        _ORACLES[f.__name__] = oracle
        return f

    return register


#: Documents as entries: ``lines`` without empty ones, ``headed`` those with a headword, ``n`` their spans.
_ENTRIES = """WITH d AS (SELECT doc_id, source, lang, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS lines, doc_id % 3 = 0 AS headed FROM documents),
e AS (SELECT *, len(lines) + CAST(headed AS INTEGER) AS n, left(lines[1], 5) AS head, CAST(CAST(0.5 + (doc_id % 5) / 10 AS FLOAT) AS DOUBLE) AS confidence,
  regexp_replace(regexp_replace(lower(trim(source)), '[^a-z0-9-]', '_', 'g'), '^_+|_+$', '', 'g') || ':p' || regexp_replace(regexp_replace(lower(trim(lang)), '[^a-z0-9-]', '_', 'g'), '^_+|_+$', '', 'g') || ':e' || printf('%04d', doc_id) AS id FROM d)
"""


@query(
    _ENTRIES
    + """SELECT source AS edition, count(*) AS entries, count(*) AS machine, CAST(0 AS BIGINT) AS corrected, CAST(0 AS BIGINT) AS verified, count(DISTINCT lang) AS printed_pages, round(avg(confidence), 6) AS mean_confidence,
    count(*) FILTER (doc_id % 5 < 3) AS low_confidence, count(*) FILTER (NOT headed) AS missing_headwords, count(DISTINCT doc_id) FILTER (n > 0) AS source_pages FROM e GROUP BY source"""
)
def edition_report(spark, d):
    """Statistics of an edition's entries and spans."""
    entries = base._corpus(spark, d)
    out = corpus.edition_statistics(entries, corpus.spans(entries))
    return out.select("edition", "entries", "machine", "corrected", "verified", "printed_pages", F.round("mean_confidence", 6).alias("mean_confidence"), "low_confidence", "missing_headwords", "source_pages")


@query(
    _ENTRIES
    + """, s AS (SELECT doc_id, unnest(lines) AS s FROM e UNION ALL SELECT doc_id, head FROM e WHERE headed)
    SELECT * FROM (SELECT 'error' AS severity, 'self_alias' AS code, count(*) FILTER (doc_id % 50 = 0) AS n FROM e
    UNION ALL SELECT 'error', 'edition_provenance_mismatch', count(*) FILTER (doc_id % 70 = 0 AND source <> 'other') FROM e
    UNION ALL SELECT 'error', 'incomplete_coordinates', count(*) FILTER (doc_id = 0) FROM s
    UNION ALL SELECT 'error', 'normalization_mismatch', count(*) FILTER (nfc_normalize(s) <> s) FROM s
    UNION ALL SELECT 'error', 'replacement_character', count(*) FILTER (contains(s, chr(65533))) FROM s) WHERE n > 0"""
)
def validation_by_code(spark, d):
    """All corpus rules over entries with planted faults; issues by code."""
    return corpus.validate(base._corpus(spark, d)).groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))


@query(
    _ENTRIES
    + """, c AS (SELECT count(*) AS entries, CAST(sum(n) AS BIGINT) AS spans, count(DISTINCT source) AS editions FROM e)
    SELECT unnest(['editions', 'entries', 'aliases', 'senses', 'blocks', 'spans', 'ocr_hypotheses', 'source_coordinates', 'unicode_warnings', 'citations', 'cross_references', 'entry_fts']) AS "table",
           unnest([editions, entries, entries, 0, entries, spans, 2 * spans, spans, 0, 0, 0, entries]) AS n FROM c"""
)
def shredded_counts(spark, d):
    """Rows of every relational table that the nested entries are shredded to."""
    out = None
    for name, table in writers.shred(base._corpus(spark, d)).items():
        row = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(_ENTRIES + "SELECT id AS entry_id, CAST(unnest(range(1, len(lines) + 1)) - 1 AS INTEGER) AS ordinal, md5(unnest(lines)) AS digest FROM e")
def shredded_spans(spark, d):
    """The spans of blocks, one row each with its ordinal and text."""
    spans = writers.shred(base._corpus(spark, d))["spans"]
    return spans.where("role = 'paragraph'").select("entry_id", "ordinal", F.md5("diplomatic").alias("digest"))


@query(
    """SELECT unnest(['entries', 'aliases', 'senses', 'blocks', 'blocks', 'spans', 'spans', 'ocr_hypotheses', 'source_coordinates', 'unicode_warnings', 'citations', 'citations', 'cross_references', 'cross_references']) AS child,
    unnest(['edition_id', 'entry_id', 'entry_id', 'entry_id', 'sense_id', 'entry_id', 'block_id', 'span_id', 'span_id', 'span_id', 'entry_id', 'span_id', 'entry_id', 'span_id']) AS key, CAST(0 AS BIGINT) AS broken"""
)
def foreign_keys(spark, d):
    """Broken references of the shredded tables per foreign key."""
    entries = base._corpus(spark, d, "id", "hypotheses", "coordinates", "warnings")
    return writers.check_tables(writers.shred(entries)).select("child", "key", "broken")


@query(_ENTRIES + "SELECT id, md5(array_to_string(lines, ' ')) AS digest FROM e")
def entry_texts(spark, d):
    """Ordered text of every entry."""
    return base._corpus(spark, d).select("id", F.md5(corpus.entry_text()).alias("digest"))


@query(
    _ENTRIES
    + """, s AS (SELECT id, doc_id, unnest(lines) AS s FROM e), w AS (SELECT id, greatest(length(s), 1) AS w, CASE WHEN regexp_matches(s, '^[A-M]') THEN 0.25 ELSE 0.75 END AS c FROM s)
    SELECT id, round(sum(c * w) / sum(w), 9) AS confidence FROM w GROUP BY id"""
)
def weighted_spans(spark, d):
    """Confidence of an entry's lines weighted by their length."""
    sure = lambda x: F.when(x["diplomatic"].rlike("^[A-M]"), 0.25).otherwise(0.75)
    lines = F.transform(F.get("blocks", 0)["spans"], lambda x: F.struct(x["diplomatic"].alias("text"), sure(x).cast("float").alias("confidence")))
    return base._corpus(spark, d).select("id", lines.alias("lines")).where("size(lines) > 0").select("id", F.round(tx.weighted_confidence(F.col("lines")), 9).alias("confidence"))


@query(
    _ENTRIES
    + """SELECT 'source_hashes' AS kind, source AS key, repeat('a', 64) AS value FROM e GROUP BY source UNION ALL SELECT 'model_hashes', unnest(['a:m', 'b:m']), repeat('c', 64)
    UNION ALL SELECT 'entry_count', '', CAST(count(*) AS VARCHAR) FROM e UNION ALL SELECT 'draft', '', 'true'"""
)
def manifest_rows(spark, d):
    """The manifest's hashes and totals."""
    one = corpus.manifest(base._corpus(spark, d), "1", "c", F.lit(None).cast("timestamp"))
    maps = [one.select(F.lit(k).alias("kind"), F.explode(k).alias("key", "value")) for k in ("source_hashes", "model_hashes")]
    scalars = [one.select(F.lit(k).alias("kind"), F.lit("").alias("key"), F.col(k).cast("string").alias("value")) for k in ("entry_count", "draft")]
    return maps[0].unionByName(maps[1]).unionByName(scalars[0]).unionByName(scalars[1])


@query(_ENTRIES + "SELECT source AS edition, CAST(doc_id AS INTEGER) AS source_page, CAST(1 AS INTEGER) AS entries, CAST(n AS INTEGER) AS polygons FROM e WHERE n > 0")
def pages_for_review(spark, d):
    """Per page its entries and the polygons of their spans there."""
    pages = corpus.review_pages(base._corpus(spark, d))
    return pages.select("edition", "source_page", F.size("entries").alias("entries"), F.aggregate("entries", F.lit(0), lambda a, x: a + F.size(x["polygons"])).alias("polygons"))


@query(
    _ENTRIES
    + """, g AS (SELECT *, lpad(hex(doc_id), 8, '0') AS h FROM e WHERE headed AND doc_id % 2 = 0 AND lang IN (SELECT min(lang) FROM documents)),
    v AS (SELECT *, CAST('0x' || substr(sha256(encode(source) || from_hex(substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))), 1, 2) AS INTEGER) % 10 AS slot FROM g)
    SELECT source AS edition, lang AS printed_page, CAST(doc_id AS INTEGER) AS source_page, 'l9998' AS line_id, head AS text, CASE WHEN slot <= 6 THEN 'train' WHEN slot <= 8 THEN 'validation' ELSE 'test' END AS split FROM v"""
)
def training_lines(spark, d):
    """Reviewed lines of the pilot pages (here: of one language) with their split."""
    entries = base._corpus(spark, d)
    reviewed = entries.withColumn("headword", F.when(F.col("headword").isNotNull(), F.col("headword").withField("review_state", F.when(F.col("entry_ordinal") % 2 == 0, "verified").otherwise("machine"))))
    first = entries.agg(F.min("printed_page").alias("printed_page"))
    pilot = entries.select("edition", "printed_page").distinct().join(F.broadcast(first), "printed_page", "left_semi")
    return corpus.ground_truth(reviewed, pilot).select("edition", "printed_page", "source_page", "line_id", "text", "split")


@query(
    _ENTRIES
    + """SELECT code, n FROM (SELECT 'empty_line_identity' AS code, CAST(coalesce(sum(CASE WHEN doc_id % 6 = 0 THEN len(lines) - CASE WHEN doc_id % 7 = 0 AND len(lines) > 0 THEN 1 ELSE 0 END ELSE 0 END), 0) AS BIGINT) AS n FROM e
    UNION ALL SELECT 'missing_assigned_entry', CAST(coalesce(sum(CASE WHEN doc_id % 4 = 0 THEN len(lines) - CASE WHEN doc_id % 7 = 0 AND len(lines) > 0 THEN 1 ELSE 0 END ELSE 0 END), 0) AS BIGINT) FROM e
    UNION ALL SELECT 'unassigned_recognized_line', CAST(coalesce(sum(CASE WHEN doc_id % 6 = 0 THEN len(lines) WHEN doc_id % 7 = 0 AND len(lines) > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) FROM e) WHERE n > 0"""
)
def assignment_issues(spark, d):
    """Line assignments held against entries: blank regions, entries that are gone, lines left out."""
    entries = base._corpus(spark, d, "coordinates").withColumn("source_page", F.col("entry_ordinal"))
    i = F.col("source_page")
    lines = entries.select("edition", "source_page", "id", F.posexplode(F.get("blocks", 0)["spans"]).alias("k", "s")).where(~((i % 7 == 0) & (F.col("k") == 0)))
    assigned = lines.select(
        "edition", "source_page", F.when(i % 6 == 0, " ").otherwise("r").alias("region_id"), F.concat(F.lit("l"), F.col("k").cast("string")).alias("line_id"), F.lit("entry").alias("kind"), F.when(i % 4 == 0, "gone").otherwise(F.col("id")).alias("entry_id")
    )
    return corpus.validate_assignments(assigned, entries).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS w FROM documents), f AS (
    SELECT w, NOT regexp_matches(w, '\\p{L}') AND regexp_matches(w, '[0-9[:punct:]]') AS placeholder,
      regexp_full_match(translate(regexp_replace(w, '^[^A-Za-z]+|[^A-Za-z]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]{2,}|a') AS english,
      CASE WHEN regexp_matches(w, '\\p{N}') THEN NULL ELSE nullif(translate(regexp_replace(w, '^[^\\p{L}]+|[^\\p{L}]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') END AS normal FROM w WHERE w <> '' AND NOT regexp_matches(w, '\\s'))
    SELECT placeholder, english, count(*) AS words, count(DISTINCT normal) AS normals FROM f GROUP BY placeholder, english"""
)
def word_rules(spark, d):
    """Word rules over the distinct words of all documents."""
    words = base.t(spark, d, "documents", "text").select(F.explode(F.split("text", " ")).alias("w")).where("w <> ''").where(~F.col("w").rlike(r"\s")).distinct()
    w = F.col("w")
    flagged = words.select(tx.placeholder(w).alias("placeholder"), tx.plausible_english(w).alias("english"), tx.normalized_word(w).alias("normal"))
    return flagged.groupBy("placeholder", "english").agg(F.count(F.lit(1)).alias("words"), F.count_distinct("normal").alias("normals"))


@query(
    f"""WITH i AS (SELECT doc_id, {base._INJECT} AS s FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(s, '\\p{{Hebrew}}')) AS h, len(regexp_extract_all(s, '\\p{{Arabic}}')) AS a, len(regexp_extract_all(s, '\\p{{Syriac}}')) AS y, len(regexp_extract_all(s, '\\p{{Greek}}')) AS g FROM i)
    SELECT doc_id, CASE WHEN greatest(h, a, y, g) = 0 THEN NULL WHEN g = greatest(h, a, y, g) THEN 'grc' WHEN y = greatest(h, a, y, g) THEN 'syr' WHEN a = greatest(h, a, y, g) THEN 'ara' ELSE 'heb' END AS language FROM c"""
)
def text_language(spark, d):
    """Language of the most frequent of four scripts."""
    return base._injected(spark, d).select("doc_id", tx.detected_language(F.col("text")).alias("language"))


@query("SELECT round(CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) / count(*) FILTER (toxic = 0), 9) AS precision, round(CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) / count(*) FILTER (quality = 1), 9) AS recall FROM labels")
def exact_precision_recall(spark, d):
    """Ids predicted (not toxic) against ids expected (good)."""
    labels = base.t(spark, d, "labels")
    out = evaluate.precision_recall(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 0").select("doc_id"), "doc_id")
    return out.select(F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("SELECT o_custkey, v[len(v) // 2 + 1] AS upper_median FROM (SELECT o_custkey, list_sort(list(o_totalprice)) AS v FROM orders GROUP BY o_custkey)")
def median_of_orders(spark, d):
    """The layout's upper median, over each customer's orders."""
    return base.t(spark, d, "orders", "o_custkey", "o_totalprice").groupBy("o_custkey").agg(layout.upper_median(F.collect_list("o_totalprice")).alias("upper_median"))


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey % 3 <> 0 AND o_orderkey % 5 <> 0")
def kept_references(spark, d):
    """Orders less those whose customer or key is gone: what broken_references leaves."""
    orders = base.t(spark, d, "orders", "o_custkey", "o_orderkey")
    gone = corpus.broken_references(orders, "o_custkey", orders.where("o_custkey % 3 <> 0"), "o_custkey").unionByName(corpus.broken_references(orders, "o_orderkey", orders.where("o_orderkey % 5 <> 0"), "o_orderkey"))
    return orders.join(gone.select("o_orderkey").distinct(), "o_orderkey", "left_anti").select("o_custkey", "o_orderkey")


@query(_ENTRIES + "SELECT id, split_part(id, ':', 1) AS edition_part, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS padded FROM e")
def entry_ids(spark, d):
    """Entry ids as the library builds them."""
    docs = base.t(spark, d, "documents", "doc_id", "source", "lang")
    made = docs.select("doc_id", ids.entry_id(F.col("source"), F.col("lang"), F.col("doc_id")).alias("id"))
    return made.select("id", F.substring_index("id", ":", 1).alias("edition_part"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("padded"))


#: Two boxes per order line, whole coordinates.
_BOXES = """WITH b AS (SELECT l_orderkey, l_linenumber, CAST(l_suppkey % 97 AS DOUBLE) AS x1, CAST(l_partkey % 89 AS DOUBLE) AS y1, CAST(l_suppkey % 97 + l_linenumber * 7 AS DOUBLE) AS x2, CAST(l_partkey % 89 + l_linenumber * 5 AS DOUBLE) AS y2,
  CAST(l_suppkey % 97 + l_partkey % 13 AS DOUBLE) AS u1, CAST(l_partkey % 89 + l_suppkey % 11 AS DOUBLE) AS v1, CAST(l_suppkey % 97 + l_partkey % 13 + 20 AS DOUBLE) AS u2, CAST(l_partkey % 89 + l_suppkey % 11 + 15 AS DOUBLE) AS v2 FROM lineitem)
"""


def _boxes(spark, d):
    s, p, n = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber")
    box = lambda x, y, w, h: F.struct(x.cast("double").alias("x1"), y.cast("double").alias("y1"), (x + w).cast("double").alias("x2"), (y + h).cast("double").alias("y2"))
    a, b = box(s % 97, p % 89, n * 7, n * 5), box(s % 97 + p % 13, p % 89 + s % 11, F.lit(20), F.lit(15))
    return base.t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").select("l_orderkey", "l_linenumber", a.alias("a"), b.alias("b"))


@query(
    _BOXES
    + """, o AS (SELECT *, greatest(least(x2, u2) - greatest(x1, u1), 0) * greatest(least(y2, v2) - greatest(y1, v1), 0) AS o, (x2 - x1) * (y2 - y1) AS m, (u2 - u1) * (v2 - v1) AS n FROM b)
    SELECT l_orderkey, l_linenumber, round(o / (m + n - o), 9) AS iou, round(o / least(m, n), 9) AS share, (y1 + y2) / 2 AS middle, v2 - v1 AS height FROM o"""
)
def box_overlaps(spark, d):
    """Overlap of two boxes over their union and over the lesser one, middle and height."""
    a, b = F.col("a"), F.col("b")
    return _boxes(spark, d).select("l_orderkey", "l_linenumber", F.round(mx.iou(a, b), 9).alias("iou"), F.round(mx.overlap_fraction(a, b), 9).alias("share"), mx.middle_y(a).alias("middle"), mx.height(b).alias("height"))


@query(
    _BOXES
    + """, c AS (SELECT l_orderkey, l_linenumber, greatest(x1 - 5, 0) AS x, greatest(y1 - 5, 0) AS y, least(x2 + 5, 90) AS r, least(y2 + 5, 70) AS s FROM b)
    SELECT l_orderkey, l_linenumber, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST(r - x AS BIGINT) AS w, CAST(s - y AS BIGINT) AS h FROM c WHERE r > x AND s > y"""
)
def crops(spark, d):
    """Boxes padded by five and kept within a page of 90 by 70; those with nothing left go."""
    cut = _boxes(spark, d).select("l_orderkey", "l_linenumber", mx.padded_box(F.col("a"), F.lit(5), F.lit(90), F.lit(70)).alias("c")).where("c is not null")
    return cut.select("l_orderkey", "l_linenumber", *[F.col(f"c.{k}").cast("long").alias(k) for k in "xywh"])


@query(
    _BOXES
    + """SELECT l_orderkey, l_linenumber, CAST(least(x1, u1) + 3 AS INTEGER) AS x, CAST(greatest(least(y1, v1) - 40, 0) AS INTEGER) AS y, CAST(greatest(x2, u2) - least(x1, u1) AS INTEGER) AS w, CAST(greatest(y2, v2) - least(y1, v1) AS INTEGER) AS h FROM b"""
)
def polygon_bounds(spark, d):
    """Whole-pixel bounds of a moved polygon of four corners."""
    point = lambda s, x, y: F.struct(F.col(s)[x].alias("x"), F.col(s)[y].alias("y"))
    polygon = F.array(*[point(s, x, y) for s in "ab" for x, y in (("x2", "y1"), ("x1", "y2"))])
    moved = _boxes(spark, d).select("l_orderkey", "l_linenumber", mx.rounded_box(mx.shifted(polygon, F.lit(3.0), F.lit(-40.0))).alias("c"))
    return moved.select("l_orderkey", "l_linenumber", *[F.col(f"c.{k}").alias(k) for k in "xywh"])


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents),
    g AS (SELECT doc_id, text, k, (k * 37 + doc_id * 11) % 1000 AS x, (k * 61) % 1400 AS y, least(length(text) * 9, 900) AS w, 12 + doc_id % 20 AS h, 1000 AS pw, 1400 AS ph FROM l)
    SELECT doc_id, count(*) FILTER (y < ph * 0.05 OR y + h > ph * 0.975) AS margins, count(*) FILTER (regexp_full_match(text, '[0-9[:punct:]]*') AND w <= pw * 0.02 AND h <= ph * 0.02) AS artifacts,
           CAST(sum(CASE WHEN x + w // 2 >= pw // 2 THEN 1 ELSE 0 END) AS BIGINT) AS right_column FROM g GROUP BY doc_id"""
)
def line_flags(spark, d):
    """Margin lines, specks and lines of the right column, per document laid out as a page."""
    lines = base.t(spark, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "text"))
    k, i = F.col("k"), F.col("doc_id")
    placed = lines.select(
        "doc_id", "text", ((k * 37 + i * 11) % 1000).alias("x"), ((k * 61) % 1400).alias("y"), F.least(F.length("text") * 9, F.lit(900)).alias("w"), (12 + i % 20).alias("h"), F.lit(1000).alias("page_w"), F.lit(1400).alias("page_h")
    )
    return placed.groupBy("doc_id").agg(F.count_if(layout.is_margin()).alias("margins"), F.count_if(layout.is_artifact()).alias("artifacts"), F.sum(layout.column_of()).alias("right_column"))


@query(
    _ENTRIES
    + """, b AS (SELECT id, string_split(regexp_replace(lower(CASE WHEN headed AND head IS NOT NULL THEN head || ' ' ELSE '' END || array_to_string(lines, ' ')), '[^\\p{L}\\p{N}\\p{M}]+', ' ', 'g'), ' ') AS terms FROM e)
    SELECT id AS entry_id FROM b WHERE list_contains(terms, 'the') AND list_contains(terms, 'of')"""
)
def entry_search(spark, d):
    """Entries that hold two terms, by the inverted index."""
    return corpus.search(corpus.search_index(base._corpus(spark, d)), "the", "Of")


@query(
    """WITH h AS (SELECT doc_id, text, lang, lpad(hex(octet_length(encode(text))), 16, '0') AS a, lpad(hex(octet_length(encode(lang))), 16, '0') AS b FROM documents),
    r AS (SELECT *, list_reduce([substr(a, 2 * i + 1, 2) FOR i IN range(0, 8)], lambda x, y: y || x) AS ra, list_reduce([substr(b, 2 * i + 1, 2) FOR i IN range(0, 8)], lambda x, y: y || x) AS rb FROM h)
    SELECT doc_id, sha256(from_hex(ra) || encode(text) || from_hex(rb) || encode(lang)) AS digest, text IS NOT NULL AND lang IS NOT NULL AS good FROM r"""
)
def content_hashes(spark, d):
    """Length-prefixed SHA-256 of text and language, and whether it looks like one."""
    docs = base.t(spark, d, "documents", "doc_id", "text", "lang")
    return docs.select("doc_id", ids.content_hash(F.col("text"), F.col("lang")).alias("digest")).select("doc_id", "digest", ids.is_sha256(F.col("digest")).alias("good"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey = 7 THEN 'vii' WHEN o_orderkey = 33 THEN 'xxxiii' WHEN o_orderkey - 500 > 0 THEN CAST(o_orderkey - 500 AS VARCHAR) ELSE 'front-' || lpad(CAST(o_orderkey AS VARCHAR), 4, '0') END AS label,
    o_orderkey NOT IN (7, 33) AND o_orderkey <= 500 AS front_matter FROM orders"""
)
def printed_pages(spark, d):
    """Printed labels of scanned pages: mapped ones, numbers by offset, front matter."""
    named = F.create_map(F.lit(7), F.lit("vii"), F.lit(33), F.lit("xxxiii"))
    page = ids.printed_page(F.col("o_orderkey").cast("int"), F.lit(-500), named)
    return base.t(spark, d, "orders", "o_orderkey").select("o_orderkey", page.alias("p")).select("o_orderkey", "p.label", "p.front_matter")


#: Distinct words of the documents with other scripts added.
_WORDS = f"WITH i AS (SELECT doc_id, {base._INJECT} AS s FROM documents), w AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(s, ' ')) AS w FROM i) WHERE w <> '' AND NOT regexp_matches(w, '\\s'))"


def _words(spark, d):
    words = base._injected(spark, d).select(F.explode(F.split("text", " ")).alias("w"))
    return words.where("w <> ''").where(~F.col("w").rlike(r"\s")).distinct()


@query(
    _WORDS
    + """, t AS (SELECT w, regexp_replace(w, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g') AS core FROM w)
    SELECT md5(w) AS word, core <> '' AND length(core) <= 6 AND NOT regexp_full_match(core, '[a-z]*') AND NOT (regexp_full_match(core, '\\p{N}*') AND regexp_matches(w, '[^\\p{L}\\p{N}]')) AS candidate,
    regexp_matches(w, '^[^\\p{L}\\p{N}]*\\p{Hebrew}') AS hebrew, regexp_matches(w, '\\p{Hebrew}|\\p{Arabic}|\\p{Syriac}|\\p{Greek}') AS foreign_script,
    nullif(regexp_extract(w, '\\p{Hebrew}[\\p{Hebrew}\\p{Inherited}-]*'), '') AS run FROM t"""
)
def headword_words(spark, d):
    """Headword rules over the distinct words."""
    w = F.col("w")
    return _words(spark, d).select(F.md5("w").alias("word"), tx.headword_candidate(w).alias("candidate"), tx.begins_with_hebrew(w).alias("hebrew"), tx.contains_foreign(w).alias("foreign_script"), tx.hebrew_headword(w).alias("run"))


@query(
    f"""WITH i AS (SELECT doc_id, {base._INJECT} AS s FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(s, '\\p{{L}}')) AS n, len(regexp_extract_all(regexp_replace(s, '[^\\p{{L}}]', '', 'g'), '\\p{{Hebrew}}')) AS h, len(regexp_extract_all(regexp_replace(s, '[^\\p{{L}}]', '', 'g'), '\\p{{Greek}}')) AS g FROM i)
    SELECT doc_id, n > 0 AND 3 * CASE WHEN doc_id % 2 = 0 THEN h ELSE g END >= 2 * n AS fits FROM c"""
)
def language_fit(spark, d):
    """Whether two thirds of a text's letters are in the script of a claimed language."""
    claimed = F.when(F.col("doc_id") % 2 == 0, "heb").otherwise("grc")
    return base._injected(spark, d).select("doc_id", tx.matches_language(F.col("text"), claimed).alias("fits"))


@query(
    _ENTRIES
    + """, s AS (SELECT doc_id, unnest(lines) AS s FROM e UNION ALL SELECT doc_id, head FROM e WHERE headed), n AS (SELECT (SELECT count(*) FROM e WHERE doc_id % 50 = 0) + (SELECT count(*) FROM e WHERE doc_id % 70 = 0 AND source <> 'other')
    + (SELECT count(*) FILTER (doc_id = 0) + count(*) FILTER (nfc_normalize(s) <> s) + count(*) FILTER (contains(s, chr(65533))) FROM s) AS errors) SELECT CAST(errors AS BIGINT) AS errors, CAST(0 AS BIGINT) AS warnings, errors = 0 AS valid FROM n"""
)
def validity(spark, d):
    """The verdict of all corpus rules together."""
    return evaluate.is_valid(corpus.validate(base._corpus(spark, d)))


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
