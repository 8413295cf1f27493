"""Registered queries over the test tables, each with its DuckDB text where SQL can say the same.

The tables hold no scanned books, so a query maps them onto the engine's model: a document's
``source`` stands for the edition, ``doc_id`` for the entry, labels for review states, embeddings for
boxes, conversations for correction logs.  Where the data would never trigger a rule (no Hebrew, no
controls), both sides inject the same characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import ids, text as tx
from .functions import metrics as mx
from .functions import udf
from .operators import corpus, layout, matching
from .sources import writers

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}

HEBREW, ARABIC, GREEK = "אב", "اب", "αβ"


def query(oracle: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if oracle:
            _ORACLES[f.__name__] = oracle
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


# ---- editions ------------------------------------------------------------------------------------------

_ENTRY_SQL = """
WITH e AS (
  SELECT d.doc_id, d.source AS edition, d.lang, d.n_chars, l.quality, l.toxic,
         CASE WHEN l.doc_id IS NULL THEN 'machine' WHEN l.toxic = 1 THEN 'corrected' ELSE 'verified' END AS state,
         CAST(coalesce(l.quality, 0) AS DOUBLE) AS confidence
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def _entries(spark, d, *columns):
    docs, labels = t(spark, d, "documents", "doc_id", "source", "lang", "n_chars", *columns), t(spark, d, "labels")
    joined = docs.join(labels, "doc_id", "left")
    state = F.when(F.col("quality").isNull(), "machine").when(F.col("toxic") == 1, "corrected").otherwise("verified")
    return joined.select("doc_id", F.col("source").alias("edition"), "lang", "n_chars", "quality", "toxic", state.alias("state"), F.coalesce("quality", F.lit(0)).cast("double").alias("confidence"), *columns)


@query(
    _ENTRY_SQL
    + """SELECT edition, count(*) AS entries, count(*) FILTER (state = 'machine') AS machine, count(*) FILTER (state = 'corrected') AS corrected, count(*) FILTER (state = 'verified') AS verified,
  count(DISTINCT lang) AS pages, round(avg(confidence), 9) AS mean_confidence, count(*) FILTER (state <> 'machine' AND confidence < 0.8) AS low_confidence, count(*) FILTER (quality IS NULL) AS missing
  FROM e GROUP BY edition"""
)
def edition_statistics(spark, d):
    """Entries, review states, pages and confidence per edition."""
    return (
        _entries(spark, d).groupBy("edition").agg(
            F.count(F.lit(1)).alias("entries"), F.count_if(F.col("state") == "machine").alias("machine"), F.count_if(F.col("state") == "corrected").alias("corrected"),
            F.count_if(F.col("state") == "verified").alias("verified"), F.count_distinct("lang").alias("pages"), F.round(F.avg("confidence"), 9).alias("mean_confidence"),
            F.count_if((F.col("state") != "machine") & (F.col("confidence") < 0.8)).alias("low_confidence"), F.count_if(F.col("quality").isNull()).alias("missing"),
        )
    )


@query(_ENTRY_SQL + "SELECT edition, round(sum(confidence * greatest(n_chars, 1)) / sum(greatest(n_chars, 1)), 9) AS confidence FROM e GROUP BY edition")
def weighted_confidence(spark, d):
    """Confidence weighted by length."""
    w = F.greatest("n_chars", F.lit(1))
    return _entries(spark, d).groupBy("edition").agg(F.round(F.sum(F.col("confidence") * w) / F.sum(w), 9).alias("confidence"))


_HEADED_SQL = """
WITH h AS (SELECT regexp_extract(text, '^[^ .,;!?|]+') AS key, source AS edition, doc_id AS seq, text FROM documents),
l AS (SELECT key, edition, arg_max(text, seq) AS text FROM h WHERE key <> '' GROUP BY key, edition)
"""


def _headed(spark, d):
    docs = t(spark, d, "documents", "doc_id", "source", "text")
    return docs.select(F.regexp_extract("text", "^[^ .,;!?|]+", 0).alias("key"), F.col("source").alias("edition"), F.col("doc_id").alias("seq"), "text").where("key <> ''")


@query(_HEADED_SQL + "SELECT key, min(edition) AS edition FROM l GROUP BY key HAVING count(*) = 1 AND (SELECT count(DISTINCT edition) FROM h) > 1")
def edition_only_headwords(spark, d):
    """Headwords that one edition alone has."""
    # a digest of the text is enough to compare; the texts themselves are not shuffled
    return corpus.headword_differences(_headed(spark, d).withColumn("text", F.md5("text")))[0]


@query(_HEADED_SQL + "SELECT key, count(*) AS editions, count(DISTINCT text) AS texts FROM l GROUP BY key HAVING count(*) > 1 AND count(DISTINCT text) > 1")
def editorial_differences(spark, d):
    """Headwords whose text differs between editions; per edition the last entry counts."""
    differ = corpus.headword_differences(_headed(spark, d).withColumn("text", F.md5("text")))[1]
    return differ.select("key", F.size("texts").cast("long").alias("editions"), F.size(F.array_distinct(F.transform("texts", lambda x: x["text"]))).cast("long").alias("texts"))


@query(
    """SELECT 'nation' AS kind, n_name AS key, sha256(CAST(n_regionkey AS VARCHAR)) AS value FROM nation UNION ALL SELECT 'region', r_name, sha256(CAST(r_regionkey AS VARCHAR)) FROM region
    UNION ALL SELECT 'supplier', s_name, sha256(CAST(s_nationkey AS VARCHAR)) FROM supplier"""
)
def manifest_maps(spark, d):
    """Key to hash with a check that every key has one hash."""
    of = lambda name, k, v: t(spark, d, name).select(F.lit(name).alias("kind"), F.col(k).alias("key"), F.sha2(F.col(v).cast("string"), 256).alias("value"))
    rows = of("nation", "n_name", "n_regionkey").unionByName(of("region", "r_name", "r_regionkey")).unionByName(of("supplier", "s_name", "s_nationkey"))
    grouped = rows.groupBy("kind", "key").agg(F.collect_set("value").alias("v"))
    return grouped.select("kind", "key", F.when(F.size("v") > 1, F.raise_error(F.lit("conflicting hashes")).cast("string")).otherwise(F.get("v", 0)).alias("value"))


# ---- text ------------------------------------------------------------------------------------------------

_INJECT = f"CASE doc_id % 5 WHEN 0 THEN '{HEBREW}' WHEN 1 THEN '{GREEK}' WHEN 2 THEN text ELSE text || CASE doc_id % 7 WHEN 0 THEN '{HEBREW}' WHEN 1 THEN '{ARABIC}' ELSE '' END END"


def _injected(spark, d):
    i = F.col("doc_id")
    tail = F.when(i % 7 == 0, HEBREW).when(i % 7 == 1, ARABIC).otherwise("")
    return t(spark, d, "documents", "doc_id", "text").select("doc_id", F.when(i % 5 == 0, HEBREW).when(i % 5 == 1, GREEK).when(i % 5 == 2, F.col("text")).otherwise(F.concat("text", tail)).alias("text"))


_STRONG = "regexp_replace(s, '[\\p{Common}\\p{Inherited}]', '', 'g')"


@query(
    f"""WITH i AS (SELECT doc_id, {_INJECT} AS s FROM documents), x AS (SELECT doc_id, {_STRONG} AS r FROM i)
    SELECT doc_id, CASE WHEN regexp_full_match(r, '\\p{{Hebrew}}+') THEN 'Hebr' WHEN regexp_full_match(r, '\\p{{Arabic}}+') THEN 'Arab' WHEN regexp_full_match(r, '\\p{{Greek}}+') THEN 'Grek'
    WHEN regexp_full_match(r, '\\p{{Latin}}+') THEN 'Latn' ELSE 'Zyyy' END AS script FROM x"""
)
def classify_script(spark, d):
    """One script or Zyyy, for every whole text."""
    return _injected(spark, d).select("doc_id", tx.classify_script(F.col("text")).alias("script"))


@query(f"WITH i AS (SELECT doc_id, {_INJECT} AS s FROM documents) SELECT CASE WHEN regexp_matches(s, '\\p{{Hebrew}}|\\p{{Arabic}}|\\p{{Syriac}}') THEN 'r' ELSE '' END || CASE WHEN regexp_matches(s, '\\p{{Latin}}|\\p{{Greek}}|\\p{{Cyrillic}}') THEN 'l' ELSE '' END AS k, count(*) AS n FROM i GROUP BY k")
def strong_directions(spark, d):
    """How many texts have right-to-left, left-to-right, or both."""
    k = F.concat(F.when(F.col("text").rlike(r"[\p{IsHebrew}\p{IsArabic}\p{IsSyriac}]"), "r").otherwise(""), F.when(F.col("text").rlike(r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}]"), "l").otherwise(""))
    return _injected(spark, d).groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH i AS (SELECT doc_id, {_INJECT} AS s FROM documents), x AS (SELECT doc_id, regexp_matches(s, '\\p{{Hebrew}}|\\p{{Arabic}}|\\p{{Syriac}}') AS r, regexp_matches(s, '\\p{{Latin}}|\\p{{Greek}}|\\p{{Cyrillic}}') AS l FROM i)
    SELECT doc_id, CASE WHEN r AND l THEN 'mixed' WHEN r THEN 'rtl' ELSE 'ltr' END AS direction FROM x"""
)
def infer_direction(spark, d):
    return _injected(spark, d).select("doc_id", tx.infer_direction(F.col("text")).alias("direction"))


@query(f"WITH i AS (SELECT doc_id, {_INJECT} AS s FROM documents) SELECT CAST(sum(len(regexp_extract_all(s, '\\p{{Hebrew}}'))) AS BIGINT) AS hebrew, CAST(sum(len(regexp_extract_all(s, '\\p{{Greek}}'))) AS BIGINT) AS greek, CAST(sum(len(regexp_extract_all(s, '[A-Za-z]'))) AS BIGINT) AS ascii FROM i")
def script_counts(spark, d):
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p)))
    return _injected(spark, d).agg(n(r"\p{IsHebrew}").alias("hebrew"), n(r"\p{IsGreek}").alias("greek"), n("[A-Za-z]").alias("ascii"))


@query("SELECT doc_id, md5(nfc_normalize(replace(text, 'e', 'e' || chr(769)))) AS digest FROM documents")
def nfc_normalize(spark, d):
    """Canonical composition of whole texts with decomposed accents put in."""
    decomposed = F.replace(F.col("text"), F.lit("e"), F.lit("é"))
    return t(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(udf.nfc(decomposed)).alias("digest"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def bidi_strip(spark, d):
    """Controls put in before every ``a`` and stripped again."""
    marked = F.replace(F.col("text"), F.lit("a"), F.lit("‏a⁦"))
    return t(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(tx.strip_bidi(marked)).alias("digest"))


@query(
    """WITH w AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN chr(8207) || source WHEN 1 THEN source || chr(65533) WHEN 2 THEN 'x' || chr(57344) || source ELSE source END AS s FROM documents)
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'embedded_bidi_control' WHEN 1 THEN 'replacement_character' ELSE 'private_use_character' END AS code,
           CASE doc_id % 4 WHEN 0 THEN 'U+200F' WHEN 1 THEN 'U+FFFD' ELSE 'U+E000' END AS code_point, CAST(CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN length(s) - 1 ELSE 1 END AS INTEGER) AS character_offset
    FROM w WHERE doc_id % 4 < 3"""
)
def unicode_warnings(spark, d):
    """Positions of controls, unresolved and private characters."""
    i, s = F.col("doc_id"), F.col("source")
    made = F.when(i % 4 == 0, F.concat(F.lit("‏"), s)).when(i % 4 == 1, F.concat(s, F.lit("�"))).when(i % 4 == 2, F.concat(F.lit("x"), s)).otherwise(s)
    out = t(spark, d, "documents", "doc_id", "source").select("doc_id", F.explode(tx.unicode_issues(made)).alias("w"))
    return out.select("doc_id", "w.code", "w.code_point", "w.character_offset")


@query()
def unicode_warnings_with_marks(spark, d):
    """All warnings of whole texts with an orphan mark put in front (needs combining classes)."""
    out = t(spark, d, "documents", "doc_id", "text").select("doc_id", udf.unicode_warnings(F.concat(F.lit("ְ"), "text")).alias("w"))
    return out.select("doc_id", F.explode("w").alias("w")).groupBy("w.code").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT doc_id, regexp_replace(regexp_replace(lower(trim(source || ' / ' || lang)), '[^a-z0-9-]', '_', 'g'), '^_+|_+$', '', 'g') || ':p' || lang || ':e' || printf('%04d', doc_id) AS entry_id,
    'safe' || regexp_replace(source || '.' || lang, '[^A-Za-z0-9_-]', '_', 'g') AS safe FROM documents"""
)
def stable_ids(spark, d):
    docs = t(spark, d, "documents", "doc_id", "source", "lang")
    return docs.select("doc_id", ids.entry_id(F.concat("source", F.lit(" / "), "lang"), F.col("lang"), F.col("doc_id")).alias("entry_id"), F.concat(F.lit("safe"), ids.safe_name(F.concat("source", F.lit("."), "lang"))).alias("safe"))


@query("SELECT p_partkey, 'g_' || replace(replace(replace(p_name, ' ', '_20_'), '#', '_23_'), ':', '_3a_') AS xml_id FROM part")
def xml_ids(spark, d):
    return t(spark, d, "part", "p_partkey", "p_name").select("p_partkey", ids.xml_id(F.col("p_name")).alias("xml_id"))


@query(
    """SELECT doc_id, CASE WHEN v <= 6 THEN 'train' WHEN v <= 8 THEN 'validation' ELSE 'test' END AS split FROM (
    SELECT doc_id, CAST('0x' || substr(sha256(encode(source) || from_hex(substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))), 1, 2) AS INTEGER) % 10 AS v
    FROM (SELECT doc_id, source, lpad(hex(doc_id), 8, '0') AS h FROM documents))"""
)
def page_split(spark, d):
    """Deterministic train / validation / test split."""
    return t(spark, d, "documents", "doc_id", "source").select("doc_id", ids.page_split(F.col("source"), F.col("doc_id")).alias("split"))


@query("SELECT unnest([1, 2, 3, 5, 8]) AS page")
def page_spec(spark, d):
    return spark.range(1).select(F.explode(ids.page_spec(F.lit("5,1-3,3,8"))).alias("page"))


@query(
    """SELECT l, CAST(row_number() OVER (ORDER BY n IS NOT NULL, coalesce(n, 0), CASE WHEN n IS NULL THEN l ELSE '' END) AS INTEGER) AS place FROM (
    SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN 'x' || p_size ELSE CAST(p_size AS VARCHAR) END AS l, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS n FROM part)"""
)
def page_order(spark, d):
    """Printed pages: labels first, then numbers by value (a bounded set of labels)."""
    label = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    labels = t(spark, d, "part", "p_size").select(label.alias("l")).distinct()
    return labels.select("l", F.row_number().over(Window.orderBy(ids.page_key(F.col("l")))).alias("place"))


# ---- segmentation and windows ----------------------------------------------------------------------------

_LINES_SQL = """
WITH n AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
f AS (SELECT doc_id, pos, line, (regexp_matches(line, '^[A-M]') OR pos = 1) AS opens, pos % 7 = 0 AS heading FROM n),
e AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS entry_no FROM f)
"""


def _lines(spark, d):
    lines = t(spark, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).withColumn("pos", F.col("p") + 1)
    flags = lines.select("doc_id", "pos", "line", (F.col("line").rlike("^[A-M]") | (F.col("pos") == 1)).alias("opens"), (F.col("pos") % 7 == 0).alias("heading"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return flags.withColumn("entry_no", F.sum(F.col("opens").cast("int")).over(w))


@query(_LINES_SQL + "SELECT doc_id, CAST(entry_no AS BIGINT) AS entry_no, count(*) AS lines, CAST(min(pos) AS BIGINT) AS first_line FROM e GROUP BY doc_id, entry_no")
def segment_entries(spark, d):
    """Lines into entries: a running sum of opening lines (gaps and islands)."""
    return _lines(spark, d).groupBy("doc_id", "entry_no").agg(F.count(F.lit(1)).alias("lines"), F.min("pos").cast("long").alias("first_line"))


@query(
    _LINES_SQL
    + """, k AS (SELECT *, lag(heading) OVER (PARTITION BY doc_id, entry_no ORDER BY pos) AS before FROM e), b AS (SELECT *, sum(CASE WHEN before = heading AND NOT opens THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, entry_no ORDER BY pos) AS block_no FROM k)
    SELECT doc_id, CAST(entry_no AS BIGINT) AS entry_no, CAST(block_no AS BIGINT) AS block_no, bool_or(heading) AS heading, count(*) AS lines FROM b GROUP BY doc_id, entry_no, block_no"""
)
def segment_blocks(spark, d):
    """Entries into blocks: a block goes on while the kind stays."""
    w = Window.partitionBy("doc_id", "entry_no").orderBy("pos")
    kinds = _lines(spark, d).withColumn("before", F.lag("heading").over(w))
    goes_on = F.coalesce((F.col("before") == F.col("heading")) & ~F.col("opens"), F.lit(False))
    blocks = kinds.withColumn("block_no", F.sum((~goes_on).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return blocks.groupBy("doc_id", "entry_no", "block_no").agg(F.bool_or("heading").alias("heading"), F.count(F.lit(1)).alias("lines"))


@query()
def segment_pages(spark, d):
    """The full page-layout rules over documents laid out as pages of lines, with Hebrew heads put in."""
    return _laid_out(spark, d).transform(lambda x: layout.segment(x)).groupBy("edition", "source_page", "kind").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("entry_id").alias("entries"))


def _laid_out(spark, d):
    lines = t(spark, d, "documents", "doc_id", "source", "text").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    n = F.col("n")
    words = F.transform(F.filter(F.split("line", " "), lambda w: w != ""), lambda w, k: F.struct(k.cast("string").alias("id"), w.alias("text"), F.lit(0.9).cast("float").alias("confidence"), (k * 10).cast("float").alias("x"), (n * 50).cast("float").alias("y"), F.lit(9.0).cast("float").alias("w"), F.lit(45.0).cast("float").alias("h"), F.lit(None).cast("string").alias("language")))
    head = F.when(n % 3 == 0, F.lit(HEBREW + " m. ")).otherwise("")
    whole = lambda c: F.lit(c).cast("int")
    return lines.select(
        F.col("source").alias("edition"), F.col("doc_id").cast("int").alias("source_page"), F.lit("primary").alias("engine"), whole(1000).alias("page_w"), (F.lit(4000) + n * 0).cast("int").alias("page_h"),
        whole(0).alias("region_ord"), F.lit("r").alias("region_id"), whole(50).alias("region_x"), whole(0).alias("region_y"), whole(420).alias("region_w"), whole(4000).alias("region_h"),
        n.cast("int").alias("line_ord"), F.concat(F.lit("l"), n.cast("string")).alias("line_id"), F.when(n % 3 == 0, 90).otherwise(50).cast("int").alias("x"), (F.lit(300) + n * 50).cast("int").alias("y"), whole(400).alias("w"), whole(45).alias("h"),
        F.concat(head, "line").alias("text"), F.lit(0.9).cast("float").alias("confidence"), F.array().cast("array<struct<x:float,y:float>>").alias("polygon"), words.alias("words"), F.col("doc_id").cast("string").alias("printed_page"), F.lit(False).alias("front_matter"),
    )


@query(
    """WITH p AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, ts FROM events),
    r AS (SELECT user_id, event_type, sum(CASE WHEN before = event_type THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM p)
    SELECT user_id, CAST(run AS BIGINT) AS run, min(event_type) AS event_type, count(*) AS n FROM r GROUP BY user_id, run HAVING count(*) >= 3"""
)
def run_islands(spark, d):
    """Runs of three or more equal events of a user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t(spark, d, "events", "user_id", "event_id", "event_type", "ts").withColumn("before", F.lag("event_type").over(w))
    same = F.coalesce(F.col("before") == F.col("event_type"), F.lit(False))
    runs = e.withColumn("run", F.sum((~same).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count(F.lit(1)).alias("n")).where("n >= 3")


@query(
    """WITH p AS (SELECT DISTINCT l_suppkey AS edition, CAST(l_partkey AS INTEGER) AS source_page FROM lineitem), c AS (SELECT *, source_page - row_number() OVER (PARTITION BY edition ORDER BY source_page) AS chain FROM p)
    SELECT edition, CAST(min(source_page) AS INTEGER) AS first_page, count(*) AS pages FROM c GROUP BY edition, chain HAVING count(*) > 1"""
)
def chain_continuation(spark, d):
    """Maximal runs of consecutive pages per edition."""
    pages = t(spark, d, "lineitem", "l_suppkey", "l_partkey").select(F.col("l_suppkey").alias("edition"), F.col("l_partkey").cast("int").alias("source_page"))
    return layout.chains(pages).groupBy("edition", "chain").agg(F.min("source_page").alias("first_page"), F.count(F.lit(1)).alias("pages")).where("pages > 1").drop("chain")


_WORDS_SQL = "WITH w AS (SELECT doc_id, generate_subscripts(regexp_extract_all(text, '[^ ]+'), 1) AS pos, unnest(regexp_extract_all(text, '[^ ]+')) AS word FROM documents)"


@query(_WORDS_SQL + "SELECT word, count(*) AS n FROM (SELECT word, lag(word) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM w) WHERE before = 'the' GROUP BY word HAVING count(*) > 2")
def label_hint(spark, d):
    """Words that follow a label word, found inside each text's word array (no shuffle by document)."""
    words = F.filter(F.split("text", " "), lambda x: x != "")
    pairs = t(spark, d, "documents", "text").select(words.alias("w")).select(F.explode(F.filter(F.transform("w", lambda x, i: F.when((i > 0) & (F.get("w", i - 1) == "the"), x)), lambda x: x.isNotNull())).alias("word"))
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 2")


@query(
    _WORDS_SQL
    + """, l AS (SELECT doc_id, pos, word, lead(word, 1) OVER o AS a, lead(word, 2) OVER o AS b, lead(word, 3) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos))
    SELECT doc_id, count(*) AS n FROM l WHERE length(word) <= 6 AND (a IN ('of', 'de', 'le') OR b IN ('of', 'de', 'le') OR c IN ('of', 'de', 'le')) GROUP BY doc_id"""
)
def grammar_lookahead(spark, d):
    """Short words with a label among the next three words."""
    words = F.filter(F.split("text", " "), lambda x: x != "")

    def hits(w):
        label = lambda i, k: F.coalesce(F.get(w, i + k).isin("of", "de", "le"), F.lit(False))  # noqa: E731  (slice would copy the array for every word)
        return F.size(F.filter(w, lambda x, i: (F.length(x) <= 6) & (label(i, 1) | label(i, 2) | label(i, 3))))

    # the words are a lambda's argument: as a column they would be split anew for every word once the filter is pushed down
    n = F.get(F.transform(F.array(words), hits), 0).cast("long")
    return t(spark, d, "documents", "doc_id", "text").select("doc_id", n.alias("n")).where("n > 0")


@query()
def enumeration_chain(spark, d):
    """Languages carried along ``X and Y and Z`` inside lines, smoothed over runs."""
    lines = _laid_out(spark, d)
    out = layout.classify_languages(lines.drop("printed_page", "front_matter"), ["heb", "grc"])
    return out.select("edition", F.explode("words.language").alias("l")).groupBy("edition", F.coalesce("l", F.lit("-")).alias("language")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, l_linestatus, v[len(v) // 2 + 1] AS upper_median FROM (SELECT l_returnflag, l_linestatus, list_sort(list(l_extendedprice)) AS v FROM lineitem GROUP BY l_returnflag, l_linestatus)")
def upper_median(spark, d):
    """Upper median by rank: a window count and one row per group, no array of a whole group."""
    p = t(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_extendedprice")
    keys = ["l_returnflag", "l_linestatus"]
    # duplicates fall together first, so a group's window holds its distinct values only
    values = p.groupBy(*keys, "l_extendedprice").count()
    w = Window.partitionBy(*keys)
    ranked = values.select(*keys, "l_extendedprice", F.sum("count").over(w.orderBy("l_extendedprice").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("count").over(w).alias("n"))
    return ranked.where(F.col("upto") > F.floor(F.col("n") / 2)).groupBy(*keys).agg(F.min("l_extendedprice").alias("upper_median"))


# ---- matching ----------------------------------------------------------------------------------------------

_BOX_SQL = """WITH b AS (SELECT vec_id AS i, vec_id // 25 AS page, embedding[1] AS a, embedding[2] AS b, abs(embedding[3]) + 0.5 AS w, abs(embedding[4]) + 0.5 AS h FROM embeddings),
x AS (SELECT i, page, CAST(a AS DOUBLE) AS x1, CAST(b AS DOUBLE) AS y1, CAST(a AS DOUBLE) + CAST(w AS DOUBLE) AS x2, CAST(b AS DOUBLE) + CAST(h AS DOUBLE) AS y2 FROM b)"""


def _boxes(spark, d):
    v = lambda k: F.get("embedding", k).cast("double")
    size = lambda k: F.abs(F.get("embedding", k)).cast("double") + 0.5
    b = t(spark, d, "embeddings", "vec_id", "embedding", "label")
    return b.select(F.col("vec_id").alias("i"), F.floor(F.col("vec_id") / 25).alias("page"), F.struct(v(0).alias("x1"), v(1).alias("y1"), (v(0) + size(2)).alias("x2"), (v(1) + size(3)).alias("y2")).alias("box"), (F.col("label") % 7 / 7).alias("confidence"))


@query(
    """WITH b AS (SELECT vec_id AS i, vec_id // 25 AS page, CAST(embedding[1] AS DOUBLE) AS x1, CAST(embedding[2] AS DOUBLE) AS y1, CAST(abs(embedding[3]) AS DOUBLE) + 0.5 AS w, CAST(abs(embedding[4]) AS DOUBLE) + 0.5 AS h FROM embeddings),
    p AS (SELECT l.page, l.i AS l, r.i AS r, greatest(least(l.x1 + l.w, r.x1 + r.w) - greatest(l.x1, r.x1), 0) * greatest(least(l.y1 + l.h, r.y1 + r.h) - greatest(l.y1, r.y1), 0) AS o, l.w * l.h AS la, r.w * r.h AS ra
          FROM b l JOIN b r ON l.page = r.page AND l.i % 2 = 0 AND r.i % 2 = 1)
    SELECT page, count(*) AS pairs, round(sum(o / (la + ra - o)), 6) AS total FROM p WHERE o / (la + ra - o) >= 0.15 GROUP BY page"""
)
def spatial_candidates(spark, d):
    """Overlapping boxes of two readings of a page: equality on the page, IoU as residual."""
    b = _boxes(spark, d)
    pairs = matching.spatial_candidates(b.where("i % 2 = 0"), b.where("i % 2 = 1"), ["page"])
    return pairs.groupBy("page").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.sum("iou"), 6).alias("total"))


@query()
def greedy_match(spark, d):
    """One-to-one alignment by falling overlap."""
    b = _boxes(spark, d)
    return matching.align(b.where("i % 2 = 0"), b.where("i % 2 = 1"), ["page"])


@query()
def nearest_unused(spark, d):
    b = _boxes(spark, d)
    return matching.nearest_unused(b.where("i % 2 = 0"), b.where("i % 2 = 1"), ["page"])


@query()
def overlap_dedupe(spark, d):
    return matching.dedupe_overlapping(_boxes(spark, d), ["page"], 0.3)


@query(
    """WITH s AS (SELECT user_id, event_id, ts AS lo, ts + INTERVAL 30 MINUTE AS hi FROM events WHERE event_type = 'error'), p AS (SELECT user_id, event_id, ts AS lo, ts + INTERVAL 5 MINUTE AS hi FROM events WHERE event_type = 'purchase')
    SELECT user_id, event_id FROM p WHERE EXISTS (SELECT 1 FROM s WHERE s.user_id = p.user_id AND p.lo < s.hi AND s.lo < p.hi)"""
)
def interval_semi(spark, d):
    """Purchases that overlap an error interval of the same user."""
    e = t(spark, d, "events", "user_id", "event_id", "event_type", "ts")
    of = lambda kind, minutes: e.where(F.col("event_type") == kind).select("user_id", "event_id", F.col("ts").alias("lo"), (F.col("ts") + F.expr(f"INTERVAL {minutes} MINUTES")).alias("hi"))
    return matching.interval_semi(of("purchase", 5), of("error", 30).drop("event_id"), ["user_id"]).select("user_id", "event_id")


# ---- metrics -------------------------------------------------------------------------------------------------

def _turns(spark, d):
    c = t(spark, d, "conversations", "conv_id", "turn", "text")
    return c.withColumn("before", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("before IS NOT NULL")


@query()
def cer(spark, d):
    """Character error rate of each turn against the one before, in code points (DuckDB's distance counts bytes, so there is no SQL)."""
    return _turns(spark, d).select("conv_id", "turn", F.round(mx.cer(F.col("before"), F.col("text")), 9).alias("cer"))


@query()
def wer(spark, d):
    return _turns(spark, d).select("conv_id", "turn", F.round(mx.wer(F.col("before"), F.col("text")), 9).alias("wer"))


@query()
def script_cer(spark, d):
    scored = _turns(spark, d).select("conv_id", "turn", F.explode(mx.script_cer(F.concat("before", F.lit(HEBREW)), F.concat("text", F.lit(GREEK)))).alias("script", "cer"))
    return scored.select("conv_id", "turn", "script", F.round("cer", 9).alias("cer"))


@query()
def disagreement_queue(spark, d):
    """Conversations queued because two adjacent readings disagree (no SQL, as for ``cer``)."""
    worst = _turns(spark, d).groupBy("conv_id").agg(F.max(mx.disagreement(F.col("before"), F.col("text"))).alias("disagreement"))
    return worst.where(F.col("disagreement") > 0.15).select("conv_id", F.round("disagreement", 9).alias("disagreement"))


@query("SELECT item_id FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = b.item_id * 37)")
def missing_gold(spark, d):
    """Gold items without a reading."""
    gold = t(spark, d, "benchmark", "item_id").withColumn("doc_id", F.col("item_id") * 37)
    return gold.join(t(spark, d, "documents", "doc_id"), "doc_id", "left_anti").select("item_id")


@query("SELECT CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) / count(*) FILTER (toxic = 0) AS precision, CAST(count(*) FILTER (quality = 1 AND toxic = 0) AS DOUBLE) / count(*) FILTER (quality = 1) AS recall FROM labels")
def precision_recall(spark, d):
    hits, said, true = F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)), F.count_if(F.col("toxic") == 0), F.count_if(F.col("quality") == 1)
    share = lambda n: F.when(n == 0, 1.0).otherwise(hits / n)
    return t(spark, d, "labels").agg(share(said).alias("precision"), share(true).alias("recall"))


# ---- changes ---------------------------------------------------------------------------------------------------


@query("SELECT c.conv_id AS id, n AS revision, md5(arg_max(text, turn)) AS digest FROM conversations c JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) k ON c.conv_id = k.conv_id GROUP BY c.conv_id, n")
def patch_replay(spark, d):
    """Conversations as correction logs: the last valid replacement of every entry."""
    c = t(spark, d, "conversations", "conv_id", "turn", "text")
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long")
    base = c.select(F.col("conv_id").cast("string").alias("id"), F.lit(0).cast("long").alias("revision"), F.lit("").alias("text")).distinct()
    patches = c.select(
        F.col("turn").alias("seq"), F.col("conv_id").cast("string").alias("entry_id"), (number - 1).alias("base_revision"), number.alias("revision"),
        F.struct(F.col("conv_id").cast("string").alias("id"), number.alias("revision"), "text").alias("replacement"),
    )
    out = corpus.replay(base, patches, strict=False)
    return out.select(F.col("id").cast("long").alias("id"), "revision", F.md5("text").alias("digest"))


@query("SELECT conv_id, turn, 'unknown_entry' AS code FROM conversations WHERE conv_id % 5 = 0")
def chain_violations(spark, d):
    """Patches whose entry is missing from the base."""
    c = t(spark, d, "conversations", "conv_id", "turn")
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long")
    base = c.where("conv_id % 5 <> 0").select(F.col("conv_id").cast("string").alias("id"), F.lit(0).cast("long").alias("revision")).distinct()
    patches = c.select(F.col("turn").alias("seq"), F.col("conv_id").cast("string").alias("entry_id"), (number - 1).alias("base_revision"), number.alias("revision"), F.struct(F.col("conv_id").cast("string").alias("id"), number.alias("revision")).alias("replacement"))
    found = corpus.replay_issues(base, patches)
    return found.select(F.col("entry_id").cast("long").alias("conv_id"), F.col("seq").alias("turn"), "code")


@query(
    """WITH c AS (SELECT l_orderkey AS k, arg_max(round(l_extendedprice, 2), l_linenumber) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
    SELECT o_orderkey, coalesce(c.price, round(o_totalprice, 2)) AS price FROM orders LEFT JOIN c ON o_orderkey = k"""
)
def upsert_merge(spark, d):
    """Changes by key over a base: the last change wins, of equal line numbers the first in the table; other base rows stay."""
    base = t(spark, d, "orders", "o_orderkey", "o_totalprice").select("o_orderkey", F.round("o_totalprice", 2).alias("price"))
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    changes = lines.where("l_returnflag = 'R' AND l_linenumber IS NOT NULL AND l_extendedprice IS NOT NULL").select(F.col("l_orderkey").alias("o_orderkey"), F.round("l_extendedprice", 2).alias("price"), "l_linenumber", "file", "row")
    known = changes.join(base.select("o_orderkey"), "o_orderkey", "left_semi")
    return corpus.upsert(base, known, ["o_orderkey"], "l_linenumber", ("file", "row"))


# ---- validation --------------------------------------------------------------------------------------------------


@query(
    """WITH e AS (SELECT d.*, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, 'short' AS code FROM e WHERE n_chars < 200 UNION ALL SELECT doc_id, 'unlabelled' FROM e WHERE quality IS NULL UNION ALL SELECT doc_id, 'no_space' FROM e WHERE NOT contains(text, ' ')"""
)
def validation_issues(spark, d):
    """Several rules in one pass: an array of violations, exploded."""
    e = t(spark, d, "documents", "doc_id", "n_chars", "text").join(t(spark, d, "labels", "doc_id", "quality"), "doc_id", "left")
    rules = F.array(F.when(F.col("n_chars") < 200, "short"), F.when(F.col("quality").isNull(), "unlabelled"), F.when(~F.contains("text", F.lit(" ")), "no_space"))
    return e.select("doc_id", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("code"))


@query("SELECT doc_id, first_value(doc_id) OVER w AS owner FROM (SELECT doc_id, md5(text) AS h FROM documents) WINDOW w AS (PARTITION BY h ORDER BY doc_id) QUALIFY row_number() OVER w > 1")
def duplicate_rows(spark, d):
    """Rows whose text was seen before, with the first owner (joined, so no group is gathered)."""
    h = t(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5("text").alias("h"))
    first = h.groupBy("h").agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return h.join(first, "h").where("doc_id <> owner").select("doc_id", "owner")


@query("SELECT doc_id, lag(doc_id) OVER (PARTITION BY h ORDER BY doc_id) AS previous FROM (SELECT doc_id, md5(text) AS h FROM documents) QUALIFY previous IS NOT NULL")
def previous_owner(spark, d):
    h = t(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5("text").alias("h"))
    return h.withColumn("previous", F.lag("doc_id").over(Window.partitionBy("h").orderBy("doc_id"))).where("previous IS NOT NULL").select("doc_id", "previous")


@query(
    """SELECT 'orders.customer' AS key, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS broken UNION ALL
    SELECT 'lineitem.orders', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) UNION ALL
    SELECT 'nation.region', (SELECT count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)) UNION ALL
    SELECT 'labels.even', (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0))"""
)
def integrity_anti_joins(spark, d):
    """Broken references per foreign key."""
    even = t(spark, d, "documents", "doc_id").where("doc_id % 2 = 0")
    checks = [
        ("orders.customer", t(spark, d, "orders", "o_custkey"), "o_custkey", t(spark, d, "customer", "c_custkey"), "c_custkey"),
        ("lineitem.orders", t(spark, d, "lineitem", "l_orderkey"), "l_orderkey", t(spark, d, "orders", "o_orderkey"), "o_orderkey"),
        ("nation.region", t(spark, d, "nation", "n_regionkey"), "n_regionkey", t(spark, d, "region", "r_regionkey"), "r_regionkey"),
        ("labels.even", t(spark, d, "labels", "doc_id"), "doc_id", even, "doc_id"),
    ]
    out = None
    for name, child, key, parent, parent_key in checks:
        row = corpus.broken_references(child, key, parent, parent_key).agg(F.count(F.lit(1)).alias("broken")).select(F.lit(name).alias("key"), "broken")
        out = row if out is None else out.unionByName(row)
    return out


# ---- nested results ---------------------------------------------------------------------------------------------------


@query(
    """SELECT o_custkey, string_agg(o, ';' ORDER BY k) AS orders FROM (
    SELECT o_custkey, o_orderkey AS k, o_orderkey || ':' || string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS o FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, o_orderkey) GROUP BY o_custkey"""
)
def page_summary(spark, d):
    """Two-level nesting: customer, its orders, their lines."""
    joined = t(spark, d, "orders", "o_orderkey", "o_custkey").join(t(spark, d, "lineitem", "l_orderkey", "l_linenumber"), F.col("o_orderkey") == F.col("l_orderkey"))
    per = joined.groupBy("o_custkey", "o_orderkey").agg(F.array_join(F.array_sort(F.collect_list("l_linenumber")).cast("array<string>"), ",").alias("lines"))
    nested = per.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "lines"))).alias("o"))
    return nested.select("o_custkey", F.array_join(F.transform("o", lambda x: F.concat(x["o_orderkey"].cast("string"), F.lit(":"), x["lines"])), ";").alias("orders"))


@query("SELECT l_orderkey AS parent, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS ordinal, l_partkey AS part FROM lineitem")
def shred_children(spark, d):
    """Nest lines under orders, then shred them to rows with their ordinal again."""
    nested = t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    return nested.select(F.col("l_orderkey").alias("parent"), F.posexplode("lines").alias("ordinal", "x")).select("parent", "ordinal", F.col("x.l_partkey").alias("part"))


@query("SELECT term, count(*) AS documents FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{8,}')) AS term FROM documents) GROUP BY term HAVING count(*) > 3")
def search_term(spark, d):
    """Document frequency of terms: each text's distinct terms, then a pre-aggregated count."""
    terms = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{8,}"), F.lit(0)))
    return t(spark, d, "documents", "text").select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("documents")).where("documents > 3")


@query()
def search_index(spark, d):
    """Documents per term of the inverted index: all tokens of letters and digits, however short or rare."""
    return corpus.search_index(_corpus(spark, d)).groupBy("term").agg(F.count_distinct("entry_id").alias("documents"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def first_seen(spark, d):
    """First occurrence per key, by a pre-aggregated minimum."""
    return t(spark, d, "events", "user_id", "event_type", "event_id").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))


@query("SELECT d.source, count(*) AS n FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) GROUP BY d.source")
def pilot_semi_join(spark, d):
    return t(spark, d, "documents", "doc_id", "source").join(t(spark, d, "labels", "doc_id", "quality").where("quality = 1"), "doc_id", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def ordered_text(spark, d):
    """Ordered concatenation."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return t(spark, d, "conversations", "conv_id", "turn", "text").groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda x: x["text"]), "\n").alias("text"))


@query("SELECT doc_id, '<e n=\"' || doc_id || '\">' || replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;') || '</e>' AS xml FROM documents")
def xml_fragments(spark, d):
    """Each document as an escaped XML fragment."""
    return t(spark, d, "documents", "doc_id", "text").select("doc_id", F.concat(F.lit('<e n="'), F.col("doc_id").cast("string"), F.lit('">'), tx.xml_escape(F.col("text")), F.lit("</e>")).alias("xml"))


@query()
def corpus_validation(spark, d):
    """All corpus rules over entries built from documents with planted faults; issues by code."""
    return corpus.validate(_corpus(spark, d)).groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))


@query()
def relational_tables(spark, d):
    """Row counts of the shredded corpus."""
    out = None
    for name, table in writers.shred(_corpus(spark, d)).items():
        row = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query()
def lexicon_xml(spark, d):
    return _corpus(spark, d).select("id", F.md5(writers.tei_entry()).alias("digest"))


@query()
def review_queue(spark, d):
    entries = _corpus(spark, d, "hypotheses", "readings", "warnings")
    return corpus.review_summary(entries).where("queued").select("id", "confidence", "warnings", F.round("disagreement", 6).alias("disagreement"))


def _corpus(spark, d, *needs):
    """Documents as entries: one span per line, whose two readings are the whole line and the line with letters confused.

    ``needs`` names the span fields that the caller looks at (``readings``: the texts of ``hypotheses``); the others are
    null then, as no optimizer prunes what a lambda builds.  Without it all are there.  Rows and spans are the same."""
    from . import schemas

    docs = t(spark, d, "documents", "doc_id", "source", "lang", "text")
    eid = F.col("id")
    n = lambda k: k.cast("int")

    def field(name, value):
        return value() if not needs or name in needs else F.lit(None)

    def span(x, k):
        point = lambda a, b: F.struct(F.lit(a).cast("float").alias("x"), (k * 50 + b).cast("float").alias("y"))
        place = lambda: F.array(F.struct(n(F.col("doc_id")).alias("source_page"), F.col("lang").alias("printed_page"), F.lit("r").alias("region_id"), F.concat(F.lit("l"), k.cast("string")).alias("line_id"), field("polygon", lambda: F.array(point(0, 0), point(9, 0), point(9, 40))).cast(schemas.POLYGON).alias("polygon"), F.lit("t").alias("transform_id"), F.lit("p").alias("page_image")))
        reading = lambda e, v: F.struct(F.lit(e).alias("engine"), F.lit("1").alias("engine_version"), F.lit("m").alias("model"), F.lit("c" * 64).alias("model_hash"), field("readings", v).cast("string").alias("text"), F.lit(0.9).cast("float").alias("confidence"))
        made = {
            "id": lambda: ids.span_id(eid, k + 1), "diplomatic": lambda: x, "normalized": lambda: x, "language": lambda: F.lit(None), "script": lambda: tx.classify_script(x), "direction": lambda: tx.infer_direction(x),
            "confidence": lambda: F.lit(0.5) + (F.col("doc_id") % 5) / 10, "review_state": lambda: F.lit("machine"),
            "hypotheses": lambda: F.array(reading("a", lambda: x), reading("b", lambda: F.replace(x, F.lit("e"), F.lit("c")))), "coordinates": place, "warnings": lambda: F.array(),
        }
        return F.struct(*[field(f.name, made[f.name]).cast(f.dataType).alias(f.name) for f in schemas.SPAN])

    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    empty = lambda kind: F.array().cast(schemas.array(kind))
    # the id is a column of its own, so that the spans do not build it anew for every line
    named = docs.select("doc_id", "source", "lang", lines.alias("lines"), ids.entry_id(F.col("source"), F.col("lang"), F.col("doc_id")).alias("id"))
    return named.select(
        eid, F.array(F.when(F.col("doc_id") % 50 == 0, eid).otherwise(F.concat(F.lit("alias-"), F.col("doc_id").cast("string")))).alias("aliases"), F.col("source").alias("edition"), F.col("lang").alias("printed_page"),
        n(F.col("doc_id")).alias("entry_ordinal"), F.when(F.col("doc_id") % 3 == 0, span(F.substring(F.get("lines", 0), 1, 5), F.lit(9998))).alias("headword"), F.lit(None).cast("int").alias("homograph"), empty(schemas.SPAN).alias("grammatical_labels"),
        F.array(F.struct(ids.block_id(eid, F.lit(1)).alias("id"), F.lit("paragraph").alias("kind"), F.transform("lines", span).alias("spans"))).alias("blocks"), empty(schemas.SENSE).alias("senses"), empty(schemas.CITATION).alias("citations"),
        empty(schemas.CROSS_REFERENCE).alias("cross_references"), empty(schemas.BLOCK).alias("etymology"),
        F.struct(F.when(F.col("doc_id") % 70 == 0, "other").otherwise(F.col("source")).alias("edition"), F.lit("a" * 64).alias("source_sha256"), F.lit("scan").alias("scan_id"), F.lit("run").alias("pipeline_run")).alias("provenance"),
        (F.lit(0.5) + (F.col("doc_id") % 5) / 10).cast("float").alias("confidence"), F.lit("machine").alias("review_state"), F.lit(0).cast("long").alias("revision"),
    )


@query()
def page_extract(spark, d):
    """Raw pages: title, number of links and visible length, by ordered pattern extraction."""
    p = t(spark, d, "pages", "page_id", "html")
    visible = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " ")
    return p.select("page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.regexp_count("html", F.lit(r"(?i)<a\s")).alias("links"), F.length(F.trim(F.regexp_replace(visible, r"\s+", " "))).alias("visible"))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upsert(spark, d):
    """The same change log as a stream: micro-batches keep the last change per key."""
    import tempfile
    import uuid

    from .streaming import changes

    schema = t(spark, d, "events").schema
    where = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="foliant-stream-")
    base = f"{where.rstrip('/')}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(_as_folder(spark, d, "events"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy("user_id").agg(F.max(F.struct("event_id", "event_type")).alias("x")).select("user_id", "x.event_type", "x.event_id")
        last.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    changes.publish_stream(stream.select("user_id", "event_id", "event_type"), merge, f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("user_id").agg(F.max(F.struct("event_id", "event_type")).alias("x")).select("user_id", "x.event_type", "x.event_id")


def _as_folder(spark: SparkSession, d: str, name: str) -> str:
    """A streaming source reads folders; a table that is one file is named by a glob."""
    return f"{d.rstrip('/')}/{name}.parquet*"


def queries() -> dict[str, Callable]:
    from . import library_queries

    return _QUERIES | library_queries.queries()


def oracle_sql() -> dict[str, str]:
    from . import library_queries

    return _ORACLES | library_queries.oracle_sql()
