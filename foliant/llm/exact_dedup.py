"""Exact duplicates by progressive refinement (DataFrame functions only).

1. every row's normalised length (and, from the same read, a hash of its first characters);
2. lengths that occur once are done; the others are refined by the prefix hash;
3. (length, prefix) pairs that occur once are done; only for the others is the whole text read and
   hashed (SHA-256).

Between the levels the surviving keys travel as a :class:`KeyFilter` of bounded size, so no text and
no unique row is ever shuffled.  Only rows with a full hash take part in the final group-by, which is
pre-aggregated; a hot group (a third of all rows being one text) is one row after the partial
aggregation, and the join back to its members is an ordinary left join that AQE can split.

Defined cases: null text counts as empty, all empty texts are equal; null doc_id sorts after every
other id; of fully tied rows exactly one is kept; extra columns of any name are ignored or carried.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, materialize, without_space


def _scan(docs: DataFrame, text: str, doc_id: str, prefix_chars: int) -> tuple[Column, DataFrame]:
    row = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    norm = row.select("doc_id", "text", without_space(F.col("text")).alias("norm"))
    return F.xxhash64("nlen", "prefix"), norm.select(
        "doc_id",
        F.char_length("text").cast("long").alias("olen"),
        F.octet_length("norm").cast("long").alias("nlen"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"),
        "norm",
    )


def survivors(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", prefix_chars: int = 64, log2_bits: int = 24) -> KeyFilter:
    """Levels 1 and 2: the (length, prefix) keys whose rows need their whole text read."""
    pair, scan = _scan(docs, text, doc_id, prefix_chars)
    keys = materialize(scan.select("nlen", "prefix"), "dedup-keys")
    lengths = KeyFilter(keys.groupBy("nlen").count().where("count > 1"), F.xxhash64("nlen"), log2_bits)
    same_length = lengths.mark(keys, F.xxhash64("nlen"), "again").where("again")
    return KeyFilter(same_length.groupBy("nlen", "prefix").count().where("count > 1"), pair, log2_bits)


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    *,
    prefix_chars: int = 64,
    log2_bits: int = 24,
    digest_all: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``text_sha256`` is null where an earlier level proved the row unique, unless ``digest_all``
    asks for it as an output (it then plays no part in the decision).
    """
    pair, scan = _scan(docs, text, doc_id, prefix_chars)
    marked = survivors(docs, text, doc_id, prefix_chars, log2_bits).mark(scan, pair, "again")
    sha = F.sha2("norm", 256)
    rows = materialize(
        marked.select(
            "doc_id",
            "olen",
            "again",
            (sha if digest_all else F.when(F.col("again"), sha)).alias("sha"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "dedup-rows",
    )
    again, once = rows.where("again"), rows.where("not again")
    best = F.struct((-F.col("olen")).alias("o"), F.col("doc_id").isNull().alias("n"), "doc_id", "rid")
    groups = (
        again.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("best"))
        .where("group_size > 1")
        .select(F.col("sha").alias("g_sha"), "group_size", F.col("best.doc_id").alias("g_keep"), F.col("best.rid").alias("g_rid"))
    )
    # as a table of its own: a join straight on the aggregation keeps AQE from splitting a hot group's members
    groups = materialize(groups, "dedup-groups")
    one = F.col("g_sha").isNull()
    found = again.join(groups, F.col("sha") == F.col("g_sha"), "left").select(
        "doc_id",
        F.when(one, F.col("doc_id")).otherwise(F.col("g_keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (one | (F.col("rid") == F.col("g_rid"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    alone = once.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return found.unionByName(alone)


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, prefix_chars: int = 64, log2_bits: int = 24) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Rows whose (length, prefix) is unique pass straight through; only candidates are grouped by full
    hash.  A group's best row is found on keys alone (pre-aggregated) and joined back, so no group
    of texts is gathered in one task; fully identical rows then fall to one by ``dropDuplicates``,
    which also pre-aggregates.
    """
    pair = F.xxhash64("nlen", "prefix")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    norm = whole.select("row", without_space(F.coalesce(F.col("row")[text], F.lit(""))).alias("norm"))
    scan = norm.select("row", F.octet_length("norm").cast("long").alias("nlen"), F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"), "norm")
    marked = survivors(docs, text, doc_id, prefix_chars, log2_bits).mark(scan, pair, "again")
    unique = marked.where("not again").select("row.*")
    rank = F.struct((-F.char_length(F.coalesce(F.col("row")[text], F.lit("")))).alias("o"), F.col("row")[doc_id].isNull().alias("n"), F.col("row")[doc_id].alias("d"), F.xxhash64("row").alias("tie"))
    again = marked.where("again").select("row", F.sha2("norm", 256).alias("sha"), rank.alias("rank"))
    groups = again.groupBy(F.col("sha").alias("g_sha")).agg(F.min("rank").alias("g_rank"), F.count(F.lit(1)).alias("g_n")).where("g_n > 1")
    groups = materialize(groups, "dedup-groups")
    joined = again.join(groups, F.col("sha") == F.col("g_sha"), "left")
    single = joined.where("g_sha is null").select("row.*")
    best = joined.where("g_rank = rank").select("row", "sha", "rank").dropDuplicates(["sha"]).select("row.*")
    return unique.unionByName(single).unionByName(best)


def op3_exact_dedup(spark, sf_dir):
    from .common import table

    return exact_groups(table(spark, sf_dir, "documents"), digest_all=True)


#: DuckDB: chr() for the white space so that no escape is needed.
ORACLE = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS olen,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY olen DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY olen DESC, doc_id) = 1 AS kept,
       text_sha256
FROM n
"""

QUERIES = {"op3_exact_dedup": op3_exact_dedup}
ORACLES = {"op3_exact_dedup": ORACLE}
