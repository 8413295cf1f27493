"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every version of a text is addressed by its content (SHA-256).  The ledger holds one row per
(blob, rule version) already scanned, with its findings.  A scan touches only pairs that the ledger
lacks, each distinct blob once; findings are then joined back to all rows ("paths") with that blob.

Blobs that are new and occur once are scanned where they are read, without a shuffle: a bitmap of
bounded size tells them from those that occur again or may be known.  Only the latter are grouped
(copies fall to one before the shuffle) and held against the ledger.

Positions are code points, end exclusive.  All matches of a rule and the gaps between them come
from the same leftmost, non-overlapping search, so running lengths give every position.

Defined cases: null text counts as empty (no span); rows with the same text share findings; repeated
rows stay; extra columns of any name are ignored unless carried; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, hadoop_path, materialize, shared_dir, table

#: kind, pattern, group whose length counts, least length, literal without which nothing can match.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, None),
    # a run shorter than the least length holds no other match, so the length can stand in the pattern
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, None),
)
EXTRA = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN "),
    ("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 1, "gh"),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, "xox"),
    ("cloud", r"AIza[A-Za-z0-9_-]{35}", 0, 1, "AIza"),
    ("payment", r"sk_live_[A-Za-z0-9]{16,}", 0, 1, "sk_live_"),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", 0, 1, "eyJ"),
)
RULE_VERSION = "2026-1"
LEDGER_SCHEMA = "blob string, rule_version string, spans array<struct<start:int,rank:int,end:int,kind:string>>"
_NONE = "cast(array() AS array<struct<start:int,rank:int,end:int,kind:string>>)"


def _walk(rank: int, kind: str, least: int) -> Column:
    """Spans from the struct ``f`` of matches ``m``, gaps ``g`` and counted groups ``c``."""
    return F.expr(f"""
      CASE WHEN size(f.m) = 0 THEN {_NONE} ELSE aggregate(
        sequence(0, size(f.m) - 1),
        named_struct('at', 0, 'out', {_NONE}),
        (acc, k) -> named_struct(
          'at', acc.at + length(f.g[k]) + length(f.m[k]),
          'out', CASE WHEN length(f.c[k]) >= {least} THEN concat(acc.out, array(named_struct(
             'start', acc.at + length(f.g[k]), 'rank', {rank}, 'end', acc.at + length(f.g[k]) + length(f.m[k]), 'kind', '{kind}')))
             ELSE acc.out END),
        acc -> acc.out) END""")


def scan(blobs: DataFrame, rules=BASE + EXTRA) -> DataFrame:
    """``blobs(blob, text)`` -> ``(blob, spans)``; spans sorted by start, then kind as listed."""
    found = blobs
    names = []
    for rank, (kind, pattern, group, least, needs) in enumerate(rules):
        text = F.col("text")
        none = F.array().cast("array<string>")
        has = F.contains(text, F.lit(needs)) if needs else F.lit(True)
        all_ = F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        found = found.select("*", all_.alias(f"m{rank}"))
        hit = F.size(f"m{rank}") > 0
        counted = F.col(f"m{rank}") if group == 0 else F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none)
        gaps = F.when(hit, F.split(text, pattern, -1)).otherwise(none)
        found = found.select("*", F.struct(F.col(f"m{rank}").alias("m"), gaps.alias("g"), counted.alias("c")).alias("f")).select(
            *[c for c in found.columns if c != f"m{rank}"], _walk(rank, kind, least).alias(f"s{rank}")
        )
        names.append(f"s{rank}")
    return found.select("blob", F.array_sort(F.concat(*names)).alias("spans"))


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    *,
    carry: list[str],
    ledger: DataFrame | None = None,
    rule_version: str = RULE_VERSION,
    rules=BASE + EXTRA,
    log2_bits: int = 24,
) -> tuple[DataFrame, DataFrame]:
    """``(findings, news)``: per input row its ``carry`` columns (in ``row``), ``blob`` and ``spans``;
    and the ledger rows to append."""
    spark = docs.sparkSession
    held = (ledger if ledger is not None else spark.range(0).select(F.lit("").alias("blob"), F.lit("").alias("rule_version"), F.expr(_NONE).alias("spans"))).where(F.col("rule_version") == rule_version).select("blob", "spans")
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = materialize(docs.select(F.struct(*[docs[c].alias(c) for c in carry]).alias("row"), F.sha2(t, 256).alias("blob")), "secret-rows")
    again = rows.groupBy("blob").count().where("count > 1").select("blob").unionByName(held.select("blob"))
    key = F.xxhash64("blob")
    marked = KeyFilter(again, key, log2_bits).mark(docs.select(F.sha2(t, 256).alias("blob"), t.alias("text")), key, "maybe")
    once = marked.where("not maybe").select("blob", "text")
    others = marked.where("maybe").select("blob", "text").dropDuplicates(["blob"]).join(held.select("blob"), "blob", "left_anti")
    news = materialize(scan(once, rules).unionByName(scan(others, rules)), "secret-ledger")
    known = held.unionByName(news).where("size(spans) > 0").select(F.col("blob").alias("k_blob"), "spans")
    findings = rows.join(known, F.col("blob") == F.col("k_blob"), "left").select("row", "blob", F.coalesce("spans", F.expr(_NONE)).alias("spans"))
    return findings, news.select("blob", F.lit(rule_version).alias("rule_version"), "spans")


def scan_into(docs: DataFrame, ledger_path: str, text: str = "text", *, carry: list[str], rule_version: str = RULE_VERSION, rules=BASE + EXTRA) -> DataFrame:
    """Findings of ``docs`` through the ledger kept at ``ledger_path`` (a shared folder).

    Blobs that the ledger holds under this rule version are not scanned again; what was scanned is
    appended.  An append that fails midway leaves no rows (Spark commits files at the end), and rows
    appended twice by two runs at once are equal, so findings stay right.
    """
    spark = docs.sparkSession
    where, fs = hadoop_path(spark, ledger_path)
    held = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).dropDuplicates(["blob", "rule_version"]) if fs.exists(where) else None
    findings, news = scan_secrets(docs, text, carry=carry, ledger=held, rule_version=rule_version, rules=rules)
    news.write.mode("append").parquet(ledger_path)
    return findings


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secrets(spark, sf_dir):
    # a ledger of its own for each call, so that a rerun scans as much as the first run
    ledger = f"{shared_dir(spark)}/op6-ledger-{uuid.uuid4().hex}"
    findings = scan_into(table(spark, sf_dir, "documents"), ledger, carry=["doc_id"])
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))
    return findings.select(
        F.col("row.doc_id").alias("doc_id"), *[count(kind) for kind, *_ in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


QUERIES = {"op6_secrets": op6_secrets}
ORACLES: dict[str, str] = {}
