"""Mixing sources to target weights with a time-varying curriculum (DataFrame functions only).

1. *Targets.*  Sources share a budget by weight; a target stops at ``max_epochs`` times its source's
   size and the excess is shared again by weight (water-filling, solved in closed form over one row
   per source).
2. *Demand.*  Each source has a piecewise-linear weight schedule over training time 0..1.  Its
   integral, scaled to the target, is the source's cumulative token demand.
3. *Supply.*  Documents of a source stand in a fixed pseudo-random order (MD5 of the id); a
   two-level prefix sum gives each the number of tokens before it.  Hot sources are no problem: the
   order is cut into buckets of some thousand documents, buckets are summed (pre-aggregated), and
   only bucket sums are accumulated per source.
4. *Positions.*  The demand curve is inverted at each document's middle token (once per epoch), which
   gives its training time; documents are range-sorted by it.

A document is taken whole, as often as the middle of its tokens lies before the target, so a source's
taken tokens miss the target by at most half of one document, and no document is taken more than
``max_epochs`` times.

Defined cases: null text has size 0 (never counts words, taken 0); null sources are one source,
last in order; an empty table gives an empty result; ids may repeat (order then falls to the size);
null ids are ordered by size alone; rows equal in id and size stand in the order of a hash of their text; extra columns of any name are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize, table

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
#: Relative weight at the knots of training time; each has mean 1, so a schedule's integral is the weight.
SHAPES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (1.0, 0.5)),  # early
    ((0.0, 1.0), (1.0, 1.0)),  # even
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),  # late
)
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _targets(sources: DataFrame, weights: Sequence[int], share_percent: int, epochs: int) -> DataFrame:
    """``(source, size)`` -> plus ``weight, kind, target``.  One row per source in all windows here."""
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    i = F.row_number().over(in_order) - 1
    ranked = sources.select("source", "size", i.alias("i"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.pmod(F.col("i"), F.lit(len(weights))) + 1).cast("int")).cast("long")
    weighed = ranked.select("source", "size", "i", w.alias("w")).select(
        "*", F.sum("size").over(everything).alias("total"), F.sum("w").over(everything).alias("w_all")
    )
    # a source that stops has a smaller size per weight than any that does not, so those that stop come first
    before = Window.orderBy(F.col("size") / F.col("w"), "i").rowsBetween(Window.unboundedPreceding, -1)
    filled = weighed.select(
        "*", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("size_before"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before")
    )
    # all whole numbers, in hundredths of a token, so that every engine agrees
    left = lambda s: share_percent * F.col("total") - 100 * epochs * s
    stops = F.col("w") * left(F.col("size_before")) > 100 * epochs * F.col("size") * (F.col("w_all") - F.col("w_before"))
    stopped = filled.select("*", stops.alias("stops")).select(
        "*",
        F.coalesce(F.sum(F.when(F.col("stops"), F.col("size"))).over(everything), F.lit(0)).alias("s_stop"),
        F.coalesce(F.sum(F.when(F.col("stops"), F.col("w"))).over(everything), F.lit(0)).alias("w_stop"),
    )
    share = (F.col("w") * left(F.col("s_stop"))).cast("double") / (100 * (F.col("w_all") - F.col("w_stop"))).cast("double")
    target = F.when(F.col("stops"), (epochs * F.col("size")).cast("double")).otherwise(share)
    return stopped.select("source", "size", "w", F.col("i"), target.alias("target"))


def _schedule(i: Column, shapes) -> Column:
    """Array of (t0, t1, w0, w1, c0): a schedule's pieces with the integral before each."""
    cases = []
    for knots in shapes:
        pieces, c = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            pieces.append(F.struct(*[F.lit(float(x)).alias(n) for n, x in (("t0", t0), ("t1", t1), ("w0", w0), ("w1", w1), ("c0", c))]))
            c += (t1 - t0) * (w0 + w1) / 2
        cases.append(F.struct(F.array(*pieces).alias("pieces"), F.lit(c).alias("whole")))
    return F.element_at(F.array(*cases), (F.pmod(i, F.lit(len(shapes))) + 1).cast("int"))


def _invert(schedule: Column, share: Column) -> Column:
    """The time at which the schedule's integral is ``share`` (0..1) of its whole."""
    y = share * schedule["whole"]
    p = F.element_at(F.filter(schedule["pieces"], lambda x: (x["c0"] <= y) | (x["c0"] == 0)), -1)
    rise = (p["w1"] - p["w0"]) / (p["t1"] - p["t0"])
    rest = y - p["c0"]
    step = F.when(F.abs(rise) < 1e-12, rest / p["w0"]).otherwise((F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * rise * rest, F.lit(0.0))) - p["w0"]) / rise)
    return F.least(p["t1"], F.greatest(p["t0"], p["t0"] + step))


def assign(
    docs: DataFrame,
    size: Column,
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    tie: Column | None = None,
    carry: Sequence[str] | None = None,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    shapes=SHAPES,
) -> DataFrame:
    """One row per input row: ``row`` (columns ``carry``, default all), ``size, source_size, target,
    copies, times, tie`` - ``times`` the training time of each of the document's ``copies``.

    Rows equal in id and size stand in the order of ``tie`` (a hash of the text, say); without one
    their order, but not the sums, may change between runs."""
    n_rows = docs.count()
    buckets = max(1, -(-n_rows // BUCKET_ROWS))
    digest = F.md5(F.coalesce(docs[doc_id].cast("string"), size.cast("string"), F.lit("")))
    named = docs.select(
        F.struct(*[docs[c].alias(c) for c in (docs.columns if carry is None else carry)]).alias("row"),
        docs[source].cast("string").alias("source"),
        docs[doc_id].alias("id"),
        size.alias("size"),
        digest.alias("digest"),
        (F.lit(0).cast("long") if tie is None else tie).alias("tie"),
    )
    # equal slices of the digest's range: bucket order is digest order
    slot = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32)).cast("long")
    placed = named.select("*", slot.alias("bucket"))
    sums = materialize(placed.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-sums")
    totals = _targets(sums.groupBy("source").agg(F.sum("size").alias("size")), weights, share_percent, max_epochs)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    offsets = materialize(
        offsets.join(totals, F.col("o_source").eqNullSafe(F.col("source"))).select("o_source", "o_bucket", "offset", F.col("size").alias("source_size"), "target", "i"), "mix-offsets"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("digest", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("inside"))
    joined = summed.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    middle = (2 * (F.col("offset") + F.col("inside")) + F.col("size")).cast("double") / F.lit(2.0)
    copies = F.when(F.col("source_size") > 0, F.greatest(F.lit(0), F.least(F.lit(max_epochs), F.ceil((F.col("target") - F.col("middle")) / F.col("source_size"))))).otherwise(0).cast("int")
    counted = joined.select("row", "size", "source_size", "target", "i", "tie", middle.alias("middle")).select("*", copies.alias("copies"))
    at = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda e: _invert(_schedule(F.col("i"), shapes), (F.col("middle") + e * F.col("source_size")) / F.col("target")),
    )
    return counted.select("row", "size", "source_size", "target", "copies", at.alias("times"), "tie")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """The training set in training order: each taken document, as often as it is taken, all columns
    as they were, range-sorted by training time (ties by id, then by a hash of the text)."""
    out = assign(docs, word_count(docs[text]), source=source, doc_id=doc_id, tie=F.xxhash64(docs[text].cast("string")), **how)
    each = out.select("row", F.explode("times").alias("time"), "tie")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return each.repartitionByRange(parts, "time", F.col("row")[doc_id], "tie").sortWithinPartitions("time", F.col("row")[doc_id], "tie").select("row.*")


def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = assign(docs, word_count(docs["text"]), carry=["doc_id"], tie=F.xxhash64(docs["text"]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = out.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.try_element_at("times", F.lit(1)).alias("time")
    )
    placed = listed.repartitionByRange(parts, "time", "doc_id").sortWithinPartitions("time", "doc_id")
    return placed.select("doc_id", "size", "source_size", "target", "taken", F.round("time", 6).alias("time"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source
), w AS (
  SELECT *, CAST(CASE i % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS BIGINT) AS w FROM s
), f AS (
  SELECT *, CAST(sum(size) OVER () AS BIGINT) AS total, CAST(sum(w) OVER () AS BIGINT) AS w_all,
         CAST(coalesce(sum(size) OVER (ORDER BY size / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS size_before,
         CAST(coalesce(sum(w) OVER (ORDER BY size / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS w_before
  FROM w
), g AS (
  SELECT *, w * (150 * total - 200 * size_before) > 200 * size * (w_all - w_before) AS stops FROM f
), h AS (
  SELECT *, CAST(coalesce(sum(size) FILTER (stops) OVER (), 0) AS BIGINT) AS s_stop, CAST(coalesce(sum(w) FILTER (stops) OVER (), 0) AS BIGINT) AS w_stop FROM g
), t AS (
  SELECT source, i, size AS source_size,
         CASE WHEN stops THEN CAST(2 * size AS DOUBLE)
              ELSE CAST(w * (150 * total - 200 * s_stop) AS DOUBLE) / CAST(100 * (w_all - w_stop) AS DOUBLE) END AS target
  FROM h
), m AS (
  SELECT doc_id, size, source,
         CAST(2 * coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size AS DOUBLE) / 2 AS middle
  FROM d
), c AS (
  SELECT doc_id, size, source_size, target, i % 3 AS kind, middle / nullif(target, 0) AS y,
         CASE WHEN source_size > 0 THEN greatest(0, least(2, ceil((target - middle) / source_size))) ELSE 0 END AS copies
  FROM m JOIN t ON m.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN round(greatest(0, least(1, CASE
         WHEN kind = 0 THEN 1.5 - sqrt(greatest(2.25 - 2 * y, 0))
         WHEN kind = 1 THEN y
         WHEN y < 0.375 THEN sqrt(0.25 + 2 * y) - 0.5
         ELSE sqrt(1 + 2 * (y - 0.375)) - 0.5 END)), 6) END AS time
FROM c
"""

QUERIES = {"op1_mixing": op1_mixing}
ORACLES = {"op1_mixing": ORACLE}
