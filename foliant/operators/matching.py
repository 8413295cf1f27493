"""One-to-one matching and order-dependent merging inside a page.

Candidates come from an equality join on the page with the geometry as a residual condition, so
work is per page, never a cross product of the corpus.  The order-dependent part is a fold over one
page's sorted candidates (``aggregate``), a bounded array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as mx
from ..functions import text as tx

ALIGN_IOU = 0.15
SAME_IOU = 0.80
NEAREST = 1.5
WORD_OVERLAP = 0.35
KEEP_ENGLISH, KEEP_SURE, BETTER_BY = 0.70, 0.86, 0.05


def spatial_candidates(left: DataFrame, right: DataFrame, keys: Sequence[str], at_least: float = ALIGN_IOU) -> DataFrame:
    """Pairs of boxes on the same page with IoU of ``at_least``: ``keys, l, r, iou``.

    Both sides have ``keys``, an ordinal ``i`` and a ``box``."""
    a = left.select(*keys, F.col("i").alias("l"), F.col("box").alias("l_box"))
    b = right.select(*keys, F.col("i").alias("r"), F.col("box").alias("r_box"))
    return a.join(b, list(keys)).select(*keys, "l", "r", mx.iou(F.col("l_box"), F.col("r_box")).alias("iou")).where(F.col("iou") >= at_least)


def greedy(candidates: DataFrame, keys: Sequence[str], cost: Column) -> DataFrame:
    """Accept candidates by rising ``cost`` (ties: left, then right ordinal) while both sides are free."""
    order = F.array_sort(F.collect_list(F.struct(cost.alias("cost"), "l", "r")))
    none = "cast(array() AS array<struct<l:bigint,r:bigint>>)"
    fold = f"""
      aggregate(c, {none}, (acc, x) -> CASE
        WHEN exists(acc, p -> p.l = x.l OR p.r = x.r) THEN acc
        ELSE concat(acc, array(named_struct('l', cast(x.l AS bigint), 'r', cast(x.r AS bigint)))) END)"""
    grouped = candidates.groupBy(*keys).agg(order.alias("c"))
    return grouped.select(*keys, F.explode(F.expr(fold)).alias("p")).select(*keys, "p.l", "p.r")


def align(canonical: DataFrame, hypothesis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Greedy one-to-one alignment by falling IoU; unmatched canonical lines keep a null ``r``."""
    pairs = greedy(spatial_candidates(canonical, hypothesis, keys), keys, -F.col("iou"))
    return canonical.select(*keys, F.col("i").alias("l")).join(pairs, [*keys, "l"], "left")


def nearest_unused(source: DataFrame, candidate: DataFrame, keys: Sequence[str], tolerance: float = NEAREST) -> DataFrame:
    """In source order, each line takes the nearest free candidate by vertical middle within
    ``tolerance`` times the larger height; of equally near ones the first."""
    a = source.select(*keys, F.col("i").alias("l"), F.col("box").alias("l_box"))
    b = candidate.select(*keys, F.col("i").alias("r"), F.col("box").alias("r_box"))
    distance = F.abs(mx.middle_y(F.col("l_box")) - mx.middle_y(F.col("r_box")))
    reach = F.greatest(mx.height(F.col("l_box")), mx.height(F.col("r_box"))) * tolerance
    near = a.join(b, list(keys)).where(distance <= reach).select(*keys, "l", "r", distance.alias("distance"))
    per_line = near.groupBy(*keys, "l").agg(F.array_sort(F.collect_list(F.struct("distance", "r"))).alias("options"))
    none = "cast(array() AS array<struct<l:bigint,r:bigint>>)"
    fold = f"""
      aggregate(c, {none}, (acc, x) -> transform(array(filter(x.options, o -> NOT exists(acc, p -> p.r = o.r))), free ->
        CASE WHEN size(free) = 0 THEN acc ELSE concat(acc, array(named_struct('l', cast(x.l AS bigint), 'r', cast(free[0].r AS bigint)))) END)[0])"""
    grouped = per_line.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("l", "options"))).alias("c"))
    return grouped.select(*keys, F.explode(F.expr(fold)).alias("p")).select(*keys, "p.l", "p.r")


def dedupe_overlapping(items: DataFrame, keys: Sequence[str], at_least: float = SAME_IOU) -> DataFrame:
    """Keep the first of overlapping boxes; a later, surer one takes the earlier one's place.

    ``items`` has ``keys, i, box, confidence``; returns ``keys, place, i`` of what is kept.  The rule
    is not transitive, hence a fold in order over one page.
    """
    one = "struct<x1:double,y1:double,x2:double,y2:double>"
    order = F.array_sort(F.collect_list(F.struct(F.col("i").cast("long").alias("i"), F.col("box").cast(one).alias("box"), F.col("confidence").cast("double").alias("confidence"))))
    kind = f"array<struct<i:bigint,box:{one},confidence:double>>"
    overlap = "(greatest(least(e.box.x2, x.box.x2) - greatest(e.box.x1, x.box.x1), 0D) * greatest(least(e.box.y2, x.box.y2) - greatest(e.box.y1, x.box.y1), 0D))"
    area = "(({0}.box.x2 - {0}.box.x1) * ({0}.box.y2 - {0}.box.y1))"
    union = f"({area.format('e')} + {area.format('x')} - {overlap})"
    same = f"({union} > 1.1920929E-7D AND {overlap} / nullif({union}, 0D) >= {at_least}D)"
    fold = f"""
      aggregate(c, cast(array() AS {kind}), (acc, x) ->
        transform(array(array_position(transform(acc, e -> coalesce({same}, false)), true)), at -> CASE
          WHEN at = 0 THEN concat(acc, array(x))
          ELSE transform(acc, (e, k) -> CASE WHEN k + 1 = at AND x.confidence > e.confidence THEN x ELSE e END) END)[0])"""
    grouped = items.groupBy(*keys).agg(order.alias("c"))
    return grouped.select(*keys, F.posexplode(F.expr(fold)).alias("place", "e")).select(*keys, "place", "e.i")


def interval_semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left(lo, hi)`` that overlap some interval of ``right`` with the same keys."""
    r = right.select(*[F.col(k).alias("r_" + k) for k in keys], F.col("lo").alias("r_lo"), F.col("hi").alias("r_hi"))
    same = [F.col(k) == F.col("r_" + k) for k in keys]
    return left.join(r, [*same, F.col("lo") < F.col("r_hi"), F.col("r_lo") < F.col("hi")], "left_semi")


# ---- word fusion ----------------------------------------------------------------------------------


def _word_box(w: Column) -> Column:
    return F.struct(w["x"].alias("x1"), w["y"].alias("y1"), (w["x"] + w["w"]).alias("x2"), (w["y"] + w["h"]).alias("y2"))


def _run_box(words: Column) -> Column:
    get = lambda f: F.transform(words, f)
    return F.struct(
        F.array_min(get(lambda w: w["x"])).alias("x1"), F.array_min(get(lambda w: w["y"])).alias("y1"),
        F.array_max(get(lambda w: w["x"] + w["w"])).alias("x2"), F.array_max(get(lambda w: w["y"] + w["h"])).alias("y2"),
    )


def foreign_runs(words: Column) -> Column:
    """Array of (first, last) word indices of foreign runs; punctuation bridges, letters break."""
    n = F.size(words)
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    foreign = F.filter(at, lambda i: tx.contains_foreign(F.get(words, i)["text"]))
    breaks = F.filter(at, lambda i: ~tx.contains_foreign(F.get(words, i)["text"]) & F.get(words, i)["text"].rlike(tx.ALPHA))
    between = lambda a, b: F.exists(breaks, lambda k: (k > a) & (k < b))
    firsts = F.filter(foreign, lambda x, k: (k == 0) | between(F.get(foreign, k - 1), x))
    lasts = F.filter(foreign, lambda x, k: (k == F.size(foreign) - 1) | between(x, F.get(foreign, k + 1)))
    return F.arrays_zip(firsts.alias("first"), lasts.alias("last"))


def _grammar_at(words: Column, at: Column) -> Column:
    """The label test for the word at ``at`` (without the candidate test)."""
    following = F.transform(F.slice(words, at + 2, 3), lambda w: F.coalesce(tx.normalized_word(w["text"]), F.lit("")))
    word = F.get(words, at)["text"]
    in_hebrew = (tx.begins_with_hebrew(word) | ~word.rlike("[a-z]")) & (F.get(following, 0) == "in") & F.get(following, 1).isin("heb", "hebr")
    return F.exists(following, lambda w: w.isin(*tx.GRAMMAR_LABELS)) | F.coalesce(in_hebrew, F.lit(False))


def replacements(primary: Column, secondary: Column) -> Column:
    """Accepted (p_first, p_last, s_first, s_last), first come first served among overlapping ones."""

    def judge(run: Column) -> Column:
        words = F.slice(secondary, run["first"] + 1, run["last"] - run["first"] + 1)
        hit = F.filter(F.sequence(F.lit(0), F.size(primary) - 1), lambda i: mx.overlap_fraction(_word_box(F.get(primary, i)), _run_box(words)) >= WORD_OVERLAP)
        first, last = F.array_min(hit), F.array_max(hit)
        own = F.slice(primary, first + 1, last - first + 1)
        p_conf, s_conf = tx.weighted_confidence(own), tx.weighted_confidence(words)
        headword = (run["first"] == run["last"]) & _grammar_at(secondary, run["first"])
        english = (p_conf >= KEEP_ENGLISH) & F.forall(own, lambda w: tx.plausible_english(w["text"]))
        sure = (p_conf >= KEEP_SURE) & (s_conf < p_conf + BETTER_BY)
        return F.struct(
            first.alias("p_first"), last.alias("p_last"), run["first"].alias("s_first"), run["last"].alias("s_last"),
            F.when(F.size(hit) == 0, False).otherwise(headword | ~(english | sure)).alias("good"),
        )

    kind = "array<struct<p_first:int,p_last:int,s_first:int,s_last:int,good:boolean>>"
    judged = F.transform(foreign_runs(secondary), judge)
    return F.aggregate(
        judged.cast(kind),
        F.array().cast(kind),
        lambda acc, r: F.when(r["good"] & ~F.exists(acc, lambda a: (r["p_first"] <= a["p_last"]) & (r["p_last"] >= a["p_first"])), F.concat(acc, F.array(r))).otherwise(acc),
    )


def fuse_words(lines: DataFrame) -> DataFrame:
    """``lines`` with ``secondary_words`` (null where not aligned): foreign runs of the secondary reading
    replace what they cover; text, confidence and word ids of changed lines follow."""
    usable = F.col("secondary_words").isNotNull() & (F.size("secondary_words") > 0) & (F.size("words") > 0)
    swaps = lines.withColumn("swaps", F.when(usable, replacements(F.col("words"), F.col("secondary_words"))))
    kind = lines.schema["words"].dataType.elementType.simpleString()
    n = F.size("words")
    # at each primary position: the replacement that starts there, nothing inside one, else the word
    at = F.sequence(F.lit(0), n - 1)

    def here(i: Column) -> Column:
        own = F.filter("swaps", lambda s: (i >= s["p_first"]) & (i <= s["p_last"]))
        s = F.get(own, 0)
        return (
            F.when(F.size(own) == 0, F.slice("words", i + 1, 1))
            .when(i == s["p_first"], F.slice("secondary_words", s["s_first"] + 1, s["s_last"] - s["s_first"] + 1))
            .otherwise(F.array().cast(f"array<{kind}>"))
        )

    changed = F.coalesce(F.size("swaps"), F.lit(0)) > 0
    fused = F.flatten(F.transform(at, here))
    named = F.transform(fused, lambda w, k: w.withField("id", F.concat(F.col("line_id"), F.format_string("-fused-word-%04d", k + 1))))
    out = swaps.withColumn("fused", F.when(changed, named))
    return out.withColumns(
        {
            "words": F.coalesce("fused", "words"),
            "text": F.when(changed, F.array_join(F.transform("fused", lambda w: w["text"]), " ")).otherwise(F.col("text")),
            "confidence": F.when(changed, tx.weighted_confidence(F.col("fused"))).otherwise(F.col("confidence")).cast("float"),
        }
    ).drop("swaps", "fused")
