"""Edit-distance metrics and box geometry as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import RECOGNISED, SCRIPTS, tokens


def rate(errors: Column, denominator: Column) -> Column:
    """errors / denominator; without a denominator 1 if there are errors, else 0."""
    return F.when(denominator == 0, (errors != 0).cast("double")).otherwise(errors / denominator)


def cer(reference: Column, hypothesis: Column) -> Column:
    return rate(F.levenshtein(reference, hypothesis), F.length(reference))


def wer(reference: Column, hypothesis: Column) -> Column:
    """Word error rate: every distinct token of the pair becomes one code point, then edit distance."""
    return rate(word_distance(reference, hypothesis), F.size(tokens(reference)))


def word_distance(reference: Column, hypothesis: Column) -> Column:
    ref, hyp = tokens(reference), tokens(hypothesis)
    known = F.array_distinct(F.concat(ref, hyp))
    # U+10000 and up: no surrogates, no characters with a meaning to the comparison
    packed = lambda words: F.decode(
        F.unhex(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(F.array_position(known, w) + F.lit(0xFFFF)), 8, "0")), "")), "UTF-32"
    )
    return F.levenshtein(packed(ref), packed(hyp))


def script_cer(reference: Column, hypothesis: Column) -> Column:
    """Map from ISO 15924 code to the CER over that script's characters, for scripts in the reference."""
    pairs = []
    for code in RECOGNISED:
        only = lambda t: F.regexp_replace(t, rf"\P{{Is{SCRIPTS[code]}}}", "")  # noqa: E731,B023
        pairs.append(F.when(F.length(only(reference)) > 0, F.struct(F.lit(code).alias("key"), cer(only(reference), only(hypothesis)).alias("value"))))
    return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p.isNotNull()))


def distance(left: Column, right: Column) -> Column:
    """Edit distance; for equal lengths only the band within the number of differing places, which it cannot exceed."""
    places = F.zip_with(F.split(left, ""), F.split(right, ""), lambda x, y: ~x.eqNullSafe(y))
    differing = F.size(F.filter(places, lambda x: x))
    return F.when(F.length(left) == F.length(right), F.call_function("levenshtein", left, right, differing)).otherwise(F.levenshtein(left, right))


def disagreement(left: Column, right: Column) -> Column:
    return F.least(rate(distance(left, right), F.greatest(F.length(left), F.length(right))), F.lit(1.0))


def box(polygon: Column) -> Column:
    """Bounds of an array of (x, y) as (x1, y1, x2, y2); null for an empty polygon."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return F.when(
        F.size(polygon) > 0,
        F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")),
    )


def rounded_box(polygon: Column) -> Column:
    """Whole-pixel (x, y, w, h): origin rounded and not below 0, size rounded."""
    b = box(polygon)
    whole = lambda v: F.greatest(F.round(v), F.lit(0)).cast("int")
    return F.struct(whole(b["x1"]).alias("x"), whole(b["y1"]).alias("y"), whole(b["x2"] - b["x1"]).alias("w"), whole(b["y2"] - b["y1"]).alias("h"))


def padded_box(b: Column, padding: Column, width: Column, height: Column) -> Column:
    """Crop bounds: floor/ceil of a padded box, kept within the page; null when nothing is left."""
    x1 = F.greatest(F.floor(b["x1"]) - padding, F.lit(0))
    y1 = F.greatest(F.floor(b["y1"]) - padding, F.lit(0))
    x2, y2 = F.least(F.ceil(b["x2"]) + padding, width), F.least(F.ceil(b["y2"]) + padding, height)
    return F.when((x2 > x1) & (y2 > y1), F.struct(x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h")))


def _overlap(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), F.lit(0.0))
    h = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), F.lit(0.0))
    return w * h


def _area(a: Column) -> Column:
    return (a["x2"] - a["x1"]) * (a["y2"] - a["y1"])


def iou(a: Column, b: Column) -> Column:
    union = _area(a) + _area(b) - _overlap(a, b)
    return F.when(union > 1.1920929e-07, _overlap(a, b) / union).otherwise(0.0).cast("double")


def overlap_fraction(a: Column, b: Column) -> Column:
    """Overlap as a share of the smaller box."""
    least = F.least(_area(a), _area(b))
    return F.when(least > 1.1920929e-07, _overlap(a, b) / least).otherwise(0.0)


def shifted(polygon: Column, dx: Column, dy: Column) -> Column:
    return F.transform(polygon, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y")))


def middle_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2


def height(b: Column) -> Column:
    return b["y2"] - b["y1"]
