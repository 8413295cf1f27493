"""Stable identifiers, content hashes, splits and page specifications as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import code_point, trim_space


def component(value: Column) -> Column:
    """Trimmed, lower-cased, everything but letters, digits and ``-`` to ``_``, outer ``_`` cut."""
    return F.regexp_replace(F.regexp_replace(F.lower(trim_space(value)), "[^a-z0-9-]", "_"), "^_+|_+$", "")


def entry_id(edition: Column, page: Column, ordinal: Column) -> Column:
    return F.concat(component(edition), F.lit(":p"), component(page), F.format_string(":e%04d", ordinal))


def span_id(entry: Column, number: Column) -> Column:
    return F.concat(entry, F.format_string(":span:%04d", number))


def block_id(entry: Column, number: Column) -> Column:
    return F.concat(entry, F.format_string(":block:%04d", number))


def headword_id(first_span: Column) -> Column:
    return F.concat(F.regexp_replace(first_span, "(:span:0001)+$", ""), F.lit(":headword"))


def safe_name(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9_-]", "_")


def xml_id(value: Column) -> Column:
    """``g_`` and the value with every other character as ``_hex_``."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    return F.concat(
        F.lit("g_"),
        F.array_join(F.transform(chars, lambda c: F.when(c.rlike("^[A-Za-z0-9_.-]$"), c).otherwise(F.concat(F.lit("_"), F.lower(F.hex(code_point(c).cast("long"))), F.lit("_")))), ""),
    )


def _little_endian(value: Column, size: int) -> Column:
    big = F.lpad(F.hex(value.cast("long")), 2 * size, "0")
    return F.unhex(F.concat(*[F.substring(big, 2 * i + 1, 2) for i in reversed(range(size))]))


def content_hash(*parts: Column) -> Column:
    """SHA-256 over each part's byte length (8 bytes, little-endian) and bytes."""
    pieces = []
    for p in parts:
        raw = F.encode(p, "UTF-8")
        pieces += [_little_endian(F.octet_length(raw), 8), raw]
    return F.sha2(F.concat(*pieces), 256)


def is_sha256(value: Column) -> Column:
    return F.coalesce(value.rlike("^[0-9a-f]{64}$"), F.lit(False))


def page_split(edition: Column, page: Column) -> Column:
    """train / validation / test in proportion 7:2:1, fixed by edition and page."""
    digest = F.sha2(F.concat(F.encode(edition, "UTF-8"), _little_endian(page, 4)), 256)
    slot = F.conv(F.substring(digest, 1, 2), 16, 10).cast("int") % 10
    return F.when(slot <= 6, "train").when(slot <= 8, "validation").otherwise("test")


def page_key(label: Column) -> Column:
    """Sort key of a printed page: labels that are no number first, then numbers by value."""
    number = F.when(label.rlike("^[0-9]{1,10}$"), F.try_to_number(label, F.lit("9999999999")).cast("long"))
    return F.struct(number.isNotNull().cast("int").alias("numeric"), F.coalesce(number, F.lit(0)).alias("number"), F.when(number.isNull(), label).otherwise("").alias("label"))


def printed_page(page: Column, offset: Column, labels: Column) -> Column:
    """(label, front_matter): the mapped label, else page + offset, else ``front-0001`` style."""
    mapped = F.try_element_at(labels, page)
    number = page + offset
    return F.struct(
        F.coalesce(mapped, F.when(number > 0, number.cast("string")).otherwise(F.format_string("front-%04d", page))).alias("label"),
        (mapped.isNull() & (number <= 0)).alias("front_matter"),
    )


def page_spec(spec: Column) -> Column:
    """``1,3-5,9`` -> sorted distinct pages; an error on 0, a reversed range, an empty or other part."""
    bad = lambda part: F.raise_error(F.concat(F.lit("bad page range: "), part)).cast("array<int>")

    def pages(part: Column) -> Column:
        p = trim_space(part)
        lo = F.try_element_at(F.split(p, "-"), F.lit(1)).try_cast("int")
        hi = F.coalesce(F.try_element_at(F.split(p, "-"), F.lit(2)).try_cast("int"), lo)
        good = p.rlike(r"^\s*\d+\s*(-\s*\d+\s*)?$") & (lo >= 1) & (hi >= lo)
        return F.when(good, F.sequence(lo, hi)).otherwise(bad(part))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(spec, ","), pages))))

