"""License scans by ordered signature rules (DataFrame functions only).

Every text is brought to normal form (lower-case words, single spaces) and searched for the rules'
keywords, which are plain strings of that form; a text without any can hold no license wording and is
done.  Only rules whose keyword occurs are run: the wordings of license texts and notices (``BODIES``),
and license names (``FAMILIES``) in the forms in which a license is named (``FORMS``).  Every detection
is an interval of words with a priority, and a detection that lies inside another of equal or higher
priority is dropped ("apache license" inside "licensed under the apache license version 2 0").  Base
phrases keep their labels whatever happens to their detections.

All of it happens inside the row, without any shuffle.

Defined cases: null text counts as empty (no words, no labels, score 0); repeated rows stay; extra
columns of any name are ignored unless carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: label, keyword, name as a pattern over normal form.
FAMILIES = (
    ("mit", "mit", "mit(?: x11)?(?: licen[sc]e)?"),
    ("apache-2.0", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version)? 2(?: 0)?"),
    ("apache", "apache", "apache(?: software)? licen[sc]e"),
    ("gpl-3.0", "gpl", "gpl(?: version)?(?: v)? ?3(?: 0)?"),
    ("gpl-2.0", "gpl", "gpl(?: version)?(?: v)? ?2(?: 0)?"),
    ("gpl-3.0", "general public", "(?:gnu )?general public licen[sc]e(?: version)? v?3(?: 0)?"),
    ("gpl-2.0", "general public", "(?:gnu )?general public licen[sc]e(?: version)? v?2(?: 0)?"),
    ("gpl", "general public", "(?:gnu )?general public licen[sc]e"),
    ("lgpl", "lgpl", "lgpl(?: version)?(?: v)? ?(?:2 1|3 0|2|3)?"),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public licen[sc]e(?: version [23](?: [01])?)?"),
    ("agpl-3.0", "agpl", "agpl(?: version)?(?: v)? ?3?(?: 0)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[sc]e(?: version 3(?: 0)?)?"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?"),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[sc]e)?"),
    ("bsd", "bsd", "bsd licen[sc]e"),
    ("isc", "isc", "isc licen[sc]e"),
    ("mpl-2.0", "mpl", "mpl(?: version)? ?2(?: 0)?"),
    ("mpl-2.0", "mozilla", "mozilla public licen[sc]e(?: version)?(?: 2)?(?: 0)?"),
    ("epl-2.0", "eclipse", "eclipse public licen[sc]e(?: v)?(?: [12])?(?: 0)?"),
    ("cddl", "cddl", "cddl(?: 1 [01])?"),
    ("eupl", "eupl", "eupl(?: 1 [0-2])?"),
    ("artistic", "artistic", "artistic licen[sc]e(?: 2 0)?"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("boost", "boost", "boost software licen[sc]e(?: 1 0)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("cc0", "cc0", "cc0(?: 1 0)?"),
    ("cc-by", "cc by", "cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc by", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?"),
    ("public-domain", "public domain", "(?:the )?public domain"),
    ("all-rights-reserved", "rights reserved", "all rights reserved"),
    ("openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?"),
    ("odbl", "open database", "open database licen[sc]e"),
    ("ofl", "open font", "(?:sil )?open font licen[sc]e(?: 1 1)?"),
    ("python", "python", "python software foundation licen[sc]e"),
)
#: form over {name}, priority, confidence.
FORMS = (
    ("spdx licen[sc]e identifier {name}", 4, 1.0),
    ("licen[sc]ed under(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.95),
    ("(?:released|distributed|available|published|made available) under(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.95),
    ("subject to(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.9),
    ("permission is granted under(?: the)? {name}", 3, 0.9),
    ("copyright [^ ]+(?: [^ ]+){{0,6}} {name}", 2, 0.8),
    ("{name}", 1, 0.6),
)
#: label, keyword, wording, priority, confidence: sentences of the licenses themselves and of their notices.
BODIES = (
    ("mit", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software", 4, 1.0),
    ("mit", "to deal in", "to deal in the software without restriction", 3, 0.95),
    ("mit", "permission notice shall", "the above copyright notice and this permission notice shall be included in all copies", 4, 0.95),
    ("as-is", "provided as is", "(?:the|this) software is provided as is", 2, 0.7),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted", 3, 1.0),
    ("bsd-2-clause", "redistributions in binary form", "redistributions in binary form must reproduce the above copyright notice", 3, 0.9),
    ("bsd-3-clause", "endorse or promote", "neither the names? of [^ ]+(?: [^ ]+){0,14} may be used to endorse or promote products", 4, 1.0),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display", 4, 1.0),
    ("isc", "with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 4, 1.0),
    ("postgresql", "without fee", "permission to use copy modify and distribute this software and its documentation for any purpose without fee", 4, 1.0),
    ("apache-2.0", "compliance with the license", "you may not use this file except in compliance with the license", 4, 1.0),
    ("apache-2.0", "applicable law", "unless required by applicable law or agreed to in writing software distributed under the license", 4, 1.0),
    ("apache-2.0", "contributor license agreements", "licensed to the [^ ]+(?: [^ ]+){0,4} under one or more contributor license agreements", 4, 0.95),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it", 3, 0.95),
    ("gpl-2.0", "version 2 of the license", "either version 2 of the license or at your option any later version", 4, 0.9),
    ("gpl-3.0", "version 3 of the license", "either version 3 of the license or at your option any later version", 4, 0.9),
    ("gpl", "hope that it will be useful", "distributed in the hope that it will be useful but without any warranty", 3, 0.9),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify it", 4, 1.0),
    ("agpl-3.0", "interacting with it remotely", "all users interacting with it remotely through a computer network", 4, 0.95),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public licen[sc]e", 4, 1.0),
    ("mpl-1.1", "contents of this file", "the contents of this file are subject to the mozilla public licen[sc]e", 4, 0.95),
    ("cddl", "contents of this file", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e", 4, 1.0),
    ("epl-2.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e", 4, 1.0),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain", 4, 1.0),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", 4, 1.0),
    ("zlib", "express or implied warranty", "this software is provided as is without any express or implied warranty", 4, 0.95),
    ("boost", "free of charge", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 4, 1.0),
    ("cc0", "this deed", "the person who associated a work with this deed has dedicated the work to the public domain", 4, 1.0),
    ("cc-by", "creative commons", "this work is licensed under (?:a|the) creative commons attribution", 3, 0.9),
    ("ofl", "font software", "this font software is licensed under the sil open font licen[sc]e", 4, 1.0),
    ("artistic", "may be copied", "the conditions under which a package may be copied", 4, 1.0),
    ("python", "psf is making", "psf is making python available to licensee on an as is basis", 4, 1.0),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", 2, 0.8),
    ("proprietary", "strictly prohibited", "unauthorized copying of this file via any medium is strictly prohibited", 4, 1.0),
)
#: Families whose bare name is no license.
NOT_BARE = {"mit": "mit licen[sc]e"}


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, pattern, priority, confidence); patterns start and end at word edges."""
    out = list(BODIES)
    for label, keyword, name in FAMILIES:
        for form, priority, confidence in FORMS:
            said = NOT_BARE.get(label, name) if form == "{name}" else name
            out.append((label, keyword, form.format(name=said), priority, confidence))
    return [(label, keyword, f"(?<= ){pattern}(?= )", priority, confidence) for label, keyword, pattern, priority, confidence in out]


def keywords() -> list[str]:
    return sorted({r[1] for r in rules()} | {phrase for phrase, _ in BASE})


def _array(rows: list[tuple[str, str, str, int, float]]) -> Column:
    return F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("keyword"), F.lit(c).alias("pattern"), F.lit(d).alias("priority"), F.lit(e).alias("confidence")) for a, b, c, d, e in rows])


_SPAN = "struct<first:int,last:int,label:string,priority:int,confidence:double>"


def _places(pattern: str, label: str, priority: str, confidence: str) -> str:
    """Word intervals of a pattern's matches in ``n``: characters walked so far, then spaces counted.

    ``n`` starts with a space, so the word at a match is the number of spaces before it less one.
    """
    return f"""
      transform(array(struct(regexp_extract_all(n, {pattern}, 0) AS m)), f ->
        CASE WHEN size(f.m) = 0 THEN cast(array() AS array<{_SPAN}>) ELSE aggregate(
          sequence(0, size(f.m) - 1),
          named_struct('word', -1, 'gaps', split(n, {pattern}, -1), 'out', cast(array() AS array<{_SPAN}>)),
          (acc, k) -> transform(array(acc.word + length(acc.gaps[k]) - length(replace(acc.gaps[k], ' ', ''))), s -> named_struct(
             'word', s + length(f.m[k]) - length(replace(f.m[k], ' ', '')),
             'gaps', acc.gaps,
             'out', concat(acc.out, array(named_struct('first', s, 'last', s + length(f.m[k]) - length(replace(f.m[k], ' ', '')),
                                                       'label', {label}, 'priority', {priority}, 'confidence', cast({confidence} AS double))))))[0],
          acc -> acc.out) END)[0]"""


def scan(docs: DataFrame, text: str = "text", *, carry: list[str]) -> DataFrame:
    """One row per input row: ``row`` (columns ``carry``), ``n_words``, ``base`` (places of base
    phrases) and ``found`` (detections that stay), both arrays of word intervals with labels."""
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    read = docs.select(F.struct(*[docs[c].alias(c) for c in carry]).alias("row"), t.alias("text"))
    normal = read.select("row", F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.col("text")), NOT_WORD, " ")), F.lit(" ")).alias("n"))
    found = F.filter(F.array(*[F.lit(k) for k in keywords()]), lambda k: F.contains(F.col("n"), k))
    # no word: the two spaces alone
    count = F.when(F.col("n") == "  ", 0).otherwise(F.char_length("n") - F.char_length(F.replace("n", F.lit(" "), F.lit(""))) - 1).cast("long")
    searched = normal.select("row", "n", count.alias("n_words"), found.alias("keywords"))
    gated = searched.select("row", "n_words", "keywords", F.when(F.size("keywords") > 0, F.col("n")).alias("n"))
    none = f"cast(array() AS array<{_SPAN}>)"
    base = ", ".join(_places(f"'(?<= ){phrase}(?= )'", f"'{label}'", "5", "0.9") for phrase, label in BASE)
    based = gated.select("row", "n_words", "n", "keywords", F.expr(f"CASE WHEN n IS NULL THEN {none} ELSE concat({base}) END").alias("base"))
    ruled = based.select(
        "row", "n_words", "n", "base", F.when(F.col("n").isNotNull(), F.filter(_array(rules()), lambda r: F.array_contains(F.col("keywords"), r["keyword"]))).alias("rules")
    )
    # longest first at a start; then a detection lies in an earlier one if that one reaches as far
    raw = f"array_sort(flatten(transform(rules, r -> {_places('r.pattern', 'r.label', 'r.priority', 'r.confidence')})), (a, b) -> CASE WHEN a.first <> b.first THEN a.first - b.first WHEN a.last <> b.last THEN b.last - a.last WHEN a.priority <> b.priority THEN b.priority - a.priority WHEN a.label < b.label THEN -1 WHEN a.label > b.label THEN 1 ELSE 0 END)"
    detected = ruled.select("row", "n_words", "base", F.expr(f"CASE WHEN n IS NULL THEN {none} ELSE {raw} END").alias("raw"))
    # reach[p]: how far detections of priority above p have come
    keep = f"""
      aggregate(raw, named_struct('reach', array_repeat(-1, 5), 'out', {none}),
        (acc, d) -> CASE WHEN acc.reach[d.priority - 1] >= d.last THEN acc ELSE named_struct(
          'reach', transform(acc.reach, (x, p) -> CASE WHEN p < d.priority THEN greatest(x, d.last) ELSE x END),
          'out', concat(acc.out, array(d))) END,
        acc -> acc.out)"""
    return detected.select("row", "n_words", "base", F.expr(keep).alias("found"))


def labelled(spans: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"])))


def op9_licenses(spark, sf_dir):
    out = scan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    starts = F.transform("base", lambda s: s["first"])
    top = F.aggregate(F.concat("base", "found"), F.lit(0.0), lambda a, s: F.greatest(a, s["confidence"]))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(labelled(F.col("base")), ",").alias("base_labels"),
        F.array_join(labelled(F.concat("base", "found")), ",").alias("labels"),
        top.alias("score"),
    )


QUERIES = {"op9_licenses": op9_licenses}
ORACLES: dict[str, str] = {}
