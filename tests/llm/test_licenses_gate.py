"""No text that a rule matches is lost at the first search."""

import re

import pytest

from foliant.llm import licenses

SAMPLES = {
    "This code is released under the Apache 2.0 terms.": "apache-2.0",
    "Distributed under MIT.": "mit",
    "released under Apache-2.0": "apache-2.0",
    "All rights\nreserved": "all-rights-reserved",
    "in the public\ndomain": "public-domain",
    "CC_BY_SA 4.0": "cc-by-sa",
    "MPL2 0": "mpl-2.0",
    "bsd_3_clause": "bsd-3-clause",
    "CREATIVE\tCOMMONS -- attribution": "cc-by",
}


BODIES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software": "mit",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted": "bsd",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY': "as-is",
    "you may not use this file except in compliance with the License.": "apache-2.0",
    "All Rights Reserved.": "all-rights-reserved",
    "public-domain": "public-domain",
    "MPL2.0": "mpl-2.0",
    "CC/BY-SA 4.0": "cc-by-sa",
}
SAMPLES |= BODIES


def _words(pattern):
    """A text that the pattern matches: optional parts left out, the first of every choice."""
    pattern = re.sub(r"\(\?<= \)|\(\?= \)", "", pattern).replace("[^ ]+", "2020").replace("licen[sc]e", "license")
    while re.search(r"\((\?:)?[^()]*\)", pattern):
        pattern = re.sub(r"\(\?:[^()]*\)(\?|\{0,\d+\})", "", pattern, count=1) if re.search(r"\(\?:[^()]*\)(\?|\{0,\d+\})", pattern) else re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", pattern, count=1)
    return re.sub(r".\?", "", re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)).strip()


def test_samples_and_every_rule(spark):
    made = [(" ".join(_words(pattern).split()), label) for label, _, pattern, _, _ in licenses.rules()]
    assert all(re.search(pattern, f" {text} ") for (text, _), (_, _, pattern, _, _) in zip(made, licenses.rules()))
    texts = [(i, t) for i, t in enumerate(dict.fromkeys([*SAMPLES, *[sep.join(t.upper().split()) for t, _ in made for sep in (" ", "_", "\n", " - ")]]))]
    got = {r.text: r.found for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), carry=["text"]).select("row.text", licenses.labelled(licenses.F.col("found")).alias("found")).collect()}
    assert all(got[t] for _, t in texts), [t for _, t in texts if not got[t]][:5]
    assert {t: label in got[t] for t, label in SAMPLES.items()} == dict.fromkeys(SAMPLES, True)
