"""Quality rules as weak supervision (DataFrame functions only).

Every rule looks at a few counts of the whole text and votes good (+1), bad (-1) or abstains (0).
How often a rule is right is not known, so expectation-maximisation estimates it from how the rules
agree.  Bad texts are bad in different ways, and a rule that sees one fault says little about another;
hence a latent class for good texts and one for each kind of fault (``KINDS``), and for each class and
rule the probability that a vote is bad.  These probabilities are free between ``FLOOR`` and
1 - ``FLOOR``; an abstention says nothing.  The verdict is the posterior probability of the good class,
not "every rule must pass"; ``accuracies`` shows what share of each rule's votes the posterior holds right.

All that EM needs is how often each combination of votes occurs, and ``m`` rules have at most
``3**m`` of them, whatever the number of documents.  That bounded table is folded by one
``aggregate`` expression (no driver loop, no Python on rows) and joined back by the combination's
number.

Defined cases: null text has no words (all counts 0, rejected by the base rule); a corpus whose
documents all vote alike keeps close to the start values; extra columns of any name are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize, row_key, table, without_rows, without_space

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
EM_STEPS = 30
#: Kept when the posterior probability of good is at least this.
KEEP_AT = 0.5
#: Start values: share of good documents; probability that a vote names its class (bad for the rules
#: of a fault's kind, good otherwise).
GOOD, RIGHT = 0.8, 0.9
#: No probability is below this.
FLOOR = 1e-3
#: Kinds of fault and the rules that look for them.
KINDS = {
    "symbols": ("symbols",),
    "shouting": ("capitals", "exclamations"),
    "menu": ("bars",),
    "no sentences": ("sentence_ends",),
    "repetition": ("repeated_windows", "repeated_lines"),
    "odd words": ("word_length",),
}
#: While few values repeat, a linear look-up in them is cheaper than sorting pairs.
FEW_VALUES = 24


def counts(text: Column) -> dict[str, Column]:
    """The cheap counts, each one pass over the text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    return {
        "words": F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        "word_chars": F.char_length(without_space(t)).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(_without(t, "#*$%&|<>"))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_caps": F.regexp_count(t, F.lit("\\p{Lu}{3,}")).cast("long"),
        "n_bangs": F.regexp_count(t, F.lit("!!")).cast("long"),
        "n_bars": (F.char_length(t) - F.char_length(F.replace(t, F.lit("|"), F.lit("")))).cast("long"),
        "n_stops": F.regexp_count(t, F.lit("[.?!…](?=[\\s\"'”»)]|$)")).cast("long"),
    }


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def with_counts(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``row`` (the columns ``carry``) and ``q`` (a struct of counts); no shuffle.

    The repeated windows are found inside the row: hash every window, sort the hashes, keep values
    with an equal neighbour.  Where none repeats (most texts) that is all; a few repeated values are
    looked up in place; many (junk) are found by sorting (hash, position) pairs.
    """
    whole = docs.select(F.struct(*[docs[c].alias(c) for c in carry]).alias("row"), docs[text].cast("string").alias("text"))
    c = counts(F.col("text"))
    base = whole.select("row", *[v.alias(k) for k, v in c.items()])
    hashed = base.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.expr("CASE WHEN size(words) >= 3 THEN transform(slice(words, 1, size(words) - 2), (w, i) -> xxhash64(w, words[i + 1], words[i + 2])) ELSE cast(array() AS array<bigint>) END").alias("h"),
    )
    sorted_h = hashed.select("*", F.sort_array("h").alias("s"))
    twice = sorted_h.select("*", F.expr("array_distinct(filter(s, (x, i) -> x = get(s, i + 1)))").alias("twice"))
    starts = twice.select(
        "*",
        F.expr(f"""
          CASE WHEN size(twice) = 0 THEN cast(array() AS array<int>)
               WHEN size(twice) <= {FEW_VALUES} THEN
                 filter(transform(h, (x, i) -> CASE WHEN array_contains(twice, x) THEN i END), i -> i IS NOT NULL)
          END""").alias("plain_starts"),
        F.expr(f"CASE WHEN size(twice) > {FEW_VALUES} THEN array_sort(transform(h, (x, i) -> struct(x AS x, i AS i))) END").alias("pairs"),
    )
    return _finish(starts)


def _finish(starts: DataFrame) -> DataFrame:
    many = F.expr("sort_array(transform(filter(pairs, (e, k) -> e.x = get(pairs, k + 1).x OR (k > 0 AND e.x = get(pairs, k - 1).x)), e -> e.i))")
    at = starts.select("*", F.when(F.col("pairs").isNotNull(), many).otherwise(F.col("plain_starts")).alias("starts"))
    repeat = F.expr("aggregate(transform(starts, (p, k) -> least(3, coalesce(get(starts, k + 1) - p, 3))), 0L, (a, x) -> a + x)")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_caps", "n_bangs", "n_bars", "n_stops"]
    return at.select("row", F.struct(*[F.col(n) for n in names], repeat.alias("n_repeat_words")).alias("q"))


def votes(q: Column) -> list[tuple[str, Column]]:
    """The rules: +1 good, -1 bad, 0 no opinion."""
    n = F.greatest(q["n_words"], F.lit(1)).cast("double")
    rule = lambda good, bad: F.when(bad, -1).when(good, 1).otherwise(0)
    chars = q["word_chars"] / n
    symbols, repeat, dup = q["n_symbols"] / n, q["n_repeat_words"] / n, q["n_dup_lines"]
    caps, bangs, bars, stops = q["n_caps"] / n, q["n_bangs"] / n, q["n_bars"] / n, q["n_stops"] / n
    return [
        ("word_length", rule((chars >= 3.5) & (chars <= 8.0), (chars < 2.5) | (chars > 10.0))),
        ("symbols", rule(symbols < 0.01, symbols > 0.10)),
        ("capitals", rule(caps < 0.02, caps > 0.15)),
        ("exclamations", rule(bangs < 0.01, bangs > 0.10)),
        ("bars", rule(bars < 0.01, bars > 0.10)),
        ("sentence_ends", rule((stops >= 0.03) & (stops <= 0.25), (stops < 0.01) | (stops > 0.5))),
        ("repeated_windows", rule(repeat < 0.05, repeat > 0.30)),
        ("repeated_lines", rule(dup == 0, dup > 3)),
    ]


def start_values(rules: list[str], kinds: dict[str, tuple[str, ...]] = KINDS) -> list[list[float]]:
    """Probability of a bad vote by class (good, then each kind) and rule."""
    return [[1 - RIGHT] * len(rules)] + [[RIGHT if r in of else 1 - RIGHT for r in rules] for of in kinds.values()]


def _em(patterns: DataFrame, start: list[list[float]], steps: int) -> DataFrame:
    """``patterns(code, v array<int>, n)`` -> ``(code, v, n, classes)``, ``classes`` the posterior by class; at most 3**m rows in one row."""
    one = patterns.agg(F.array_sort(F.collect_list(F.struct("code", "v", F.col("n").cast("double").alias("n")))).alias("ps"))
    last, last_class = len(start[0]) - 1, len(start) - 1
    array = lambda xs: f"array({', '.join(xs)})"
    t0 = array([array([f"{x}D" for x in row]) for row in start])
    p0 = array([f"{GOOD}D"] + [f"{(1 - GOOD) / last_class}D"] * last_class)
    log = f"transform(p.prior, (r, c) -> aggregate(sequence(0, {last}), ln(r), (s, j) -> s + CASE x.v[j] WHEN -1 THEN ln(p.bad[c][j]) WHEN 1 THEN ln(1 - p.bad[c][j]) ELSE 0D END))"
    # transform over a one-element array binds a value to a name
    classes = f"transform(array({log}), l -> transform(l, y -> exp(y - array_max(l)) / aggregate(l, 0D, (s, u) -> s + exp(u - array_max(l)))))[0]"
    weighed = f"transform(ps, x -> struct(x.v AS v, x.n AS n, {classes} AS g))"
    total = lambda expr: f"aggregate(e, 0D, (s, x) -> s + {expr})"
    # one pseudo-vote at the start value keeps a rule that never votes defined
    seen, voted = total("CASE WHEN x.v[j] = -1 THEN x.n * x.g[c] ELSE 0D END"), total("CASE WHEN x.v[j] <> 0 THEN x.n * x.g[c] ELSE 0D END")
    bad = f"transform({t0}, (row, c) -> transform(row, (b, j) -> least(1 - {FLOOR}D, greatest({FLOOR}D, (b + {seen}) / (1D + {voted})))))"
    prior = f"transform(p.prior, (r, c) -> greatest({FLOOR}D, {total('x.n * x.g[c]')} / greatest(1D, {total('x.n')})))"
    step = f"transform(array({weighed}), e -> struct({prior} AS prior, {bad} AS bad))[0]"
    fitted = one.select("ps", F.expr(f"aggregate(sequence(1, {steps}), struct({p0} AS prior, {t0} AS bad), (p, i) -> {step})").alias("p"))
    return fitted.select(F.explode("ps").alias("x"), "p").select("x.code", "x.v", "x.n", F.expr(classes).alias("classes"))


def _fit(counted: DataFrame, em_steps: int) -> tuple[DataFrame, DataFrame]:
    """``counted`` with the number ``code`` of its votes, and EM's posterior by number."""
    ballots = votes(F.col("q"))
    m = len(ballots)
    code = sum(((v + 1) * (3**j) for j, (_, v) in enumerate(ballots)), F.lit(0))
    coded = counted.select("*", code.alias("code"))
    v = F.array(*[(F.pmod(F.floor(F.col("code") / F.lit(3**j)), F.lit(3)) - 1).cast("int") for j in range(m)])
    patterns = materialize(coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).select("code", v.alias("v"), "n"), "quality-votes")
    return coded, materialize(_em(patterns, start_values([name for name, _ in ballots]), em_steps), "quality-posterior")


def accuracies(docs: DataFrame, text: str = "text", *, em_steps: int = EM_STEPS) -> DataFrame:
    """``(rule, votes, accuracy)``: how many votes each rule cast and what share of them EM holds right."""
    counted = with_counts(docs, text, [])
    _, fitted = _fit(materialize(counted, "quality"), em_steps)
    names = F.array(*[F.lit(name) for name, _ in votes(F.col("q"))])
    each = fitted.select("n", F.get("classes", 0).alias("good"), F.posexplode("v").alias("j", "vote"), names.alias("names")).where("vote <> 0")
    right = F.when(F.col("vote") == 1, F.col("good")).otherwise(1 - F.col("good"))
    return each.groupBy(F.get("names", F.col("j")).alias("rule")).agg(F.sum("n").cast("long").alias("votes"), (F.sum(F.col("n") * right) / F.sum("n")).alias("accuracy"))


def judge(docs: DataFrame, text: str = "text", *, carry: list[str], em_steps: int = EM_STEPS, keep_at: float = KEEP_AT) -> DataFrame:
    """One row per input row: ``row`` (the columns ``carry``), ``q``, ``base_failed``, ``posterior``, ``kind``, ``kept``.

    The texts are read once for the counts, which are kept as a small table; EM and verdict never see
    a text again.  The only shuffle is the pre-aggregated count of vote combinations.
    """
    q = F.col("q")
    coded, fitted = _fit(materialize(with_counts(docs, text, carry), "quality"), em_steps)
    classes = F.col("classes")
    # the likelier kind; of equal ones the first
    kind = F.element_at(F.array(F.lit("good"), *[F.lit(k) for k in KINDS]), F.array_position(classes, F.array_max(classes)).cast("int"))
    posterior = fitted.select(F.col("code").alias("p_code"), F.get("classes", 0).alias("posterior"), kind.alias("kind"))
    failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    # at most 3**m short rows: a proven bound for the broadcast
    joined = coded.withColumn("base_failed", failed).join(F.broadcast(posterior), F.col("code") == F.col("p_code"), "left")
    kept = ~F.col("base_failed") & (F.col("posterior") >= keep_at)
    return joined.select("row", "q", "base_failed", "posterior", "kind", kept.alias("kept"))


def drop_low_quality(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    keyed = docs.select(*row_key(docs, doc_id, text), docs[text].alias("text"))
    gone = judge(keyed, carry=["key_id", "key_hash"]).where("not kept").select("row.*")
    return without_rows(docs, gone, doc_id, text)


def op5_quality_rules(spark, sf_dir):
    out = judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(F.col("row.doc_id").alias("doc_id"), *[F.col("q")[n].alias(n) for n in names], "base_failed", "kept", "posterior", "kind")


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES: dict[str, str] = {}
