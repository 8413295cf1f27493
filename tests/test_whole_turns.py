"""Queries over turns against a brute-force edit distance, with and without other alphabets."""

from foliant import queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_every_pair_of_turns_is_scored(spark, tmp_path):
    """Accented, Greek and Hebrew turns, one beyond the basic plane, an empty one, and ASCII."""
    talks = {1: ["plain words", "plain wards", "plain"], 2: ["café déjà", "cafe deja"], 3: ["αβγδ", "αβγε", "אבגד"], 4: ["a😀b", "ab"], 5: ["", "é", ""]}
    rows = [(c, t, text) for c, texts in talks.items() for t, text in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    pairs = [(c, t, texts[t - 1], texts[t]) for c, texts in talks.items() for t in range(1, len(texts))]
    want = {(c, t): round(distance(a, b) / len(a) if a else float(b != ""), 9) for c, t, a, b in pairs}
    assert {(r.conv_id, r.turn): r.cer for r in queries.queries()["cer"](spark, str(tmp_path)).collect()} == want
    worst = {c: max(min(distance(a, b) / max(len(a), len(b), 1), 1) for k, _, a, b in pairs if k == c) for c in talks}
    got = {r.conv_id: r.disagreement for r in queries.queries()["disagreement_queue"](spark, str(tmp_path)).collect()}
    assert got == {c: round(v, 9) for c, v in worst.items() if v > 0.15}
