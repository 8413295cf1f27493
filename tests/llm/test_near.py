"""Near-duplicates of the pipeline against brute-force Jaccard similarity."""

import random

from foliant.llm import simhash


def jaccard(x, y, k=5):
    of = lambda t: {tuple(t.lower().split()[i : i + k]) for i in range(max(1, len(t.split()) - k + 1))}
    return len(of(x) & of(y)) / len(of(x) | of(y))


def test_near_duplicates_against_brute_force(spark):
    """Copies with few and many words replaced, one crowd of them, unlike texts, a null and a null id."""
    rnd = random.Random(3)
    made = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]

    def changed(words, n):
        words = list(words)
        for i in rnd.sample(range(len(words)), n):
            words[i] = f"x{rnd.randrange(5000)}"
        return words

    texts = []
    for n in (1, 2, 3, 4, 6):
        for _ in range(6):
            base = made(160)
            texts += [base, changed(base, n)]
    base = made(160)
    texts += [changed(base, rnd.randrange(1, 5)) for _ in range(40)] + [made(120) for _ in range(10)]
    data = list(enumerate(" ".join(t) for t in texts)) + [(900, None), (None, "one two"), (901, "one two")]
    parent = {i: i for i in range(len(data))}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    order = lambda i: (data[i][0] is None, data[i][0] or 0)
    pairs = [(i, j) for i in range(len(data)) for j in range(i) if jaccard(data[i][1] or "", data[j][1] or "") >= 0.8]
    assert any(jaccard(data[i][1], data[j][1]) < 0.85 for i, j in pairs)
    for i, j in pairs:
        a, b = sorted((find(i), find(j)), key=order)
        parent[b] = a
    df = spark.createDataFrame(data, "doc_id long, text string")
    left = simhash.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {data[find(i)][0] for i in parent}
    assert simhash.drop_near_duplicates(df.where("false")).count() == 0
