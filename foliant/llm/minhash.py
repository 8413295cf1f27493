"""Links by the Jaccard similarity of word-shingle sets: minima as candidates, the sets as decision.

The search of near copies beyond a SimHash's reach, used by :func:`simhash.drop_near_duplicates`.

Every text gets ``BANDS`` keys, each over ``ROWS`` minima of independently seeded hashes of its shingle
set.  Texts that share a key are candidates; two of similarity s do so with probability
1 - (1 - s**ROWS)**BANDS (0.9993 at 0.8).  Every candidate pair is decided, by the sets themselves, or
lies in one class already:

* A key's *hub* is the member that shares most with others (the sum of its keys' sizes), in a crowd of
  copies usually their common original.  Each member is compared with its key's hub: as many pairs as
  members, found by pre-aggregated maxima, so no key is gathered anywhere.
* Where a key still holds several classes, its members outside the hub's class meet those of other
  classes.  The join itself holds them against an upper bound of the intersection and makes rows of
  the few pairs that may be similar enough.

The bound comes from bitmaps of the sets' hashes: |A & B| <= |A| less the bits of A that B lacks.

Defined cases: null or word-free texts have the set of one empty shingle; fewer words than a shingle make
one shingle of them all; rows equal in id and text are one node.
"""

from __future__ import annotations

import operator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEED, KeyFilter, components, materialize, words_of

ROWS, BANDS = 6, 24
#: 64-bit words of a set's bitmap.
WORDS = 16
#: Shingles hashed at a time, which bounds the matrix of minima.
BLOCK = 1 << 11
#: Texts handed to Arrow at a time.
BATCH = 256
_rng = np.random.default_rng(SEED)
_FACTOR = _rng.integers(1, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_TERM = _rng.integers(0, 1 << 63, ROWS * BANDS, np.uint64)


def hashes(text: str | None, shingle: int) -> np.ndarray:
    """64-bit hashes of a text's word shingles, repeats included."""
    words = words_of(text)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(" ".join(words[i : i + shingle]), SEED) for i in range(n)), np.uint64, n)


def bands(distinct: np.ndarray) -> np.ndarray:
    """The ``BANDS`` keys of a set of hashes."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(distinct), BLOCK):
        x = distinct[at : at + BLOCK, None] * _FACTOR + _TERM
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, x.min(0), out=least)
    raw = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(raw[k].tobytes(), k) for k in range(BANDS)], np.uint64)


def bitmap(distinct: np.ndarray) -> np.ndarray:
    bit = distinct % np.uint64(64 * WORDS)
    out = np.zeros(WORDS, np.uint64)
    np.bitwise_or.at(out, (bit // np.uint64(64)).astype(int), np.uint64(1) << bit % np.uint64(64))
    return out


def per_text(keyed: DataFrame, shingle: int, fields: str, make) -> DataFrame:
    """``node`` and the columns that ``make`` gives for the shingle hashes of ``text``: one row a text."""
    source = keyed.select("node", "text")
    node = source.schema["node"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                named = make([hashes(x.as_py(), shingle) for x in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), *named.values()], ["node", *named])

    return source.mapInArrow(run, f"node {node}, {fields}")


_SET_FIELDS = f"n int, bits struct<ones:int, {', '.join(f'w{k}:bigint' for k in range(WORDS))}>, hashes array<bigint>"


def _sets(rows: list[np.ndarray]) -> dict[str, pa.Array]:
    sets = [np.unique(x) for x in rows]
    sizes = np.array([len(s) for s in sets], np.int32)
    maps = np.array([bitmap(s) for s in sets], np.uint64).reshape(-1, WORDS)
    ones = np.bitwise_count(maps).sum(1, dtype=np.int32)
    flat = np.concatenate(sets).view(np.int64)
    return {
        "n": pa.array(sizes),
        "bits": pa.StructArray.from_arrays([pa.array(ones), *[pa.array(maps[:, k].view(np.int64)) for k in range(WORDS)]], ["ones", *[f"w{k}" for k in range(WORDS)]]),
        "hashes": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat)),
    }


def _needed(similarity: float, m: Column, n: Column) -> Column:
    """The least intersection of sets of ``m`` and ``n`` that makes their Jaccard similarity enough."""
    return F.ceil((m + n) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))


def _may_reach(needed: Column, m: Column, n: Column, x: Column, y: Column) -> Column:
    """Whether sets of ``m`` and ``n`` with bitmaps ``x`` and ``y`` may share as much as needed.

    Few terms, so that the generated method stays small enough to be compiled.
    """
    both = reduce(operator.add, [F.bit_count(x[f"w{k}"].bitwiseAND(y[f"w{k}"])) for k in range(WORDS)])
    return (F.least(m, n) >= needed) & (both >= needed + F.greatest(x["ones"] - m, y["ones"] - n))


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets have at least the similarity."""
    side = lambda k, *c: sets.select(F.col("node").alias(k), *[F.col(x).alias(f"{x}_{k}") for x in c])
    met = pairs.distinct().join(side("a", "n", "bits"), "a").join(side("b", "n", "bits"), "b")
    met = met.withColumn("needed", _needed(similarity, F.col("n_a"), F.col("n_b")))
    close = materialize(met.where(_may_reach(F.col("needed"), F.col("n_a"), F.col("n_b"), F.col("bits_a"), F.col("bits_b"))).select("a", "b", "needed"), "near-close")
    whole = close.join(side("a", "hashes"), "a").join(side("b", "hashes"), "b")
    return materialize(whole.where(F.size(F.array_intersect("hashes_a", "hashes_b")) >= F.col("needed")).select("a", "b"), "near-similar")


def _ordered(df: DataFrame, x: Column, y: Column) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a <> b")


def links(keyed: DataFrame, signed: DataFrame, also: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Edges ``(a, b)``, ``a < b``, whose classes are those of all candidates of enough similarity.

    ``keyed(node, text)``; ``signed(node, bands)`` of the same nodes; ``also(a, b)``: pairs to decide besides.
    """
    listed = signed.select("node", F.posexplode("bands").alias("band", "value"))
    slot = F.xxhash64("band", "value")
    keys = materialize(listed.groupBy("band", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "near-keys")
    again = KeyFilter(keys, slot).mark(listed, slot, "again").where("again").drop("again").join(keys, ["band", "value"])
    # at most BANDS keys a node, so this gathers no group
    of_node = again.groupBy("node").agg(F.sum("members").alias("shared"), F.collect_set(F.struct("band", "value")).alias("keys"))
    members = materialize(of_node.select("node", "shared", F.explode("keys").alias("key")).select("node", "shared", "key.band", "key.value"), "near-members")
    hubs = members.groupBy("band", "value").agg(F.max(F.struct("shared", "node")).alias("hub")).select("band", "value", "hub.node")
    hubs = materialize(hubs.withColumnRenamed("node", "hub"), "near-hubs")
    star = _ordered(members.join(hubs, ["band", "value"]), F.col("node"), F.col("hub"))
    nodes = materialize(members.select("node").unionByName(also.select(F.explode(F.array("a", "b")).alias("node"))).distinct(), "near-nodes")
    hashed = F.xxhash64("node")
    texts = KeyFilter(nodes, hashed).mark(keyed, hashed, "listed").where("listed")
    sets = materialize(per_text(texts, shingle, _SET_FIELDS, _sets).dropDuplicates(["node"]), "near-sets")
    first = similar(star.unionByName(also), sets, similarity)
    tree = components(first)
    crowd = members.join(tree, "node", "left").select("band", "value", "node", F.coalesce("root", "node").alias("root"))
    hub_root = hubs.join(tree.withColumnRenamed("node", "hub"), "hub", "left").select("band", "value", "hub", F.coalesce("root", "hub").alias("hub_root"))
    mixed = crowd.groupBy("band", "value").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("band", "value")
    crowd = crowd.join(hub_root.join(mixed, ["band", "value"]), ["band", "value"]).where("node <> hub")
    crowd = materialize(crowd.join(sets.select("node", "n", "bits"), "node").withColumn("outside", F.col("root") != F.col("hub_root")), "near-crowd")
    x, y = crowd.where("outside").alias("x"), crowd.alias("y")
    needed = _needed(similarity, F.col("x.n"), F.col("y.n"))
    across = (
        (F.col("x.band") == F.col("y.band")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.root") != F.col("y.root"))
        & (~F.col("y.outside") | (F.col("x.node") < F.col("y.node"))) & _may_reach(needed, F.col("x.n"), F.col("y.n"), F.col("x.bits"), F.col("y.bits"))
    )
    # the classes found so far stand as stars, so that the last search for classes starts from them
    stars = tree.select(F.col("root").alias("a"), F.col("node").alias("b")).where("a <> b")
    return stars.unionByName(similar(_ordered(x.join(y, across), F.col("x.node"), F.col("y.node")), sets, similarity))
