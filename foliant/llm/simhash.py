"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into ``ceil((max_distance + 1) / 2)`` segments - fewer than a plain
pigeonhole cut would need - so that of two fingerprints within ``max_distance`` bits at least one
segment differs in at most *one* bit.  Each segment is indexed under all its variants with one bit
wild-carded; such a pair then meets under at least one equal key, and every meeting is verified with
``bit_count(a ^ b)``.

Only *distinct* fingerprints are indexed (copies of a text are one row by then).  Equal keys are met
by a window over the sorted keys that compares each fingerprint with its next few neighbours, so a
key never yields all pairs of its members.  If a pair under one key is further apart than that reach,
both its members see a neighbour at the reach's edge and are handed to an exact second way: every
fingerprint is listed under the 65 points within one bit of it.  Fingerprints that share a point are
within two bits by the triangle inequality, so they need no pairwise comparison at all: linking each
to the point's smallest is exact for the classes, a point has at most 65 such neighbours, and the
cost stays in proportion to the fingerprints however many share a key by chance.

Classes of linked fingerprints come from min-label propagation with pointer jumping, each round cut
by a table in the shared folder.

``drop_near_duplicates`` asks for a Jaccard similarity of five-word shingles, which lies beyond the
reach of a 64-bit SimHash: it adds the candidates of :mod:`minhash` to those of the fingerprints and
decides every pair by the shingle sets.

Defined cases: a null or word-free text has fingerprint zero and is linked like any other; fewer words
than a shingle make one shingle of the whole sequence; a null doc_id never becomes a component's id
unless all its ids are null; repeated rows stay one output row each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import minhash
from .common import SEED, components, materialize, row_key, table, without_rows, words_of

BITS = 64
#: Shingles hashed at a time, which bounds the bit matrix (64 bytes a shingle).
BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text: a bit is 1 if it is set in over half of its shingles' hashes."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for start in range(0, n, BLOCK):
        end = min(n, start + BLOCK)
        raw = b"".join([digest(" ".join(words[i : i + shingle]), SEED) for i in range(start, end)])
        set_bits += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """``carry`` columns and ``fp`` (the fingerprint's bits as a signed long)."""
    source = docs.select(docs[text].cast("string").alias("_fp_text"), F.struct(*[docs[c] for c in carry]).alias("_fp_row"))
    kind = source.schema["_fp_row"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(0)
            for at in range(0, batch.num_rows, 512):
                part = texts.slice(at, 512)
                fps = np.array([fingerprint(x.as_py(), shingle) for x in part], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, 512), pa.array(fps, pa.int64())], ["row", "fp"])

    return source.mapInArrow(run, f"row {kind}, fp bigint").select("row.*", "fp")


def _variants(fp: Column, segments: int) -> Column:
    """Array of (segment, wild-carded bit, remaining bits) packed in structs."""
    out = []
    width = -(-BITS // segments)
    for s in range(segments):
        low, high = s * width, min(BITS, (s + 1) * width)
        mask = (1 << high) - (1 << low)
        for bit in range(low, high):
            out.append(F.struct(F.lit(bit).cast("short").alias("wild"), fp.bitwiseAND(F.lit(_signed(mask & ~(1 << bit)))).alias("rest")))
    return F.array(*out)


def _signed(x: int) -> int:
    x &= (1 << BITS) - 1
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _ball(fp: Column, radius: int) -> Column:
    """Array of all points within ``radius`` (0, 1 or 2) bits of ``fp``."""
    masks = [0]
    if radius >= 1:
        masks += [1 << i for i in range(BITS)]
    if radius >= 2:
        masks += [(1 << i) | (1 << j) for i in range(BITS) for j in range(i)]
    return F.transform(F.array(*[F.lit(_signed(m)) for m in masks]), lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, max_distance: int = 2, reach: int = 4) -> DataFrame:
    """Edges ``(a, b)``, ``a < b``, among distinct ``fps(fp)``; their classes are exactly the classes
    of the relation "at most ``max_distance`` (1 or 2) differing bits"."""
    if not 1 <= max_distance <= 2:
        raise ValueError("max_distance must be 1 or 2")
    fp = F.col("fp")
    keyed = fps.select("fp", F.explode(_variants(fp, (max_distance + 2) // 2)).alias("k")).select("fp", "k.wild", "k.rest")
    w = Window.partitionBy("wild", "rest").orderBy("fp")
    near = F.filter(
        F.array(*[F.lag("fp", i).over(w) for i in range(1, reach + 1)]),
        lambda x: x.isNotNull() & (F.bit_count(x.bitwiseXOR(fp)) <= max_distance),
    )
    beyond = F.lag("fp", reach + 1).over(w).isNotNull() | F.lead("fp", reach + 1).over(w).isNotNull()
    seen = keyed.select("fp", near.alias("near"), beyond.alias("beyond")).where("size(near) > 0 OR beyond")
    met = materialize(
        seen.groupBy("fp").agg(F.flatten(F.collect_set("near")).alias("near"), F.max("beyond").alias("beyond")), "simhash-met"
    )
    direct = met.select(F.explode(F.array_distinct("near")).alias("a"), F.col("fp").alias("b"))
    crowd = met.where("beyond").select("fp")
    radius = 1
    points = crowd.select("fp", F.explode(_ball(fp, radius)).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z")
    # members of one point are within 2 * radius bits of each other: at most 65 distinct ones for radius 1
    star = points.join(least, "point").where("fp > a").select("a", F.col("fp").alias("b"))
    if max_distance == 1:
        star = star.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 1)
        star = star.unionByName(_ball_edges(crowd, 1))
    return direct.unionByName(star.distinct())


def _ball_edges(crowd: DataFrame, radius: int) -> DataFrame:
    """Fingerprints that lie in another's ball: every pair within ``radius`` bits, at most 64 per row."""
    points = crowd.select("fp", F.explode(_ball(F.col("fp"), radius)).alias("point")).where("fp <> point")
    return points.join(crowd.select(F.col("fp").alias("point")), "point").select(F.least("fp", "point").alias("a"), F.greatest("fp", "point").alias("b")).distinct()


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fp, component_id``."""
    fps = materialize(fingerprints(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), shingle=shingle), "simhash-fp")
    return _labelled(fps, max_distance)


def _labelled(fps: DataFrame, max_distance: int) -> DataFrame:
    heads = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")), "simhash-heads")
    tree = materialize(components(links(heads.select("fp"), max_distance)), "simhash-classes")
    linked = tree.join(heads, F.col("node") == F.col("fp")).select("node", "root", "head")
    least = linked.groupBy(F.col("root").alias("r")).agg(F.min("head").alias("component"))
    of_class = linked.join(least, F.col("root") == F.col("r")).select(F.col("node").alias("c_fp"), "component")
    # fingerprints of one document without links keep their own id and are not joined with anything large
    several = heads.where("n > 1").join(of_class.select("c_fp"), F.col("fp") == F.col("c_fp"), "left_anti").select(F.col("fp").alias("c_fp"), F.col("head").alias("component"))
    known = of_class.unionByName(several)
    return fps.join(known, F.col("fp") == F.col("c_fp"), "left").select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id"))


def _of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes, as a signed number."""
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].byteswap().view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big"))


def _signatures(rows: list[np.ndarray]) -> dict[str, pa.Array]:
    """Fingerprint and minima keys of each text, from the same hashes."""
    keys = [minhash.bands(np.unique(x)).view(np.int64) for x in rows]
    offsets = np.arange(0, len(rows) * minhash.BANDS + 1, minhash.BANDS, dtype=np.int32)
    return {"fp": pa.array([_of_hashes(x) for x in rows], pa.int64()), "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))}


def similar_groups(keyed: DataFrame, *, shingle: int = 5, similarity: float = 0.8, max_distance: int = 2) -> DataFrame:
    """``(node, root)`` for the nodes of ``keyed(node, text)`` that have a near-duplicate.

    Classes of the relation "the sets of word shingles have at least the Jaccard similarity".  Pairs come
    from the fingerprints within ``max_distance`` bits and, since texts just above the similarity differ in
    some ten of 64 bits, from minima of the shingle sets; each pair is decided by the sets.
    """
    signed = materialize(minhash.per_text(keyed, shingle, "fp bigint, bands array<bigint>", _signatures), "near-signatures")
    heads = materialize(signed.groupBy("fp").agg(F.min("node").alias("head"), F.max("node").alias("last")), "near-heads")
    of = lambda k, v: heads.select(F.col("fp").alias(k), F.col("head").alias(v))
    close = materialize(links(heads.select("fp"), max_distance), "near-fingerprints").select(F.col("a").alias("p"), F.col("b").alias("q"))
    met = close.join(of("p", "a"), "p").join(of("q", "b"), "q").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # texts of one fingerprint: each with the first; most fingerprints have one text and take no part
    same = signed.join(heads.where("head <> last"), "fp").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    also = materialize(met.unionByName(same), "near-pairs")
    return components(minhash.links(keyed, signed, also, similarity, shingle))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, shingle: int = 5, similarity: float = 0.8, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` less all but one of each near-duplicate group (the smallest id stays).

    Rows equal in id and text are one document here and stay or go together (an exact dedup runs first).
    """
    key_id, key_hash = row_key(docs, doc_id, text)
    # of one id's different texts the smaller hash goes first, so that exactly one row of a class is its head
    node = F.struct(key_id.isNull().alias("n"), key_id.alias("key_id"), key_hash.alias("key_hash"))
    keyed = docs.select(node.alias("node"), docs[text].cast("string").alias("text"))
    tree = similar_groups(keyed, shingle=shingle, similarity=similarity, max_distance=max_distance)
    return without_rows(docs, tree.where("node <> root").select("node.key_id", "node.key_hash"), doc_id, text)


def op8_simhash(spark, sf_dir):
    out = near_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash": op8_simhash}
ORACLES: dict[str, str] = {}
