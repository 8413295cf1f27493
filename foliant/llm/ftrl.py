"""Hashed n-gram logistic regression trained by FTRL-Proximal (McMahan et al. 2013).

``Features`` turn a text into a set of hashed indices: n-grams (and skip-grams) of its tokens and of
their shapes.  Training runs over a *bounded* sample of labelled rows (``TRAIN_ROWS``, chosen by a hash
of the id, so reruns agree); what reaches the driver is that sample's index arrays only.  Weights are
sparse (L1) and at most ``2**bits``, a proven bound for shipping them to the executors, which score
every whole text as a sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: Bound on the labelled rows that training uses.
TRAIN_ROWS = 6_000
#: Token hashes remembered per worker.
CACHED = 300_000
ROWS = 64


def _shape(token: str) -> str:
    if token.isalpha():
        return ("A" if token.isupper() else "Aa" if token[0].isupper() else "a") + str(min(len(token), 12) // 3)
    return "0" if token[0].isdigit() else token[:2]


@dataclass(frozen=True)
class Features:
    bits: int = 20
    #: n-grams up to this many tokens
    words: int = 2
    #: widths of gaps in skip-grams of two tokens
    skips: tuple[int, ...] = ()
    #: n-grams of token shapes up to this many tokens
    shapes: int = 0
    lower: bool = True

    def extractor(self) -> Callable[[str], np.ndarray]:
        known: dict[str, int] = {}
        shapes: dict[str, int] = {}

        def look(tokens: list[str], memory: dict[str, int], of: Callable[[str], str]) -> np.ndarray:
            if len(memory) > CACHED:
                memory.clear()
            for t in set(tokens):
                if t not in memory:
                    memory[t] = xxhash.xxh64_intdigest(of(t))
            return np.fromiter(map(memory.__getitem__, tokens), np.uint64, len(tokens))

        def grams(h: np.ndarray, n: int, skips: tuple[int, ...], salt: int) -> list[np.ndarray]:
            s = np.uint64(salt)
            out = [h * _A + s]
            if n >= 2:
                out.append((h[:-1] * _B + h[1:]) * _A + s)
            if n >= 3:
                out.append(((h[:-2] * _B + h[1:-1]) * _C + h[2:]) * _A + s)
            return out + [(h[: -k - 1] * _C + h[k + 1 :] * _B + np.uint64(k)) * _A + s for k in skips if len(h) > k + 1]

        def extract(text: str) -> np.ndarray:
            tokens = _TOKEN.findall(text)
            if not tokens:
                return np.zeros(0, np.int32)
            cased = [t.lower() for t in tokens] if self.lower else tokens
            with np.errstate(over="ignore"):
                parts = grams(look(cased, known, str), self.words, self.skips, 1)
                if self.shapes:
                    parts += grams(look(tokens, shapes, lambda t: "\0" + _shape(t)), self.shapes, (), 2)
                raw = np.concatenate(parts)
                raw ^= raw >> np.uint64(29)
                raw *= _B
            return np.unique(raw >> np.uint64(64 - self.bits)).astype(np.int32)

        return extract


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.15
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 4
    positive_weight: float = 1.0
    seed: int = 7

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, bits: int) -> tuple[np.ndarray, float]:
        """Weights (dense, mostly zero) and bias.  Each row is a set of present features."""
        n_bias = 1 << bits
        z, n = np.zeros(n_bias + 1), np.zeros(n_bias + 1)
        order = np.random.default_rng(self.seed)
        rows = [np.append(r, n_bias) for r in rows]
        for _ in range(self.epochs):
            for k in order.permutation(len(rows)):
                i = rows[k]
                w = self._weights(z[i], n[i])
                p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
                g = (p - labels[k]) * (self.positive_weight if labels[k] else 1.0)
                n_new = n[i] + g * g
                z[i] += g - (np.sqrt(n_new) - np.sqrt(n[i])) / self.alpha * w
                n[i] = n_new
        w = self._weights(z, n)
        return w[:-1].astype(np.float32), float(w[-1])

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Per-coordinate rates; L1 keeps a coordinate at zero until its evidence exceeds it."""
        free = np.abs(z) > self.l1
        return np.where(free, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)


@dataclass(frozen=True)
class Model:
    features: Features
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.features.bits, np.float32)
        w[self.index] = self.weight
        return w


def _map_texts(df: DataFrame, make: Callable[[], Callable[[str], object]], kind: str, to_arrow: Callable[[list], pa.Array]) -> DataFrame:
    """``(row, text)`` -> ``(row, out)`` in small Arrow batches."""
    row = df.schema["row"].dataType.simpleString()

    def run(batches):
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), to_arrow([f(x.as_py() or "") for x in part.column(1)])], ["row", "out"])

    return df.select("row", "text").mapInArrow(run, f"row {row}, out {kind}")


def train(docs: DataFrame, labels: DataFrame, label: str, features: Features, how: Ftrl, *, text: str = "text", doc_id: str = "doc_id", usable: Column | None = None, max_rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows, those with the least hash of their id.

    ``labels(doc_id, label)``; ids labelled more than once count once (the larger label), null
    labels and ids are skipped.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        ids = ids.where(usable)
    ids = ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    sample = materialize(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "train-ids").withColumnRenamed("doc_id", "l_id")
    # at most max_rows rows of an id and a label: a proven bound for the broadcast
    joined = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
    rows = joined.select(F.struct("doc_id", "y", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).alias("row"), "text")

    def to_arrow(values: list) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))

    indexed = _map_texts(rows, features.extractor, "array<int>", to_arrow)
    # ids that repeat among the documents must not lift the sample over its bound: one text each
    got = indexed.groupBy("row.doc_id").agg(F.min_by("row.y", "row.tie").alias("y"), F.min_by("out", "row.tie").alias("out")).orderBy(F.xxhash64("doc_id"), "doc_id").select("y", "out").toArrow()
    y = got.column("y").to_numpy().astype(np.float64)
    x = [v for chunk in got.column("out").chunks for v in np.split(chunk.values.to_numpy()[: chunk.offsets[-1].as_py()], chunk.offsets.to_numpy()[1:-1])] if len(y) else []
    w, bias = how.fit(x, y, features.bits)
    index = np.nonzero(w)[0].astype(np.int32)
    return Model(features, index, w[index], bias)


def score(docs: DataFrame, model: Model, *, text: str = "text", carry: list[str]) -> DataFrame:
    """``carry`` columns (in ``row``) and ``score`` in 0..1 for every row."""
    df = docs.select(F.struct(*[docs[c].alias(c) for c in carry]).alias("row"), docs[text].cast("string").alias("text"))

    def make():
        extract, w, bias = model.features.extractor(), model.dense(), model.bias
        return lambda t: 1.0 / (1.0 + float(np.exp(-np.clip(float(w[extract(t)].sum(dtype=np.float64)) + bias, -35, 35))))

    return _map_texts(df, make, "double", lambda v: pa.array(v, pa.float64())).withColumnRenamed("out", "score")


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
