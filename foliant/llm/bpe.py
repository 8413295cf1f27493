"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split by the tokenizer's pattern and each match is merged on its own.  The bytes of all the
matches that a block of rows shows for the first time stand in one linked list, cut between matches.
Every adjacent pair that makes a vocabulary entry waits in the bucket of its rank; a bitmap over
ranks, with a bitmap over its words, says which buckets hold anything, so find-first-set gives the
next rank in two steps, and the bucket is worked off from left to right.  Merging changes two pairs;
their old entries stay and are skipped as stale when they come up.  If a merge forms a pair of lesser
rank, the rest of the bucket waits again.  The cost is that of the pairs ever formed, without a scan
or a sort of the match, which suits very long ones (a run of a million letters).

Matches repeat, so short ones are remembered in a dictionary of bounded size.

The vocabulary is a public rank file whose path is a parameter; the driver reads it and the ranks
travel in the closure (about 1 MB, fixed by the file).

Defined cases: null text counts as empty and gives an empty array; other columns are carried by
name, and if one of them is called ``token_ids`` (or ``decoded``) they stay in a struct ``r`` beside
the result; repeated rows stay; special tokens are never recognised in a text.
"""

from __future__ import annotations

import base64
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache
from sys import byteorder

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Matches longer than this are not remembered; so many are remembered at most.
CACHED_CHARS = 48
CACHED = 100_000
#: Rows and characters of a block, a bound on what one worker holds besides one text.
ROWS, CHARS = 256, 1 << 19
#: Ranks per bitmap word, as a power of two.
_SHIFT = 8
_MASK = (1 << _SHIFT) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankQueue:
    """Positions by rank.  ``pop`` gives the least rank and its positions from left to right, ``None`` when empty.

    Two levels: ``words`` holds a bit per rank, ``top`` a bit per non-empty word.  An empty queue can be
    used again, so a codec keeps one.
    """

    __slots__ = ("buckets", "words", "top")

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * ((n_ranks >> _SHIFT) + 1)
        self.top = 0

    def put(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        k = rank >> _SHIFT
        self.words[k] |= 1 << (rank & _MASK)
        self.top |= 1 << k

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.put(rank, [position])
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]] | None:
        top = self.top
        if not top:
            return None
        k = (top & -top).bit_length() - 1
        word = self.words[k]
        first = word & -word
        self.words[k] = word = word ^ first
        if not word:
            self.top = top & (top - 1)
        rank = (k << _SHIFT) + first.bit_length() - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Vocabulary:
    """Ranks of byte strings, and the rank that two adjacent tokens make together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.parts = [b""] * self.size
        for part, rank in ranks.items():
            self.parts[rank] = part
        self.byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.pairs: dict[int, int] = {}
        find = ranks.get
        for part, rank in ranks.items():
            for k in range(1, len(part)):
                a, b = find(part[:k]), find(part[k:])
                if a is not None and b is not None:
                    self.pairs[a * self.size + b] = rank
        #: rank of two bytes, -1 for none
        self.two = np.array([[ranks.get(bytes([i, j]), -1) for j in range(256)] for i in range(256)], np.int32)
        self.queue = RankQueue(self.size)


def merge_all(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Token ids of each match, packed as 32-bit numbers: always merge its pair of least rank, leftmost first."""
    size, find, queue = vocabulary.size, vocabulary.pairs.get, vocabulary.queue
    buckets, put, pop = queue.buckets, queue.put, queue.pop
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    token = vocabulary.byte[data].tolist()
    following, preceding = np.arange(1, n + 1), np.arange(-1, n - 1)
    inner = ends[(ends > 0) & (ends < n)]
    following[inner - 1] = n
    preceding[inner] = -1
    after = following.tolist()  # the part that follows in the same match; n: none
    before = preceding.tolist()  # the one in front; -1: none
    pairs = np.full(n + 1, -1, np.int32)
    if n > 1:
        pairs[: n - 1] = vocabulary.two[data[:-1], data[1:]]
        pairs[inner - 1] = -1
    waits = pairs.tolist()  # rank of the pair that starts at i
    order = np.argsort(pairs, kind="stable")
    order = order[np.searchsorted(pairs[order], 0) :]
    starts = np.flatnonzero(np.diff(pairs[order], prepend=-1)).tolist()
    for low, high in zip(starts, [*starts[1:], len(order)]):
        put(int(pairs[order[low]]), order[low:high].tolist())
    while (first := pop()) is not None:
        rank, positions = first
        base = rank * size
        for k, i in enumerate(positions):
            if waits[i] != rank:
                continue  # stale: one of the pair's parts has been merged since
            j = after[i]
            token[i] = rank
            token[j] = waits[j] = -1
            stop = after[i] = after[j]
            less = False
            if stop < n:
                before[stop] = i
                r = find(base + token[stop])
                if r is None:
                    waits[i] = -1
                else:
                    waits[i] = r
                    if r in buckets:
                        buckets[r].append(i)
                    else:
                        put(r, [i])
                        less = r < rank
            else:
                waits[i] = -1
            h = before[i]
            if h >= 0:
                r = find(token[h] * size + rank)
                if r is None:
                    waits[h] = -1
                else:
                    waits[h] = r
                    if r in buckets:
                        buckets[r].append(h)
                    else:
                        put(r, [h])
                        less = less or r < rank
            if less:
                if rest := positions[k + 1 :]:
                    put(rank, rest)
                break
    merged = np.array(token, np.int32)
    stays = merged >= 0
    packed = merged[stays].tobytes()
    cuts = (4 * np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], ends])]).tolist()
    return [packed[x:y] for x, y in zip(cuts, cuts[1:])]


class Codec:
    """Encodes and decodes whole texts; remembers short matches in two generations of bounded size."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.parts = pa.array(self.vocabulary.parts, pa.binary())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, matches: set[str]) -> dict[str, bytes]:
        """Packed ids of matches that are not known: from the older generation, the vocabulary or merged."""
        older, whole = self.older, self.vocabulary.ranks.get
        fresh = {m: older[m] for m in matches if m in older}
        unseen, pieces = [], []
        for m in matches.difference(fresh):
            piece = m.encode("utf-8")
            rank = whole(piece)
            if rank is None:
                unseen.append(m)
                pieces.append(piece)
            else:
                fresh[m] = rank.to_bytes(4, byteorder)
        fresh.update(zip(unseen, merge_all(pieces, self.vocabulary)))
        return fresh

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text.  What one block of texts is the first to show is merged in one go."""
        if len(self.known) >= CACHED:
            self.older, self.known = self.known, {}
        known, split_texts = self.known, list(map(self.split, texts))
        unknown = set().union(*split_texts)
        unknown.difference_update(known)
        fresh = self._learn(unknown)
        known.update((m, ids) for m, ids in fresh.items() if len(m) <= CACHED_CHARS)
        get = (known if fresh.keys() <= known.keys() else ChainMap(known, fresh)).__getitem__
        return [np.frombuffer(b"".join(map(get, matches)), np.int32) for matches in split_texts]

    def decode(self, lists: pa.Array) -> pa.Array:
        """The bytes of each list of ids; a null list gives no bytes."""
        flat = lists.flatten()
        lengths = pc.fill_null(pc.list_value_length(lists), 0)
        offsets = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.parts.take(flat)), b"")


@lru_cache(maxsize=2)
def _codec(items: bytes, pattern: str) -> Codec:
    """One codec a worker process and vocabulary, kept over its tasks."""
    return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, items.splitlines())}, pattern)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of blocks of at most ``ROWS`` rows and ``CHARS`` bytes, one row at least."""
    at, rows, held = 0, 0, 0
    for size in pc.fill_null(pc.binary_length(texts), 0).to_pylist():
        if rows and (rows == ROWS or held + size > CHARS):
            yield at, rows
            at, rows, held = at + rows, 0, 0
        rows, held = rows + 1, held + size
    if rows:
        yield at, rows


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default all) and ``token_ids`` (array of int) of every whole text."""
    with open(vocabulary, "rb") as f:
        items = f.read()
    row = F.struct(*[docs[c] for c in (docs.columns if carry is None else carry)])
    source = docs.select(docs[text].cast("string").alias("_text"), row.alias("_row"))
    kind = source.schema["_row"].dataType.simpleString()

    def run(batches):
        codec = _codec(items, pattern)
        for batch in batches:
            for at, n in _blocks(batch.column(0)):
                ids = codec.encode([x or "" for x in batch.column(0).slice(at, n).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, n), _lists(ids)], ["r", "ids"])

    out = source.mapInArrow(run, f"r {kind}, ids array<int>")
    clash = "token_ids" in [f.name for f in source.schema["_row"].dataType.fields]
    return out.select("r", F.col("ids").alias("token_ids")) if clash else out.select("r.*", F.col("ids").alias("token_ids"))


def decode(tokens: DataFrame, vocabulary: str, *, ids: str = "token_ids", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default all) and ``decoded`` (binary): the bytes the ids stand for."""
    with open(vocabulary, "rb") as f:
        items = f.read()
    source = tokens.select(tokens[ids].alias("_ids"), F.struct(*[tokens[c] for c in (tokens.columns if carry is None else carry)]).alias("_row"))
    kind = source.schema["_row"].dataType.simpleString()

    def run(batches):
        codec = _codec(items, "")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, ROWS), codec.decode(batch.column(0).slice(at, ROWS))], ["r", "decoded"])

    out = source.mapInArrow(run, f"r {kind}, decoded binary")
    clash = "decoded" in [f.name for f in source.schema["_row"].dataType.fields]
    return out.select("r", "decoded") if clash else out.select("r.*", "decoded")


def op4_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    ids = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, carry=["doc_id"])
    both = decode(ids, path)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op4_bpe": op4_bpe}
ORACLES: dict[str, str] = {}
