"""URL filter: a memory-mapped sorted array of 64-bit digests of rule strings.

Rules are strings ``host/path-prefix`` with a verdict; plain blocked hosts and exact URLs are such
strings too.  The index is one file: the rules' XXH64 digests in ascending order, and beside each its
verdict and its place in a block of the full strings.  Workers map the file (they do not load it) and
probe whole Arrow batches with a vectorised binary search; each digest hit is confirmed against the
stored string, so a digest collision cannot give a wrong verdict.

The file goes to the shared folder and from there to each executor by Spark's file distribution,
which also serves executors that come later.  Its size is checked: beyond ``max_index_bytes`` the
same candidates are joined with the rules as a table instead (shuffled on the digest).

Candidates of a URL: every suffix of its host at a dot, each with every prefix of its path whose
length some rule has.  The longest rule that fits wins, of equally long ones the one with the
longer host.

Defined cases: null URL or no ``://``: host and path are empty, nothing fits; an empty path fits no
rule (rules' paths start with ``/``); repeated rows stay; other columns are ignored unless carried.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hadoop_path, shared_dir, table

SEED = 0
VERDICTS = ("allow", "block")
#: (rule, verdict) of the registered query.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Where no rule fits.
DEFAULT = "allow"
MAX_INDEX_BYTES = 1 << 30
ROWS = 4096


def digest(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8"), SEED)


class Index:
    """Layout: n, then n digests, n+1 offsets (64 bit), n verdicts (8 bit), n path lengths are part of
    the header list, then the strings."""

    def __init__(self, buffer: np.ndarray):
        n, k = (int(x) for x in buffer[:16].view(np.uint64))
        at = 16
        self.lengths = buffer[at : at + 8 * k].view(np.uint64).astype(int).tolist()
        at += 8 * k
        self.digests = buffer[at : at + 8 * n].view(np.uint64)
        at += 8 * n
        self.offsets = buffer[at : at + 8 * (n + 1)].view(np.uint64)
        at += 8 * (n + 1)
        self.verdicts = buffer[at : at + n]
        self.strings = buffer[at + n :]

    @staticmethod
    def build(rules: Iterable[tuple[str, str]]) -> bytes:
        entries = sorted({(digest(r), r.encode("utf-8"), VERDICTS.index(v)) for r, v in dict(rules).items()})
        lengths = sorted({len(r) - r.index("/") for r in dict(rules)})
        blob = b"".join(e[1] for e in entries)
        offsets = np.concatenate([[0], np.cumsum([len(e[1]) for e in entries])]).astype(np.uint64)
        parts = (np.array([len(entries), len(lengths)], np.uint64), np.array(lengths, np.uint64), np.array([e[0] for e in entries], np.uint64), offsets, np.array([e[2] for e in entries], np.uint8))
        return b"".join(p.tobytes() for p in parts) + blob

    def string(self, i: int) -> bytes:
        return self.strings[int(self.offsets[i]) : int(self.offsets[i + 1])].tobytes()

    def probe(self, candidates: list[str]) -> np.ndarray:
        """The entry of each candidate, or -1."""
        keys = np.fromiter((digest(c) for c in candidates), np.uint64, len(candidates))
        place = np.searchsorted(self.digests, keys)
        found = np.full(len(keys), -1, np.int64)
        inside = place < len(self.digests)
        hits = np.nonzero(inside)[0]
        hits = hits[self.digests[place[hits]] == keys[hits]]
        for h in hits:  # confirm; entries of equal digest stand side by side
            want, i = candidates[h].encode("utf-8"), int(place[h])
            while i < len(self.digests) and self.digests[i] == keys[h]:
                if self.string(i) == want:
                    found[h] = i
                    break
                i += 1
        return found


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Longest first; equally long ones with the longer host first."""
    if not host or not path:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    return sorted((h + path[:k] for h in hosts for k in lengths if k <= len(path)), key=len, reverse=True)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(after, "^[^?#]*", 0)


def publish(spark: SparkSession, index: bytes) -> str:
    """Put the index into the shared folder and register it; returns the file's name on executors."""
    name = f"url-index-{hashlib.sha256(index).hexdigest()[:24]}.bin"
    where, fs = hadoop_path(spark, f"{shared_dir(spark)}/{name}")
    if not fs.exists(where):
        out = fs.create(where, True)
        out.write(bytearray(index))
        out.close()
        fs.deleteOnExit(where)
    spark.sparkContext.addFile(where.toString() if where.isAbsolute() and "://" in where.toString() else fs.makeQualified(where).toString())
    return name


_mapped: dict[str, Index] = {}


def _open(name: str) -> Index:
    if name not in _mapped:
        _mapped[name] = Index(np.memmap(SparkFiles.get(name), np.uint8, "r"))
    return _mapped[name]


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]] = RULES,
    *,
    url: str = "url",
    carry: list[str],
    default: str = DEFAULT,
    max_index_bytes: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """``carry`` columns and ``host, path, rule, verdict`` of every row."""
    rules = list(dict(rules).items())
    spark = pages.sparkSession
    host, path = parts(pages[url])
    named = pages.select(F.struct(*[pages[c] for c in carry]).alias("row"), host.alias("host"), path.alias("path"))
    if sum(len(r.encode("utf-8")) + 25 for r, _ in rules) > max_index_bytes:
        return _joined(named, spark.createDataFrame(rules, "rule string, verdict string"), sorted({len(r) - r.index("/") for r, _ in rules}), default)
    name = publish(spark, Index.build(rules))
    kind = named.schema["row"].dataType.simpleString()

    def run(batches):
        index = _open(name)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lists = [candidates(h, p, index.lengths) for h, p in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                found = index.probe([c for x in lists for c in x])
                which, verdict, k = [], [], 0
                for x in lists:
                    hit = next((i for i in range(k, k + len(x)) if found[i] >= 0), None)
                    k += len(x)
                    which.append(None if hit is None else index.string(int(found[hit])).decode("utf-8"))
                    verdict.append(default if hit is None else VERDICTS[index.verdicts[found[hit]]])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(which, pa.string()), pa.array(verdict, pa.string())], ["row", "host", "path", "rule", "verdict"])

    out = named.mapInArrow(run, f"row {kind}, host string, path string, rule string, verdict string")
    return out.select("row.*", "host", "path", "rule", "verdict")


def _joined(named: DataFrame, rules: DataFrame, lengths: list[int], default: str) -> DataFrame:
    """The same answer from an equality join on the candidate's digest, for rule lists of any size.

    (host, path) pairs are made distinct first, so a host with a third of all pages is joined once a path.
    """
    labels = F.split("host", "\\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(k) for k in lengths]), lambda k: k <= F.length("path"))
    both = F.flatten(F.transform(hosts, lambda h: F.transform(cuts, lambda k: F.struct(F.concat(h, F.substring(F.col("path"), F.lit(1), k)).alias("rule"), F.length(h).alias("h")))))
    distinct = named.select("host", "path").where("host <> '' AND path <> ''").distinct()
    each = distinct.select("host", "path", F.explode(both).alias("c")).select("host", "path", "c.rule", "c.h")
    hit = each.join(rules, "rule").groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "h", "rule", "verdict")).alias("best"))
    out = named.join(hit, ["host", "path"], "left")
    return out.select("row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op2_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), carry=["page_id"])


ORACLE = r"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a
), c AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b
), r(rule, rhost, rpath, verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
         ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')
), h AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM c) u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path
)
SELECT page_id, c.host, c.path, h.rule, coalesce(h.verdict, 'allow') AS verdict FROM c LEFT JOIN h ON c.host = h.host AND c.path = h.path
"""

QUERIES = {"op2_url_filter": op2_url_filter}
ORACLES = {"op2_url_filter": ORACLE}
