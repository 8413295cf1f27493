"""Shared pieces of the training-data operators.

* ``table``        reads one input table through Spark's own reader.
* ``materialize``  cuts lineage with a Parquet table in the shared folder that the
  cluster names in ``spark.checkpoint.dir``; a lost executor only repeats reads.
* ``KeyFilter``    a hashed bitmap of *bounded* size: a superset test that lets rows which
  surely have no partner skip the shuffle.  It never decides anything by itself.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space in every contract of this subpackage.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"
#: Seed of every XXH64 over shingles.
SEED = 42
_WORDS = re.compile(WORD).findall
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPACE_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` of the session wins.  A folder of our own is set only where none is
    named and everything runs in one JVM (``local`` masters, as in tests).
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="foliant-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, fs = hadoop_path(spark, path)
    fs.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[str]:
    """Words of one text with A-Z lower-cased."""
    return _WORDS((text or "").translate(_LOWER))


def without_space(text: Column) -> Column:
    """``text`` less every character of ``[\\x20\\x09-\\x0D]`` (plain byte search, no regex)."""
    for c in _SPACE_CHARS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else untouched (``lower`` would also change other alphabets)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class KeyFilter:
    """Bitmap over hashed keys, at most ``2**log2_bits / 8`` bytes whatever the input's size.

    ``mark(df, key, name)`` adds a boolean column that is true for every key that was put in and for
    few others.  Callers must stay right when it is always true (a full bitmap).
    """

    def __init__(self, keys: DataFrame, key: Column, log2_bits: int = 24):
        self.log2_bits = log2_bits
        slot = self._slot(key)
        # at most 2**log2_bits / 32768 rows of 4 KiB: a proven bound for the broadcast below
        self.bits = keys.groupBy(F.bitmap_bucket_number(slot).alias("_kf_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_kf_bits")
        )

    def _slot(self, key: Column) -> Column:
        return F.pmod(key, F.lit(1 << self.log2_bits)) + F.lit(1)

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        slot = self._slot(key)
        kept = [df[c] for c in df.columns]
        probe = df.select(*kept, F.bitmap_bucket_number(slot).alias("_kf_b"), F.bitmap_bit_position(slot).alias("_kf_p"))
        hit = F.expr(
            "coalesce(getbit(cast(conv(hex(substring(_kf_bits, cast(_kf_p div 8 + 1 as int), 1)), 16, 10) as int),"
            " cast(_kf_p % 8 as int)) = 1, false)"
        )
        joined = probe.join(F.broadcast(self.bits), F.col("_kf_b") == F.col("_kf_bucket"), "left")
        return joined.withColumn(name, hit).drop("_kf_b", "_kf_p", "_kf_bucket", "_kf_bits")


def row_key(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, Column]:
    """What tells rows apart when a verdict is joined back: the id and a hash of the text."""
    return docs[doc_id].alias("key_id"), F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("key_hash")


def without_rows(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` less the rows whose key is in ``gone(key_id, key_hash)``; columns as they were.

    Rows outside a bounded bitmap of the gone keys pass without a shuffle; only the others, the gone
    ones and few more, meet them in an anti join.
    """
    gone = materialize(gone.select("key_id", "key_hash").distinct(), "gone")
    key = F.xxhash64("key_id", "key_hash")
    tagged = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *row_key(docs, doc_id, text))
    marked = KeyFilter(gone, key).mark(tagged, key, "maybe")
    g = gone.select(F.col("key_id").alias("g_id"), F.col("key_hash").alias("g_hash"))
    match = F.col("key_id").eqNullSafe(F.col("g_id")) & (F.col("key_hash") == F.col("g_hash"))
    return marked.where("not maybe").select("row.*").unionByName(marked.where("maybe").join(g, match, "left_anti").select("row.*"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is its class's least node.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each keeps the classes, never
    grows the number of edges, and O(log^2) rounds leave stars.  A node's neighbours are never
    gathered: the least one comes from a pre-aggregated ``min``.
    """
    e = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("a"), F.min("b")).alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        least = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
        small = large.join(least, F.col("b") == F.col("n")).select("a", "b", "m")
        e = materialize(
            small.select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "edges",
        )
        now = e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        before = now
    raise RuntimeError("components did not settle")
