"""Readers: entries, patch logs, layout XML, word tables, catalogues, gold texts, page artifacts.

All take an explicit schema.  Files are read by Spark; only small configuration files are parsed in the
driver.
"""

from __future__ import annotations

import re
import tomllib
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import metrics as mx
from ..functions import text as tx

S, I = schemas.S, schemas.I


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """JSONL corpus: one file, a folder of ``*.jsonl``, or what ``write_entries`` wrote; a bad line fails the read."""
    return spark.read.schema(schemas.ENTRY).option("mode", "FAILFAST").option("pathGlobFilter", "{*.jsonl,part-*}").json(path)


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """Append-only log with ``seq``, each patch's line number; a missing log is empty, a bad line fails."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], T.StructType([T.StructField("seq", T.LongType()), *schemas.PATCH.fields]))
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("seq", "line")).where(F.trim("line") != "")
    return lines.select(F.col("seq").cast("long").alias("seq"), F.from_json("line", schemas.PATCH, {"mode": "FAILFAST"}).alias("p")).select("seq", "p.*")


_KIND = (
    "edition string, source_page int, engine string, page_w int, page_h int, region_ord int, region_id string, region_x int, region_y int, region_w int, region_h int, "
    "line_ord int, line_id string, x int, y int, w int, h int, text string, confidence float, polygon array<struct<x:float,y:float>>, "
    "words array<struct<id:string,text:string,confidence:float,x:float,y:float,w:float,h:float,language:string>>"
)


def _local(node: ET.Element) -> str:
    return node.tag.rsplit("}", 1)[-1]


def _named(node: ET.Element, name: str) -> list[ET.Element]:
    return [n for n in node.iter() if _local(n) == name]


def _polygon(node: ET.Element) -> list[dict]:
    for child in node:
        if _local(child) == "Shape":
            for p in _named(child, "Polygon"):
                return [{"x": float(a), "y": float(b)} for a, b in (pair.split(",") for pair in p.get("POINTS", "").split())]
    try:
        x, y, w, h = (float(node.attrib[k]) for k in ("HPOS", "VPOS", "WIDTH", "HEIGHT"))
    except KeyError:
        return []
    return [{"x": x, "y": y}, {"x": x + w, "y": y}, {"x": x + w, "y": y + h}, {"x": x, "y": y + h}]


def _box(polygon: list[dict]) -> tuple[float, float, float, float]:
    if not polygon:
        return 0.0, 0.0, 0.0, 0.0
    xs, ys = [p["x"] for p in polygon], [p["y"] for p in polygon]
    return min(xs), min(ys), max(xs) - min(xs), max(ys) - min(ys)


def _whole(v: float) -> int:
    return max(0, int(v + 0.5))


def _share(value: str | None) -> float:
    try:
        return float(value)
    except (TypeError, ValueError):
        return 0.0


def _line_text(node: ET.Element) -> tuple[str, list[dict]]:
    """Strings, spaces and hyphens in document order."""
    text, words = "", []
    for child in node.iter():
        name = _local(child)
        if name == "String":
            content = child.get("CONTENT", "")
            text += (" " if text and not text[-1].isspace() else "") + content
            x, y, w, h = _box(_polygon(child))
            words.append({"id": child.get("ID"), "text": content, "confidence": min(1.0, max(0.0, _share(child.get("WC")))), "x": x, "y": y, "w": w, "h": h, "language": None})
        elif name == "SP":
            text += "" if text.endswith(" ") else " "
        elif name == "HYP":
            text += child.get("CONTENT", "-")
    return text.strip(), words


def parse_alto(xml: str, edition: str, source_page: int, engine: str) -> list[dict]:
    page = next(iter(_named(ET.fromstring(xml), "Page")), None)
    if page is None:
        raise ValueError("layout document has no Page")
    rows, blocks = [], _named(page, "TextBlock")
    if not blocks:
        raise ValueError("layout page has no TextBlock")
    for r, block in enumerate(blocks):
        region = block.get("ID", f"region-{r:04d}")
        rx, ry, rw, rh = map(_whole, _box(_polygon(block)))
        for n, line in enumerate(_named(block, "TextLine")):
            line_id = line.get("ID", f"{region}-line-{n:04d}")
            text, words = _line_text(line)
            for k, w in enumerate(words):
                w["id"] = w["id"] or f"{line_id}-word-{k + 1:04d}"
            weights = [max(1, len(w["text"])) for w in words]
            confidence = sum(w["confidence"] * k for w, k in zip(words, weights)) / sum(weights) if words else _share(line.get("WC"))
            polygon = _polygon(line)
            x, y, w_, h_ = map(_whole, _box(polygon))
            rows.append(
                dict(
                    edition=edition, source_page=source_page, engine=engine, page_w=int(page.attrib["WIDTH"]), page_h=int(page.attrib["HEIGHT"]), region_ord=r, region_id=region,
                    region_x=rx, region_y=ry, region_w=rw, region_h=rh, line_ord=n, line_id=line_id, x=x, y=y, w=w_, h=h_, text=text, confidence=confidence, polygon=polygon, words=words,
                )
            )
    return rows


def lines_from_alto(pages: DataFrame) -> DataFrame:
    """``pages(edition, source_page, engine, xml)`` -> the ``lines`` table.

    Strings, spaces and hyphens interleave, which Spark's own XML source does not keep; hence a parser
    in ``mapInPandas``, one page at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame(parse_alto(row.xml, row.edition, row.source_page, row.engine))

    return pages.select("edition", "source_page", "engine", "xml").mapInPandas(run, _KIND)


def read_alto(spark: SparkSession, path: str, name_pattern: str = r"([^/]+)-p0*(\d+)\.([^./]+)\.xml$") -> DataFrame:
    """A folder of layout files; edition, page and engine come from the file names."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("xml"), F.input_file_name().alias("file"))
    part = lambda k: F.regexp_extract("file", name_pattern, k)
    return lines_from_alto(raw.select(part(1).alias("edition"), part(2).cast("int").alias("source_page"), part(3).alias("engine"), "xml"))


_TSV = T.StructType([T.StructField(f"c{i}", S) for i in range(12)])


def read_word_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Word table of a recogniser: per file the joined text and its weighted confidence (0..1)."""
    raw = spark.read.schema(_TSV).option("sep", "\t").option("header", True).option("quote", "").csv(path).withColumn("file", F.input_file_name()).withColumn("seq", F.monotonically_increasing_id())
    rows = raw.where((F.col("c0") == "5") & (tx.trim_space(F.coalesce("c11", F.lit(""))) != "")).withColumn("conf", F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(F.col("c10").try_cast("double"), F.lit(0.0)))) / 100)
    weight = F.greatest(F.length("c11"), F.lit(1))
    return rows.groupBy("file").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "c11"))), lambda x: x["c11"]), " ").alias("text"), (F.sum(F.col("conf") * weight) / F.sum(weight)).alias("confidence")
    )


def read_toml(path: str) -> dict:
    with open(path, "rb") as f:
        return tomllib.load(f)


_SOURCE = schemas.struct(
    edition=S, title=S, year=I, publisher=S, public_url=S, download_url=S, local_import_path=S, rights=S, sha256=S, scan_id=S, printed_page_offset=I, printed_page_labels=T.MapType(I, S), page_count=I,
    alternate_scans=schemas.array(schemas.struct(scan_id=S, public_url=S, note=S)),
)


def sources(spark: SparkSession, catalogue: dict) -> DataFrame:
    """Source catalogue as a dimension table; unknown keys, repeated editions and bad hashes are errors."""
    rows, seen = [], set()
    for record in catalogue.get("sources", catalogue.get("source", [])):
        unknown = set(record) - set(_SOURCE.names)
        if unknown or record["edition"] in seen or not re.fullmatch("[0-9a-f]{64}", record["sha256"]):
            raise ValueError(f"bad source record {record.get('edition')}: {sorted(unknown) or 'repeated edition or bad hash'}")
        seen.add(record["edition"])
        labels = {int(k): v for k, v in record.get("printed_page_labels", {}).items()}
        rows.append([record.get(n) if n != "printed_page_labels" else labels for n in _SOURCE.names])
    return spark.createDataFrame(rows, _SOURCE)


_PILOT = schemas.struct(edition=S, printed_page=S, category=S, scripts=schemas.array(S), note=S)


def pilot(spark: SparkSession, catalogue: dict, pages_per_edition: int = 24) -> DataFrame:
    """Pilot pages; each edition must list exactly ``pages_per_edition`` distinct ones."""
    rows = [[e["edition"], str(p["printed_page"]), p.get("category"), p.get("scripts", []), p.get("note")] for e in catalogue.get("editions", []) for p in e["pages"]]
    for edition in {r[0] for r in rows}:
        if len({r[1] for r in rows if r[0] == edition}) != pages_per_edition:
            raise ValueError(f"{edition} needs {pages_per_edition} distinct pilot pages")
    return spark.createDataFrame(rows, _PILOT)


# Limits and defaults of the pipeline settings.
SETTINGS = {"dpi": (72, 1200, 400), "confidence_threshold": (0.0, 1.0, 0.80), "disagreement_threshold": (0.0, 1.0, 0.15)}


def settings(values: dict) -> dict:
    """Pipeline settings with defaults, each within its range."""
    out = dict(values)
    for name, (low, high, default) in SETTINGS.items():
        out.setdefault(name, default)
        if not low <= out[name] <= high:
            raise ValueError(f"{name} must be within {low} and {high}")
    return out


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold texts, one row per line with its position; structural errors fail the read."""
    g = spark.read.schema(schemas.GOLD).option("multiLine", True).option("mode", "FAILFAST").json(path)
    names = F.transform("lines", lambda x: x["line_id"])
    bad = (tx.trim_space("id") == "") | (F.col("source_page") < 1) | ~F.col("source_sha256").rlike("^[0-9A-Fa-f]{64}$") | (F.size("lines") == 0) | (F.size(F.array_distinct(names)) != F.size("lines"))
    checked = g.withColumn("lines", F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.lit("invalid gold text"))).otherwise(F.col("lines")).cast(schemas.GOLD["lines"].dataType))
    return checked.select("id", "edition", "source_page", F.posexplode("lines").alias("position", "line")).select("id", "edition", "source_page", "position", "line.line_id", "line.text")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path)


def read_metrics(spark: SparkSession, path: str | None) -> DataFrame:
    """Accuracy metrics; without a file one row of zeros."""
    if path is None:
        return spark.createDataFrame([[0.0, 0.0, {}, 0.0, 0.0, 0.0]], schemas.METRICS)
    return spark.read.schema(schemas.METRICS).option("multiLine", True).json(path)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GROUND_TRUTH).json(path)


_ARTIFACT = schemas.struct(source_page=I, entries=schemas.array(schemas.ENTRY), assignments=T.StringType())


def read_page_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """All ``parsed.json`` below ``root``: ``file``, ``artifact`` (null where it is no valid JSON) and the
    line assignments, whose tagged values come as ``kind`` and ``entry_id``."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "parsed.json").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    triples = F.from_json(F.col("artifact.assignments"), "array<array<string>>")
    out = raw.select("file", F.from_json("value", _ARTIFACT).alias("artifact"))
    each = F.transform(
        triples,
        lambda t: F.struct(F.get(t, 0).alias("region_id"), F.get(t, 1).alias("line_id"), F.coalesce(F.get_json_object(F.get(t, 2), "$.kind"), F.get(t, 2)).alias("kind"), F.get_json_object(F.get(t, 2), "$.entry_id").alias("entry_id")),
    )
    return out.withColumn("assignments", each)


def verify_files(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Content hashes of files against ``expected(name, sha256)``: name, actual, matches."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("actual"))
    return expected.join(files, "name", "left").select("name", "actual", F.coalesce(F.col("actual") == F.lower("sha256"), F.lit(False)).alias("matches"))


def evaluate_gold(gold: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per gold text: CER, WER, per-script CER over all lines at once, and missing lines.

    Of repeated hypothesis line ids the last counts."""
    place = F.struct("region_ord", "line_ord")
    last = lines.groupBy("edition", "source_page", "line_id").agg(F.max_by("text", place).alias("hypothesis"))
    joined = gold.join(last, ["edition", "source_page", "line_id"], "left")
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.coalesce(c, F.lit("")).alias("t")))), lambda x: x["t"]), "\n")
    missing = F.transform(F.array_sort(F.collect_list(F.when(F.col("hypothesis").isNull(), F.struct("position", "line_id")))), lambda x: x["line_id"])
    per = joined.groupBy("id").agg(text(F.col("text")).alias("reference"), text(F.col("hypothesis")).alias("hypothesis"), missing.alias("missing_lines"))
    r, h = F.col("reference"), F.col("hypothesis")
    return per.select(
        "id", mx.cer(r, h).alias("cer"), mx.wer(r, h).alias("wer"), mx.script_cer(r, h).alias("cer_by_script"), F.length(r).alias("reference_characters"), F.size(tx.tokens(r)).alias("reference_words"), "missing_lines"
    )
