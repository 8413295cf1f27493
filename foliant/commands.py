"""Commands: ``python -m foliant.commands NAME ...``; each prints JSON lines.

run, benchmark, train, validate, report, export, review, search, source-verify.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import ids
from .operators import corpus, evaluate
from .plans import run as plan
from .sources import readers, writers


def materialized(spark: SparkSession, entries: str, patches: str | None) -> DataFrame:
    """Base entries, with the correction log replayed if there is one."""
    base = readers.read_entries(spark, entries)
    return corpus.replay(base, readers.read_patches(spark, patches)) if patches else base


def show(df: DataFrame) -> None:
    for line in df.toJSON().toLocalIterator():
        print(line)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    """Pages of layout files into the corpus: parse, fuse, segment, publish."""
    wanted = spark.range(1).select(F.explode(ids.page_spec(F.lit(a.pages))).alias("source_page"))
    lines = readers.read_alto(spark, a.alto).where(F.col("edition") == a.edition).join(F.broadcast(wanted), "source_page")
    canonical = lines.where(F.col("engine") == a.canonical).cache()
    if a.secondary:
        canonical = plan.fuse(canonical, lines.where(F.col("engine") == a.secondary)).cache()
    catalogue = readers.read_toml(a.catalogue)
    source = next(s for s in catalogue.get("sources", catalogue.get("source", [])) if s["edition"] == a.edition)
    engines = spark.read.schema("engine string, engine_ord int, engine_version string, model string, model_hash string").json(a.engines)
    context = {"source_sha256": source["sha256"], "scan_id": source["scan_id"], "pipeline_run": a.run_id, "transform_id": "identity", "page_image": "page-%04d.png"}
    entries, assignments = plan.run(canonical, lines, engines, source, context)
    published = plan.publish(readers.read_entries(spark, a.entries), entries, wanted) if a.entries else entries
    writers.write_entries(published, a.out)
    show(evaluate.assignment_counts(assignments))


def benchmark(spark: SparkSession, a: argparse.Namespace) -> None:
    show(readers.evaluate_gold(readers.read_gold(spark, a.gold), readers.read_alto(spark, a.alto)))


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    """Reviewed pilot lines with their split, and every engine's baseline on them."""
    truth = corpus.ground_truth(materialized(spark, a.entries, a.patches), readers.pilot(spark, readers.read_toml(a.pilot))).cache()
    truth.drop("hypotheses").write.mode("overwrite").json(a.out)
    show(evaluate.split_counts(truth))
    show(evaluate.baseline_metrics(truth))


def validate(spark: SparkSession, a: argparse.Namespace) -> None:
    issues = corpus.validate(materialized(spark, a.entries, a.patches)).cache()
    show(issues.orderBy("location", "code"))
    verdict = evaluate.is_valid(issues).first()
    print(json.dumps(verdict.asDict()))
    if not verdict.valid:
        raise SystemExit(1)


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    entries = materialized(spark, a.entries, a.patches).cache()
    statistics = corpus.edition_statistics(entries, corpus.spans(entries))
    headed = entries.where("headword IS NOT NULL").select(F.concat_ws("#", "headword.normalized", F.coalesce("homograph", F.lit(0)).cast("string")).alias("key"), "edition", corpus.entry_text().alias("text"), F.col("id").alias("seq"))
    only, differ = corpus.headword_differences(headed)
    print(writers.comparison_markdown(statistics))
    for df in (statistics.orderBy("edition"), only.orderBy("key"), differ.orderBy("key")):
        show(df)


def manifest(entries: DataFrame, version: str, commit: str) -> dict:
    row = corpus.manifest(entries, version, commit, F.lit(datetime.now(timezone.utc))).first()
    return row.asDict()


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    entries = materialized(spark, a.entries, a.patches)
    writers.export(entries, a.out, a.format, manifest(entries, a.version, a.commit), a.title)


def review(spark: SparkSession, a: argparse.Namespace) -> None:
    """The review queue, one entry (``--id``), or pages (``--by-page``)."""
    entries = materialized(spark, a.entries, a.patches)
    if a.id:
        show(entries.where(F.col("id") == a.id))
    elif a.by_page:
        show(corpus.review_pages(entries))
    else:
        queue = corpus.review_summary(entries)
        queue = queue.where(F.col("review_state") == a.state) if a.state else queue.where("queued")
        show(queue.orderBy("id"))


def search(spark: SparkSession, a: argparse.Namespace) -> None:
    show(corpus.search(corpus.search_index(materialized(spark, a.entries, a.patches)), *a.terms).orderBy("entry_id"))


def source_verify(spark: SparkSession, a: argparse.Namespace) -> None:
    table = readers.sources(spark, readers.read_toml(a.catalogue)).select(F.concat("edition", F.lit(a.suffix)).alias("name"), "sha256")
    show(readers.verify_files(spark, a.folder, table))


# options of each command; a trailing ! marks those that must be given
COMMANDS = {
    "run": (run, ["edition!", "pages!", "alto!", "canonical!", "secondary", "catalogue!", "engines!", "run-id!", "entries", "out!"]),
    "benchmark": (benchmark, ["gold!", "alto!"]),
    "train": (train, ["entries!", "patches", "pilot!", "out!"]),
    "validate": (validate, ["entries!", "patches"]),
    "report": (report, ["entries!", "patches"]),
    "export": (export, ["entries!", "patches", "format!", "out!", "version=1.0.0", "commit=unknown", "title=Corpus"]),
    "review": (review, ["entries!", "patches", "id", "state", "by-page?"]),
    "search": (search, ["entries!", "patches", "terms*"]),
    "source-verify": (source_verify, ["catalogue!", "folder!", "suffix=.pdf"]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="foliant")
    commands = top.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        p = commands.add_parser(name)
        for o in options:
            base, _, default = o.rstrip("!?*").partition("=")
            if o.endswith("?"):
                p.add_argument(f"--{base}", action="store_true")
            elif o.endswith("*"):
                p.add_argument(base, nargs="+")
            else:
                p.add_argument(f"--{base}", required=o.endswith("!"), default=default or None)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    COMMANDS[a.command][0](spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
