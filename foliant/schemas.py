"""Explicit schemas; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, TS = T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def array(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind, True)


POINT = struct(x=D, y=D)
POLYGON = array(POINT)
HYPOTHESIS = struct(engine=S, engine_version=S, model=S, model_hash=S, text=S, confidence=D)
COORDINATE = struct(source_page=I, printed_page=S, region_id=S, line_id=S, polygon=POLYGON, transform_id=S, page_image=S)
WARNING = struct(code_point=S, character_offset=I, code=S, message=S)
SPAN = struct(
    id=S, diplomatic=S, normalized=S, language=S, script=S, direction=S, confidence=D, review_state=S, hypotheses=array(HYPOTHESIS), coordinates=array(COORDINATE), warnings=array(WARNING)
)
BLOCK = struct(id=S, kind=S, spans=array(SPAN))
SENSE = struct(id=S, label=S, blocks=array(BLOCK))
CITATION = struct(id=S, text=SPAN, target=S)
CROSS_REFERENCE = struct(id=S, text=SPAN, target_entry_id=S)
PROVENANCE = struct(edition=S, source_sha256=S, scan_id=S, pipeline_run=S)
ENTRY = struct(
    id=S,
    aliases=array(S),
    edition=S,
    printed_page=S,
    entry_ordinal=I,
    headword=SPAN,
    homograph=I,
    grammatical_labels=array(SPAN),
    blocks=array(BLOCK),
    senses=array(SENSE),
    citations=array(CITATION),
    cross_references=array(CROSS_REFERENCE),
    etymology=array(BLOCK),
    provenance=PROVENANCE,
    confidence=D,
    review_state=S,
    revision=L,
)
PATCH = struct(entry_id=S, base_revision=L, revision=L, reviewer=S, comment=S, reviewed_at=TS, replacement=ENTRY)
WORD = struct(id=S, text=S, confidence=D, x=D, y=D, w=D, h=D, language=S)
LINE = struct(
    edition=S, source_page=I, engine=S, page_w=I, page_h=I, region_ord=I, region_id=S, region_x=I, region_y=I, region_w=I, region_h=I,
    line_ord=I, line_id=S, x=I, y=I, w=I, h=I, text=S, confidence=D, polygon=POLYGON, words=array(WORD),
)
ASSIGNMENT = struct(edition=S, source_page=I, region_id=S, line_id=S, kind=S, entry_id=S)
GOLD = struct(id=S, edition=S, source_page=I, source_sha256=S, authority=S, lines=array(struct(line_id=S, text=S)))
MANIFEST = struct(
    corpus_version=S, schema_version=S, pipeline_commit=S, generated_at=TS, source_hashes=T.MapType(S, S), model_hashes=T.MapType(S, S), entry_count=L, draft=B
)
METRICS = struct(cer=T.DoubleType(), wer=T.DoubleType(), cer_by_script=T.MapType(S, T.DoubleType()), layout_accuracy=T.DoubleType(), boundary_precision=T.DoubleType(), boundary_recall=T.DoubleType())
GROUND_TRUTH = struct(edition=S, printed_page=S, source_page=I, line_id=S, image=S, text=S, split=S, reviewer=S)

ENTRY_ROLES = ("headword", "grammatical_labels", "blocks", "senses", "citations", "cross_references", "etymology")
