"""Explicit schemas of the data model; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


CATALOGUE_ENTRY = _of(name=_S, path=_S, source=_S)
CATALOGUE = _of(name=_S, description=_S, skills=T.ArrayType(CATALOGUE_ENTRY), excluded=T.ArrayType(_S))
FOLDER_FILE = _of(path=_S, modificationTime=T.TimestampType(), length=_L, content=T.BinaryType())
DOCUMENT = _of(name=_S, description=_S, keys=T.ArrayType(_S), body=_S)
FRONT_MATTER = _of(entries=T.MapType(_S, _S), name_type=_S, desc_type=_S)
SITE_NOTE = _of(domain=_S, aliases=T.ArrayType(_S), updated=_DATE, body=_S)
EVAL_CASE = _of(id=_I, prompt=_S, expected_output=_S, files=T.ArrayType(_S))
EVAL_SET = _of(skill_name=_S, evals=T.ArrayType(EVAL_CASE))
PATTERN = _of(
    id=_S, name=_S, category=_S, source_skill=_S, applied_to=T.ArrayType(_S), description=_S, when_to_apply=_S, when_not_to_apply=_S,
    implementation_hint=_S, success_count=_I, failure_count=_I, user_satisfaction=_S, created_at=_DATE, last_used=_DATE,
)
PATTERN_LIBRARY = _of(patterns=T.ArrayType(PATTERN), meta=_of(total_evolutions=_I, most_effective_category=_S))
SOURCE_INVENTORY = _of(date=_DATE, platform_id=_S, title=_S, series=_S, subseries=_S, knowledge_theme=_S, duration=_I, play_count=_L, url=_S, status=_S, local_transcript_path=_S)
PUBLIC_COLUMNS = [f.name for f in SOURCE_INVENTORY if f.name not in ("status", "local_transcript_path")]
PUBLIC_INDEX = T.StructType([SOURCE_INVENTORY[c] for c in PUBLIC_COLUMNS])
LAYERS = ("raw", "audio", "transcripts", "data", "notes", "outputs", "logs", "tmp")
WIKI_PAGE = _of(page_id=_S, type=_S, title=_S, updated=_DATE, body=_S)
EDGE = _of(src=_S, dst=_S, kind=_S)
RUN_TRACE = _of(task=_S, agent=_S, tools=T.ArrayType(_S), elapsed=_D, tokens=_L)
SCORE_CARD = _of(dimension=_S, agent=_S, score=_I, advice=_S)
SERIES_POINT = _of(entity=_S, period=_I, metric=_S, value=_D)
BALANCE = _of(period=_I, opening=_D, output=_D, imports=_D, consumption=_D, exports=_D)
BROWSER_TARGET = _of(targetId=_S, type=_S, title=_S, url=_S)
REQUEST = _of(id=_L, target=_S, at=T.TimestampType())
SCOPE = _of(creator=_S, platform=_S, series=_S, start=_DATE, end=_DATE, expected=_L, product=_S, boundary=_S, frequency=_S)
COMPLETION_REPORT = _of(sources=_L, processed=_L, failed=_L, artifacts=_L, boundary=_S, cleaned=_L, update_path=_S)

#: The tables that queries read.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
