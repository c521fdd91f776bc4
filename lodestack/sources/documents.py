"""Folders of documents with a YAML header: reading, header parsing, JSON and CSV tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

MEMBER = "SKILL.md"  # fixed value: the file that every folder must hold


def walk(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """All files below a folder, not the folders (SRC-5): path, relative, length and, if asked for, content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").rsplit("/", 1)[-1]
    files = files.withColumn("relative", F.regexp_extract("path", f"/{_quoted(base)}/(.*)\\z", 1))
    return files.select("path", "relative", "length", *["content"] * content)


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def child_folders(files: DataFrame) -> DataFrame:
    """Names of the folders right below the root, sorted (SRC-6, SORT-1)."""
    return files.select(F.regexp_extract("relative", "^([^/]+)/", 1).alias("name")).where("name != ''").distinct().orderBy("name")


def member_content(files: DataFrame, member: str = MEMBER) -> DataFrame:
    """Each child folder with its member file's content, null if it has none (SRC-2)."""
    own = files.withColumn("name", F.regexp_extract("relative", "^([^/]+)/", 1)).where("name != ''")
    return own.groupBy("name").agg(F.max(F.when(F.col("relative") == F.concat("name", F.lit(f"/{member}")), F.struct("content"))).alias("m")).select("name", F.col("m.content").alias("content"))


def valid_text(content: str) -> F.Column:
    """Bytes as text, null where they aren't UTF-8; a byte-order mark stays (SRC-1)."""
    text = F.col(content).cast("string")
    return F.when(F.is_valid_utf8(text), text)


def newlines(text: F.Column) -> F.Column:
    return F.regexp_replace(text, "\\r\\n?", "\n")


def header_text(text: F.Column) -> F.Column:
    """What stands between the first fences, null without them (SRC-3)."""
    found = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    return F.when(text.rlike(r"(?s)\A---\n.*?\n---"), found)


HEADER = T.StructType(
    [T.StructField(n, t) for n, t in (("error", T.StringType()), ("is_map", T.BooleanType()), ("keys", T.ArrayType(T.StringType())), ("name", T.StringType()), ("name_type", T.StringType()), ("description", T.StringType()), ("description_type", T.StringType()), ("entries", T.MapType(T.StringType(), T.StringType())))]
)


def _parse_header(text: str | None) -> dict | None:
    import yaml

    if text is None:
        return None
    out = dict.fromkeys((f.name for f in HEADER), None) | {"is_map": False}
    try:
        data = yaml.safe_load(text)
    except yaml.YAMLError as e:
        return out | {"error": str(e)}
    if not isinstance(data, dict):
        return out
    out |= {"is_map": True, "keys": [str(k) for k in data], "entries": {str(k): None if v is None else str(v) for k, v in data.items()}}
    for k in ("name", "description"):
        if k in data:
            out |= {k: data[k] if isinstance(data[k], str) else None, f"{k}_type": type(data[k]).__name__}
    return out


def parse_headers(df: DataFrame, header: str, to: str = "parsed") -> DataFrame:
    """``df`` with the YAML header in a column parsed, types kept (SRC-4, UDF-2).  The one Python step: Spark has no YAML reader."""
    schema = T.StructType([*df.schema.fields, T.StructField(to, HEADER)])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(HEADER)
        for batch in batches:
            found = [_parse_header(x) for x in batch.column(names.index(header)).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(found, kind)], [*names, to])

    return df.mapInArrow(run, schema)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON document a file, with an explicit schema (SRC-8)."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def eval_cases(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.EVAL_SET).select("skill_name", F.explode("evals").alias("e")).select("skill_name", "e.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.SOURCE_INVENTORY) -> DataFrame:
    """A CSV table with a header; a row that doesn't fit stops the read (SRC-9)."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", multiLine=True, escape='"')


def inline_table(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """A small table given in code (SRC-7)."""
    return spark.createDataFrame(rows, "name string, path string")


def first_source(*candidates: F.Column) -> F.Column:
    """The first candidate that is there (SRC-11)."""
    return F.coalesce(*candidates)


def port_file(text: F.Column) -> F.Column:
    """Port and path of a port file as a struct (SRC-10): the first line's leading digits between 1 and 65535, and the second line if it isn't empty; null without a port."""
    lines = F.split(F.btrim(text, F.lit(" \t\r\n")), "\n")
    digits = F.regexp_extract(F.get(lines, F.lit(0)), r"^\s*([+-]?[0-9]{1,9})", 1)
    port = F.when(digits != "", digits.cast("int"))
    return F.when((port > 0) & (port < 65536), F.struct(port.alias("port"), F.nullif(F.get(lines, F.lit(1)), F.lit("")).alias("path")))
