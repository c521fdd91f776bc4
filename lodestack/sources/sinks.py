"""Writers: archives, scaffolds, save modes, logs, upserts, publishing, snapshots."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import fill, title_case
from ..schemas import PUBLIC_COLUMNS


def archive(folder: str, to: str | None = None) -> str:
    """A folder as a deflated zip file ``<name>.skill`` with names relative to its parent; runs on the driver (SNK-1, PRJ-4)."""
    source = Path(folder).resolve()
    if not source.is_dir():
        raise NotADirectoryError(folder)
    target = Path(to or ".").resolve() / f"{source.name}.skill"
    target.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(source.rglob("*")):
            if p.is_file() and p != target:
                z.write(p, p.relative_to(source.parent))
    return str(target)


def scaffold(root: str, name: str, files: dict[str, str]) -> str:
    """A new folder from templates with {{NAME}} and {{TITLE}}; refuses one that is there (SNK-2)."""
    target = Path(root) / name
    target.mkdir(parents=True, exist_ok=False)
    title = " ".join(p.capitalize() for p in name.split("-"))
    for relative, template in files.items():
        p = target / relative
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(template.replace("{{NAME}}", name).replace("{{TITLE}}", title), encoding="utf-8")
    return str(target)


def archived(files: DataFrame, folder: str = "folder") -> DataFrame:
    """folder and data: a deflated zip of each folder's files (relative, content), made where the files are (SNK-1).

    A folder comes together in one task, as a zip file is one file.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, content in sorted(zip(group["relative"], group["content"], strict=True)):
                z.writestr(zipfile.ZipInfo(name), bytes(content or b""), zipfile.ZIP_DEFLATED)
        return pd.DataFrame({"folder": [group["folder"].iloc[0]], "data": [out.getvalue()]})

    return files.select(F.col(folder).alias("folder"), "relative", "content").groupBy("folder").applyInPandas(pack, "folder string, data binary")


def unarchived(archives: DataFrame) -> DataFrame:
    """folder, relative and content of the files in each archive (folder, data)."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder, data in zip(batch["folder"], batch["data"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    yield pd.DataFrame([(folder, i.filename, z.read(i)) for i in z.infolist()], columns=["folder", "relative", "content"])

    return archives.select("folder", "data").mapInPandas(unpack, "folder string, relative string, content binary")


def scaffolded(names: DataFrame, files: dict[str, str], there: DataFrame) -> DataFrame:
    """folder, relative and content of new folders (column ``folder``) from templates with {{NAME}} and {{TITLE}}; folders that are ``there`` are refused: they get no row (SNK-2)."""
    new = names.select("folder").distinct().join(there.select("folder").distinct(), "folder", "left_anti")
    rows = F.array(*(F.struct(F.lit(r).alias("relative"), fill(t, NAME=F.col("folder"), TITLE=title_case(F.col("folder"))).alias("content")) for r, t in files.items()))
    return new.select("folder", F.explode(rows).alias("f")).select("folder", "f.relative", "f.content")


def write_if_absent(df: DataFrame, path: str, force: bool = False) -> None:
    """Skips a target that is there, unless forced (SNK-3)."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def replace_pruned(files: DataFrame, path: str, drop: tuple[str, ...] = ("__pycache__", "node_modules")) -> None:
    """Replaces the target by the files outside the dropped folders (SNK-4, FIL-13)."""
    files.where(~F.concat(F.lit("/"), F.col("relative")).rlike("/(" + "|".join(drop) + ")/")).write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """An append-only log (SNK-7)."""
    df.write.mode("append").parquet(path)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` take the place of rows with their key, others stay or are added (SNK-8)."""
    newer = new.select(key, F.struct(*new.columns).alias("_new"))
    older = old.select(key, F.struct(*old.columns).alias("_old"))
    both = older.join(newer, key, "full_outer")
    return both.select(*(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in old.columns))


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrites a table that ``df`` may be read from: written beside it first."""
    spark: SparkSession = df.sparkSession
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    spark.read.schema(df.schema).parquet(beside).write.mode("overwrite").parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def publish(df: DataFrame, path: str, blocked: F.Column, columns: list[str] = PUBLIC_COLUMNS) -> None:
    """Allowed columns of rows that pass the gate, in a folder of their own (SNK-9, PRJ-1)."""
    df.where(~blocked).select(*columns).write.mode("overwrite").parquet(path)


def cleanable(intermediates: DataFrame, verified: DataFrame, key: str) -> DataFrame:
    """Intermediates whose notes are verified (SNK-10)."""
    return intermediates.join(verified.select(key).distinct(), key, "left_semi")


def cleaned(intermediates: DataFrame, verified: DataFrame, key: str, size: str, path: str) -> DataFrame:
    """Writes what is left of the intermediates to ``path``, and returns files and size that were cleaned (SNK-10, AGG-14)."""
    intermediates.join(verified.select(key).distinct(), key, "left_anti").write.mode("overwrite").parquet(path)
    return cleanable(intermediates, verified, key).agg(F.count("*").alias("cleaned"), F.coalesce(F.sum(size), F.lit(0)).alias("cleaned_size"))


def snapshot(df: DataFrame, root: str, stamp: str) -> str:
    """A copy under a time stamp before a change (SNK-11)."""
    path = f"{root.rstrip('/')}/snapshot={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path
