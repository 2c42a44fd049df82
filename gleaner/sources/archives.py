"""Archives on disk: CSV and Parquet reads, staged overwrites, append logs, run folders."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import hadoop_path

# Columns of an article archive, in their order.
COLUMNS = ["search_keyword", "news_id", "pubdate", "collected_at", "title", "description", "link", "originallink", "content"]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)
META = "issue_cluster_id int, issue_label string, cluster_size int, representative_titles array<string>"


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def read_csv(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """CSV archive with header, quoted line breaks and byte order mark; a missing file is an empty archive."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.options(header=True, multiLine=True, escape='"', encoding="UTF-8").schema(schema).csv(path)


def read_archive(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Parquet archive; a missing one is empty."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_keyword_archives(spark: SparkSession, root: str, keywords: list[str], part: str | None = None) -> DataFrame:
    """The archives of the configured keywords that exist (``<root>/<keyword>[/<part>]``), as one table.

    Missing and unreadable ones are left out.
    """
    out = spark.createDataFrame([], SCHEMA)
    for k in keywords:
        path = f"{root}/{k}/{part}" if part else f"{root}/{k}"
        if exists(spark, path):
            try:
                one = spark.read.parquet(path)
            except AnalysisException:
                continue
            out = out.unionByName(one, allowMissingColumns=True)
    return out


def ordered(df: DataFrame, columns: list[str] = COLUMNS) -> DataFrame:
    """Declared columns first, any others after them."""
    return df.select(*[c for c in columns if c in df.columns], *[c for c in df.columns if c not in columns])


def replace(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Overwrite through a staging folder, so that a table may be derived from the one it replaces.

    The old table is set aside before the new one takes its name and deleted last,
    so a crash at any step leaves one of both whole.
    """
    spark = df.sparkSession
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(stage)
    fs, old = hadoop_path(spark, path)
    _, new = hadoop_path(spark, stage)
    _, aside = hadoop_path(spark, f"{stage}.old")
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"could not move {stage} to {path}")
    fs.delete(aside, True)


def append_rejects(df: DataFrame, path: str) -> None:
    """Append rejected rows, one folder per reason."""
    df.where("reject_reason is not null").write.mode("append").partitionBy("reject_reason").parquet(path)


def summary(df: DataFrame) -> DataFrame:
    return df.select("news_id", "pubdate", "title", "description")


def read_json(spark: SparkSession, path: str, schema: str = META) -> DataFrame:
    """A JSON array or object file, or a folder of JSON lines, as rows; a missing one is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=not is_folder(spark, path))


def read_state(spark: SparkSession, path: str) -> dict[str, str]:
    """Small key-value state; a missing file is empty."""
    if not exists(spark, path):
        return {}
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_state(spark: SparkSession, path: str, state: dict, history: str | None = None) -> None:
    """Replace a small state file; the former one moves to the folder ``history``, or is dropped.

    The new text is written beside it first. A former file that can't be moved is
    no reason to fail: it is overwritten.
    """
    fs, old = hadoop_path(spark, path)
    _, new = hadoop_path(spark, f"{path}.new-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(state, ensure_ascii=False, indent=2, sort_keys=True).encode()))
    out.close()
    if fs.exists(old):
        if history:
            _, folder = hadoop_path(spark, history)
            fs.mkdirs(folder)
            n = len(fs.listStatus(folder))
            _, kept = hadoop_path(spark, f"{history}/{n:06d}-{old.getName()}")
            fs.rename(old, kept)
        if fs.exists(old):
            fs.delete(old, False)
    if not fs.rename(new, old):
        raise OSError(f"could not move {new} to {path}")


def latest_run(spark: SparkSession, root: str) -> str:
    """Lexicographically last folder below ``root``."""
    fs, p = hadoop_path(spark, root)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []
    if not names:
        raise FileNotFoundError(f"no runs in {root}")
    return names[-1]


def as_json(df: DataFrame) -> DataFrame:
    """One JSON text per row, as an HTTP layer would serve it."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def write_csv(df: DataFrame, path: str, columns: list[str] = COLUMNS) -> None:
    """CSV with header, declared columns first, quotes doubled; replaces what is at ``path`` through a staging folder."""
    replace(ordered(df, columns), path, "csv", header=True, escape='"', encoding="UTF-8")


def read_template(spark: SparkSession, path: str, default: str | None = None) -> str:
    """A text file whole; without it the default, or FileNotFoundError if there is none."""
    if not exists(spark, path):
        if default is None:
            raise FileNotFoundError(path)
        return default
    return spark.read.text(path, wholetext=True).first()[0]


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    """Elements ``row_tag`` of XML files as rows; an empty path is a ValueError."""
    if not path:
        raise ValueError("no path")
    reader = spark.read.option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).xml(path)
