"""Session builder, tables in the shared folder and size-checked joins shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only if its measured rows take at most this many bytes.
BROADCAST_BYTES = 16 << 20


def build_session(app: str = "gleaner", cores: int | str = "*", partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A local session with the settings every operator expects (UTC, AQE with skew joins, Arrow).

    ``shared`` is the folder for written intermediate tables (``spark.checkpoint.dir``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    return (builder.config("spark.checkpoint.dir", shared) if shared else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local master (one machine, as in tests) gets a folder of
    its own; any other master is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        spark.conf.set("spark.checkpoint.dir", path)
        atexit.register(_remove, path[7:])
    return path


def _remove(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as that file system knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def materialize(df: DataFrame, name: str = "t", *by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder, in a folder for each value of ``by``, and read it back.

    This cuts lineage in a way that survives the loss of executors, keeps column
    pruning for later readers and never pins executor memory. The table goes when
    ``discard`` is called on it, else when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gleaner-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._gleaner_path = path
    return out


def counted(df: DataFrame, name: str = "t", *also: Column) -> tuple[DataFrame, dict]:
    """``materialize`` with the count of its rows (``n``) and other aggregates, observed in the same job."""
    seen = Observation()
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("n"), *also), name)
    return table, seen.get


def discard(*tables: DataFrame | None) -> None:
    """Delete materialised tables that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_gleaner_path", None) if t is not None else None
        if path:
            fs, p = hadoop_path(t.sparkSession, path)
            fs.delete(p, True)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row in memory: eight per field, and the lengths of strings and arrays on top."""
    total = F.lit(8 * len(schema) + 16).cast("bigint")
    for f in schema:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            total += F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 8
        elif isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            each = F.lit(8) if not isinstance(inner, T.StringType) else None
            n = F.coalesce(F.array_size(f"`{f.name}`"), F.lit(0))
            total += n * each + 16 if each is not None else F.octet_length(F.coalesce(F.array_join(f"`{f.name}`", ""), F.lit(""))) + 24 * n + 16
        elif isinstance(f.dataType, T.StructType | T.MapType):
            total += F.octet_length(F.coalesce(F.to_json(f"`{f.name}`"), F.lit("")))
    return total


def table_bytes(df: DataFrame) -> int:
    """Measured bytes of a table's rows; one aggregate over it, so it should be a written table."""
    return df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0


def sized_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose right side (unique by ``keys``) is broadcast only if its measured bytes allow.

    ``right`` should be a written table, as its bytes are measured first. Above
    ``BROADCAST_BYTES`` both sides are shuffled; a key that holds a third of the left
    rows is then split over tasks by the adaptive skew join, which repeats only the
    right rows of that key.
    """
    if table_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), keys, how)
    return left.join(right.hint("merge"), keys, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table as a DataFrame."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def blank_to_null(c: Column) -> Column:
    """NULL for text that is empty or only white space (U+00A0 included)."""
    return F.when(F.length(F.regexp_replace(c, r"(?U)\s+", "")) > 0, c)
