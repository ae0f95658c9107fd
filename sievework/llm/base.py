"""Shared plumbing: tables written to the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Unset, a temporary folder, for local sessions only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sievework-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


@contextlib.contextmanager
def _shuffles_end_with_queries(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files are deleted when it ends, not when the driver's garbage is next collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and a lost executor costs no
    recomputation of what stands before. Stays until release()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sievework/{label}-{uuid.uuid4().hex}"
    with _shuffles_end_with_queries(spark):
        df.write.option("compression", "zstd").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most n rows of df, those of least hash of key: a sample that is the same however df is partitioned. Rows
    that can't be among them are left out where they are read, so tasks send about n rows altogether, not n each."""
    total = df.count()
    share = min(1.0, (n + 8 * n**0.5 + 20) / max(total, 1))
    at = F.xxhash64(key)
    near = df if share == 1.0 else df.where(at <= int(-(2**63) + share * (2**64 - 1)))
    return near.orderBy(at, key).limit(n)


def free_name(columns: list[str], name: str) -> str:
    """name, lengthened until no column begins with it."""
    while any(c.lower().startswith(name) for c in columns):
        name += "_"
    return name


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete what stage() wrote so far (but for the last keep tables). Call it once the results that
    read those tables have themselves been written. The driver's JVM then gives up plans and generated classes of
    the queries that ended, which else stay until its heap is full."""
    while len(_STAGED) > keep:
        drop_folder(spark, _STAGED.pop(0))
    gc.collect()
    spark._jvm.System.gc()


def text_of(column: str = "text"):
    """A text column in which null reads as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ddl(schema: pa.Schema) -> str:
    """Spark DDL of an Arrow schema with simple types."""
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.float64(): "double", pa.bool_(): "boolean"}
    kinds = lambda t: f"array<{names[t.value_type]}>" if pa.types.is_list(t) else names[t]
    return ", ".join(f"`{f.name}` {kinds(f.type)}" for f in schema)
