"""Readers: project folders, records, chat rows, texts and images. Files are listed and read by Spark alone, so any
store that Spark reaches will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Spark, snake
from ..operators.normalise import RAW_SCHEMA

# Image endings in the order in which a sketch is looked for, and their types.
IMAGE_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp"}
# Fields of a configuration that training rows leave out.
LEFT_OUT = ("imageUrl", "purchaseUrl", "ebayUrl", "amazonUrl", "aliexpressUrl", "research", "partId")

_SLUG = r"/([^/]+?)(?:_files)?/[^/]*$"


def read_configs(spark: SparkSession, root: str, prune: bool = False) -> DataFrame:
    """Raw configurations (RAW_SCHEMA) of all project folders below root: <slug>_files/<name>_CONFIG.json, the first by
    name if a folder has several. Only the fields of the schema are parsed. With prune, fields that training rows
    leave out are null. A file that is no JSON gives a row of nulls but for its slug; folders without a file give none."""
    files = spark.read.option("pathGlobFilter", "*_CONFIG.json").option("recursiveFileLookup", "true").text(root, wholetext=True)
    files = files.select(F.col("_metadata.file_path").alias("path"), "value").withColumn("slug", F.regexp_extract(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), _SLUG, 1))
    first = files.groupBy("slug").agg(F.min("path").alias("path"))
    files = files.join(first, ["slug", "path"])
    schema = RAW_SCHEMA.replace("slug string, ", "")
    raw = files.select("slug", F.from_json("value", schema).alias("r")).select("slug", "r.*")
    if prune:
        nodes = raw.schema["nodes"].dataType.elementType.names
        raw = raw.withColumn("nodes", F.transform("nodes", lambda n: F.struct(*[(F.lit(None).cast("string") if k in LEFT_OUT else n[k]).alias(k) for k in nodes])))
    return raw


def read_records(spark: SparkSession, schema: str, *roots: str, tolerant: bool = False) -> DataFrame:
    """Canonical records of JSON files, a record a file. src counts the roots, so that seeds come before variants, and
    file is the name to sort by. Tolerant: files that can't be read are skipped, else they fail."""
    out = None
    for i, root in enumerate(roots):
        mode = "DROPMALFORMED" if tolerant else "FAILFAST"
        df = spark.read.schema(schema).option("multiLine", "true").option("mode", mode).option("pathGlobFilter", "*.json").json(root)
        df = df.select("*", F.lit(i).alias("src"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
        out = df if out is None else out.unionByName(df)
    return out


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON lines file or folder; lines that are no such rows are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, text) of whole text files."""
    return spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("value").alias("text"))


def _images(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    rank = F.coalesce(*[F.when(ending == e, F.lit(i)) for i, e in enumerate(IMAGE_TYPES)])
    kind = F.coalesce(*[F.when(ending == e, F.lit(t)) for e, t in IMAGE_TYPES.items()])
    return files.withColumn("rank", rank).withColumn("mime", kind).where("rank is not null")


def read_data_uris(spark: SparkSession, root: str) -> DataFrame:
    """(path, uri): images as data URIs, their type by the ending of the name."""
    plain = F.translate(F.base64("content"), "\r\n", "")
    return _images(spark, root).select("path", F.concat(F.lit("data:"), "mime", F.lit(";base64,"), plain).alias("uri"))


def find_sketches(spark: SparkSession, root: str) -> DataFrame:
    """(slug, path): the sketch of each project, <slug>.<ending>, png before jpg before jpeg before webp. Only names
    are read."""
    found = _images(spark, root).select("path", "rank", F.regexp_extract("path", r"/([^/]+)\.[^./]+$", 1).alias("slug"))
    return found.groupBy("slug").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def project_slugs(spark: SparkSession, root: str) -> DataFrame:
    """(slug, folder_id): project folders that hold a file, and the identifiers that records know them by."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_extract("path", r"/([^/]+)_files/[^/]*$", 1).alias("slug"))
    return files.where("slug <> ''").distinct().select("slug", F.expr(snake(Spark(), "slug")).alias("folder_id"))
