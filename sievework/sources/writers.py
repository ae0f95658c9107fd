"""Writers: chat rows, splits, record files, part lists, guides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab


def chat_rows(rows: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(chat, stats) of rows (pos, system, user, assistant, tag): the first row, by pos, of each input as
    messages array<struct<role, content>>, with a place in a seeded order; and by tag the rows written and dropped.

    Inputs are the same if system and user are, but for case and white space. The order is that of a hash with the
    seed: the same for the same rows, however they are partitioned."""
    space = r"\s+"
    text = F.trim(F.regexp_replace(F.lower(F.concat(F.col("system"), F.lit("||"), F.col("user"))), space, " "))
    marked = rows.withColumn("fp", F.sha2(text, 256))
    kept = marked.groupBy("fp").agg(F.min_by(F.struct("pos", "system", "user", "assistant", "tag"), "pos").alias("r"), F.count(F.lit(1)).alias("n"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    messages = F.array(turn("system", F.col("r.system")), turn("user", F.trim("r.user")), turn("assistant", F.col("r.assistant")))
    chat = kept.select(messages.alias("messages"), F.col("r.tag").alias("tag"), F.xxhash64(F.lit(seed), "fp").alias("place"))
    dropped = marked.groupBy("tag").agg(F.count(F.lit(1)).alias("rows"))
    written = kept.groupBy(F.col("r.tag").alias("w_tag")).agg(F.count(F.lit(1)).alias("written"))
    stats = dropped.join(written, F.col("tag").eqNullSafe(F.col("w_tag")), "left").select("tag", F.coalesce("written", F.lit(0)).alias("written"), (F.col("rows") - F.coalesce("written", F.lit(0))).alias("duplicates_dropped"))
    return chat, stats


def write_chat(chat: DataFrame, path: str) -> None:
    """Chat rows as JSON lines in their seeded order."""
    chat.orderBy("place").select(F.to_json(F.struct("messages")).alias("value")).write.mode("overwrite").text(path)


def to_alpaca(chat: DataFrame) -> DataFrame:
    """(instruction, input, output): the last message of each role."""
    last = lambda role: F.coalesce(F.try_element_at(F.filter("messages", lambda m: m["role"] == role), F.lit(-1))["content"], F.lit(""))
    return chat.select(last("system").alias("instruction"), last("user").alias("input"), last("assistant").alias("output"), "*")


def write_splits(chat: DataFrame, path: str, alpaca: bool = False) -> None:
    """Rows with a column split as JSON lines, a folder a split."""
    body = F.to_json(F.struct("instruction", "input", "output")) if alpaca else F.to_json(F.struct("messages"))
    df = to_alpaca(chat) if alpaca else chat
    df.select("split", body.alias("value")).write.mode("overwrite").partitionBy("split").text(path)


def write_records(records: DataFrame, path: str, force: bool = False) -> None:
    """Records as JSON, a folder a record, named by its identifier. A record that has been written before is left as
    it is, unless forced."""
    df = records.withColumn("project_id", F.col("project.project_id"))
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    if there and not force:
        known = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", r"/project_id=([^/]+)/", 1).alias("k")).distinct()
        df = df.join(known, df.project_id == known.k, "left_anti")
    out = df.select("project_id", F.to_json(F.struct(*records.columns)).alias("value"))
    out.write.mode("overwrite" if force else "append").option("partitionOverwriteMode", "dynamic").partitionBy("project_id").text(path)


def parts_csv(records: DataFrame) -> DataFrame:
    """(project_id, value): each record's part list, numbers plain and texts quoted, money with two places."""
    text = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    line = lambda x: F.concat_ws(",", text(x["component_id"]), text(x["product_name"]), x["quantity"].cast("string"), text(x["unit_cost_usd"].cast("decimal(18,2)").cast("string")), text(x["total_cost_usd"].cast("string")))
    head = F.lit('"component_id","product_name","quantity","unit_cost_usd","total_cost_usd"')
    return records.select(F.col("project.project_id").alias("project_id"), F.concat_ws("\n", F.array(head), F.transform("sourcing.items", line)).alias("value"))


def guides(records: DataFrame) -> DataFrame:
    """(project_id, value): each record's guide: sections for the phases in the order in which they first appear, steps
    numbered within them, their parts and whole bodies; a step without a body says so."""
    phases = "array_distinct(transform(instructions, s -> s.phase))"
    body = f"coalesce(nullif(trim(s.detail), ''), '{vocab.PLACEHOLDER}')"
    parts = "IF(size(s.component_ids) > 0, concat('Parts: ', concat_ws(', ', s.component_ids)), NULL)"
    step = f"concat_ws('\\n', concat('### ', cast(p.n + 1 as string), '.', cast(j + 1 as string), ' ', s.title), {parts}, {body})"
    section = f"concat_ws('\\n\\n', concat('## ', cast(p.n + 1 as string), '. ', p.name), transform(filter(instructions, s -> s.phase = p.name), (s, j) -> {step}))"
    text = f"concat_ws('\\n\\n', concat('# ', project.name), transform(transform({phases}, (q, n) -> named_struct('name', q, 'n', n)), p -> {section}))"
    return records.select(F.col("project.project_id").alias("project_id"), F.expr(text).alias("value"))


def write_texts(texts: DataFrame, path: str) -> None:
    """(project_id, value) as text, a folder a project."""
    texts.select("project_id", "value").write.mode("overwrite").partitionBy("project_id").text(path)
