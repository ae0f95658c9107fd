"""Hilbert-curve sharding: rows close in several metadata dimensions land in the same file."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import stage, text_of


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of axes (n x d, values below 2**bits)."""
    x = axes.astype(np.int64).T.copy()
    d = x.shape[0]
    q = 1 << (bits - 1)
    while q > 1:  # undo excess rotation, from the coarsest bit down
        low = q - 1
        for i in range(d):
            hit = (x[i] & q) != 0
            x[0] = np.where(hit, x[0] ^ low, x[0])
            t = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] ^= t
            x[i] ^= t
        q >>= 1
    for i in range(1, d):  # Gray code over the axes
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _codes(df: DataFrame, column: str, levels: int):
    """A level for each value: null 0, the levels - 1 most frequent values levels of their own in value order, every
    other value the level of its hash among them, so that its rows stay together whatever their number."""
    top = df.groupBy(column).count().where(F.col(column).isNotNull()).orderBy(F.desc("count"), column).limit(levels - 1)
    values = sorted(r[0] for r in top.collect())  # at most levels - 1 rows
    if not values:
        return F.lit(0)
    pairs = [F.lit(x) for k, v in enumerate(values) for x in (v, k + 1)]
    other = F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(column), F.lit(levels - 1)).cast("int") + 1)
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), other)


def shard_documents(docs: DataFrame, shards: int = 24, bits: int = 5, run_rows: int = 20_000) -> DataFrame:
    """Deal documents into equal shards along a Hilbert curve over (source, lang, size).

    Each dimension is quantised to 2**bits levels (sources and languages by a dictionary of the most
    frequent values and a hash of the others, sizes by approximate quantiles); rows are ordered by curve index, then by a hashed
    sub-run, then doc_id, and the order is cut into `shards` runs whose counts differ by one at most.

    The global rank needs no single sorted partition: curve cells are bounded (2**(3 * bits)) and a cell
    of more than run_rows rows is split into hashed sub-runs, so a hot source never meets in one task.

    Null text: size 8 and the checksum of the empty text. Null source or lang: code 0. Null or repeated
    doc_id: ranked like any other (ties by checksum; equal rows are interchangeable). No rows: none.
    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.
    """
    text = text_of()
    slim = stage(
        docs.select(
            "doc_id",
            "source",
            "lang",
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        ),
        "shard-rows",
    )
    levels = 1 << bits
    cuts = slim.select(F.percentile_approx("size", [i / levels for i in range(1, levels)], 10_000)).first()[0] or []
    size_code = sum((F.when(F.col("size") > int(c), 1).otherwise(0) for c in cuts), F.lit(0))

    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack([a, b, c]), bits))

    coded = slim.select(
        "doc_id",
        "size",
        "text_crc32",
        curve(_codes(slim, "source", levels), _codes(slim, "lang", levels), size_code).alias("curve"),
    )
    cells = coded.groupBy("curve").agg(F.count(F.lit(1)).alias("cell_rows"))
    runs = cells.select("curve", F.ceil(F.col("cell_rows") / run_rows).alias("runs"))
    coded = stage(
        coded.join(runs, "curve").withColumn("run", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.col("runs"))).drop("runs"),
        "shard-cells",
    )
    counts = coded.groupBy("curve", "run").agg(F.count(F.lit(1)).alias("n"))
    before_cell = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # 2**(3*bits) rows at most
    before_run = Window.partitionBy("curve").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    cell_base = cells.select("curve", F.coalesce(F.sum("cell_rows").over(before_cell), F.lit(0)).alias("cell_base"))
    bases = counts.withColumn("run_base", F.coalesce(F.sum("n").over(before_run), F.lit(0))).join(cell_base, "curve")
    bases = bases.select("curve", "run", (F.col("cell_base") + F.col("run_base")).alias("base"))
    total = coded.count()
    within = Window.partitionBy("curve", "run").orderBy("doc_id", "text_crc32", "size")
    ranked = coded.withColumn("rank_in_run", F.row_number().over(within) - 1).join(bases, ["curve", "run"])
    rank = F.col("base") + F.col("rank_in_run")
    ranked = ranked.withColumn("rank", rank).withColumn("shard", F.expr(f"cast(rank * {shards}L div {max(total, 1)}L as int)"))
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
