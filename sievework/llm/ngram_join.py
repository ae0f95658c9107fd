"""Exact Jaccard self-join of documents by word shingles, with an R-tree over count vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import ddl, stage, text_of
from .components import components

_U = np.uint64
_K = [_U(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_BITMAP = 8_388_593  # a prime: positions of the id filter, 1 MB whatever the input
GROUPS = 64  # coordinates of a count vector


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _K[1]
    x = (x ^ (x >> _U(29))) * _K[3]
    return x ^ (x >> _U(32))


class _Words(dict):
    """64-bit hash of each word, computed once while the cache lasts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str, words: _Words, size: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. Bytes lower-case A-Z alone and split at the six ASCII spaces."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, parts), np.uint64, n)
    k = min(size, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _K[0] + w[i : n - k + 1 + i]
    h = np.sort(_mix(h))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _bands(percent: int) -> list[int]:
    """Lower bounds of the size bands; each is half as long again as the one before."""
    out = [1, 2, 3, 4]
    while out[-1] < 1 << 31:
        out.append(out[-1] * 3 // 2)
    return out


class Blocks:
    """Pigeonhole keys of a shingle set: sets that link agree on a key.

    With similarity percent/100 = t, sets x and y of a link differ in at most (|x| + |y|) * (1-t)/(1+t)
    shingles, D at most for the sizes of a band. Shingles fall by hash into D + 1 + q blocks, so q + 1
    blocks at least hold the same shingles in both. Each set leaves out its q weakest blocks (fewest
    shingles, then lowest number). The strongest common block stands in neither set's q weakest, or all
    q + 1 common ones would; so nothing is lost, and blocks that say little make no keys.
    A set gives keys for its own band and for the next one if a partner may lie there.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = np.array(_bands(percent))

    def plan(self, band: int) -> tuple[int, int]:
        """(blocks, left out) in a band."""
        top = int(self.lows[band + 1]) - 1
        d = 2 * top * (100 - self.percent) // (100 + self.percent)
        q = 3 * (d + 1) // 10
        return d + 1 + q, q

    def keys(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        if not n:
            return np.zeros(0, np.int64)
        out, v = [], (s * _K[2]) ^ (s >> _U(32))
        own = int(np.searchsorted(self.lows, n, "right")) - 1
        last = int(np.searchsorted(self.lows, n * 100 // self.percent, "right")) - 1
        for band in range(own, last + 1):
            m, q = self.plan(band)
            at = (s % _U(m)).astype(np.int64)
            counts = np.bincount(at, minlength=m)
            ends = np.cumsum(counts)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v[np.argsort(at, kind="stable")], dtype=np.uint64)])
            sums = total[ends] - total[ends - counts]
            keep = np.argsort(counts, kind="stable")[q:]
            out.append(_mix(sums[keep] * _K[4] + _mix(np.full(1, band, np.uint64)) + keep.astype(np.uint64) * _K[1] + counts[keep].astype(np.uint64)))
        return np.unique(np.concatenate(out)).view(np.int64)


class PackedRTree:
    """A packed R-tree over count vectors. Points stand in order of size; a node keeps the largest count of
    each coordinate and the least size below it. The overlap of x with any set below a node is at most the
    sum over coordinates of min(count of x, largest count), so a node whose bound stays under what a link
    to its smallest set needs is skipped with all below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fan: int = 16):
        self.fan = fan
        self.levels = [(points, sizes)]
        while len(self.levels[-1][0]) > fan:
            p, n = self.levels[-1]
            starts = np.arange(0, len(p), fan)
            self.levels.append((np.maximum.reduceat(p, starts), np.minimum.reduceat(n, starts)))

    def search(self, x: np.ndarray, size: int, percent: int, first: int, skip) -> np.ndarray:
        """Points from `first` on whose bound allows a link with x; skip(level, nodes): those not to visit."""
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            span = self.fan**level
            nodes = nodes[(nodes + 1) * span > first]
            nodes = nodes[~skip(level, nodes)]
            p, n = self.levels[level]
            bound = np.minimum(p[nodes], x).sum(1, dtype=np.int64)
            nodes = nodes[bound * (100 + percent) >= percent * (n[nodes] + size)]
            if level:
                nodes = (nodes[:, None] * self.fan + np.arange(self.fan)).ravel()
                nodes = nodes[nodes < len(self.levels[level - 1][0])]
        return nodes


def count_vector(s: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount((s >> _U(40)).astype(np.int64) % groups, minlength=groups).astype(np.int32)


def spanning_links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what links connect: every pair that might link is verified, but for pairs that
    verified links connect already."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    points = np.array([count_vector(sets[i]) for i in order])
    tree = PackedRTree(points, sizes)
    group = np.arange(len(order))

    out = []
    for i in range(len(order) - 1):
        own = group[i]

        def skip(level: int, nodes: np.ndarray) -> np.ndarray:
            if level == 0:
                return group[nodes] == group[i]  # noqa: B023
            if level > 1:
                return np.zeros(len(nodes), bool)
            lo, hi = nodes * tree.fan, np.minimum((nodes + 1) * tree.fan, len(group))
            cum = np.concatenate([[0], np.cumsum(group != own)])  # noqa: B023
            return cum[hi] == cum[lo]

        x = sets[order[i]]
        near = tree.search(points[i], int(sizes[i]), percent, i + 1, skip)
        for j in near[near > i]:
            if group[j] != group[i]:
                y = sets[order[j]]
                pos = np.searchsorted(y, x)
                both = int((y[np.minimum(pos, len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((ids[order[i]], ids[order[j]]))
                    group[group == group[j]] = group[i]
    return out


_KEYED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig_a", pa.int64()), ("sig_b", pa.int64()), ("keys", pa.list_(pa.int64()))])
_SETS = pa.schema([("s_id", pa.int64()), ("shingles", pa.binary())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _keyed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, blocks = _Words(), Blocks(percent)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts, sig_a, sig_b, keys, ends = [], [], [], [], [0]
                for text in part.column(1):
                    s = shingles(text.as_py(), words, size)
                    counts.append(len(s))
                    sig_a.append(int((s * _K[3]).sum(dtype=np.uint64).astype(np.int64)))
                    sig_b.append(int(np.bitwise_xor.reduce(_mix(s + _K[4])).astype(np.int64)) if len(s) else 0)
                    keys.append(blocks.keys(s))
                    ends.append(ends[-1] + len(keys[-1]))
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(sig_a, pa.int64()), pa.array(sig_b, pa.int64()), listed], schema=_KEYED)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, ddl(_KEYED))


def _id_filter(ids: DataFrame) -> bytes:
    """A bitmap of ids modulo a prime: 1 MB at most, a superset of the ids."""
    at = F.pmod("s_id", F.lit(_BITMAP))
    words = ids.select(at.alias("at")).groupBy(F.expr("at div 32").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits"))
    bits = np.zeros(_BITMAP // 32 + 1, np.uint32)
    for r in words.toLocalIterator():
        bits[r.w] = r.bits
    return bits.tobytes()


def near_copies(docs: DataFrame, size: int = 3, percent: int = 90, chunk: int = 2000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: component_id is the smallest doc_id that links
    reach, a link being 100 * intersection >= percent * union of two sets of distinct `size`-word shingles.

    1. Documents of equal sets are one from here on, by the smallest doc_id: a large group of copies costs one row.
       Each set gives pigeonhole keys (see Blocks); sets that share one are chained to the smallest. Connected,
       these give clusters that no link leaves.
    2. In each cluster the sets are compared: an R-tree over vectors of GROUPS
       counts bounds the overlap, and pairs that survive are verified on the sets. Pairs that are already
       connected are passed over, so a large group of near copies costs no quadratic output. A cluster of
       more than `chunk` sets is dealt to tasks by pairs of chunks, each with two chunks at most.
    3. Connected components over the verified links.

    Null or empty text or no word: 0 shingles, linked with nothing. Null doc_id: counted, component null.
    Rows that repeat a doc_id are one document; it links if one of its rows does. No rows: none.
    """
    keyed = stage(_keyed(docs, size, percent), "shingle-keys")
    same = ["sig_a", "sig_b", "n_shingles"]
    slim = keyed.where("n_shingles > 0 and doc_id is not null").select("doc_id", *same)
    sets = slim.groupBy(*same).agg(F.min("doc_id").alias("rep"))  # equal sets are one, before any key is dealt out
    heads = keyed.join(sets, [*same], "inner").where("doc_id = rep").select("rep", F.explode("keys").alias("key"))
    least = F.first("rep").over(Window.partitionBy("key").orderBy("rep"))
    chains = heads.select("rep", least.alias("head")).where("rep <> head").distinct()
    clusters = stage(components(chains, "rep", "head").select(F.col("node").alias("c_id"), F.col("component").alias("cluster")), "clusters")
    many = clusters.groupBy(F.col("cluster").alias("m_cluster")).agg(F.count(F.lit(1)).alias("m"))
    reps = stage(clusters.join(many, clusters.cluster == many.m_cluster).select("cluster", F.col("c_id").alias("rep"), "m"), "cluster-sets")
    wanted = docs.sparkSession.sparkContext.broadcast(_id_filter(reps.select(F.col("rep").alias("s_id"))))  # 1 MB

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        bits = np.frombuffer(wanted.value, np.uint32)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = ids % _BITMAP
            pick = np.flatnonzero((bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1)
            for lo in range(0, len(pick), 500):
                part = pick[lo : lo + 500]
                found = [shingles(batch.column(1)[int(i)].as_py(), words, size).tobytes() for i in part]
                yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(found, pa.binary())], schema=_SETS)

    texts = docs.where("doc_id is not null").select("doc_id", text_of().alias("text"))
    found = texts.mapInArrow(read, ddl(_SETS))
    pieces = F.greatest(F.ceil(F.col("m") / chunk), F.lit(1)).cast("int")
    dealt = found.join(reps, found.s_id == reps.rep).select("cluster", "rep", "shingles", pieces.alias("p"), F.pmod(F.xxhash64("rep"), pieces).cast("int").alias("c"))
    dealt = dealt.select("cluster", "rep", "shingles", "c", F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias("d"))
    dealt = dealt.select("cluster", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"), "rep", "shingles")

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets_of = None, [], []

        def flush() -> pa.RecordBatch:
            rows = spanning_links(ids, sets_of, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], schema=_LINKS)

        for batch in batches:
            rows = batch.to_pydict()
            for cluster, i, j, rep, s in zip(*(rows[c] for c in ("cluster", "i", "j", "rep", "shingles")), strict=True):
                if (cluster, i, j) != now:
                    if len(ids) > 1:
                        yield flush()
                    now, ids, sets_of = (cluster, i, j), [], []
                ids.append(rep)
                sets_of.append(np.frombuffer(s, np.uint64))
        if len(ids) > 1:
            yield flush()

    grouped = dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "rep")
    links = grouped.mapInArrow(link, ddl(_LINKS))
    placed = stage(slim.join(sets, same).select("doc_id", "rep").distinct(), "set-members")
    # rows of one doc_id that hold several sets are one document: their sets link
    several = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a <> top").select(F.col("doc_id").alias("v_id"), "a")
    links = stage(links, "set-links").unionByName(placed.join(several, placed.doc_id == several.v_id).select("a", F.col("rep").alias("b")))
    joined = components(links)
    found = placed.join(joined, placed.rep == joined.node, "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    found = found.groupBy(F.col("doc_id").alias("p_id")).agg(F.min("component").alias("component"))
    final = keyed.select("doc_id", "n_shingles")
    return final.join(found, final.doc_id == found.p_id, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """docs without the documents that links connect to one of smaller doc_id; columns stay."""
    found = near_copies(docs, size, percent)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
