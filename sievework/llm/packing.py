"""Mixture-controlled packing: deficit round-robin over source queues into fixed-length sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import ddl, stage, text_of
from .tokens import default_paths, encoder

_REST = "\x00rest"


@dataclass
class Phase:
    """A run of equal windows. Queues stand in a fixed order; in window w of the phase, queue k takes the
    tokens between floor(w * W * P[k]) - floor(w * W * P[k-1]) and the same at w + 1, P the running sum of
    the shares: its deficit stays below one token and is carried from window to window."""

    first_window: int
    windows: int
    queues: list[int]
    bounds: list[int]  # numerators of the running shares, from 0
    scale: int  # their denominator
    taken: dict[int, int] = field(default_factory=dict)  # by queue, before the phase
    quota: dict[int, int] | None = None  # of a single, explicit window


def _shares(queues: list[int], target: dict[int, Fraction], width: int) -> tuple[list[int], int]:
    """Running integer shares; no queue has less than one token in a window."""
    total = sum(target[q] for q in queues)
    raw = [max(int(target[q] * width * 1000 / total), 1000) for q in queues]
    bounds = [0]
    for r in raw:
        bounds.append(bounds[-1] + r)
    return bounds, bounds[-1]


def schedule(tokens: dict[int, int], target: dict[int, Fraction], width: int) -> list[Phase]:
    """Deficit round-robin over queues with `tokens` each, in windows of `width` tokens.

    While every queue can serve its share, windows follow a closed form, so the schedule holds one phase
    for each time that queues run dry, however many windows there are. A window that some queue can't
    fill is written out: what is missing goes round the queues that still have tokens, by their shares.
    """
    left = {q: n for q, n in sorted(tokens.items()) if n > 0}
    taken = {q: 0 for q in left}
    phases: list[Phase] = []
    window = 0
    while left:
        queues = list(left)
        bounds, scale = _shares(queues, target, width)
        served = lambda k, w: w * width * bounds[k + 1] // scale - w * width * bounds[k] // scale  # noqa: E731, B023
        lo, hi = 0, sum(left.values()) // width
        while lo < hi:  # the most windows that all queues can serve in full
            mid = (lo + hi + 1) // 2
            if all(served(k, mid) <= left[q] for k, q in enumerate(queues)):
                lo = mid
            else:
                hi = mid - 1
        if lo:
            phases.append(Phase(window, lo, queues, bounds, scale, dict(taken)))
            window += lo
            for k, q in enumerate(queues):
                taken[q] += served(k, lo)
                left[q] -= served(k, lo)
        room, quota = min(width, sum(left.values())), {}
        for k, q in enumerate(queues):
            quota[q] = min(left[q], served(k, 1), room)
            room -= quota[q]
        while room:
            able = [q for q in queues if left[q] > quota[q]]
            fair = max(room // len(able), 1)
            for q in able:
                more = min(left[q] - quota[q], fair, room)
                quota[q] += more
                room -= more
        if any(quota.values()):
            phases.append(Phase(window, 1, queues, bounds, scale, dict(taken), quota))
            window += 1
            for q in queues:
                taken[q] += quota[q]
                left[q] -= quota[q]
        left = {q: n for q, n in left.items() if n}
    return phases


class Layout:
    """Where each token of each queue goes."""

    def __init__(self, tokens: dict[int, int], target: dict[int, Fraction], width: int, length: int):
        self.width, self.length, self.total = width, length, sum(tokens.values())
        self.runs: dict[int, list[tuple]] = {}
        for p in schedule(tokens, target, width):
            at = 0
            for k, q in enumerate(p.queues):
                if p.quota is not None:
                    if p.quota[q]:
                        self.runs.setdefault(q, []).append((p.taken[q], p.taken[q] + p.quota[q], p.first_window * width + at, None))
                    at += p.quota[q]
                else:
                    lo, hi = p.bounds[k], p.bounds[k + 1]
                    n = p.windows * width * hi // p.scale - p.windows * width * lo // p.scale
                    if n:
                        self.runs.setdefault(q, []).append((p.taken[q], p.taken[q] + n, p.first_window * width, (lo, hi, p.scale)))
        self.starts = {q: [r[0] for r in runs] for q, runs in self.runs.items()}
        self.full = self.total - self.total % length
        self.tail: list[tuple[int, int, int]] = []  # (first position, length, sequence): powers of two
        at, seq, rest = self.full, self.full // length, self.total % length
        while rest:
            size = 1 << (rest.bit_length() - 1)
            self.tail.append((at, size, seq))
            at, seq, rest = at + size, seq + 1, rest - size

    def stretches(self, queue: int, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """(global position, length) of the tokens start..stop of a queue, in order."""
        from bisect import bisect_right

        i = bisect_right(self.starts[queue], start) - 1
        while start < stop:
            begin, end, base, form = self.runs[queue][i]
            upto = min(stop, end)
            if form is None:
                yield base + start - begin, upto - start
            else:
                lo, hi, scale = form
                width = self.width
                served = lambda w: w * width * hi // scale - w * width * lo // scale  # noqa: E731, B023
                o, last = start - begin, upto - begin
                w = max(o * scale // (width * (hi - lo)) - 1, 0)
                while served(w + 1) <= o:
                    w += 1
                while o < last:
                    nxt = min(served(w + 1), last)
                    inside = (w + 1) * width * lo // scale - w * width * lo // scale
                    if nxt > o:
                        yield base + w * width + inside + o - served(w), nxt - o
                    o, w = nxt, w + 1
            start, i = upto, i + 1

    def pieces(self, queue: int, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of the tokens start..stop of a queue, in order."""
        for at, n in self.stretches(queue, start, stop):
            while n:
                if at < self.full:
                    seq, off = divmod(at, self.length)
                    size = self.length
                else:
                    first, size, seq = next(t for t in self.tail if t[0] <= at < t[0] + t[1])
                    off = at - first
                step = min(n, size - off)
                yield seq, off, step
                at, n = at + step, n - step


_TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
)
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("queue", pa.int64()),
    ]
)


def tokenize(docs: DataFrame, json_path: str, ranks_path: str | None) -> DataFrame:
    """(doc_id, source, part, first, n, ids): ids with the closing id 0; first: how many ids of the same
    source stand before the document's in its part (input split)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(json_path, ranks_path)
        end = b"\0" * (4 if enc.wide else 2)
        part = TaskContext.get().partitionId()
        before: dict[str | None, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000).to_pydict()
                ids = [enc.encode(t) + end for t in rows["text"]]
                counts = [len(x) // len(end) for x in ids]
                first = []
                for s, n in zip(rows["source"], counts, strict=True):
                    first.append(before.get(s, 0))
                    before[s] = first[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip((rows["doc_id"], rows["source"], [part] * len(ids), first, counts, ids), _TOKENS, strict=True)],
                    schema=_TOKENS,
                )

    return docs.select("doc_id", text_of().alias("text"), "source").mapInArrow(run, ddl(_TOKENS))


def pack(
    docs: DataFrame,
    length: int = 1024,
    window_sequences: int = 16,
    weights: dict[str, float] | None = None,
    max_queues: int = 256,
    json_path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """Pack documents into sequences of `length` ids whose sources follow target proportions.

    Each source is a queue of ids (documents in table order, id 0 after each). Windows of
    window_sequences sequences are filled by deficit round-robin: a queue's share of a window follows its
    target (`weights` by source; a source without one, its share of all ids), fractions are carried to
    the next window, and when a queue runs dry the others share its room. Documents are cut where a share
    or a sequence ends. Every sequence is full; what remains at the end is cut into sequences whose
    lengths are powers of two, so nothing is padded.

    Weighted sources, then the largest, max_queues - 1 in all, have queues of their own; further ones share one queue,
    source after source, whose target is their share of all ids, so the schedule has a fixed size. Ids are computed once and written; prefix sums run over
    (part, source) totals, and each piece follows from its document's place in its queue in closed form,
    so no task holds a queue, hot or not.

    Null text: empty, one id 0. Null source: a queue like others. Null or repeated doc_id: each row is
    packed. No rows: none. Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue.
    """
    if json_path is None:
        json_path, ranks_path = default_paths()
    toks = stage(tokenize(docs, json_path, ranks_path), "tokens")
    totals = toks.groupBy("source", "part").agg(F.sum("n").alias("n"))
    by_source = totals.groupBy("source").agg(F.sum("n").alias("n"))
    weights = weights or {}
    if len(weights) > max_queues - 1:
        raise ValueError(f"{len(weights)} weighted sources need as many queues; max_queues is {max_queues}")
    named = F.coalesce(F.col("source").isin([w for w in weights if w is not None]), F.lit(None in weights)) if weights else F.lit(False)
    top = by_source.orderBy(F.desc(named), F.desc("n"), F.col("source").asc_nulls_first()).limit(max_queues - 1).collect()
    own = {r["source"]: i for i, r in enumerate(top)}
    sizes = {own[r["source"]]: r["n"] for r in top}
    everything = by_source.agg(F.sum("n")).first()[0] or 0
    rest = max_queues - 1
    if everything > sum(sizes.values()):
        sizes[rest] = everything - sum(sizes.values())
    target = {q: Fraction(n, max(everything, 1)) for q, n in sizes.items()}
    for source, w in weights.items():
        if source in own:
            target[own[source]] = Fraction(w).limit_denominator(10**6)
    layout = Layout(sizes, target, length * window_sequences, length)

    pairs = [F.lit(x) for s, i in own.items() if s is not None for x in (s, i)]
    queue = F.element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None).cast("int")
    queue = F.coalesce(F.when(F.col("source").isNull(), F.lit(own.get(None, rest))).otherwise(queue), F.lit(rest)).cast("long")
    before = Window.partitionBy("queue").orderBy("source", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("queue", queue).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bases = bases.select(F.col("part").alias("b_part"), F.col("source").alias("b_source"), "queue", "base")
    placed = toks.join(bases, (toks.part == bases.b_part) & toks.source.eqNullSafe(bases.b_source))
    placed = placed.select("doc_id", "queue", (F.col("base") + F.col("first")).alias("at"), "n", "ids")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                rows = batch.slice(lo, 2000).to_pydict()
                out: list[tuple] = []
                for doc, q, at, n, ids in zip(*(rows[c] for c in ("doc_id", "queue", "at", "n", "ids")), strict=True):
                    size = len(ids) // n
                    wide = ids if size == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    start = 0
                    for seq, off, step in layout.pieces(q, at, at + n):
                        out.append((doc, start, step, zlib.crc32(wide[4 * start : 4 * (start + step)]), n, seq, off, q))
                        start += step
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return placed.mapInArrow(cut, ddl(_PIECES))
