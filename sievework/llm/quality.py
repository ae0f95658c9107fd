"""Quality and toxicity classifiers by co-training: a text view and a metadata view teach each other."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ddl, first_by_hash, free_name, stage, text_of

_SHAPE = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"\w+")
_GRAMS = 1 << 18  # buckets of words and word pairs
_DENSE = 10
_META = 256


def _byte_classes() -> np.ndarray:
    table = np.full(256, 4, np.uint8)  # punctuation and symbols
    for b in range(256):
        c = chr(b)
        if b >= 128 or "a" <= c <= "z":
            table[b] = 0
        elif "A" <= c <= "Z":
            table[b] = 1
        elif "0" <= c <= "9":
            table[b] = 2
        elif c in " \t\r\n\v\f":
            table[b] = 3
        elif c in ".,;:'\"!?()-":
            table[b] = 5
    return table


_CLASSES = _byte_classes()


def word_bucket(word: str, buckets: int) -> int:
    """Bucket of a word's shape: letters as 'a', what is glued to them kept; so 'of%%%' and 'the%%%' meet."""
    return zlib.crc32(_SHAPE.sub("a", word).encode()) % buckets


class Hashes(dict):
    """Hash of a word, kept while it is small."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


def gram_buckets(text: str, known: Hashes) -> np.ndarray:
    """Buckets of a text's lower-cased words and of its pairs of neighbouring words."""
    words = _WORD.findall(text.lower())
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([h * np.uint64(0x9E3779B97F4A7C15), pairs]) >> np.uint64(46)).astype(np.int64)


def telling_grams(found: list[np.ndarray], y: np.ndarray, least: float = 6.0, most: int = 1024) -> np.ndarray:
    """Buckets that stand in the texts of one label more often than chance allows: a difference of shares of
    `least` standard errors or more, the `most` largest of them."""
    n = [max(int((y == k).sum()), 1) for k in (0, 1)]
    have = [np.bincount(np.concatenate([np.zeros(0, np.int64), *(f for f, k in zip(found, y, strict=True) if k == c)]), minlength=_GRAMS) for c in (0, 1)]
    share = (have[0] + have[1] + 1) / (n[0] + n[1] + 2)
    z = np.abs(have[1] / n[1] - have[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(best[z[best] >= least])


class TextView:
    """Features of a text: hashed word shapes (mean counts), telling words and word pairs (there or not), and ratios
    of characters, words and lines."""

    def __init__(self, buckets: int = 1024, grams: np.ndarray | None = None):
        self.buckets, self.known, self.hashes = buckets, {}, Hashes()
        self.grams = np.zeros(0, np.int64) if grams is None else grams

    def bucket(self, word: str) -> int:
        b = self.known.get(word)
        if b is None:
            if len(self.known) > 200_000:
                self.known.clear()
            b = self.known[word] = word_bucket(word, self.buckets)
        return b

    def dense(self, text: str, words: list[str]) -> list[float]:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        n = max(len(raw), 1)
        c = np.bincount(_CLASSES[raw], minlength=6) / n
        k = max(len(words), 1)
        return [c[1], c[2], c[3], c[4], c[5], len(set(words)) / k, min(sum(map(len, words)) / k, 40) / 20, min((text.count("\n") + 1) / k, 1), math.log1p(k) / 10, float(not words)]

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray, list[float]]:
        words = text.split()
        ids, counts = np.unique(np.fromiter(map(self.bucket, words), np.int64, len(words)), return_counts=True)
        return ids, counts / max(len(words), 1), self.dense(text, words)

    def matrix(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), self.buckets + _DENSE + len(self.grams)), np.float32)
        for i, t in enumerate(texts):
            x[i, self.buckets + _DENSE :] = np.isin(self.grams, gram_buckets(t, self.hashes))
            ids, share, dense = self.features(t)
            x[i, ids] = share
            x[i, self.buckets : self.buckets + _DENSE] = dense
        return x


_LAYOUT = 7


def layout(text: str) -> list[float]:
    """How a text is laid out, whatever it says: lines, how many are blank or repeated, how long they are, bytes a character."""
    lines = text.split("\n")
    full = [x for x in lines if x.strip()]
    n, sizes = max(len(full), 1), list(map(len, full)) or [0]
    size = max(len(text), 1)
    return [math.log1p(len(lines)) / 10, 1 - len(full) / len(lines), 1 - len(set(full)) / n if full else 0.0, math.log1p(sum(sizes) / n) / 10, math.log1p(max(sizes)) / 10, len(text.encode("utf-8", "surrogatepass")) / size / 4, float(not full)]


def meta_row(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Features of what stands beside the text: source, language, length and its order of magnitude; layout follows."""
    x = np.zeros(_META + 2 + _LAYOUT, np.float32)
    x[zlib.crc32(f"s{source}".encode()) % (_META - 48)] = 1
    x[_META - 48 + zlib.crc32(f"l{lang}".encode()) % 32] = 1
    x[_META - 16 + min(max(n_chars or 0, 0).bit_length(), 30) // 2] = 1
    x[_META] = math.log1p(max(n_chars or 0, 0)) / 10
    x[_META + 1] = float(n_chars is None)
    return x


def meta_matrix(rows: list[tuple]) -> np.ndarray:
    """Metadata features of rows (text, source, lang, n_chars, ...)."""
    x = np.zeros((len(rows), _META + 2 + _LAYOUT), np.float32)
    for i, r in enumerate(rows):
        x[i] = meta_row(*r[1:4])
        x[i, _META + 2 :] = layout(r[0])
    return x


@dataclass
class Logistic:
    """Logistic regression with standardised inputs and a ridge."""

    w: np.ndarray
    b: float
    slope: float = 1.0  # Platt's calibration
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 150) -> Logistic:
    """Full-batch accelerated gradient descent; deterministic. Classes count alike."""
    live = (x != 0).any(0)  # a column that is always 0 keeps weight 0
    width, x = x.shape[1], x[:, live]
    scale = np.sqrt((x**2).mean(0)) + 1e-3
    z = x / scale
    weight = np.ones(len(y)) if weight is None else weight
    for k in (0, 1):
        total = weight[y == k].sum()
        weight = np.where(y == k, weight * (0.5 / total if total else 0), weight)
    w, b = np.zeros(x.shape[1]), 0.0
    vw, vb = w.copy(), b
    top, v = 0.0, np.ones(len(y))
    for _ in range(30):  # the largest eigenvalue of the weighted inner products bounds the curvature
        v = np.sqrt(weight) * v
        v = np.sqrt(weight) * (z @ (v @ z) + v.sum())
        top = float(np.linalg.norm(v))
        v /= top or 1.0
    rate = 4 / (top * 1.1 + 4 * ridge + 1e-9)
    for t in range(steps):
        g = weight * (_sigmoid(z @ vw + vb) - y)
        nw, nb = vw - rate * (g @ z + ridge * vw), vb - rate * g.sum()
        k = t / (t + 3)
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    full = np.zeros(width)
    full[live] = w / scale
    return Logistic(full, float(b))


def _calibrate(model: Logistic, x: np.ndarray, y: np.ndarray) -> None:
    """Platt: slope and shift by Newton steps on held-out rows, smoothed targets."""
    if len(set(y.tolist())) < 2:
        return
    s = model.raw(x)
    target = np.where(y == 1, ((y == 1).sum() + 1) / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = _sigmoid(a * s + b)
        h = p * (1 - p) + 1e-9
        g = np.array([((p - target) * s).sum() + 1e-3 * (a - 1), (p - target).sum()])
        hess = np.array([[(h * s * s).sum() + 1e-3, (h * s).sum()], [(h * s).sum(), h.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, g)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    model.slope, model.shift = max(float(a), 0.0), float(b)


@dataclass
class CoTrained:
    """Both views and how their calibrated logits combine: score = sigmoid(mix . (1, text, meta))."""

    text: Logistic
    meta: Logistic
    mix: np.ndarray
    buckets: int
    grams: np.ndarray
    rounds: list[tuple[int, int]]  # pseudo-labels that the text and the metadata view gave, by round

    def score(self, text_logit: np.ndarray, meta_logit: np.ndarray) -> np.ndarray:
        return _sigmoid(self.mix[0] + self.mix[1] * text_logit + self.mix[2] * meta_logit)


def cotrain(labelled: list[tuple], unlabelled: list[tuple], rounds: int = 4, per_round: int = 100, sure: float = 0.9, buckets: int = 1024) -> CoTrained:
    """Co-train on rows (text, source, lang, n_chars[, label]).

    In each round either view gives up to per_round of the unlabelled rows per class, those it is surest of
    and at least `sure`, to the other view's training rows. A fifth of the labelled rows is held out to
    calibrate both views and to weigh their logits. One class only: its constant; no labels: all accepted.
    """
    view = TextView(buckets)
    y = np.array([r[4] for r in labelled], np.int64)
    if len(set(y.tolist())) < 2:
        level = 0.0 if len(y) and y[0] == 0 else 1.0
        empty = lambda n: Logistic(np.zeros(n), 0.0)
        return CoTrained(empty(buckets + _DENSE), empty(_META + 2 + _LAYOUT), np.array([20.0 * (2 * level - 1), 0, 0]), buckets, view.grams, [])
    held = np.arange(len(y)) % 5 == 4
    if min(len(set(y[held].tolist())), len(set(y[~held].tolist()))) < 2:
        held = np.zeros(len(y), bool)
    view.grams = telling_grams([np.unique(gram_buckets(r[0], view.hashes)) for r, h in zip(labelled, held, strict=True) if not h], y[~held])
    xt, xm = view.matrix([r[0] for r in labelled]), meta_matrix(labelled)
    ut, um = view.matrix([r[0] for r in unlabelled]), meta_matrix(unlabelled)
    given = {"text": np.full(len(unlabelled), -1), "meta": np.full(len(unlabelled), -1)}  # labels received from the other view
    train_t, train_m, tally = xt[~held], xm[~held], []

    def fitted(x: np.ndarray, u: np.ndarray, got: np.ndarray) -> Logistic:
        take = got >= 0
        return fit_logistic(np.concatenate([x, u[take]]), np.concatenate([y[~held], got[take]]), np.concatenate([np.ones(len(x)), np.full(take.sum(), 0.5)]))

    on = held if held.any() else ~held
    def both() -> tuple[Logistic, Logistic]:
        """Either view fitted to its rows, its confidence calibrated on the rows held out."""
        a, b = fitted(train_t, ut, given["text"]), fitted(train_m, um, given["meta"])
        _calibrate(a, xt[on], y[on])
        _calibrate(b, xm[on], y[on])
        return a, b

    text, meta = both()
    for _ in range(rounds if len(unlabelled) else 0):
        passed = []
        for giver, x, to in ((text, ut, "meta"), (meta, um, "text")):
            p, before = _sigmoid(giver.logit(x)), given[to] >= 0
            n = 0
            for k, conf in ((1, p), (0, 1 - p)):
                best = np.argsort(-np.where(before, -1, conf), kind="stable")[:per_round]
                best = best[(conf[best] >= sure) & ~before[best]]
                given[to][best] = k
                n += len(best)
            passed.append(n)
        tally.append(tuple(passed))
        if not any(passed):
            break
        text, meta = both()
    views = np.column_stack([text.logit(xt[on]), meta.logit(xm[on])]).astype(np.float64)
    mix = _mix(views, y[on])
    return CoTrained(text, meta, mix, buckets, view.grams, tally)


def _mix(views: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of the two calibrated logits, near (0, 1, 0.5) by a ridge, never negative: views that know
    nothing of each other's errors add up their logits, and a view that knows little has small ones."""
    x, prior = np.column_stack([np.ones(len(y)), views]), np.array([0.0, 1.0, 0.5])
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w)).sum() + 0.5 * ((w - prior) ** 2).sum()
    w = prior
    for _ in range(25):
        p = _sigmoid(x @ w)
        h = p * (1 - p) + 1e-6
        step, pace = np.linalg.solve(x.T @ (x * h[:, None]) + np.eye(3), x.T @ (p - y) + (w - prior)), 1.0
        while pace > 1e-6:  # a whole step may overshoot: take half of it until the loss falls
            to = w - pace * step
            to[1:] = np.maximum(to[1:], 0)
            if loss(to) < loss(w):
                w = to
                break
            pace /= 2
        else:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, labelled_rows: int, unlabelled_rows: int) -> DataFrame:
    """(t_text, t_source, t_lang, t_chars, t_label): bounded samples by hash of doc_id, of rows with a label
    (labels: doc_id, y) and of rows without (-1). Ids are chosen first; only the rows that they name are read whole.
    An id with unlike labels counts as its least."""
    known = labels.where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").cast("int").alias("y"))
    present = docs.select("doc_id").where("doc_id is not null").distinct()
    yes = first_by_hash(known.join(present, "doc_id", "left_semi"), "doc_id", labelled_rows)
    no = first_by_hash(present.join(known, "doc_id", "left_anti"), "doc_id", unlabelled_rows).withColumn("y", F.lit(-1))
    picked = stage(yes.unionByName(no).select(F.col("doc_id").alias("p_id"), F.col("y").alias("t_label")), "quality-ids")
    rows = docs.join(F.broadcast(picked), docs["doc_id"] == picked["p_id"])  # labelled_rows + unlabelled_rows ids at most
    rows = rows.select("p_id", "t_label", text_of().alias("t_text"), F.col("source").alias("t_source"), F.col("lang").alias("t_lang"), F.col("n_chars").cast("long").alias("t_chars"))
    return rows.orderBy(F.xxhash64("p_id"), "t_text").dropDuplicates(["p_id"]).drop("p_id")


_SCORED = pa.schema([("text_score", pa.float64()), ("meta_score", pa.float64()), ("score", pa.float64()), ("toxic_score", pa.float64())])


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = 1500, unlabelled_rows: int = 1500) -> CoTrained:
    """Co-train on bounded samples of the corpus (labelled_rows and unlabelled_rows at most), in one task of an
    executor: texts never come to the driver, only the model does. labels: doc_id, y."""
    sample = training_rows(docs, labels, labelled_rows, unlabelled_rows)

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("t_text", "t_source", "t_lang", "t_chars", "t_label")), strict=True)]
        rows.sort(key=lambda r: (zlib.crc32(r[0].encode("utf-8", "surrogatepass")), r[0]))
        model = cotrain([r for r in rows if r[4] >= 0], [r for r in rows if r[4] < 0])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = sample.coalesce(1).mapInArrow(train, "model binary").first()
    return pickle.loads(made.model) if made else cotrain([], [])


def fit_both(docs: DataFrame, labels: DataFrame, label: str = "quality", toxic: str = "toxic") -> tuple[CoTrained, CoTrained]:
    """The models of a good document and of one that isn't toxic; labels without such a column reject none as toxic."""
    if toxic in labels.columns:
        clean = labels.select("doc_id", (1 - F.col(toxic)).alias("y"))
    else:
        clean = labels.limit(0).select("doc_id", F.lit(1).alias("y"))
    return fit(docs, labels.select("doc_id", F.col(label).alias("y"))), fit(docs, clean)


def scorer(model: CoTrained, clean: CoTrained):
    """Pandas UDF (text, source, lang, n_chars) -> struct(text_score, meta_score, score, toxic_score), rounded to 6
    places. The first three are of the good, the last is one less the score of those that aren't toxic."""

    @F.pandas_udf(ddl(_SCORED))
    def score(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        view, both = TextView(model.buckets), (model, clean)
        ends = model.buckets + _DENSE
        shape, rest = (np.column_stack([m.text.w[lo:hi] for m in both]) for lo, hi in ((0, model.buckets), (model.buckets, ends)))
        gram, told = np.zeros((_GRAMS, 2)), np.zeros(_GRAMS, bool)
        for j, m in enumerate(both):
            gram[m.grams, j] = m.text.w[ends:]
            told[m.grams] = True

        class Weights(dict):
            def __missing__(self, word: str) -> complex:
                if len(self) > 200_000:
                    self.clear()
                self[word] = v = complex(*shape[word_bucket(word, model.buckets)])
                return v

        global _WEIGHTS
        key = zlib.crc32(shape.tobytes())
        if _WEIGHTS is None or _WEIGHTS[0] != key:
            _WEIGHTS = (key, Weights(), Hashes())
        known, hashes = _WEIGHTS[1:]
        form = np.column_stack([m.meta.w[_META + 2 :] for m in both])
        meta: dict[tuple, tuple[float, float]] = {}
        text_raw, meta_raw = np.zeros((len(text), 2)), np.zeros((len(text), 2))
        start = np.array([m.text.b for m in both])
        for i, t in enumerate(text):
            words = t.split()
            at = gram_buckets(t, hashes)
            shapes = sum(map(known.__getitem__, words), 0j) / max(len(words), 1)  # both models' sums in one number
            text_raw[i] = np.array([shapes.real, shapes.imag]) + gram[np.unique(at[told[at]])].sum(0) + np.array(view.dense(t, words)) @ rest + start
        for i, (s, g, n) in enumerate(zip(source, lang, n_chars, strict=True)):
            n = None if n is None or n != n else int(n)
            k = (s, g, n)
            if k not in meta:
                row = meta_row(*k)
                meta[k] = tuple(float(m.meta.raw(row)) for m in both)
            meta_raw[i] = meta[k] + np.array(layout(text.iloc[i])) @ form
        (a, b), (c, d) = ((m.text.slope * text_raw[:, j] + m.text.shift, m.meta.slope * meta_raw[:, j] + m.meta.shift) for j, m in enumerate(both))
        cols = _sigmoid(a), _sigmoid(b), model.score(a, b), 1 - clean.score(c, d)
        return pd.DataFrame({f.name: np.round(x, 6) for f, x in zip(_SCORED, cols, strict=True)})

    return score


_WEIGHTS = None


def with_scores(docs: DataFrame, model: CoTrained, clean: CoTrained, name: str = "quality_view") -> DataFrame:
    """docs with a struct column of that name; null text is empty, null source, language or length a value of its own."""
    return docs.withColumn(name, scorer(model, clean)(text_of(), "source", "lang", F.col("n_chars").cast("double")))


def _accepted(view: str, accept: float):
    """Good enough, and as surely not toxic."""
    return (F.col(f"{view}.score") >= accept) & (F.col(f"{view}.toxic_score") <= 1 - accept)


def score_documents(docs: DataFrame, labels: DataFrame, accept: float = 0.5, label: str = "quality") -> DataFrame:
    """(doc_id, text_score, meta_score, score, toxic_score, accepted) of every document.

    Repeated doc_ids: a row each. No documents: none. No labels: all accepted. Labels for ids that
    aren't in docs are ignored.
    """
    slim = docs.select("doc_id", "text", "source", "lang", "n_chars")
    scored = with_scores(slim, *fit_both(slim, labels, label))
    return scored.select("doc_id", "quality_view.*", _accepted("quality_view", accept).alias("accepted"))


def keep_good(docs: DataFrame, labels: DataFrame, accept: float = 0.5, label: str = "quality") -> DataFrame:
    """The documents that the classifier accepts, in their own columns."""
    models = fit_both(docs.select("doc_id", "text", "source", "lang", "n_chars"), labels, label)
    name = free_name(docs.columns, "judged")
    return with_scores(docs, *models, name).where(_accepted(name, accept)).drop(name)
