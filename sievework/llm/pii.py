"""Personal data: exact base patterns, widened by a character-level BiLSTM-CRF trained here in numpy."""

from __future__ import annotations

import hashlib
import pickle
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ddl, first_by_hash, text_of

# Fixed values of the contract: kinds in output order, and the patterns of each.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, in order of kind and start."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        # the leftmost match that ends in a given '@...' starts where the run of local characters before it starts
        done = 0
        for m in _DOMAIN.finditer(text):
            i = m.start()
            while i > done and text[i - 1] in _LOCAL:
                i -= 1
            if i < m.start():
                out.append((0, i, m.end()))
                done = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


# ---- the tagger. Tags: 0 outside, 1 + 2k begins kind k, 2 + 2k continues it.

TAGS = 1 + 2 * len(KINDS)
_CHARS = "abcdefghijklmnopqrstuvwxyz@.-+()_%:/#*, \n"
_CODES = np.full(0x250, len(_CHARS) + 2, np.int8)
for _i, _c in enumerate(_CHARS):
    _CODES[ord(_c)] = _CODES[ord(_c.upper())] = _i
_CODES[48:58] = len(_CHARS)
SYMBOLS = len(_CHARS) + 4
_PAD = len(_CHARS) + 3


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CODES[np.minimum(points, len(_CODES) - 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Tagger:
    """Weights: embedding, forward and backward LSTM (gates in the order input, forget, output, cell), output layer, transitions."""

    emb: np.ndarray
    wf: np.ndarray
    wb: np.ndarray
    out: np.ndarray
    trans: np.ndarray

    @classmethod
    def fresh(cls, seed: int, width: int = 12, hidden: int = 24) -> Tagger:
        g = np.random.default_rng(seed)
        w = lambda *s: (g.standard_normal(s) * 0.2).astype(np.float32)
        t = cls(w(SYMBOLS, width), w(width + hidden + 1, 4 * hidden), w(width + hidden + 1, 4 * hidden), w(2 * hidden + 1, TAGS), w(TAGS, TAGS) * 0.1)
        for k in (t.wf, t.wb):
            k[-1, hidden : 2 * hidden] = 1.0
        return t

    def weights(self) -> list[np.ndarray]:
        return [self.emb, self.wf, self.wb, self.out, self.trans]

    def _lstm(self, x: np.ndarray, w: np.ndarray, keep: bool):
        """x: T x N x width. Hidden states T x N x hidden and, for training, what the way back needs."""
        steps, n, width = x.shape
        h = w.shape[1] // 4
        inner = x.reshape(-1, width) @ w[:width] + w[-1]
        inner = inner.reshape(steps, n, 4 * h)
        rec = w[width:-1]
        hs, c = np.zeros((steps, n, h), np.float32), np.zeros((n, h), np.float32)
        prev, tape = np.zeros((n, h), np.float32), []
        for t in range(steps):
            z = inner[t] + prev @ rec
            gates, cell = _sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])
            old = c
            c = gates[:, h : 2 * h] * old + gates[:, :h] * cell
            squash = np.tanh(c)
            prev = hs[t] = gates[:, 2 * h :] * squash
            if keep:
                tape.append((gates, cell, old, squash))
        return hs, tape

    def _lstm_back(self, dh: np.ndarray, x: np.ndarray, hs: np.ndarray, tape: list, w: np.ndarray):
        steps, n, width = x.shape
        h = w.shape[1] // 4
        dz_all = np.zeros((steps, n, 4 * h), np.float32)
        nxt, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            gates, cell, old, squash = tape[t]
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            d = dh[t] + nxt
            dc = dc + d * o * (1 - squash**2)
            dz = dz_all[t]
            dz[:, :h] = dc * cell * i * (1 - i)
            dz[:, h : 2 * h] = dc * old * f * (1 - f)
            dz[:, 2 * h : 3 * h] = d * squash * o * (1 - o)
            dz[:, 3 * h :] = dc * i * (1 - cell**2)
            dc = dc * f
            nxt = dz @ w[width:-1].T
        flat = dz_all.reshape(-1, 4 * h)
        before = np.concatenate([np.zeros((1, n, h), np.float32), hs[:-1]]).reshape(-1, h)
        dw = np.concatenate([x.reshape(-1, width).T @ flat, before.T @ flat, flat.sum(0, keepdims=True)])
        return (flat @ w[:width].T).reshape(x.shape), dw

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """ids: T x N. Scores T x N x TAGS."""
        x = self.emb[ids]
        f, _ = self._lstm(x, self.wf, False)
        b, _ = self._lstm(x[::-1], self.wb, False)
        return np.concatenate([f, b[::-1]], 2) @ self.out[:-1] + self.out[-1]

    def step(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of a batch (T x N) and its gradients."""
        steps, n = ids.shape
        x = self.emb[ids]
        f, tf = self._lstm(x, self.wf, True)
        b, tb = self._lstm(x[::-1], self.wb, True)
        both = np.concatenate([f, b[::-1]], 2)
        e = both @ self.out[:-1] + self.out[-1]
        # CRF by forward and backward sums in log space
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        for t in range(1, steps):
            alpha[t] = lse(alpha[t - 1][:, :, None] + self.trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = lse(self.trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        p = np.exp(alpha + beta - z[None, :, None])
        at, who = np.arange(steps)[:, None], np.arange(n)[None, :]
        gold = e[at, who, tags].sum() + self.trans[tags[:-1], tags[1:]].sum()
        de = p.copy()
        de[at, who, tags] -= 1
        de /= n
        dtrans = np.zeros_like(self.trans)
        for t in range(1, steps):
            dtrans += np.exp(alpha[t - 1][:, :, None] + self.trans + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        np.add.at(dtrans, (tags[:-1].ravel(), tags[1:].ravel()), -1)
        dtrans /= n
        h = f.shape[2]
        flat, top = de.reshape(-1, TAGS), both.reshape(-1, 2 * h)
        dout = np.concatenate([top.T @ flat, flat.sum(0, keepdims=True)])
        dboth = (flat @ self.out[:-1].T).reshape(both.shape)
        dxf, dwf = self._lstm_back(dboth[:, :, :h], x, f, tf, self.wf)
        dxb, dwb = self._lstm_back(dboth[::-1, :, h:], x[::-1], b, tb, self.wb)
        demb = np.zeros_like(self.emb)
        np.add.at(demb, ids.ravel(), (dxf + dxb[::-1]).reshape(-1, x.shape[2]))
        return float((z.sum() - gold) / n), [demb, dwf, dwb, dout, dtrans]

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tag sequences (T x N) of scores T x N x TAGS; column i counts up to lengths[i]."""
        steps, n, _ = scores.shape
        back = np.zeros((steps, n, TAGS), np.int8)
        v = scores[0].copy()
        for t in range(1, steps):
            s = v[:, :, None] + self.trans
            back[t] = s.argmax(1)
            v = np.where((t < lengths)[:, None], s.max(1) + scores[t], v)
        tags, cur = np.zeros((steps, n), np.int8), v.argmax(1)
        who = np.arange(n)
        for t in range(steps - 1, -1, -1):
            live = t < lengths
            tags[t] = np.where(live, cur, 0)
            if t:
                cur = np.where(live, back[t, who, cur], cur)
        return tags


def train(samples: list[tuple[str, list[tuple[int, int, int]]]], window: int = 64, epochs: int = 8, batch: int = 24, seed: int = 7) -> Tagger:
    """Fit a tagger to labelled spans (text, [(kind, start, end)]) by Adam on the CRF likelihood."""
    ids, tags = [], []
    for text, spans in samples:
        c, y = codes(text), np.zeros(len(text), np.int8)
        for kind, a, b in spans:
            y[a:b] = 2 + 2 * kind
            y[a] = 1 + 2 * kind
        for at in range(0, max(len(c), 1), window):
            pad = window - len(c[at : at + window])
            ids.append(np.pad(c[at : at + window], (0, pad), constant_values=_PAD))
            tags.append(np.pad(y[at : at + window], (0, pad)))
    model, rng = Tagger.fresh(seed), np.random.default_rng(seed)
    m1, m2, n = [np.zeros_like(w) for w in model.weights()], [np.zeros_like(w) for w in model.weights()], 0
    x, y = np.array(ids), np.array(tags)
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 0.02 * 0.75**epoch
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            _, grads = model.step(x[pick].T, y[pick].T)
            n += 1
            for w, g, a, b in zip(model.weights(), grads, m1, m2, strict=True):
                g = np.clip(g, -5, 5)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= (rate * (a / (1 - 0.9**n)) / (np.sqrt(b / (1 - 0.99**n)) + 1e-6)).astype(np.float32)
    return model


def labelled_samples(words: list[str], n: int = 1800, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled spans in running text: personal data in common spellings (also ones that the base patterns miss)
    and numbers that are none (years, sizes, versions, long runs), among the given words."""
    rng = random.Random(seed)
    words = words or ["the"]
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: re.sub(r"[^a-z]", "", rng.choice(words).lower()) or "name"

    def email() -> str:
        return f"{word()}{rng.choice(['.', '_', ''])}{rng.choice([word(), digits(2)])}@{word()}{rng.choice(['', digits(1)])}.{rng.choice(['example.com', 'com', 'org', 'net', 'example.net'])}"

    def ip() -> str:
        return ".".join(str(rng.randrange(256)) for _ in range(4))

    def card() -> str:
        d = rng.choice("3456") + digits(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return rng.choice([d, f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}", f"{d[:4]}-{d[4:8]}-{d[8:12]}-{d[12:]}"])

    def phone() -> str:
        a, b, c, d = digits(2), digits(3), digits(3), digits(4)
        return rng.choice([f"+{a} {b} {c} {d}", f"+{a}{b}{c}{d}", f"+1 ({b}) {c}-{d}", f"({b}) {c}-{d}", f"00{a} {b} {c} {d}", f"+{a}-{b}-{c}-{d}", f"{b}-{c}-{d}"])

    def neither() -> str:
        return rng.choice(
            [digits(4), digits(2), f"{digits(1)}.{digits(2)}", f"v{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(4)}-{digits(2)}-{digits(2)}", digits(6), f"${digits(3)}", f"{digits(2)}%", "@" + word(), digits(24), f"Version {digits(1)}.0", f"{digits(2)}:{digits(2)}", f"#{digits(5)}", f"{digits(3)},{digits(3)}"]
        )

    makers = (email, ip, card, phone)
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + rng.choice([" ", " ", ": ", ", "])
            kind = rng.randrange(-2, 4)
            piece = makers[kind]() if kind >= 0 else neither()
            if kind >= 0:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece + rng.choice([" ", " ", ". ", ", ", "\n"])
        out.append((text + rng.choice(words), spans))
    return out


# ---- whole texts

_TRIGGER = re.compile(r"[0-9@]+")


def segments(text: str, margin: int = 24) -> list[tuple[int, int]]:
    """Stretches around digits and '@'. A span of any kind contains one of these, so no other text can hold one."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(m.start() - margin, 0), min(m.end() + margin, len(text))
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def model_spans(model: Tagger, texts: list[str], window: int = 64, stride: int = 40, group: int = 512, sure: float = 0.5) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger finds. Each stretch is read in overlapping windows; every character takes its
    scores from the window in which it lies deepest, and one Viterbi pass over the whole stretch, by the
    CRF's transitions, settles the tags. A span counts if its characters are `sure` of it on average."""
    jobs: list[tuple[int, int, int]] = []
    for i, text in enumerate(texts):
        jobs += [(i, a, b) for a, b in segments(text)]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    jobs.sort(key=lambda j: j[2] - j[1])
    at = 0
    while at < len(jobs):
        # stretches of like length are decoded together; the area of a group is bounded, a longer stretch stands alone
        part = [jobs[at]]
        at += 1
        while at < len(jobs) and len(part) < group and (len(part) + 1) * (jobs[at][2] - jobs[at][1]) <= 80_000:
            part.append(jobs[at])
            at += 1
        longest = part[-1][2] - part[-1][1]
        scores = np.zeros((longest, len(part), TAGS), np.float32)
        starts, ids = [], []
        for k, (i, a, b) in enumerate(part):
            c = codes(texts[i][a:b])
            for w in range(0, max(len(c) - window + stride, 1), stride):
                piece = c[w : w + window]
                ids.append(np.pad(piece, (0, window - len(piece)), constant_values=_PAD))
                starts.append((k, w, len(piece), len(c)))
        slack = (window - stride) // 2
        for lo in range(0, len(ids), 1024):
            e = model.emissions(np.array(ids[lo : lo + 1024]).T)
            for j, (k, w, n, size) in enumerate(starts[lo : lo + 1024]):
                left, right = (slack if w else 0), (n if w + n >= size else n - slack)
                scores[w + left : w + right, k] = e[left:right, j]
        tags = model.decode(scores, np.array([b - a for _, a, b in part]))
        peak = scores.max(2, keepdims=True)
        p = np.exp(scores - peak)
        p /= p.sum(2, keepdims=True)
        for k in np.flatnonzero((tags > 0).any(0)):
            i, a, b = part[k]
            y, t = tags[: b - a, k], 0
            while t < len(y):
                kind = (int(y[t]) - 1) // 2
                if y[t] and y[t] % 2:
                    end = t + 1
                    while end < len(y) and y[end] == 2 + 2 * kind:
                        end += 1
                    inside = p[t + 1 : end, k, 2 + 2 * kind]
                    if len(inside) and inside.mean() >= sure:
                        found[i].append((kind, a + t, a + end))
                    t = end
                else:
                    t += 1
    return found


def plausible(kind: int, span: str) -> bool:
    """Whether the characters of a span that the model adds could be of its kind at all."""
    n = sum(c in "0123456789" for c in span)
    if span != span.strip():
        return False
    if kind == 0:
        return "@" in span and "." in span[span.index("@") :] and " " not in span and "\n" not in span
    if kind == 1:
        return span.count(".") == 3 and all(p.isdigit() and int(p) <= 255 for p in span.split("."))
    if kind == 2:
        return 16 <= n <= 19 and luhn("".join(c for c in span if c in "0123456789")) and set(span) <= set("0123456789 -.")
    return 10 <= n <= 15 and set(span) <= set("0123456789 +().-") and n * 2 > len(span)


def find_spans(model: Tagger | None, texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of each text, in order of kind and start. A span of the model that touches a
    base span or an earlier, longer one of its own is not added."""
    bases = [base_spans(t) for t in texts]
    extra = model_spans(model, texts) if model is not None else [[] for _ in texts]
    out = []
    for text, base, more in zip(texts, bases, extra, strict=True):
        taken = sorted((a, b) for _, a, b in base)
        added = []
        for kind, a, b in sorted(more, key=lambda s: (s[1] - s[2], s)):
            if plausible(kind, text[a:b]) and all(b <= x or a >= y for x, y in taken):
                # whole numbers only: a span may not cut a run of digits
                if not (a and text[a - 1].isdigit()) and not (b < len(text) and text[b].isdigit()):
                    added.append((kind, a, b))
                    taken.append((a, b))
        out.append((base, sorted(base + added)))
    return out


_FOUND = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
)


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame, sample_rows: int = 200) -> Tagger:
    """A tagger for a corpus: labelled spans set among the words of sample_rows texts at most, by hash of
    doc_id, plus the base spans of those whole texts with their surroundings. The same corpus gives the same tagger.
    It is fitted in one task of an executor: texts don't come to the driver."""
    ids = first_by_hash(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", sample_rows).select(F.col("doc_id").alias("p_id"))
    picked = docs.join(F.broadcast(ids), docs["doc_id"] == ids["p_id"]).select("p_id", text_of().alias("p_text"))  # sample_rows ids at most

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(training_samples([t for _, t in rows])))], pa.binary())], names=["model"])

    made = picked.coalesce(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(made.model) if made else train(training_samples([]))


def training_samples(texts: list[str]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled spans set among the words of some texts, and base spans of these with their surroundings, some ten a text."""
    words = sorted({w for t in texts for w in t.split() if len(w) < 20})[:20_000]
    samples = labelled_samples(words)
    for text in texts:
        base = base_spans(text)
        for _, a, b in base[:: max(1, len(base) // 10)]:
            lo, hi = max(a - 20, 0), min(b + 20, len(text))
            samples.append((text[lo:hi], [(k, x - lo, y - lo) for k, x, y in base if lo <= x and y <= hi]))
    return samples


def find_personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """Personal data in every whole text: one row for each document.

    n_email, n_ip, n_card, n_phone count base spans; base_sha256 digests them; spans lists all, those that
    the tagger adds included (n_added of them). The tagger reads every stretch that could hold a span, in
    whole texts of any length. Null or empty text: no spans. Repeated doc_ids: a row each. No rows: none.
    """
    tagger = fit(docs) if model is None else model

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000).to_pydict()
                out = []
                for doc, (base, every) in zip(rows["doc_id"], find_spans(tagger, rows["text"]), strict=True):
                    n = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                    out.append((doc, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(every) - len(base)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _FOUND, strict=True)], schema=_FOUND)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, ddl(_FOUND))
