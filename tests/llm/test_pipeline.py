"""The pipeline against a plain version of each stage, with odd rows and column names that the stages use themselves."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sievework.llm import quality
from sievework.llm.base import release

from .test_line_dedup import similar, vocabulary

pipeline = pytest.importorskip("corpus_pipeline")
NAMES = ("gone", "n_lines", "x_doc", "__score", "judged", "dedup", "shard", "node")


def tables(spark, home, docs, labels, items):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.select("*", *[F.lit(k).alias(n) for k, n in enumerate(NAMES)]).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    return df


def corpus():
    rng, words = random.Random(6), vocabulary(2500, 9)
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    docs = [(i, "\n".join(line(rng.randint(8, 25)) for _ in range(rng.randint(2, 5)))) for i in range(160)]
    docs += [(200 + i, " ".join(f"{w}%%%" for w in line(50).split())) for i in range(60)]  # junk
    item = line(30)
    shared = line(14)
    long = [line(40) for _ in range(6)]
    docs += [(300, line(12) + "\n" + item), (301, f"{shared}\n{line(10)}"), (302, f"{line(11)}\n{shared}"), (303, shared), (304, shared)]
    docs += [(310, " ".join(long)), (311, " ".join([*long[:5], *long[5].split()[:-1], "changed."])), (320, None), (321, ""), (322, " \n "), (None, line(20)), (330, "one"), (331, "word " * 20_000), (332, "x" * 30_000)]
    labels = [(i, int(i < 200), 0) for i, _ in docs if i is not None and i < 260 and i % 2 == 0] + [(9999, 0, 1), (None, 1, 0)]
    return docs, labels, [(1, item), (2, None), (3, "absent from all of it and long enough to make windows")]


def test_run_matches_a_plain_version(spark, tmp_path):
    docs, labels, items = corpus()
    df = tables(spark, str(tmp_path), docs, labels, items)
    models = quality.fit_both(spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", "text", "source", "lang", "n_chars"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = {(r.doc_id, r.text) for r in quality.with_scores(df, *models).where("quality_view.score >= 0.5 and quality_view.toxic_score <= 0.5").select("doc_id", "text").collect()}
    assert not any(200 <= (i or 0) < 260 for i, _ in good) and sum((i or 999) < 160 for i, _ in good) >= 158
    # lines: the first of every group of like lines stays, in the order of documents
    flat = lambda x: re.sub(r"[\W_]+", " ", x.lower()).strip()
    kept, seen = [], []
    for i, t in sorted(good, key=lambda r: (r[0] is not None, r[0] or 0)):
        if t is None:
            kept.append((i, None))
            continue
        left = []
        for x in t.split("\n"):
            n = flat(x)
            if n and any(n == m or (abs(len(n) - len(m)) * 10 <= max(len(n), len(m)) and max(len(n), len(m)) < 3000 and similar(n, m)) for m in seen) and i is not None:
                continue
            seen += [n] if n else []
            left.append(x)
        if len(left) == t.count("\n") + 1 or any(flat(x) for x in left):
            kept.append((i, "\n".join(left)))

    # copies: one document of each group whose five-word shingles have Jaccard 0.8
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 5 else {tuple(w)} if w else set()

    ones = []
    for i, t in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0)):
        s = shingles(t)
        if i is None or not s or not any(100 * len(s & u) >= 80 * len(s | u) for u in map(shingles, (x for _, x in ones))):
            ones.append((i, t))
    clean = [(i, t) for i, t in ones if flat(items[0][1]) not in flat(t or "")]
    out = pipeline.run(spark, str(tmp_path)).collect()
    got = {}
    for r in out:
        got.setdefault(r.doc_id, 0)
        got[r.doc_id] += r.length
    assert set(got) == {i for i, _ in clean}, sorted(set(got) ^ {i for i, _ in clean}, key=str)
    assert 300 not in got and 311 not in got and 303 not in got and 304 not in got
    for r in out:
        assert 0 < r.length <= r.doc_tokens
    assert all(got[r.doc_id] == r.doc_tokens for r in out)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    docs, labels, items = corpus()
    tables(spark, str(tmp_path), docs[:0], labels[:0], items[:0])
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, step in pipeline.STAGES[:-1]:
        out = step(spark, df, str(tmp_path))
        assert out.columns == df.columns and out.count() == 0
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_release_collects_the_drivers_garbage(spark):
    """What ended queries leave in the driver's JVM goes between stages, not when the heap is full."""
    held = spark._jvm.java.util.WeakHashMap()
    held.put("a key that nothing else in the JVM refers to", 1)
    release(spark)
    assert held.size() == 0
