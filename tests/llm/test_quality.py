"""Operator 12: statistics against a plain reading, trees against a walk, held-out accuracy on the given labels."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import quality
from quarry.llm.queries import QUERIES
from tests.llm.helpers import odd_documents, text

SF = "/root/testdata/sf0.01"


def auc(score, label):
    good, bad = np.array(score)[np.array(label) == 1], np.array(score)[np.array(label) == 0]
    return (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()


def test_query_held_out(spark):
    """Each row scored, and held-out labels predicted."""
    out = QUERIES["op12_quality"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.dtypes[1:] == [("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(got[i].score, y) for i, y in labels if got[i].held_out]
    assert len(held) > 50
    assert auc(*zip(*held)) > 0.95
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.93


def plain(t):
    """The statistics that are easy to say in words."""
    words, lines = t.split(), [x for x in t.replace("\r", "\n").split("\n") if x]
    size, raw = [len(w) for w in words], t.encode()
    pairs = list(zip(words, words[1:]))
    return {"log_chars": np.log1p(len(t)), "log_words": np.log1p(len(words)), "log_lines": np.log1p(len(lines)),
            "share_upper": sum("A" <= c <= "Z" for c in t) / max(1, len(raw)), "share_digit": sum(c in "0123456789" for c in t) / max(1, len(raw)),
            "share_break": (t.count("\n") + t.count("\r")) / max(1, len(raw)), "word_mean": sum(size) / max(1, len(words)), "word_longest": max(size, default=0),
            "words_distinct": len(set(words)) / max(1, len(words)), "word_top": max(map(words.count, words), default=0) / max(1, len(words)),
            "pairs_distinct": len(set(pairs)) / max(1, len(words) - 1), "pair_top": max(map(pairs.count, pairs), default=0) / max(1, len(words) - 1),
            "lines_distinct": len(set(lines)) / max(1, len(lines)), "line_top": max(map(lines.count, lines), default=0) / max(1, len(lines)),
            "ends_stop": sum(w.endswith(".") for w in words) / max(1, len(words)), "words_short": sum(x <= 3 for x in size) / max(1, len(words))}


def test_statistics(monkeypatch):
    rnd = random.Random(1)
    texts = ["", " ", "\n\n", "One. TWO 33 four!", "a\na\nb", "日本 ëta. ok\r\nx", *("\n".join(text(rnd, rnd.randint(0, 30)) for _ in range(rnd.randint(1, 9))) for _ in range(30))]
    for part in (1 << 20, 64):  # texts in one part or in many
        monkeypatch.setattr(quality, "PART", part)
        x = quality.statistics(pa.array([*texts, None]))
        assert x.shape == (len(texts) + 1, len(quality.STATISTICS)) and np.isfinite(x).all() and not x[0].any() and not x[-1].any()
        for row, t in zip(x, texts):
            for name, value in plain(t).items():
                if part == 64 and name.startswith(("pair", "line_", "lines", "log_lines")) and len(t.encode()) > part:
                    continue  # a line cut between parts counts as two
                assert abs(row[quality.STATISTICS.index(name)] - value) < 1e-9, (name, t)


def walk(model, x):
    """Row by row and tree by tree."""
    out = model.base
    for at in model.roots:
        while model.left[at] != at:
            at = model.left[at] if x[model.stat[at]] <= model.threshold[at] else model.right[at]
        out += model.value[at]
    return out


def test_trees():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 5)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 2] + x[:, 3] > 0.5)).astype(float)
    model = quality.boost(x, y, trees=30)
    assert np.allclose(model.margin(x), [walk(model, r) for r in x])
    assert ((model.probability(x) > 0.5) == y).mean() > 0.97
    fresh = rng.normal(size=(400, 5))
    assert ((model.probability(fresh) > 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 2] + fresh[:, 3] > 0.5))).mean() > 0.85
    # the first split is the best of all single ones by the gain of the histogram
    stump = quality.boost(x, y, trees=1, depth=1)
    g, h = y - y.mean(), np.full(len(y), y.mean() * (1 - y.mean()))
    gain = {}
    for j, cuts in enumerate(quality._cuts(x, quality.BINS)):
        for c in cuts:
            left = x[:, j] <= c
            if min(h[left].sum(), h[~left].sum()) >= quality.LEAST_CHILD:
                gain[j, c] = sum(g[s].sum() ** 2 / (h[s].sum() + quality.PENALTY) for s in (left, ~left))
    assert np.isclose(gain[int(stump.stat[0]), float(stump.threshold[0])], max(gain.values()))
    flat = quality.boost(x * 0, y)
    assert np.allclose(flat.probability(x), y.mean())


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (5, 0), (6, 7), (None, 1), (99, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model)
    assert got.columns == ["doc_id", "score"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1  # null is empty
    for lab, share in (([(1, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.0)):
        only = quality.fit(docs, spark.createDataFrame(lab, "doc_id long, quality int"))
        assert all(abs(r.score - share) < 1e-5 for r in quality.score(docs, only).collect())
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.fit(docs.limit(0), labels).roots.size == 0


def test_label_inputs_do_not_leak(spark):
    """Labels of held-out rows and other columns change no score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    some = docs.where("doc_id < 40")
    a = quality.score(some, quality.fit(docs, labels.where(~held))).collect()
    b = quality.score(some.withColumn("lang", F.lit("zz")), quality.fit(docs.withColumn("source", F.lit("")), labels.where(~held))).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
