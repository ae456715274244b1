"""Operator 5 - toxicity by a character n-gram classifier with naive Bayes
scaled features.

Features are the distinct character n-grams (hashed) of the lower-cased text
with white space as one space.  Over the labelled training texts Spark counts
in how many toxic and other texts each occurs; the log of the ratio of the
smoothed rates scales the feature, and a linear (logistic) model is trained on
the scaled features.  Only the ``KEEP`` features of the largest evidence enter
the model; the score is its probability for label 1.

The model is fitted on at most ``TRAIN_ROWS`` labelled texts (those with the
smallest hashes of their id); scoring covers every text whole, in windows, so a
task's memory doesn't follow a text's length.

Defined cases: null text is empty; an empty text scores the model's intercept;
null labels are ignored, of several labels of one document the largest counts;
without labels of both kinds every score is the share of label 1 (0 without
any label); repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quarry.llm.common import discard, handoff, row_slices, sum_vectors, text_batches, text_sizes, tidy

#: Bound of the training sample, in labelled texts.
TRAIN_ROWS = 20_000
HASH_BITS = 20
SLICES = 16
LENGTHS = (2, 3, 4, 5, 6)
KEEP = 1 << 15
#: Least log-likelihood gain of a feature over one rate for both kinds of text.
LEAST_EVIDENCE = 8.0
SMOOTH = 1.0
PENALTY = 0.01
WINDOW = 1 << 18
#: Bytes of texts whose features a task holds at a time.
SLICE_BYTES = 1 << 20


class NgramMarks:
    """Which hashed n-grams a text has."""

    def __init__(self, bits: int = HASH_BITS, lengths: tuple[int, ...] = LENGTHS):
        self.shift, self.lengths = np.uint64(64 - bits), lengths
        self.marked = np.zeros(1 << bits, dtype=bool)

    def _hashes(self, text: str) -> Iterator[np.ndarray]:
        """The n-grams' hashes, by length and window."""
        text = f" {' '.join(text.lower().split())} "
        if len(text) <= 2:
            return
        most = max(self.lengths)
        for at in range(0, len(text), WINDOW):
            c = np.frombuffer(text[at:at + WINDOW + most - 1].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
            c *= np.uint64(0xD6E8FEB86659FD93)
            h = np.zeros(len(c), dtype=np.uint64)
            for n in range(1, min(most, len(c)) + 1):
                h = h[:len(c) - n + 1] * np.uint64(0x9E3779B97F4A7C15)
                h += c[n - 1:]
                if n in self.lengths:
                    x = h ^ (h >> np.uint64(29))
                    x *= np.uint64(0xBF58476D1CE4E5B9)
                    x >>= self.shift
                    yield x.view(np.int64)

    def indices(self, text: str, among: np.ndarray | None = None) -> np.ndarray:
        """The distinct hashes, of those marked in ``among`` if given."""
        if among is not None:
            found = [h[among[h]] for h in self._hashes(text)]
            return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
        for h in self._hashes(text):
            self.marked[h] = True
        out = np.flatnonzero(self.marked)
        self.marked[out] = False
        return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks, size = NgramMarks(), 1 << HASH_BITS
    count, seen = np.zeros((2, size), dtype=np.int32), False
    for b in batches:
        for t, y in zip(b.column(0), b.column(1).to_pylist()):
            count[y, marks.indices(t.as_py() or "")] += 1
            seen = True
    if seen:
        flat, width = count.reshape(-1), 2 * size // (2 * SLICES)
        yield pa.RecordBatch.from_arrays([pa.array(list(range(2 * SLICES)), pa.int32()), pa.array([flat[i * width:(i + 1) * width].tobytes() for i in range(2 * SLICES)], pa.binary())], names=["slice", "values"])


def select_features(other: np.ndarray, toxic: np.ndarray, n_other: int, n_toxic: int, keep: int = KEEP) -> tuple[np.ndarray, np.ndarray]:
    """The features of the largest evidence and their log-count ratios."""
    p, q = (toxic + SMOOTH) / (n_toxic + 2 * SMOOTH), (other + SMOOTH) / (n_other + 2 * SMOOTH)
    ratio = np.log(p / q)
    # deviance of the two rates from one rate
    both = (toxic + other + 2 * SMOOTH) / (n_toxic + n_other + 4 * SMOOTH)
    def part(k: np.ndarray, n: int) -> np.ndarray:
        rate = (k + SMOOTH) / (n + 2 * SMOOTH)
        return k * np.log(rate / both) + (n - k) * np.log((1 - rate) / (1 - both))
    evidence = np.where(toxic + other > 1, part(toxic, n_toxic) + part(other, n_other), -np.inf)
    best = np.argsort(-evidence, kind="stable")[:keep]
    best = np.sort(best[evidence[best] > LEAST_EVIDENCE])
    return best, ratio[best]


class Model:
    """Feature weights (of marks, the ratio already in) and the intercept."""

    def __init__(self, weight: np.ndarray, intercept: float):
        self.weight, self.intercept = weight, intercept
        self.used = weight != 0

    def score(self, marks: NgramMarks, text: str) -> float:
        z = self.intercept + float(self.weight[marks.indices(text, self.used)].sum())
        return 1 / (1 + np.exp(-z)) if z >= 0 else np.exp(z) / (1 + np.exp(z))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on the documents whose id has a label."""
    spark = docs.sparkSession
    text_batches(spark)
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
             .where("y in (0, 1)").orderBy(F.xxhash64("id"), "id").limit(train_rows))
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id").select("text", "y")  # bounded by train_rows
    train = handoff(sample, "toxicity-train")
    n = dict(train.groupBy("y").agg(F.count("*")).collect())
    n_other, n_toxic = n.get(0, 0), n.get(1, 0)
    size = 1 << HASH_BITS
    if not n_other or not n_toxic:
        share = min(max(n_toxic / max(1, n_other + n_toxic), 1e-6), 1 - 1e-6) if n else 1e-6
        return Model(np.zeros(size), float(np.log(share / (1 - share))))
    parts = max(2, min(64, -(-(n_other + n_toxic) // 512)))
    spread = train.repartition(parts)
    count = sum_vectors(spark, spread.mapInArrow(tidy(_counts), "slice int, values binary"), 2 * SLICES, size // SLICES).reshape(2, size)
    kept, ratio = select_features(count[0].astype(float), count[1].astype(float), n_other, n_toxic)
    place = np.full(size, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))
    used, width = place >= 0, max(1, len(kept))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sparse vectors as MLlib stores them (type, size, indices, values)."""
        marks = NgramMarks()
        for b in batches:
            for lo, hi in row_slices(text_sizes(b.column(0)), SLICE_BYTES):
                at = [place[marks.indices(t.as_py() or "", used)] for t in b.column(0).slice(lo, hi - lo)]
                offsets = pa.array(np.cumsum([0, *map(len, at)]).astype(np.int32))
                flat = np.concatenate(at).astype(np.int32)
                vector = pa.StructArray.from_arrays(
                    [pa.array(np.zeros(hi - lo, dtype=np.int8)), pa.array(np.full(hi - lo, width, dtype=np.int32)),
                     pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(offsets, pa.array(ratio[flat]))], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([vector, b.column(1).slice(lo, hi - lo).cast(pa.float64())], names=["features", "label"])

    written = handoff(spread.mapInArrow(tidy(vectors), "features struct<type:tinyint,size:int,indices:array<int>,values:array<double>>, label double"), "toxicity-features")
    # read back as vectors: the stored form is the same
    features = spark.read.schema(StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])).parquet(written.__dict__["handoff_path"])
    fitted = LogisticRegression(regParam=PENALTY, elasticNetParam=0.0, standardization=False, maxIter=40, tol=1e-6).fit(features)
    discard(train, written)
    weight = np.zeros(size)
    weight[kept] = fitted.coefficients.toArray()[:len(kept)] * ratio
    return Model(weight, float(fitted.intercept))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` (double) in place of, or behind,
    them; the text is the only input of the score."""
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.intercept))
    names = [c for c in docs.columns if c != "score"]
    at = names.index(text)
    schema = StructType([docs.schema[c] for c in names]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, model = NgramMarks(), Model(*sent.value)
        for b in batches:
            z = [float(model.score(marks, t.as_py() or "")) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(z, pa.float64())], names=[*names, "score"])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(tidy(run), schema)
