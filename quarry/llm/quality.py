"""Operator 12 - quality by histogram gradient-boosted trees over document
statistics.

``statistics`` turns every whole text into a row of numbers: shares of byte
classes, word, line and repetition figures.  ``fit`` bins the statistics of the
labelled training texts by quantiles and boosts small trees on the logistic
loss: in every node a histogram of gradients and curvatures over the bins of
each statistic gives the best split.  All trees are flattened into one set of
arrays (statistic, threshold, children, value), which tasks traverse for a whole
batch of rows and all trees at once with numpy.

Training sees at most ``TRAIN_ROWS`` labelled texts (those with the smallest
hashes of their id), as one byte per statistic, so the driver holds less than
two megabytes; the statistics themselves and all scoring are maps on Spark.  A
task reads texts in parts of ``PART`` bytes and keeps eight bytes a word, pair
of words and line of the texts at hand.

Defined cases: a null text is empty; an empty text has all statistics zero and
a score like any other; null labels and labels other than 0 and 1 are ignored,
of several labels of one document the largest counts; without labels of both
kinds every score is the share of label 1 (0 without any label); repeated rows
are scored each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from quarry.llm.common import RollingBytes, row_slices, text_sizes

#: Bound of the training sample, in labelled texts.
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE = 120, 4, 0.1
BINS = 64
#: Least curvature sum of a child, and the penalty on leaf values.
LEAST_CHILD, PENALTY = 2.0, 1.0
PART = 1 << 20

# -- statistics -------------------------------------------------------------------
LOWER, UPPER, DIGIT, SPACE, BREAK, STOP, COMMA, MARK, SYMBOL, QUOTE, LEAD, TAIL, CONTROL = range(13)
CLASSES = 13
_CLASS = np.full(256, CONTROL, dtype=np.uint8)
_CLASS[33:127] = SYMBOL
_CLASS[ord("a"):ord("z") + 1], _CLASS[ord("A"):ord("Z") + 1], _CLASS[ord("0"):ord("9") + 1] = LOWER, UPPER, DIGIT
for _chars, _kind in ((b" \t", SPACE), (b"\n\r\x0b\x0c", BREAK), (b".", STOP), (b",;:", COMMA), (b"!?", MARK), (b"'\"()-", QUOTE)):
    _CLASS[list(_chars)] = _kind
_CLASS[128:192], _CLASS[192:] = TAIL, LEAD

STATISTICS = ["log_chars", "log_words", "log_lines", *(f"share_{c}" for c in ("lower", "upper", "digit", "space", "break", "stop", "comma", "mark", "symbol", "quote", "accent", "control")),
              "class_entropy", "word_mean", "word_spread", "word_longest", "words_short", "words_long", "words_upper", "words_capital", "words_digit", "ends_symbol", "ends_mark", "ends_stop",
              "words_distinct", "word_top", "pairs_distinct", "pair_top", "line_mean", "line_longest", "lines_distinct", "line_top", "lines_stop", "words_per_stop"]


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts that end behind a line or, failing that, a word."""
    at = 0
    while at < len(text):
        end = min(at + PART, len(text))
        if end < len(text):
            cut = max(text.rfind(b"\n", at, end), -1)
            cut = cut if cut >= 0 else text.rfind(b" ", at, end)
            end = cut + 1 if cut >= 0 else end
        yield text[at:end]
        at = end


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _repeats(owner: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By owner: the number of distinct keys, and the most times that one occurs."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(key):
        order = np.lexsort((key, owner))
        o, k = owner[order], key[order]
        first = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (k[1:] != k[:-1])))
        np.add.at(distinct, o[first], 1)
        np.maximum.at(top, o[first], np.diff(np.append(first, len(k))))
    return distinct, top


def _group_statistics(texts: list[bytes]) -> np.ndarray:
    """Statistics of texts that are read together, a row each."""
    n = len(texts)
    classes = np.zeros((n, CLASSES))
    add = {name: np.zeros(n) for name in ("words", "chars", "squares", "short", "long", "upper", "capital", "digit", "e_symbol", "e_mark", "e_stop", "lines", "l_chars", "l_stop")}
    longest, l_longest = np.zeros(n), np.zeros(n)
    words: list[tuple[np.ndarray, np.ndarray]] = []
    lines: list[tuple[np.ndarray, np.ndarray]] = []
    pieces = [(i, p) for i, t in enumerate(texts) for p in _parts(t)]
    for lo, hi in row_slices(np.array([len(p) + 1 for _, p in pieces], dtype=np.int64), PART + 1):
        data = np.frombuffer(b"\n".join(p for _, p in pieces[lo:hi]), dtype=np.uint8)
        size = np.array([len(p) + 1 for _, p in pieces[lo:hi]])
        owner = np.repeat(np.array([i for i, _ in pieces[lo:hi]]), size)[:len(data)]
        kind = _CLASS[data]
        classes += np.bincount(owner * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
        classes[owner[np.cumsum(size)[:-1] - 1], BREAK] -= 1  # the breaks put between
        rolling = RollingBytes(data)
        tails = np.concatenate([[0], np.cumsum(kind == TAIL)])
        start, end = _runs((kind != SPACE) & (kind != BREAK))
        if len(start):
            who, length = owner[start], (end - start - (tails[end] - tails[start])).astype(float)
            uppers = np.concatenate([[0], np.cumsum(kind == UPPER)])
            lowers = np.concatenate([[0], np.cumsum(kind == LOWER)])
            digits = np.concatenate([[0], np.cumsum(kind == DIGIT)])
            up, low, last = uppers[end] - uppers[start], lowers[end] - lowers[start], kind[end - 1]
            for name, weight in (("words", None), ("chars", length), ("squares", length ** 2), ("short", length <= 3), ("long", length >= 14), ("upper", (up > 1) & (low == 0)), ("capital", kind[start] == UPPER),
                                 ("digit", digits[end] > digits[start]), ("e_symbol", (last == SYMBOL) | (last == CONTROL)), ("e_mark", last == MARK), ("e_stop", last == STOP)):
                add[name] += np.bincount(who, weight, n)
            np.maximum.at(longest, who, length)
            words.append((who, rolling.ranges(start, end)))
        start, end = _runs(kind != BREAK)
        if len(start):
            who, length = owner[start], (end - start).astype(float)
            for name, weight in (("lines", None), ("l_chars", length), ("l_stop", kind[end - 1] == STOP)):
                add[name] += np.bincount(who, weight, n)
            np.maximum.at(l_longest, who, length)
            lines.append((who, rolling.ranges(start, end)))
    none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))
    who, word = (np.concatenate(x) for x in zip(*words, none))
    l_who, line = (np.concatenate(x) for x in zip(*lines, none))
    distinct, top = _repeats(who, word, n)
    joined = np.flatnonzero(who[1:] == who[:-1])
    p_distinct, p_top = _repeats(who[joined], word[joined] * np.uint64(0x9E3779B97F4A7C15) + word[joined + 1], n)
    l_distinct, l_top = _repeats(l_who, line, n)
    total, count, n_lines = classes.sum(1), add["words"], add["lines"]
    share = classes / np.maximum(total, 1)[:, None]
    of = lambda x, y: x / np.maximum(y, 1)
    mean = of(add["chars"], count)
    letters = np.delete(share, TAIL, axis=1)
    entropy = -(share * np.log(np.maximum(share, 1e-300))).sum(1)
    return np.column_stack([
        np.log1p(total - classes[:, TAIL]), np.log1p(count), np.log1p(n_lines), letters, entropy,
        mean, np.sqrt(np.maximum(of(add["squares"], count) - mean ** 2, 0)), longest, *(of(add[x], count) for x in ("short", "long", "upper", "capital", "digit", "e_symbol", "e_mark", "e_stop")),
        of(distinct, count), of(top, count), of(p_distinct, count - 1), of(p_top, count - 1), of(add["l_chars"], n_lines), l_longest, of(l_distinct, n_lines), of(l_top, n_lines), of(add["l_stop"], n_lines),
        of(count, classes[:, STOP] + classes[:, MARK])])


def statistics(column: pa.Array) -> np.ndarray:
    """The statistics of a text column, a row of STATISTICS for each text."""
    out = [np.zeros((0, len(STATISTICS)))]
    for lo, hi in row_slices(text_sizes(column), PART):
        out.append(_group_statistics([(t or "").encode("utf-8") for t in column.slice(lo, hi - lo).to_pylist()]))
    return np.concatenate(out)


# -- boosting ----------------------------------------------------------------------
class Trees:
    """Boosted trees in flat arrays: a node holds its statistic, threshold (rows
    up to it go left), children and value; leaves are their own children."""

    def __init__(self, base: float, roots: list[int], stat: list[int], threshold: list[float], left: list[int], right: list[int], value: list[float], depth: int):
        self.base, self.depth = base, depth
        self.roots = np.array(roots, dtype=np.int32)
        self.stat, self.left, self.right = (np.array(x, dtype=np.int32) for x in (stat, left, right))
        self.threshold, self.value = np.array(threshold, dtype=float), np.array(value, dtype=float)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for lo in range(0, len(x), 2048) if len(self.roots) else ():
            rows = x[lo:lo + 2048]
            at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
            row = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                at = np.where(rows[row, self.stat[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[lo:lo + 2048] += self.value[at].sum(1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * self.margin(x)))


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Up to bins - 1 thresholds a statistic, midway between values that differ."""
    out = []
    for column in x.T:
        value, count = np.unique(column, return_counts=True)
        if len(value) > bins:
            place = np.searchsorted(np.cumsum(count), np.arange(1, bins) * len(column) / bins)
            place = np.unique(place[place < len(value) - 1])
        else:
            place = np.arange(len(value) - 1)
        out.append((value[place] + value[place + 1]) / 2)
    return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    """Trees on the logistic loss of labels ``y`` (0 or 1) given statistics."""
    share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    flat: dict[str, list] = {k: [] for k in ("stat", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if not len(y) or y.min() == y.max():
        return Trees(base, roots, **flat, depth=depth)
    cuts = _cuts(x, bins)
    code = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)]).astype(np.uint8)
    width = x.shape[1] * bins
    slot = code + np.arange(x.shape[1]) * bins  # a histogram's cell of each statistic
    margin = np.full(len(y), base)

    def node() -> int:
        at = len(flat["value"])
        for k, v in (("stat", 0), ("threshold", 0.0), ("left", at), ("right", at), ("value", 0.0)):
            flat[k].append(v)
        return at

    for _ in range(trees):
        p = 0.5 * (1 + np.tanh(0.5 * margin))
        gradient, curve = y - p, p * (1 - p)
        roots.append(node())
        level = [(roots[-1], np.arange(len(y)))]
        for d in range(depth + 1):
            below = []
            for at, rows in level:
                g, h = gradient[rows].sum(), curve[rows].sum()
                flat["value"][at] = rate * g / (h + PENALTY)
                if d == depth or len(rows) < 2:
                    margin[rows] += flat["value"][at]
                    continue
                cells = slot[rows].ravel()
                hist = [np.cumsum(np.bincount(cells, np.repeat(w[rows], x.shape[1]), width).reshape(-1, bins), axis=1) for w in (gradient, curve)]
                gain = np.where((hist[1] >= LEAST_CHILD) & (h - hist[1] >= LEAST_CHILD),
                                hist[0] ** 2 / (hist[1] + PENALTY) + (g - hist[0]) ** 2 / (h - hist[1] + PENALTY), -np.inf)
                best = int(gain.argmax())
                stat, cut = divmod(best, bins)
                if gain.flat[best] <= g * g / (h + PENALTY) + 1e-9 or cut >= len(cuts[stat]):
                    margin[rows] += flat["value"][at]
                    continue
                flat["stat"][at], flat["threshold"][at], flat["value"][at] = stat, float(cuts[stat][cut]), 0.0
                flat["left"][at], flat["right"][at] = node(), node()
                goes = code[rows, stat] <= cut
                below += [(flat["left"][at], rows[goes]), (flat["right"][at], rows[~goes])]
            level = below
    return Trees(base, roots, **flat, depth=depth)


# -- on Spark ----------------------------------------------------------------------
def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, stats array<double>): the statistics of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(b.column(1))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=[key, "stats"])

    schema = StructType([docs.schema[key]]).add("stats", ArrayType(DoubleType()))
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """Fit on the documents whose id has a label."""
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
             .where("y in (0, 1)").orderBy(F.xxhash64("id"), "id").limit(train_rows))
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")  # bounded by train_rows
    # an id that repeats brings one text, so the sample stays bounded
    sample = sample.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    spread = sample.repartition(max(2, min(64, -(-train_rows // 512))), "id")
    rows = measure(spread, "id").join(F.broadcast(known), "id").orderBy("id").select("y", "stats").toArrow()
    y = rows.column("y").to_numpy().astype(float)
    x = rows.column("stats").combine_chunks().values.to_numpy().reshape(len(y), len(STATISTICS)) if len(y) else np.zeros((0, len(STATISTICS)))
    return boost(x, y)


def score(docs: DataFrame, model: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, score double) for each row of ``docs``; the text is the only
    input of the score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.probability(statistics(b.column(1))))], names=[key, "score"])

    schema = StructType([docs.schema[key]]).add("score", "double")
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)
