"""Operator 11 - spelling variants by dense prefix-suffix tiling.

Words are near if one inserted, deleted or replaced code point makes one of the
other.  A tile compares two blocks of words at once: their code points stand in
padded matrices, aligned left for the common prefix and right for the common
suffix, and a pair is near exactly if its lengths differ by at most one and
prefix plus suffix reach the longer length minus one.

Which blocks meet: with L the shorter length of a near pair and h = L // 2, the
pair has its first h or its last L - h code points in common.  So every word
goes, for L its own length and one less, to the groups (L, prefix of h) and
(L, suffix of L - h), and blocks are compared within a group.  A group above
``BLOCK`` words is dealt into blocks whose pairs are tiles of their own, so no
task gets more than two blocks of a group; small groups share a task and are
compared many at a time.  The suffix groups leave pairs to the prefix groups that share
both.  A tile returns a row per word (near words, best form), never the pairs.

Every step from the occurrences on is partial before the shuffle: tasks count
words before they are summed, tiles give one row per word.  Forms are followed to their roots
by pointer doubling: each form has at least ``factor`` times the occurrences
of its word, so chains are logarithmic and a few rounds suffice.

Defined cases: a null text has no words; a null id garbles nothing; repeated
rows count again; without words the result has no rows; other columns are
ignored; with ``factor`` 1 or less chains needn't end, which is an error.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import discard, handoff

RUN = "A-Za-zÀ-ÿ"
_LOWER = {i: i + 32 for i in range(65, 91)}
#: Distinct words that a counting task holds before it hands them on.
HELD = 300_000
#: Words of a block, and of the groups that are compared many at a time.
BLOCK, SMALL = 1024, 32
#: Keyed words of a task, about.
BUCKET = 60_000
#: Pairs that one comparison holds at a time, and code points of a matrix.
PAIRS, POINTS = 1 << 20, 1 << 22
#: Up to so many group names (one for BLOCK keyed words) are broadcast.
BROADCAST_GROUPS = 50_000
MAX_ROUNDS = 12


# -- occurrences --------------------------------------------------------------------
def garble(doc_id: int | None, run: str, every: int) -> str:
    """The run without one code point where ``every`` divides its checksum."""
    if doc_id is None or not every:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, garble_every: int = 0) -> DataFrame:
    """Rows (word, n): the lower-cased runs of letters of whole texts with at
    least so many code points and occurrences."""
    # a garbled run is one shorter, never longer
    pattern = re.compile(f"[{RUN}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                if not t.is_valid:
                    continue
                # runs of one text that are equal up to case are garbled alike
                mine: Counter[str] = Counter()
                for m in pattern.finditer(t.as_py()):
                    mine[m.group()] += 1
                    if len(mine) > HELD:
                        for run, n in mine.items():
                            word = garble(i, run.translate(_LOWER), garble_every)
                            if len(word) >= least_length:
                                held[word] += n
                        mine.clear()
                        yield flush()
                for run, n in mine.items():
                    word = garble(i, run.translate(_LOWER), garble_every)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    found = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- tiles ----------------------------------------------------------------------------
def _matrix(words: list[str], width: int, right: bool, pad: int) -> np.ndarray:
    """Code points of words in rows of ``width``, padded on the other side."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    kind = np.uint8 if not len(points) or points.max() < 256 else np.uint32
    out = np.full((len(words), width), pad, dtype=kind)
    place = np.arange(width)
    out[(place >= width - size[:, None]) if right else (place < size[:, None])] = points
    return out


def _common(a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
    """(groups, p, q): leading columns that the rows of (groups, p, width) and
    (groups, q, width) have in common; the first ``known`` are equal."""
    alive = np.ones((len(a), a.shape[1], b.shape[1]), dtype=bool)
    out = np.full(alive.shape, known, dtype=np.int32)
    for w in range(known, a.shape[2]):
        alive &= a[:, :, None, w] == b[:, None, :, w]
        if not alive.any():
            break
        out += alive
    return out


class _Blocks:
    """Words of one length class, with what a tile finds of each."""

    def __init__(self, words: list[str], n: np.ndarray, length: int):
        self.words, self.n = words, n
        self.size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.rank = np.empty(len(words), dtype=np.int64)  # in code-point order
        self.rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        self.by_rank = np.argsort(self.rank)
        # the two sides of a comparison are padded apart, as pads aren't common
        self.sides = [[_matrix(words, length + 1, right, pad) for right in (False, True)] for pad in (0, 1)]
        self.near = np.zeros(len(words), dtype=np.int64)
        self.best_n = np.zeros(len(words), dtype=np.int64)
        self.best = np.full(len(words), np.iinfo(np.int64).max)

    def compare(self, a: np.ndarray, b: np.ndarray, length: int, side: int, once: bool) -> None:
        """Compare the rows ``a`` with ``b``, index matrices (groups, p) and
        (groups, q) with -1 where there's no word; ``once``: of two orders of a
        pair only one is meant."""
        half = length // 2
        known = (half, 0) if side == 0 else (0, length - half)
        left, right = ([self.sides[s][k][x] for k in (0, 1)] for s, x in ((0, a), (1, b)))
        prefix = _common(left[0], right[0], known[0])
        suffix = _common(left[1][:, :, ::-1], right[1][:, :, ::-1], known[1])
        la, lb = self.size[a][:, :, None], self.size[b][:, None, :]
        near = (prefix + suffix >= np.maximum(la, lb) - 1) & (np.minimum(la, lb) == length) & (a >= 0)[:, :, None] & (b >= 0)[:, None, :]
        if side == 1:  # these are in a prefix group as well
            near &= prefix < half
        if once:
            near &= a[:, :, None] < b[:, None, :]
        g, p, q = np.nonzero(near)
        for x, y in ((a[g, p], b[g, q]), (b[g, q], a[g, p])):
            np.add.at(self.near, x, 1)
            order = np.lexsort((self.rank[y], -self.n[y], x))
            x, y = x[order], y[order]
            first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else x
            x, y = x[first], y[first]
            better = (self.n[y] > self.best_n[x]) | (self.n[y] == self.best_n[x]) & (self.rank[y] < self.best[x])
            self.best_n[x[better]], self.best[x[better]] = self.n[y[better]], self.rank[y[better]]

    def rows(self) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
        has = np.flatnonzero(self.near)
        return [self.words[i] for i in has], self.near[has], self.best_n[has], [self.words[self.by_rank[r]] for r in self.best[has]]


def _tile(table: pa.Table) -> pa.Table:
    """For applyInArrow by (bucket, i, j): many small groups whole (i = -1), or
    the blocks i and j of large ones."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    table = table.sort_by([("length", "ascending"), ("side", "ascending"), ("part", "ascending")])
    length, side = (table.column(c).to_numpy() for c in ("length", "side"))
    cut = np.flatnonzero(np.append(True, (length[1:] != length[:-1]) | (side[1:] != side[:-1])))
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(length)]):
        l, s = int(length[lo]), int(side[lo])
        rows = table.slice(lo, hi - lo)
        part = rows.column("part").combine_chunks()
        code = part.dictionary_encode().indices.to_numpy()
        own = rows.column("own").to_numpy()
        blocks = _Blocks(rows.column("word").to_pylist(), rows.column("n").to_numpy(), l)
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        size = np.diff(np.append(first, len(code)))
        small = size <= SMALL
        for k in (2, 4, 8, 16, SMALL):  # groups of like sizes in one comparison
            of = np.flatnonzero(small & (size <= k) & (size > k // 2) & (size > 1))
            step = max(1, min(PAIRS // (k * k), POINTS // (k * (l + 1))))
            for at in range(0, len(of), step):
                g = of[at:at + step]
                index = first[g][:, None] + np.arange(k)
                index[np.arange(k) >= size[g][:, None]] = -1
                _within(blocks, index, own, l, s)
        for g in np.flatnonzero(~small):
            index = np.arange(first[g], first[g] + size[g])
            _within(blocks, index[None, :], own, l, s)
        for have, new in zip(out, blocks.rows()):
            have.extend(new)
    return pa.table([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], names=["word", "near", "best_n", "best"])


def _within(blocks: _Blocks, index: np.ndarray, own: np.ndarray, length: int, side: int) -> None:
    """Compare groups, the rows of ``index``, within themselves; of a pair of
    blocks, the rows of the one (own 0) with those of the other (own 1)."""
    if own[index[0, 0]] == 2 and index.shape[1] <= SMALL:
        blocks.compare(index, index, length, side, True)
        return
    step = max(1, min(BLOCK, POINTS // (length + 1)))
    for row in index:
        row = row[row >= 0]
        whole = own[row[0]] == 2
        a, b = (row, row) if whole else (row[own[row] == 0], row[own[row] == 1])
        for x in range(0, len(a), step):
            for y in range(x if whole else 0, len(b), step):
                blocks.compare(a[None, x:x + step], b[None, y:y + step], length, side, whole)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Rows (word, n_near, best_n, best) for the words that have near words;
    ``vocabulary``: distinct words with counts (word, n), written once."""
    parts = ", ".join(f"named_struct('length', {l}, 'side', {side}, 'part', {part})" for l in ("char_length(word)", "char_length(word) - 1")
                      for side, part in ((0, f"left(word, int(({l}) div 2))"), (1, f"right(word, int({l} - ({l}) div 2))")))
    keyed = vocabulary.select("word", "n", F.expr(f"explode(array({parts}))").alias("k")).select("word", "n", "k.*")
    groups = ["length", "side", "part"]
    total, points = keyed.agg(F.count("*"), F.sum("length")).first()
    buckets = max(1, -(-total // BUCKET), -(-(points or 0) // POINTS))
    large = handoff(keyed.groupBy(*groups).agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
                    .select(*groups, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "spelling-large")
    few = large.count() <= BROADCAST_GROUPS
    found = keyed.join(F.broadcast(large) if few else large, groups, "left")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    # a block of a large group meets itself (own 2) and each other block (own 0 or 1)
    tiles = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(2).alias("own")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
            F.least(x, block).alias("i"), F.greatest(x, block).alias("j"), F.when(x == block, 2).when(block < x, 0).otherwise(1).alias("own"))))
    dealt = (found.select("word", "n", *groups, F.explode(tiles).alias("t"))
             .select("word", "n", *groups, "t.*", F.pmod(F.xxhash64(*groups), F.lit(buckets)).cast("int").alias("bucket")))
    tiled = dealt.repartition(buckets, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(_tile, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return tiled.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


# -- forms and roots --------------------------------------------------------------------
def variants(vocabulary: DataFrame, factor: int = 2) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for distinct words (word, n):
    the form is the near word of the largest n (ties: the smallest in code-point
    order) if that is at least ``factor`` times the word's own."""
    if factor <= 1:
        raise ValueError("factor must be above 1")
    vocabulary = handoff(vocabulary.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    takes = F.col("best_n") >= factor * F.col("n")
    near = handoff(vocabulary.join(near_words(vocabulary), "word").select(
        "word", "n_near", F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")), "spelling-near")
    roots = handoff(near.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(MAX_ROUNDS):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = handoff(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        ended = step.where("moved").isEmpty()
        discard(roots)
        roots = step
        if ended:
            break
    else:
        raise RuntimeError(f"chains of forms don't end after {MAX_ROUNDS} doublings")
    return (vocabulary.join(near, "word", "left").join(roots.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
