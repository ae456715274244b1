"""Operator 8 - nearest neighbours by multi-index hashing.

Codes are the signs of vectors under learned rotations: iterative quantisation
(alternate signs and orthogonal Procrustes) on a bounded sample, from several
random starts until there are ``BITS`` bits.  A code is cut into substrings and
each shard indexes every one of them.  Two codes within Hamming radius r agree
in some substring up to its share of r (pigeonhole), so probing the buckets
within these shares and checking the whole codes retrieves every code within r.
Candidates are reranked by the double-precision cosine of the original vectors.

The radius is learned too: the ``RADIUS_QUANTILE`` of the distances between
sample queries and their true neighbours in the sample (with more rows
neighbours are nearer).  A query that finds fewer than k codes in a shard goes on with larger
radii there, so no query ends short.  A ball of more keys than the directory
has is probed by running over the directory's keys.

Index shards are hashes of vec_id and queries come in blocks, so a task holds a
bounded part of either side whatever vector is frequent; each cell returns k
rows a query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; a query's own row is every row with its vec_id; other
vector sizes than a query's are no candidates; ties go to the smaller vec_id;
equal queries are one; null vec_ids take no part; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import handoff
from quarry.llm.vectors import matrix, norms, packed_vectors, scaled

BITS = 256
PART_BITS = 16
#: Bounds of what is fitted on: rows and sample queries.
SAMPLE_ROWS = 8192
SAMPLE_QUERIES = 256
ROUNDS = 15
RADIUS_QUANTILE = 0.995
SHARD_ROWS = 16_384
QUERY_BLOCK = 2048

_ONES = np.array([bin(i).count("1") for i in range(1 << PART_BITS)], dtype=np.uint8)


def fit_rotations(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """A (size, bits) matrix of learned orthogonal directions."""
    rng, d = np.random.default_rng(seed), sample.shape[1]
    u = sample / norms(sample)[:, None]
    out = []
    for _ in range(-(-bits // d)):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            signs = np.where(u @ r >= 0, 1.0, -1.0)
            a, _, b = np.linalg.svd(u.T @ signs, full_matrices=False)
            r = a @ b
        out.append(r)
    return np.concatenate(out, axis=1)[:, :bits]


def encode(v: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as rows of 16-bit substrings."""
    v = scaled(v)
    bits = np.packbits((v / norms(v)[:, None]) @ rotations >= 0, axis=1)
    return np.ascontiguousarray(bits).view("<u2")


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _ONES[codes ^ code].sum(1, dtype=np.int64)


def cosines(v: np.ndarray, length: np.ndarray, q: np.ndarray, q_length: float) -> np.ndarray:
    return np.einsum("ij,j->i", v, q) / (length * q_length)


def nearest(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return at[np.lexsort((ids[at], -score[at]))][:k]
    return np.lexsort((ids, -score))[:k]


def fit_radius(sample: np.ndarray, rotations: np.ndarray, k: int, quantile: float = RADIUS_QUANTILE) -> int:
    if len(sample) < 2:
        return 0
    codes, length = encode(sample, rotations), norms(sample)
    seen = []
    for i in range(min(SAMPLE_QUERIES, len(sample))):
        score = cosines(sample, length, sample[i], length[i])
        score[i] = -2
        best = nearest(score, np.arange(len(sample)), min(k, len(sample) - 1))
        seen.append(distances(codes[best], codes[i]))
    return int(np.ceil(np.quantile(np.concatenate(seen), quantile))) if seen and len(seen[0]) else 0


class MultiIndex:
    """The substring directories of a shard's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.parts = codes, codes.shape[1]
        self.order, self.keys, self.starts = [], [], []
        for j in range(self.parts):
            order = np.argsort(codes[:, j], kind="stable")
            keys, starts = np.unique(codes[order, j], return_index=True)
            self.order.append(order)
            self.keys.append(keys)
            self.starts.append(np.append(starts, len(order)))
        self.balls = np.argsort(_ONES, kind="stable").astype(np.uint16)  # xor masks, small weights first
        self.ball_size = np.cumsum(np.bincount(_ONES, minlength=PART_BITS + 1))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes within the radius."""
        share, extra = divmod(radius, self.parts)
        found = np.zeros(len(self.codes), dtype=bool)
        for j in range(self.parts):
            s = share if j <= extra else share - 1  # else the sum would exceed the radius
            if s < 0:
                continue
            keys, s = self.keys[j], min(s, PART_BITS)
            if self.ball_size[s] < len(keys):
                want = np.sort(self.balls[:self.ball_size[s]] ^ code[j])
                at = np.searchsorted(keys, want)
                at = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == want)]
            else:
                at = np.flatnonzero(_ONES[keys ^ code[j]] <= s)
            lo, n = self.starts[j][at], self.starts[j][at + 1] - self.starts[j][at]
            rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found[self.order[j][rows]] = True
        rows = np.flatnonzero(found)
        return rows[distances(self.codes[rows], code) <= radius]


def _search(k: int, radius: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if index.num_rows and queries.num_rows:
            v, ids = scaled(matrix(index.column("v"))), index.column("vec_id").to_numpy()
            codes = np.frombuffer(b"".join(index.column("code").to_pylist()), dtype="<u2").reshape(len(v), -1)
            length, table = norms(v), MultiIndex(codes)
            qv = scaled(matrix(queries.column("v")))
            q_codes = np.frombuffer(b"".join(queries.column("code").to_pylist()), dtype="<u2").reshape(len(qv), -1)
            for i, (q, name, n) in enumerate(zip(queries.column("vec_id").to_pylist(), queries.column("name").to_pylist(), norms(qv).tolist())):
                r, others = radius, int((ids != q).sum())
                while True:
                    rows = table.within(q_codes[i], r)
                    rows = rows[ids[rows] != q]
                    if len(rows) >= min(k, others):
                        break
                    r += PART_BITS
                score = cosines(v[rows], length[rows], qv[i], n)
                best = nearest(score, ids[rows], k)
                out["query_id"] += [q] * len(best)
                out["query"] += [name] * len(best)
                out["vec_id"] += ids[rows[best]].tolist()
                out["score"] += score[best].tolist()
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))
    return run


def search(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest rows of each query."""
    index = handoff(packed_vectors(rows, key, vector).where("v is not null and vec_id is not null"), "hashing-index")
    asked = packed_vectors(queries, key, vector).where("v is not null and vec_id is not null").distinct()
    sizes = [r["size"] for r in index.groupBy(F.octet_length("v").alias("size")).agg(F.count("*").alias("n")).orderBy("size").collect()]
    out = None
    for size in sizes:  # one index for each vector size; commonly there is one
        found = _search_size(index.where(F.octet_length("v") == size), asked.where(F.octet_length("v") == size), k)
        out = found if out is None else out.union(found)
    if out is None:
        return index.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_size(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    sample = scaled(matrix(pa.chunked_array([pa.array([bytes(r["v"]) for r in index.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE_ROWS).collect()], pa.binary())])))
    rotations = fit_rotations(sample)
    radius = fit_radius(sample, rotations, k)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = encode(matrix(b.column(1)), rotations)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "v", "code"])

    n, m = index.count(), asked.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // QUERY_BLOCK))
    each = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    left = index.mapInArrow(code, "vec_id long, v binary, code binary").select("*", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), each(blocks, "part"))
    right = asked.mapInArrow(code, "vec_id long, v binary, code binary").select("*", F.xxhash64("v").alias("name"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("part"), each(shards, "shard"))
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(_search(k, radius), "query_id long, query long, vec_id long, score double")
