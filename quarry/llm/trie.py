"""Operator 13 - conversation prefix trie by time-forward processing.

A node is a distinct sequence of first turns; it is named by its depth and a
128-bit hash of the sequence.  The hash is a sum of turn digests times powers
of an odd number, so a conversation's prefix hashes are running sums: rows are
range-sorted by conversation and turn, every partition sums what it has, and
what a partition's first conversation brings from the partitions before it is
added afterwards.  No conversation has to fit a task.  A prefix without its last
turn has the hash less the last term, so a row knows its parent without a join.

Subtree totals flow from the deepest nodes upwards.  The trie is cut into
pieces: a node shared by more than ``HEAVY`` conversations (and by more than a
ten-thousandth of all turns) is heavy, all others belong to the piece of their
topmost light ancestor within a band of ``BAND`` levels.  A shard holds whole pieces, sorted by
reverse level order (Spark's external sort); its task reads the nodes once,
takes the totals that children sent from a priority queue, which spills to
anonymous scratch files of the task, and sends its own total to the parent.  Then
the same goes across the shards' roots: pieces in bands below one another become
nodes of a smaller tree with longer bands, until one band holds all, and back
down with the totals that come from outside a piece; what reaches the heavy nodes, of which
there are some ten thousand at most, is summed before they are processed in the
same way.

Defined cases: rows without conversation id are left out; null role and text
are empty; turns of equal number (null first) are ordered by role, then by the
digest of role and text; repeated rows are turns of their own; of a negative id
the remainder is negative too (-5 belongs to 0); other columns are ignored; a
table without ids gives no rows.  Hashes of two different sequences agree with
a probability below 2**-100.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import discard, handoff

#: Levels of a band; the bands of the next tree have BAND times as many.
BAND = 512
#: Conversations that make a node heavy, at least.
HEAVY = 256
#: Rows of a partition or shard, about.
SHARD_ROWS = 200_000
#: Messages that a queue holds in memory.
HELD = 200_000
CHUNK = 1 << 16
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1
KEY = ["depth", "k1", "k2"]
_WORDS = "[^\\\\x20\\\\x09-\\\\x0D]+"


# -- turns ----------------------------------------------------------------------------
def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversation ids): every conversation c starts with the first h
    turns of c - c % group, h = crc32(c) % heads, and goes on with its own
    turns after its first h.  Turns are (c, origin, pos, turn, role, digest,
    rid, words), in the order of these columns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, 16)
    own = handoff(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"),
        F.expr(f"regexp_count(coalesce(text, ''), '{_WORDS}')").cast("long").alias("words")).withColumn("rid", F.monotonically_increasing_id()), "trie-turns")
    taken = F.crc32(F.col("c").cast("string").cast("binary")) % heads
    order = Window.partitionBy("c").orderBy(F.asc_nulls_first("turn"), "role", "digest", "rid")
    first = handoff(own.withColumn("pos", F.row_number().over(order)).where(F.col("pos") < heads), "trie-first")
    ids = handoff(own.select("c").distinct(), "trie-ids")
    lent = first.where(F.col("c") % group == 0).select(F.col("c").alias("s"), "pos", "digest", "words")
    lent = (ids.select("c", (F.col("c") - F.col("c") % group).alias("s"), taken.alias("h")).join(lent, "s").where("pos <= h")
            .select("c", F.lit(0).alias("origin"), "pos", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), "digest", F.lit(0).cast("long").alias("rid"), "words"))
    kept = own.join(first.where(F.col("pos") <= taken).select("rid"), "rid", "left_anti")
    return lent.union(kept.select("c", F.lit(1), F.lit(0), "turn", "role", "digest", "rid", "words")), ids


# -- prefix hashes ----------------------------------------------------------------------
def _powers(base: int, n: int) -> np.ndarray:
    out, done = np.ones(max(n, 1), dtype=np.uint64), 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_SCAN = "last int, part int, opening boolean, c long, depth long, h1 long, h2 long, t1 long, t2 long, words long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depths and prefix hashes as far as this partition knows, and at its end
    a row (last = 1) with its last conversation's figures, t1 its first one."""
    names = [x.split()[0] for x in _SCAN.split(", ")]
    part = TaskContext.get().partitionId()
    at, begin, count, sums, opening = None, None, 0, [0, 0], True
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        c = b.column(0).to_numpy()
        digest = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype="<u8").reshape(n, 2)
        start = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        run = np.repeat(np.arange(len(start)), np.diff(np.append(start, n)))
        depth = np.arange(n) - start[run]
        goes_on = at is not None and c[0] == at
        if begin is None:
            begin = int(c[0])
        if not goes_on:
            count, sums = 0, [0, 0]
            opening = at is None
        before = np.where(run == 0, count, 0)
        is_opening = (run == 0) & opening
        hashes, terms = [], []
        for lane in (0, 1):
            term = digest[:, lane] * _powers(_BASES[lane], n)[depth]
            term[run == 0] *= np.uint64(pow(_BASES[lane], count, 1 << 64))
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term)])
            h = total[1:] - total[start][run]
            h[run == 0] += np.uint64(sums[lane])
            hashes.append(h)
            terms.append(term)
        depth = depth + before + 1
        at, count, sums, opening = int(c[-1]), int(depth[-1]), [int(h[-1]) for h in hashes], bool(is_opening[-1])
        columns = [np.zeros(n, dtype=np.int32), np.full(n, part, dtype=np.int32), is_opening, c, depth, *(x.view(np.int64) for x in (*hashes, *terms)), b.column(2).to_numpy()]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)
    if at is not None:
        signed = [int(np.array(x, dtype=np.uint64).view(np.int64)) for x in sums]
        row = [1, part, opening, at, count, *signed, begin, 0, 0]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 7])], names=names)


def _carried(ends: list) -> dict[int, tuple[int, int, int]]:
    """By partition: depth and hashes that its first conversation brings."""
    out: dict[int, tuple[int, int, int]] = {}
    before = None
    for e in ends:
        carry = before[1] if before and before[0] == e["t1"] else (0, 0, 0)
        if carry[0]:
            out[e["part"]] = carry
        d, *h = carry if e["opening"] else (0, 0, 0)
        mine = [(h[i] + pow(_BASES[i], d, 1 << 64) * (e[f"h{i + 1}"] & _MASK)) & _MASK for i in (0, 1)]
        before = (e["c"], (d + e["depth"], *mine))
    return out


def prefixes(turns: DataFrame, rows: int) -> DataFrame:
    """Rows (c, depth, k1, k2, q1, q2, words), one for each turn: the hashes of
    the prefix that ends with it and of the one before."""
    order = ["c", "origin", "pos", F.asc_nulls_first("turn"), "role", "digest", "rid"]
    ranged = turns.repartitionByRange(rows // SHARD_ROWS + 4, *order).sortWithinPartitions(*order)
    scanned = handoff(ranged.select("c", "digest", "words").mapInArrow(_scan, _SCAN), "trie-scan")
    carried = _carried(scanned.where("last = 1").orderBy("part").collect())  # a row for each partition

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, opening, c, depth, h1, h2, t1, t2, words = (x.to_numpy(zero_copy_only=False) for x in b.columns)
            depth, keys = depth.copy(), [h1.view(np.uint64).copy(), h2.view(np.uint64).copy()]
            terms = [t1.view(np.uint64).copy(), t2.view(np.uint64).copy()]
            for p in np.unique(part[opening]).tolist():
                if p in carried:
                    of, (d, *h) = opening & (part == p), carried[p]
                    depth[of] += d
                    for lane in (0, 1):
                        up = np.uint64(pow(_BASES[lane], d, 1 << 64))
                        keys[lane][of] = keys[lane][of] * up + np.uint64(h[lane])
                        terms[lane][of] *= up
            parents = [k - t for k, t in zip(keys, terms)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (c, depth, *(k.view(np.int64) for k in keys), *(p.view(np.int64) for p in parents), words)],
                                             names=["c", "depth", "k1", "k2", "q1", "q2", "words"])

    out = handoff(scanned.where("last = 0").select("part", "opening", "c", "depth", "h1", "h2", "t1", "t2", "words")
                  .mapInArrow(add, "c long, depth long, k1 long, k2 long, q1 long, q2 long, words long"), "trie-prefixes")
    discard(scanned)
    return out


# -- time-forward processing ---------------------------------------------------------------
class SpillingQueue:
    """A priority queue of tuples that holds ``held`` of them in memory and
    sorted runs of the rest in scratch files without a name, which the system
    takes back even if the task is lost."""

    RUNS, BLOCK = 32, 4096

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.heads, self.runs = held, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.held:
            self.heap.sort()
            self._keep(iter(self.heap))
            self.heap = []
            if len(self.heads) > self.RUNS:
                runs, self.heads = self.heads, []
                self._keep(heapq.merge(*(self._whole(head, rest) for head, _, rest in runs)))

    @staticmethod
    def _whole(head: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
        yield head
        yield from rest

    def _keep(self, items: Iterator[tuple]) -> None:
        file, block = tempfile.TemporaryFile(), []
        for item in items:
            block.append(item)
            if len(block) == self.BLOCK:
                pickle.dump(block, file)
                block = []
        pickle.dump(block, file)
        file.seek(0)
        self._advance(self._read(file))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: Iterator[tuple]) -> None:
        head = next(run, None)
        if head is not None:
            self.runs += 1  # told apart by number, iterators don't compare
            heapq.heappush(self.heads, (head, self.runs, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """Remove and give the items that start with ``key``, if it is the least."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:n] == key:
            head, _, run = heapq.heappop(self.heads)
            self._advance(run)
            yield head

    def __len__(self) -> int:
        return len(self.heap) + len(self.heads)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of a shard's nodes, which come in reverse level order."""
    queue = SpillingQueue()
    for b in batches:
        leaves, saved = [], []
        columns = [x.to_pylist() for x in b.columns]
        for depth, k1, k2, pdepth, p1, p2, inside, l, s in zip(*columns):
            for _, _, _, more_l, more_s in queue.take((-depth, k1, k2)):
                l += more_l
                s += more_s
            if inside:
                queue.push((-pdepth, p1, p2, l, s))
            leaves.append(l)
            saved.append(s)
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=[*KEY, "leaves", "saved"])
    if len(queue):
        raise RuntimeError("a shard has no node for a message sent in it")


def _totals(tree: DataFrame, values: DataFrame, shards: int, name: str) -> DataFrame:
    """Rows (key, leaves, saved): each node's value and those of all below it
    in its piece; ``tree``: key, parent pdepth, p1, p2, piece e, r1, r2, inside."""
    nodes = tree.join(values, KEY).repartition(shards, "e", "r1", "r2").sortWithinPartitions(F.desc("depth"), "k1", "k2")
    out = nodes.select(*KEY, "pdepth", "p1", "p2", "inside", "leaves", "saved").mapInArrow(_forward, "depth long, k1 long, k2 long, leaves long, saved long")
    return handoff(out, name)


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _up(depth: Column, band: int) -> Column:
    """The depth of a light node's piece root, in bands of so many levels."""
    return F.greatest(F.col("heavy") + 1, depth - depth % band)


def _light_totals(light: DataFrame, rows: DataFrame, deepest: int, shards: int, band: int) -> DataFrame:
    """Subtree totals of the light nodes: key, parent q1, q2, member c, heavy
    (depth of its deepest heavy ancestor), own leaves and saved."""
    places = rows.select("c", F.col("depth").alias("at"), F.col("k1").alias("a1"), F.col("k2").alias("a2"))

    def at(table: DataFrame, depth: Column, names: tuple[str, str, str]) -> DataFrame:
        """With the node that the member has at a depth."""
        return (table.withColumn("at", depth).join(places, ["c", "at"])
                .withColumnsRenamed(dict(zip(("at", "a1", "a2"), names))))

    trees, width = [], band
    while True:
        d = F.col("depth")
        if not trees:
            t = light.select(*KEY, "c", "heavy", (d - 1).alias("pdepth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
        else:  # the roots of the pieces so far, each below the piece of its parent
            below = width // band
            t = light.where(_up(d, below) == d).select(*KEY, "c", "heavy")
            inner = at(t.where("depth > heavy + 1"), _up(d - 1, below), ("pdepth", "p1", "p2"))
            t = inner.select(*KEY, "c", "heavy", "pdepth", "p1", "p2").union(t.where("depth = heavy + 1").select(*KEY, "c", "heavy", d - 1, F.lit(0), F.lit(0)))
        t = at(t, _up(d, width), ("e", "r1", "r2")).withColumn("inside", F.col("e") < d)
        trees.append(handoff(t.drop("c"), f"trie-tree{len(trees)}"))
        if width > deepest:
            break
        width *= band
    values = [light.select(*KEY, "leaves", "saved")]
    for k, t in enumerate(trees):
        total = _totals(t, values[k], shards, f"trie-up{k}")
        values.append(total.join(t.where("not inside").select(*KEY), KEY, "left_semi"))
    for k in range(len(trees) - 2, -1, -1):
        t = trees[k]
        sent = (t.where("not inside and depth > heavy + 1").join(total, KEY)
                .select(F.col("pdepth").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "leaves", "saved"))
        total = _totals(t, _sums(values[k].union(_sums(sent))), shards, f"trie-down{k}")
    discard(*trees)
    return total


# -- ends ------------------------------------------------------------------------------
def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, c) to rows (key, first, ids): runs of a node's ids."""
    key, first, ids, size, out = None, 0, [], 0, []
    for b in batches:
        for *k, c in zip(*(x.to_pylist() for x in b.columns)):
            if k != key or size > CHUNK:
                if ids:
                    out.append((*key, first, ",".join(ids)))
                key, first, ids, size = k, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if out:
            yield _rows(out, [*KEY, "first", "ids"])
            out = []
    if ids:
        yield _rows([(*key, first, ",".join(ids))], [*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to rows (key, ends): the digest of a node's joined ids."""
    key, digest, out = None, None, []
    for b in batches:
        for *k, _, ids in zip(*(x.to_pylist() for x in b.columns)):
            if k == key:
                digest.update(b"," + ids.encode())
                continue
            if key:
                out.append((*key, digest.hexdigest()))
            key, digest = k, hashlib.sha256(ids.encode())
        if out:
            yield _rows(out, [*KEY, "ends"])
            out = []
    if key:
        yield _rows([(*key, digest.hexdigest())], [*KEY, "ends"])


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)


def _end_digests(ends: DataFrame, parts: int) -> DataFrame:
    order = [*KEY, "c"]
    chunks = (ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .mapInArrow(_chunks, "depth long, k1 long, k2 long, first long, ids string"))
    return (chunks.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(_digests, "depth long, k1 long, k2 long, ends string"))


# -- the trie -----------------------------------------------------------------------------
def trie(turns: DataFrame, ids: DataFrame, band: int = BAND, heavy_from: int = HEAVY) -> DataFrame:
    """One row for each node of the trie of conversations: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256; ``turns`` and ``ids`` as ``rebuilt`` gives them."""
    turns = handoff(turns, "trie-rebuilt")
    n_rows, n_ids = turns.count(), ids.count()
    if not n_ids:
        return ids.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    parts = n_rows // SHARD_ROWS + 4
    rows = prefixes(turns, n_rows)
    discard(turns)
    root = ids.agg(F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(k) for k in ("k1", "k2", "q1", "q2")),
                   F.count("*").alias("n_convs"), F.min("c").alias("c"), F.lit(0).cast("long").alias("words"))
    distinct = handoff(rows.groupBy(*KEY).agg(F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.count("*").alias("n_convs"), F.min("c").alias("c"), F.min("words").alias("words"))
                       .unionByName(root), "trie-distinct")
    children = distinct.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    leaves = (F.col("n_children") == 0).cast("long").alias("leaves")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    is_heavy = (F.col("depth") == 0) | (F.col("n_convs") > max(heavy_from, n_rows // 10_000))
    nodes = handoff(distinct.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                    .select("*", leaves, saved, is_heavy.alias("is_heavy")), "trie-nodes")
    discard(distinct)
    # sum of n_convs over all nodes but the root is n_rows: at most 10,000 such nodes
    heavy = nodes.where("is_heavy")
    ends = rows.groupBy("c").agg(F.max(F.struct(*KEY)).alias("end")).select("c", "end.*")
    ends = handoff(ids.join(ends, "c", "left").na.fill(0, KEY), "trie-ends")
    deepest = nodes.agg(F.max("depth")).first()[0]

    # how far down each conversation is heavy; a row for each of its bands, so a long one is no hot key
    reach = rows.join(F.broadcast(heavy.select(*KEY)), KEY, "left_semi").groupBy("c").agg(F.max("depth").alias("heavy"))
    reach = (ends.join(reach, "c", "left").select("c", F.coalesce("heavy", F.lit(0).cast("long")).alias("heavy"),
                                                  F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"depth div {band}"))).alias("band")))
    light = handoff(nodes.where("not is_heavy").withColumn("band", F.expr(f"depth div {band}")).join(reach, ["c", "band"])
                    .select(*KEY, "q1", "q2", "c", "heavy", "leaves", "saved"), "trie-light")
    below = _light_totals(light, rows, deepest, parts, band)
    tops = light.where("depth = heavy + 1").select(*KEY, "q1", "q2").join(below, KEY)
    sent = tops.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2"), "leaves", "saved")
    crown = heavy.select(*KEY, (F.col("depth") - 1).alias("pdepth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"),
                         *(F.lit(0).alias(x) for x in ("e", "r1", "r2")), (F.col("depth") > 0).alias("inside"))
    above = _totals(crown, _sums(heavy.select(*KEY, "leaves", "saved").union(_sums(sent))), 1, "trie-heavy")

    # parents' names: of heavy parents from the broadcast, of others by a join
    parent = lambda t, name: t.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("c").alias(name))
    link = ["depth", "q1", "q2"]
    named = nodes.join(F.broadcast(parent(heavy, "parent_conv_id")), link, "left")
    deep = named.where("parent_conv_id is null and depth > 0").drop("parent_conv_id").join(parent(nodes.where("not is_heavy"), "parent_conv_id"), link)
    named = named.where("parent_conv_id is not null or depth = 0").unionByName(deep)
    none = F.sha2(F.lit("").cast("binary"), 256)
    out = (named.drop("leaves", "saved").join(below.union(above), KEY).join(_end_digests(ends, n_ids // SHARD_ROWS + 4), KEY, "left")
           .select(F.col("c").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                   F.col("saved").alias("saved_tokens"), F.coalesce("ends", none).alias("ends_sha256")))
    return out
