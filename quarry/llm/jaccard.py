"""Operator 4 - n-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds 64-bit hashes of its distinct word shingles.  Sets are
ordered rarest first, by exact document frequencies, and a text indexes a
prefix of n - ceil(t n) + l tokens: two texts that reach the threshold t share
at least min(l, l') tokens of their prefixes.  Each text picks its own l from 1
up to ``MAX_MATCH``: a longer prefix reads more postings, but asks for more
shared tokens before the two sets are verified; the l of the least estimated
cost wins.  A pair also needs enough common tokens on both sides.

Jobs: (1) every block of texts sends its tokens, three bytes each, to buckets,
which find those that two texts have; (2) the blocks get them back with their
frequencies.  A token of one text can't match, so the prefixes' other tokens
become postings, and only the common tokens of indexed texts are kept for
verification.  (3) Only components are wanted, so a posting list is not
expanded into pairs: first the list's centre (its most typical member) is
verified against the members of other components, and lists inside one
component are dropped.  Texts that share a prefix token then belong to the
family of that list's centre, so every candidate pair lies in some family.  A
family's texts are compared in tiles of at most two blocks: products of its
token matrices count the shared prefix tokens of all pairs at once, those that
share enough are verified by their whole sets in the same way, and a tile returns one link for a text,
never its pairs.  So no link between components is lost, and families of texts
that share most shingles but stay below the threshold make no rows.

Equal texts are one from the start, texts with equal sets one node.  Blocks
are hashes of the text, so no block follows a source or a group of copies.

Defined cases: null or blank texts have empty sets and link with nothing; a
text with fewer words than a shingle is one token; repeated rows and equal
sets share a component; ``component_id`` is the smallest doc_id (null only
where all of a component's are); an empty table gives no rows; other columns
are ignored.  Hashes are 64 bits: a set's size or a pair's overlap is wrong by
a collision with a probability below 2**-40 for sets under a million shingles.
The bytes of a token that travel in job 1 only decide what may be left out: two
tokens that agree in them are kept needlessly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import RollingBytes, Roots, connected_components, discard, handoff, mix64, row_slices, text_batches, tidy, tidy_group
from quarry.llm.packed import packed_blocks, unpack
from quarry.llm.shared import SCHEMA, SharedKeys, key_rows, shared_keys, slices

WORDS = 5
THRESHOLD = 80  # per cent
MAX_MATCH = 6
#: Cost of a verification in posting reads, per token of the set.
VERIFY_COST = 0.25
CHUNK = 1 << 20
BLOCK_BYTES = 4 << 20
#: Tokens that one bucket compares, about.
BUCKET_TOKENS = 500_000
#: A block of a family: texts, and tokens of theirs.
FAMILY_TEXTS, FAMILY_TOKENS = 512, 1 << 18
#: Tokens that a task compares, about, and columns of a token matrix.
TILE_TOKENS, COLUMNS = 1 << 20, 4096
#: A token in so many pairs or more is counted by a matrix product.
DENSE_PAIRS = 64
#: Up to so many families of several blocks (one for FAMILY_TEXTS texts) are broadcast.
BROADCAST_FAMILIES = 50_000
#: Up to so many copies (40 bytes each) are broadcast, to leave them out of
#: job 1; with more their tokens only pass needlessly.
BROADCAST_COPIES = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a buffer of bytes."""
    data = _LOWER[data]
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return start, RollingBytes(data).ranges(start, end)


def _factors(k: int) -> np.ndarray:
    return mix64(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def _long_words(text: bytes) -> np.ndarray:
    """Word hashes of one long text, read in parts that end between words."""
    out, at = [], 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        out.append(_word_hashes(np.frombuffer(text, dtype=np.uint8, count=min(end, len(text)) - at, offset=at))[1])
        at = end
    return np.concatenate(out)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    factor, out = _factors(words), []
    for lo, hi in row_slices(sizes, CHUNK):
        if hi == lo + 1 and len(texts[lo]) > CHUNK:
            per_text = [_long_words(texts[lo])]
        else:
            start, h = _word_hashes(np.frombuffer(b" ".join(texts[lo:hi]), dtype=np.uint8))
            begin = np.cumsum(sizes[lo:hi]) - sizes[lo:hi]
            per_text = np.split(h, np.searchsorted(start, begin[1:]))
        for h in per_text:
            n = len(h)
            if n >= words:
                s = h[:n - words + 1] * factor[0]
                for j in range(1, words):
                    s += h[j:n - words + 1 + j] * factor[j]
                out.append(np.unique(mix64(s)))
            elif n:
                out.append(mix64((h * factor[:n]).sum(keepdims=True) + np.uint64(n)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def _node(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def choose_match(df: np.ndarray, size: int, required: int) -> int:
    """The l of the least estimated cost; ``df``: document counts of the set's
    rarest tokens, rarest first."""
    base, most = size - required, min(MAX_MATCH, required)
    reads = np.cumsum(df[:base + most] - 1.0)[base:]  # of the prefixes for l = 1..most
    l = np.arange(1, most + 1)
    # each candidate takes at least l of the postings read
    return int(np.argmin(base + l + reads + reads / l * (VERIFY_COST * size))) + 1


# -- job 2: postings and sets of each block ---------------------------------------
_BLOCK_ROWS = pa.schema([("kind", pa.int32()), ("h", pa.string()), ("n", pa.int64()), ("l", pa.int64()), ("node", pa.int64()), ("rank", pa.int32()), ("tokens", pa.binary())])


def _index_block(words: int, percent: int, buckets: int):
    """Kind 0: size and node of every text (by its hash h); kind 1: the
    indexed nodes with their common tokens, those of the prefix first."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows:
            common = SharedKeys(right.column("bucket").to_pylist(), right.column("data").to_pylist(), buckets)
            docs, seen_text, seen_node = unpack(left.column("data").to_pylist()), set(), set()
            hashes = docs.column("h").to_pylist()
            for lo, texts in slices(docs.column("text").combine_chunks()):
                for h, s in zip(hashes[lo:lo + len(texts)], shingle_sets(texts, words)):
                    if h in seen_text:
                        continue
                    seen_text.add(h)
                    node, n = _node(s) if len(s) else None, len(s)
                    out.append((0, h, n, None, node, None, None))
                    if not n or not len(common.known) or node in seen_node:
                        continue
                    seen_node.add(node)
                    df = common.texts_with(s)
                    required = (percent * n + 99) // 100
                    rare = int(np.count_nonzero(df == 1))
                    if rare >= n - required + min(MAX_MATCH, required):  # every prefix ends among its own tokens
                        continue
                    order = np.lexsort((s, df))
                    match = choose_match(df[order].astype(float), n, required)
                    size = n - required + match
                    if rare >= size:
                        continue
                    mine = s[order[rare:]]
                    out.append((1, None, n, match, node, 255 * rare // n, (size - rare).to_bytes(4, "little") + mine.tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, _BLOCK_ROWS.types)], schema=_BLOCK_ROWS)
    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        token, size = [], []
        for x in b.column(2).to_pylist():
            n = int.from_bytes(x[:4], "little")
            token.append(np.frombuffer(x, dtype=np.int64, count=n, offset=4))
            size.append(n)
        if token:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token)), pa.array(np.repeat(b.column(0).to_numpy(), size)), pa.array(np.repeat(b.column(1).to_numpy(), size))], names=["token", "node", "rank"])


def _sorted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.sort(np.frombuffer(x, dtype=np.uint64, offset=4)).tobytes() for x in b.column(1).to_pylist()], pa.binary())], names=["node", "tokens"])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = [len(np.intersect1d(np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64), assume_unique=True))
                for x, y in zip(b.column(2), b.column(3))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(4), b.column(5), pa.array(both, pa.int64())], names=["a", "b", "na", "nb", "both"])


# -- families ------------------------------------------------------------------------
def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each left set shares with each right set."""
    out = np.zeros(len(left) * len(right), dtype=np.int64)
    size = [np.fromiter(map(len, s), dtype=np.int64, count=len(s)) for s in (left, right)]
    owner = [np.repeat(np.arange(len(s)), k) for s, k in zip((left, right), size)]
    token, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    code = [code[:len(owner[0])], code[len(owner[0]):]]
    count = [np.bincount(c, minlength=len(token)) for c in code]
    pairs = count[0] * count[1]
    dense = np.flatnonzero(pairs >= DENSE_PAIRS)
    if len(dense):
        place = np.full(len(token), -1)
        place[dense] = np.arange(len(dense))
        total = np.zeros((len(left), len(right)), dtype=np.float32)  # counts below 2**24
        for lo in range(0, len(dense), COLUMNS):
            sides = []
            for c, o, s in zip(code, owner, (left, right)):
                at = place[c] - lo
                has = (at >= 0) & (at < COLUMNS)
                m = np.zeros((len(s), min(COLUMNS, len(dense) - lo)), dtype=np.float32)
                m[o[has], at[has]] = 1
                sides.append(m)
            total += sides[0] @ sides[1].T
        out += total.astype(np.int64).ravel()
    few = (pairs > 0) & (pairs < DENSE_PAIRS)
    keep = [few[c] for c in code]
    a, b = (np.stack([c[k], o[k]]) for c, k, o in zip(code, keep, owner))
    b = b[:, np.argsort(b[0], kind="stable")]
    begin = np.searchsorted(b[0], a[0])
    n = count[1][a[0]]
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    out += np.bincount(np.repeat(a[1], n) * len(right) + b[1][at], minlength=len(out))
    return out.reshape(len(left), len(right))


def _families(percent: int):
    """For applyInArrow by (bucket, i, j): small families whole, or two blocks
    of a large one; rows (a, b) join each linked text to one of the others."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("family")
        family, own, node, comp, n, l = (table.column(c).to_numpy() for c in ("family", "own", "node", "comp", "n", "l"))
        data = table.column("tokens").combine_chunks()
        roots = Roots(len(node))
        first = np.flatnonzero(np.append(True, family[1:] != family[:-1]))
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(family)]):
            if hi - lo < 2 or (comp[lo:hi] == comp[lo]).all():
                continue
            sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64, offset=4) for x in data[lo:hi]]
            heads = [s[:int.from_bytes(x.as_buffer()[:4].to_pybytes(), "little")] for s, x in zip(sets, data[lo:hi])]
            whole = own[lo] == 2
            a, b = (np.arange(hi - lo),) * 2 if whole else (np.flatnonzero(own[lo:hi] == k) for k in (0, 1))
            if not len(a) or not len(b):
                continue
            common = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
            mine = lambda x: (x[lo:hi][a][:, None], x[lo:hi][b][None, :])
            (na, nb), (la, lb), (pa_, pb) = mine(n), mine(l), mine(comp)
            ca, cb = common[a][:, None], common[b][None, :]
            may = ((overlaps([heads[x] for x in a], [heads[x] for x in b]) >= np.minimum(la, lb)) & (pa_ != pb)
                   & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * np.minimum(ca, cb) >= percent * (na + nb)))
            if whole:
                may = np.triu(may, 1)
            x, y = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
            if not len(x):
                continue
            both = overlaps([sets[k] for k in a[x]], [sets[k] for k in b[y]])
            linked = may[np.ix_(x, y)] & (100 * both >= percent * (na[x] + nb[:, y] - both))
            p, q = np.nonzero(linked)
            roots.link(a[x[p]] + lo, b[y[q]] + lo)
        moved = np.flatnonzero(roots.root != np.arange(len(node)))
        return pa.table({"a": pa.array(node[roots.root[moved]]), "b": pa.array(node[moved])})
    return run


class _Join:
    """The job's tables: measured (doc_id, n, node), about (node, n, l),
    postings (token, node, rank) and sets (node, tokens)."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.percent = percent
        text_batches(docs.sparkSession)
        body = F.coalesce("text", F.lit(""))
        docs = docs.select("doc_id", body.alias("text"), F.sha2(body, 256).alias("h"))
        meta = handoff(docs.select("doc_id", "h", F.octet_length("text").alias("size")), "jaccard-meta")
        total = meta.agg(F.sum("size")).first()[0] or 0
        blocks, buckets = max(1, -(-total // BLOCK_BYTES)), max(64, -(-total // (6 * BUCKET_TOKENS)))
        block = F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int")
        least = meta.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
        copies = handoff(meta.join(least, "h").where("doc_id > least").select("doc_id", "h").distinct(), "jaccard-copies")
        once = docs.join(F.broadcast(copies), ["doc_id", "h"], "left_anti") if copies.count() <= BROADCAST_COPIES else docs
        tokens = once.select("text", block.alias("block")).mapInArrow(tidy(key_rows(partial(shingle_sets, words=words), buckets)), "bucket int, data binary")
        common = tokens.groupBy("bucket").applyInArrow(tidy_group(shared_keys), SCHEMA)
        texts = packed_blocks(once.select("h", "text", block.alias("block")))
        schema = "kind int, h string, n long, l long, node long, rank int, tokens binary"
        rows = handoff(texts.groupBy("block").cogroup(common.groupBy("block")).applyInArrow(tidy_group(_index_block(words, percent, buckets), 2), schema), "jaccard-index")
        self.measured = handoff(meta.join(rows.where("kind = 0").select("h", "n", "node"), "h").select("doc_id", "n", "node"), "jaccard-measured")
        # texts of one node may lie in different blocks: any of them serves
        nodes = rows.where("kind = 1").select("node", "n", "l", "rank", "tokens").dropDuplicates(["node"])
        nodes = handoff(nodes, "jaccard-nodes")
        discard(rows, meta, copies)
        self.nodes = nodes
        # c: tokens that other texts have too; no overlap is larger
        self.about = nodes.select("node", "n", "l", ((F.octet_length("tokens") - 4) / 8).cast("long").alias("c"))
        self.sets = nodes.select("node", "tokens").mapInArrow(tidy(_sorted_sets), "node long, tokens binary")
        postings = nodes.select("node", "rank", "tokens").mapInArrow(tidy(_postings), "token long, node long, rank int")
        self.postings = handoff(postings, "jaccard-postings")
        self.holders = self.measured.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def _may_link(self, n1: str, n2: str, c1: str, c2: str) -> Column:
        """Sizes and common tokens allow the threshold."""
        return ((100 * F.least(n1, n2) >= self.percent * F.greatest(n1, n2))
                & ((100 + self.percent) * F.least(c1, c2) >= self.percent * (F.col(n1) + F.col(n2))))

    def _sized(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, shared) that may reach the threshold, with sizes."""
        side = lambda x: self.about.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("l").alias(f"l{x}"), F.col("c").alias(f"c{x}"))
        return (pairs.join(side("a"), "a").join(side("b"), "b")
                .where((F.col("shared") >= F.least("la", "lb")) & self._may_link("na", "nb", "ca", "cb"))
                .select("a", "b", "na", "nb"))

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """The linked pairs (a, b) of candidate pairs, by whole sets: tokens
        that one text alone has aren't in an intersection."""
        joined = (pairs.join(self.sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
                  .join(self.sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
                  .select("a", "b", "ta", "tb", "na", "nb"))
        out = joined.mapInArrow(tidy(_overlap), "a long, b long, na long, nb long, both long")
        return handoff(out.where(100 * F.col("both") >= self.percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b").distinct(), f"jaccard-{name}-links")

    def labelled(self, links: DataFrame | None, name: str) -> DataFrame:
        """Postings with the component of their node, without tokens that lie
        in one component."""
        rows = self.postings.withColumn("comp", F.col("node"))
        if links is not None:
            rows = (self.postings.join(connected_components(links, f"jaccard-{name}").withColumnRenamed("component", "comp"), "node", "left")
                    .withColumn("comp", F.coalesce("comp", "node")))
        mixed = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
        return handoff(rows.join(mixed, "token"), f"jaccard-{name}-mixed")

    @staticmethod
    def _typical(turn: int) -> Column:
        """The centre of a list is its member with the least of these."""
        return F.struct("rank", F.xxhash64(F.col("node"), F.lit(turn)), F.col("node").alias("a"), F.col("comp").alias("ca"))

    def star(self, rows: DataFrame) -> DataFrame:
        """Candidates of the lists' centres with the members of other components."""
        centre = rows.groupBy("token").agg(F.min(self._typical(0)).alias("c")).select("token", "c.a", "c.ca")
        pairs = rows.join(centre, "token").where("comp <> ca").select("a", F.col("node").alias("b"))
        return self._sized(pairs.groupBy("a", "b").agg(F.count("*").alias("shared")))

    def rest(self, rows: DataFrame) -> DataFrame:
        """Links (a, b) between components: the families' tiles."""
        centre = rows.groupBy("token").agg(F.min(self._typical(0)).alias("c")).select("token", F.col("c.a").alias("family"))
        members = rows.join(centre, "token").select("family", "node", "comp").distinct()
        members = handoff(members.join(self.about, "node"), "jaccard-members")
        blocks = F.greatest(F.ceil(F.col("texts") / FAMILY_TEXTS), F.ceil(F.col("tokens") / FAMILY_TOKENS)).cast("int")
        large = handoff(members.groupBy("family").agg(F.count("*").alias("texts"), F.sum("c").alias("tokens"))
                        .select("family", F.when(F.col("texts") > 1, blocks).otherwise(1).alias("blocks")).where("blocks > 1"), "jaccard-large")
        side = F.broadcast(large) if large.count() <= BROADCAST_FAMILIES else large
        # a block of a large family meets itself (own 2) and each other block (own 0 or 1)
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        tiles = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(2).alias("own")))).otherwise(
            F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
                F.least(x, block).alias("i"), F.greatest(x, block).alias("j"), F.when(x == block, 2).when(block < x, 0).otherwise(1).alias("own"))))
        total = members.agg(F.sum("c")).first()[0] or 0
        buckets = max(1, -(-total // TILE_TOKENS))
        dealt = (members.join(side, "family", "left").select("family", "node", "comp", "n", "l", F.explode(tiles).alias("t")).select("family", "node", "comp", "n", "l", "t.*")
                 .join(self.nodes.select("node", "tokens"), "node").withColumn("bucket", F.pmod(F.xxhash64("family"), F.lit(buckets)).cast("int")))
        found = dealt.repartition(buckets, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(tidy_group(_families(self.percent)), "a long, b long")
        out = handoff(found, "jaccard-families")
        discard(members, large)
        return out

    def links(self) -> list[DataFrame]:
        """Tables of verified links (a, b) that connect what links connect."""
        rows = self.labelled(None, "star")
        first = self.verify(self.star(rows), "star")
        discard(rows)
        rows = self.labelled(first, "family")
        second = self.rest(rows)
        discard(rows, self.nodes, self.postings)
        return [first, second]


def components(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (doc_id, n_shingles, component_id) for each row of ``docs``."""
    join = _Join(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), words, percent)
    found = join.links()
    parts = connected_components(reduce(DataFrame.union, found), "jaccard-all")
    discard(*found)
    # nodes to components to the smallest doc_id of a component
    of = handoff(join.holders.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("part"), "doc_id"), "jaccard-parts")
    least = of.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    named = of.join(least, "part").select("node", "component_id")
    full = join.measured.where("node is not null").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = join.measured.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(empty)
