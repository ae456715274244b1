"""Operator 7 - BPE encoding and decoding by contiguous rank arrays.

A pre-token's symbols (bytes, the last one with the word end) are its parts.
For short words the part ids and the ranks of adjacent pairs are contiguous
rows of a matrix that holds many distinct words at once: each pass scans every
row for its minimum rank, deletes that boundary (the row closes up) and
refreshes the ranks on both sides of the merged part.  Words above
``SHORT_BYTES`` use a heap over linked parts, which gives the same merges
without a quadratic scan.

The vocabulary is a parameter and read by each Python worker; a bounded cache
keeps the ids of white-space separated chunks.  Results equal the tokenizers
library's (no truncation or padding, no special tokens added).

Defined cases: null text encodes as the empty text; strings of special tokens
in a text are special tokens; ids decode to their tokens joined by one space
(this vocabulary's file names no decoder); repeated rows give repeated rows;
the input's other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quarry.llm.common import row_slices, text_sizes

SHORT_BYTES = 64
CACHE_CHUNKS = 500_000
SLICE_BYTES = 2 << 20
NO_RANK = np.int32(2**31 - 1)
#: Separators that str.split() takes and the vocabulary's pattern doesn't.
_CONTROL_SPACE = regex.compile("[\x1c-\x1f]")
_WIDTHS = (4, 8, 12, 16, 24, 32, 48, SHORT_BYTES)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(keep) else chr(next(rest)) for b in range(256)]


class BpeCodec:
    """Vocabulary, merge ranks and the encoder's cache of one worker."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("only BPE files without decoder and post-processor are supported")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        # \s of the file's pattern is the Unicode property, not Python's notion
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.tokens = np.empty(size, dtype=object)
        for t, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = t
        letters = byte_alphabet()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.final = np.array([vocab[c + suffix] for c in letters], dtype=np.int32)
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.uint64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.uint64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self._hash(left << np.uint64(32) | right)
        self.cache: dict[str, bytes] = {}
        self.cache_chunks = cache_chunks

    def _hash(self, keys: np.ndarray) -> None:
        """Open-addressed table of the pairs, built rank by rank."""
        bits = max(4, int(len(keys) * 16).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_keys = np.full((1 << bits) + 64, np.uint64(2**64 - 1), dtype=np.uint64)
        self.slot_rank = np.full((1 << bits) + 64, NO_RANK, dtype=np.int32)
        self.factor, self.probes = np.uint64(0x9E3779B97F4A7C15), 1
        slots = ((keys * self.factor) >> self.shift).astype(np.int64)
        for rank, (slot, key) in enumerate(zip(slots.tolist(), keys)):
            k = slot
            while self.slot_keys[k] != np.uint64(2**64 - 1):
                k += 1
            self.slot_keys[k], self.slot_rank[k] = key, rank
            self.probes = max(self.probes, k - slot + 1)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of the id pairs; NO_RANK where there is none or an id is -1."""
        key = a.astype(np.uint64) << np.uint64(32) | (b.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = ((key * self.factor) >> self.shift).astype(np.int64)
        out = np.where(self.slot_keys[slot] == key, self.slot_rank[slot], NO_RANK)
        for k in range(1, self.probes):
            hit = self.slot_keys[slot + k] == key
            if hit.any():
                out[hit] = self.slot_rank[(slot + k)[hit]]
        return out

    # -- words to ids -------------------------------------------------------
    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of distinct non-empty words."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        least = 0
        for width in _WIDTHS:
            here = np.flatnonzero((size > least) & (size <= width))
            least = width
            for at in range(0, len(here), 32768):
                part = here[at:at + 32768]
                self._encode_block([words[i] for i in part.tolist()], size[part], width, part, out)
        for i in np.flatnonzero(size > SHORT_BYTES).tolist():
            out[i] = self._encode_long(words[i])
        return out

    def _encode_block(self, words: list[bytes], size: np.ndarray, width: int, where: np.ndarray, out: list[bytes]) -> None:
        n = len(words)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
        ids = self.inner[raw]
        rows = np.arange(n)
        ids[rows, size - 1] = self.final[raw[rows, size - 1]]
        ids[np.arange(width)[None, :] >= size[:, None]] = -1
        ranks = self.ranks(ids[:, :-1], ids[:, 1:])
        ranks[ids[:, 1:] < 0] = NO_RANK
        done_ids = np.full((n, width), -1, dtype=np.int32)
        while len(rows):
            low = ranks.argmin(1)
            at = np.arange(len(rows))
            rank = ranks[at, low]
            over = rank == NO_RANK
            if over.any():
                done_ids[rows[over], :ids.shape[1]] = ids[over]
                keep = ~over
                rows, ids, ranks, low, rank = rows[keep], ids[keep], ranks[keep], low[keep], rank[keep]
                if not len(rows):
                    break
                at = np.arange(len(rows))
            width_now = ids.shape[1]
            if width_now == 2:  # one pair, merged into one part
                done_ids[rows, 0] = self.merged[rank]
                break
            ids[at, low] = self.merged[rank]
            # delete the boundary: all columns behind it move up by one
            cols = np.arange(width_now - 1)
            ids = np.where(cols[None, :] <= low[:, None], ids[:, :-1], ids[:, 1:])
            ranks = np.where(cols[None, :-1] < low[:, None], ranks[:, :-1], ranks[:, 1:])
            # refresh the neighbours
            for side in (low - 1, low):
                ok = (side >= 0) & (side < width_now - 2)
                k, j = at[ok], side[ok]
                fresh = self.ranks(ids[k, j], ids[k, j + 1])
                fresh[ids[k, j + 1] < 0] = NO_RANK
                ranks[k, j] = fresh
        have = done_ids >= 0
        flat = done_ids[have].astype("<u4").tobytes()
        ends = (np.cumsum(have.sum(1)) * 4).tolist()
        begin = 0
        for i, end in zip(where.tolist(), ends):
            out[i] = flat[begin:end]
            begin = end

    def _encode_long(self, word: bytes) -> bytes:
        raw = np.frombuffer(word, dtype=np.uint8)
        ids = self.inner[raw]
        ids[-1] = self.final[raw[-1]]
        first = self.ranks(ids[:-1], ids[1:])
        part, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        current = dict((i, r) for r, i in heap)
        while heap:
            r, i = heapq.heappop(heap)
            if current.get(i) != r:
                continue
            j = after[i]
            part[i] = int(self.merged[r])
            current.pop(i, None)
            current.pop(j, None)
            part[j] = -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    fresh = int(self.ranks(np.array([part[k]]), np.array([part[after[k]]]))[0])
                    if fresh != NO_RANK:
                        current[k] = fresh
                        heapq.heappush(heap, (fresh, k))
                    else:
                        current.pop(k, None)
        return np.array([p for p in part if p >= 0], dtype="<u4").tobytes()

    # -- texts to ids -------------------------------------------------------
    @staticmethod
    def normalise(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _learn(self, chunks: set[str]) -> None:
        """Cache the ids of chunks that aren't cached."""
        letters = [c for c in chunks if c.isalpha()]
        split = [(c, self.pattern.findall(c)) for c in chunks if not c.isalpha()]
        words = list({p for _, ps in split for p in ps}.difference(letters))
        ids = self.encode_words([w.encode("utf-8", "surrogatepass") for w in letters + words])
        self.cache.update(zip(letters, ids))
        pieces = dict(zip(words, ids[len(letters):]))
        for c, ps in split:
            self.cache[c] = b"".join([pieces[p] if p in pieces else self.cache[p] for p in ps])

    def _plain(self, texts: list[str]) -> list[list[str]]:
        out = []
        for t in texts:
            t = self.normalise(t)
            out.append([p for p in self.pattern.findall(t)] if _CONTROL_SPACE.search(t) else t.split())
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32."""
        plan: list[list[str | int]] = []
        plain: list[str] = []
        for t in texts:
            if self.special_pattern is None or "<|" not in t:
                plan.append([len(plain)])
                plain.append(t)
                continue
            steps: list = []
            for k, s in enumerate(self.special_pattern.split(t)):
                if k % 2:
                    steps.append(np.array([self.specials[s]], dtype="<u4").tobytes())
                elif s:
                    steps.append(len(plain))
                    plain.append(s)
            plan.append(steps)
        chunks = self._plain(plain)
        missing = set().union(*chunks).difference(self.cache)
        if missing:
            self._learn(missing)
        get = self.cache.__getitem__
        ids = [b"".join(map(get, c)) for c in chunks]
        if len(self.cache) > self.cache_chunks:  # full: the chunks known first, the most frequent, stay
            for c in missing:
                del self.cache[c]
        return [ids[s[0]] if len(s) == 1 and isinstance(s[0], int) else b"".join(x if isinstance(x, bytes) else ids[x] for x in s) for s in plan]

    def decode(self, ids: bytes) -> str:
        return " ".join(self.tokens[np.frombuffer(ids, dtype="<u4")].tolist())


@lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    return BpeCodec(path)


def texts_of(column: pa.Array, begin: int, end: int) -> list[str]:
    return [t or "" for t in column.slice(begin, end - begin).to_pylist()]


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, ids binary: little-endian uint32) per row of ``docs``."""
    path = path or vocabulary_path()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            for begin, end in row_slices(text_sizes(b.column(1)), SLICE_BYTES):
                ids = bpe.encode_batch(texts_of(b.column(1), begin, end))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, end - begin), pa.array(ids, pa.binary())], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows (key, ids, decoded string) of rows (key, ids)."""
    path = path or vocabulary_path()
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            for begin, end in row_slices(text_sizes(b.column(1)), SLICE_BYTES):
                part = b.column(1).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(begin, end - begin), part, pa.array([bpe.decode(x or b"") for x in part.to_pylist()], pa.string())],
                    names=[key, ids, "decoded"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, {ids} binary, decoded string")
