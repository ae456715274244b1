import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe, packing
from quarry.llm.queries import QUERIES
from tests.llm.helpers import odd_documents

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    e = LIBRARY.encode(text or "", add_special_tokens=False)
    return e.ids, LIBRARY.decode(e.ids, skip_special_tokens=False)


def test_codec_equals_the_library_on_odd_texts():
    codec, rnd, bad = bpe.BpeCodec(PATH, cache_chunks=500), random.Random(1), []
    letters = "abcdeEIT 's'll  \t\n\x1c\x1f\x85\xa0​　.,!#é́eΣςİıßﬁ日本語한국🤷‍♀️12³½٣ǅᾳ<|endoftext|>"
    for k in range(1500):
        s = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        s += "<|endoftext|>x<|startoftext|>" if k % 10 == 0 else ""
        s += "".join(rnd.choice("abcde") for _ in range(rnd.randint(60, 400))) if k % 50 == 0 else ""
        ids, back = expected(s)
        got = codec.encode_batch([s])[0]
        if np.frombuffer(got, "<u4").tolist() != ids or codec.decode(got) != back:
            bad.append(s)
    assert not bad


def test_rank_array_equals_the_heap():
    codec, rnd = bpe.BpeCodec(PATH), random.Random(2)
    words = list({"".join(rnd.choice("thean") for _ in range(rnd.randint(1, bpe.SHORT_BYTES))).encode() for _ in range(400)})
    assert codec.encode_words(words) == [codec._encode_long(w) for w in words]


def test_bpe_query(spark, sf):
    rows = QUERIES["op7_bpe"](spark, sf).collect()
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        ids, back = expected(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_bpe_odd_documents(spark):
    docs = odd_documents(spark)
    got = Counter((r[0], bytes(r[1]), r[2]) for r in bpe.decode(bpe.encode(docs)).collect())
    want = Counter((r["doc_id"], np.array(expected(r["text"])[0], dtype="<u4").tobytes(), expected(r["text"])[1]) for r in docs.collect())
    assert got == want
    assert bpe.encode(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_everything_once(seed):
    rnd = random.Random(seed)
    count = Counter(rnd.choice([rnd.randint(1, 4096), rnd.randint(1, 300), 4096, 7]) for _ in range(rnd.choice([1, 30, 3000])))
    plan = packing.make_plan(dict(count))
    used = Counter()
    for content, copies in plan:
        assert sum(L * k for L, k in content) <= 4096 and copies > 0
        for L, k in content:
            used[L] += k * copies
    assert used == count
    volume = -(-sum(L * n for L, n in count.items()) // 4096)
    assert volume <= sum(c for _, c in plan) <= sum(c for _, c in packing.best_fit(dict(count), 4096))
    assert packing.make_plan({}) == []


@pytest.mark.parametrize("low, high, pieces", [(1, 4095, 2000), (800, 2500, 6000), (1, 300, 2000)])
def test_the_cover_leaves_best_fit_the_remainder_alone(low, high, pieces):
    rnd = random.Random(3)
    count = dict(Counter(rnd.randint(low, high) for _ in range(pieces)))
    found, left, bound = packing.cover(count, 4096, {L: (L / 4096) ** packing.WEIGHT_POWER for L in count})
    tokens = sum(L * n for L, n in count.items())
    assert sum(L * n for L, n in left.items()) <= tokens / 128
    plan, fitted, least = packing.solve(count, 4096)
    n, plain = sum(c for _, c in plan), sum(c for _, c in packing.best_fit(count, 4096))
    assert max(bound - 1e-6, tokens / 4096) <= least <= n <= 1.005 * plain and fitted <= 0.02 * n + 1


def check_packed(rows, texts):
    """rows: of pack; texts: (doc_id, text) of the input."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    want = Counter()
    for i, t in texts:
        ids = [*expected(t)[0], 1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want[i, k // 4096, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_pack_query(spark, sf):
    rows = QUERIES["op6_pack"](spark, sf).collect()
    n = check_packed(rows, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert n <= 1.02 * -(-sum(r["length"] for r in rows) // 4096) + 1


def test_pack_odd_documents_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_PIECES", 3)
    docs = odd_documents(spark)
    check_packed(packing.pack(docs).collect(), docs.select("doc_id", "text").collect())
    assert packing.pack(docs.limit(0)).count() == 0
