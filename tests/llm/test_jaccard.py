import random
import re

import numpy as np
import pytest

from quarry.llm import jaccard
from quarry.llm.common import connected_components
from quarry.llm.queries import QUERIES
from tests.llm.helpers import groups, odd_documents


def sets_of(texts, k):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
        out.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(rows, k, percent):
    sets = sets_of([t for _, t in rows], k)
    holders = {}
    for a, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(a)
    links = {(b, a) for m in holders.values() for a in m for b in m if b < a and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    of = groups(len(rows), links)
    low = {}
    for (i, _), g in zip(rows, of):
        low[g] = min(i, low.get(g, i))
    return sorted((i, len(s), low[g] if s else i) for (i, _), s, g in zip(rows, sets, of))


@pytest.mark.parametrize("seed, k, percent", [(0, 4, 85), (1, 5, 80), (2, 2, 50)])
def test_components_equal_brute_force(spark, seed, k, percent):
    rnd = random.Random(seed)
    words = [f"W{i}" for i in range(300)]
    family = [[rnd.choice(words) for _ in range(rnd.randint(30, 120))] for _ in range(6)]
    rows = []
    for _ in range(400):
        w = [rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 3, 5, 20, 60, 100]))]
        if rnd.random() < 0.6:
            w = list(rnd.choice(family))
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((rnd.randint(0, 10**6), None if rnd.random() < 0.02 else rnd.choice([" ", "\n", "  "]).join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, jaccard.components(docs, k, percent).collect())) == brute(rows, k, percent)


def test_prefix_lengths_keep_every_pair():
    """Sets at the threshold share min(l, l') prefix tokens, whatever each l."""
    rnd = random.Random(5)
    for _ in range(300):
        n = rnd.randint(2, 40)
        a = rnd.sample(range(200), n)
        b = a[:rnd.randint(1, n)] + rnd.sample(range(200, 400), rnd.randint(0, 5))
        if 100 * len(set(a) & set(b)) < 80 * len(set(a) | set(b)):
            continue
        order = rnd.sample(range(400), 400)
        def prefix(s):
            required = (80 * len(s) + 99) // 100
            l = rnd.randint(1, min(jaccard.MAX_MATCH, required))
            return set(sorted(s, key=order.__getitem__)[:len(s) - required + l]), l
        (p, l), (q, m) = prefix(a), prefix(b)
        assert len(p & q) >= min(l, m)


def test_common_tokens_ask_for_more_matches():
    assert jaccard.choose_match(np.ones(30), 100, 80) == 1
    assert jaccard.choose_match(np.array([1.0] * 15 + [5000.0] * 15), 100, 80) > 1


def test_long_and_blank_texts():
    long = b"a B " * 700_000 + b"x"
    assert len(jaccard.shingle_sets([long], 4)[0]) == len(jaccard.shingle_sets([b"a b a b a b x"], 4)[0])
    assert [len(s) for s in jaccard.shingle_sets([b"", b" \n", b"a", b"a b c d"], 4)] == [0, 0, 1, 1]


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = sorted(((r[0], r[1], r[2]) for r in jaccard.components(docs, 4, 85).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (None, 2, 1), (5, 2, 5), (6, 1, 6), (7, 1, 7)], key=str)
    assert jaccard.components(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op4_jaccard"](spark, sf).collect())) == brute(rows, 4, 85)


def test_connected_components(spark):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    links = chain + [(rnd.randint(100, 300), rnd.randint(100, 300)) for _ in range(120)] + [(500, 500), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    real = [(a, b) for a, b in links if a is not None and a != b]
    of = groups(301, real)
    assert got == {x: of[x] for pair in real for x in pair}


@pytest.mark.parametrize("texts, tokens", [(1024, 1 << 19), (40, 1 << 19), (1024, 2000)])
def test_family_whose_texts_share_most_shingles(spark, monkeypatch, texts, tokens):
    """Most pairs stay below the threshold; those that reach it are found, and nothing is listed pair by pair."""
    monkeypatch.setattr(jaccard, "FAMILY_TEXTS", texts)
    monkeypatch.setattr(jaccard, "FAMILY_TOKENS", tokens)
    rnd = random.Random(texts + tokens)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(320):
        w = list(base)
        for at in rnd.sample(range(150), rnd.choice([2, 3, 3, 4, 4, 5])):
            w[at] = rnd.choice([f"x{rnd.randrange(4)}", f"y{i}"])
        rows.append((i, " ".join(w)))
    sets = sets_of([x for _, x in rows], 4)
    of = groups(320, [(a, b) for b in range(320) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    want = [(i, len(sets[i]), of[i]) for i in range(320)]
    assert len(set(of)) > 20  # far from one component
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.components(docs, 4, 85).collect())) == want


def test_overlaps_count_shared_tokens():
    rng = np.random.default_rng(1)
    left, right = ([np.unique(rng.integers(0, 60, size=rng.integers(0, 40))).astype(np.uint64) for _ in range(n)] for n in (30, 17))
    assert (jaccard.overlaps(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()
