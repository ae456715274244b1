"""Operator 11 against brute force over all pairs of words, on small blocks and odd inputs."""

import re
import zlib
from collections import Counter

import pytest

from quarry.llm import spelling
from quarry.llm.queries import QUERIES
from tests.llm.helpers import odd_documents

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs, every=97):
    n, low = Counter(), {i: i + 32 for i in range(65, 91)}
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 3}


def brute(n):
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def rows(df):
    return {tuple(r) for r in df.select(*COLUMNS).collect()}


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op11_spelling"](spark, sf)
    assert got.columns == COLUMNS
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert rows(got) == brute(brute_words(docs))


def test_large_groups_and_chains(spark, monkeypatch):
    """Tiles of blocks, chains of forms, ties of n, long and non-Latin words."""
    monkeypatch.setattr(spelling, "BLOCK", 7)
    monkeypatch.setattr(spelling, "BUCKET", 300)
    n = {f"shared{a}{b}": 3 + ord(a) * ord(b) % 40 for a in "abcdefghijkl" for b in "abcdefghijklm"}
    n |= {"chain" + "x" * k: 3 * 2 ** k for k in range(12)}
    n |= {"aaaaa": 5, "aaaaaa": 10, "aaaaaaa": 20, "tiexa": 9, "tiexb": 9, "tiexc": 4, "日本語日本": 8, "日本語日": 3, "z" * 3000: 3, "z" * 3001: 9}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), 2)
    assert rows(got) == brute(n)
    roots = {r.word: r.root for r in got.collect()}
    assert roots["chain"] == "chain" + "x" * 11 and roots["tiexc"] == "tiexa"


def test_words(spark):
    docs = [(1, "HELLO Hello hello ÀÉÎÕÜ àéîõü " * 3), (2, "four 4five×six× ab" * 4), (None, "nulls NULLS nulls"), (3, None), (4, "")]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], "doc_id long, text string, word string, n int")
    for every in (97, 1, 3):
        assert {tuple(r) for r in spelling.words(df, garble_every=every).collect()} == set(brute_words(docs, every).items())


def test_odd_documents(spark):
    df = odd_documents(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert rows(spelling.variants(spelling.words(df, garble_every=97))) == brute(brute_words(docs))
    assert rows(spelling.variants(spelling.words(df.limit(0)))) == set()
    with pytest.raises(ValueError):
        spelling.variants(spelling.words(df), factor=1)
