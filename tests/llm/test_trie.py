"""Operator 13 against a dictionary of all prefixes, with small bands, shards and queues."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from quarry.llm import trie
from quarry.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
            conv[c].append(((t is not None, t or 0), r.encode(), digest, x))
    for c in conv:
        conv[c].sort(key=lambda v: v[:3])
    whole = {}
    for c in conv:
        h, s = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple((v[1], v[3]) for v in conv.get(s, [])[:h] + conv[c][h:])
    members, children, total = defaultdict(list), defaultdict(list), {}
    for c, q in whole.items():
        for d in range(len(q) + 1):
            members[q[:d]].append(c)
    for q in members:
        if q:
            children[q[:-1]].append(q)
    for q in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0d]+", q[-1][1])) if q else 0
        total[q] = (sum(total[k][0] for k in children[q]) or 1, (len(members[q]) - 1) * words + sum(total[k][1] for k in children[q]))
    ends = {q: ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(q)) for q, m in members.items()}
    return sorted((min(m), len(q), min(members[q[:-1]]) if q else -1, len(m), len(children[q]), *total[q], hashlib.sha256(ends[q].encode()).hexdigest()) for q, m in members.items())


def rows(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.select(*COLUMNS).collect())


def test_query(spark, sf):
    got = QUERIES["op13_trie"](spark, sf)
    assert got.columns == COLUMNS and dict(got.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in COLUMNS}
    assert rows(got) == brute([(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()])


def conversations():
    rnd = random.Random(5)
    out = [(c, rnd.choice([None, t, t, t]), rnd.choice(["user", "bot", None]), rnd.choice([None, "", "a b", "c d \t e"]))
           for c in [*range(-25, 60), None] for t in range(rnd.choice([1, 2, 3, 8]))]
    out += [(7, t, "u", "x y") for t in range(90)] + [(27, t, "u", "x y") for t in range(80)]  # long ones that share their beginning
    out += [(8, 5, "u", "x y")] * 60  # repeated rows
    return out + [(100, 0, "u", "only")]  # without a conversation to borrow from


@pytest.mark.parametrize("band,heavy", [(trie.BAND, trie.HEAVY), (3, 10)])
def test_bands_and_heavy_nodes(spark, monkeypatch, band, heavy):
    monkeypatch.setattr(trie, "SHARD_ROWS", 150)
    data = conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in data], SCHEMA + ", depth int, c string").repartition(5)
    assert rows(trie.trie(*trie.rebuilt(df), band=band, heavy_from=heavy)) == brute(data)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.trie(*trie.rebuilt(empty)).collect() == []
    assert trie.trie(*trie.rebuilt(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA))).collect() == []
    data = [(c, None, None, None) for c in (1, 2, 3, 20)]
    assert rows(trie.trie(*trie.rebuilt(spark.createDataFrame(data, SCHEMA)))) == brute(data)


def test_spilling_queue():
    rnd = random.Random(1)
    queue, want = trie.SpillingQueue(held=50), defaultdict(list)
    queue.RUNS = 4
    for level in range(30, 0, -1):
        for _ in range(rnd.randint(0, 200)):
            item = (-rnd.randint(0, level - 1), rnd.randint(0, 9), 0, rnd.random())
            queue.push(item)
            want[item[:3]].append(item[3])
        for k in range(10):
            key = (-(level - 1), k, 0)
            assert sorted(x[3] for x in queue.take(key)) == sorted(want.pop(key, []))
    assert not len(queue) and not want
