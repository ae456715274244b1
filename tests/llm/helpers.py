"""Small inputs and brute-force forms shared by the tests."""

import random

WORDS = ["alpha", "béta", "gam", "delta", "ep", "zeta", "ëta", "theta", "日本", "x"]


def text(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def groups(n, links):
    """The smallest member of each of range(n)'s components."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and
    columns that clash with results."""
    rows = [(1, "a b c d e", "en", 1.0), (1, "a b c d e", "en", 1.0), (2, None, None, None), (3, "", "", 0.0), (4, " \n\t ", "en", 2.0),
            (None, "a b c d e", None, None), (5, "long word " * 60_000, "en", 3.0), (6, "z" * 70_000, "en", 4.0), (7, "<|endoftext|> İ ǅ", "tr", 5.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, score double")
