"""Plain versions and small tables for the tests of this folder."""

import os
import re
from collections import Counter, defaultdict

import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

#: Nulls, empty and blank texts, ties, repeated rows, one long text, extra columns with clashing names.
LONG = " ".join(f"word{k % 977} the" for k in range(40_000))
ODD_ROWS = [(1, "The same five words here again", "x", 1.0), (2, "The same five words here again", "y", 2.0),
            (2, "The same five words here again", "y", 2.0), (3, None, None, None), (4, "", "z", 0.0), (5, " \t\n", "z", 0.0),
            (6, "one two", "z", 0.0), (7, "ONE\ttwo", "z", 0.0), (None, "no id at all but five words", "z", 0.0),
            (8, LONG, "z", 0.0), (9, "a b c d e f g h ünï çødé 中文", "z", 0.0)]
ODD_SCHEMA = "doc_id long, text string, sid string, score double"


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", text)


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def plain_components(rows):
    """``{id: (set size, smallest linked id)}`` of ``(id, text)`` rows with different ids, over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for x in s for j in having[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
