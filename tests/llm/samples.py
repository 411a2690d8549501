"""Small tables with every awkward case."""

from __future__ import annotations

import re

LONG = " ".join(f"word{i % 977}" for i in range(120_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHES = "lines string, mix int, copies int, row string, kept int, id string, body string, size int, rank int, score string, ids int, length int"


def awkward(spark, more=()):
    """Nulls in every column, empty, blank and very long texts, ties, and repeated rows."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
        (2, None, None, None, None),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n\x0b ", "en", "b", 5),
        (None, "one line\nANOTHER line \nlast", "de", None, 28),
        (None, None, None, None, None),
        (5, LONG, "en", "a", len(LONG)),
        (6, "naïve café İstanbul 日本 😀  x", "fr", "c", 27),
        (6, "another text under the same id", "fr", "c", 30),
        *more,
    ]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """``df`` with extra columns under names that the operators use inside."""
    from pyspark.sql import functions as F

    extra = dict(f.strip().split(" ") for f in CLASHES.split(","))
    return df.withColumns({name: F.lit(7).cast(kind) for name, kind in extra.items()})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def groups(pairs, nodes):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
