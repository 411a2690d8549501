"""Quality by histogram gradient-boosted trees over document statistics.

Each text is reduced to a row of statistics (shares of kinds of characters, lengths of
words and lines, repetition). Boosted trees of fixed depth are fitted to binned statistics
of at most ``sample_rows`` labelled texts (a documented bound). The trees are complete and
stored in flat arrays, so scoring walks all rows of a batch down all trees with a few
numpy gathers per level.

Defined cases: a null or empty text has statistics zero throughout and is scored like any
other; a long text is read whole; with no labelled row, or one label only, there are no
splits and scores are the (smoothed) share of label 1; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.sample import labelled_sample

_SIGNS = "!#$%&*|@/<>{}=+~^_"
# Kinds of bytes; bytes of 128 and above belong to letters outside ASCII.
_KINDS = np.array([
    [chr(b).isdigit() and b < 128 for b in range(256)],
    [65 <= b <= 90 for b in range(256)],
    [97 <= b <= 122 for b in range(256)],
    [b >= 128 for b in range(256)],
    [chr(b) in ".,;:?'\"()-" and b < 128 for b in range(256)],
    *[[chr(b) == s for b in range(256)] for s in _SIGNS],
    [chr(b) in " \t" for b in range(256)],
    [b == 10 for b in range(256)],
], float)
STATISTICS = len(_KINDS) + 12


def statistics(text: str | None) -> np.ndarray:
    """The text's row of statistics."""
    out = np.zeros(STATISTICS)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = len(_KINDS)
    out[:kinds] = _KINDS @ np.bincount(raw, minlength=256) / len(raw)
    words, lines = text.split(), text.split("\n")
    if not words:
        return out
    counts = Counter(words)
    line_counts = Counter(lines)
    ends = sum(line.rstrip().endswith((".", "!", "?")) for line in lines)
    out[kinds:] = [
        np.log1p(len(words)), len(raw) / len(words), len(counts) / len(words), max(counts.values()) / len(words),
        sum(map(eq, words, words[1:])) / len(words), len(words) / len(lines), ends / len(lines),
        len(line_counts) / len(lines), max(line_counts.values()) / len(lines),
        sum(1 for w in counts if w.isupper() and len(w) > 1) / len(counts), sum(1 for w in counts if w.isalpha()) / len(counts),
        sum(1 for w in counts if w[-1] in _SIGNS) / len(counts),
    ]
    return out


@dataclass
class Forest:
    """Tree t, node i: split on ``feature[t, i]`` above ``cut[t, i]``; leaves left to right in ``leaf[t]``."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        depth = (self.feature.shape[1] + 1).bit_length() - 1
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def boost(rows: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
          ridge: float = 1.0, least: int = 10) -> Forest:
    """Fits by gradient and curvature histograms, level by level."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start, nodes = float(np.log(share / (1 - share))), 2**depth - 1
    if not 0 < y.sum() < len(y):
        trees = 0
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(rows) else np.zeros(0)
             for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], 1)
    forest = Forest(start, np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, nodes + 1)))
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            best = np.full(width, 1e-6)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                slot = (node - first) * bins + binned[:, f]
                g, h, n = (np.bincount(slot, w, width * bins).reshape(width, bins).cumsum(1)
                           for w in (slope, curve, np.ones(len(y))))
                gl, hl, nl = g[:, : len(edge)], h[:, : len(edge)], n[:, : len(edge)]
                gr, hr, nr = g[:, -1:] - gl, h[:, -1:] - hl, n[:, -1:] - nl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                gain[(nl < least) | (nr < least)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                forest.feature[t, first + better], forest.cut[t, first + better] = f, edge[at[better]]
            node = 2 * node + 1 + (rows[np.arange(len(y)), forest.feature[t, node]] > forest.cut[t, node])
        leaf = node - nodes
        g, h = (np.bincount(leaf, w, nodes + 1) for w in (slope, curve))
        forest.leaf[t] = -rate * g / (h + ridge)
        total += forest.leaf[t][leaf]
    return forest


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, sample_rows: int = 20_000, label: str = "quality",
        id_col: str = "doc_id", text: str = "text") -> Forest:
    """Learns from labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, folds, held_out, sample_rows, id_col, text)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], ["row", "label"])

    got = sample.select("body", "label").mapInArrow(reduced, "row binary, label int").collect()
    got.sort(key=lambda r: (bytes(r.row), r.label))  # sums, and so trees, do not depend on the order of tasks
    rows = np.frombuffer(b"".join(bytes(r.row) for r in got)).reshape(-1, STATISTICS)
    return boost(rows, np.array([r.label for r in got], float))


def score(text: Column, forest: Forest) -> Column:
    """The score of a text column: 0 to 1, higher for likelier good."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        rows = np.stack([statistics(t) for t in texts.tolist()]) if len(texts) else np.zeros((0, STATISTICS))
        return pd.Series(forest.scores(rows))

    return scored(text)
