"""Toxicity by a counterfactually regularised linear classifier.

A logistic regression over the words a text holds. For every labelled sentence that
mentions an identity term, the term is swapped for another of its group and for a neutral
noun, and the loss adds ``balance`` times the squared change of the score. So a group name
cannot carry the score, however often it stands beside abuse, and a neutral mention stays
clean, while the words that do the abusing keep their weight.

The words that count are found by Spark: document counts by label over the sample, ranked
by chi-square. At most ``sample_rows`` labelled texts are used for the fit (a documented
bound); each is reduced to the places of its known words before it reaches the driver.

Defined cases: a null or empty text has no words and gets the score of the intercept; a
long text is scored whole; with no labelled row, or only one label, the fit has no words
and scores are the (smoothed) share of label 1; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.sample import labelled_sample
from opsflow.session import staged

# Identity terms by language and group, after the noun that stands for any of them there.
IDENTITY = {
    "people": [
        ["women", "men", "girls", "boys", "woman", "man", "female", "male", "transgender", "nonbinary"],
        ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "muslims", "christians", "jews"],
        ["black", "white", "asian", "latino", "african", "european", "arab", "indigenous"],
        ["gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"],
        ["immigrants", "refugees", "foreigners", "migrants", "natives"],
        ["disabled", "blind", "deaf", "elderly", "young", "old"],
    ],
    "menschen": [
        ["frauen", "männer", "mädchen", "jungen"],
        ["muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"],
        ["schwarze", "weiße", "asiaten", "araber"],
        ["schwule", "lesben", "homosexuelle", "heterosexuelle"],
        ["einwanderer", "flüchtlinge", "ausländer", "migranten"],
    ],
    "gens": [
        ["femmes", "hommes", "filles", "garçons"],
        ["musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"],
        ["noirs", "blancs", "asiatiques", "arabes"],
        ["lesbiennes", "homosexuels", "hétérosexuels"],
        ["immigrés", "réfugiés", "étrangers"],
    ],
    "personas": [
        ["mujeres", "hombres", "niñas", "niños"],
        ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"],
        ["negros", "blancos", "asiáticos", "árabes"],
        ["lesbianas", "homosexuales", "heterosexuales"],
        ["inmigrantes", "refugiados", "extranjeros"],
    ],
}
GROUP = {term: group for groups in IDENTITY.values() for group in groups for term in group}
NEUTRAL = {term: noun for noun, groups in IDENTITY.items() for group in groups for term in group}
NOUNS = [*IDENTITY]

WORDS = re.compile(r"[^\W\d_]+")
SENTENCE_ENDS = re.compile(r"[.!?\n]+")


@dataclass
class Model:
    words: dict[str, int]
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        known, weights = self.words.keys(), dict(zip(self.words, self.weights.tolist()))
        for i, text in enumerate(texts):
            out[i] = self.intercept + sum(sorted(weights[w] for w in words_of(text) & known))
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall((text or "").lower()))


def swapped(sentence: set[str]) -> list[set[str]]:
    """The sentence's words with every identity term swapped for its successor in the group, and for the neutral noun."""
    terms = sentence & GROUP.keys()
    if not terms:
        return []
    rest = sentence - terms
    return [rest | {GROUP[t][(GROUP[t].index(t) + 1) % len(GROUP[t])] for t in terms}, rest | {NEUTRAL[t] for t in terms}]


def vocabulary(sample: DataFrame, size: int, min_signal: float) -> list[str]:
    """The ``size`` words that tell the labels apart best, identity terms included.

    They are ranked by chi-square, with one document taken off the difference so that rare
    words do not pass by chance, and must reach ``min_signal``.
    """
    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("pos")).first()
    if not 0 < total.pos < total.n:
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("body"), F.lit(r"([\p{L}]+)"), F.lit(1)))
    counts = sample.select("label", F.explode(words).alias("word")).groupBy("word").agg(
        F.count("*").cast("double").alias("df"), F.sum("label").cast("double").alias("pos"))
    n, pos = float(total.n), float(total.pos)
    expected = F.col("df") * (pos / n)
    spread = expected * (1 - pos / n) * (n - F.col("df") + 1) / n + 1e-9
    signal = F.pow(F.greatest(F.abs(F.col("pos") - expected) - 1, F.lit(0.0)), 2) / spread
    ranked = counts.withColumn("signal", signal).where(
        (F.col("signal") >= min_signal) & ~F.col("word").isin(*GROUP, *NOUNS)).orderBy(F.desc("signal"), "word")
    return [r.word for r in ranked.select("word").limit(size).collect()] + [*GROUP, *NOUNS]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample_rows: int = 20_000, words: int = 1024,
        min_signal: float = 16.0, balance: float = 5.0, ridge: float = 2e-4, label: str = "toxic",
        id_col: str = "doc_id", text: str = "text") -> Model:
    """Learns from labelled rows outside the held-out fold."""
    return fit_sample(labelled_sample(docs, labels, label, folds, held_out, sample_rows, id_col, text), words, min_signal, balance, ridge)


def fit_sample(sample: DataFrame, words: int = 1024, min_signal: float = 16.0, balance: float = 5.0, ridge: float = 2e-4) -> Model:
    """Learns from (body, label)."""
    index = {w: i for i, w in enumerate(vocabulary(sample, words, min_signal))}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found: set[str]) -> bytes:
            return np.array(sorted(index[w] for w in found & index.keys()), "<u2").tobytes()

        for batch in batches:
            rows, swaps = [], []
            for body in batch.column(0).to_pylist():
                rows.append(packed(words_of(body)))
                mine = []
                if words_of(body) & GROUP.keys():
                    for sentence in SENTENCE_ENDS.split(body):
                        told = words_of(sentence)
                        mine += [x for other in swapped(told) for x in (packed(told), packed(other))]
                swaps.append(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(swaps, pa.list_(pa.binary())), batch.column(1)], ["known", "swaps", "label"])

    coded = staged(sample.select("body", "label").mapInArrow(places, "known binary, swaps array<binary>, label int"), "toxic-sample")
    # Equal rows are merged, with their number, before they leave Spark.
    texts = coded.groupBy("known", "label").agg(F.count("*").alias("n")).orderBy("known", "label").collect()
    pairs = coded.select(F.posexplode("swaps").alias("at", "told"), F.col("swaps")).where("at % 2 = 0").select(
        "told", F.element_at("swaps", F.col("at") + 2).alias("other")
    ).where("told <> other").groupBy("told", "other").agg(F.count("*").alias("n")).orderBy("told", "other").collect()
    return _fitted(index, texts, pairs, balance, ridge)


def _rows(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = [np.frombuffer(c, "<u2") for c in codes]
    return np.repeat(np.arange(len(found)), [len(f) for f in found]), np.concatenate([*found, np.zeros(0, "<u2")]).astype(np.int64)


def _fitted(index: dict[str, int], texts: list, pairs: list, balance: float, ridge: float) -> Model:
    """Full-batch Adam on the weighted loss; fixed steps, so reruns agree."""
    size = len(index)
    y, n = np.array([t.label for t in texts], float), np.array([t.n for t in texts], float)
    share = ((y * n).sum() + 0.5) / (n.sum() + 1)
    bias = float(np.log(share / (1 - share)))
    weights = np.zeros(size)
    if not size:
        return Model(index, weights, bias)
    row, col = _rows([bytes(t.known) for t in texts])
    m = np.array([p.n for p in pairs], float)
    told, told_col = _rows([bytes(p.told) for p in pairs])
    other, other_col = _rows([bytes(p.other) for p in pairs])
    moments = np.zeros((2, size + 1))
    for step in range(1, 401):
        score = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[col], len(y)) + bias, -40, 40)))
        error = (score - y) * n / n.sum()
        slope = np.append(np.bincount(col, error[row], size) + 2 * ridge * weights, error.sum())
        if len(m):
            change = np.bincount(told, weights[told_col], len(m)) - np.bincount(other, weights[other_col], len(m))
            pull = 2 * balance * change * m / m.sum()
            slope[:size] += np.bincount(told_col, pull[told], size) - np.bincount(other_col, pull[other], size)
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = 0.1 * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        weights -= move[:size]
        bias -= float(move[size])
    return Model(index, weights, bias)


def score(text: Column, model: Model) -> Column:
    """The score of a text column: 0 to 1, higher for likelier toxic."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return scored(text)
