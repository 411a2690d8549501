"""The language model against a version in plain dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsflow.llm import katz
from opsflow.llm.base import crc_of_id

SF = "/root/testdata/sf0.001"


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


class Plain:
    """Katz backoff with Good-Turing discounts, one token at a time."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        self.after = defaultdict(set)
        for text in texts:
            words = [b"\n"] * (order - 1) + tokens_of(text)
            for i in range(order - 1, len(words)):
                for n in range(1, order + 1):
                    gram = tuple(words[i - n + 1 : i + 1])
                    self.counts[n][gram] += 1
                    self.after[gram[:-1]].add(gram[-1])
        self.total = sum(self.counts[1].values())
        self.starts = self.counts[1][(b"",)]
        self.weigh = [None, *(self.discount(Counter(c.values())) for c in self.counts[1:])]
        self.unknown = 1 - sum(self.weigh[1](c) for c in self.counts[1].values()) / self.total if self.total else 1.0
        self.weights = {}

    @staticmethod
    def discount(of):
        known = [r for r in range(1, 7) if of[r]]
        slope = float(np.polyfit([math.log(r) for r in known], [math.log(of[r]) for r in known], 1)[0]) if len(known) > 1 else -2.0
        slope = slope if slope < -1 else -2.0

        def weigh(r):
            turing = (r + 1) * of[r + 1] / of[r] if r <= 5 and of[r] else 0
            return turing if 0 < turing < r else r * (1 + 1 / r) ** (slope + 1)

        return weigh

    def count_of(self, history):
        return self.starts if set(history) == {b"\n"} else self.counts[len(history)][history]

    def chance(self, history, word):
        if not history:
            count = self.counts[1][(word,)]
            return self.weigh[1](count) / self.total if count else self.unknown
        whole = self.count_of(history)
        count = self.counts[len(history) + 1][(*history, word)]
        if count:
            return self.weigh[len(history) + 1](count) / whole
        return (self.backoff(history) if whole else 1.0) * self.chance(history[1:], word)

    def backoff(self, history):
        if history not in self.weights:
            seen = self.after[history]
            taken = sum(self.chance(history, w) for w in seen)
            self.weights[history] = (1 - taken) / (1 - sum(self.chance(history[1:], w) for w in seen))
        return self.weights[history]

    def score(self, text):
        words = [b"\n"] * (self.order - 1) + tokens_of(text)
        return sum(math.log10(self.chance(tuple(words[i - self.order + 1 : i]), words[i])) for i in range(self.order - 1, len(words)))

    def base(self, text):
        words, spread = tokens_of(text), self.total + 0.1 * (len(self.counts[1]) + 1)
        return sum(math.log10((self.counts[1][(w,)] + 0.1) / spread) for w in words)


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def compare(docs, order, **options):
    got = katz.fit_and_score(docs, crc_of_id(F.col("doc_id")) % 10 == 0, order=order, **options).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    plain = Plain([t for i, t in rows if not held(i)], order)
    wanted = sorted(((i, held(i), len(tokens_of(t)), sum(plain.counts[1][(w,)] > 0 for w in tokens_of(t)), plain.total,
                      round(plain.base(t), 6), round(plain.score(t), 6)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got),
                  key=repr) == wanted
    return got, plain


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_plain_model(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got, _ = compare(docs, order)
    tested = [r for r in got if r.held_out]
    if order > 1:
        assert sum(r.score for r in tested) > sum(r.base_score for r in tested)


def test_small_shards_and_parts(spark, monkeypatch):
    """Many shards and parts, and no hot histories, give the same scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    path = str(docs.sparkSession.conf.get("spark.checkpoint.dir")) + "/katz-docs"
    docs.repartition(3).write.mode("overwrite").parquet(path)
    monkeypatch.setattr(katz, "PART_BYTES", 1 << 13)
    monkeypatch.setattr(katz, "HOT", 1)
    compare(spark.read.parquet(path), 2)
    compare(spark.read.parquet(path), 3)


CASES = [
    (None, "the cat the cat"), (1, None), (1, ""), (2, " \t\n"), (3, "The\x0bCAT sat"), (3, "The\x0bCAT sat"), (5, "É é  x   y"),
    (7, "the " * 3000 + "end"), (11, "zebra unseen"), (12, "the cat sat"), (24, "the the the dog"), (37, "nothing here is known"),
]


@pytest.mark.parametrize("order", [2, 3])
def test_odd_rows(spark, order):
    docs = spark.createDataFrame(CASES, "doc_id int, text string").withColumn("score", F.lit("x")).withColumn("shard", F.lit(None))
    got, _ = compare(docs, order)
    assert {r.held_out for r in got} == {False, True}


def test_empty_table_and_no_training_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert katz.fit_and_score(none, F.lit(False)).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.fit_and_score(docs, F.lit(True)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


def test_stored_model_is_normalised(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    path = str(tmp_path / "model")
    katz.fit_and_score(docs, crc_of_id(F.col("doc_id")) % 10 == 0, order=2, path=path).collect()
    plain = Plain([r.text for r in docs.collect() if not held(r.doc_id)], 2)
    table = {(r.n, r.key): r for r in katz.read_model(spark, path).collect()}
    assert {(n, katz.key_of([w.decode() for w in g])): c for n in (1, 2) for g, c in plain.counts[n].items()} == {
        k: r["count"] for k, r in table.items() if r["count"] is not None}
    words = [g[0] for g in plain.counts[1]]
    for history in [*words[:40], b"\n"]:
        weight = table[1, katz.key_of([history.decode()])].backoff if history else None
        if weight is not None:
            assert weight == pytest.approx(plain.backoff((history,)), rel=1e-9)
            assert sum(plain.chance((history,), w) for w in words) + weight * plain.unknown == pytest.approx(1, abs=1e-9)


def test_a_changed_table_is_noticed(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), (F.rand() * 1e9).cast("long").cast("string")).alias("text"))
    noisy = F.udf(lambda i: f"word{np.random.default_rng().integers(1 << 40)}").asNondeterministic()
    with pytest.raises(Exception, match="not the same"):
        katz.fit_and_score(docs.withColumn("text", noisy("doc_id")), F.lit(False)).collect()


def test_discounts_lie_between_zero_and_the_count():
    for of in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 9, 9, 9, 9], [100, 40, 20, 10, 6, 4], [3, 3, 3, 3, 3, 3]):
        counts = np.array([1, 2, 3, 4, 5, 6, 100, 10**12])
        weighed = katz.Discount.of(np.array(of, float))(counts)
        assert (weighed > 0).all() and (weighed < counts).all()
