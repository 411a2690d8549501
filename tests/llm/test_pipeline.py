"""Every stage of the pipeline against its brute-force version, on the test table and on awkward rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import awkward, clashing, groups, words
from test_duplicates import by_hand, lines_by_hand
from test_selection import mix_by_hand
from test_tokens import _check_packing

import corpus_pipeline as cp
from opsflow.llm import toxicity
from opsflow.session import job_scope, staged

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash", "mix", "packing"]


def check(spark, docs):
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = docs.collect()
    key = lambda r: str(tuple(r))

    model = toxicity.fit(docs, labels, folds=4, held_out=2)
    docs = staged(cp.STAGES[0][1](spark, docs, SF), "s")
    clean = [r for r, s in zip(before, model.scores([r.text for r in before])) if s < 0.3]
    after = docs.collect()
    assert docs.columns == columns and sorted(after, key=key) == sorted(clean, key=key)

    wanted = Counter(
        (str(r.doc_id), None if r.text is None else own[2]) for r, own in zip(after, lines_by_hand([r.text for r in after], 10)))
    docs = staged(cp.STAGES[1][1](spark, docs, SF), "s")
    after = docs.collect()
    assert docs.columns == columns and Counter((str(r.doc_id), r.text) for r in after) == wanted

    prints = [by_hand(r.text) for r in after]
    nodes = sorted(set(prints))
    near = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4]
    root, first = groups(near, nodes), {}
    for r, p in zip(after, prints):
        first.setdefault(root[p], []).append(r.doc_id)
    wanted = Counter(str(min((i for i in ids if i is not None), default=None)) for ids in first.values())
    docs = staged(cp.STAGES[2][1](spark, docs, SF), "s")
    after = docs.collect()
    assert docs.columns == columns and Counter(str(r.doc_id) for r in after) == wanted

    _, copies = mix_by_hand([(r.doc_id, r.source, len(words(r.text))) for r in after])
    wanted = Counter()
    for r, n in zip(after, copies):
        wanted[(str(r.doc_id), r.text)] += n
    docs = staged(cp.STAGES[3][1](spark, docs, SF), "s")
    after = docs.collect()
    assert docs.columns == columns and Counter((str(r.doc_id), r.text) for r in after) == +wanted

    packed = cp.STAGES[4][1](spark, docs, SF).collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)
    assert Counter(str(r.doc_id) for r in packed if r.start == 0) == Counter(str(r.doc_id) for r in after)
    return packed


def test_stages_on_the_test_table(spark):
    with job_scope(spark):
        check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_stages_on_awkward_rows(spark):
    more = [(500 + i, f"the same line\nown words number {i} of this one", "en", "q", 1) for i in range(12)]
    with job_scope(spark):
        check(spark, staged(clashing(awkward(spark, more)), "awkward"))


@pytest.mark.parametrize("stage", range(5))
def test_empty_tables_stay_empty(spark, stage):
    with job_scope(spark):
        empty = staged(awkward(spark).where("false"), "empty")
        assert cp.STAGES[stage][1](spark, empty, SF).collect() == []


def test_run_is_the_stages_in_order(spark):
    with job_scope(spark):
        rows = cp.run(spark, SF)
        again = cp.run(spark, SF)
        shown = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        assert rows.columns[:5] == shown
        assert sorted(rows.select(shown).collect()) == sorted(again.select(shown).collect())
        used = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
        assert used.where("n <> end or n > 2048").count() == 0
