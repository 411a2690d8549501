"""The registered queries: each applies one operator to its whole table and derives the compared columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm import (
    html_text, katz, line_dedup, mixing, negatives, packing, quality, simhash, token_files, topk, toxicity, vectors, whitening,
)
from opsflow.llm.base import crc_of_id, table, word_count
from opsflow.session import staged, work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_html_text(spark, sf_dir):
    """Visible text of every page."""
    return table(spark, sf_dir, "pages").select("page_id", "url", html_text.extract(F.col("html")).alias("text"))


@query
def op2_toxicity(spark, sf_dir):
    """Toxicity of every text, learned from labelled rows outside the fold crc32(doc_id) mod 4 = 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return _scored(docs, toxicity.score(F.col("text"), model), crc_of_id(F.col("doc_id")) % 4 == 2)


def _scored(docs, score, held_out):
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op3_embedding_dedup(spark, sf_dir):
    """Vectors linked at cosine 0.95 and above."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), threshold=0.95)


@query
def op4_simhash(spark, sf_dir):
    """Classes of documents whose 4-word fingerprints are linked at 4 differing bits or fewer."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.classes(docs, words=4, radius=4)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; the machine's own copy, never one of the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_token_files(spark, sf_dir):
    """Documents written as grammar-compressed id files in id order, and read back."""
    path = work_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_documents(docs, path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    back = token_files.read_documents(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_line_dedup(spark, sf_dir):
    """Lines found in at least 10 documents go from every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.kept").cast("binary"), 256).alias("kept_sha256")
    )


@query
def op7_source_mix(spark, sf_dir):
    """Words taken from each document by the mix with weights 1, 2, 3 and at most three copies."""
    docs = table(spark, sf_dir, "documents")
    sized = staged(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.rank(F.col("doc_id")).alias("rank")),
        "mix-sizes",
    )
    plan = mixing.thresholds(sized, weights=(1, 2, 3), max_copies=3)
    mixed = mixing.with_copies(sized, plan, "source", F.col("rank"))
    return mixed.select(
        "doc_id", "size", "mix.source_size", "mix.target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query
def op8_quality(spark, sf_dir):
    """Quality of every text, learned from labelled rows outside the fold crc32(doc_id) mod 5 = 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return _scored(docs, quality.score(F.col("text"), forest), crc_of_id(F.col("doc_id")) % 5 == 0)


@query
def op9_exact_topk(spark, sf_dir):
    """The 5 best rows by integer inner product for every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding"), 256).alias("vector"))
    return topk.search(rows, F.col("vec_id") % 50 == 0, k=5)


@query
def op10_packing(spark, sf_dir):
    """Documents as pieces of sequences of 2048 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048, end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op11_lm_scoring(spark, sf_dir):
    """Katz scores of every text, by a bigram model of the documents outside the fold crc32(doc_id) mod 10 = 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.fit_and_score(docs, crc_of_id(F.col("doc_id")) % 10 == 0, order=2)


@query
def op12_embedding_whitening(spark, sf_dir):
    """Every vector along the 16 leading eigenvectors of the covariance of floor(64 * x) + 1000000, over its deviations."""
    scaled = F.transform(topk.quantised(F.col("embedding"), 64), lambda x: x + 1_000_000)
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", scaled.alias("vector")), components=16)


@query
def op13_hard_negatives(spark, sf_dir):
    """For every vector whose id is divisible by 50, and each of its 5 positives, the 3 best rows of other labels in the window."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), topk.quantised(F.col("embedding"), 256).alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)
