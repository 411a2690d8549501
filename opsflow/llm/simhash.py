"""SimHash near-duplicates by tiled exact comparison.

A fingerprint bit is set if over half of the text's shingle hashes have it. Equal
fingerprints are merged first, so copies cost nothing. The distinct fingerprints are
compared exactly, tile against tile, with exclusive-or and bit counts; tiles whose bit
counts differ by more than the radius are skipped.

Tiles are filled so that no close pair is missed and few others meet: the 64 bits are cut
into radius + 1 blocks, and two fingerprints within the radius agree on at least one of
them. Each block deals the fingerprints by its low bits, as many as keep a group near one
tile on average; larger groups are cut by bit count and hash (see ``tiles``). With one
group (small tables) this is the plain all-tiles comparison. A tile pair yields a
spanning forest of its links, not the links, so a large group of near copies stays small.

Defined cases: texts without words (null, empty, blanks) have fingerprint zero and are
linked like any others; texts shorter than a shingle are one shingle; repeated rows and
ids fall in one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.components import components
from opsflow.llm.tiles import compare, deal, forest
from opsflow.session import staged

SEED = 42
SHINGLES_AT_ONCE = 1 << 16
CELLS_AT_ONCE = 1 << 20


def fingerprint(text: str | None, words: int) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles."""
    from xxhash import xxh64_digest

    found = (text or "").encode().lower().split()  # on bytes, both only know ASCII
    if not found:
        return 0
    joined = b" ".join(found)
    stops = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    shingles = max(1, len(found) - words + 1)
    starts, stops = starts[:shingles].tolist(), stops[min(words, len(found)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for i in range(0, shingles, SHINGLES_AT_ONCE):
        part = zip(starts[i : i + SHINGLES_AT_ONCE], stops[i : i + SHINGLES_AT_ONCE])
        hashes = np.frombuffer(b"".join([xxh64_digest(joined[a:b], SEED) for a, b in part]), np.uint8)
        counts += np.unpackbits(hashes).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > shingles).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """(id, text_key, fingerprint) of every row; text_key is a hash of the text, the fingerprint a signed long."""
    kind = dict(docs.dtypes)[id_col]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["id", "text_key", "fingerprint"]
            )

    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("body"))
    return narrow.mapInArrow(hashed, f"id {kind}, text_key long, fingerprint long")


def links(distinct: DataFrame, radius: int, tile: int = 2048) -> DataFrame:
    """Links (a, b) that connect all of ``distinct`` (fingerprint) within ``radius`` bits."""
    count = distinct.count()
    low_bits = min(64 // (radius + 1), max(0, (count // tile).bit_length()))
    width = [64 // (radius + 1) + (i < 64 % (radius + 1)) for i in range(radius + 1)]
    blocks = F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fingerprint", sum(width[:i])).bitwiseAND((1 << low_bits) - 1).alias("bucket"))
        for i in range(radius + 1)
    ])
    rows = distinct.select("fingerprint", F.inline(blocks)).withColumn(
        "band", F.floor(F.bit_count("fingerprint") / (radius + 1)).cast("int")
    )
    keys = ["block", "bucket"]
    dealt = deal(rows, keys, "fingerprint", tile, "band").drop("band")

    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        bits, side = np.bitwise_count(values).astype(np.int16), table.column("side").to_numpy()
        same = table.column("tile_a").to_numpy() == table.column("tile_b").to_numpy()
        a, b = [], []
        for start, stop in zip(starts, np.append(starts[1:], len(values))):
            left = right = np.arange(start, stop)
            if not same[start]:
                left, right = left[side[start:stop] == 0], right[side[start:stop] == 1]
            i, j = _close(values, bits, left, right, radius)
            node, root = forest(i - start, j - start, stop - start)
            a.append(values[node + start])
            b.append(values[root + start])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"]
        )

    return compare(dealt, keys, work, "a long, b long")


def _close(values: np.ndarray, bits: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int):
    """Places (i, j) of the close pairs between two tiles, compared in strips of rows sorted by bit count."""
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left, right = left[np.argsort(bits[left], kind="stable")], right[np.argsort(bits[right], kind="stable")]
    strip = max(1, CELLS_AT_ONCE // max(1, len(right)))
    for at in range(0, len(left), strip):
        rows = left[at : at + strip]
        low, high = np.searchsorted(bits[right], [bits[rows[0]] - radius, bits[rows[-1]] + radius + 1])
        if low == high:
            continue
        near = np.bitwise_count(values[rows][:, None] ^ values[right[low:high]][None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = rows[i], right[low:high][j]
        found_i.append(i[i != j])
        found_j.append(j[i != j])
    return np.concatenate(found_i), np.concatenate(found_j)


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4,
            tile: int = 2048) -> DataFrame:
    """One row per document: id, text_key, fingerprint, and ``first``, the (id, text_key) that stands for its class.

    That is the smallest id of the class (null ids last), and of equal ids the smallest text_key.
    """
    marked = staged(fingerprints(docs, id_col, text, words), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    distinct = staged(marked.groupBy("fingerprint").agg(F.min(order).alias("first")), "fingerprints")
    joined = components(links(distinct.select("fingerprint"), radius, tile))
    root = F.coalesce("component", "fingerprint")
    rooted = distinct.join(joined, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", root.alias("root"), "first")
    rooted = staged(rooted, "fingerprints")
    firsts = staged(rooted.groupBy("root").agg(F.min("first").alias("first")), "fingerprints")
    placed = staged(rooted.drop("first").join(firsts, "root").select("fingerprint", "first"), "fingerprints")
    return marked.join(placed, "fingerprint").select("id", "text_key", "fingerprint", "first")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` that stand for their classes: one row each, with its own columns."""
    kept = staged(classes(docs, id_col, text, words, radius).select("first.id", "first.text_key").distinct(), "kept")
    kept = kept.select(F.col("id").alias("kept_id"), F.col("text_key").alias("kept_key")).select(F.struct("*").alias("kept"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("row_id"), F.xxhash64(text).alias("row_key"),
    )
    match = F.col("row_id").eqNullSafe(F.col("kept.kept_id")) & (F.col("row_key") == F.col("kept.kept_key"))
    return packed.join(kept, match, "left_semi").dropDuplicates(["row_id", "row_key"]).select("row.*")
