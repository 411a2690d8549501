"""Packing of documents into sequences by first-fit decreasing in randomised groups.

Documents are encoded, closed with an end id and cut into pieces of at most ``capacity``
ids. The pieces are dealt at random (with a seed) to groups of about ``group_bytes`` of
text and end ids; inside a group the pieces go, longest first, into the first sequence with room,
which a tournament tree over the sequences' free room finds in logarithmic time. The
number of groups grows with the corpus, so no task's work does.

Defined cases: a null or empty text is the end id alone; repeated rows and ids are
packed as often as they occur, each row as a document; an empty table gives no pieces;
of extra columns only those named in ``keep`` come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.tokens import encoder

BYTES_AT_ONCE = 8 << 20


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items of equal length keep their order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int((lengths == capacity).sum())
    bins[order[:full]] = np.arange(full)
    rest = order[full:].tolist()
    leaves = 1 << max(0, len(rest) - 1).bit_length()
    room = [capacity] * (2 * leaves)  # room[i]: the most free room below node i
    for item, need in zip(rest, lengths[order[full:]].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = full + node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every document: its id, start, length, ids (little-endian 32-bit), doc_tokens."""
    kind = dict(docs.dtypes)[id_col]
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            of, starts, ids, totals, held = [], [], [], [], 0
            # Texts are taken one by one and pieces handed on at ``BYTES_AT_ONCE``, whatever a batch holds.
            for row, body in enumerate(encode.encode_all(t.as_py() for t in batch.column(1))):
                body += end
                for start in range(0, len(body), 4 * capacity):
                    of.append(row)
                    starts.append(start // 4)
                    ids.append(body[start : start + 4 * capacity])
                    totals.append(len(body) // 4)
                held += len(body)
                if held >= BYTES_AT_ONCE:
                    yield cut_of(batch, of, starts, ids, totals)
                    of, starts, ids, totals, held = [], [], [], [], 0
            yield cut_of(batch, of, starts, ids, totals)

    def cut_of(batch: pa.RecordBatch, of: list, starts: list, ids: list, totals: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(of, pa.int64())), pa.array(starts, pa.int64()),
             pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
            ["piece_id", "start", "length", "ids", "doc_tokens"],
        )

    schema = f"piece_id {kind}, start long, length long, ids binary, doc_tokens long"
    return docs.select(F.col(id_col), F.col(text)).mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = 2048,
         end_id: int = 1, group_bytes: int = 2 << 20, seed: int = 10) -> DataFrame:
    """One row per piece: the document's id under its own name, start, length, ids, doc_tokens, sequence_id, offset.

    A sequence's pieces lie without gaps from offset 0; its padding follows the last one.
    """
    # Every row has an end id, of four bytes, so rows without text weigh too.
    volume = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 4)).first()[0] or 0
    groups = max(1, -(-volume // group_bytes))

    def place(group: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), capacity)
        first = group.column("pack_group")[0].as_py() << 32
        columns = ["piece_id", "start", "length", "ids", "doc_tokens"]
        return pa.table(
            [*(group.column(c) for c in columns), pa.array(first + bins), pa.array(offsets)], [*columns, "sequence_id", "offset"]
        )

    cut = pieces(docs, tokenizer, id_col, text, capacity, end_id)
    dealt = cut.withColumn("pack_group", F.floor(F.rand(seed) * groups).cast("long"))
    schema = f"{cut.schema.simpleString()[7:-1]},sequence_id:bigint,offset:bigint"
    fields = ", ".join(f.replace(":", " ", 1) for f in schema.split(","))
    return dealt.groupBy("pack_group").applyInArrow(place, fields).withColumnRenamed("piece_id", id_col)
