"""Katz backoff language model with Good-Turing discounts, fitted and evaluated over the whole corpus.

Texts are read in shards, runs of neighbouring documents of one task. A shard asks for each
of its distinct n-grams once, so a word or phrase that stands everywhere costs no more than
one row a shard, and no n-gram is ever gathered from all its places. Four steps:

1. Count: every shard sends its distinct n-grams of all orders, with its own counts, to the
   part of the key space that they fall in. A part adds them up, stores its piece of the
   n-gram table, and answers every shard with the corpus counts.
2. Discount: counts of counts give Good-Turing discounts. An n-gram seen r times weighs
   r* = (r + 1) n(r + 1) / n(r); where that is not between 0 and r, or r is above
   ``TURING``, the log-linear smoothing of n(r) takes its place (Gale and Sampson 1995). So
   every count loses something, and every history keeps some mass for unseen words.
3. Back off: for each distinct n-gram, one shard that has it (the first) sends its discounted
   count and its lower-order probability to the part of its history, which adds them up to
   backoff(h) = (1 - sum of P(w | h)) / (1 - sum of P(w | shorter h)), over the words seen
   after h. The probabilities after any history so add up to 1 exactly. The weights are stored
   by part beside the n-grams.
4. Score: P(w | h) is the discounted share if h w was seen, else backoff(h) P(w | shorter h),
   down to single words; unknown words share, as one class, the mass that the discounts of
   single words leave. Shards add up what their counts tell; backoff weights that a shard needs
   are asked from their parts, except those of at most ``HOT`` - 1 hot histories an order
   (found in more than 1 of ``HOT`` tokens), which are read by all.

Tokens: the text's words (see ``base.WORD``) with A-Z in lower case, then an end. A text is
preceded by start marks, which are never predicted. N-grams are known by 64-bit hashes.

Defined cases: a null or empty text is the end alone; repeated rows and ids count as often
as they occur; a null id counts as an empty text for the fold; without training rows every
token has probability 1; an empty table gives an empty result. ``docs`` must read the same
when read twice (a table, not a sample or an unsorted shuffle); if not, the query fails.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.session import work_path

SHARD_TOKENS = 1 << 20
PART_BYTES = 8 << 20
TURING = 5
HOT = 4096
END, START = xxhash.xxh64_intdigest(b""), xxhash.xxh64_intdigest(b"\n")  # no word is empty or a line feed

ASK = "n int, part int, shard long, keys binary, counts binary"
COUNTED = "kind string, n int, part int, shard long, keys binary, counts binary, first binary, sums array<long>"


# --- arrays as bytes: byte planes, so that high bytes, mostly zero, vanish ---


def packed(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 3)


def unpacked(body: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(body), np.uint8)
    size = np.dtype(kind).itemsize
    return planes.reshape(size, -1).T.copy().view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, as steps."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(body: bytes) -> np.ndarray:
    return np.cumsum(unpacked(body, np.uint64), dtype=np.uint64)


# --- n-grams of a shard ------------------------------------------------------


def followed(history: np.ndarray | np.uint64, word: np.ndarray | np.uint64) -> np.ndarray:
    """Keys of histories followed by words."""
    mixed = history * np.uint64(0x9E3779B97F4A7C15) + word
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


@dataclass
class Shard:
    """Some documents; ``lengths``: tokens of each, ends included; ``words``: keys of its distinct words; ``tokens``: places in it."""

    number: int
    ids: pa.Array
    held: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    tokens: np.ndarray

    def grams(self, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Keys of the n-grams that end at each token, and of their histories, for n = 1 to ``order`` (single words have none)."""
        first = np.cumsum(self.lengths) - self.lengths
        word = self.words[self.tokens]
        keys, before, start = [word], [np.zeros(0, np.uint64)], np.full(1, START, np.uint64)
        for _ in range(order - 1):
            history = np.roll(keys[-1], 1)
            history[first] = start[0]
            before.append(history)
            keys.append(followed(history, word))
            start = followed(start, np.full(1, START, np.uint64))
        return keys, before


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """The task's documents (id, held, body) in shards of about ``SHARD_TOKENS`` tokens, numbered alike on every read."""
    number = TaskContext.get().partitionId() << 32
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__

    def closed() -> Shard:
        keys = np.array([xxhash.xxh64_intdigest(w) for w in known], np.uint64)
        shard = Shard(number, pa.concat_arrays(ids), np.array(held, bool), np.array(lengths, np.int64), keys, np.concatenate(tokens))
        known.clear()
        return shard

    ids, held, lengths, tokens, size = [], [], [], [], 0
    for batch in batches:
        flags, bodies, begun = batch.column(1).to_pylist(), batch.column(2), 0
        for row in range(batch.num_rows):
            words = bodies[row].as_py().lower().split()  # bytes: ASCII letters and blanks alone
            words.append(b"")
            tokens.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
            held.append(flags[row])
            lengths.append(len(words))
            size += len(words)
            if size >= SHARD_TOKENS:
                ids.append(batch.column(0).slice(begun, row + 1 - begun))
                yield closed()
                ids, held, lengths, tokens, size, begun, number = [], [], [], [], 0, row + 1, number + 1
        if begun < batch.num_rows:
            ids.append(batch.column(0).slice(begun))
    if lengths:
        yield closed()


def _cut(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The parts that ascending ``keys`` fall in, each with its stretch of them."""
    of = part_of(keys, parts)
    found, starts = np.unique(of, return_index=True)
    for part, start, stop in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        yield part, slice(start, stop)


# --- discounts -----------------------------------------------------------------


@dataclass
class Discount:
    """Good-Turing counts of one order, from its counts of counts n(1) to n(TURING + 1)."""

    turing: np.ndarray
    slope: float

    @classmethod
    def of(cls, counts_of_counts: np.ndarray) -> Discount:
        found = np.flatnonzero(counts_of_counts > 0)
        slope = float(np.polyfit(np.log(found + 1), np.log(counts_of_counts[found]), 1)[0]) if len(found) > 1 else -2.0
        discount = cls(np.zeros(TURING + 1), slope if slope < -1 else -2.0)
        for r in range(TURING + 1):
            now, after = (counts_of_counts[r - 1], counts_of_counts[r]) if r else (0, 0)
            share = (r + 1) * after / now if now else 0.0
            discount.turing[r] = share if 0 < share < r else discount.smooth(np.array([r]))[0]
        return discount

    def smooth(self, counts: np.ndarray) -> np.ndarray:
        safe = np.maximum(counts, 1)
        return np.where(counts > 0, counts * (1 + 1 / safe) ** (self.slope + 1), 0.0)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts: above 0 and below the count, and 0 for 0."""
        return np.where(counts <= TURING, self.turing[np.minimum(counts, TURING)], self.smooth(counts))


@dataclass
class Model:
    """Where the tables lie, and the numbers that hold for the whole corpus."""

    path: str
    order: int
    parts: int
    tokens: int
    words: int
    discounts: list[Discount]
    unknown: float = 1.0

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.words + 1)))

    @property
    def hot(self) -> int:
        """Histories counted more often are hot."""
        return self.tokens // HOT


# --- 1. count ------------------------------------------------------------------


def _asks(order: int, parts: int):
    schema = _arrow(ASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            train = np.repeat(~shard.held, shard.lengths)
            for n, keys in enumerate(shard.grams(order)[0], 1):
                distinct, place = np.unique(keys, return_inverse=True)
                counts = np.bincount(place[train], minlength=len(distinct))
                rows = [(n, part, shard.number, packed_keys(distinct[at]), packed(counts[at])) for part, at in _cut(distinct, parts)]
                yield pa.RecordBatch.from_pylist([dict(zip(("n", "part", "shard", "keys", "counts"), r)) for r in rows], schema)

    return run


def _counted():
    schema = _arrow(COUNTED)

    def run(group: pa.Table) -> pa.Table:
        """One part's counts: a row of the n-gram table, and a reply to each shard."""
        rows = sorted(group.to_pylist(), key=lambda r: r["shard"])
        keys = [unpacked_keys(r["keys"]) for r in rows]
        own = np.concatenate([unpacked(r["counts"]) for r in rows])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, own)
        # The first shard that trains on an n-gram speaks for it.
        trained = np.flatnonzero(own > 0)
        first = np.zeros(len(own), bool)
        first[trained[np.unique(place[trained], return_index=True)[1]]] = True
        out, at = [], 0
        for row, mine in zip(rows, keys):
            stretch = slice(at, at + len(mine))
            out.append({"kind": "reply", "n": row["n"], "part": row["part"], "shard": row["shard"], "counts": packed(totals[place[stretch]]),
                        "first": zstandard.compress(np.packbits(first[stretch]).tobytes()), "sums": [_mark(mine)]})
            at += len(mine)
        seen = totals > 0
        of = np.bincount(np.minimum(totals[seen], TURING + 2), minlength=TURING + 3)[1 : TURING + 2]
        out.append({"kind": "ngrams", "n": rows[0]["n"], "part": rows[0]["part"], "keys": packed_keys(distinct[seen]), "counts": packed(totals[seen]),
                    "sums": [int(totals.sum()), int(seen.sum()), *of.tolist()]})
        return pa.Table.from_pylist(out, schema)

    return run


def _count(docs: DataFrame, order: int, parts: int, path: str) -> None:
    asked = docs.mapInArrow(_asks(order, parts), ASK)
    asked.groupBy("n", "part").applyInArrow(_counted(), COUNTED).write.partitionBy("kind").parquet(f"{path}/counts")


# --- 2. discount ---------------------------------------------------------------


def _model(spark: SparkSession, path: str, order: int, parts: int) -> Model:
    ngrams = spark.read.schema(COUNTED).parquet(f"{path}/counts").where("kind = 'ngrams'")
    summed = {r.n: r for r in ngrams.groupBy("n").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(TURING + 3)]).collect()}
    known = [[int(v) for v in list(summed[n])[1:]] if n in summed else [0] * (TURING + 3) for n in range(1, order + 1)]
    model = Model(path, order, parts, known[0][0], known[0][1], [Discount.of(np.array(k[2:], float)) for k in known])
    if model.tokens:
        discount = model.discounts[0]

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                weights = [float(discount(unpacked(body)).sum()) for body in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(weights, pa.float64())], ["weight"])

        weight = ngrams.where("n = 1").select("counts").mapInArrow(weigh, "weight double").agg(F.sum("weight")).first()[0]
        model.unknown = 1 - weight / model.tokens
    return model


# --- 3. back off, and what a shard knows of its own scores ------------------------
# Rows of a shard's answer, by kind; all arrays are packed:
#   sums   for the part of histories ``keys``: one discounted counts, two lower probabilities, three history counts
#   uses   of the backoff weights of ``keys``: one documents of each, two places of the documents, three times
#   late   the same, for hot histories; kept for the last step
#   score  ids, held; one n_tokens, two n_known, three base scores, four known parts of the scores
# and of a part's: backoff (one weights), hot (the same for hot histories), gains (one places, two logarithms).

_ANSWER = "kind string, n int, part int, shard long, keys binary, one binary, two binary, three binary, four binary, held binary, ids array<{}>"
_HOME = "shard long, ids array<{}>, held binary, lengths binary, words binary, tokens binary"


def _homes(kind: str):
    schema = _arrow(_HOME.format(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            row = [pa.array([shard.number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(shard.ids)], pa.int32()), shard.ids)]
            row += [pa.array([packed(a)], pa.binary()) for a in (shard.held, shard.lengths, shard.words, shard.tokens)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(row, schema)], schema=schema)

    return run


def _answers(model: Model, kind: str):
    schema = _arrow(_ANSWER.format(kind))

    def run(home: pa.Table, replies: pa.Table) -> pa.Table:
        row = home.slice(0, 1)
        held, lengths, words, tokens = (
            unpacked(row.column(c)[0].as_py(), k) for c, k in (("held", bool), ("lengths", np.int64), ("words", np.uint64), ("tokens", np.uint32)))
        ids = row.column("ids").combine_chunks().flatten()
        shard = Shard(row.column("shard")[0].as_py(), ids, held, lengths, words, tokens)
        keys, before = shard.grams(model.order)
        first = np.cumsum(lengths) - lengths
        doc = np.repeat(np.arange(len(lengths)), lengths)
        answer, by_order = [], defaultdict(list)
        for reply in replies.select(["n", "part", "counts", "first", "sums"]).to_pylist():
            by_order[reply["n"]].append(reply)
        level = np.zeros(len(tokens), np.int8)  # the longest n-gram that ends here and was seen
        known = np.zeros(len(tokens))
        counts = history = lower = None
        for n in range(1, model.order + 1):
            distinct, sample, place = np.unique(keys[n - 1], return_index=True, return_inverse=True)
            total, speaks = _replied(by_order[n], distinct)
            if n == 1:
                ends = first + lengths - 1
                starts = int(total[place[ends[0]]])  # a start mark is as frequent as an end
                known_words, base = (_added(values[place], first) for values in ((total > 0).astype(np.int64), model.base(total)))
                history, chance = np.full(len(tokens), model.tokens), np.full(len(tokens), model.unknown)
            else:
                history, chance = np.roll(counts, 1), np.zeros(len(tokens))
                history[first] = starts
            counts = total[place]
            seen = counts > 0
            chance[seen] = model.discounts[n - 1](counts[seen]) / history[seen]
            if n > 1:
                answer += _sums(n, shard.number, before[n - 1], sample[speaks], model, counts, history, lower)
            at = seen if n > 1 else slice(None)
            known[at] = np.log10(chance[at])
            level[seen], lower = n, chance
            before[n - 1] = (before[n - 1], history)
        for n in range(2, model.order + 1):
            answer += _uses(n, shard.number, *before[n - 1], level, doc, model)
        answer.append({
            "kind": "score", "n": 0, "part": _spread(shard.number), "shard": shard.number, "held": packed(held), "one": packed(lengths),
            "two": packed(known_words), "three": packed(base),
            "four": packed(_added(known, first)), "ids": ids.to_pylist()})
        return pa.Table.from_pylist(answer, schema)

    return run


def _spread(shard: int) -> int:
    """A part of its own for what a shard only passes on."""
    return ((shard >> 32) * 1000003 + shard) & 0x7FFFFFFF


def _added(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first)


def _mark(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys, initial=0).astype(np.int64))


def _replied(replies: list[dict], distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts of a shard's distinct n-grams, in their order, and which of them it speaks for."""
    replies.sort(key=lambda r: r["part"])
    counts = [unpacked(r["counts"]) for r in replies]
    speaks = [np.unpackbits(np.frombuffer(zstandard.decompress(r["first"]), np.uint8), count=len(c)) for r, c in zip(replies, counts)]
    total = np.concatenate([*counts, np.zeros(0, np.int64)])
    if len(total) != len(distinct) or np.bitwise_xor.reduce([r["sums"][0] for r in replies]) != _mark(distinct):
        raise RuntimeError("the documents were not the same when they were read again")
    return total, np.concatenate([*speaks, np.zeros(0, np.uint8)]).astype(bool)


def _sums(n: int, shard: int, before: np.ndarray, at: np.ndarray, model: Model, counts: np.ndarray, history: np.ndarray,
          lower: np.ndarray) -> Iterator[dict]:
    """What the n-grams at places ``at``, each of another kind, add to their histories."""
    keys, sample, place = np.unique(before[at], return_index=True, return_inverse=True)
    taken = np.bincount(place, model.discounts[n - 1](counts[at]), len(keys))
    below, of = np.bincount(place, lower[at], len(keys)), history[at][sample]
    for part, cut in _cut(keys, model.parts):
        yield {"kind": "sums", "n": n, "part": part, "shard": shard, "keys": packed_keys(keys[cut]), "one": packed(taken[cut]),
               "two": packed(below[cut]), "three": packed(of[cut])}


def _uses(n: int, shard: int, before: np.ndarray, history: np.ndarray, level: np.ndarray, doc: np.ndarray, model: Model) -> Iterator[dict]:
    """The backoff weights of order ``n`` that the shard's documents need, and how often."""
    needed = (level < n) & (history > 0)
    for hot in (False, True):
        at = np.flatnonzero(needed & ((history > model.hot) == hot))
        keys, place = np.unique(before[at], return_inverse=True)
        size = int(doc[-1]) + 1
        pairs, times = np.unique(place * size + doc[at], return_counts=True)
        of, docs = pairs // size, pairs % size
        starts = np.searchsorted(of, np.arange(len(keys) + 1))
        for part, cut in _cut(keys, 1 if hot else model.parts):
            own = slice(starts[cut.start], starts[cut.stop])
            yield {"kind": "late" if hot else "uses", "n": 0 if hot else n, "part": _spread(shard) if hot else part, "shard": shard,
                   "keys": packed_keys(keys[cut]), "one": packed(np.diff(starts)[cut]), "two": packed(docs[own]), "three": packed(times[own])}


def _resolved(model: Model, kind: str):
    schema = _arrow(_ANSWER.format(kind))

    def run(group: pa.Table) -> pa.Table:
        """One part's backoff weights, and what they add to the scores of each shard's documents."""
        if not group.column("n")[0].as_py():
            return group.cast(schema)
        rows = sorted(group.drop_columns(["ids", "held", "four"]).to_pylist(), key=lambda r: r["shard"])
        sums = [r for r in rows if r["kind"] == "sums"]
        joined = np.concatenate([unpacked_keys(r["keys"]) for r in sums])
        keys, place = np.unique(joined, return_inverse=True)
        taken, below = (np.bincount(place, np.concatenate([unpacked(r[c], float) for r in sums]), len(keys)) for c in ("one", "two"))
        count = np.zeros(len(keys), np.int64)
        count[place] = np.concatenate([unpacked(r["three"]) for r in sums])
        # The unknown class was not seen after any history, so some mass is always left below.
        least = model.unknown if rows[0]["n"] == 2 else 1e-15
        weights = (1 - taken / count) / np.maximum(1 - below, least)
        head = {"n": rows[0]["n"], "part": rows[0]["part"]}
        out = [{**head, "kind": "backoff", "keys": packed_keys(keys), "one": packed(weights)}]
        hot = count > model.hot
        if hot.any():
            out.append({**head, "kind": "hot", "keys": packed_keys(keys[hot]), "one": packed(weights[hot])})
        for row in rows:
            if row["kind"] == "uses":
                docs, gains = _gains(row, keys, weights)
                out.append({**head, "kind": "gains", "shard": row["shard"], "one": packed(docs), "two": packed(gains)})
        return pa.Table.from_pylist(out, schema)

    return run


def _gains(row: dict, keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of documents, and the logarithms that the weights of their histories add to each."""
    docs, times = unpacked(row["two"]), unpacked(row["three"])
    asked = np.repeat(unpacked_keys(row["keys"]), unpacked(row["one"]))
    found, place = np.unique(docs, return_inverse=True)
    return found, np.bincount(place, times * np.log10(weights[np.searchsorted(keys, asked)]), len(found))


# --- 4. score ------------------------------------------------------------------


def _totals(model: Model, kind: str, hot_keys: np.ndarray, hot_weights: np.ndarray):
    schema = _arrow(_RESULT.format(kind))

    def run(group: pa.Table) -> pa.Table:
        """The documents of one shard with their whole scores."""
        at = group.column("kind").to_pylist().index("score")
        ids = group.column("ids").slice(at, 1).combine_chunks().flatten()
        rows = sorted(group.drop_columns(["ids"]).to_pylist(), key=lambda r: (r["kind"], r["n"], r["part"]))
        score = next(r for r in rows if r["kind"] == "score")
        total = unpacked(score["four"], float)
        for row in rows:
            if row["kind"] == "gains":
                total[unpacked(row["one"])] += unpacked(row["two"], float)
            elif row["kind"] == "late":
                docs, gains = _gains(row, hot_keys, hot_weights)
                total[docs] += gains
        columns = [ids, unpacked(score["held"], bool), unpacked(score["one"]), unpacked(score["two"]), np.full(len(ids), model.tokens),
                   unpacked(score["three"], float), total]
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


_RESULT = "id {}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fit_and_score(docs: DataFrame, held_out: Column, order: int = 2, id_col: str = "doc_id", text: str = "text",
                  path: str | None = None) -> DataFrame:
    """Every row's id, under its own name, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Rows where ``held_out`` is not true are trained on. The model's tables are stored below
    ``path`` (see ``read_model``), by default in the working folder.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    path = path or work_path(spark, "katz")
    volume = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 4)).first()[0] or 0
    parts = max(1, -(-volume // PART_BYTES))
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                         F.coalesce(text, F.lit("")).cast("binary").alias("body"))
    _count(narrow, order, parts, path)
    model = _model(spark, path, order, parts)
    replies = spark.read.schema(COUNTED).parquet(f"{path}/counts").where("kind = 'reply'").select("n", "part", "shard", "counts", "first", "sums")
    answer = _ANSWER.format(kind)
    answered = (
        narrow.mapInArrow(_homes(kind), _HOME.format(kind)).groupBy("shard").cogroup(replies.groupBy("shard"))
        .applyInArrow(_answers(model, kind), answer)
    )
    answered.groupBy("n", "part").applyInArrow(_resolved(model, kind), answer).write.partitionBy("kind").parquet(f"{path}/answers")
    stored = spark.read.schema(answer).parquet(f"{path}/answers")
    # Fewer than HOT histories of each order.
    hot = stored.where("kind = 'hot'").select("keys", "one").collect()
    hot_keys = np.concatenate([*(unpacked_keys(bytes(r["keys"])) for r in hot), np.zeros(0, np.uint64)])
    hot_weights = np.concatenate([*(unpacked(bytes(r["one"]), float) for r in hot), np.zeros(0)])
    by_key = np.argsort(hot_keys)
    mine = stored.where("kind in ('score', 'gains', 'late')").select("kind", "n", "part", "shard", "keys", "one", "two", "three", "four", "held", "ids")
    totals = _totals(model, kind, hot_keys[by_key], hot_weights[by_key])
    return mine.groupBy("shard").applyInArrow(totals, _RESULT.format(kind)).withColumnRenamed("id", id_col)


def key_of(words: list[str]) -> int:
    """The key of an n-gram as ``read_model`` shows it; "" is the end, "\\n" a start mark."""
    keys = [np.full(1, xxhash.xxh64_intdigest(w.encode()), np.uint64) for w in words]
    key = keys[0]
    for word in keys[1:]:
        key = followed(key, word)
    return int(key.astype(np.int64)[0])


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """The tables of a stored model as rows: n, key, count, and backoff, the weight of the n-gram as a history.

    A history of start marks alone has a weight but no count.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, keys, body in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n, np.int32)), pa.array(keys), pa.array(unpacked(body))], ["n", "key", "count"])

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, keys, body in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n - 1, np.int32)), pa.array(keys), pa.array(unpacked(body, float))],
                                             ["n", "key", "backoff"])

    stored = spark.read.schema(COUNTED).parquet(f"{path}/counts").where("kind = 'ngrams'")
    answers = spark.read.schema(_ANSWER.format("long")).parquet(f"{path}/answers").where("kind = 'backoff'")
    seen = stored.select("n", "keys", "counts").mapInArrow(counts, "n int, key long, count long")
    return seen.join(answers.select("n", "keys", "one").mapInArrow(weights, "n int, key long, backoff double"), ["n", "key"], "full_outer")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, bytes]]:
    for batch in batches:
        for n, keys, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
            yield n, unpacked_keys(keys).astype(np.int64), body


def _arrow(schema: str) -> pa.Schema:
    """The Arrow schema of a DDL one; for the driver, which has a session."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
