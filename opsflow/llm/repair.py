"""Re-Pair grammar compression of one run of ids, with random access.

Frequent neighbouring pairs are replaced by new symbols again and again. Each round
counts all pairs, takes those found at least ``MIN_PAIRS`` times, replaces, of
overlapping occurrences, the one whose pair is more frequent, and so builds many rules in
one pass. Rounds end when the symbols are used up, or a round shortens the run by less
than ``LEAST_GAIN``. A rule only refers to symbols of earlier rounds, so expansions and
their lengths follow round by round. The lengths say which symbols hold a wanted stretch.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MIN_PAIRS = 8
LEAST_GAIN = 0.02
HASH_BITS = 20
MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sIIIQ")


@dataclass
class Grammar:
    """``base`` terminals; rule i stands for symbol base + i; ``ends``: number of rules after each round."""

    base: int
    pairs: np.ndarray
    ends: np.ndarray
    symbols: np.ndarray

    def __post_init__(self):
        sizes = np.ones(self.base + len(self.pairs), np.int64)
        flat, starts = np.arange(self.base, dtype=np.uint32), np.arange(self.base + len(self.pairs), dtype=np.int64)
        first = 0
        for end in self.ends.tolist():
            members = self.pairs[first:end].reshape(-1)
            own = slice(self.base + first, self.base + end)
            sizes[own] = sizes[members].reshape(-1, 2).sum(1)
            starts[own] = len(flat) + np.cumsum(sizes[own]) - sizes[own]
            flat = np.concatenate([flat, _expanded(members, flat, starts, sizes)])
            first = end
        self.sizes, self.starts, self.flat = sizes, starts, flat
        self.upto = np.cumsum(sizes[self.symbols])

    def decode(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``stop``, expanding only the symbols that hold them."""
        total = int(self.upto[-1]) if len(self.upto) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return np.zeros(0, np.uint32)
        low, high = np.searchsorted(self.upto, [start, stop - 1], side="right")
        ids = _expanded(self.symbols[low : high + 1], self.flat, self.starts, self.sizes)
        skipped = start - (int(self.upto[low - 1]) if low else 0)
        return ids[skipped : skipped + stop - start]

    def to_bytes(self) -> bytes:
        width = 2 if self.base + len(self.pairs) <= 1 << 16 else 4
        kind = f"<u{width}"
        head = _HEAD.pack(MAGIC, self.base, len(self.pairs), len(self.ends) << 8 | width, len(self.symbols))
        rule_sizes = self.sizes[self.base :].astype("<u4")
        return b"".join([head, self.ends.astype("<u4").tobytes(), self.pairs.astype(kind).tobytes(),
                         rule_sizes.tobytes(), self.symbols.astype(kind).tobytes()])

    @staticmethod
    def from_bytes(data: bytes) -> Grammar:
        magic, base, rules, packed, count = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a grammar block")
        kind, at = f"<u{packed & 255}", _HEAD.size
        ends = np.frombuffer(data, "<u4", packed >> 8, at)
        at += ends.nbytes
        pairs = np.frombuffer(data, kind, 2 * rules, at)
        at += pairs.nbytes
        sizes = np.frombuffer(data, "<u4", rules, at)
        at += sizes.nbytes
        grammar = Grammar(base, pairs.reshape(-1, 2), ends, np.frombuffer(data, kind, count, at))
        if not np.array_equal(grammar.sizes[base:], sizes):
            raise ValueError("rule lengths do not match the rules")
        return grammar


def _expanded(symbols: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The symbols' expansions, one after the other."""
    count = sizes[symbols]
    stops = np.cumsum(count)
    shift = starts[symbols] - stops + count
    return flat[np.repeat(shift, count) + np.arange(stops[-1] if len(stops) else 0)]


def compress(ids: np.ndarray, base: int) -> Grammar:
    """Grammar of ``ids``, all below ``base``; uses symbols up to 16 bits if the terminals leave room there."""
    wide = base > (1 << 16) - (1 << 12)
    room = (1 << 20) if wide else (1 << 16) - base
    kind, half = (np.uint64, np.uint64(32)) if wide else (np.uint32, np.uint32(16))
    run = ids.astype(kind)
    pairs, ends = [], []
    while room and len(run) > 1:
        keys = (run[:-1] << half) | run[1:]
        chosen, counts = _frequent(keys, room)
        if not len(chosen):
            break
        at, of = _occurrences(keys, chosen, counts)
        used = np.bincount(of, minlength=len(chosen))
        kept = used > 1
        number = np.cumsum(kept) - 1
        good = kept[of]
        at, of = at[good], of[good]
        if len(at) < LEAST_GAIN * len(run):
            break
        run[at] = (base + number[of]).astype(kind)
        stay = np.ones(len(run), bool)
        stay[at + 1] = False
        run = run[stay]
        new = chosen[kept]
        pairs.append(np.stack([new >> half, new & ((kind(1) << half) - kind(1))], 1).astype(np.uint32))
        base, room = base + len(new), room - len(new)
        ends.append(base)
    rules = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.uint32)
    terminals = base - len(rules)
    return Grammar(terminals, rules, np.array(ends, np.int64) - terminals, run.astype(np.uint32))


def _frequent(keys: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pairs, at most ``room``, and their counts."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(counts >= MIN_PAIRS)
    if len(often) > room:
        often = np.sort(often[np.argsort(-counts[often], kind="stable")[:room]])
    return ordered[starts[often]], counts[often]


def _occurrences(keys: np.ndarray, chosen: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of chosen pairs that do not overlap, and which pair each is.

    Pairs that share a hash slot with a later one wait for the next round.
    """
    slots = np.zeros(1 << HASH_BITS, np.uint32)
    slots[_slot(chosen)] = np.arange(1, len(chosen) + 1)
    of = slots[_slot(keys)]
    at = np.flatnonzero(of)
    of = of[at] - 1
    same = chosen[of] == keys[at]
    at, of = at[same], of[same]
    score = counts[of]
    beside = at[1:] == at[:-1] + 1
    lost = np.zeros(len(at), bool)
    lost[1:] |= beside & (score[:-1] >= score[1:])
    lost[:-1] |= beside & (score[1:] > score[:-1])
    return at[~lost], of[~lost]


def _slot(keys: np.ndarray) -> np.ndarray:
    if keys.dtype == np.uint32:
        return (keys * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)
    return (keys * np.uint64(11400714819323198485)) >> np.uint64(64 - HASH_BITS)
