"""Token ids of whole texts by the tokenizers library, with the pieces of a worker encoded once.

Both public vocabularies cut a text into pieces (words, digits, runs of signs) that are
encoded independently of each other, so a text's ids are its pieces' ids in order. A
worker therefore keeps the ids of the pieces it has met, and only new ones go to the
library's model, in the byte letters that its first step would give them. This holds for texts of Latin letters and ASCII signs without
unusual white space; every other text, and every text under another kind of tokenizer
file, is encoded by the library as it stands. Texts are cut and pieces looked up a few
megabytes at a time, on arrays; where white space counts for nothing it is left out first.
The cache finds pieces by their hashes, compares them whole, and is bounded: when one
generation of pieces is full the one before it is dropped.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
PLAIN = re.compile(rf"[\n -~{LETTERS}]*")
# How the two vocabularies cut texts, for the letters above.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Between texts and between pieces; no plain text holds it.
GAP = "\0"
PIECES_KEPT = 300_000
CHARS_AT_ONCE = 1 << 21


def _byte_letters() -> str:
    """A visible character for every byte: itself where it is visible, else the next free one from 256 on."""
    visible = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    return "".join(chr(b) if visible[b] else chr(256 + b - sum(visible[:b])) for b in range(256))


BYTE_LETTERS = _byte_letters()


# What the bytes of a plain text are; those of two-byte characters are letters all.
IN_GAP, SPACE, LINE_END, LETTER, DIGIT, SIGN = range(6)
BYTE_KINDS = np.full(256, LETTER, np.uint8)
for _byte in range(128):
    if not chr(_byte).isalpha():
        BYTE_KINDS[_byte] = {0: IN_GAP, 32: SPACE, 10: LINE_END}.get(_byte, DIGIT if chr(_byte).isdigit() else SIGN)


def byte_starts(text: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each byte, as the byte vocabulary cuts: ``'(?:[stmd]|re|ve|ll)| ?[letters]+| ?[0-9]+| ?[signs]+|\\s+(?!\\S)|\\s+``.

    Texts end with a gap, which is a piece of its own.
    """
    kind = BYTE_KINDS[text]
    before, after = np.append(np.uint8(IN_GAP), kind[:-1]), np.append(kind[1:], np.uint8(IN_GAP))
    blank, behind_blank = (kind == SPACE) | (kind == LINE_END), (before == SPACE) | (before == LINE_END)
    # A run takes one space before it; what blanks are left are one piece, or two where a line end stands last.
    starts = np.where(blank, ~behind_blank | (after >= LETTER), (kind != before) & (before != SPACE))
    starts |= kind == IN_GAP
    starts |= before == IN_GAP
    _cut_contractions(text, starts)
    return starts


def word_starts(text: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each byte, as the word vocabulary cuts (``WORD_SPLIT``); runs of blanks and gaps are pieces of their own."""
    kind = BYTE_KINDS[text]
    kind[kind == LINE_END] = SPACE
    starts = kind != np.append(np.uint8(IN_GAP), kind[:-1])
    starts |= (kind == DIGIT) | (kind == IN_GAP)
    _cut_contractions(text, starts)
    return starts


def _cut_contractions(text: np.ndarray, starts: np.ndarray) -> None:
    """Makes ``'(?:[stmd]|re|ve|ll)`` a piece where a piece starts with it."""
    quote = np.flatnonzero((text == ord("'")) & starts)
    first, second = text[quote + 1], text[np.minimum(quote + 2, len(text) - 1)]
    one = np.isin(first, np.frombuffer(b"stmd", np.uint8))
    two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    starts[quote[one | two] + 1] = False
    starts[quote[one] + 2] = True
    starts[quote[two] + 3] = True


class _Pieces:
    """Distinct pieces, and how many ids each has of ``flat``, where they lie one after the other; a gap has none.

    ``hashes`` ascend, and ``places`` tells whose each is. Pieces of equal hash are told apart
    whole: only the first is found again, which costs time but never gives another's ids.
    """

    def __init__(self, older: _Pieces | None):
        self.pieces, self.sizes, self.flat = pa.array([GAP], pa.string()), np.zeros(1, np.int32), np.zeros(0, "<u4")
        self.hashes, self.places = np.array([hash(GAP)], np.int64), np.zeros(1, np.int32)
        self.older = older

    def __len__(self) -> int:
        return len(self.pieces) - 1

    def find(self, pieces: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Place of each of the pieces, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        maybe = np.flatnonzero(self.hashes[at] == hashes)
        places = self.places[at[maybe]]
        same = pc.equal(pieces.take(pa.array(maybe)), self.pieces.take(pa.array(places))).to_numpy(zero_copy_only=False)
        found = np.full(len(pieces), -1, np.int64)
        found[maybe[same]] = places[same]
        return found

    def add(self, pieces: pa.Array, hashes: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Keeps the pieces with their ids, and gives their places."""
        places = np.arange(len(self.pieces), len(self.pieces) + len(pieces), dtype=np.int32)
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.sizes, self.flat = np.append(self.sizes, sizes), np.append(self.flat, flat)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order], side="right")
        self.hashes, self.places = np.insert(self.hashes, at, hashes[order]), np.insert(self.places, at, places[order])
        return places

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids for each of the places, and all their ids."""
        counts = self.sizes[places]
        # Where a piece's ids lie in ``flat``, less where they come to lie.
        shift = (np.cumsum(self.sizes) - self.sizes)[places] - (np.cumsum(counts) - counts)
        at = np.repeat(shift, counts)
        at += np.arange(len(at))
        return counts, self.flat[at]


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.specials = [t["content"] for t in described.get("added_tokens", [])]
        self.kind = _kind(described)
        self.model = self.tokenizer.model
        self.pieces = _Pieces(_Pieces(None))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; a null text has none."""
        held, chars = [], 0
        for text in texts:
            held.append(text or "")
            chars += len(held[-1])
            if chars >= CHARS_AT_ONCE:
                yield from self._encode(held)
                held, chars = [], 0
        yield from self._encode(held)

    def _plain(self, text: str) -> bool:
        """Whether the text's pieces can be encoded apart."""
        return self.kind is not None and PLAIN.fullmatch(text) is not None and not any(s in text for s in self.specials)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        plain = [self._plain(t) for t in texts]
        whole = iter(self._by_library([t for t, own in zip(texts, plain) if not own]))
        apart = self._by_pieces([t for t, own in zip(texts, plain) if own])
        for own in plain:
            yield next(apart) if own else next(whole)

    def _by_pieces(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        if len(self.pieces) > PIECES_KEPT:
            self.pieces.older = None
            self.pieces = _Pieces(self.pieces)
        joined = GAP.join([*texts, ""])
        if self.kind == "word":
            body = np.frombuffer(joined.lower().encode(), np.uint8)
            solid = (body != ord(" ")) & (body != ord("\n"))
            starts, body = np.flatnonzero(word_starts(body)[solid]), body[solid]
        else:
            body = np.frombuffer(joined.encode(), np.uint8)
            starts = np.flatnonzero(byte_starts(body))
        offsets = np.append(starts, len(body)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
        counts, ids = self.pieces.ids(self._places(pieces.dictionary)[pieces.indices.to_numpy()])
        ends = 4 * np.cumsum(counts, dtype=np.int64)[body[starts] == ord(GAP)]
        run, start = ids.tobytes(), 0
        for stop in ends.tolist():
            yield run[start:stop]
            start = stop

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Places of the pieces in the cache, which takes new ones from its older part or from the model."""
        kept, older = self.pieces, self.pieces.older
        words = distinct.to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(hash, words), np.int64, len(words))
        places = kept.find(distinct, hashes)
        new = np.flatnonzero(places < 0)
        if len(new) and older is not None:
            before = older.find(distinct.take(pa.array(new)), hashes[new])
            seen = new[before >= 0]
            places[seen] = kept.add(distinct.take(pa.array(seen)), hashes[seen], *older.ids(before[before >= 0]))
            new = new[before < 0]
        if len(new):
            places[new] = kept.add(distinct.take(pa.array(new)), hashes[new], *self._by_model(words[new].tolist()))
        return places

    def _by_model(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all their ids."""
        letters = GAP.join(pieces).encode().decode("latin-1").translate(BYTE_LETTERS).split(BYTE_LETTERS[ord(GAP)])
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(piece)] for piece in letters]
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum()))

    def _by_library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]


def _kind(described: dict) -> str | None:
    before, cutter = described.get("normalizer"), described.get("pre_tokenizer") or {}
    if before is None and cutter.get("type") == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]:
        return "byte"
    steps = [s["type"] for s in (before or {}).get("normalizers", [])]
    splits = cutter.get("pretokenizers") or [{}]
    if steps == ["NFC", "Replace", "Lowercase"] and splits[0].get("pattern") == {"Regex": WORD_SPLIT}:
        return "word"
    return None


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
