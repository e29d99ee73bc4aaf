"""Texts to token ids by way of distinct words.

A byte-level BPE encodes the words of a text independently, and most words
recur.  Texts are split into words for a whole block at once by numpy (the
splitting pattern only depends on character classes at word borders), each
distinct word is encoded once by the word encoder it is given, and ids are then
gathered from a table that a Python worker keeps from task to task.  The table
is dropped and refilled when it exceeds ``TABLE_WORDS``, so memory is bounded.

The splitter implements the pattern of byte-level tokenizers of this kind:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from . import textvec as tv
from .common import slices

TABLE_WORDS = 1_000_000
OTHER, LETTER, NUMBER, SPACE, SPECIAL = range(5)
_SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        first = unicodedata.category(chr(cp))[0]
        if first in "LN":
            kind[cp] = LETTER if first == "L" else NUMBER
    kind[_SPACES] = SPACE
    return kind, tv.mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def code_points(offsets: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, str]:
    """(offsets in code points, code points, the joined text)."""
    joined = body.tobytes().decode("utf-8")
    if len(joined) == len(body):
        return offsets, body.astype(np.uint32), joined
    before = np.zeros(len(body) + 1, np.int64)
    np.cumsum((body & 0xC0) != 0x80, out=before[1:])
    return before[offsets], np.frombuffer(joined.encode("utf-32-le"), np.uint32), joined


def split(cp: np.ndarray, offsets: np.ndarray, joined: str, specials: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every word in code points; no word crosses a text's border, a special token is a word."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _tables()[0][cp]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    for special in specials:
        at = joined.find(special)
        while at >= 0:
            # Only inside one text.
            if not border[at + 1 : at + len(special)].any():
                border[[at, at + len(special)]] = True
                kind[at : at + len(special)] = SPECIAL
                at = joined.find(special, at + len(special))
            else:
                at = joined.find(special, at + 1)
    change = border.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    begins = change.copy()
    run = np.flatnonzero(change[:n])
    end = np.append(run[1:], n)
    inner = (kind[run] == SPACE) & ~border[end]
    last = end[inner] - 1
    begins[last] = True
    begins[end[inner][cp[last] == 32]] = False
    quote = run[(cp[run] == 0x27) & (end - run == 1) & ~border[end]]
    if len(quote):
        quote = quote[begins[quote] & (kind[quote + 1] == LETTER)]
        one = cp[quote + 1]
        after = np.minimum(quote + 2, n - 1)
        two = np.where((quote + 2 < n) & ~change[np.minimum(quote + 2, n)], cp[after], 0)
        size = np.where(np.isin(one, [115, 116, 109, 100]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 2
        quote, size = quote[size > 0], size[size > 0]
        begins[quote + 1] = False
        begins[quote + 1 + size] = True
    starts = np.flatnonzero(begins[:n])
    return starts, np.append(starts[1:], n)


class WordTable:
    """Ids of distinct words, found by 64-bit hash; words it lacks are encoded when first met."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = TABLE_WORDS):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def find(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, joined: str) -> np.ndarray:
        """The slot of every word."""
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > max(self.limit, 2 * len(distinct)):
            self.clear()
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        if not known.all():
            new = at[~known]
            ids = self.encode([joined[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            slots = np.arange(len(new)) + len(self.first) - 1
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, np.fromiter((x for word in ids for x in word), np.uint32, int(sizes.sum()))])
            self.hashes = np.insert(self.hashes, place[~known], distinct[~known])
            self.slots = np.insert(self.slots, place[~known], slots)
            place = np.searchsorted(self.hashes, distinct)
        return self.slots[place][back]

    def ids(self, offsets: np.ndarray, body: np.ndarray, specials: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offsets of the texts in them)."""
        at, cp, joined = code_points(offsets, body)
        starts, ends = split(cp, at, joined, specials)
        slots = self.find(tv.segment_hashes(cp, starts, ends, _tables()[1]), starts, ends, joined)
        size = self.first[slots + 1] - self.first[slots]
        total = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(self.first[slots] - total[:-1], size) + np.arange(total[-1])
        return self.flat[pick], total[np.searchsorted(starts, at)]


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies show each byte as a printable character: itself where it is one, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in shown:
            shown[b] = chr(256 + len(shown) - len(plain))
    return {c: b for b, c in shown.items()}


@lru_cache(4)
def vocabulary(path: str) -> tuple[list[bytes], list[tuple[int, int, int]], dict[str, int]]:
    """(label of each id, merges as (left, right, merged) by rank, special tokens) of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = byte_alphabet()
    vocab = spec["model"]["vocab"]
    specials = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
    labels = [b""] * (1 + max([*vocab.values(), *specials.values()]))
    for token, i in vocab.items():
        labels[i] = bytes(byte[c] for c in token)
    for token, i in specials.items():
        labels[i] = token.encode()
    pairs = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
    return labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], specials


_kept: dict[tuple[str, str], tuple[WordTable, tuple[str, ...]]] = {}


def word_table(path: str, kind: str = "library") -> tuple[WordTable, tuple[str, ...]]:
    """This worker's table for a tokenizer file, and the file's special tokens.

    kind: ``library`` encodes new words by the tokenizers library, ``automaton`` by :mod:`.bpe`.
    """
    if (path, kind) not in _kept:
        specials = vocabulary(path)[2]
        if kind == "automaton":
            from .bpe import automaton

            encode = automaton(path).encode_words
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()

            def encode(words: list[str]) -> list[list[int]]:
                return [x.ids for i in range(0, len(words), 4096) for x in library.encode_batch(words[i : i + 4096], add_special_tokens=False)]

        _kept[path, kind] = WordTable(encode), tuple(specials)
    return _kept[path, kind]


def encoded(batches: Iterator[pa.RecordBatch], path: str, kind: str = "library", text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids, offsets of the rows in them) of about a megabyte of text each."""
    words, specials = word_table(path, kind)
    for rows, offsets, body in slices(batches, text):
        yield rows, *words.ids(offsets, body, specials)
