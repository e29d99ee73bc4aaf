"""BPE encoding by a deterministic automaton over tokens, compiled from the merges.

The automaton starts as one state with a loop for each byte.  Merges are taken
in rank order; for a merge of u and v the gadget changes it so that u is never
followed by v and the merged token stands where the two stood:

* the state that u leads to is split: u gets a copy without the arc on v;
* wherever an arc on u leaves, an arc on the merged token leaves as well, and it
  leads where v led.

After the last merge it accepts exactly the correct tokenisations.  A state is
kept as its parent and the arcs that it lost, each with the merge that took it,
and an arc on a merged token exists where the arc on its left half existed when
the merge came; so construction is linear in the merges.  Arcs written out would
be states times tokens (about 10^9), so a worker tabulates an arc when a word
first asks for it.

A pre-split word has one path through the automaton whose labels spell it, and
the beginning of a path spells the beginning of the word.  So one pass over the
bytes settles it: a table of byte transitions tells which labels end at a byte,
and the one whose arc leaves the state where it begins is the last of the path so
far; there is exactly one.  Nothing is tried again.  Decoding emits the labels of
the arcs.

Edge cases: null and empty texts have no ids and decode to the empty text; a
special token's string in a text is that token, as in the library; bytes that
are no UTF-8 decode to U+FFFD as in the library.  Equal rows give equal rows,
order and ties do not matter, extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoded, vocabulary


class Automaton:
    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        size = len(labels)
        self.labels = labels
        self.left = [-1] * size
        self.made = [-1] * size  # the merge that made a token
        self.state = [0] * size  # where an arc on the token leads
        self.parent, self.born = [0], [-1]
        self.owners = {0: len(labels) + 1}  # and the start of a word
        self.lost: dict[int, int] = {}
        merged, never = set(), {w for _, _, w in merges}
        for k, (u, v, w) in enumerate(merges):
            if u in never or v in never or not self.arc(self.state[u], v, k - 1):
                continue  # the two never meet, so nothing is merged
            self.left[w], self.made[w] = u, k
            merged.add(w)
            never.discard(w)
            was = self.state[u]
            self.owners[self.state[w]] -= 1
            self.state[w] = self.state[v]
            self.owners[self.state[w]] += 1
            if self.owners[was] > 1:
                self.owners[was] -= 1
                self.state[u] = len(self.parent)
                self.owners[self.state[u]] = 1
                self.parent.append(was)
                self.born.append(k)
            self.lost.setdefault(self.state[u] << 20 | v, k)
        self.size = [len(x) for x in labels]
        self.specials: dict[bytes, int] = {}
        self._compile([i for i in range(size) if len(labels[i]) == 1 or i in merged])
        self.arcs: dict[int, bool] = {}

    def _lost(self, state: int, token: int, until: int) -> bool:
        """Whether the state had lost its arc on the token by a merge."""
        while True:
            k = self.lost.get(state << 20 | token)
            if k is not None and k <= until:
                return True
            if not state:
                return False
            until = min(until, self.born[state] - 1)
            state = self.parent[state]

    def arc(self, state: int, token: int, until: int = 1 << 60) -> bool:
        """Whether an arc on the token leaves the state, in the finished automaton or after a merge."""
        while token >= 0:
            if self._lost(state, token, until):
                return False
            until = min(until, self.made[token])
            token = self.left[token]
        return True

    def _compile(self, tokens: list[int]) -> None:
        """Byte transitions over the beginnings of labels, where to go on if there is none, and the labels that end at each."""
        self.next: list[dict[int, int]] = [{}]
        ends = [-1]
        for i in tokens:
            node = 0
            for byte in self.labels[i]:
                if byte not in self.next[node]:
                    self.next[node][byte] = len(self.next)
                    self.next.append({})
                    ends.append(-1)
                node = self.next[node][byte]
            ends[node] = i
        self.back = [0] * len(self.next)
        self.ending = ends  # the longest label that ends here
        self.suffix = [-1] * len(self.labels)  # the next shorter label that ends where a label does
        queue = list(self.next[0].values())
        for node in queue:  # by length, so shorter ones are settled
            if ends[node] >= 0:
                self.suffix[ends[node]] = ends[self.back[node]] if self.back[node] else -1
            else:
                ends[node] = ends[self.back[node]]
            for byte, child in self.next[node].items():
                at = self.back[node]
                while at and byte not in self.next[at]:
                    at = self.back[at]
                self.back[child] = self.next[at].get(byte, 0)
                queue.append(child)

    def encode(self, word: bytes) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        next_, back, ending, suffix, size, state, arcs = self.next, self.back, self.ending, self.suffix, self.size, self.state, self.arcs
        node, last, states = 0, [-1], [0]
        for at, byte in enumerate(word, 1):
            while node and byte not in next_[node]:
                node = back[node]
            node = next_[node].get(byte, 0)
            token = ending[node]
            while token >= 0:
                key = states[at - size[token]] << 20 | token
                open_ = arcs.get(key)
                if open_ is None:
                    if len(arcs) > 2_000_000:
                        arcs.clear()
                    open_ = arcs[key] = self.arc(key >> 20, token)
                if open_:
                    break
                token = suffix[token]
            else:
                raise ValueError(f"no path spells {word!r}")
            last.append(token)
            states.append(state[token])
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at -= size[last[at]]
        return path[::-1]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [self.encode(w.encode()) for w in words]


@lru_cache(4)
def automaton(path: str) -> Automaton:
    """The automaton of a tokenizer file; a special token's string is a word that only its own arc spells."""
    labels, merges, specials = vocabulary(path)
    made = Automaton(labels, merges)
    made.specials = {text.encode(): i for text, i in specials.items()}
    return made


class Labels:
    """The labels of all ids end to end, for emitting many at once."""

    def __init__(self, labels: list[bytes]):
        self.flat = np.frombuffer(b"".join(labels), np.uint8)
        self.size = np.array([len(x) for x in labels], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def emit(self, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, the cuts' places in them)."""
        size = self.size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(self.first[ids] - total[:-1], size) + np.arange(total[-1])], total[cuts]


@lru_cache(4)
def _labels(path: str) -> Labels:
    return Labels(vocabulary(path)[0])


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): no shuffle; memory follows the longest text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, cuts in encoded(batches, path, "automaton"):
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], ["id", "ids"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the labels of each row's ids; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = _labels(path).emit
        for batch in batches:
            texts = []
            for row in batch.column(1):
                ids = np.array(row.as_py() or [], np.int64)
                texts.append(emit(ids, np.array([0, len(ids)]))[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return kept.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, digests only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = _labels(path).emit
        for rows, ids, cuts in encoded(batches, path, "automaton"):
            stored = memoryview(ids.astype("<u4").view(np.uint8))
            body, places = emit(ids, cuts)
            emitted = memoryview(body)
            of_ids, of_text = [], []
            for a, b, p, q in zip((cuts[:-1] * 4).tolist(), (cuts[1:] * 4).tolist(), places[:-1].tolist(), places[1:].tolist(), strict=True):
                of_ids.append(hashlib.sha256(stored[a:b]).hexdigest())
                text = emitted[p:q]
                try:
                    str(text, "utf-8")
                except UnicodeDecodeError:
                    text = bytes(text).decode("utf-8", "replace").encode()
                of_text.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(cuts)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
