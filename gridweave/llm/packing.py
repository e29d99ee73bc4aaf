"""Best-fit packing of token sequences, improved by swap-based local search.

Only how many pieces have each length matters for a packing, and there are at
most ``capacity`` lengths.  So executors tokenise and count lengths, the driver
packs the counts, and executors look up each piece's place by its length and its
rank among pieces of that length.  The driver's work depends on the capacity and
not on the number of documents.

The driver packs by best fit, longest first, over classes of bins with equal
contents.  Then local search works on underfull bins: it drains the emptiest
class by one-for-one exchanges, two-for-one exchanges (either way) and moves
into other bins, each of which must raise the sum of squared fills, until the
lower bound ceil(tokens / capacity) is met or no exchange improves.  Candidates
come from an index over free room, so neither pieces of a bin nor bins are cut
off.  Full bins take no part: nothing fits in, and giving up pieces would lower
the sum.

Edge cases: a null text is an empty document (its closing id alone); repeated
rows are packed each by itself; rows of a null id are packed too; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written
from .tokens import encoded

CAPACITY = 2048
CLOSING = 0
Pattern = tuple[int, ...]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents longer than the capacity are cut, the first piece may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, cuts in encoded(batches, path):
            names = rows.column(0)
            count = np.diff(cuts) + 1
            closed = np.full(len(ids) + len(count), closing, "<u4")
            closed[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count - 1)] = ids
            data = memoryview(closed.view(np.uint8))
            of, number, start, length, crc = [], [], [], [], []
            base = 0
            for row, size in enumerate(count.tolist()):
                a, k = 0, 0
                while a < size:
                    b = min(size, a + ((size - 1) % capacity + 1 if not a else capacity))
                    of.append(row)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * (base + a) : 4 * (base + b)]))
                    a, k = b, k + 1
                base += size
            yield pa.RecordBatch.from_arrays([names.take(pa.array(of, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kept = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> dict[Pattern, int]:
    """Bins by contents (lengths, longest first) from pieces by length."""
    room: dict[int, dict[Pattern, int]] = defaultdict(dict)
    open_rooms: list[int] = []

    def put(left: int, pattern: Pattern, n: int) -> None:
        if not room[left]:
            insort(open_rooms, left)
        room[left][pattern] = room[left].get(pattern, 0) + n

    for size in sorted(counts, reverse=True):
        todo = counts[size]
        while todo:
            place = next((r for r in open_rooms if r >= size), None)
            if place is None:
                each = capacity // size
                if todo >= each:
                    put(capacity - each * size, (size,) * each, todo // each)
                if todo % each:
                    put(capacity - todo % each * size, (size,) * (todo % each), 1)
                break
            pattern, n = next(iter(room[place].items()))
            # A bin takes as many as fit at once; its room only shrinks, so it stays the tightest.
            each = min(place // size, todo)
            used = min(n, todo // each)
            if used == n:
                del room[place][pattern]
                if not room[place]:
                    open_rooms.remove(place)
            else:
                room[place][pattern] = n - used
            put(place - each * size, pattern + (size,) * each, used)
            todo -= used * each
    out: dict[Pattern, int] = {}
    for found in room.values():
        for pattern, n in found.items():
            key = tuple(sorted(pattern, reverse=True))
            out[key] = out.get(key, 0) + n
    return out


class Search:
    """Underfull bins by contents, with an index of what each could take.

    An entry says that some class with so much room holds a piece (or two pieces)
    of so much in all, or that any class has so much room; it is numbered when it
    comes up and anew when a second class holds it (until then it is none for its
    own holder).  A class that found no exchange is only tried against entries that
    are newer, and against all once it has a second bin, which the first can use.
    """

    def __init__(self, bins: dict[Pattern, int], capacity: int):
        self.capacity = capacity
        self.full = {p: n for p, n in bins.items() if sum(p) == capacity}
        self.open: dict[Pattern, int] = {}
        self.holders: dict[tuple[int, int, int], dict[Pattern, None]] = {}
        self.number: dict[tuple[int, int, int], int] = {}
        self.keys: list[tuple[int, int, int]] = []
        self.table = np.zeros((3, 1024), np.int64)  # pieces taken back, their length, room
        self.live = np.zeros(1024, bool)
        self.tried: dict[Pattern, int] = {}
        for p, n in bins.items():
            if sum(p) < capacity:
                self.add(p, n)

    def entries(self, pattern: Pattern) -> list[tuple[int, int, int]]:
        room = self.capacity - sum(pattern)
        pairs = {a + b for i, a in enumerate(pattern) for b in pattern[i + 1 :]}
        return [(0, 0, room), *((1, b, room) for b in set(pattern)), *((2, b, room) for b in pairs)]

    def add(self, pattern: Pattern, n: int) -> None:
        if not pattern:
            return
        if sum(pattern) == self.capacity:
            self.full[pattern] = self.full.get(pattern, 0) + n
            return
        if pattern in self.open:
            if self.open[pattern] == 1:  # from now on it is a target of its own
                self.tried.pop(pattern, None)
            self.open[pattern] += n
            return
        self.open[pattern] = n
        for key in self.entries(pattern):
            held = self.holders.setdefault(key, {})
            if len(held) < 2:  # a second holder is a target for the first one
                if held:
                    self.live[self.number[key]] = False
                k = self.number[key] = len(self.keys)
                if k == len(self.live):
                    self.table = np.hstack([self.table, np.zeros_like(self.table)])
                    self.live = np.append(self.live, np.zeros_like(self.live))
                self.keys.append(key)
                self.table[:, k], self.live[k] = key, True
            held[pattern] = None

    def take(self, pattern: Pattern, n: int) -> None:
        self.open[pattern] -= n
        if self.open[pattern]:
            return
        del self.open[pattern]
        self.tried.pop(pattern, None)
        for key in self.entries(pattern):
            del self.holders[key][pattern]
            if not self.holders[key]:
                self.live[self.number[key]] = False

    def best(self, source: Pattern) -> tuple[tuple[int, ...], tuple[int, ...], Pattern] | None:
        """(given, taken back, target) of the exchange that leaves its target least room.

        One or two pieces are given for none or one, or one for two.  The sum of
        squared fills grows if the target ends with less room than the source had.
        """
        since, self.tried[source] = self.tried.get(source, 0), len(self.keys)
        at = since + np.flatnonzero(self.live[since : len(self.keys)])
        if not len(at):
            return None
        room = self.capacity - sum(source)
        ones = sorted(set(source))
        twos = sorted({a + b for i, a in enumerate(source) for b in source[i + 1 :]})
        kind, back, free = self.table[:, at]
        options = []
        for given, allowed in ((ones, kind <= 2), (twos, kind <= 1)):
            if not given:
                continue
            sizes = np.array([0, *given])
            k = np.searchsorted(sizes, back + free, "right") - 1
            left = np.where(allowed & (sizes[k] > back), back + free - sizes[k], room)
            # A class of one bin is no target of its own.
            for i in np.argsort(left, kind="stable").tolist():
                if left[i] >= room:
                    break
                target = next((p for p in self.holders[self.keys[at[i]]] if p != source or self.open[p] > 1), None)
                if target is not None:
                    options.append((int(left[i]), int(sizes[k[i]]), int(kind[i]), int(back[i]), target, given is twos))
                    break
        if not options:
            return None
        _, size, kind_, less, target, two = min(options, key=lambda o: (o[0], o[5], o[2]))
        self.tried[source] = since
        return (pair(source, size) if two else (size,)), ((), (less,), pair(target, less) if kind_ == 2 else ())[kind_], target


def pair(pattern: Pattern, total: int) -> tuple[int, int]:
    """Two pieces of a bin with that total."""
    seen: set[int] = set()
    for a in pattern:
        if total - a in seen:
            return a, total - a
        seen.add(a)
    raise ValueError("no such pair")


def exchanged(pattern: Pattern, out: tuple[int, ...], into: tuple[int, ...]) -> Pattern:
    left = list(pattern)
    for a in out:
        left.remove(a)
    return tuple(sorted([*left, *into], reverse=True))


def improve(bins: dict[Pattern, int], capacity: int = CAPACITY) -> dict[Pattern, int]:
    """Local search over underfull bins until the bound is met or no exchange raises the sum of squared fills; never more bins than before.

    Sources are taken from the emptiest on and drained; an exchange is made by as
    many bins of the two classes at once as there are.
    """
    need = -(-sum(sum(p) * n for p, n in bins.items()) // capacity)
    number = sum(bins.values())
    search = Search(bins, capacity)
    todo = [(sum(p), p) for p in search.open]
    heapify(todo)
    while number > need:
        if not todo:
            # Classes that newer entries may give an exchange to.
            todo = [(sum(p), p) for p in search.open if search.tried.get(p, 0) < len(search.keys)]
            if not todo:
                break
            heapify(todo)
        source = heappop(todo)[1]
        while source in search.open and number > need:
            found = search.best(source)
            if not found:
                break
            given, back, target = found
            n = search.open[source] // 2 if target == source else min(search.open[source], search.open[target])
            rest, fuller = exchanged(source, given, back), exchanged(target, back, given)
            if not rest:
                n = min(n, number - need)
                number -= n
            search.take(source, n)
            search.take(target, n)
            search.add(fuller, n)
            search.add(rest, n)
            source = rest if rest else source
    out = dict(search.full)
    for p, n in search.open.items():
        out[p] = out.get(p, 0) + n
    return out


def places(bins: dict[Pattern, int]) -> dict[str, np.ndarray]:
    """For every length, ranges of ranks and where they go: sorted by length and first rank."""
    rows = []
    rank: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, n in sorted(bins.items(), reverse=True):
        offset = 0
        for size in sorted(set(pattern), reverse=True):
            each = pattern.count(size)
            rows.append((size, rank[size], each, sequence, offset))
            rank[size] += each * n
            offset += each * size
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {"key": table[:, 0] << 48 | table[:, 1], "first": table[:, 1], "each": table[:, 2], "sequence": table[:, 3], "offset": table[:, 4]}


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset); tokenises once, shuffles no tokens."""
    cut, _ = written(pieces(df, path, capacity, closing, id_col, text_col), "pieces")
    counts = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}
    where = places(improve(best_fit(counts, capacity), capacity))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(1, partitions(df.sparkSession)))).cast("int"))
    by_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    base = by_salt.select("length", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("inside", inside).join(base, ["length", "salt"])
    kept = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("inside") - 1).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(where["key"], length << 48 | rank, "right") - 1
            over = rank - where["first"][at]
            sequence = where["sequence"][at] + over // where["each"][at]
            offset = where["offset"][at] + over % where["each"][at] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = kept.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", id_col)
