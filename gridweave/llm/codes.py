"""Compression of vectors to short codes: a product code whose codebooks come from filtering Lloyd rounds.

A component x becomes floor(1024 * x); a vector is cut into ``PARTS`` equal
consecutive parts, each with a codebook of at most ``ENTRIES`` entries.

1. Rows are dealt into blocks of at most ``ROWS``.  Every block builds one
   kd-tree for each part position (cuts at the median of the widest side, equal values together; leaves of at
   most ``LEAF`` parts or of equal ones) with the count, sum and bounding box of
   every node.  Trees are built once and written to the shared folder.
2. A round walks each tree from the root with the entries that may still be
   nearest somewhere in the box.  An entry goes if another one is nearer to the
   whole box (compared at the corner that favours it most; equal distances leave
   the lower index).  If one entry is left, the whole subtree is assigned at
   once by its cached sum and count; leaves compare what is left.
3. Counts and sums by part and entry are added by Spark; the new codebook, of
   bounded size, goes back with the next round's tasks.
4. A last walk keeps the entry of every row.

All arithmetic is in whole numbers, so the order of additions has no effect.
Memory of a task: some blocks of ``ROWS`` rows and their trees.

Edge cases: rows that take part are those of ``vectors``; with fewer than
``ENTRIES`` of them the codebooks are as short; a width that is no multiple of
``PARTS`` is filled up with zeros; components beyond the bound that keeps sums of
squares exact stand at it (2^27 for parts of 16).  Repeated rows count as often
as they come; rows of a null id are coded and come last in the order of ids;
rows of one id are ordered by their vectors.  A table without usable rows gives
an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors
from .common import few, removed, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
ROWS, LEAF = 8192, 16

#: What a tree is stored as, in order: name and type of its arrays.
STORED = (("points", np.int32), ("order", np.int32), ("low", np.int32), ("high", np.int32), ("total", np.int64), ("first", np.int32), ("last", np.int32), ("left", np.int32))


class Tree:
    """A kd-tree over points (n x d whole numbers), as arrays by node; a node holds points[first:last] of its own order."""

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def built(cls, points: np.ndarray) -> Tree:
        n = len(points)
        order = np.arange(n)
        first, last, left, low, high, total = [0], [n], [-1], [], [], []
        node = 0
        while node < len(first):  # children are appended in pairs
            a, b = first[node], last[node]
            held = points[order[a:b]]
            lo, hi = held.min(0), held.max(0)
            low.append(lo)
            high.append(hi)
            total.append(held.sum(0))
            wide = int((hi - lo).argmax())
            if b - a > LEAF and hi[wide] > lo[wide]:
                side = held[:, wide]
                middle = np.partition(side, len(side) // 2)[len(side) // 2]
                under = side < middle if lo[wide] < middle else side <= middle  # equal ones stay together
                order[a:b] = np.concatenate([order[a:b][under], order[a:b][~under]])
                at = a + int(under.sum())
                left[node] = len(first)
                first += [a, at]
                last += [at, b]
                left += [-1, -1]
            node += 1
        return cls(points=points[order], order=order, low=np.array(low), high=np.array(high), total=np.array(total), first=np.array(first), last=np.array(last), left=np.array(left))

    def stored(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in STORED]

    @classmethod
    def read(cls, bodies: list[pa.Scalar], d: int) -> Tree:
        arrays = {name: np.frombuffer(body.as_buffer(), kind) for (name, kind), body in zip(STORED, bodies, strict=True)}
        for name in ("points", "low", "high", "total"):
            arrays[name] = arrays[name].reshape(-1, d).astype(np.int64)
        return cls(**arrays)

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(entry of each point in the tree's order, counts and sums by entry, points assigned by whole subtrees)."""
        k, d = entries.shape
        most = max(int(np.abs(entries).max()), int(np.abs(self.low).max()), int(np.abs(self.high).max()))
        # Doubles hold these sums exactly while they stay below 2^53, and multiply faster.
        kind = np.float64 if 16 * d * most * most < 1 << 53 else np.int64
        z, middle, side, points = (x.astype(kind) for x in (entries, self.low + self.high, self.high - self.low, self.points))
        norm = (z * z).sum(1)
        chosen = np.zeros(len(points), np.int64)
        single = np.zeros(len(points), bool)  # assigned one by one
        counts, sums = np.zeros(k, np.int64), np.zeros_like(entries)
        todo = [(0, np.arange(k))]
        while todo:
            node, some = todo.pop()
            a, b = self.first[node], self.last[node]
            if len(some) > 1:
                # The entry nearest to the middle of the box, and what it is never farther than: 2 max(lo t, hi t) = (lo + hi) t + (hi - lo) |t|.
                held = z[some]
                star = int((norm[some] - held @ middle[node]).argmin())
                towards = held - held[star]
                ahead = norm[some] - norm[some[star]] - towards @ middle[node] - np.abs(towards) @ side[node]
                some = some[(ahead < 0) | ((ahead == 0) & (some <= some[star]))]
            if len(some) == 1:  # the whole subtree is its
                one = some[0]
                chosen[a:b] = one
                counts[one] += b - a
                sums[one] += self.total[node]
            elif self.left[node] < 0:
                chosen[a:b] = some[(norm[some] - 2 * (points[a:b] @ z[some].T)).argmin(1)]
                single[a:b] = True
            else:
                todo += [(self.left[node], some), (self.left[node] + 1, some)]
        by = np.argsort(chosen[single], kind="stable")
        some, first = np.unique(chosen[single][by], return_index=True)
        if len(some):
            counts[some] += np.diff(np.append(first, len(by)))
            sums[some] += np.add.reduceat(self.points[single][by], first, 0)
        return chosen, counts, sums, len(single) - int(single.sum())


def bound(d: int) -> int:
    """The greatest magnitude at which sums of d squares of differences stay exact."""
    return isqrt((1 << 58) // d)


def parts_of(cells: np.ndarray, parts: int, d: int) -> np.ndarray:
    """Whole numbers, rows x parts x d; short widths are filled with zeros."""
    x = vectors.scaled(cells, bound(d))
    if x.shape[1] < parts * d:
        x = np.concatenate([x, np.zeros((len(x), parts * d - x.shape[1]), np.int64)], 1)
    return x.reshape(len(x), parts, d)


def forest(df: DataFrame, id_col: str, vector_col: str, label_col: str, size: int, parts: int) -> DataFrame:
    """(ids, labels, trees): a row for each block of rows."""
    d = -(-size // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                at, cells = vectors.matrix(part.column(2), size)
                if len(at):
                    x = parts_of(cells, parts, d)
                    bodies = [body for p in range(parts) for body in Tree.built(x[:, p]).stored()]
                    ids, labels = (part.column(c).take(pa.array(at)).to_pylist() for c in (0, 1))
                    yield pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([bodies], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    return kept.mapInArrow(run, "ids array<long>, labels array<string>, trees array<binary>")


def first_entries(df: DataFrame, id_col: str, vector_col: str, size: int, parts: int, entries: int) -> np.ndarray:
    """The codebooks at the start, parts x entries x d: the vectors of the least ids, ascending."""
    d = -(-size // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cells = vectors.matrix(batch.column(1), size)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), size).cast(pa.list_(pa.float64()))], ["id", "vector"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).mapInArrow(run, "id long, vector array<double>")
    rows = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()  # at most ``entries`` rows
    return parts_of(np.array([r.vector for r in rows], np.float64).reshape(len(rows), size), parts, d).transpose(1, 0, 2).copy()


def trees_of(trees: pa.Array, row: int, parts: int, d: int) -> Iterator[Tree]:
    bodies = trees[row].values
    for p in range(parts):
        yield Tree.read([bodies[p * len(STORED) + i] for i in range(len(STORED))], d)


def lloyd(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after some rounds over the written trees."""
    parts, k, d = books.shape
    ddl = "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(d))

    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, d), np.int64)
            for batch in batches:
                for row in range(batch.num_rows):
                    for p, tree in enumerate(trees_of(batch.column(0), row, parts, d)):
                        _, n, s, _ = tree.nearest(books[p])
                        counts[p] += n
                        sums[p] += s
            part, entry = np.nonzero(counts)
            columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), *(pa.array(sums[part, entry, i]) for i in range(d))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *(f"s{i}" for i in range(d))])

        found = blocks.select("trees").mapInArrow(run, ddl).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(d)])
        new = books.copy()
        for r in found.collect():  # parts x entries rows
            new[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(d)]
        books = new
    return books


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code binary, error): the entries of every row, one byte a part, and the squared distance over all parts."""
    parts, _, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                code, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(trees_of(batch.column(2), row, parts, d)):
                    chosen, _, _, _ = tree.nearest(books[p])
                    code[tree.order, p] = chosen
                    error[tree.order] += ((tree.points - books[p][chosen]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([ids, batch.column(1)[row].values, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)], ["id", "label", "code", "error"])

    return blocks.mapInArrow(run, "id long, label string, code binary, error long")


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' decimal components, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error), codebooks): entries are at most 256, so that an index is one byte."""
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = df.sparkSession
    size = vectors.width(df, vector_col)
    if size is None:
        return spark.createDataFrame([], "id long, label string, code binary, error long"), np.zeros((parts, 0, 0), np.int64)
    books = first_entries(df, id_col, vector_col, size, parts, entries)
    blocks, path = written(forest(df, id_col, vector_col, label_col, size, parts), "trees")
    books = lloyd(blocks, books, rounds)
    rows, _ = written(coded(blocks, books), "codes")
    removed(spark, path)
    return rows, books


def digests(rows: DataFrame, books: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """(id, code hex, error, label_error, codebooks_sha256); errors are added by label before the shuffle."""
    by_label = few(rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def decoded(codes: DataFrame, books: np.ndarray, width: int | None = None) -> DataFrame:
    """codes with ``vector array<double>``: the entries that each code stands for."""
    parts, _, d = books.shape
    wide = width or parts * d
    spark: SparkSession = codes.sparkSession
    table = [(p, e, [float(x) / 1024 for x in entry]) for p, book in enumerate(books) for e, entry in enumerate(book.tolist())]
    entries = F.broadcast(spark.createDataFrame(table, "part int, entry int, cells array<double>"))  # parts x 256 rows
    out = codes
    for p in range(parts):
        mine = entries.where(F.col("part") == p).select(F.col("entry").alias(f"_e{p}"), F.col("cells").alias(f"_c{p}"))
        out = out.join(mine, F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int") == F.col(f"_e{p}"), "left").drop(f"_e{p}")
    return out.withColumn("vector", F.slice(F.concat(*[F.col(f"_c{p}") for p in range(parts)]), 1, wide)).drop(*[f"_c{p}" for p in range(parts)])
