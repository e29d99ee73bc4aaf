"""Gradient boosting over histograms: features binned once, one aggregation a level, missing values with a side of their own.

1. Features become bins by quantiles, missing values bin 0; rows of one byte a
   feature are written to the shared folder.
2. A level of a tree is one pass: tasks add up gradients, curvatures and rows by
   (node, feature, bin), Spark adds these over tasks, and windows along the bins
   give the best cut of every node with missing values on either side.  Only a
   row a node reaches the driver.  Sums are of whole multiples of 1 / ``SCALE``,
   so cuts do not depend on the order of rows.
3. Held-out rows tell the loss after each tree, in the pass of the next one;
   learning stops when it has not fallen for ``patience`` trees.
4. Rows keep the score of the trees so far; it is written anew every ``KEEP``
   trees, so that a pass applies few trees and lineage stays short.

Edge cases: a feature without values is never cut; rows without a label are left
out; without rows of both labels there are no trees and every score is the share
of events (0 without rows).  Scoring takes tables with any further columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..sources.sinks import shared_dir

SCALE = 1 << 24
KEEP = 16


@dataclass
class Tree:
    """Nodes as lists; a node without a feature (-1) is a leaf.  Bins up to ``cut`` go left, missing ones where ``missing_left`` says."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, values: tuple[float, float]) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node], self.left[node] = feature, cut, missing_left, a
        for v in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.missing_left.append(False)
            self.left.append(-1)
            self.value.append(v)
        return a, a + 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, cut, missing, left = (np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left))
        at = np.zeros(len(bins), np.int64)
        while len(rows := np.flatnonzero(feature[at] >= 0)):
            node = at[rows]
            b = bins[rows, feature[node]]
            goes = np.where(b == 0, missing[node], b <= cut[node])
            at[rows] = left[node] + ~goes
        return at

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


@dataclass
class Boosted:
    """A fitted model; ``losses`` are those of held-out rows before the first tree and after each."""

    features: list[str]
    edges: list[list[float]]
    start: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bins of values, rows x features: 0 for missing ones, else 1 and how many edges lie below."""
        out = np.zeros(x.shape, np.uint8)
        for i, edges in enumerate(self.edges):
            there = ~np.isnan(x[:, i])
            out[there, i] = np.searchsorted(edges, x[there, i], "left") + 1
        return out

    def to_dict(self) -> dict:
        return {"features": self.features, "edges": self.edges, "start": self.start, "trees": [t.__dict__ for t in self.trees], "losses": self.losses}

    @classmethod
    def from_dict(cls, d: dict) -> Boosted:
        return cls(d["features"], d["edges"], d["start"], [Tree(**t) for t in d["trees"]], d["losses"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array<double> column of fixed length as rows x width, missing values as NaN."""
    import pyarrow.compute as pc

    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _packed(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of ``width`` bytes a row as rows x width."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), width) if len(column) else np.zeros((0, width), np.uint8)


def edges_of(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Upper ends of all bins of each feature but the last; at most ``bins`` - 1 numbers."""
    found = df.select(*features).approxQuantile(features, [i / bins for i in range(1, bins)], 1 / (4 * bins))
    return [sorted(set(q)) for q in found]


def best_cuts(histogram: DataFrame, l2: float, least: int) -> DataFrame:
    """(node, gain, feature, cut, missing_left, and left and right sums) of the best cut of each node that has one with a gain.

    histogram is (node, feature, bin, g, h, n) in whole numbers.  Of equal gains
    the least feature and bin, missing values right.
    """
    by = Window.partitionBy("node", "feature")
    along = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("bin") > 0
    sums = {}
    for c in "ghn":
        sums[f"{c}_all"] = F.sum(c).over(by)
        sums[f"{c}_none"] = F.sum(F.when(~present, F.col(c)).otherwise(0)).over(by)
        sums[f"{c}_up"] = F.sum(F.when(present, F.col(c)).otherwise(0)).over(along)
    cuts = histogram.withColumns({**sums, "last": F.max("bin").over(by)}).where(present)
    sides = cuts.select("*", F.explode(F.when(F.col("n_none") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("missing_left"))
    with_none = F.when(F.col("missing_left"), 1).otherwise(0)
    left = {f"{c}_left": F.col(f"{c}_up") + with_none * F.col(f"{c}_none") for c in "ghn"}
    both = sides.withColumns(left).withColumns({f"{c}_right": F.col(f"{c}_all") - F.col(f"{c}_left") for c in "ghn"})
    term = lambda s: F.pow(F.col(f"g_{s}") / SCALE, F.lit(2)) / (F.col(f"h_{s}") / SCALE + l2)
    gained = both.where((F.col("n_left") >= least) & (F.col("n_right") >= least)).withColumn("gain", term("left") + term("right") - term("all")).where("gain > 0")
    top = F.max_by(F.struct("gain", "feature", F.col("bin").alias("cut"), "missing_left", "g_left", "h_left", "g_right", "h_right"), F.struct("gain", -F.col("feature"), -F.col("bin"), ~F.col("missing_left")))
    return gained.groupBy("node").agg(top.alias("best")).select("node", "best.*")


def fit(df: DataFrame, features: list[str], label: str = "y", key: tuple[str, ...] = ("day", "cell"), rounds: int = 400, depth: int = 6, rate: float = 0.05, l2: float = 1.0, least: int = 20, bins: int = 255, validation: float = 0.1, patience: int = 10, tolerance: float = 1e-7) -> Boosted:
    """Boosted trees for a label of 0 and 1; rows are held out for the early stop by a hash of their key."""
    if not 2 <= bins <= 255:
        raise ValueError("a bin is one byte: 2 to 255 of them")
    spark = df.sparkSession
    width, home = len(features), f"{shared_dir(spark)}/gridweave/{spark.sparkContext.applicationId}/boosting-{uuid.uuid4().hex}"
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    held = F.pmod(F.xxhash64(*key), F.lit(1 << 20)) < int(validation * (1 << 20))
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), held.alias("held"), *[number(f).alias(f"f{i}") for i, f in enumerate(features)])
    names = [f"f{i}" for i in range(width)]
    train = rows.where("not held").agg(F.count("*").alias("n"), F.sum("y").alias("events")).first()
    share = (train.events or 0.0) / train.n if train.n else 0.0
    model = Boosted(list(features), [], float(np.log(share / (1 - share))) if 0 < share < 1 else (-np.inf if share == 0 else np.inf))
    if not 0 < share < 1:
        return model
    model.edges = edges_of(rows.where("not held"), names, bins)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = model.binned(_matrix(batch.column(2), width))
            body = pa.array([r.tobytes() for r in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), body, pa.array(np.full(len(packed), model.start))], ["y", "held", "bins", "score"])

    ddl = "y double, held boolean, bins binary, score double"
    rows.select("y", "held", F.array(*names).alias("x")).mapInArrow(to_bins, ddl).write.parquet(f"{home}/0")
    table, done, gone = spark.read.schema(ddl).parquet(f"{home}/0"), 0, None

    def histograms(tree: Tree, active: list[int]) -> DataFrame:
        """(node, feature, bin, g, h, n); with the root also the held-out loss and rows, as node -1."""
        newer, of = model.trees[done:], {node: i for i, node in enumerate(active)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((3, len(active), width, 256), np.int64)
            loss, n_held = 0.0, 0
            place = np.full(len(tree.feature), -1)
            for node, i in of.items():
                place[node] = i
            for batch in batches:
                y, out, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), _packed(batch.column(2), width)
                score = batch.column(3).to_numpy() + sum((t.scores(x) for t in newer), np.zeros(len(x)))
                loss += float((np.logaddexp(0, score[out]) - y[out] * score[out]).sum())
                n_held += int(out.sum())
                at = place[tree.nodes(x)]
                use = (at >= 0) & ~out
                p = 1 / (1 + np.exp(-score[use]))
                parts = [np.rint(v * SCALE) for v in (p - y[use], p * (1 - p))] + [np.ones(int(use.sum()))]
                for f in range(width):
                    index = at[use] * 256 + x[use, f]
                    for k, part in enumerate(parts):  # whole numbers below 2^53: sums of doubles are exact
                        total[k, :, f, :] += np.bincount(index, part, len(active) * 256).astype(np.int64).reshape(len(active), 256)
            i, f, b = np.nonzero(total[2])
            columns = [np.array(active)[i], f, b, *(total[k, i, f, b] for k in range(3))]
            if active == [0]:
                columns = [np.append(c, v) for c, v in zip(columns, (-1, -1, 0, int(np.rint(loss * SCALE)), 0, n_held), strict=True)]
            kinds = [pa.int32()] * 3 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["node", "feature", "bin", "g", "h", "n"])

        parts = table.mapInArrow(run, "node int, feature int, bin int, g long, h long, n long")
        return parts.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])

    def renewed() -> None:
        """The table with the scores of all trees so far."""
        nonlocal table, done, gone
        newer = model.trees[done:]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _packed(batch.column(2), width)
                score = batch.column(3).to_numpy() + sum((t.scores(x) for t in newer), np.zeros(len(x)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], ["y", "held", "bins", "score"])

        done = len(model.trees)
        table.mapInArrow(run, ddl).write.parquet(f"{home}/{done}")
        table = spark.read.schema(ddl).parquet(f"{home}/{done}")

    for _ in range(rounds):
        tree, active = Tree(), [0]
        for level in range(depth):
            found = histograms(tree, active)
            if level == 0:
                # The loss comes with the root's histogram; both are small and read twice, so they are kept while in use.
                found = found.persist()
                told = found.where("node = -1").first()
                model.losses.append(told.g / SCALE / told.n if told and told.n else 0.0)
            cuts = best_cuts(found.where("node >= 0"), l2, least).collect()  # a row a node at most
            if level == 0:
                found.unpersist()
                if told and told.n and len(model.losses) > patience and min(model.losses[-patience:]) > min(model.losses[:-patience]) - tolerance:
                    cuts = None
                    break
            active = []
            for r in sorted(cuts, key=lambda r: r.node):
                values = tuple(-rate * (g / SCALE) / (h / SCALE + l2) for g, h in ((r.g_left, r.h_left), (r.g_right, r.h_right)))
                active += tree.split(r.node, r.feature, r.cut, r.missing_left, values)
            if not active:
                break
        if cuts is None or len(tree.feature) == 1:
            break
        model.trees.append(tree)
        if len(model.trees) - done >= KEEP:
            renewed()
    if model.losses and len(model.losses) > 1:
        # Trees after the least held-out loss are left out.
        model.trees = model.trees[: int(np.argmin(model.losses))] if told and told.n else model.trees
    at = spark._jvm.org.apache.hadoop.fs.Path(home)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return model


def scored(model: Boosted, df: DataFrame, name: str = "p") -> DataFrame:
    """df with the probability of an event; a column of that name is replaced."""
    kept = [c for c in df.columns if c != name]
    number = [F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in model.features]
    width = len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model.trees:
                bins = model.binned(_matrix(batch.column(len(kept)), width))
                score = model.start + sum((t.scores(bins) for t in model.trees), np.zeros(len(bins)))
            else:
                score = np.full(batch.num_rows, model.start)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(1 / (1 + np.exp(-score)))], [*kept, name])

    asked = df.select(*kept, F.array(*number).alias("_x"))
    return asked.mapInArrow(run, StructType([*(asked.schema[c] for c in kept), StructField(name, DoubleType())]))
