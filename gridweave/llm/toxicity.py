"""Toxicity by a classifier chain.

Terms are lower-case runs of letters and their first 4, 5 and 6 letters (so that
endings do not hide a stem).  Those that toxic documents of the labelled sample
have far more often than others become features, all of them, next to how many a
document has.  Categories are predicted one after the other by logistic
regressions over sparse features:

1. ``kind_1`` to ``kind_3``: the labelled toxic documents, parted into kinds by
   which terms they use together (spherical k-means); a document that is not
   labelled toxic is of no kind, whatever terms it uses.  The labels know one
   category only, so these are weak labels, but no input tells them by itself;
2. ``toxic``: the label itself.

A later model also reads the earlier categories' probabilities; it is fitted on
out-of-fold ones, which earlier models of the other folds give, so that it sees
them as they will be on new rows.  The last category decides.

Fitting uses at most ``SAMPLE`` labelled documents (chosen by hash); their terms
in use reach the driver.  Scoring reads every whole text, without a shuffle.

Edge cases: null and empty texts have no terms and score as such; without
labels of both kinds every probability is 0 and nothing is rejected.  Repeated
rows count as often as they come; extra columns pass through a filter unchanged,
whatever their names.  Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import labelled, slices, with_labels
from .langid import folded
from .tokens import _tables, code_points

SAMPLE = 20_000
SUPPORT = 4
APART = 5.5
FOLDS = 3
KINDS = 3
CATEGORIES = (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")
STEMS = (4, 5, 6)
DECIDE = 0.5


def terms(offsets: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, row) for all words and stems, and the words of each row."""
    at, cp, _ = code_points(offsets, body)
    n = len(at) - 1
    low = folded()[cp]
    solid = np.zeros(len(cp) + 2, bool)
    solid[1:-1] = low != 32
    first, last = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(cp))]
    first[cuts] |= solid[1:-1][cuts]
    last[cuts - 1] |= solid[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(at, starts, "right") - 1
    number = np.bincount(rows, minlength=n)
    long = ends - starts >= 3
    starts, ends, rows = starts[long], ends[long], rows[long]
    found, of = [], []
    for size in (0, *STEMS):
        keep = ends - starts > size
        s = starts[keep]
        hashes = tv.segment_hashes(low, s, s + size if size else ends[keep], _tables()[1])
        found.append(hashes ^ tv.mix(np.uint64([size + 1]))[0])
        of.append(rows[keep])
    return np.concatenate(found), np.concatenate(of), number


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, clean, toxic): labelled documents with each term, from (doc_id, text, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            keys, clean, toxic = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(np.add.reduceat(clean[order], first)), pa.array(np.add.reduceat(toxic[order], first))], ["term", "clean", "toxic"])

        for part, offsets, body in slices(batches, "text"):
            label = part.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            keys, of, _ = terms(offsets, body)
            if not len(keys):
                continue
            order = np.lexsort((of, keys))
            keys, of = keys[order], of[order]
            once = np.append(True, (keys[1:] != keys[:-1]) | (of[1:] != of[:-1]))
            keys, bad = keys[once], label[of[once]] > 0
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            held.append((keys[first], np.add.reduceat((~bad).astype(np.int64), first), np.add.reduceat(bad.astype(np.int64), first)))
            if sum(len(k) for k, _, _ in held) > 1_500_000:
                yield sent()
        if held:
            yield sent()

    return rows.select("doc_id", "text", "label").mapInArrow(run, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


@dataclass
class Rows:
    """Sparse 0/1 features (row and column of each entry) next to dense ones and an intercept."""

    row: np.ndarray
    column: np.ndarray
    columns: int
    dense: np.ndarray

    def with_dense(self, more: np.ndarray) -> Rows:
        return Rows(self.row, self.column, self.columns, np.hstack([self.dense, more]))

    @property
    def width(self) -> int:
        return self.columns + self.dense.shape[1] + 1

    def times(self, w: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, weights=w[self.column], minlength=len(self.dense))
        return sparse + self.dense @ w[self.columns : -1] + w[-1]

    def turned(self, r: np.ndarray) -> np.ndarray:
        """The transpose times r."""
        return np.concatenate([np.bincount(self.column, weights=r[self.row], minlength=self.columns), self.dense.T @ r, [r.sum()]])


def logistic(x: Rows, y: np.ndarray, use: np.ndarray | None = None, ridge: float = 0.1, steps: int = 15, inner: int = 20) -> np.ndarray:
    """Weights, the intercept last, by damped Newton steps whose systems conjugate gradients solve; ``use`` marks the rows to fit."""
    use = np.ones(len(y)) if use is None else use.astype(float)
    w = np.zeros(x.width)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = probability(x, w)
        slope = x.turned(use * (p - y)) + penalty * w
        curve = use * (p * (1 - p) + 1e-6)
        step, left = np.zeros_like(w), slope.copy()
        way, size = left.copy(), left @ left
        goal = 1e-4 * size
        for _ in range(inner):
            if size <= goal:
                break
            bent = x.turned(curve * x.times(way)) + penalty * way
            far = size / (way @ bent)
            step += far * way
            left -= far * bent
            size, before = left @ left, size
            way = left + size / before * way
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-3:
            break
    return w


def probability(x: Rows, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.times(w), -30, 30)))


@dataclass
class Chain:
    """Logistic regressions in a row; each reads the features and all earlier probabilities."""

    models: list[np.ndarray]

    @classmethod
    def fit(cls, x: Rows, y: np.ndarray, fold: np.ndarray, folds: int = FOLDS) -> Chain:
        models = []
        for c in range(y.shape[1]):
            outside = np.zeros(len(y))
            for k in range(folds):
                test = fold == k
                if test.any() and (~test).any():
                    outside[test] = probability(x, logistic(x, y[:, c], ~test))[test]
            models.append(logistic(x, y[:, c]))
            x = x.with_dense(outside[:, None])
        return cls(models)

    def predict(self, x: Rows) -> np.ndarray:
        for w in self.models:
            x = x.with_dense(probability(x, w)[:, None])
        return x.dense[:, -len(self.models) :]


def kinds(x: Rows, rows: np.ndarray, n: int = KINDS, rounds: int = 20) -> np.ndarray:
    """The kind (0 to n - 1) of each of the given rows by spherical k-means on their sparse features; -1 for other rows and for those without any.

    Starts are the row with most features and then the rows least like the starts so far.
    """
    out = np.full(len(x.dense), -1)
    inside = np.isin(x.row, rows)
    row, column = x.row[inside], x.column[inside]
    if not len(row):
        return out
    number = np.bincount(row, minlength=len(out))
    length = 1 / np.sqrt(np.maximum(number, 1))
    some = np.flatnonzero(number)

    def likeness(centre: np.ndarray) -> np.ndarray:
        return (np.bincount(row, weights=centre[column], minlength=len(out)) * length)[some]

    def own(r: int) -> np.ndarray:
        return np.bincount(column[row == r], minlength=x.columns) * length[r]

    centres = [own(some[number[some].argmax()])]
    while len(centres) < n:
        centres.append(own(some[np.max([likeness(c) for c in centres], 0).argmin()]))
    kind = np.zeros(len(some), int)
    for _ in range(rounds):
        new = np.argmax([likeness(c) for c in centres], 0)
        if (new == kind).all() and _:
            break
        kind = new
        out[some] = kind
        for k in range(n):
            total = np.bincount(column, weights=(out[row] == k) * length[row], minlength=x.columns)
            if total.any():
                centres[k] = total / np.sqrt((total * total).sum())
    out[some] = kind
    return out


@dataclass
class Detector:
    known: np.ndarray  # terms, sorted
    chain: Chain | None

    def features(self, offsets: np.ndarray, body: np.ndarray) -> Rows:
        n, k = len(offsets) - 1, len(self.known)
        keys, of, _ = terms(offsets, body)
        at = np.minimum(np.searchsorted(self.known, keys), max(0, k - 1))
        hit = self.known[at] == keys if k else np.zeros(len(keys), bool)
        total = np.bincount(of[hit], minlength=n)
        cell = np.unique(of[hit] * max(1, k) + at[hit])
        row, column = np.divmod(cell, max(1, k))
        return Rows(row, column, k, amounts(np.bincount(row, minlength=n), total))

    def score(self, offsets: np.ndarray, body: np.ndarray) -> np.ndarray:
        """Probabilities of the categories, one row each."""
        n = len(offsets) - 1
        return self.chain.predict(self.features(offsets, body)) if self.chain else np.zeros((n, len(CATEGORIES)))


def amounts(different: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Dense features: how many terms a document uses, different ones and in all."""
    return np.stack([np.log1p(different), np.log1p(total), (total > 0).astype(float)], 1)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, support: int = SUPPORT) -> Detector:
    """A detector from at most ``sample`` labelled documents; their term counts are made on the executors.

    Terms of at least ``support`` toxic documents that stand out, and which of
    them each document uses, reach the driver.
    """
    chosen = labelled(labels, "toxic", sample)
    rows = with_labels(documents, chosen)
    size = {bool(r.label): r["count"] for r in chosen.withColumn("label", F.col("label") > 0).groupBy("label").count().collect()}
    clean, toxic = size.get(False, 0), size.get(True, 0)
    if not clean or not toxic:
        return Detector(np.zeros(0, np.uint64), None)
    rate = (F.col("toxic") + F.col("clean")) / (clean + toxic)
    apart = (F.col("toxic") / toxic - F.col("clean") / clean) / F.sqrt(rate * (1 - rate) * (1 / clean + 1 / toxic) + 1e-12)
    best = term_counts(rows).where(F.col("toxic") >= support).where(apart > APART).select("term").collect()
    detector = Detector(np.sort(np.array([r.term for r in best], np.int64).view(np.uint64)), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, offsets, body in slices(batches, "text"):
            x = detector.features(offsets, body)
            cut = np.searchsorted(x.row, np.arange(len(part) + 1))
            used = [x.column[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(used, pa.list_(pa.int32())), pa.array(np.rint(np.expm1(x.dense[:, 1])).astype(np.int64))], ["doc_id", "label", "used", "total"])

    got = sorted(rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, used array<int>, total long").collect(), key=lambda r: (r.doc_id, r.used, r.total))
    if not got:
        return detector
    number = np.array([len(r.used) for r in got])
    column = np.array([c for r in got for c in r.used], np.int64)
    x = Rows(np.repeat(np.arange(len(got)), number), column, len(detector.known), amounts(number, np.array([r.total for r in got])))
    label = np.array([r.label > 0 for r in got])
    kind = kinds(x, np.flatnonzero(label))
    y = np.stack([*(kind == k for k in range(KINDS)), label], 1).astype(np.float64)
    fold = (tv.mix(np.array([r.doc_id for r in got], np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(int)
    detector.chain = Chain.fit(x, y, fold)
    return detector


def predict(df: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a probability p_* of each category, toxic boolean)."""
    names = [f"p_{c}" for c in CATEGORIES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, "text"):
            p = detector.score(offsets, body)
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(p[:, c]) for c in range(p.shape[1])), pa.array(p[:, -1] >= DECIDE)], ["id", *names, "toxic"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, f"id long, {', '.join(f'{n} double' for n in names)}, toxic boolean").withColumnRenamed("id", id_col)


def without_toxic(df: DataFrame, detector: Detector, text_col: str = "text") -> DataFrame:
    """df's rows that are not toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, text_col):
            yield rows.filter(pa.array(detector.score(offsets, body)[:, -1] < DECIDE))

    return df.mapInArrow(run, df.schema)
