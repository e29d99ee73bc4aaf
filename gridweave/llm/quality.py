"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words (all of them; an empty text
is one empty passage).  A passage is described by shares of character classes
and of their successions, word lengths, repetition within the passage and of
what the document said before, and encoded by a layer of its own.  Gated
attention (a tanh and a sigmoid branch) weighs the passages, and the weighted
sum of their encodings is scored.  Encoder, attention and scorer are learned
together from document labels alone, by Adam on the log loss.

Fitting uses at most ``SAMPLE`` labelled documents (chosen by hash) of at most
``LONGEST`` passages each; their passages' descriptions (284 bytes each) reach the
driver.  Scoring reads every whole text, without a shuffle.

Edge cases: null and empty texts get the score of one empty passage; without
labels of both kinds every score is the share of label 1 (0.5 without any).
Repeated rows stay; language, source and id are not read.  Extra columns pass
through, and score and predicted stand for any of their names.  Memory follows the
longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import labelled, replaced, slices, with_labels

SAMPLE = 4_000
LONGEST = 256
PASSAGE = 64
HIDDEN, GATE, EPOCHS, SEED = 24, 12, 250, 5
DECIDE = 0.3
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n", ".", ",;:", "!?", "|", "%$&*#@^~", "'\"`()[]{}<>", "_-+=/\\")
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _chars in enumerate(_CLASSES):
    _CLASS[list(_chars.encode())] = _i
_CLASS[128:] = len(_CLASSES) + 1
KINDS = len(_CLASSES) + 2


def passages(offsets: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(descriptions of all passages, how many each text has)."""
    n = len(offsets) - 1
    hashes, rows, starts = tv.words(body, offsets, lower=False)
    number = np.bincount(rows, minlength=n)
    first_word = np.cumsum(number) - number
    place = np.arange(len(rows)) - first_word[rows]
    count = np.maximum(1, -(-number // PASSAGE))
    first = np.cumsum(count) - count
    total = int(count.sum())
    of = first[rows] + place // PASSAGE
    begin = np.repeat(offsets[:-1], count)
    opening = (place % PASSAGE == 0) & (place > 0)
    begin[of[opening]] = starts[opening]
    owner = np.searchsorted(begin, np.arange(len(body)), "right") - 1
    kind = _CLASS[body]
    share = np.bincount(owner * KINDS + kind, minlength=total * KINDS).reshape(total, KINDS).astype(np.float64)
    size = np.maximum(1, share.sum(1, keepdims=True))
    # Successions of classes, folded to letters, capitals, digits, blanks, marks, signs and other bytes.
    fold = np.array([0, 1, 2, 3, 3, 4, 4, 4, 5, 5, 4, 4, 5, 6])[kind]
    follows = np.bincount(owner[1:] * 49 + fold[:-1] * 7 + fold[1:], minlength=total * 49).reshape(total, 49) if len(body) > 1 else np.zeros((total, 49))
    words = np.maximum(1, np.bincount(of, minlength=total)).astype(np.float64)
    long = np.diff(np.append(starts, len(body)))
    long = np.minimum(long, 40)
    mean = np.bincount(of, weights=long, minlength=total) / words
    wide = np.bincount(of, weights=long > 14, minlength=total) / words
    short = np.bincount(of, weights=long <= 3, minlength=total) / words

    def seen_before(keys: np.ndarray, whose: np.ndarray, passage: np.ndarray) -> np.ndarray:
        order = np.lexsort((np.arange(len(keys)), keys, whose))
        again = np.zeros(len(keys))
        again[order[1:]] = (keys[order[1:]] == keys[order[:-1]]) & (whose[order[1:]] == whose[order[:-1]])
        return np.bincount(passage, weights=again, minlength=total) / words

    repeated = seen_before(hashes, of, of)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    runs, run_rows = tv.shingles(hashes, rows, n, 4)
    run_of = first[run_rows] + (np.arange(len(run_rows)) - np.searchsorted(run_rows, run_rows)) // PASSAGE
    said = seen_before(runs, run_rows, run_of)
    lead = np.bincount(of, weights=np.isin(fold[starts], (1,)), minlength=total) / words
    extra = np.stack([mean / 10, wide, short, repeated, np.bincount(of, weights=same, minlength=total) / words, said, lead, np.log1p(words) / 4], 1)
    return np.hstack([share / size, follows / size, extra]).astype(np.float32), count


@dataclass
class Scorer:
    base: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def score(self, offsets: np.ndarray, body: np.ndarray) -> np.ndarray:
        x, count = passages(offsets, body)
        if self.weights is None:
            return np.full(len(count), self.base)
        return _forward(self.weights, (x - self.mean) / self.scale, np.cumsum(count) - count, count)["p"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (t * g) @ w["a"]
    bag = np.repeat(np.arange(len(count)), count)
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    alpha = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(alpha[:, None] * h, first)
    p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
    return {"h": h, "t": t, "g": g, "alpha": alpha, "z": z, "p": p, "bag": bag}


def fit(x: np.ndarray, count: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, decay: float = 1e-3) -> Scorer:
    """Encoder, gated attention and scorer by Adam over all bags; deterministic."""
    base = float(label.mean()) if len(label) else 0.5
    if not 0 < base < 1:
        return Scorer(base)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = np.clip((x - mean) / scale, -8, 8)
    first = np.cumsum(count) - count
    rng = np.random.default_rng(SEED)
    dims = x.shape[1]
    w = {"W": rng.normal(0, dims**-0.5, (dims, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.2, (HIDDEN, GATE)), "U": rng.normal(0, 0.2, (HIDDEN, GATE)), "a": rng.normal(0, 0.2, GATE), "c": rng.normal(0, 0.2, HIDDEN), "d": np.array(np.log(base / (1 - base)))}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, epochs + 1):
        f = _forward(w, x, first, count)
        gap = (f["p"] - label) / len(label)
        bag, h, t, g, alpha = f["bag"], f["h"], f["t"], f["g"], f["alpha"]
        dz = gap[:, None] * w["c"]
        pull = (h * dz[bag]).sum(1)
        de = alpha * (pull - np.add.reduceat(alpha * pull, first)[bag])
        dt, dg = de[:, None] * g * w["a"] * (1 - t * t), de[:, None] * t * w["a"] * g * (1 - g)
        dh = (alpha[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        slope = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ de, "c": f["z"].T @ gap, "d": gap.sum()}
        rate = 0.01 if step < epochs * 0.7 else 0.003
        for k, s in slope.items():
            s = s + decay * w[k] * (k not in "bd")
            m, v = moment[k]
            m, v = 0.9 * m + 0.1 * s, 0.999 * v + 0.001 * s * s
            moment[k] = m, v
            w[k] = (w[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Scorer(base, mean, scale, w)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Scorer:
    """A scorer from at most ``sample`` labelled documents, of those the ones of at most ``longest`` passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, offsets, body in slices(batches, "text"):
            x, count = passages(offsets, body)
            cut = np.cumsum(count) - count
            few = np.flatnonzero(count <= longest)
            bags = [x[cut[i] : cut[i] + count[i]].tobytes() for i in few.tolist()]
            at = pa.array(few)
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), pa.array(bags, pa.binary())], ["doc_id", "label", "x"])

    rows = with_labels(documents, labelled(labels, "quality", sample)).select("doc_id", "text", "label")
    got = sorted(rows.mapInArrow(run, "doc_id long, label int, x binary").collect(), key=lambda r: (r.doc_id, r.x))
    if not got:
        return Scorer(0.5)
    dims = passages(np.array([0, 0]), np.zeros(0, np.uint8))[0].shape[1]
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, dims) for r in got]
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([float(r.label > 0) for r in got]))


def predict(df: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """df without its text, with score and predicted."""
    places, schema = replaced(df, text_col, ("score", "double"), ("predicted", "int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, text_col):
            score = scorer.score(offsets, body).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in places), pa.array(score), pa.array((score >= DECIDE).astype(np.int32))], schema.names)

    return df.mapInArrow(run, schema)
