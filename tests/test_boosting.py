"""Histogram boosting against a plain loop over the same bins, and what it is for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.operators import metrics, sampling
from gridweave.plans import boosting, model
from gridweave.queries.scoring import _X, _learning

FEATURES = ["a", "b", "c"]


def rows_of(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:, 1] = rng.integers(0, 5, n)
    gone = rng.random(n) < 0.3
    y = (x[:, 0] + 2 * gone + 0.3 * rng.normal(size=n) > 0.7).astype(int)
    x[gone, 2] = np.nan
    return [(i, *[None if np.isnan(v) else float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]


def data(spark, rows):
    return spark.createDataFrame(rows, "cell int, a double, b double, c double, y int").withColumn("day", F.lit(1))


def plain_fit(bins, y, start, rounds, depth, rate, l2, least):
    """The same trees, node by node, feature by feature, bin by bin."""
    s, trees = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-s))
        g, h = np.rint((p - y) * boosting.SCALE), np.rint(p * (1 - p) * boosting.SCALE)
        tree, todo = boosting.Tree(), {0: np.arange(len(y))}
        for _ in range(depth):
            below = {}
            for node, at in sorted(todo.items()):
                best = None
                for f in range(bins.shape[1]):
                    b = bins[at, f]
                    for cut in sorted(set(b[b > 0].tolist())):
                        for missing_left in (False, True) if (b == 0).any() else (False,):
                            left = (b > 0) & (b <= cut) | (b == 0) & missing_left
                            if min(left.sum(), (~left).sum()) < least:
                                continue
                            term = lambda m: (g[at][m].sum() / boosting.SCALE) ** 2 / (h[at][m].sum() / boosting.SCALE + l2)  # noqa: B023, E731
                            gain = term(left) + term(~left) - term(left | ~left)
                            if gain > 0 and (best is None or gain > best[0]):
                                best = (gain, f, cut, missing_left, left)
                if best:
                    _, f, cut, missing_left, left = best
                    value = lambda m: -rate * (g[at][m].sum() / boosting.SCALE) / (h[at][m].sum() / boosting.SCALE + l2)  # noqa: B023, E731
                    one, two = tree.split(node, f, cut, missing_left, (value(left), value(~left)))
                    below[one], below[two] = at[left], at[~left]
            todo = below
        trees.append(tree)
        s = s + tree.scores(bins)
    return trees


def test_trees_equal_a_plain_loop(spark):
    rows = rows_of()
    settings = {"rounds": 3, "depth": 3, "rate": 0.3, "l2": 1.0, "least": 20}
    fitted = boosting.fit(data(spark, rows), FEATURES, bins=12, validation=0.0, **settings)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    want = plain_fit(fitted.binned(x), np.array([r[4] for r in rows]), fitted.start, **settings)
    assert len(fitted.trees) == 3 and any(any(t.missing_left) or 2 in t.feature for t in fitted.trees)
    for mine, plain in zip(fitted.trees, want, strict=True):
        assert (mine.feature, mine.cut, mine.missing_left, mine.left) == (plain.feature, plain.cut, plain.missing_left, plain.left)
        assert mine.value == pytest.approx(plain.value)
    back = boosting.Boosted.from_dict(fitted.to_dict())
    a, b = (sorted((r.cell, r.p) for r in boosting.scored(m, data(spark, rows)).collect()) for m in (fitted, back))
    assert a == b and all(0 < p < 1 for _, p in a)


def test_early_stop_and_renewed_scores(spark, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)
    noise = [(i, a, b, c, int(hash((i, 7)) % 2)) for i, a, b, c, _ in rows_of(600)]
    fitted = boosting.fit(data(spark, noise), FEATURES, rounds=12, depth=2, rate=0.9, validation=0.3, patience=3)
    assert len(fitted.losses) < 12 and len(fitted.trees) == int(np.argmin(fitted.losses))


def test_without_rows_of_both_labels_or_values(spark):
    one = data(spark, [(i, 1.0, None, float("nan"), 1) for i in range(50)])
    assert {r.p for r in boosting.scored(boosting.fit(one, FEATURES), one).collect()} == {1.0}
    none = boosting.fit(one.limit(0), FEATURES)
    assert {r.p for r in boosting.scored(none, one.withColumn("p", F.lit("old"))).collect()} == {0.0}
    gone = data(spark, [(i, None, None, None, i % 2) for i in range(60)]).unionByName(data(spark, [(99, 1.0, None, None, None)]))
    fitted = boosting.fit(gone, FEATURES, rounds=2, validation=0.0)
    assert not fitted.trees and boosting.scored(fitted, gone).count() == 61


def test_precision_is_not_below_that_of_trees_without_missing_values(spark, small):
    learning = _learning(spark, small).cache()
    train, val = (sampling.chronological(learning).where(f"part = '{p}'").drop("part") for p in ("train", "val"))
    ours = boosting.scored(boosting.fit(train, _X, rounds=12, depth=3, rate=0.2), val)
    theirs = model.scored(model.boosted(train, _X, trees=5, depth=3), val, _X)
    ap = [metrics.average_precision(s, "p", "y").first()[0] for s in (ours, theirs)]
    assert ap[0] >= ap[1] - 0.01


def test_search_by_densities_beats_a_grid_of_its_size():
    space = {"depth": list(range(2, 12)), "rate": [0.01 * k for k in range(1, 31)], "l2": [0.1 * k for k in range(1, 21)]}
    surface = lambda s: -((s["depth"] - 7) ** 2) / 10 - ((s["rate"] - 0.17) ** 2) * 100 - (s["l2"] - 1.3) ** 2
    grid = [{"depth": d, "rate": r, "l2": z} for d in (2, 6, 10) for r in (0.01, 0.11, 0.21) for z in (0.1, 0.8, 1.5)]
    for seed in range(5):
        trials = model.searched_by_density(surface, space, trials=27, seed=seed)
        assert max(s for _, s in trials) > max(map(surface, grid)) and trials == model.searched_by_density(surface, space, trials=27, seed=seed)
    small = {"a": [1, 2], "b": [1, 2]}
    assert len({tuple(t.values()) for t, _ in model.searched_by_density(lambda s: s["a"], small, trials=8, start=2)}) == 4
