"""Learning and scoring with MLlib; models differ from histogram boosting in detail, not in use."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.sampling import chronological, order_of
from ..operators.windows import within_horizon
from ..schema import group_of


def _inputs(features: list[str]) -> list:
    doubles = [f"_{f}" for f in features]
    return [Imputer(strategy="median", inputCols=features, outputCols=doubles), VectorAssembler(inputCols=doubles, outputCol="_x")]


def boosted(train: DataFrame, features: list[str], label: str = "y", trees: int = 20, depth: int = 5, rate: float = 0.1, seed: int = 0) -> PipelineModel:
    """Gradient-boosted trees; missing values take the median, since trees here have no branch for them."""
    data = train.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("y"))
    return Pipeline(stages=[*_inputs(features), GBTClassifier(labelCol="y", featuresCol="_x", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed)]).fit(data)


def logistic(train: DataFrame, features: list[str], label: str = "y") -> PipelineModel:
    """Median imputation, standardisation and class-balanced logistic regression."""
    data = train.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("y"))
    share = data.agg(F.avg("y")).first()[0] or 0.5
    data = data.withColumn("_w", F.when(F.col("y") == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9)))
    stages = [*_inputs(features), StandardScaler(inputCol="_x", outputCol="_z", withMean=True), LogisticRegression(labelCol="y", featuresCol="_z", weightCol="_w", regParam=1e-4)]
    return Pipeline(stages=stages).fit(data)


def scored(model: PipelineModel, df: DataFrame, features: list[str], name: str = "p") -> DataFrame:
    """df with the probability of an event."""
    out = model.transform(df.withColumns({f: F.col(f).cast("double") for f in features}))
    return out.select(*df.columns, vector_to_array("probability")[1].alias(name)) if name not in df.columns else out.drop(name).select(*[c for c in df.columns if c != name], vector_to_array("probability")[1].alias(name))


def isotonic(df: DataFrame, p: str = "p", label: str = "y") -> IsotonicRegressionModel:
    return IsotonicRegression(featuresCol=p, labelCol=label, isotonic=True).fit(df.select(F.col(p).cast("double").alias(p), F.col(label).cast("double").alias(label)))


def calibrated(model: IsotonicRegressionModel, df: DataFrame, p: str = "p") -> DataFrame:
    """df with p calibrated, between 0 and 1."""
    out = model.setFeaturesCol(p).setPredictionCol("_q").transform(df)
    return out.withColumn(p, F.least(F.greatest("_q", F.lit(0.0)), F.lit(1.0))).drop("_q")


def permuted(df: DataFrame, feature: str, seed: int, tie: str) -> DataFrame:
    """df with one feature shuffled: rows take each other's value by two orders of a hash, bucket by bucket."""
    buckets = 64
    place = F.pmod(F.xxhash64(tie), F.lit(buckets))
    a = df.withColumn("_b", place).withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order_of(tie))))
    b = df.select(F.col(feature).alias("_v"), place.alias("_b"), F.col(tie).alias("_t")).withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(F.xxhash64(F.lit(seed), "_t")))).select("_b", "_r", "_v")
    return a.join(b, ["_b", "_r"]).withColumn(feature, F.col("_v")).drop("_b", "_r", "_v")


def importance(model: PipelineModel, df: DataFrame, features: list[str], label: str, tie: str, repeats: int = 2) -> list[tuple[str, float]]:
    """(feature, mean drop of average precision when it is permuted), greatest first."""
    ap = lambda d: metrics.average_precision(scored(model, d, features), "p", label).first().ap or 0.0
    base = ap(df)
    found = [(f, sum(base - ap(permuted(df, f, r, tie)) for r in range(repeats)) / repeats) for f in features]
    return sorted(found, key=lambda x: (-x[1], x[0]))


def without_groups(train: DataFrame, val: DataFrame, features: list[str], label: str = "y", fit=logistic) -> list[tuple[str, float]]:
    """(group left out, average precision on val), "none" first."""
    out = []
    for group in ["none", *dict.fromkeys(map(group_of, features))]:
        kept = [f for f in features if group_of(f) != group]
        if kept:
            found = scored(fit(train, kept, label), val, kept).select("p", label).persist()
            out.append((group, metrics.average_precision(found, "p", label).first().ap))
            found.unpersist()
    return out


def over_horizons(df: DataFrame, features: list[str], weather: list[str], horizons: list[int], w: WindowSpec, event: str = "is_fire", complement: bool = False, fit=logistic) -> list[tuple[int, int, float]]:
    """(horizon, events on val, average precision): a model for each horizon, its weather that of the last day ahead."""
    out = []
    for h in horizons:
        led = with_lead(df, weather, h, complement, w).withColumn("y", within_horizon(F.col(event) == 1, h, w)).where("y is not null")
        kept = features + ([f"{f}_lead{h}" for f in weather] if complement else [])
        # Fitting reads the rows many times, and they come out of windows.
        data = chronological(led.select("day", *kept, "y")).persist()
        val = data.where("part = 'val'")
        found = scored(fit(data.where("part = 'train'"), kept), val, kept)
        n = val.agg(F.sum("y")).first()[0] or 0
        out.append((h, int(n), metrics.average_precision(found, "p", "y").first().ap))
        data.unpersist()
    return out


def label_matrix(cube: DataFrame, labels: dict[str, Column], derive: Callable[[DataFrame], DataFrame], event: str = "is_fire") -> DataFrame:
    """(label, rows of ``derive``): one matrix for each definition of an event, what depends on events made anew from it."""
    parts = [derive(cube.withColumn(event, c)).select(F.lit(name).alias("label"), "*") for name, c in labels.items()]
    return reduce(DataFrame.unionByName, parts)


def searched(train: DataFrame, val: DataFrame, features: list[str], grid: dict[str, list], label: str = "y") -> tuple[dict, float]:
    """The setting with the best average precision on val, and that precision."""
    best: tuple[dict, float] = ({}, -1.0)
    for values in product(*grid.values()):
        setting = dict(zip(grid, values, strict=True))
        ap = metrics.average_precision(scored(boosted(train, features, label, **setting), val, features), "p", label).first().ap or 0.0
        best = max(best, (setting, ap), key=lambda x: x[1])
    return best


def suggested(trials: list[tuple[dict, float]], space: dict[str, list], seed: int = 0, best: float = 0.25, draws: int = 32) -> dict:
    """The next setting to try, by the ratio of two densities: of the values of the best trials and of the others'.

    Values are places on their lists; a density is a sum of triangular kernels over
    the trials' places and an even share.  Draws from the first one are by a fixed
    seed and the number of trials, so the same trials ask for the same setting; one
    that was tried is not asked for again while others are left.
    """
    rng = np.random.default_rng([seed, len(trials)])
    order = sorted(range(len(trials)), key=lambda i: -trials[i][1])
    many = max(1, int(np.ceil(best * len(trials))))
    tried = {tuple(space[k].index(t[k]) for k in space) for t, _ in trials}

    def densities(chosen: list[int]) -> list[np.ndarray]:
        out = []
        for k, values in space.items():
            n = len(values)
            reach = max(1.0, n / 4)
            at = np.array([values.index(trials[i][0][k]) for i in chosen], float).reshape(-1, 1)
            weight = np.ones(n) / n + np.maximum(0.0, 1 - np.abs(np.arange(n) - at) / reach).sum(0)
            out.append(weight / weight.sum())
        return out

    good, rest = densities(order[:many]), densities(order[many:])
    found = {tuple(int(rng.choice(len(d), p=d)) for d in good) for _ in range(draws)}
    if not found - tried:
        found = set(product(*[range(len(v)) for v in space.values()])) if np.prod([len(v) for v in space.values()]) <= 4096 else found
    ratio = lambda p: sum(float(np.log(g[i] / r[i])) for g, r, i in zip(good, rest, p, strict=True))
    top = max(sorted(found - tried or found), key=ratio)
    return {k: v[i] for (k, v), i in zip(space.items(), top, strict=True)}


def searched_by_density(score: Callable[[dict], float], space: dict[str, list], trials: int = 20, start: int = 6, seed: int = 0) -> list[tuple[dict, float]]:
    """(setting, score) of all trials in order: some drawn evenly, then those that :func:`suggested` asks for."""
    rng, done = np.random.default_rng(seed), []
    for k in range(trials):
        if k < start:
            setting = {name: values[int(rng.integers(len(values)))] for name, values in space.items()}
        else:
            setting = suggested(done, space, seed)
        known = [s for t, s in done if t == setting]
        done.append((setting, known[0] if known else score(setting)))
    return done


def by_definition(cube: DataFrame, labels: dict[str, Column], derive: Callable[[DataFrame], DataFrame], features: list[str], fit: Callable[[DataFrame, list[str]], Callable[[DataFrame], DataFrame]], tie: str = "id") -> list[dict]:
    """Metrics of a model for each definition of an event, fitted and judged on that definition's own matrix by a chronological split.

    ``derive`` makes (tie, day, y, features) of a cube with that definition; ``fit``
    gives what adds p.  A row a definition reaches the driver.
    """
    out = []
    for name, definition in labels.items():
        # Fitting and judging read the rows many times, and they come out of windows.
        rows = derive(cube.withColumn("is_fire", definition)).where("y is not null").select(tie, "day", "y", *features).persist()
        data = chronological(rows)
        val = fit(data.where("part = 'train'"), features)(data.where("part = 'val'")).select(tie, "p", "y").persist()
        found = metrics.average_precision(val, "p", "y").first(), metrics.roc_auc(val, "p", "y").first(), metrics.r_precision(val, "p", "y", tie).first()
        out.append({"label": name, "ap": found[0].ap, "auc": found[1].auc, "precision_at_k": found[2].precision, "n_pos": found[1].n_pos, "n_neg": found[1].n_neg})
        val.unpersist()
        rows.unpersist()
    return out


def forecast_gain(df: DataFrame, features: list[str], weather: list[str], fit: Callable[[DataFrame, list[str]], Callable[[DataFrame], DataFrame]], lead: int = 1) -> dict[str, float | None]:
    """Average precision without a forecast, with the weather of t + lead in its place, and with both; on the rows that all three have."""
    w = Window.partitionBy("cell").orderBy("day")
    both = with_lead(df, weather, lead, True, w).where(" and ".join(f"{f}_lead{lead} is not null" for f in weather))
    later = [f"{f}_lead{lead}" for f in weather]
    # Fitting and judging read the rows many times, and they come out of windows.
    rows = both.where("y is not null").select("day", "y", *features, *later).persist()
    data = chronological(rows)
    train, val = data.where("part = 'train'"), data.where("part = 'val'")
    sets = {"without": features, "instead": [f for f in features if f not in weather] + later, "with": features + later}
    out = {}
    for name, names in sets.items():
        found = fit(train, names)(val).select("p", "y").persist()
        out[name] = metrics.average_precision(found, "p", "y").first().ap
        found.unpersist()
    rows.unpersist()
    return out


def early_stopped(scores: list[tuple[float, float]], alpha: float = 0.5, patience: int = 3) -> int:
    """The step to keep by a blend of two precisions (new events, spread); looking ends after ``patience`` steps without a better one."""
    best, at = -1.0, 0
    for k, (new, spread) in enumerate(scores):
        blend = alpha * new + (1 - alpha) * spread
        if blend > best:
            best, at = blend, k
        elif k - at >= patience:
            break
    return at


def with_lead(df: DataFrame, features: list[str], lead: int, complement: bool, w) -> DataFrame:
    """Weather of t + lead in place of the day's own, or next to it."""
    return df.withColumns({f"{f}_lead{lead}" if complement else f: F.lead(f, lead).over(w) for f in features})


def label(event: Column) -> Column:
    return F.coalesce(event.cast("int"), F.lit(0))
