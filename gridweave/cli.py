"""Jobs over tables: ``python -m gridweave.cli JOB --help``.

A grid is given as x0,y0,dx,dy,nx,ny; without one it is the served grid.
"""

from __future__ import annotations

import argparse
import json
import uuid
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from .grid import KILOMETRE, SERVED_FACTOR, Grid
from .operators import metrics, sampling, spatial
from .plans import features, maintain, model, serving
from .schema import FEATURES, WEATHER, chosen, present
from .sources import readers, sinks, snapshots


def session(name: str = "gridweave") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def grid_of(text: str | None) -> Grid:
    if not text:
        return KILOMETRE.coarse(SERVED_FACTOR)
    *floats, nx, ny = text.split(",")
    return Grid(*map(float, floats), int(nx), int(ny))


def guarded(path: str, overwrite: bool, spark: SparkSession) -> None:
    if sinks.exists(spark, path) and not overwrite:
        raise SystemExit(f"{path} is there; give --overwrite")


def append(spark, a):
    """Bronze days that silver lacks, up to an end."""
    new = readers.cube(spark, a.source, last=a.end)
    print(json.dumps({"days": sorted(str(r.day) for r in sinks.append_new(new, a.target).collect())}))


def coarsen(spark, a):
    """Blocks of a cube, each variable pooled by its name."""
    guarded(a.target, a.overwrite, spark)
    df = readers.cube(spark, a.source)
    values = [c for c in df.columns if c not in ("day", "cell")]
    sinks.replace_days(spatial.block_pool(df, grid_of(a.grid), a.factor, values), a.target)


def _carried(spark, target: str, last: str) -> bool:
    """Whether the stored state is of the built days up to ``last``."""
    store = snapshots.Snapshots(spark, f"{target}_carried")
    row = store.read().first() if store.versions() else None
    return row is not None and str(row.upto) == last


def _keep(spark, target: str, last, carried, seen) -> None:
    """Stores state and moments with the day that they are of, as new versions; moments first, so that the state names what is complete."""
    upto = F.lit(str(last)).cast("date").alias("upto")
    for name, df, keys in (("moments", seen, ["cell", "_doy"]), ("carried", carried, ["cell"])):
        store = snapshots.Snapshots(spark, f"{target}_{name}")
        store.create(df.select("*", upto), keys)
        store.vacuum(2)


def build(spark, a):
    """All engineered features of a cube, and what an edge goes on from."""
    guarded(a.target, a.overwrite, spark)
    cube = readers.cube(spark, a.source)
    annual = features.annual_rain(cube)
    land = None
    if a.static:
        features.terrain(spark.read.parquet(a.static), grid_of(a.grid)).write.mode("overwrite").parquet(f"{a.target}_land")
        land = spark.read.parquet(f"{a.target}_land")
    sinks.replace_days(features.engineered(cube, grid_of(a.grid), annual, land), a.target)
    annual.write.mode("overwrite").parquet(f"{a.target}_annual")
    done = spark.read.parquet(a.target).withColumn("day", F.col("day").cast("date"))
    last = done.agg(F.max("day")).first()[0]
    _keep(spark, a.target, last, features.state(done, str(last)), features.moments(done))


def edge(spark, a):
    """New days of a cube, a year at a time, appended with features equal to the whole build's."""
    done = spark.read.parquet(a.target).withColumn("day", F.col("day").cast("date"))
    last = done.agg(F.max("day")).first()[0]
    cube = readers.cube(spark, a.source, last=a.to)
    if a.dry_run:
        print(json.dumps({"last": str(last), "new": cube.where(F.col("day") > F.lit(last)).select("day").distinct().count()}))
        return
    if _carried(spark, a.target, str(last)):
        carried, seen = (snapshots.Snapshots(spark, f"{a.target}_{name}").read().where(F.col("upto") == F.lit(last)).drop("upto") for name in ("carried", "moments"))
    else:  # a run was lost between rows and state: once from all built days
        carried, seen = features.state(done, str(last)), features.moments(done)
    land = spark.read.parquet(f"{a.target}_land") if sinks.exists(spark, f"{a.target}_land") else None
    work = f"{a.target}_work/{uuid.uuid4().hex}"

    def kept(df):
        at = f"{work}/{uuid.uuid4().hex}"
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    for upto, new, carried, seen in features.edges(cube, grid_of(a.grid), last, spark.read.parquet(f"{a.target}_annual"), carried, seen, kept, land=land):
        sinks.append_new(new, a.target)
        _keep(spark, a.target, upto, carried, seen)
    at = spark._jvm.org.apache.hadoop.fs.Path(work)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def update(spark, a):
    """What an update would add, by the settled-data lag."""
    row = readers.cube(spark, a.source).agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    print(json.dumps(maintain.plan(row.a, row.b, date.fromisoformat(a.today), a.lag), default=str))


def rechunk(spark, a):
    """Another layout of the same rows."""
    sinks.relaid(spark.read.parquet(a.source), a.files, ["cell"], ["cell", "day"]).write.mode("overwrite").parquet(a.target)


def _inputs(spark, a):
    df = readers.cube(spark, a.source)
    names, missing = present(df.columns)
    if missing:
        print(json.dumps({"missing": missing}))
    names = chosen(names, exclude=a.drop)
    # A feature without any value (anomalies of a first year) has no median to stand for it.
    there = df.agg(*[F.count(n).alias(n) for n in names]).first()
    names = [n for n in names if there[n]]
    w = Window.partitionBy("cell").orderBy("day")
    if a.lead:
        weather = [f for f in names if WEATHER.match(f)]
        df = model.with_lead(df, weather, a.lead, a.complement, w)
        names += [f"{f}_lead{a.lead}" for f in weather] if a.complement else []
    df = df.withColumn("y", F.lead(model.label(F.col("is_fire"))).over(w)).where("y is not null")
    return sampling.chronological(df.withColumn("regime", serving.regime(F.col("dist_to_fire")))), names


def train(spark, a):
    """Model, calibration and metrics by a chronological split."""
    data, names = _inputs(spark, a)
    fitted = model.boosted(sampling.negatives_per_day(data.where("part = 'train'"), "y", "cell"), names, trees=a.trees, depth=a.depth)
    val = model.scored(fitted, sampling.every(data.where("part = 'val'"), a.stride), names).withColumn("id", F.concat_ws("|", "day", "cell"))
    fitted.write().overwrite().save(f"{a.model}/trees{a.tag}")
    model.isotonic(val).write().overwrite().save(f"{a.model}/isotonic{a.tag}")
    found = metrics.regime_metrics(val, "p", "y", "regime", "id").first().asDict()
    sinks.publish(spark, f"{a.model}/meta{a.tag}", {"features": names, "metrics": found})
    print(json.dumps(found))


def importance(spark, a):
    data, _ = _inputs(spark, a)
    names = sinks.manifest(spark, f"{a.model}/meta{a.tag}")["features"]
    val = sampling.every(data.where("part = 'val'"), a.stride).withColumn("id", F.concat_ws("|", "day", "cell"))
    print(json.dumps(model.importance(PipelineModel.load(f"{a.model}/trees{a.tag}"), val, names, "y", "id")))


def serve(spark, a):
    """Scores of a day: summary by region and regime, cells, drift, drivers; the manifest last."""
    if a.show:
        readers.last_partitions(spark.read.parquet(f"{a.store}/inference"), "issue_date", 3).orderBy(F.desc("expected_count")).show(8, False)
        return
    at = f"{a.store}/inference/issue_date={a.date}"
    guarded(at, a.overwrite, spark)
    meta = sinks.manifest(spark, f"{a.model}/meta{a.tag}")
    names, fitted = meta["features"], PipelineModel.load(f"{a.model}/trees{a.tag}")
    rows = readers.cube(spark, a.source, first=a.date, last=a.date).withColumn("regime", serving.regime(F.col("dist_to_fire")))
    if "region" not in rows.columns:
        rows = rows.withColumn("region", F.lit(1))
    scored = model.calibrated(IsotonicRegressionModel.load(f"{a.model}/isotonic{a.tag}"), model.scored(fitted, rows, names))
    inference, stats = serving.daily_outputs(scored, names, a.date, a.threshold)
    sinks.replace_days(inference, f"{a.store}/inference", "issue_date")
    sinks.replace_days(scored.select(F.lit(a.date).cast("date").alias("issue_date"), "cell", "p", "regime"), f"{a.store}/grids", "issue_date")
    sinks.replace_days(stats, f"{a.store}/feature_stats", "date")
    found = serving.drivers_json(serving.drivers(rows.select("cell", "regime", *names), names, lambda d: model.scored(fitted, d, names)))
    sinks.replace_days(found.withColumn("issue_date", F.lit(a.date).cast("date")), f"{a.store}/drivers", "issue_date")
    sinks.publish(spark, f"{a.store}/manifest", {"issue": a.date, "inference_path": at, "grid_path": f"{a.store}/grids/issue_date={a.date}"})


JOBS = {
    "append": (append, {"source": {}, "target": {}, "--end": {}}),
    "coarsen": (coarsen, {"source": {}, "target": {}, "--factor": {"type": int, "default": SERVED_FACTOR}, "--grid": {}, "--overwrite": {"action": "store_true"}}),
    "build": (build, {"source": {}, "target": {}, "--grid": {}, "--static": {}, "--overwrite": {"action": "store_true"}}),
    "edge": (edge, {"source": {}, "target": {}, "--grid": {}, "--to": {}, "--dry-run": {"action": "store_true"}}),
    "update": (update, {"source": {}, "--today": {"required": True}, "--lag": {"type": int, "default": maintain.SETTLED_DAYS}}),
    "rechunk": (rechunk, {"source": {}, "target": {}, "--files": {"type": int, "default": 64}}),
    "train": (train, {"source": {}, "model": {}, "--drop": {}, "--tag": {"default": ""}, "--lead": {"type": int, "default": 0}, "--complement": {"action": "store_true"}, "--trees": {"type": int, "default": 20}, "--depth": {"type": int, "default": 5}, "--stride": {"type": int, "default": 1}}),
    "importance": (importance, {"source": {}, "model": {}, "--drop": {}, "--tag": {"default": ""}, "--lead": {"type": int, "default": 0}, "--complement": {"action": "store_true"}, "--stride": {"type": int, "default": 1}}),
    "serve": (serve, {"source": {}, "model": {}, "store": {}, "--date": {}, "--threshold": {"type": float, "default": 0.1276}, "--tag": {"default": ""}, "--overwrite": {"action": "store_true"}, "--show": {"action": "store_true"}}),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridweave", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (run, options) in JOBS.items():
        one = jobs.add_parser(name, help=run.__doc__)
        for option, more in options.items():
            one.add_argument(option, **more)
        one.set_defaults(run=run)
    a = parser.parse_args(argv)
    # The served grid's artefacts have no tag; another grid's are named after it.
    if getattr(a, "tag", None) == "" and getattr(a, "grid", None):
        a.tag = f"_{a.grid.replace(',', '_')}"
    a.run(spark or session(), a)


if __name__ == "__main__":
    main()
