"""Scaler and k-means kept up by date: partial results that merge exactly.

A refit over a year of 5-minute windows reads every feature row again, though
only the newest dates have changed. Here each date leaves two small partials:

* moments -- (n, mean, sum of squared deviations) of each feature. They merge
  to the mean and deviation of all rows, in any order.
* cells -- a coreset: rows fall into cells of a fixed grid, and a cell keeps its
  count, sums and sums of squares. Cells of all dates add up by cell; k-means
  runs on the cells' means, weighted by their counts. What the cells hide is
  known exactly: the squared deviations inside them.

A refresh works out the dates that are not stored yet and the newest stored one
(it may have been unfinished); only their feature rows are read. Partials of a
date replace that date's folder, so a repeated refresh changes nothing.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..schemas import VECTOR_COLUMNS
from ..session import child_names, path_exists
from ..sinks.alert_store import window_date
from .model import ModelBundle, _ordered, fit_partitions, model_inputs

DATE = "window_date"
#: Cells a standard deviation, along each feature.
CELLS_PER_DEVIATION = 16
#: Cells that a fit takes; with more, neighbouring cells merge (two along each
#: feature become one) until they fit.
MAX_CELLS = 1_000_000
#: Fits on the coreset, of which the one of least cost is kept.
RESTARTS = 4


def _x(name: str) -> Column:
    return F.col(name).cast("double")


# ------------------------------------------------------------------- moments ---

def date_moments(features: DataFrame) -> DataFrame:
    """(window_date, n, mean_*, m2_*): one row a date."""
    per_feature = [a for n in VECTOR_COLUMNS for a in (
        F.avg(_x(n)).alias(f"mean_{n}"), (F.var_pop(_x(n)) * F.count(F.lit(1))).alias(f"m2_{n}"))]
    return model_inputs(features).withColumn(DATE, window_date()).groupBy(DATE).agg(
        F.count(F.lit(1)).alias("n"), *per_feature)


def merged_scaler(moments: DataFrame, window: str) -> ModelBundle:
    """The scaler of all dates (a bundle without centroids). Two passes over one
    row a date: the means, then the squared deviations from them."""
    total = moments.agg(F.sum("n").alias("n"), *[
        (F.sum(F.col("n") * F.col(f"mean_{n}")) / F.sum("n")).alias(n) for n in VECTOR_COLUMNS]).first()
    if not total["n"]:
        raise ValueError("no feature rows to train on (no logs with a time stamp)")
    means = [float(total[n]) for n in VECTOR_COLUMNS]
    m2 = moments.agg(*[F.sum(F.col(f"m2_{n}") + F.col("n") * (F.col(f"mean_{n}") - F.lit(m))
                             * (F.col(f"mean_{n}") - F.lit(m))).alias(n)
                       for n, m in zip(VECTOR_COLUMNS, means)]).first()
    rest = max(1, total["n"] - 1)
    return ModelBundle(window=window, means=means, centers=[], fit_ids=[],
                       stds=[float((m2[n] / rest) ** 0.5) for n in VECTOR_COLUMNS])


# --------------------------------------------------------------------- cells ---

@dataclass(frozen=True)
class Grid:
    """Origin and step of the cells along each feature; fixed when the first
    dates are stored, so that cells of all dates add up."""

    origin: tuple[float, ...]
    step: tuple[float, ...]

    @staticmethod
    def of(scaler: ModelBundle) -> Grid:
        return Grid(tuple(scaler.means), tuple(s / CELLS_PER_DEVIATION or 1.0 for s in scaler.stds))

    def cell(self) -> list[Column]:
        return [F.floor((_x(n) - F.lit(o)) / F.lit(s)).cast("long").alias(f"c_{n}")
                for n, o, s in zip(VECTOR_COLUMNS, self.origin, self.step)]


_CELL = [f"c_{n}" for n in VECTOR_COLUMNS]
_SUMS = ["n", *[f"{k}_{n}" for n in VECTOR_COLUMNS for k in ("sum", "sq")]]


def date_cells(features: DataFrame, grid: Grid) -> DataFrame:
    """(window_date, cell, n, sums, sums of squares) of the rows of each date."""
    sums = [a for n in VECTOR_COLUMNS for a in (
        F.sum(_x(n)).alias(f"sum_{n}"), F.sum(_x(n) * _x(n)).alias(f"sq_{n}"))]
    rows = model_inputs(features).withColumn(DATE, window_date())
    return rows.select("*", *grid.cell()).groupBy(DATE, *_CELL).agg(F.count(F.lit(1)).alias("n"), *sums)


def merged_cells(cells: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Cells of all dates, added up by cell, ``max_cells`` at most: beyond that
    the cells merge two by two along each feature, which loses nothing of their
    sums."""
    level = 0
    while True:
        merged = cells.groupBy(*[F.shiftright(c, level).alias(c) for c in _CELL]).agg(
            *[F.sum(s).alias(s) for s in _SUMS]).persist()
        if merged.count() <= max_cells or level >= 62:
            return merged
        merged.unpersist()
        level += 1


def train_on_cells(cells: DataFrame, scaler: ModelBundle, k: int = C.KMEANS_K,
                   max_iter: int = C.KMEANS_MAX_ITER, seed: int = C.KMEANS_SEED,
                   order: str = "error_rate", max_cells: int = MAX_CELLS) -> ModelBundle:
    """k-means on the cells' means, weighted by their counts and scaled. The
    layout follows from the number of cells alone, and the cells are sorted, so
    the same dates give the same model in any session. Of RESTARTS seeds the
    fit of least cost is kept (a coreset is cheap to fit again)."""
    merged = merged_cells(cells, max_cells)
    try:
        z = [F.when(F.lit(s != 0.0), (F.col(f"sum_{n}") / F.col("n") - F.lit(m)) / F.lit(s or 1.0)).otherwise(0.0)
             for n, m, s in zip(VECTOR_COLUMNS, scaler.means, scaler.stds)]
        parts = fit_partitions(merged.count())
        points = merged.select(*_CELL, F.col("n").cast("double").alias("weight"),
                               array_to_vector(F.array(*z)).alias("features")).repartition(
            parts, *_CELL).sortWithinPartitions(*_CELL).persist()
        try:
            fits = [KMeans(k=k, maxIter=max_iter, seed=seed + i, featuresCol="features",
                           weightCol="weight").fit(points) for i in range(RESTARTS)]
        finally:
            points.unpersist()
    finally:
        merged.unpersist()
    best = min(fits, key=lambda m: m.summary.trainingCost)
    centers = [[float(x) for x in c] for c in best.clusterCenters()]
    perm = _ordered(centers, scaler.means, scaler.stds, order)
    return ModelBundle(window=scaler.window, means=scaler.means, stds=scaler.stds,
                       centers=[centers[i] for i in perm], fit_ids=perm, order=order, partitions=parts,
                       kmeans_model=best)


# ----------------------------------------------------------- stored by date ---

def stored_dates(spark: SparkSession, path: str) -> list[str]:
    return [n.split("=")[1] for n in child_names(spark, f"{path.rstrip('/')}/moments") if n.startswith(DATE)]


def _write_dates(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)


def _grid(spark: SparkSession, base: str) -> Grid | None:
    if not path_exists(spark, f"{base}/grid/_SUCCESS"):
        return None
    return Grid(*(tuple(x) for x in json.loads(spark.read.text(f"{base}/grid").first()[0])))


def refresh_partials(spark: SparkSession, features: DataFrame, path: str) -> list[str]:
    """Bring the partials below ``path`` up to date with a feature table that has
    a ``window_date`` partition (or any): only rows of dates that are not stored,
    and of the newest stored one, are read. Returns the dates stored before."""
    base = path.rstrip("/")
    before = stored_dates(spark, base)
    if DATE not in features.columns:
        features = features.withColumn(DATE, window_date())
    settled = before[:-1]
    fresh = features.filter(~F.col(DATE).cast("string").isin(settled)) if settled else features
    moments = date_moments(fresh).persist()
    try:
        grid = _grid(spark, base)
        if grid is None:
            if moments.isEmpty():
                return before
            grid = Grid.of(merged_scaler(moments, ""))
            spark.createDataFrame([(json.dumps([grid.origin, grid.step]),)], "grid string").coalesce(
                1).write.mode("overwrite").text(f"{base}/grid")
        _write_dates(date_cells(fresh, grid), f"{base}/cells")
        _write_dates(moments, f"{base}/moments")       # last: a date counts once both are there
    finally:
        moments.unpersist()
    return before


def refit_scaler(spark: SparkSession, path: str, window: str) -> ModelBundle:
    """The scaler of all stored dates, from one row a date."""
    return merged_scaler(spark.read.parquet(f"{path.rstrip('/')}/moments"), window)


def refit(spark: SparkSession, path: str, window: str, **fit_options) -> ModelBundle:
    """The model of all stored dates, from their partials alone."""
    cells = spark.read.parquet(f"{path.rstrip('/')}/cells")
    return train_on_cells(cells, refit_scaler(spark, path, window), **fit_options)
