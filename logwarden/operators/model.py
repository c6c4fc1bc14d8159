"""Scaler + k-means model: fit, store as tables, load, train-or-reuse.

Training runs on the feature table, which is tiny next to the raw logs (one
row per window and service); it is persisted once and reused by the scaler
fit and every k-means iteration instead of re-reading the logs each time.

Two deliberate changes to the original job:

* Reproducibility: seeded k-means still depends on how rows are split into
  partitions, so rows are hash-partitioned into a number of partitions that
  follows from the row count, and sorted within them before the fit. Same rows -> same model, whatever the
  input layout, and the fit stays parallel.
* Meaning of cluster ids: k-means numbers clusters arbitrarily, yet the alert
  gates read id 1 as MEDIUM and id 2 as HIGH. ``order="error_rate"`` (default)
  renumbers clusters by their un-scaled error rate, lowest first, so the
  highest-error cluster is id k-1. ``order="fit"`` keeps k-means' own ids.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..schemas import CENTROID_TABLE_SCHEMA, SCALER_TABLE_SCHEMA, VECTOR_COLUMNS
from ..functions import seconds
from ..session import current_version, new_version, path_exists, publish_version

# Feature rows of one partition of the k-means fit. The fit depends on how rows
# are split, so the count follows from the number of rows alone (never from the
# session's setting): the same rows give the same model, and more rows get more
# tasks.
FIT_ROWS = 100_000


def fit_partitions(rows: int) -> int:
    return max(1, -(-rows // FIT_ROWS))


# A model table is read to the driver (it parameterises expressions); its size
# is bounded by k and checked against this limit.
MAX_CLUSTERS = 1024


def _check_cluster_count(n: int) -> None:
    """One limit for training, saving and loading."""
    if not 1 <= n <= MAX_CLUSTERS:
        raise ValueError(f"{n} clusters; expected 1..{MAX_CLUSTERS}")


def model_inputs(features: DataFrame) -> DataFrame:
    """Null average (all messages null) becomes 0.0 instead of failing the
    vector assembly."""
    return features.withColumn("avg_message_length",
                               F.coalesce(F.col("avg_message_length"), F.lit(0.0)))


def assemble(features: DataFrame, output_col: str = "raw_features") -> DataFrame:
    """The 4 features as one dense vector, in VECTOR_COLUMNS order."""
    va = VectorAssembler(inputCols=VECTOR_COLUMNS, outputCol=output_col)
    return va.transform(model_inputs(features))


def fit_scaler(assembled: DataFrame, input_col: str = "raw_features",
               output_col: str = "features") -> StandardScalerModel:
    """z-score scaler: mean and corrected sample standard deviation."""
    return StandardScaler(inputCol=input_col, outputCol=output_col,
                          withMean=True, withStd=True).fit(assembled)


def stable_layout(df: DataFrame, partitions: int) -> DataFrame:
    """Fixed hash partitioning + in-partition sort on the feature key, so the
    same rows always meet k-means in the same order."""
    keys = ["window_start", "serviceName"]
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def fit_kmeans(scaled: DataFrame, k: int = C.KMEANS_K,
               max_iter: int = C.KMEANS_MAX_ITER, seed: int = C.KMEANS_SEED,
               features_col: str = "features", partitions: int = 1) -> KMeansModel:
    km = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col,
                predictionCol="prediction")
    return km.fit(stable_layout(scaled, partitions))


@dataclass
class ModelBundle:
    """Scaler statistics, centroids (in stored cluster order) and the window
    width the model was trained on."""

    window: str
    means: list[float]
    stds: list[float]
    centers: list[list[float]]
    fit_ids: list[int] = field(default_factory=list)   # k-means id per stored id
    order: str = "error_rate"
    partitions: int = 1                                # layout of the fit
    scaler_model: StandardScalerModel | None = None
    kmeans_model: KMeansModel | None = None

    @property
    def k(self) -> int:
        return len(self.centers)

    def stored_id_of_fit_id(self) -> dict[int, int]:
        return {fid: i for i, fid in enumerate(self.fit_ids or range(self.k))}

    def unscaled_centers(self) -> list[list[float]]:
        return [[c * s + m for c, s, m in zip(cen, self.stds, self.means)]
                for cen in self.centers]


def _ordered(centers: list[list[float]], means: list[float], stds: list[float],
             order: str) -> list[int]:
    if order == "fit":
        return list(range(len(centers)))
    if order != "error_rate":
        raise ValueError(f"unknown cluster order {order!r}")
    pos = VECTOR_COLUMNS.index("error_rate")
    unscaled = [c[pos] * stds[pos] + means[pos] for c in centers]
    return sorted(range(len(centers)), key=lambda i: (unscaled[i], i))


def train(features: DataFrame, window: str, k: int = C.KMEANS_K,
          max_iter: int = C.KMEANS_MAX_ITER, seed: int = C.KMEANS_SEED,
          order: str = "error_rate", partitions: int | None = None) -> ModelBundle:
    """Fit scaler and k-means on a feature table.

    The k-means layout has ``partitions`` partitions (by default as many as the
    number of rows asks for) whatever the session and the input's layout, so the
    same rows give the same model."""
    _check_cluster_count(k)
    assembled = assemble(features).select(
        "window_start", "serviceName", "raw_features").persist()
    try:
        rows = assembled.count()
        if rows == 0:
            raise ValueError("no feature rows to train on (no logs with a time stamp)")
        partitions = partitions or fit_partitions(rows)
        scaler = fit_scaler(assembled)
        scaled = scaler.transform(assembled)
        km = fit_kmeans(scaled, k, max_iter, seed, partitions=partitions)
    finally:
        assembled.unpersist()
    means = [float(x) for x in scaler.mean.toArray()]
    stds = [float(x) for x in scaler.std.toArray()]
    fit_centers = [[float(x) for x in c] for c in km.clusterCenters()]
    perm = _ordered(fit_centers, means, stds, order)
    return ModelBundle(window=window, means=means, stds=stds,
                       centers=[fit_centers[i] for i in perm], fit_ids=perm,
                       order=order, partitions=partitions, scaler_model=scaler,
                       kmeans_model=km)


def train_scaler(features: DataFrame, window: str) -> ModelBundle:
    """Only the scaler (one aggregation pass); the bundle has no centroids."""
    scaler = fit_scaler(assemble(features).select("raw_features"))
    return ModelBundle(window=window,
                       means=[float(x) for x in scaler.mean.toArray()],
                       stds=[float(x) for x in scaler.std.toArray()],
                       centers=[], fit_ids=[], scaler_model=scaler)


def scaler_table(spark: SparkSession, bundle: ModelBundle) -> DataFrame:
    rows = [(name, i, float(bundle.means[i]), float(bundle.stds[i]))
            for i, name in enumerate(VECTOR_COLUMNS)]
    return spark.createDataFrame(rows, SCALER_TABLE_SCHEMA)


def centroid_table(spark: SparkSession, bundle: ModelBundle) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(bundle.centers)]
    return spark.createDataFrame(rows, CENTROID_TABLE_SCHEMA)


def bundle_from_tables(scaler_df: DataFrame, centroid_df: DataFrame,
                       window: str, order: str = "error_rate") -> ModelBundle:
    """Model from its two tables. Both are bounded (4 rows; k rows) and the
    bound is checked before anything reaches the driver."""
    nv = len(VECTOR_COLUMNS)
    srows = sorted(scaler_df.select("position", "mean", "std").limit(nv + 1).collect())
    if [r["position"] for r in srows] != list(range(nv)):
        raise ValueError("scaler table must have one row per vector position")
    crows = sorted(centroid_df.select("cluster", "center").limit(MAX_CLUSTERS + 1).collect())
    n = len(crows)
    _check_cluster_count(n)
    if [r["cluster"] for r in crows] != list(range(n)):
        raise ValueError("cluster ids must be 0..k-1")
    return ModelBundle(window=window,
                       means=[float(r["mean"]) for r in srows],
                       stds=[float(r["std"]) for r in srows],
                       centers=[[float(x) for x in r["center"]] for r in crows],
                       fit_ids=list(range(n)), order=order)


def save_bundle(spark: SparkSession, bundle: ModelBundle, path: str) -> None:
    """Save the plain model tables, and the pyspark.ml models if the bundle has
    them, as a new version; the version counts once all its parts are written,
    so readers never see parts of two models."""
    base = path.rstrip("/")
    version = new_version(spark, base)
    vdir = f"{base}/{version}"
    parts = ["scaler_table", "centroids"]
    for name, model in (("kmeans", bundle.kmeans_model), ("scaler", bundle.scaler_model)):
        if model is not None:
            model.write().overwrite().save(f"{vdir}/{name}")
            parts.append(name)
    scaler_table(spark, bundle).coalesce(1).write.parquet(f"{vdir}/scaler_table")
    centroid_table(spark, bundle).coalesce(1).write.parquet(f"{vdir}/centroids")
    publish_version(spark, base, version, {
        "window": bundle.window, "order": bundle.order, "fit_ids": bundle.fit_ids,
        "partitions": bundle.partitions, "parts": parts})


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete model is stored (a storage error is raised)."""
    base = path.rstrip("/")
    meta = current_version(spark, base)
    return meta is not None and all(
        path_exists(spark, f"{base}/{meta['version']}/{p}") for p in meta["parts"])


def load_bundle(spark: SparkSession, path: str, window: str | None = None) -> ModelBundle:
    """Load the current saved model; ``window`` (if given) must equal the
    trained width, so a model is never applied to windows of another size."""
    base = path.rstrip("/")
    meta = current_version(spark, base)
    if meta is None:
        raise FileNotFoundError(f"no model at {path}")
    if window is not None and seconds(window) != seconds(meta["window"]):
        raise ValueError(f"model trained on {meta['window']!r} windows, asked for {window!r}")
    vdir = f"{base}/{meta['version']}"
    b = bundle_from_tables(spark.read.parquet(f"{vdir}/scaler_table"),
                           spark.read.parquet(f"{vdir}/centroids"),
                           meta["window"], meta.get("order", "error_rate"))
    b.fit_ids = list(meta.get("fit_ids") or range(b.k))
    b.partitions = meta["partitions"]
    if "kmeans" in meta["parts"]:
        b.kmeans_model = KMeansModel.load(f"{vdir}/kmeans")
    if "scaler" in meta["parts"]:
        b.scaler_model = StandardScalerModel.load(f"{vdir}/scaler")
    return b


def ensure_model(spark: SparkSession, path: str, logs_factory, window: str,
                 **train_kwargs) -> ModelBundle:
    """Train unless a complete model is stored at ``path``; then load it.

    ``logs_factory`` is only called when training is needed (it may snapshot
    the topic first)."""
    from .features import window_features

    if model_exists(spark, path):
        return load_bundle(spark, path, window)
    logs = logs_factory()
    bundle = train(window_features(logs, window), window, **train_kwargs)
    save_bundle(spark, bundle, path)
    return bundle
