"""Scaling and nearest-centroid scoring.

Two equivalent paths:

* ``predict`` -- the pyspark.ml models (VectorAssembler -> StandardScalerModel
  -> KMeansModel), ids mapped to the stored cluster order.
* ``score`` -- the model as data: scaler statistics and k centroids become
  literal constants inside ordinary column expressions (z-scores, squared
  distances, arg-min). No join, no UDF, no vector serialisation: the whole
  scoring stays in one code-generated stage next to the aggregate, for batch
  and streaming plans alike. The constant count is 4*k, bounded by the model.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import VECTOR_COLUMNS
from .model import ModelBundle, assemble


def _inv(std: float) -> float:
    # StandardScalerModel's rule: a zero deviation scales that feature to 0.0.
    return 0.0 if std == 0.0 else 1.0 / std


def z_columns(bundle: ModelBundle, prefix: str = "z_") -> list[Column]:
    """z-scores ``(x - mean) * (1 / std)`` for the 4 vector features."""
    out = []
    for i, name in enumerate(VECTOR_COLUMNS):
        x = F.col(name).cast("double")
        if name == "avg_message_length":
            x = F.coalesce(x, F.lit(0.0))
        z = (x - F.lit(bundle.means[i])) * F.lit(_inv(bundle.stds[i]))
        out.append(z.alias(prefix + name))
    return out


def scale(features: DataFrame, bundle: ModelBundle, prefix: str = "z_") -> DataFrame:
    """Feature rows plus one z-score column per vector feature."""
    return features.select("*", *z_columns(bundle, prefix))


def squared_distance(zs: list[Column], center: list[float]) -> Column:
    total = None
    for z, c in zip(zs, center):
        d = z - F.lit(float(c))
        term = d * d
        total = term if total is None else total + term
    return total


def nearest_cluster(zs: list[Column], centers: list[list[float]]) -> Column:
    """Index of the closest centre; ties go to the lower index (as k-means)."""
    cands = [F.struct(squared_distance(zs, c).alias("d"), F.lit(i).alias("cluster"))
             for i, c in enumerate(centers)]
    return F.array_min(F.array(*cands)).getField("cluster")


def score(features: DataFrame, bundle: ModelBundle,
          prediction_col: str = "prediction", keep_z: bool = False) -> DataFrame:
    """Feature rows plus ``prediction`` (stored cluster id)."""
    zcols = z_columns(bundle, "_z_")
    names = [f"_z_{n}" for n in VECTOR_COLUMNS]
    staged = features.select("*", *zcols)
    pred = nearest_cluster([F.col(n) for n in names], bundle.centers)
    out = staged.withColumn(prediction_col, pred)
    if not keep_z:
        out = out.drop(*names)
    return out


def predict(features: DataFrame, bundle: ModelBundle,
            prediction_col: str = "prediction") -> DataFrame:
    """The pyspark.ml path: assemble -> scale -> KMeansModel.transform, with
    k-means ids mapped to the stored cluster order."""
    if bundle.scaler_model is None or bundle.kmeans_model is None:
        raise ValueError("bundle has no fitted pyspark.ml models")
    assembled = assemble(features)
    scaled = bundle.scaler_model.transform(assembled)
    km = bundle.kmeans_model.copy()
    km.setPredictionCol("_fit_prediction")
    pred = km.transform(scaled)
    mapping = bundle.stored_id_of_fit_id()
    mapped = F.lit(None).cast("int")
    for fid, sid in mapping.items():
        mapped = F.when(F.col("_fit_prediction") == fid, F.lit(sid)).otherwise(mapped)
    return (pred.withColumn(prediction_col, mapped)
            .drop("_fit_prediction", "raw_features", "features"))


def scaled_vector_columns(features: DataFrame, bundle: ModelBundle,
                          prefix: str = "z_") -> DataFrame:
    """Scaled features through StandardScalerModel, unpacked into columns."""
    if bundle.scaler_model is None:
        raise ValueError("bundle has no fitted scaler")
    scaled = bundle.scaler_model.transform(assemble(features))
    arr = vector_to_array(F.col("features"))
    return scaled.select(
        *[c for c in features.columns],
        *[arr[i].alias(prefix + n) for i, n in enumerate(VECTOR_COLUMNS)])


__all__ = ["nearest_cluster", "predict", "scale",
           "scaled_vector_columns", "score", "squared_distance", "z_columns"]
