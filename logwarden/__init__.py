"""Service-log anomaly detection on Spark: windowed features, z-score +
k-means scoring, MEDIUM/HIGH alerts, in batch and as a stream."""

__version__ = "0.1.0"
