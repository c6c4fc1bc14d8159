"""Training snapshot: the decoded logs written to a table (overwrite).

Files, and on request a copy in a database (JDBC). The snapshot is written
once and training then reads the *stored* files, so the topic is scanned one
time instead of once per training job and no database connection is a
bottleneck of the training read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LOG_COLUMNS, LOG_SCHEMA


def _jdbc_options(url: str, table: str, user: str | None, password: str | None,
                  driver: str | None) -> dict:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def snapshot_logs(logs: DataFrame, *, path: str | None = None, fmt: str = "parquet",
                  jdbc_url: str | None = None, table: str = "training_logs",
                  user: str | None = None, password: str | None = None,
                  driver: str | None = None) -> None:
    out = logs.select(*LOG_COLUMNS)
    if jdbc_url:
        (out.write.format("jdbc")
         .options(**_jdbc_options(jdbc_url, table, user, password, driver))
         .mode("overwrite").save())
        return
    if path is None:
        raise ValueError("either jdbc_url or path is required")
    out.write.mode("overwrite").format(fmt).save(path)


def read_snapshot(spark: SparkSession, *, path: str | None = None, fmt: str = "parquet",
                  jdbc_url: str | None = None, table: str = "training_logs",
                  user: str | None = None, password: str | None = None,
                  driver: str | None = None, partition_column: str | None = None,
                  lower_bound: str | None = None, upper_bound: str | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """The stored logs. A database table is read through ``num_partitions``
    connections that split ``partition_column`` between the bounds (rows
    outside them are read too, by the first and last connection)."""
    if jdbc_url:
        opts = _jdbc_options(jdbc_url, table, user, password, driver)
        if not (partition_column and lower_bound is not None and upper_bound is not None
                and num_partitions):
            raise ValueError("a database table is read in parallel: give partition_column, "
                             "lower_bound, upper_bound and num_partitions")
        opts |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                 "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
        df = spark.read.format("jdbc").options(**opts).load()
        # Column names and types back to the log schema (JDBC may upper-case).
        by_lower = {c.lower(): c for c in df.columns}
        return df.select(*[df[by_lower[f.name.lower()]].cast(f.dataType).alias(f.name)
                           for f in LOG_SCHEMA.fields])
    if path is None:
        raise ValueError("either jdbc_url or path is required")
    reader = spark.read.format(fmt)
    if fmt != "parquet":
        reader = reader.schema(LOG_SCHEMA)
    return reader.load(path).select(*LOG_COLUMNS)
