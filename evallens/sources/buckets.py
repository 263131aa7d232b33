"""Tables in folders, bucketed by a key: two of them with as many buckets meet without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def read_bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """A folder that `write_bucketed` wrote, read as such."""
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, dealt: bool = False, **options: str) -> None:
    """Rows to one file per bucket, dealt by the key unless they are already (`dealt`)."""
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.mode("overwrite").bucketBy(buckets, key).options(path=path, **options).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")
