"""Writers: day-partitioned marts, audit logs, versioned state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_days(df: DataFrame, path: str, day: str = "pub_date") -> None:
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def save_state(df: DataFrame, path: str, version: int) -> str:
    """State is written beside the older version, never over it."""
    target = f"{path}/version={version:010d}"
    df.write.mode("errorifexists").parquet(target)
    return target


def restore_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest version."""
    df = spark.read.parquet(path)
    newest = df.agg(F.max("version")).first()[0]  # one number
    return df.filter(F.col("version") == newest).drop("version")


def prune(df: DataFrame, at: str, today, days: int = 30) -> DataFrame:
    return df.filter(F.datediff(F.lit(today), F.col(at)) <= days)
