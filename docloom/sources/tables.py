"""Table loading and the re-delivery rule shared by all queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(df: DataFrame, key: str, load_time: str) -> DataFrame:
    """One row per key: the one with the latest load time.

    Re-delivered rows repeat a key; ties on the load time are broken by the
    hash of the whole row, so the result does not depend on partitioning.
    ``max_by`` combines map-side, so one hot key costs one row per map task.
    Rows whose key is null are kept as one row.
    """
    cols = df.columns
    row = F.struct(*cols)
    best = F.max_by(row, F.struct(F.col(load_time), F.xxhash64(*[F.col(c).cast("string") for c in cols])))
    return df.groupBy(key).agg(best.alias("__row")).select("__row.*")
