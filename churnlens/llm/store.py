"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from churnlens.session import ensure_checkpoint_dir


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder name under the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{tag}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs one file read, not a recompute.
    """
    path = folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder as a table bucketed by ``key``, so that a later grouping by
    that key reads it in place instead of shuffling it.  Every task writes only the
    buckets that it holds."""
    spark = df.sparkSession
    name = f"{tag}_{uuid.uuid4().hex}"
    (df.write.bucketBy(shuffle_partitions(spark), key).option("path", folder(spark, tag))
     .saveAsTable(name))
    return spark.table(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
