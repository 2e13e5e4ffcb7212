"""The bounded sample of rated documents on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATED_ROWS = 20_000  # documents a classifier is fitted on at most


def grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade per labelled document: 0 toxic, 1 of low quality, 2 good.

    Repeated labels count by the worst; NULL toxic counts as not toxic; rows
    without doc_id or quality are no rating.
    """
    return (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
            .select("doc_id", F.when(F.col("toxic") > 0, 0).when(F.col("quality") < 1, 1).otherwise(2)
                    .cast("int").alias("grade")))


def rated_sample(labels: DataFrame, rows: int = RATED_ROWS) -> DataFrame:
    """The ``rows`` ratings with the smallest hash of doc_id: fixed by the data, whatever their layout."""
    return grades(labels).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(rows)
