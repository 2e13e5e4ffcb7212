"""Equi-joins whose left side may hold a hot key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str],
                how: str = "left", salts: int = SALTS) -> DataFrame:
    """Join on ``keys`` (NULL equals NULL) with every key's left rows dealt over ``salts`` tasks.

    ``spread`` names left columns that differ among the rows of one key; the salt is their
    hash, so a repeated task deals the same rows again.  ``right`` holds few rows a key; each is
    copied to every salt.  Columns of both sides other than the keys must differ in name.
    """
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys],
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_r_salt"))
    same = [F.col("_salt") == F.col("_r_salt"), *[F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]]
    return (left.join(right, reduce(lambda a, b: a & b, same), how)
            .drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys]))
