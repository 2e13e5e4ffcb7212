"""Sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet).  Column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with a declared schema.

    Quotes are doubled inside quoted fields (names may hold commas and quotes);
    empty fields read as NULL, never as NaN.
    """
    return (spark.read.schema(schema)
            .option("header", True).option("escape", '"').option("mode", "FAILFAST")
            .csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Overwrite or append.  Never write to a path the plan reads from."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def guarded_read(spark: SparkSession, path: str, schema: StructType,
                 fmt: str = "parquet") -> DataFrame:
    """A missing input yields an empty frame of the declared schema."""
    try:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("escape", '"')
        df = reader.format(fmt).load(path)
        df.schema  # resolves the path
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def row_count(df: DataFrame, column: str) -> int:
    """S3: pruned scan of one column and a count."""
    return df.select(column).count()
