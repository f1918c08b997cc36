"""Shared reading helper."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str | list[str], schema: StructType | str,
                  fmt: str = "parquet", **options: str) -> DataFrame:
    """The table at ``path`` (or paths, or nothing) under an explicit schema; no rows when
    nothing is there yet."""
    if path:
        try:
            return spark.read.format(fmt).schema(schema).options(**options).load(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)
