"""Scans, SQL over a frame, bounded fetch and the training-set sink."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def source(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table or view, addressed by its one- to three-part name."""
    return spark.table(name)


def read_training_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header line. Without a schema Spark reads the file twice to infer one.

    A schema names columns of the header in any order; a name that the header lacks and a cell that
    is not of its type raise an error.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    named = {field.name: field for field in wanted}
    header = reader.csv(path).columns
    if missing := [name for name in named if name not in header]:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    by_place = StructType([named.get(name, StructField(name, StringType())) for name in header])
    rows = reader.option("mode", "FAILFAST").option("enforceSchema", False).schema(by_place).csv(path)
    return rows.select(*named)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """All ORC files below ``path``."""
    return spark.read.orc(path)


def sql_on(df: DataFrame, query: str, name: str = "frame") -> DataFrame:
    """Run ``query`` with ``df`` visible under ``name``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(query)


def to_local(df: DataFrame, limit: int) -> pd.DataFrame:
    """First ``limit`` rows as pandas; the limit is mandatory so the driver stays bounded."""
    return df.limit(limit).toPandas()


def write_training_set(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("city_destination",)
) -> None:
    """Write Parquet by city. ``rebalance`` lets AQE split a hot city and merge tiny ones."""
    keys = list(partition_by)
    out = df.hint("rebalance", *keys) if keys else df.hint("rebalance")
    out.write.partitionBy(*keys).parquet(path)


def read_training_set(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read what ``write_training_set`` wrote, with the types and order of ``schema``.

    Without it, Spark guesses the types of partition values: cities named 007 would come back as numbers.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.read.schema(wanted).parquet(path).select(*wanted.names)
