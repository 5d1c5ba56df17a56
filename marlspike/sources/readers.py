"""Scans: Parquet, text lines, delimited records, LibSVM, stop words."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_table(
    spark: SparkSession, directory: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet table; a given schema is checked by name and cast."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return bind_schema(df, schema) if schema is not None else df


def read_parquet(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A Parquet folder, spread over a number of partitions when one is given."""
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table with fewer files than cores, moved to every core by key;
    a table of more files is left where it is. For work that is heavy per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if len(df.inputFiles()) < cores else df


def read_lines(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", column)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "::"
) -> DataFrame:
    """Typed records split by a separator of one or more characters."""
    return spark.read.csv(path, schema=schema, sep=sep)


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """(label double, features sparse vector). Giving the width saves a pass."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One column `token` of distinct stop words, one per input line."""
    return read_lines(spark, path, "token").where(F.col("token") != "").distinct()


def bind_schema(
    df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Select and cast by name; rename maps source names to schema names.

    A missing column is an error. Text that does not parse becomes null.
    """
    source = {new: old for old, new in (rename or {}).items()}
    wanted = {field.name: source.get(field.name, field.name) for field in schema.fields}
    missing = sorted(set(wanted.values()) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    columns = []
    for field in schema.fields:
        held = F.col(f"`{wanted[field.name]}`")
        same = df.schema[wanted[field.name]].dataType == field.dataType
        columns.append((held if same else held.try_cast(field.dataType)).alias(field.name))
    return df.select(*columns)
