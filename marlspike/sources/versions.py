"""Tables that are replaced by publishing a new version beside the old ones.

A version is written to a folder of its own; only when that is complete is a row
with its number and folder added to the list of versions, which is one file. Readers
follow the list, so they see the old version or the new one, never a part; a write that
failed leaves a folder that no list names. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "version int, folder string, mark string"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, folder, mark) of what was published under path; no rows if nothing was."""
    try:
        return spark.read.schema(LISTED).parquet(f"{path}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTED)


def publish(df: DataFrame, path: str, mark: str | None = None) -> int:
    """Write df as the next version of the table at path; its number, from 1. The mark,
    such as a fingerprint of what it was made from, is listed with it."""
    spark = df.sparkSession
    latest = versions(spark, path).agg(F.max("version")).first()[0]
    version = (latest or 0) + 1
    folder = f"data/{version}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{folder}")
    listed = spark.createDataFrame([(version, folder, mark)], LISTED).coalesce(1)
    listed.write.mode("append").parquet(f"{path}/versions")
    return version


def latest_mark(spark: SparkSession, path: str) -> str | None:
    """The mark of the latest version at path; None if there is none."""
    found = versions(spark, path).orderBy(F.desc("version")).first()
    return found["mark"] if found else None


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at path as published under that number, the latest if none is given."""
    listed = versions(spark, path)
    if version is not None:
        listed = listed.where(F.col("version") == version)
    found = listed.orderBy(F.desc("version")).first()
    if found is None:
        raise ValueError(f"no version {'' if version is None else version} at {path}".replace("  ", " "))
    return spark.read.parquet(f"{path}/{found['folder']}")
