"""A registered query: the Spark form and, where SQL can say it, the SQL form."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marlspike.sources.readers import load_table

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None


def tables(spark: SparkSession, directory: str, *names: str) -> list[DataFrame]:
    return [load_table(spark, directory, name) for name in names]


def derive(spark: SparkSession, directory: str, sql: str, *names: str) -> DataFrame:
    """A table derived from the given ones by SQL that both engines read. The views it
    reads have names of their own, so that none of the caller's is replaced."""
    own = uuid.uuid4().hex
    for name in names:
        load_table(spark, directory, name).createOrReplaceTempView(f"{name}_{own}")
    listed = "|".join(names)
    return spark.sql(re.sub(rf"(?i)\b(FROM|JOIN)(\s+)({listed})\b", rf"\1\2\3_{own}", sql))


def sql_hash(key: str, seed: int) -> str:
    """functions.hashing.row_hash in SQL; key is a SQL text expression."""
    return f"('0x' || substr(md5({key} || '|{seed}'), 1, 15))::BIGINT"


def sql_case(value: str, mapping: dict, default: str = "0") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"(CASE {value} {whens} ELSE {default} END)"


def sql_steps(value: str, edges: list, codes: list, op: str = "<", null: str = "0") -> str:
    whens = " ".join(f"WHEN {value} {op} {e} THEN {c}" for e, c in zip(edges, codes))
    return f"(CASE WHEN {value} IS NULL THEN {null} {whens} ELSE {codes[-1]} END)"
