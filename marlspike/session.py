"""Session settings and the two ways a plan is allowed to be cut."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

# Settings that matter for correctness (time zone) or for skewed input (AQE).
# Sizes and partition counts belong to the cluster, so they are not set here.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}

# Of sessions in local mode without the setting.
LOCAL_DIR = "/tmp/checkpoints"


def build_session(app: str = "marlspike", master: str | None = None, **conf: str) -> SparkSession:
    """A session with RECOMMENDED settings; conf entries win (use _ for dots)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local-mode session, whose executor is this machine, may leave it unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return LOCAL_DIR


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/marlspike/{app}/{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, label: str = "table", partition_by: list[str] | None = None
) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    The written table survives a lost executor, gives every reader the same
    rows (row ids and random values are fixed by it), and later passes read
    only the columns they use.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has at most that many rows. Reads no column that the row
    count does not need, and partitions only until it has seen enough."""
    return len(df.select(F.lit(1)).take(rows + 1)) <= rows


def localize(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """(df as a driver-side relation, True) when it has at most max_rows rows,
    else (df unchanged, False).

    This is the size check in front of every small-side join: a local relation
    has an exact size, so Spark broadcasts it; a larger table stays distributed
    and joins by shuffle. The check reads partitions only until it has enough.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return df, False
    columns = {c: [r[i] for r in rows] for i, c in enumerate(df.columns)}
    held = pa.table(columns, schema=to_arrow_schema(df.schema))
    return df.sparkSession.createDataFrame(held, schema=df.schema), True
