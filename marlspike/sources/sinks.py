"""Writing results. Paths, addresses and credentials always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame

FORMATS = ("parquet", "csv", "text", "jdbc", "orc", "json")


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, fetchsize: int = 1000
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetchsize),
    }


def save(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    files: int | None = None,
    partition_by: list[str] | None = None,
    **options: str,
) -> None:
    """Write df, replacing what was there.

    files asks for a number of output files. It shuffles at the sink, so the
    work above keeps its parallelism; leave it unset for large results.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt is one of {', '.join(FORMATS)}")
    if fmt == "text" and [t for _, t in df.dtypes] != ["string"]:
        raise ValueError("text output needs exactly one string column")
    if files:
        df = df.repartition(files)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "jdbc":
        writer.save()
    elif path:
        writer.save(path)
    else:
        raise ValueError("path is needed for file output")
