"""Stages that are committed one by one and taken up again where a run ended.

Each stage's table is published as a version (sources.versions) under a folder of its own,
with a mark made from the fingerprints of the inputs, the names and revisions of the stages
up to it. A stage whose latest version bears the mark of this run is read, not computed. So a run
after a failure starts at the stage that failed, and a change of an input or of a revision computes
again what depends on it. Readers of a stage see its version before until the new one is complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.sources.versions import latest_mark, publish, read_version

Stage = tuple[str, Callable[[Mapping[str, DataFrame]], DataFrame]]


def fingerprint(table: DataFrame) -> str:
    """Changes with the files behind a table as it was read: path, size and time of change.

    No column of the table is read and no file is listed on the driver. Files without rows
    do not count.
    """
    parts = ["file_path", "file_size", "file_modification_time"]
    files = table.select(*[F.col(f"_metadata.{p}").alias(p) for p in parts]).distinct()
    hashed = F.xxhash64(*parts).cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)), F.sum(hashed)).first()
    return f"{found[0]}:{found[1] or 0}"


def run_stages(
    spark: SparkSession,
    path: str,
    inputs: Mapping[str, DataFrame],
    stages: Sequence[Stage],
    revisions: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Each stage's table, computed and published under path, or as published before.

    inputs are tables as read from files. A stage's function gets the inputs and the tables
    of the stages before it, by name, and returns a DataFrame; errors propagate, with the
    stages before committed. revisions names a stage's revision: change it
    with the stage's code or parameters. One run at a time may use a path.
    """
    names = [*inputs, *[name for name, _ in stages]]
    if len(set(names)) < len(names):
        raise ValueError("inputs and stages need names of their own")
    unknown = set(revisions or {}) - {name for name, _ in stages}
    if unknown:
        raise ValueError(f"revisions of unknown stages: {', '.join(sorted(unknown))}")
    tables = dict(inputs)
    trail = [f"{name}={fingerprint(inputs[name])}" for name in sorted(inputs)]
    for name, build in stages:
        trail.append(f"{name}={(revisions or {}).get(name, '')}")
        mark = hashlib.sha256("\n".join(trail).encode()).hexdigest()
        target = f"{path}/{name}"
        if latest_mark(spark, target) != mark:
            publish(build(tables), target, mark)
        tables[name] = read_version(spark, target)
    return {name: tables[name] for name, _ in stages}
