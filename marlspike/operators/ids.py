"""Dense row ids and running sums over a global order, without one big task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.session import materialize

PART, POS = "_part", "_pos"


def place_in_order(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """Written copy of df with _part (range partition in the given order) and
    _pos (0-based place inside it).

    Writing fixes the range bounds, so a lost executor cannot move a row
    between the pass that counts and the pass that numbers.
    """
    spot = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    numbered = ranged.withColumn("_spot", spot).withColumns(
        {
            PART: F.shiftright("_spot", 33).cast("int"),
            POS: F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    return materialize(numbered.drop("_spot"), "ordered")


def _offsets(per_part: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per range partition, the sum of each column over earlier partitions
    (_before_*) and over all of them (_total_*).

    One row per partition, so the single-task windows and the broadcast are
    bounded by the partition count.
    """
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in cols]
    total = [F.sum(c).over(Window.partitionBy()).alias(f"_total_{c}") for c in cols]
    return F.broadcast(per_part.select(PART, *before, *total))


def _numbered(placed: DataFrame, id_col: str) -> DataFrame:
    sizes = placed.groupBy(PART).agg((F.max(POS) + 1).alias("n"))
    number = (F.col("_before_n") + F.col(POS) + 1).alias(id_col)
    held = [c for c in placed.columns if c not in (PART, POS)]
    return placed.join(_offsets(sizes, ["n"]), PART).select(*held, number)


def number_rows(df: DataFrame, order_by: Sequence[Column], id_col: str) -> DataFrame:
    """Ids 1..n of rows that the order tells apart. The rows themselves are
    sorted and written, so this suits narrow tables such as aggregates."""
    return _numbered(place_in_order(df, order_by), id_col)


def assign_ids(
    df: DataFrame,
    order_by: str | Sequence[str],
    desc: bool = False,
    id_col: str = "id",
    as_string: bool = False,
) -> DataFrame:
    """Ids 1..n in the order of order_by.

    Rows are dealt by ranges of the order, numbered inside their range and moved up by
    the sizes of the ranges before it. Ties are split by a row hash and a stored
    number, so that a value held by a large share of the rows is spread over ranges;
    which of several equal rows gets which id does not matter.
    """
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    order = [F.desc(n) if desc else F.asc(n) for n in names]
    held = df.columns
    tied = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
    numbered = number_rows(tied, [*order, F.xxhash64(*[f"`{c}`" for c in held]), F.col("_tie")], "_id")
    return _with_id(numbered, held, id_col, as_string)


def _with_id(numbered: DataFrame, held: Sequence[str], id_col: str, as_string: bool) -> DataFrame:
    number = F.col("_id").cast("string") if as_string else F.col("_id")
    return numbered.select(*[F.col(f"`{c}`") for c in held if c != id_col], number.alias(id_col))


def running_sums(df: DataFrame, order_by: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """Add run_<c>, the cumulative sum over a global order that identifies each
    row, and all_<c>, the sum over every row, for each column."""
    placed = place_in_order(df, order_by)
    totals = placed.groupBy(PART).agg(*[F.sum(c).alias(c) for c in cols])
    inside = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    running = [(F.sum(c).over(inside) + F.col(f"_before_{c}")).alias(f"run_{c}") for c in cols]
    whole = [F.col(f"_total_{c}").alias(f"all_{c}") for c in cols]
    return placed.join(_offsets(totals, cols), PART).select(*df.columns, *running, *whole)
