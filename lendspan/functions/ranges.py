"""Exact running totals over a global order, without putting the rows into one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch


def in_ranges(df: DataFrame, order: tuple[Column, ...], scratch: Scratch) -> DataFrame:
    """The rows, range-partitioned by `order` once and stored with their range as `_range`.

    There are as many ranges as shuffle partitions. Spark samples the cuts, so ranges are
    of about even size; the stored number stays the same whatever is computed anew later.
    An order that leaves no ties also splits the rows of a frequent value.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.store(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))


def range_offsets(ranged: DataFrame, totals: tuple[str, ...]) -> DataFrame:
    """Per range, the totals of all ranges before it: one row per range, so it may be broadcast."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in totals])
    return sums.select(
        "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_offset_{c}") for c in totals]
    )


def running_totals(ranged: DataFrame, order: tuple[Column, ...], totals: tuple[str, ...]) -> DataFrame:
    """`<name>_before`: the totals of all rows that come earlier in `order`, for each row.

    `ranged` comes from `in_ranges` under the same order; rows that tie are taken in any
    order. Windows run within a range, and the offsets add what lies before it.
    """
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.col(f"`{c}`") for c in ranged.columns if c != "_range"]
    return (
        ranged.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"_within_{c}") for c in totals])
        .join(F.broadcast(range_offsets(ranged, totals)), "_range")
        .select(*columns, *[(F.col(f"_within_{c}") + F.col(f"_offset_{c}")).alias(f"{c}_before") for c in totals])
    )
