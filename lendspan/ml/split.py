"""Repeatable stratified split with an exact share per class."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULTS, Params
from ..session import materialise

CELL_BITS = 16


def stratified_split(df: DataFrame, label: str, params: Params = DEFAULTS) -> DataFrame:
    """Add `is_test`: the first share of each class in hash order of (loan_id, month_end).

    Rows are counted in 65,536 hash cells per class. Only the cell in which the share
    ends is ranked row by row, so no task ever holds a whole class. `df` is read twice
    by jobs that run now and once for every read of the result; pass a materialised frame.
    """
    hashed = F.xxhash64("loan_id", "month_end", F.lit(params.split_seed))
    keyed = df.withColumn("_hash", hashed).withColumn(
        "_cell", F.shiftrightunsigned("_hash", 64 - CELL_BITS)
    )
    in_class = Window.partitionBy(label).orderBy("_cell")
    quota = F.ceil(F.col("_class_rows") * F.lit(params.test_share)).cast("long")
    cells = (
        keyed.groupBy(label, "_cell")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "*",
            F.sum("_rows").over(in_class).alias("_upto"),
            F.sum("_rows").over(Window.partitionBy(label)).alias("_class_rows"),
        )
    )
    before = F.col("_upto") - F.col("_rows")
    last_cell = cells.where((before < quota) & (quota <= F.col("_upto"))).select(
        label, "_cell", (quota - before).alias("_needed")
    )  # one row per class
    place = F.row_number().over(Window.partitionBy(label).orderBy("_hash", "loan_id", "month_end"))
    position = F.struct("_cell", "_hash", "loan_id", "month_end")
    last_row = (
        keyed.select(label, "_cell", "_hash", "loan_id", "month_end")
        .join(F.broadcast(last_cell), [label, "_cell"])
        .withColumn("_place", place)
        .where(F.col("_place") == F.col("_needed"))
        .select(label, position.alias("_last"))
    )  # one row per class
    last_row = materialise(last_row)
    return keyed.join(F.broadcast(last_row), label, "left").select(
        *df.columns, F.coalesce(position <= F.col("_last"), F.lit(False)).alias("is_test")
    )
