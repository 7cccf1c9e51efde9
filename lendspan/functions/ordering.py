"""Global order statistics and top-n without putting a whole group into one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts into which a group is split for the first pass.
SALTS = 256


def top_n_per_group(df: DataFrame, groups: tuple, order: tuple, n: int, salt_by: tuple) -> DataFrame:
    """The first n rows of each group. `order` must leave no ties.

    A first pass keeps the first n of each of SALTS parts of a group, so no task gets a
    whole group; `salt_by` names columns that spread its rows.
    """
    def first(rows: DataFrame, keys: list) -> DataFrame:
        position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)))
    return first(first(salted, [*groups, "_salt"]).drop("_salt"), list(groups))


def quantile_position(count: Column, q: float) -> Column:
    """Fractional zero-based position of a quantile, with linear interpolation."""
    return (count - 1).cast("double") * q
