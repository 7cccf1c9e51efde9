"""Small dimension tables given as inline rows."""

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CHANNELS, MACRO_MONTHLY, PRODUCTS

# Product and channel dimension rows.
PRODUCT_ROWS = [
    ("Personal", False, "High"),
    ("Auto", True, "Medium"),
    ("Mortgage", True, "Low"),
    ("SME", False, "High"),
]
CHANNEL_ROWS = [
    ("Online", "Direct"),
    ("Branch", "Direct"),
    ("Broker", "Indirect"),
    ("Partner", "Indirect"),
]


def products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCT_ROWS, PRODUCTS)


def channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNEL_ROWS, CHANNELS)


def macro_monthly(spark: SparkSession) -> DataFrame:
    """The optional macro dimension: typed and empty until a source is loaded."""
    return spark.createDataFrame([], MACRO_MONTHLY)
