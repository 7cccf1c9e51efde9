"""Relational database connector: options for Spark's own JDBC source and sink."""

from pyspark.sql import DataFrame, SparkSession

# URL scheme -> driver class.
DRIVERS = {
    "sqlite": "org.sqlite.JDBC",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgresql": "org.postgresql.Driver",
}
BATCH_ROWS = 2000


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 64,
    **extra: str,
) -> dict:
    """Reader options; with a partition column the scan is split over executors."""
    if not url.startswith("jdbc:"):
        raise ValueError("expected a JDBC URL, e.g. jdbc:postgresql://host:5432/loans")
    scheme = url.split(":", 2)[1]
    if scheme not in DRIVERS:
        raise ValueError(f"unknown database {scheme!r}; expected one of {sorted(DRIVERS)}")
    options = {
        "url": url,
        "dbtable": table,
        "driver": DRIVERS[scheme],
        "fetchsize": str(BATCH_ROWS),
        "batchsize": str(BATCH_ROWS),
    }
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return {**options, **extra}


def read_table(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", **extra: str) -> None:
    """`overwrite` empties the table and keeps its definition and indexes."""
    options = jdbc_options(url, table, **extra)
    if mode == "overwrite":
        options["truncate"] = "true"
    df.write.format("jdbc").options(**options).mode(mode).save()
