"""A stored layout for portfolios that many marts are computed from.

The monthly flows and the loans are written once, bucketed by loan. Every later mart
then joins and runs its loan windows without a shuffle on loan_id, and none of them
reads the schedule and payment rows again.
"""

import posixpath
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame

from ..operators.ledger import LOAN_COLUMNS, monthly_flows
from ..tables import Tables


def _write_bucketed(df: DataFrame, folder: str, name: str, order: tuple, buckets: int) -> DataFrame:
    path = posixpath.join(folder, name)
    (
        # one task per bucket, so that each bucket is one file
        df.repartition(buckets, "loan_id")
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "loan_id")
        .sortBy(*order)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def bucket_by_loan(t: Tables, buckets: int, folder: str, prefix: str | None = None) -> Tables:
    """Tables that read the stored layout; `buckets` sets the parallelism of all later marts.

    The files stay in `folder`, which all executors share, for as long as the tables are used.

    Flows hold at most one row per loan and month, so a loan with very many raw rows
    does not fill a bucket.
    """
    prefix = prefix or f"lendspan_{uuid.uuid4().hex[:12]}"
    return replace(
        t,
        flows=_write_bucketed(
            monthly_flows(t), folder, f"{prefix}_monthly_flows", ("loan_id", "month_end"), buckets
        ),
        loans=_write_bucketed(
            t.loans.select("loan_id", *LOAN_COLUMNS, "status"), folder, f"{prefix}_loans", ("loan_id",), buckets
        ),
    )
