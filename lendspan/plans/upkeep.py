"""Stored loan-month marts that follow a portfolio batch by batch.

`loan_months` holds one row per loan and month with the running sums, the bucket, the bucket
before and the balance, in partitions of month and loan bucket; the baseline, balance and
commercial marts are projections or small sums of it. `state` holds one row per loan with
what its later rows need: sums over its whole schedule, its first month, its columns.

A batch is summed per loan and month, and only loans it touches are computed anew, from their
stored rows and their state. Payments change a loan from their month on, schedule rows and loan
columns all of its months, since the average installment covers the whole schedule. Only
partitions in which such rows lie are written again. The schedule and payment rows of earlier
batches are never read.

Partitions are written under a new name each time, and a version then says which name is current
for which partition (see `sources.versions`). So a batch counts in all marts or in none, it can be
repeated after a failure, and readers of the version before are not disturbed. (Overwriting
partitions in place would delete them before their new rows are in place, one by one.)

A large batch is computed in shares of its loans, one after the other, each written to the new
partitions straight away. Each share filters the stored rows anew; in return the disk holds the
shuffle files of one share, and no second copy of the new rows.
"""

import posixpath
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import cents, dpd_bucket, money, no_cents
from ..operators import commercial
from ..operators.balance import SNAPSHOT_COLUMNS
from ..operators.delinquency import migration_of, vintage_of
from ..operators.ledger import FLOW_SUMS, LOAN_COLUMNS, by_loan, missed_installments, month_sums
from ..params import DEFAULTS, Params
from ..session import Scratch, dropping_shuffles
from ..sources.files import read_batch, stored_batches
from ..sources.versions import Versions, children, delete
from ..tables import Tables

BUCKETS = 16
# A batch is computed in shares of its loans, so that only the shuffle files of one share exist at a
# time: as many shares as keep a share at this many loan-months, a power of two up to the second number.
SHARE_ROWS = 2 << 20
MOST_SHARES = 8

_LOAN = {
    "customer_id": "long",
    "product_type": "string",
    "channel": "string",
    "origination_date": "date",
    "principal_nzd": "decimal(14,2)",
    "interest_rate_apr": "decimal(6,4)",
    "term_months": "int",
}
_MONTHS = {
    "loan_id": "long",
    **dict.fromkeys(FLOW_SUMS, "long"),
    "arrears": "long",
    "repaid": "long",
    "missed_inst": "double",
    "dpd_bucket": "string",
    "from_bucket": "string",
    "eop_balance": "decimal(18,2)",
    "known": "boolean",
    **_LOAN,
}
_STATE = {
    "loan_id": "long",
    "first_month": "date",
    "life_due": "long",
    "life_count": "long",
    "early": "long",
    "known": "boolean",
    **_LOAN,
}
# table -> its columns and the columns of its partitions
_TABLES = {
    "loan_months": (_MONTHS, {"month_end": "date", "loan_bucket": "int"}),
    "state": (_STATE, {"loan_bucket": "int"}),
}


def _partition(values: tuple) -> str:
    return "/".join(str(v) for v in values)


def _read(spark: SparkSession, folder: str, table: str, parts: dict[str, str]) -> DataFrame:
    """The given partitions of a stored table (partition -> name of the run that wrote it)."""
    columns, by = _TABLES[table]
    schema = ", ".join(f"{c} {k}" for c, k in {**columns, **by}.items())
    if not parts:
        return spark.createDataFrame([], schema)
    root = posixpath.join(folder, table)
    paths = [
        posixpath.join(root, f"run={run}", *[f"{c}={v}" for c, v in zip(by, part.split("/"), strict=True)])
        for part, run in parts.items()
    ]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*columns, *by)


def _write(rows: DataFrame, folder: str, table: str, run: str) -> None:
    columns, by = _TABLES[table]
    typed = rows.select(*[F.col(c).cast(k).alias(c) for c, k in {**columns, **by}.items()])
    # a partition of the table may be larger than a task can hold; Spark cuts it into several files
    # rows of a loan compress better side by side
    spread = typed.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, "loan_id")
    with dropping_shuffles(rows.sparkSession):
        spread.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(
            posixpath.join(folder, table, f"run={run}")
        )


def _in(parts: list[str], place: int, values: set[str]) -> list[str]:
    return [p for p in parts if p.split("/")[place] in values]


def _or(first: str, second: str) -> Column:
    return F.coalesce(F.col(first), F.col(second))


def apply_batch(
    spark: SparkSession,
    folder: str,
    batch: Tables,
    batch_id: str,
    params: Params = DEFAULTS,
    buckets: int = BUCKETS,
    content: dict | None = None,
) -> bool:
    """Bring the stored marts up to date with a batch; False if they have it already.

    `buckets` parts the loans and is fixed by the first batch. A loan row of an id that was seen
    before replaces its columns. Rows without a loan or a date, which the audit reports, are left
    out. `content` replaces what the newest version says, to start over.
    """
    versions = Versions(spark, folder)
    number, current = versions.latest()
    content = current if content is None else content
    if batch_id in content.get("batches", []):
        return False
    buckets = content.get("buckets", buckets)
    stored = content.get("parts", {table: {} for table in _TABLES})
    run = uuid.uuid4().hex
    with Scratch(spark) as scratch:
        delta = scratch.store(
            month_sums(batch).where("loan_id IS NOT NULL AND month_end IS NOT NULL").withColumn("loan_bucket", _bucket(buckets))
        )
        touched, held = _touched(spark, scratch, folder, delta, batch, buckets, stored)
        later = _later_parts(touched, stored)
        changed, new_count = _changed(scratch, _old_rows(_read(spark, folder, "loan_months", later), touched), delta)
        again = {p: r for p, r in stored["loan_months"].items() if p in changed}
        shares = _shares(new_count + _read(spark, folder, "loan_months", again).count())
        for turn in range(shares if changed else 0):
            own = _share(touched, shares, turn)
            old, kept = (_share(_read(spark, folder, "loan_months", parts), shares, turn) for parts in (later, again))
            new_rows = _new_rows(_old_rows(old, own), _share(delta, shares, turn), own, params)
            kept = _kept_rows(kept, own)
            _write(kept.unionByName(new_rows.select(*kept.columns)), folder, "loan_months", run)
        if held:
            written = _read(spark, folder, "loan_months", dict.fromkeys(changed, run))
            _write(_new_state(spark, folder, touched, written, held, stored), folder, "state", run)
    parts = {
        "loan_months": {**stored["loan_months"], **dict.fromkeys(sorted(changed), run)},
        "state": {**stored["state"], **dict.fromkeys(sorted(held), run)},
    }
    done = [*content.get("batches", []), batch_id]
    versions.commit(number + 1, {**content, "batches": done, "buckets": buckets, "parts": parts})
    return True


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("loan_id"), F.lit(buckets)).cast("int")


def _shares(count: int) -> int:
    """Number of shares in which `count` loan-months are written."""
    wanted = -(-count // SHARE_ROWS)
    return min(MOST_SHARES, 1 << max(0, wanted - 1).bit_length())


def _share(rows: DataFrame, shares: int, turn: int) -> DataFrame:
    """The rows of one share of the loans."""
    return rows if shares == 1 else rows.where(F.pmod(F.xxhash64("loan_id"), F.lit(shares)) == turn)


def _changed(scratch: Scratch, old: DataFrame, delta: DataFrame) -> tuple[set[str], int]:
    """The partitions in which rows of a batch lie, and at most how many rows that are."""
    key = ("month_end", "loan_bucket")
    found = scratch.store(old.select(*key).unionByName(delta.select(*key)).groupBy(*key).count()).collect()
    return {_partition(r[:2]) for r in found}, sum(r["count"] for r in found)


def _touched(
    spark: SparkSession, scratch: Scratch, folder: str, delta: DataFrame, batch: Tables, buckets: int, stored: dict
) -> tuple[DataFrame, set[str]]:
    """One row per loan of the batch: what is new, its state before, and `floor`, the first month to
    compute anew; and the loan buckets they lie in (at most `buckets`)."""
    flows = delta.groupBy("loan_id").agg(
        F.min("month_end").alias("since"),
        F.sum("due").alias("more_due"),
        F.sum("installments").alias("more_count"),
    )
    # of several rows of one id the greatest counts
    loans = (
        batch.loans.where("loan_id IS NOT NULL")
        .groupBy("loan_id")
        .agg(F.max(F.struct(*[F.col(c).cast(k).alias(c) for c, k in _LOAN.items()])).alias("new"))
        .select("loan_id", *[F.col(f"new.{c}").alias(f"new_{c}") for c in _LOAN], F.lit(True).alias("is_new"))
    )
    both = scratch.store(flows.join(loans, "loan_id", "full").withColumn("loan_bucket", _bucket(buckets)))
    held = {str(r[0]) for r in both.select("loan_bucket").distinct().collect()}
    state = _read(spark, folder, "state", {p: r for p, r in stored["state"].items() if p in held}).drop("loan_bucket")
    joined = both.join(state, "loan_id", "left")
    news, known = F.coalesce("is_new", F.lit(False)), F.coalesce("known", F.lit(False))
    # schedule rows change the average installment, loan columns the balance: all months change
    whole = news | (F.coalesce("more_count", F.lit(0)) > 0)
    column = lambda c: F.when(news, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
    return (
        scratch.store(
            joined.select(
                "loan_id",
                "loan_bucket",
                whole.alias("whole"),
                F.when(whole, F.least("first_month", "since")).otherwise(F.col("since")).alias("floor"),
                F.least("first_month", "since").alias("first_month"),
                (F.coalesce("life_due", no_cents()) + F.coalesce("more_due", no_cents())).alias("life_due"),
                (F.coalesce("life_count", no_cents()) + F.coalesce("more_count", no_cents())).alias("life_count"),
                F.coalesce("early", no_cents()).alias("early"),
                (news | known).alias("known"),
                *[column(c) for c in _LOAN],
            )
        ),
        held,
    )


def _later_parts(touched: DataFrame, stored: dict) -> dict[str, str]:
    """The stored partitions that may hold rows of the loans of a batch from their floor on."""
    floors = touched.where("floor IS NOT NULL").groupBy("loan_bucket").agg(F.min("floor").alias("floor"))
    first = {str(r.loan_bucket): str(r.floor) for r in floors.collect()}
    parts = {}
    for part, run in stored["loan_months"].items():
        month, bucket = part.split("/")
        if bucket in first and month >= first[bucket]:
            parts[part] = run
    return parts


def _old_rows(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """Those of stored rows that are of loans of a batch, from their floor on."""
    return rows.join(touched.select("loan_id", "floor"), "loan_id").where("month_end >= floor")


def _new_rows(old: DataFrame, delta: DataFrame, touched: DataFrame, params: Params) -> DataFrame:
    """The rows of the loans of a batch from their floor on, with the batch in.

    A month with payments alone is kept, so that a later installment finds them, but adds nothing
    and has no arrears. Where a loan is not computed as a whole, its first old row tells the
    sums before it.
    """
    visible = F.col("installments") > 0
    before = old.select(
        "loan_id",
        "month_end",
        *FLOW_SUMS,
        F.when(visible, F.col("arrears") - (F.col("due") - F.col("paid"))).alias("arrears_before"),
        F.when(visible, F.col("repaid") - F.col("principal")).alias("repaid_before"),
        F.when(visible, F.col("from_bucket")).alias("bucket_before"),
        visible.alias("was_visible"),
    )
    fresh = delta.select(
        "loan_id",
        "month_end",
        *FLOW_SUMS,
        no_cents().alias("arrears_before"),
        no_cents().alias("repaid_before"),
        F.lit(None).cast("string").alias("bucket_before"),
        F.lit(False).alias("was_visible"),
    )
    months = (
        before.unionByName(fresh)
        .groupBy("loan_id", "month_end")
        .agg(
            *[F.sum(c).alias(c) for c in FLOW_SUMS],
            F.max(F.when(F.col("was_visible"), F.struct("arrears_before", "repaid_before", "bucket_before"))).alias("before"),
        )
        .join(touched, "loan_id")
    )
    loan = Window.partitionBy("loan_id")
    upto = by_loan().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everywhere = by_loan().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    on_books = F.col("month_end") >= F.last_day("origination_date")
    # without an origination date no month is on the books, and none is early
    early = F.sum(F.when(F.coalesce(~on_books, F.lit(False)), F.col("principal")).otherwise(no_cents())).over(loan)
    base = F.when(~F.col("whole"), F.first("before", ignorenulls=True).over(everywhere))
    summed = months.select(
        "*",
        F.when(F.col("whole"), early).otherwise(F.col("early")).alias("early_now"),
        base.alias("base"),
        F.sum(F.when(visible, F.col("due") - F.col("paid")).otherwise(no_cents())).over(upto).alias("net_here"),
        F.sum(F.when(visible, F.col("principal")).otherwise(no_cents())).over(upto).alias("repaid_here"),
    )
    rows = summed.select(
        "*",
        F.when(visible, F.col("net_here") + F.coalesce("base.arrears_before", no_cents())).alias("arrears"),
        F.when(visible, F.col("repaid_here") + F.coalesce("base.repaid_before", no_cents())).alias("repaid"),
    ).withColumn("missed_inst", F.when(visible, missed_installments()))
    buckets = rows.withColumn(
        "dpd_bucket", F.when(visible, dpd_bucket(F.col("arrears"), F.col("missed_inst"), params.dpd_cutoffs))
    )
    earlier = F.last("dpd_bucket", ignorenulls=True).over(by_loan().rowsBetween(Window.unboundedPreceding, -1))
    left = F.greatest(cents("principal_nzd") - (F.col("repaid") - F.col("early_now")), no_cents())
    return buckets.select(
        *[c for c in _MONTHS if c not in ("from_bucket", "eop_balance")],
        F.when(visible, F.coalesce(earlier, F.col("base.bucket_before"))).alias("from_bucket"),
        F.when(visible & F.col("known") & on_books, money(left)).alias("eop_balance"),
        "month_end",
        "loan_bucket",
    )


def _kept_rows(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """Those rows of partitions to be written again that the batch leaves as they are."""
    floors = touched.select("loan_id", "floor")
    kept = rows.join(floors, "loan_id", "left").where("floor IS NULL OR month_end < floor")
    return kept.select(*rows.columns)


def _new_state(
    spark: SparkSession, folder: str, touched: DataFrame, written: DataFrame, held: set[str], stored: dict
) -> DataFrame:
    """The state of all loans in the buckets of a batch.

    `written` holds the partitions that the batch wrote, and so all months of a loan that was computed as a whole.
    """
    state = _read(spark, folder, "state", {p: r for p, r in stored["state"].items() if p in held})
    before = F.col("month_end") < F.last_day("origination_date")
    early = written.where(before).groupBy("loan_id").agg(F.sum("principal").alias("early_now"))
    fresh = (
        touched.join(early, "loan_id", "left")
        .withColumn("early", F.when(F.col("whole"), F.coalesce("early_now", no_cents())).otherwise(F.col("early")))
        .select(*state.columns)
    )
    return state.join(touched.select("loan_id"), "loan_id", "left_anti").select(*state.columns).unionByName(fresh)


def maintain_marts(
    spark: SparkSession, portfolio: str, folder: str, params: Params = DEFAULTS, buckets: int = BUCKETS
) -> list[str]:
    """Bring the marts in `folder` up to date with a stored portfolio; returns the batches applied."""
    return follow(
        spark, portfolio, folder, lambda batch, name, content: apply_batch(spark, folder, batch, name, params, buckets, content)
    )


def follow(
    spark: SparkSession, portfolio: str, folder: str, apply: Callable[[Tables, str, dict | None], bool]
) -> list[str]:
    """Apply to what is stored in `folder` the batches of a portfolio that it has not seen, in order.

    A reload of the portfolio, or a compaction that merged unseen batches, starts over from the
    stored tables: `apply` then gets the content to begin with.
    """
    known = stored_batches(spark, portfolio)
    _, content = Versions(spark, folder).latest()
    applied = []
    base = f"{known.origin}:{len(known.merged)}" if known.merged else known.origin
    seen = set(content.get("batches", []))
    if content.get("origin") != known.origin or not set(known.merged) <= seen:
        apply(read_batch(spark, known.base), base, {"origin": known.origin, "batches": list(known.merged)})
        applied.append(base)
        seen = set(known.merged)
    for batch_id, path in known.later.items():
        if batch_id not in seen and apply(read_batch(spark, path), batch_id, None):
            applied.append(batch_id)
    return applied


def clean_marts(spark: SparkSession, folder: str) -> None:
    """Delete rows that the newest version does not name; nothing may read older versions by then."""
    _, content = Versions(spark, folder).latest()
    for table in _TABLES:
        used = {f"run={run}" for run in content.get("parts", {}).get(table, {}).values()}
        for name in children(spark, posixpath.join(folder, table)):
            if name.startswith("run=") and name not in used:
                delete(spark, posixpath.join(folder, table, name))


def stored_loan_months(
    spark: SparkSession, folder: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The stored loan-months; a span of months reads the partitions of these months alone."""
    _, content = Versions(spark, folder).latest()
    parts = {
        part: run
        for part, run in content.get("parts", {}).get("loan_months", {}).items()
        if (since is None or part >= str(since)) and (until is None or part.split("/")[0] <= str(until))
    }
    return _read(spark, folder, "loan_months", parts).where("installments > 0")


def stored_marts(spark: SparkSession, folder: str, params: Params = DEFAULTS) -> dict[str, DataFrame]:
    """The named marts that loan-months give by projection or one sum, from the stored rows."""
    months = stored_loan_months(spark, folder)
    amounts = {"scheduled_amt": "due", "paid_amt_same_month": "paid", "arrears_amt": "arrears", "sched_principal": "principal"}
    plain = months.select("*", *[money(F.col(c)).alias(name) for name, c in amounts.items()])
    known = plain.where("known")
    rar = commercial.with_commercial(known, params)
    return {
        "mart_loan_due_paid": plain.select(
            "loan_id", F.col("month_end").alias("due_month_end"), "scheduled_amt", "paid_amt_same_month"
        ),
        "mart_loan_arrears": plain.select("loan_id", "month_end", "scheduled_amt", "paid_amt_same_month", "arrears_amt"),
        "mart_loan_dpd_bucket": plain.select("loan_id", "month_end", "arrears_amt", "missed_inst", "dpd_bucket"),
        "mart_portfolio_snapshot": known.select(*SNAPSHOT_COLUMNS),
        "mart_dpd_migration": migration_of(plain),
        "mart_vintage_60plus": vintage_of(known),
        "mart_principal_paid_by_month": plain.select("loan_id", "month_end", "sched_principal"),
        "mart_portfolio_snapshot_v2": known.select(*SNAPSHOT_COLUMNS, "eop_balance"),
        **{name: rar.select(*columns) for name, columns in commercial.MART_COLUMNS.items()},
    }


def register_stored_marts(spark: SparkSession, folder: str, params: Params = DEFAULTS) -> list[str]:
    """Register the stored marts under their names for spark.sql(...), instead of views that compute them."""
    marts = stored_marts(spark, folder, params)
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
    return list(marts)
