
from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from lendspan import Params, Tables, schemas  # noqa: E402
from lendspan.functions.columns import bucket_rank  # noqa: E402
from lendspan.ml import model as ml  # noqa: E402
from lendspan.ml.split import stratified_split  # noqa: E402
from lendspan.operators import amortise as amort  # noqa: E402
from lendspan.operators import balance, commercial, delinquency, ledger, measures, propensity, risk, scores  # noqa: E402
from lendspan.operators.audit import integrity_audit  # noqa: E402
from lendspan.plans import audit_upkeep, registry, reports, upkeep  # noqa: E402
from lendspan.session import materialise, session_scratch  # noqa: E402
from lendspan.sources import files  # noqa: E402
from lendspan.sources.bridge import load_bridged  # noqa: E402
from oracle.sql import ORACLES  # noqa: E402

# The test tables span 1995 to 2001 and their last month is thin, so dates and the
# segment size differ from the defaults; the SQL checks use the same values.
PARAMS = Params(
    min_segment_loans=2,
    migration_month=date(1998, 12, 31),
    vintage_from=date(1996, 1, 31),
    vintage_to=date(1997, 12, 31),
)
AS_OF = date(1999, 6, 15)


def presentable(df: DataFrame) -> DataFrame:
    """Decimals as double and integers as long, so both engines give the same types."""
    casts = {T.DecimalType: "double", T.IntegerType: "long", T.FloatType: "double"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(casts[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in casts
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rule_score() -> Column:
    """A score by formula for the queries that read scores and are checked with SQL."""
    number = lambda c: c.cast("double")
    return (
        F.lit(0.4) * (number(bucket_rank(F.col("dpd_bucket"))) / F.lit(4.0))
        + F.lit(0.3) * (F.lit(1.0) - F.col("roll3_paid_full_rate"))
        + F.lit(0.3) * (number(850 - F.col("credit_score")) / F.lit(400.0))
    )


def rule_scores(t: Tables) -> DataFrame:
    return risk.labelled_features(t).select(
        "loan_id", "month_end", rule_score().alias("risk_score"), risk.LABEL
    )


def joined_watchlist(t: Tables) -> DataFrame:
    """The watchlist as users run it: the snapshot joined with a table of scores."""
    return risk.risk_watchlist(balance.portfolio_snapshot_v2(t), rule_scores(t))


def rule_watchlist(t: Tables) -> DataFrame:
    """The same rows cut from one ledger, for the queries that rank them."""
    return risk.rolling_months(t).select(
        "month_end", "loan_id", "product_type", "channel", "dpd_bucket", "eop_balance", rule_score().alias("risk_score")
    )


def _data_key(t: Tables) -> tuple:
    """What is made once in a session belongs to these files."""
    return (t.loans.sparkSession.sparkContext.applicationId, *sorted(t.schedule.inputFiles()))


_CUBES: dict[tuple, DataFrame] = {}


def _cube(t: Tables) -> DataFrame:
    """The stored cube of a portfolio, made once in a session."""
    key = _data_key(t)
    if key not in _CUBES:
        months = risk.rolling_months(t, all_loans=True, columns=(*risk.CUSTOMER_COLUMNS, "region"))
        # stored narrow and before the commercial columns, since a cube is two passes over them
        stored = materialise(
            months.select(
                *measures.CELL,
                "dpd_bucket",
                "principal_nzd",
                "interest_rate_apr",
                ledger.eop_cents().alias("eop_balance"),
                rule_score().alias("risk_score"),
            )
        )
        scored = commercial.with_commercial(stored, base="principal_base", in_cents=True)
        _CUBES[key] = materialise(measures.measure_cube(scored))
        session_scratch(stored.sparkSession).drop(stored)
    return _CUBES[key]


def _measures(t: Tables, *by: str) -> DataFrame:
    return measures.cube_measures(_cube(t), by)


def _evaluation(t: Tables) -> DataFrame:
    return scores.evaluate_scores(rule_scores(t), risk.LABEL)


def _split_counts(t: Tables) -> DataFrame:
    rows = stratified_split(materialise(risk.training_set(t)), risk.LABEL)
    return rows.groupBy(risk.LABEL, "is_test").agg(F.count(F.lit(1)).alias("rows"))


def _split_rows(t: Tables) -> DataFrame:
    """Every labelled row with its class, to show that a split loses and repeats none."""
    rows = stratified_split(materialise(risk.training_set(t)), risk.LABEL)
    return rows.groupBy("loan_id", "month_end", risk.LABEL).agg(F.count("is_test").alias("times"))


def _model_gradient(t: Tables) -> DataFrame:
    rows = materialise(risk.training_set(t))
    found = ml.fit_gradient(ml.fit_risk_model(rows), rows)
    # adding 0 turns a rounded -0.0 into 0.0
    return found.select("feature", (F.round("gradient", 6) + F.lit(0.0)).alias("gradient"))


def _balance_at_quarters(t: Tables) -> DataFrame:
    quarters = t.loans.sparkSession.range(12).select(
        F.add_months(F.lit(date(1996, 3, 31)), 3 * F.col("id").cast("int")).alias("month_end")
    )
    return balance.balance_at(balance.balance_intervals(t), quarters)


def _encoded(t: Tables) -> DataFrame:
    rows = materialise(risk.training_set(t))
    named = ml.named_features(ml.fit_encoder(rows), rows)
    return named.select(*[F.col(f"`{c}`").alias(c.replace("=", "__").lower()) for c in named.columns])


def _annuity(t: Tables) -> DataFrame:
    payment = amort.annuity_payment(
        F.col("principal_nzd"), F.col("interest_rate_apr"), F.col("term_months")
    )
    return t.loans.select("loan_id", F.round(payment.cast("decimal(28,8)"), 2).alias("payment"))


def _propensity(t: Tables) -> DataFrame:
    return propensity.risk_propensity(t).select(
        "loan_id", F.round("p_late", 6).alias("p_late"), F.round("p_miss", 6).alias("p_miss")
    )


def _pay_probability(t: Tables) -> DataFrame:
    return propensity.pay_probability(t).select(
        "loan_id", F.round("pay_probability", 6).alias("pay_probability")
    )


def _registered_mart_counts(t: Tables) -> DataFrame:
    """Rows of marts that are read back by name after registration."""
    spark = t.loans.sparkSession
    registry.register_marts(spark, t)
    names = ("mart_portfolio_snapshot", "mart_portfolio_snapshot_v2", "mart_dpd_migration", "comm_rar_monthly")
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{n}' AS mart, count(*) AS row_count FROM {n}" for n in names)
    )


def _folder(t: Tables, name: str) -> str:
    return f"{session_scratch(t.loans.sparkSession).root}/{name}-{uuid.uuid4().hex}"


def _csv_round_trip(t: Tables) -> DataFrame:
    """Payments written as CSV and read back with their types."""
    folder = _folder(t, "csv")
    files.write_csv(t.payments, folder)
    return files.read_csv(t.payments.sparkSession, folder, schemas.PAYMENTS)


def _reload_then_append(t: Tables) -> DataFrame:
    """Rows of each table after a load, a reload of the folder from itself and an append."""
    spark, folder = t.loans.sparkSession, _folder(t, "portfolio")
    files.reload_portfolio(t, folder)
    files.reload_portfolio(files.read_parquet_portfolio(spark, folder), folder)
    files.append_portfolio(t, folder)
    return reports.row_counts(files.read_parquet_portfolio(spark, folder))


def _parts_of(t: Tables) -> list[Tables]:
    """The portfolio as a first load and a batch of late loans, late and skipped schedule rows and late payments."""
    loan = F.col("loan_id")
    later = {
        "loans": loan % 7 == 3,
        "schedule": (F.col("due_date") >= date(1997, 6, 1)) | (loan % 5 == 0),
        "payments": F.col("payment_date") >= date(1997, 3, 1),
        **dict.fromkeys(("customers", "products", "channels", "collections", "macro"), F.lit(False)),
    }
    return [
        Tables(**{name: getattr(t, name).where(late == second) for name, late in later.items()})
        for second in (False, True)
    ]


_KEPT_UP: dict[tuple, str] = {}


def _kept_up(t: Tables) -> tuple[SparkSession, str]:
    """Marts that followed a stored portfolio through a first load and a batch that was sent twice."""
    spark = t.loans.sparkSession
    if _data_key(t) not in _KEPT_UP:
        portfolio, marts = _folder(t, "portfolio"), _folder(t, "marts")
        first, second = _parts_of(t)
        files.reload_portfolio(first, portfolio)
        upkeep.maintain_marts(spark, portfolio, marts, buckets=1)  # the test tables fill one bucket
        for _ in range(2):
            files.append_portfolio(second, portfolio, "second")
            upkeep.maintain_marts(spark, portfolio, marts)
        _KEPT_UP[_data_key(t)] = marts
    return spark, _KEPT_UP[_data_key(t)]


def _maintained(t: Tables) -> DataFrame:
    """The snapshot with balances, read from the marts that were kept up batch by batch."""
    return upkeep.stored_marts(*_kept_up(t))["mart_portfolio_snapshot_v2"]


def _stored_mart_totals(t: Tables) -> DataFrame:
    """Rows and one total of stored marts that are read by name."""
    spark, marts = _kept_up(t)
    upkeep.register_stored_marts(spark, marts)
    totals = {
        "mart_loan_due_paid": "sum(paid_amt_same_month)",
        "mart_loan_arrears": "sum(arrears_amt)",
        "mart_loan_dpd_bucket": "sum(CASE WHEN missed_inst >= 1 THEN arrears_amt END)",
        "mart_dpd_migration": "sum(CASE WHEN from_bucket < to_bucket THEN loan_count END)",
        "mart_vintage_60plus": "sum(bad_60plus_cnt)",
        "mart_principal_paid_by_month": "sum(sched_principal)",
        "comm_rar_monthly": "sum(rar_profit_est)",
    }
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS mart, count(*) AS row_count, CAST({total} AS DOUBLE) AS total FROM {name}"
            for name, total in totals.items()
        )
    )


def _maintained_audit(t: Tables) -> DataFrame:
    """The audit of a portfolio that was counted as it came in, a batch sent twice among it."""
    spark, folder = t.loans.sparkSession, _folder(t, "audit")
    first, second = _parts_of(t)
    for name, batch in (("first", first), ("second", second), ("second", second)):
        audit_upkeep.apply_audit_batch(spark, folder, batch, name, buckets=4)
    return audit_upkeep.maintained_audit(spark, folder)


def _saved_scores(t: Tables) -> DataFrame:
    """Scores that replace an earlier, different table of scores."""
    target = _folder(t, "scores")
    scored = rule_scores(t)
    files.save_scores(scored.limit(5), target)
    files.save_scores(scored, target)
    return files.read_scores(t.loans.sparkSession, target)


def _richest_snapshot(t: Tables) -> DataFrame:
    registry.register_marts(t.loans.sparkSession, t)
    return balance.richest_snapshot(t.loans.sparkSession)


# Given coefficients, so that scoring can be checked with SQL.
COEFFICIENTS = {
    "credit_score": -0.004,
    "roll3_paid_full_rate": -1.5,
    "roll3_missed_cnt": 0.7,
    "interest_rate_apr": 2.0,
    "dpd_bucket=DPD_60_89": 0.9,
    "employment_type=Student": 0.25,
}
INTERCEPT = 1.25


def _scores_of_coefficients(t: Tables) -> DataFrame:
    rows = materialise(risk.training_set(t))
    named = ml.named_features(ml.fit_encoder(rows), rows)
    scored = ml.score_with_coefficients(named, COEFFICIENTS, INTERCEPT)
    return scored.select("loan_id", "month_end", F.round("risk_score", 9).alias("risk_score"))


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    # baseline marts
    "month_ends": delinquency.month_ends_of,
    "mart_loan_due_paid": delinquency.loan_due_paid,
    "mart_loan_due_paid_as_of": lambda t: delinquency.loan_due_paid(t, AS_OF),
    "mart_loan_arrears": delinquency.loan_arrears,
    "mart_loan_dpd_bucket": delinquency.loan_dpd_bucket,
    "mart_loan_dpd_bucket_as_of": lambda t: delinquency.loan_dpd_bucket(t, as_of=AS_OF),
    "mart_portfolio_snapshot": delinquency.portfolio_snapshot,
    "mart_dpd_migration": delinquency.dpd_migration,
    "mart_vintage_60plus": delinquency.vintage_60plus,
    "mart_principal_paid_by_month": balance.principal_paid_by_month,
    "mart_balance_eop": balance.balance_eop,
    "balance_intervals": balance.balance_intervals,
    "balance_at_quarters": _balance_at_quarters,
    "mart_portfolio_snapshot_v2": balance.portfolio_snapshot_v2,
    "registered_mart_counts": _registered_mart_counts,
    "maintain_marts": _maintained,
    "stored_mart_totals": _stored_mart_totals,
    # risk
    "risk_pay_behaviour_monthly": risk.pay_behaviour_monthly,
    "risk_features_3m": risk.features_3m,
    "risk_labels_60p_3m": risk.labels_60p_3m,
    "recent_features": risk.recent_features,
    "recent_labels": risk.recent_labels,
    "training_set": risk.training_set,
    "encoded_features": _encoded,
    "stratified_split_counts": _split_counts,
    "stratified_split_rows": _split_rows,
    "score_evaluation": _evaluation,
    "model_gradient": _model_gradient,
    "model_scores": lambda t: ml.train_risk_model(t).scores,
    "model_metrics": lambda t: ml.train_risk_model(t).metrics,
    "risk_watchlist": joined_watchlist,
    "watchlist_top": lambda t: scores.rank_watchlist(rule_watchlist(t), 100),
    "watchlist_top_by_month": lambda t: scores.rank_watchlist_by_month(rule_watchlist(t), 10),
    "scores_of_coefficients": _scores_of_coefficients,
    # commercial
    "comm_interest_income_monthly": commercial.interest_income_monthly,
    "comm_nii_monthly": commercial.nii_monthly,
    "comm_expected_loss": commercial.expected_loss,
    "comm_rar_monthly": commercial.rar_monthly,
    "comm_rar_monthly_eop": lambda t: commercial.rar_monthly(t, balance="eop"),
    "segment_profitability": commercial.segment_profitability,
    "pricing_effectiveness": commercial.pricing_effectiveness,
    # analysis and reports
    "monthly_rates": reports.monthly_rates,
    "worst_segments": lambda t: reports.worst_segments(t, PARAMS),
    "migration_matrix": lambda t: reports.migration_matrix(t, params=PARAMS),
    "vintage_curves": lambda t: reports.vintage_curves(t, params=PARAMS),
    "dpd_by_product": reports.dpd_by_product,
    "dpd_by_product_pivot": reports.dpd_by_product_pivot,
    "migration_total": reports.migration_total,
    "migration_total_loans": lambda t: reports.migration_total(t, "loans"),
    "migration_total_pivot": lambda t: reports.migration_total_pivot(t, "loans"),
    "vintage_average": reports.vintage_average,
    "score_histogram": lambda t: scores.score_histogram(rule_scores(t)),
    "score_box_plot": lambda t: scores.score_box_plot(rule_scores(t)),
    "score_statistics": lambda t: scores.score_statistics(rule_scores(t), risk.LABEL),
    "commercial_trend": reports.commercial_trend,
    "dashboard_trend": reports.dashboard_trend,
    "latest_month_split": reports.latest_month_split,
    "portfolio_overview": reports.portfolio_overview,
    "latest_month_kpis": reports.latest_month_kpis,
    "top_products": reports.top_products,
    "top_channels": reports.top_channels,
    "last_months": reports.last_months,
    "top_risk_loans": lambda t: scores.top_risk_loans(rule_watchlist(t)),
    "product_performance": reports.product_performance,
    "commercial_totals": reports.commercial_totals,
    "portfolio_size": reports.portfolio_size,
    "score_vs_balance": lambda t: scores.score_vs_balance(rule_watchlist(t)),
    "row_counts": reports.row_counts,
    "first_rows": lambda t: reports.first_rows(commercial.rar_monthly(t)),
    "delinquency_by_region": reports.delinquency_by_region,
    # measures and glossary
    "measures_by_month": lambda t: _measures(t, "month_end"),
    "measures_by_product_channel": lambda t: _measures(t, "product_type", "channel"),
    "measures_total": lambda t: _measures(t),
    "migration_rates": lambda t: delinquency.migration_rates(delinquency.dpd_migration(t)),
    "roll_rates": lambda t: delinquency.roll_rates(delinquency.dpd_migration(t)),
    "transition_classes": lambda t: delinquency.transition_classes(delinquency.dpd_migration(t)),
    # loan schedules and propensity
    "annuity_payment": _annuity,
    "amortise": lambda t: amort.amortise(t.loans),
    "amortise_uncapped": lambda t: amort.amortise(t.loans, capped=False),
    "risk_propensity": _propensity,
    "pay_probability": _pay_probability,
    # base tables
    "csv_round_trip": _csv_round_trip,
    "reload_then_append": _reload_then_append,
    "saved_scores": _saved_scores,
    "richest_snapshot": _richest_snapshot,
    "integrity_audit": integrity_audit,
    "maintained_audit": _maintained_audit,
    "fct_loans": lambda t: t.loans,
    "dim_customers": lambda t: t.customers,
    "fct_schedule": lambda t: t.schedule,
    "fct_payments": lambda t: t.payments,
    "fct_collections": lambda t: t.collections,
}

# The others run a job while they are built: they write a shared intermediate or fit a model.
QUERIES_WITH_LAZY_PLANS = sorted(
    set(BUILDERS)
    - {
        "csv_round_trip",
        "reload_then_append",
        "maintain_marts",
        "stored_mart_totals",
        "maintained_audit",
        "saved_scores",
        "scores_of_coefficients",
        "encoded_features",
        "stratified_split_counts",
        "stratified_split_rows",
        "score_evaluation",
        "score_box_plot",
        "score_histogram",
        "score_statistics",
        "measures_by_month",
        "measures_by_product_channel",
        "measures_total",
        "model_gradient",
        "model_scores",
        "model_metrics",
    }
)


def _with_shared_folder(spark: SparkSession) -> SparkSession:
    """Name a folder for intermediate tables where neither the session nor its user did."""
    context = spark.sparkContext
    if not (context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark


def _query(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: presentable(build(load_bridged(_with_shared_folder(spark), sf_dir)))


def _corpus_query(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(_with_shared_folder(spark), sf_dir)


CORPUS_QUERIES: dict[str, Callable] = {}
CORPUS_ORACLES: dict[str, str] = {}
# The corpus operators can be left out; any other missing module is an error.
try:
    import lendspan.llm.queries as corpus_queries

    CORPUS_QUERIES |= corpus_queries.QUERIES
    CORPUS_ORACLES |= corpus_queries.ORACLES
    import corpus_pipeline

    CORPUS_QUERIES["pipeline"] = corpus_pipeline.run
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "lendspan.llm", "lendspan.llm.queries"):
        raise


def entry(spark: SparkSession) -> DataFrame:
    """Monthly 30+/60+/90+ rates of the smallest test portfolio."""
    return queries()["monthly_rates"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for name, build in BUILDERS.items()} | {
        name: _corpus_query(build) for name, build in CORPUS_QUERIES.items()
    }


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **CORPUS_ORACLES}
