"""Project the order/lineitem test tables onto the loan star schema.

Every rule is a per-row expression, apart from the earliest ship date of an order,
which is a partial-aggregated minimum. The test tables hold money as double; it is
turned into whole cents once and stays exact from there.
"""

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import Tables
from . import dims

# Only the columns that the rules use; given as types so that no file is opened to infer them.
SOURCE_COLUMNS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


def load_bridged(spark: SparkSession, folder: str) -> Tables:
    source = {
        name: spark.read.schema(columns).parquet(posixpath.join(folder, name + ".parquet"))
        for name, columns in SOURCE_COLUMNS.items()
    }
    lineitem = source["lineitem"]
    return Tables(
        customers=_customers(source["customer"], source["nation"], source["region"]),
        products=dims.products(spark),
        channels=dims.channels(spark),
        loans=_loans(source["orders"], lineitem),
        schedule=_schedule(lineitem),
        payments=_payments(lineitem),
        collections=_collections(lineitem),
        macro=dims.macro_monthly(spark),
    )


def _hundredths(column: str) -> str:
    return f"CAST(rint({column} * 100) AS BIGINT)"


def _money(cents: str, precision: int = 14) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(14,0)) * 0.01BD AS DECIMAL({precision},2))"


def _percent_of(cents: str, percent: str) -> str:
    """A whole percentage of non-negative cents, half up."""
    return f"({cents} * {percent} + 50) DIV 100"


def _customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    # Broadcast by name: these tables have 25 and 5 rows at every scale, and 25 keys
    # would leave a shuffle of the customers on a few tasks.
    places = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
    income = f"1800000 + ({_hundredths('c_acctbal')} + 100000) * 20"
    return customer.join(places, customer.c_nationkey == places.n_nationkey).selectExpr(
        "c_custkey AS customer_id",
        "CAST(18 + c_custkey * 13 % 58 AS INT) AS age",
        f"{_money(income, 12)} AS annual_income_nzd",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Salaried' WHEN 'AUTOMOBILE' THEN 'Self-employed'
           WHEN 'MACHINERY' THEN 'Contractor' WHEN 'HOUSEHOLD' THEN 'Student'
           WHEN 'FURNITURE' THEN 'Unemployed' END AS employment_type""",
        "r_name AS region",
        "CAST(450 + c_custkey * 37 % 401 AS INT) AS credit_score",
        "CAST(1 + c_custkey * 7 % 180 AS INT) AS tenure_months",
    )


def _loans(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    first_ship = lineitem.selectExpr("l_orderkey AS o_orderkey", "CAST(l_shipdate AS DATE) AS shipped")
    first_ship = first_ship.groupBy("o_orderkey").agg({"shipped": "min"})
    return orders.join(first_ship, "o_orderkey", "left").selectExpr(
        "o_orderkey AS loan_id",
        "o_custkey AS customer_id",
        """CASE WHEN o_orderkey % 20 < 11 THEN 'Personal' WHEN o_orderkey % 20 < 15 THEN 'Auto'
           WHEN o_orderkey % 20 < 18 THEN 'Mortgage' ELSE 'SME' END AS product_type""",
        "least(CAST(o_orderdate AS DATE), `min(shipped)`) AS origination_date",
        f"{_money(_hundredths('o_totalprice'))} AS principal_nzd",
        "CAST(CAST(3 + o_orderkey % 37 AS DECIMAL(4,0)) * 0.01BD AS DECIMAL(6,4)) AS interest_rate_apr",
        "CAST(12 + o_orderkey % 4 * 12 AS INT) AS term_months",
        """CASE WHEN o_orderkey DIV 20 % 20 < 7 THEN 'Online' WHEN o_orderkey DIV 20 % 20 < 13 THEN 'Broker'
           WHEN o_orderkey DIV 20 % 20 < 17 THEN 'Branch' ELSE 'Partner' END AS channel""",
        "'Active' AS status",
    )


def _schedule(lineitem: DataFrame) -> DataFrame:
    amount = _hundredths("l_extendedprice")
    interest = _percent_of(amount, _hundredths("l_tax"))
    return lineitem.selectExpr(
        "l_orderkey AS loan_id",
        "l_linenumber AS installment_no",
        "CAST(l_shipdate AS DATE) AS due_date",
        f"{_money(amount)} AS scheduled_amount",
        f"{_money(f'{amount} - {interest}')} AS scheduled_principal",
        f"{_money(interest)} AS scheduled_interest",
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    share = f"""CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A'
                THEN 100 - 5 * {_hundredths('l_discount')} ELSE 100 END"""
    paid = _percent_of(_hundredths("l_extendedprice"), share)
    return lineitem.where("l_returnflag <> 'R' OR l_linenumber <= 3").selectExpr(
        "l_orderkey AS loan_id",
        "date_add(CAST(l_shipdate AS DATE), 7 * (CAST(l_quantity AS INT) % 5)) AS payment_date",
        f"{_money(paid)} AS paid_amount",
    )


def _collections(lineitem: DataFrame) -> DataFrame:
    return lineitem.where("l_returnflag = 'R' AND l_linenumber > 3").selectExpr(
        "l_orderkey AS loan_id",
        "date_add(CAST(l_shipdate AS DATE), CAST(3 + l_partkey % 23 AS INT)) AS event_date",
        """CASE l_linenumber WHEN 4 THEN 'SMS' WHEN 5 THEN 'Call' WHEN 6 THEN 'Email'
           ELSE 'Agent' END AS action_type""",
        """CASE WHEN l_linenumber < 7
           THEN date_add(CAST(l_shipdate AS DATE), CAST(7 + l_suppkey % 34 AS INT)) END AS promised_to_pay_date""",
    )
