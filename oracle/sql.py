"""SQL checks for DuckDB, written view by view with joins and cross joins spelled out.

They share one chain of common table expressions, from the test tables to the marts.
"""

BASE = """
dim_customers AS (
  SELECT c_custkey AS customer_id,
         CAST(18 + c_custkey * 13 % 58 AS BIGINT) AS age,
         CAST(18000 + (CAST(c_acctbal AS DECIMAL(14,2)) + 1000) * 20 AS DECIMAL(12,2)) AS annual_income_nzd,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Salaried' WHEN 'AUTOMOBILE' THEN 'Self-employed'
              WHEN 'MACHINERY' THEN 'Contractor' WHEN 'HOUSEHOLD' THEN 'Student'
              WHEN 'FURNITURE' THEN 'Unemployed' END AS employment_type,
         r_name AS region,
         CAST(450 + c_custkey * 37 % 401 AS BIGINT) AS credit_score,
         CAST(1 + c_custkey * 7 % 180 AS BIGINT) AS tenure_months
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
dim_products(product_type, secured_flag, base_risk_tier) AS (
  VALUES ('Personal', false, 'High'), ('Auto', true, 'Medium'), ('Mortgage', true, 'Low'), ('SME', false, 'High')
),
dim_channels(channel, channel_group) AS (
  VALUES ('Online', 'Direct'), ('Branch', 'Direct'), ('Broker', 'Indirect'), ('Partner', 'Indirect')
),
fct_loans AS (
  SELECT o_orderkey AS loan_id,
         o_custkey AS customer_id,
         CASE WHEN o_orderkey % 20 < 11 THEN 'Personal' WHEN o_orderkey % 20 < 15 THEN 'Auto'
              WHEN o_orderkey % 20 < 18 THEN 'Mortgage' ELSE 'SME' END AS product_type,
         least(CAST(o_orderdate AS DATE), first_ship) AS origination_date,
         CAST(o_totalprice AS DECIMAL(14,2)) AS principal_nzd,
         CAST((3 + o_orderkey % 37) * 0.01 AS DECIMAL(6,4)) AS interest_rate_apr,
         CAST(12 + o_orderkey % 4 * 12 AS BIGINT) AS term_months,
         CASE WHEN o_orderkey // 20 % 20 < 7 THEN 'Online' WHEN o_orderkey // 20 % 20 < 13 THEN 'Broker'
              WHEN o_orderkey // 20 % 20 < 17 THEN 'Branch' ELSE 'Partner' END AS channel,
         'Active' AS status
  FROM orders
  LEFT JOIN (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_ship FROM lineitem GROUP BY 1)
    ON l_orderkey = o_orderkey
),
fct_schedule AS (
  SELECT loan_id, installment_no, due_date, scheduled_amount,
         CAST(scheduled_amount - interest AS DECIMAL(14,2)) AS scheduled_principal,
         interest AS scheduled_interest
  FROM (
    SELECT l_orderkey AS loan_id, CAST(l_linenumber AS BIGINT) AS installment_no,
           CAST(l_shipdate AS DATE) AS due_date,
           CAST(l_extendedprice AS DECIMAL(14,2)) AS scheduled_amount,
           CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(14,2)) AS interest
    FROM lineitem)
),
fct_payments AS (
  SELECT l_orderkey AS loan_id,
         CAST(l_shipdate AS DATE) + CAST(7 * (CAST(l_quantity AS INTEGER) % 5) AS INTEGER) AS payment_date,
         CAST(round(CAST(l_extendedprice AS DECIMAL(14,2))
              * CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A'
                     THEN 1 - 5 * CAST(l_discount AS DECIMAL(4,2)) ELSE CAST(1 AS DECIMAL(4,2)) END, 2) AS DECIMAL(14,2)) AS paid_amount
  FROM lineitem WHERE l_returnflag <> 'R' OR l_linenumber <= 3
),
fct_collections AS (
  SELECT l_orderkey AS loan_id,
         CAST(l_shipdate AS DATE) + CAST(3 + l_partkey % 23 AS INTEGER) AS event_date,
         CASE l_linenumber WHEN 4 THEN 'SMS' WHEN 5 THEN 'Call' WHEN 6 THEN 'Email' ELSE 'Agent' END AS action_type,
         CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) + CAST(7 + l_suppkey % 34 AS INTEGER) END AS promised_to_pay_date
  FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber > 3
)
"""

MARTS = """
due_paid AS MATERIALIZED (
  SELECT s.loan_id, s.due_month_end, s.scheduled_amt, coalesce(p.paid_amt, 0) AS paid_amt_same_month
  FROM (SELECT loan_id, last_day(due_date) AS due_month_end, sum(scheduled_amount) AS scheduled_amt
        FROM fct_schedule GROUP BY 1, 2) s
  LEFT JOIN (SELECT loan_id, last_day(payment_date) AS pay_month_end, sum(paid_amount) AS paid_amt
             FROM fct_payments GROUP BY 1, 2) p
    ON p.loan_id = s.loan_id AND p.pay_month_end = s.due_month_end
),
arrears AS (
  SELECT loan_id, due_month_end AS month_end, scheduled_amt, paid_amt_same_month,
         sum(scheduled_amt) OVER (PARTITION BY loan_id ORDER BY due_month_end)
         - sum(paid_amt_same_month) OVER (PARTITION BY loan_id ORDER BY due_month_end) AS arrears_amt
  FROM due_paid
),
life AS (
  SELECT loan_id, CAST(CAST(sum(scheduled_amount) AS DECIMAL(18,2)) * 100 AS DOUBLE) AS total_cents,
         CAST(count(*) AS DOUBLE) AS installments
  FROM fct_schedule GROUP BY 1
),
missed AS (
  -- whole cents times a count over whole cents: the quotient by the average installment, exact at the limits
  SELECT a.loan_id, a.month_end, a.arrears_amt,
         CASE WHEN l.total_cents <> 0 THEN greatest(CAST(0 AS DOUBLE),
              CAST(CAST(a.arrears_amt AS DECIMAL(18,2)) * 100 AS DOUBLE) * l.installments / l.total_cents) END AS missed_inst
  FROM arrears a LEFT JOIN life l ON l.loan_id = a.loan_id
),
dpd AS MATERIALIZED (
  SELECT loan_id, month_end, arrears_amt, missed_inst,
         CASE WHEN arrears_amt <= 0 THEN 'DPD_0' WHEN missed_inst < 1 THEN 'DPD_1_29'
              WHEN missed_inst < 2 THEN 'DPD_30_59' WHEN missed_inst < 3 THEN 'DPD_60_89'
              ELSE 'DPD_90_PLUS' END AS dpd_bucket
  FROM missed
),
snapshot AS MATERIALIZED (
  SELECT d.month_end, l.loan_id, l.customer_id, l.product_type, l.channel, l.origination_date,
         l.principal_nzd, l.interest_rate_apr, l.term_months, d.arrears_amt, d.dpd_bucket
  FROM dpd d JOIN fct_loans l ON l.loan_id = d.loan_id
),
migration AS (
  SELECT month_end, from_bucket, to_bucket, count(*) AS loan_count
  FROM (SELECT month_end, dpd_bucket AS to_bucket,
               lag(dpd_bucket) OVER (PARTITION BY loan_id ORDER BY month_end) AS from_bucket FROM dpd)
  WHERE from_bucket IS NOT NULL GROUP BY 1, 2, 3
),
vintage AS (
  SELECT vintage_month, months_on_books, count(*) AS loan_cnt, CAST(sum(bad) AS BIGINT) AS bad_60plus_cnt,
         CAST(sum(bad) AS DOUBLE) / count(*) AS rate_60plus
  FROM (SELECT last_day(l.origination_date) AS vintage_month,
               (year(d.month_end) - year(last_day(l.origination_date))) * 12
               + month(d.month_end) - month(last_day(l.origination_date)) AS months_on_books,
               CASE WHEN d.dpd_bucket IN ('DPD_60_89', 'DPD_90_PLUS') THEN 1 ELSE 0 END AS bad
        FROM dpd d JOIN fct_loans l ON l.loan_id = d.loan_id
        WHERE d.month_end >= last_day(l.origination_date))
  GROUP BY 1, 2
),
principal_paid AS (
  SELECT loan_id, last_day(due_date) AS month_end, sum(scheduled_principal) AS sched_principal
  FROM fct_schedule GROUP BY 1, 2
),
balance AS (
  SELECT loan_id, month_end,
         round(greatest(0, principal_nzd - sum(sched_principal) OVER (PARTITION BY loan_id ORDER BY month_end)), 2) AS eop_balance
  FROM (SELECT l.loan_id, l.principal_nzd, m.month_end, coalesce(p.sched_principal, 0) AS sched_principal
        FROM fct_loans l CROSS JOIN (SELECT DISTINCT month_end FROM dpd) m
        LEFT JOIN principal_paid p ON p.loan_id = l.loan_id AND p.month_end = m.month_end
        WHERE m.month_end >= last_day(l.origination_date))
),
snapshot2 AS MATERIALIZED (
  SELECT s.*, b.eop_balance
  FROM snapshot s LEFT JOIN balance b ON b.loan_id = s.loan_id AND b.month_end = s.month_end
),
behaviour AS (
  SELECT d.loan_id, d.due_month_end AS month_end, d.scheduled_amt, p.paid_amt_same_month AS paid_amt,
         CASE WHEN p.paid_amt_same_month >= d.scheduled_amt THEN 1 ELSE 0 END AS paid_full_flag
  FROM due_paid d JOIN due_paid p ON p.loan_id = d.loan_id AND p.due_month_end = d.due_month_end
),
features AS (
  SELECT s.loan_id, s.month_end, s.dpd_bucket, s.arrears_amt, s.eop_balance, l.product_type, l.channel,
         l.interest_rate_apr, c.credit_score, c.annual_income_nzd, c.employment_type,
         avg(CAST(b.paid_full_flag AS DOUBLE)) OVER w AS roll3_paid_full_rate,
         CAST(sum(CASE WHEN b.paid_full_flag = 0 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS roll3_missed_cnt,
         CAST(sum(s.arrears_amt) OVER w AS DOUBLE) / count(s.arrears_amt) OVER w AS roll3_avg_arrears
  FROM snapshot2 s JOIN fct_loans l ON l.loan_id = s.loan_id
  JOIN dim_customers c ON c.customer_id = l.customer_id
  LEFT JOIN behaviour b ON b.loan_id = s.loan_id AND b.month_end = s.month_end
  WINDOW w AS (PARTITION BY s.loan_id ORDER BY s.month_end ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
),
labels60 AS (
  SELECT loan_id, month_end,
         CAST(coalesce(max(CASE WHEN dpd_bucket IN ('DPD_60_89', 'DPD_90_PLUS') THEN 1 ELSE 0 END)
           OVER (PARTITION BY loan_id ORDER BY month_end ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0) AS BIGINT) AS will_be_60p_in_3m
  FROM snapshot2
),
recent_features AS (
  SELECT * FROM features
  WHERE month_end >= CAST((SELECT max(month_end) FROM features) - INTERVAL 24 MONTH AS DATE)
),
recent_labels AS (
  SELECT * FROM labels60
  WHERE month_end >= CAST((SELECT max(month_end) FROM labels60) - INTERVAL 24 MONTH AS DATE)
),
training AS (
  SELECT f.*, l.will_be_60p_in_3m
  FROM recent_features f JOIN recent_labels l ON l.loan_id = f.loan_id AND l.month_end = f.month_end
  WHERE f.roll3_paid_full_rate IS NOT NULL AND f.roll3_avg_arrears IS NOT NULL
),
scores AS MATERIALIZED (
  SELECT f.loan_id, f.month_end,
         CAST(0.4 AS DOUBLE) * (CASE f.dpd_bucket WHEN 'DPD_0' THEN CAST(0 AS DOUBLE) WHEN 'DPD_1_29' THEN 1
           WHEN 'DPD_30_59' THEN 2 WHEN 'DPD_60_89' THEN 3 ELSE 4 END / CAST(4 AS DOUBLE))
         + CAST(0.3 AS DOUBLE) * (CAST(1 AS DOUBLE) - f.roll3_paid_full_rate)
         + CAST(0.3 AS DOUBLE) * (CAST(850 - f.credit_score AS DOUBLE) / CAST(400 AS DOUBLE)) AS risk_score,
         l.will_be_60p_in_3m
  FROM features f JOIN labels60 l ON l.loan_id = f.loan_id AND l.month_end = f.month_end
),
watchlist AS (
  SELECT s.month_end, s.loan_id, s.product_type, s.channel, s.dpd_bucket, s.eop_balance, r.risk_score
  FROM snapshot2 s JOIN scores r ON r.loan_id = s.loan_id AND r.month_end = s.month_end
),
income AS (
  SELECT month_end, loan_id, product_type, channel, principal_nzd AS eop_balance, interest_rate_apr,
         round(CAST(principal_nzd * interest_rate_apr / 12 AS DECIMAL(28,10)), 2) AS interest_income_est
  FROM snapshot
),
nii AS MATERIALIZED (
  SELECT month_end, loan_id, product_type, channel, principal_nzd AS eop_balance,
         round(CAST(principal_nzd * interest_rate_apr / 12 AS DECIMAL(28,10)), 2) AS interest_income_est,
         round(CAST(principal_nzd * 0.055 / 12 AS DECIMAL(28,10)), 2) AS funding_cost_est,
         round(CAST(principal_nzd * interest_rate_apr / 12 - principal_nzd * 0.055 / 12 AS DECIMAL(28,10)), 2) AS nii_est
  FROM snapshot
),
pd_map AS MATERIALIZED (
  SELECT loan_id, month_end, dpd_bucket,
         CASE dpd_bucket WHEN 'DPD_0' THEN 0.01 WHEN 'DPD_1_29' THEN 0.03 WHEN 'DPD_30_59' THEN 0.10
              WHEN 'DPD_60_89' THEN 0.30 ELSE 0.55 END AS pd_proxy
  FROM snapshot
),
rar AS (
  -- income and loss are of the same snapshot row, so the two views are joined on their key once
  SELECT n.month_end, n.loan_id, n.product_type, n.channel, n.eop_balance, n.nii_est,
         round(n.eop_balance * p.pd_proxy * 0.55, 2) AS expected_loss_est,
         round(n.nii_est - n.eop_balance * p.pd_proxy * 0.55, 2) AS rar_profit_est
  FROM nii n JOIN pd_map p ON p.loan_id = n.loan_id AND p.month_end = n.month_end
)
"""

BAD30 = "CASE WHEN dpd_bucket IN ('DPD_30_59', 'DPD_60_89', 'DPD_90_PLUS') THEN 1 ELSE 0 END"
BAD60 = "CASE WHEN dpd_bucket IN ('DPD_60_89', 'DPD_90_PLUS') THEN 1 ELSE 0 END"
BAD90 = "CASE WHEN dpd_bucket = 'DPD_90_PLUS' THEN 1 ELSE 0 END"
RATE30, RATE60, RATE90 = (f"CAST(sum({b}) AS DOUBLE) / count(*)" for b in (BAD30, BAD60, BAD90))
BUCKET_NAMES = ("DPD_0", "DPD_1_29", "DPD_30_59", "DPD_60_89", "DPD_90_PLUS")


def money(*names: str) -> str:
    """Columns of exact decimals as double."""
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n.split('.')[-1]}" for n in names)


def marts(select: str, extra: str = "") -> str:
    return f"WITH RECURSIVE {BASE},{MARTS}{',' + extra if extra else ''} {select}"


def base(select: str, extra: str = "") -> str:
    return f"WITH RECURSIVE {BASE}{',' + extra if extra else ''} {select}"


def wide(row: str, column: str, source: str, value: str) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN {column} = '{b}' THEN {value} END), 0) AS BIGINT) AS \"{b}\""
        for b in BUCKET_NAMES
    )
    return marts(f"SELECT {row}, {cells} FROM {source} GROUP BY 1")


SNAPSHOT = (
    "month_end, loan_id, customer_id, product_type, channel, origination_date, "
    + money("principal_nzd", "interest_rate_apr")
    + ", term_months, "
    + money("arrears_amt")
    + ", dpd_bucket"
)
FEATURES = (
    "loan_id, month_end, dpd_bucket, "
    + money("arrears_amt", "eop_balance")
    + ", product_type, channel, "
    + money("interest_rate_apr")
    + ", credit_score, "
    + money("annual_income_nzd")
    + ", employment_type, roll3_paid_full_rate, roll3_missed_cnt, roll3_avg_arrears"
)
RAR_COLUMNS = "month_end, loan_id, product_type, channel, " + money(
    "eop_balance", "nii_est", "expected_loss_est", "rar_profit_est"
)
AS_OF = "DATE '1999-06-15'"
AS_OF_DUE_PAID = f"""
due_paid_as_of AS (
  SELECT s.loan_id, s.due_month_end, s.scheduled_amt, coalesce(p.paid_amt, 0) AS paid_amt_same_month
  FROM (SELECT loan_id, last_day(due_date) AS due_month_end, sum(scheduled_amount) AS scheduled_amt
        FROM fct_schedule WHERE due_date <= {AS_OF} GROUP BY 1, 2) s
  LEFT JOIN (SELECT loan_id, last_day(payment_date) AS pay_month_end, sum(paid_amount) AS paid_amt
             FROM fct_payments WHERE payment_date <= {AS_OF} GROUP BY 1, 2) p
    ON p.loan_id = s.loan_id AND p.pay_month_end = s.due_month_end
),
missed_as_of AS (
  SELECT a.loan_id, a.month_end, a.arrears_amt,
         CASE WHEN l.total_cents <> 0 THEN greatest(CAST(0 AS DOUBLE),
              CAST(CAST(a.arrears_amt AS DECIMAL(18,2)) * 100 AS DOUBLE) * l.installments / l.total_cents) END AS missed_inst
  FROM (SELECT loan_id, due_month_end AS month_end,
               sum(scheduled_amt) OVER w - sum(paid_amt_same_month) OVER w AS arrears_amt
        FROM due_paid_as_of WINDOW w AS (PARTITION BY loan_id ORDER BY due_month_end)) a
  LEFT JOIN life l ON l.loan_id = a.loan_id
)
"""
DPD_AS_OF = """SELECT loan_id, month_end, CAST(arrears_amt AS DOUBLE) AS arrears_amt, missed_inst,
  CASE WHEN arrears_amt <= 0 THEN 'DPD_0' WHEN missed_inst < 1 THEN 'DPD_1_29'
       WHEN missed_inst < 2 THEN 'DPD_30_59' WHEN missed_inst < 3 THEN 'DPD_60_89'
       ELSE 'DPD_90_PLUS' END AS dpd_bucket FROM missed_as_of"""


def rar_on_eop() -> str:
    return marts(
        f"SELECT {RAR_COLUMNS} FROM rar_eop",
        """
nii_eop AS (
  SELECT month_end, loan_id, product_type, channel, dpd_bucket, eop_balance,
         round(CAST(eop_balance * interest_rate_apr / 12 - eop_balance * 0.055 / 12 AS DECIMAL(28,10)), 2) AS nii_est
  FROM (SELECT * REPLACE (CAST(eop_balance AS DECIMAL(14,2)) AS eop_balance) FROM snapshot2)
),
rar_eop AS (
  SELECT n.month_end, n.loan_id, n.product_type, n.channel, n.eop_balance, n.nii_est,
         round(n.eop_balance * p.pd_proxy * 0.55, 2) AS expected_loss_est,
         round(n.nii_est - n.eop_balance * p.pd_proxy * 0.55, 2) AS rar_profit_est
  FROM nii_eop n JOIN pd_map p ON p.loan_id = n.loan_id AND p.month_end = n.month_end
)""",
    )


def segments() -> str:
    sums = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in ("eop_balance", "nii_est", "expected_loss_est", "rar_profit_est"))
    margins = (
        "CAST(sum(nii_est) AS DOUBLE) / nullif(CAST(sum(eop_balance) AS DOUBLE), 0) AS nii_margin, "
        "CAST(sum(rar_profit_est) AS DOUBLE) / nullif(CAST(sum(eop_balance) AS DOUBLE), 0) AS rar_margin"
    )
    parts = [
        f"SELECT {product} AS product_type, {channel} AS channel, count(*) AS loan_months, {sums}, {margins} FROM rar GROUP BY {keys}"
        for product, channel, keys in (
            ("product_type", "CAST(NULL AS VARCHAR)", "product_type"),
            ("CAST(NULL AS VARCHAR)", "channel", "channel"),
            ("product_type", "channel", "product_type, channel"),
        )
    ]
    return marts(" UNION ALL ".join(parts))


def latest_of(segment: str) -> str:
    return marts(
        f"""SELECT {segment}, count(DISTINCT loan_id) AS loans, round({RATE60} * 100, 2) AS rate_60p
FROM snapshot WHERE month_end = (SELECT max(month_end) FROM snapshot)
GROUP BY 1 ORDER BY {RATE60} DESC, loans DESC, {segment} LIMIT 10"""
    )


def all_measures(*by: str) -> str:
    keys = "".join(f"{k}, " for k in by)
    group = f"GROUP BY {', '.join(by)}" if by else ""
    using = f"USING ({', '.join(by)})" if by else "ON true"
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return marts(
        f"""SELECT {keys}loans, loans_30p, loans_60p, loans_90p,
  CAST(balance_total AS DOUBLE) AS eop_balance_total, CAST(balance_60p AS DOUBLE) AS eop_60p_balance,
  {money('interest_income_est', 'funding_cost_est', 'nii_est', 'expected_loss_est', 'rar_profit_est')},
  avg_risk_score,
  CAST(loans_30p AS DOUBLE) / nullif(loans, 0) AS rate_30p, CAST(loans_60p AS DOUBLE) / nullif(loans, 0) AS rate_60p,
  CAST(loans_90p AS DOUBLE) / nullif(loans, 0) AS npl_90p_rate,
  CAST(balance_60p AS DOUBLE) / nullif(CAST(balance_total AS DOUBLE), 0) AS eop_60p_rate,
  CAST(nii_est AS DOUBLE) / nullif(CAST(balance_total AS DOUBLE), 0) AS nii_margin,
  CAST(rar_profit_est AS DOUBLE) / nullif(CAST(balance_total AS DOUBLE), 0) AS rar_margin,
  CAST(top_balance AS DOUBLE) AS top_risk_balance
FROM (SELECT {keys}count(*) AS loans, CAST(sum({BAD30}) AS BIGINT) AS loans_30p, CAST(sum({BAD60}) AS BIGINT) AS loans_60p,
             CAST(sum({BAD90}) AS BIGINT) AS loans_90p, sum(eop_balance) AS balance_total,
             sum(CASE WHEN dpd_bucket IN ('DPD_60_89', 'DPD_90_PLUS') THEN eop_balance END) AS balance_60p
      FROM snapshot2 {group})
JOIN (SELECT {keys}sum(interest_income_est) AS interest_income_est FROM income {group}) {using}
JOIN (SELECT {keys}sum(funding_cost_est) AS funding_cost_est FROM nii {group}) {using}
JOIN (SELECT {keys}sum(nii_est) AS nii_est, sum(expected_loss_est) AS expected_loss_est,
             sum(rar_profit_est) AS rar_profit_est FROM rar {group}) {using}
JOIN (SELECT {keys}CAST(sum(CAST(risk_score AS DECIMAL(18,12))) AS DOUBLE) / count(risk_score) AS avg_risk_score FROM watchlist {group}) {using}
LEFT JOIN (SELECT {keys}sum(eop_balance) AS top_balance
           FROM (SELECT *, rank() OVER ({part} ORDER BY risk_score DESC) AS place FROM watchlist)
           WHERE place <= 100 {group}) {using}"""
    )


def audit() -> str:
    keys = {"dim_customers": "customer_id", "dim_products": "product_type", "dim_channels": "channel", "fct_loans": "loan_id"}
    required = {
        "dim_customers": ("customer_id",),
        "dim_products": ("product_type",),
        "dim_channels": ("channel",),
        "fct_loans": ("loan_id", "customer_id", "product_type", "origination_date", "principal_nzd", "interest_rate_apr", "term_months", "channel"),
        "fct_schedule": ("loan_id", "installment_no", "due_date", "scheduled_amount", "scheduled_principal", "scheduled_interest"),
        "fct_payments": ("loan_id", "payment_date", "paid_amount"),
        "fct_collections": ("loan_id", "event_date"),
    }
    foreign = (
        ("fct_loans", "customer_id", "dim_customers"),
        ("fct_schedule", "loan_id", "fct_loans"),
        ("fct_payments", "loan_id", "fct_loans"),
        ("fct_collections", "loan_id", "fct_loans"),
    )
    rows = [
        f"SELECT '{t}' AS \"table\", 'unique {k}' AS rule, count(*) - count(DISTINCT {k}) AS violations FROM {t}"
        for t, k in keys.items()
    ]
    rows += [
        f"SELECT '{t}', '{c} refers to a known row', count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{c} = x.{c})"
        for t, c, p in foreign
    ]
    rows += [
        f"SELECT '{t}', '{c} is required', count(*) FROM {t} WHERE {c} IS NULL"
        for t, columns in required.items()
        for c in columns
    ]
    return base(" UNION ALL ".join(rows))


def encoded() -> str:
    values = {
        "product_type": ("Auto", "Mortgage", "Personal", "SME"),
        "channel": ("Branch", "Broker", "Online", "Partner"),
        "employment_type": ("Contractor", "Salaried", "Self-employed", "Student", "Unemployed"),
        "dpd_bucket": BUCKET_NAMES,
    }
    indicators = ", ".join(
        f"CASE WHEN {c} = '{v}' THEN CAST(1 AS DOUBLE) ELSE 0 END AS \"{c}__{v.lower()}\""
        for c, vs in values.items()
        for v in vs
    )
    numbers = money(
        "credit_score", "annual_income_nzd", "roll3_paid_full_rate", "roll3_missed_cnt",
        "roll3_avg_arrears", "eop_balance", "interest_rate_apr",
    )
    return marts(f"SELECT loan_id, month_end, {numbers}, {indicators} FROM training")


def amortised(capped: bool) -> str:
    part = "payment - balance * rate"
    if capped:
        part = f"greatest(CAST(0 AS DOUBLE), least({part}, balance))"
    left = f"balance - ({part})"
    stop = ""
    if capped:
        left = f"greatest(CAST(0 AS DOUBLE), {left})"
        stop = f" AND {left} > 0.01"
    return base(
        f"""SELECT loan_id, n AS installment_no, CAST(origination_date + to_months(CAST(n AS INTEGER)) AS DATE) AS due_date,
  CAST(round(CAST(payment AS DECIMAL(28,8)), 2) AS DOUBLE) AS scheduled_amount,
  CAST(round(CAST({part} AS DECIMAL(28,8)), 2) AS DOUBLE) AS scheduled_principal,
  CAST(round(CAST(balance * rate AS DECIMAL(28,8)), 2) AS DOUBLE) AS scheduled_interest
FROM steps""",
        f"""
plans AS (
  SELECT loan_id, origination_date, term_months, CAST(principal_nzd AS DOUBLE) AS principal,
         CAST(interest_rate_apr AS DOUBLE) / 12 AS rate
  FROM fct_loans
),
priced AS (
  SELECT *, CASE WHEN rate <= 0 THEN principal / term_months
                 ELSE principal * (rate * pow(1 + rate, term_months)) / (pow(1 + rate, term_months) - 1) END AS payment
  FROM plans
),
steps AS (
  SELECT loan_id, origination_date, term_months, rate, payment, CAST(1 AS BIGINT) AS n, principal AS balance FROM priced
  UNION ALL
  SELECT loan_id, origination_date, term_months, rate, payment, n + 1, {left}
  FROM steps WHERE n < term_months{stop}
)""",
    )


EVALUATION = """SELECT n, tp, fp, fn, CAST(0 AS BIGINT) AS n_unscored,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
  coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  (SELECT (sum(CASE WHEN y = 1 THEN mid_rank END) - sum(y) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)))
   FROM (SELECT will_be_60p_in_3m AS y,
                rank() OVER (ORDER BY risk_score) + (count(*) OVER (PARTITION BY risk_score) - 1) / CAST(2 AS DOUBLE) AS mid_rank
         FROM scores)) AS auc
FROM (SELECT count(*) AS n,
             CAST(sum(CASE WHEN risk_score >= 0.5 AND will_be_60p_in_3m = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN risk_score >= 0.5 AND will_be_60p_in_3m = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN risk_score < 0.5 AND will_be_60p_in_3m = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
      FROM scores)"""
HISTOGRAM = """SELECT CAST(b.bin AS BIGINT) AS bin, lo + (hi - lo) / 50 * (b.bin - 1) AS bin_from, lo + (hi - lo) / 50 * b.bin AS bin_to,
  coalesce(h.scores, 0) AS scores
FROM (SELECT min(risk_score) AS lo, max(risk_score) AS hi FROM scores)
CROSS JOIN (SELECT unnest(generate_series(1, 50)) AS bin) b
LEFT JOIN (SELECT least(CAST(floor((risk_score - lo) / (hi - lo) * 50) AS BIGINT), 49) + 1 AS bin, count(*) AS scores
           FROM scores CROSS JOIN (SELECT min(risk_score) AS lo, max(risk_score) AS hi FROM scores) GROUP BY 1) h
  ON h.bin = b.bin"""
BOX_PLOT = """SELECT (SELECT min(risk_score) FROM scores WHERE risk_score >= q1 - 1.5 * (q3 - q1)) AS whisker_low, q1, median, q3,
  (SELECT max(risk_score) FROM scores WHERE risk_score <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM quartiles"""
QUARTILES = """
ordered AS (
  SELECT risk_score, row_number() OVER (ORDER BY risk_score) - 1 AS place, count(*) OVER () - 1 AS last_place FROM scores
),
parts AS (
  SELECT q, max(CASE WHEN place = floor(last_place * q) THEN risk_score END) AS below,
         max(CASE WHEN place = ceil(last_place * q) THEN risk_score END) AS above,
         max(last_place * q - floor(last_place * q)) AS share
  FROM ordered CROSS JOIN (VALUES (CAST(0.25 AS DOUBLE)), (0.5), (0.75)) v(q) GROUP BY 1
),
quartiles AS (
  SELECT max(CASE WHEN q = 0.25 THEN below + (above - below) * share END) AS q1,
         max(CASE WHEN q = 0.5 THEN below + (above - below) * share END) AS median,
         max(CASE WHEN q = 0.75 THEN below + (above - below) * share END) AS q3
  FROM parts
)"""


def score_statistics() -> str:
    names = {
        "evaluation": ("n", "tp", "fp", "fn", "precision", "recall", "f1", "auc", "n_unscored"),
        "box_plot": ("whisker_low", "q1", "median", "q3", "whisker_high"),
    }
    rows = [
        f"SELECT '{column}' AS statistic, CAST({column} AS DOUBLE) AS value FROM {source}"
        for source, columns in names.items()
        for column in columns
    ]
    rows.append("SELECT 'bin_' || bin, CAST(scores AS DOUBLE) FROM histogram")
    views = f"{QUARTILES}, evaluation AS ({EVALUATION}), box_plot AS ({BOX_PLOT}), histogram AS ({HISTOGRAM})"
    return marts(" UNION ALL ".join(rows), views)


ORACLES = {
    "month_ends": base(
        """SELECT last_day(CAST(m AS DATE)) AS month_end
FROM (SELECT unnest(generate_series(date_trunc('month', min(due_date)), date_trunc('month', max(due_date)), INTERVAL 1 MONTH)) AS m
      FROM fct_schedule)"""
    ),
    "mart_loan_due_paid": marts(
        f"SELECT loan_id, due_month_end, {money('scheduled_amt', 'paid_amt_same_month')} FROM due_paid"
    ),
    "mart_loan_due_paid_as_of": marts(
        f"SELECT loan_id, due_month_end, {money('scheduled_amt', 'paid_amt_same_month')} FROM due_paid_as_of",
        AS_OF_DUE_PAID,
    ),
    "mart_loan_arrears": marts(
        f"SELECT loan_id, month_end, {money('scheduled_amt', 'paid_amt_same_month', 'arrears_amt')} FROM arrears"
    ),
    "mart_loan_dpd_bucket": marts(
        f"SELECT loan_id, month_end, {money('arrears_amt')}, missed_inst, dpd_bucket FROM dpd"
    ),
    "mart_loan_dpd_bucket_as_of": marts(DPD_AS_OF, AS_OF_DUE_PAID),
    "mart_portfolio_snapshot": marts(f"SELECT {SNAPSHOT} FROM snapshot"),
    "mart_dpd_migration": marts("SELECT * FROM migration"),
    "mart_vintage_60plus": marts("SELECT * FROM vintage"),
    "mart_principal_paid_by_month": marts(
        f"SELECT loan_id, month_end, {money('sched_principal')} FROM principal_paid"
    ),
    "mart_balance_eop": marts(f"SELECT loan_id, month_end, {money('eop_balance')} FROM balance"),
    "mart_portfolio_snapshot_v2": marts(f"SELECT {SNAPSHOT}, {money('eop_balance')} FROM snapshot2"),
    "balance_intervals": marts(
        f"""SELECT loan_id, month_end AS from_month, lead(month_end) OVER w AS to_month,
  CAST(round(greatest(0, principal_nzd - sum(repaid) OVER w), 2) AS DOUBLE) AS eop_balance
FROM (SELECT l.loan_id, l.principal_nzd, m.month_end, coalesce(p.sched_principal, 0) AS repaid
      FROM fct_loans l
      JOIN (SELECT loan_id, last_day(origination_date) AS month_end FROM fct_loans
            UNION SELECT loan_id, month_end FROM principal_paid) m ON m.loan_id = l.loan_id
      LEFT JOIN principal_paid p ON p.loan_id = m.loan_id AND p.month_end = m.month_end
      WHERE m.month_end >= last_day(l.origination_date))
WINDOW w AS (PARTITION BY loan_id ORDER BY month_end)"""
    ),
    "balance_at_quarters": marts(
        f"""SELECT loan_id, month_end, {money('eop_balance')} FROM balance
WHERE month_end IN (SELECT CAST(last_day(q) AS DATE) FROM
  (SELECT unnest(generate_series(TIMESTAMP '1996-03-01', TIMESTAMP '1998-12-01', INTERVAL 3 MONTH)) AS q))"""
    ),
    "maintain_marts": marts(f"SELECT {SNAPSHOT}, {money('eop_balance')} FROM snapshot2"),
    "stored_mart_totals": marts(
        """SELECT 'mart_loan_due_paid' AS mart, count(*) AS row_count, CAST(sum(paid_amt_same_month) AS DOUBLE) AS total FROM due_paid
UNION ALL SELECT 'mart_loan_arrears', count(*), CAST(sum(arrears_amt) AS DOUBLE) FROM arrears
UNION ALL SELECT 'mart_loan_dpd_bucket', count(*), CAST(sum(CASE WHEN missed_inst >= 1 THEN arrears_amt END) AS DOUBLE) FROM dpd
UNION ALL SELECT 'mart_dpd_migration', count(*), CAST(sum(CASE WHEN from_bucket < to_bucket THEN loan_count END) AS DOUBLE) FROM migration
UNION ALL SELECT 'mart_vintage_60plus', count(*), CAST(sum(bad_60plus_cnt) AS DOUBLE) FROM vintage
UNION ALL SELECT 'mart_principal_paid_by_month', count(*), CAST(sum(sched_principal) AS DOUBLE) FROM principal_paid
UNION ALL SELECT 'comm_rar_monthly', count(*), CAST(sum(rar_profit_est) AS DOUBLE) FROM rar"""
    ),
    "model_gradient": marts(
        # at the minimum of a convex objective every derivative is 0
        """SELECT feature, CAST(0 AS DOUBLE) AS gradient
FROM (VALUES ('intercept'), ('credit_score'), ('annual_income_nzd'), ('roll3_paid_full_rate'), ('roll3_missed_cnt'),
             ('roll3_avg_arrears'), ('eop_balance'), ('interest_rate_apr')) f(feature)
UNION ALL SELECT DISTINCT 'product_type=' || product_type, 0 FROM training
UNION ALL SELECT DISTINCT 'channel=' || channel, 0 FROM training
UNION ALL SELECT DISTINCT 'employment_type=' || employment_type, 0 FROM training
UNION ALL SELECT DISTINCT 'dpd_bucket=' || dpd_bucket, 0 FROM training"""
    ),
    "stratified_split_rows": marts("SELECT loan_id, month_end, will_be_60p_in_3m, CAST(1 AS BIGINT) AS times FROM training"),
    "registered_mart_counts": marts(
        """SELECT 'mart_portfolio_snapshot' AS mart, count(*) AS row_count FROM snapshot
UNION ALL SELECT 'mart_portfolio_snapshot_v2', count(*) FROM snapshot2
UNION ALL SELECT 'mart_dpd_migration', count(*) FROM migration
UNION ALL SELECT 'comm_rar_monthly', count(*) FROM rar"""
    ),
    "risk_pay_behaviour_monthly": marts(
        f"SELECT loan_id, month_end, {money('scheduled_amt', 'paid_amt')}, CAST(paid_full_flag AS BIGINT) AS paid_full_flag FROM behaviour"
    ),
    "risk_features_3m": marts(f"SELECT {FEATURES} FROM features"),
    "risk_labels_60p_3m": marts("SELECT * FROM labels60"),
    "recent_features": marts(f"SELECT {FEATURES} FROM recent_features"),
    "recent_labels": marts("SELECT * FROM recent_labels"),
    "training_set": marts(f"SELECT {FEATURES}, will_be_60p_in_3m FROM training"),
    "encoded_features": encoded(),
    "stratified_split_counts": marts(
        """SELECT will_be_60p_in_3m, is_test,
  CASE WHEN is_test THEN CAST(ceil(n * 0.25) AS BIGINT) ELSE n - CAST(ceil(n * 0.25) AS BIGINT) END AS rows
FROM (SELECT will_be_60p_in_3m, count(*) AS n FROM training GROUP BY 1) CROSS JOIN (VALUES (true), (false)) s(is_test)"""
    ),
    "scores_of_coefficients": marts(
        """SELECT loan_id, month_end, round(1 / (1 + exp(-(CAST(1.25 AS DOUBLE)
  + CAST(-0.004 AS DOUBLE) * CAST(credit_score AS DOUBLE) + CAST(-1.5 AS DOUBLE) * CAST(roll3_paid_full_rate AS DOUBLE)
  + CAST(0.7 AS DOUBLE) * CAST(roll3_missed_cnt AS DOUBLE) + CAST(2.0 AS DOUBLE) * CAST(interest_rate_apr AS DOUBLE)
  + CAST(0.9 AS DOUBLE) * CASE WHEN dpd_bucket = 'DPD_60_89' THEN 1 ELSE 0 END
  + CAST(0.25 AS DOUBLE) * CASE WHEN employment_type = 'Student' THEN 1 ELSE 0 END))), 9) AS risk_score
FROM training"""
    ),
    "csv_round_trip": base("SELECT loan_id, payment_date, CAST(paid_amount AS DOUBLE) AS paid_amount FROM fct_payments"),
    "reload_then_append": base(
        " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", 2 * count(*) AS rows FROM {t}"
            for t in ("dim_customers", "dim_products", "dim_channels", "fct_loans", "fct_schedule", "fct_payments", "fct_collections")
        )
        + " UNION ALL SELECT 'dim_macro_monthly', CAST(0 AS BIGINT)"
    ),
    "saved_scores": marts("SELECT loan_id, month_end, risk_score, CAST(will_be_60p_in_3m AS BIGINT) AS will_be_60p_in_3m FROM scores"),
    "richest_snapshot": marts(f"SELECT {SNAPSHOT}, {money('eop_balance')} FROM snapshot2"),
    "score_evaluation": marts(EVALUATION),
    "risk_watchlist": marts(
        f"SELECT month_end, loan_id, product_type, channel, dpd_bucket, {money('eop_balance')}, risk_score FROM watchlist"
    ),
    "watchlist_top": marts(
        f"""SELECT month_end, loan_id, product_type, channel, dpd_bucket, {money('eop_balance')}, risk_score FROM watchlist
ORDER BY risk_score DESC, watchlist.eop_balance DESC NULLS LAST, loan_id, month_end LIMIT 100"""
    ),
    "watchlist_top_by_month": marts(
        f"""SELECT month_end, loan_id, product_type, channel, dpd_bucket, {money('eop_balance')}, risk_score
FROM (SELECT *, row_number() OVER (PARTITION BY month_end ORDER BY risk_score DESC, eop_balance DESC NULLS LAST, loan_id) AS place FROM watchlist)
WHERE place <= 10"""
    ),
    "comm_interest_income_monthly": marts(
        f"SELECT month_end, loan_id, product_type, channel, {money('eop_balance', 'interest_rate_apr', 'interest_income_est')} FROM income"
    ),
    "comm_nii_monthly": marts(
        f"SELECT month_end, loan_id, product_type, channel, {money('eop_balance', 'interest_income_est', 'funding_cost_est', 'nii_est')} FROM nii"
    ),
    "comm_expected_loss": marts(
        f"""SELECT p.month_end, p.loan_id, p.dpd_bucket, {money('p.pd_proxy', 'r.expected_loss_est')}
FROM pd_map p JOIN rar r ON r.loan_id = p.loan_id AND r.month_end = p.month_end"""
    ),
    "comm_rar_monthly": marts(f"SELECT {RAR_COLUMNS} FROM rar"),
    "comm_rar_monthly_eop": rar_on_eop(),
    "segment_profitability": segments(),
    "pricing_effectiveness": marts(
        f"""SELECT s.product_type, s.channel, CAST(sum(s.interest_rate_apr) AS DOUBLE) / count(*) AS avg_apr,
  {RATE60} AS rate_60p,
  CAST(sum(r.rar_profit_est) AS DOUBLE) / nullif(CAST(sum(r.eop_balance) AS DOUBLE), 0) AS rar_margin
FROM snapshot s JOIN rar r ON r.loan_id = s.loan_id AND r.month_end = s.month_end GROUP BY 1, 2"""
    ),
    "monthly_rates": marts(
        f"SELECT month_end, count(*) AS loans, {RATE30} AS rate_30p, {RATE60} AS rate_60p, {RATE90} AS rate_90p FROM snapshot GROUP BY 1 ORDER BY 1"
    ),
    "worst_segments": marts(
        f"""SELECT month_end, channel, product_type, count(*) AS loans, {RATE60} AS bad_60p_rate
FROM snapshot WHERE month_end = (SELECT max(month_end) FROM snapshot)
GROUP BY 1, 2, 3 HAVING count(*) >= 2 ORDER BY bad_60p_rate DESC, channel, product_type"""
    ),
    "migration_matrix": marts(
        "SELECT * FROM migration WHERE month_end = DATE '1998-12-31' ORDER BY from_bucket, to_bucket"
    ),
    "vintage_curves": marts(
        "SELECT * FROM vintage WHERE vintage_month BETWEEN DATE '1996-01-31' AND DATE '1997-12-31' ORDER BY 1, 2"
    ),
    "dpd_by_product": marts(
        """SELECT l.product_type, s.dpd_bucket, count(*) AS loan_count
FROM snapshot s JOIN fct_loans l ON l.loan_id = s.loan_id GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
    "dpd_by_product_pivot": wide("product_type", "dpd_bucket", "snapshot", "1"),
    "migration_total": marts(
        "SELECT from_bucket, to_bucket, count(*) AS loan_count FROM migration GROUP BY 1, 2 ORDER BY 1, 2"
    ),
    "migration_total_loans": marts(
        "SELECT from_bucket, to_bucket, CAST(sum(loan_count) AS BIGINT) AS loan_count FROM migration GROUP BY 1, 2 ORDER BY 1, 2"
    ),
    "migration_total_pivot": wide("from_bucket", "to_bucket", "migration", "loan_count"),
    "vintage_average": marts(
        "SELECT vintage_month, months_on_books, avg(rate_60plus) AS avg_rate_60plus FROM vintage GROUP BY 1, 2 ORDER BY 1, 2"
    ),
    "score_histogram": marts(HISTOGRAM),
    "score_box_plot": marts(BOX_PLOT, QUARTILES),
    "score_statistics": score_statistics(),
    "commercial_trend": marts(
        """SELECT month_end, CAST(sum(nii_est) AS DOUBLE) AS total_nii, CAST(sum(rar_profit_est) AS DOUBLE) AS total_rar_profit,
  CAST(sum(rar_profit_est) AS DOUBLE) / count(*) AS avg_rar_profit FROM rar GROUP BY 1 ORDER BY 1"""
    ),
    "dashboard_trend": marts(
        f"SELECT month_end, count(*) AS total_loans, {RATE60} AS rate_60p FROM snapshot GROUP BY 1 ORDER BY 1"
    ),
    "latest_month_split": marts(
        f"""SELECT month_end, count(*) - CAST(sum({BAD60}) AS BIGINT) AS current_loans, CAST(sum({BAD60}) AS BIGINT) AS loans_60p
FROM snapshot WHERE month_end = (SELECT max(month_end) FROM snapshot) GROUP BY 1"""
    ),
    "portfolio_overview": marts(
        """SELECT count(DISTINCT loan_id) AS loans, count(DISTINCT customer_id) AS customers,
  min(month_end) AS first_month_end, max(month_end) AS last_month_end FROM snapshot"""
    ),
    "latest_month_kpis": marts(
        f"""SELECT month_end, count(*) AS total_rows, count(DISTINCT loan_id) AS loans,
  round({RATE30} * 100, 2) AS rate_30p, round({RATE60} * 100, 2) AS rate_60p, round({RATE90} * 100, 2) AS rate_90p,
  CAST(sum(eop_balance) AS DOUBLE) AS total_eop_balance
FROM snapshot2 WHERE month_end = (SELECT max(month_end) FROM snapshot2) GROUP BY 1"""
    ),
    "top_products": latest_of("product_type"),
    "top_channels": latest_of("channel"),
    "last_months": marts(
        f"""SELECT month_end, count(*) AS loans, CAST(sum(eop_balance) AS DOUBLE) AS total_balance, {RATE60} AS rate_60p
FROM snapshot2 GROUP BY 1 ORDER BY 1 DESC LIMIT 12"""
    ),
    "top_risk_loans": marts(
        f"""SELECT loan_id, month_end, risk_score, {money('eop_balance')} FROM watchlist
ORDER BY risk_score DESC, loan_id, month_end LIMIT 20"""
    ),
    "product_performance": marts(
        f"""SELECT p.product_type, p.secured_flag, p.base_risk_tier, count(DISTINCT s.loan_id) AS loans, {RATE60} AS rate_60p
FROM snapshot2 s JOIN fct_loans l ON l.loan_id = s.loan_id JOIN dim_products p ON p.product_type = l.product_type
GROUP BY 1, 2, 3"""
    ),
    "commercial_totals": marts(
        "SELECT month_end, CAST(sum(nii_est) AS DOUBLE) AS total_nii, CAST(sum(rar_profit_est) AS DOUBLE) AS total_rar FROM rar GROUP BY 1 ORDER BY 1 DESC"
    ),
    "portfolio_size": marts("SELECT month_end, count(*) AS loans FROM snapshot2 GROUP BY 1 ORDER BY 1"),
    "score_vs_balance": marts(
        f"SELECT risk_score, {money('eop_balance')} FROM watchlist WHERE risk_score IS NOT NULL"
    ),
    "row_counts": base(
        " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}"
            for t in ("dim_customers", "dim_products", "dim_channels", "fct_loans", "fct_schedule", "fct_payments", "fct_collections")
        )
        + " UNION ALL SELECT 'dim_macro_monthly', CAST(0 AS BIGINT)"
    ),
    "first_rows": marts(f"SELECT {RAR_COLUMNS} FROM rar ORDER BY loan_id, month_end LIMIT 10"),
    "delinquency_by_region": marts(
        f"""SELECT month_end, region, count(*) AS loans, {RATE30} AS rate_30p, {RATE60} AS rate_60p, {RATE90} AS rate_90p
FROM snapshot2 s JOIN dim_customers c ON c.customer_id = s.customer_id GROUP BY 1, 2"""
    ),
    "measures_by_month": all_measures("month_end"),
    "measures_by_product_channel": all_measures("product_type", "channel"),
    "measures_total": all_measures(),
    "migration_rates": marts(
        """SELECT m.*, CAST(m.loan_count AS DOUBLE) / t.total AS migration_rate
FROM migration m JOIN (SELECT month_end, from_bucket, sum(loan_count) AS total FROM migration GROUP BY 1, 2) t
  ON t.month_end = m.month_end AND t.from_bucket = m.from_bucket"""
    ),
    "roll_rates": marts(
        """SELECT m.*, CAST(m.loan_count AS DOUBLE) / t.total AS roll_rate
FROM migration m JOIN (SELECT month_end, from_bucket, sum(loan_count) AS total FROM migration GROUP BY 1, 2) t
  ON t.month_end = m.month_end AND t.from_bucket = m.from_bucket
WHERE (m.from_bucket, m.to_bucket) IN (('DPD_0', 'DPD_1_29'), ('DPD_1_29', 'DPD_30_59'), ('DPD_30_59', 'DPD_60_89'), ('DPD_60_89', 'DPD_90_PLUS'))"""
    ),
    "transition_classes": marts(
        """SELECT month_end, CASE WHEN from_bucket = to_bucket THEN 'Stay' WHEN from_bucket = 'DPD_0' THEN 'Worsen'
  WHEN from_bucket < to_bucket THEN 'Roll' ELSE 'Cure' END AS transition_class, CAST(sum(loan_count) AS BIGINT) AS loan_count
FROM migration GROUP BY 1, 2"""
    ),
    "annuity_payment": base(
        """SELECT loan_id, CAST(round(CAST(CASE WHEN rate <= 0 THEN principal / term_months
  ELSE principal * (rate * pow(1 + rate, term_months)) / (pow(1 + rate, term_months) - 1) END AS DECIMAL(28,8)), 2) AS DOUBLE) AS payment
FROM (SELECT loan_id, term_months, CAST(principal_nzd AS DOUBLE) AS principal, CAST(interest_rate_apr AS DOUBLE) / 12 AS rate FROM fct_loans)"""
    ),
    "amortise": amortised(True),
    "amortise_uncapped": amortised(False),
    "risk_propensity": base(
        """SELECT loan_id, round(least(greatest(0.35 / (1 + exp(-x)), 0.02), 0.55), 6) AS p_late,
  round(least(greatest(0.12 / (1 + exp(-x)), 0.005), 0.25), 6) AS p_miss
FROM (SELECT l.loan_id,
        ((650 - credit_score) / CAST(90 AS DOUBLE) + (65000 - CAST(annual_income_nzd AS DOUBLE)) / 90000
         + (CAST(interest_rate_apr AS DOUBLE) - 0.12) / 0.08
         + CASE WHEN employment_type IN ('Unemployed', 'Student') THEN 0.6 ELSE 0 END)
        * CAST(CASE product_type WHEN 'Personal' THEN 1.25 WHEN 'Auto' THEN 1.10 WHEN 'Mortgage' THEN 0.55 ELSE 1.35 END AS DOUBLE)
        * CAST(CASE channel WHEN 'Online' THEN 1.05 WHEN 'Broker' THEN 1.15 WHEN 'Branch' THEN 0.90 ELSE 1.25 END AS DOUBLE) AS x
      FROM fct_loans l JOIN dim_customers c ON c.customer_id = l.customer_id)"""
    ),
    "pay_probability": base(
        """SELECT loan_id, round(1 / (1 + exp(x - 2)), 6) AS pay_probability
FROM (SELECT l.loan_id,
        (850 - credit_score) / CAST(400 AS DOUBLE) + (250000 - CAST(annual_income_nzd AS DOUBLE)) / 250000
        + (CAST(interest_rate_apr AS DOUBLE) - 0.05) * 5
        + CASE employment_type WHEN 'Salaried' THEN 0.8 WHEN 'Self-employed' THEN 1.1 WHEN 'Contractor' THEN 1.2
               WHEN 'Student' THEN 1.5 ELSE 2.0 END - 1
        + CASE product_type WHEN 'Personal' THEN 1.25 WHEN 'Auto' THEN 1.10 WHEN 'Mortgage' THEN 0.55 ELSE 1.35 END - 1
        + CASE channel WHEN 'Online' THEN 1.05 WHEN 'Broker' THEN 1.15 WHEN 'Branch' THEN 0.90 ELSE 1.25 END - 1 AS x
      FROM fct_loans l JOIN dim_customers c ON c.customer_id = l.customer_id)"""
    ),
    "integrity_audit": audit(),
    "maintained_audit": audit(),
    "fct_loans": base(
        f"SELECT loan_id, customer_id, product_type, origination_date, {money('principal_nzd', 'interest_rate_apr')}, term_months, channel, status FROM fct_loans"
    ),
    "dim_customers": base(
        f"SELECT customer_id, age, {money('annual_income_nzd')}, employment_type, region, credit_score, tenure_months FROM dim_customers"
    ),
    "fct_schedule": base(
        f"SELECT loan_id, installment_no, due_date, {money('scheduled_amount', 'scheduled_principal', 'scheduled_interest')} FROM fct_schedule"
    ),
    "fct_payments": base(f"SELECT loan_id, payment_date, {money('paid_amount')} FROM fct_payments"),
    "fct_collections": base("SELECT * FROM fct_collections"),
}
