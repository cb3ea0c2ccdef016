"""Profiles, constraints, expectations, monitoring, identity and defaults."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakeops.operators import aggregates as agg, orders as ops, profile, rules as rl, schema
from lakeops.plans.bindings import Tables, as_double
from lakeops.plans.registry import query
from lakeops.plans.sql import FLAT, LOANS, avg2

# The reference rules, with limits scaled to the test tables.
RULES = [
    rl.Rule.not_null("loan_amnt"),
    rl.Rule.not_null("funded_amnt"),
    rl.Rule.not_null("addr_state"),
    rl.Rule.check("valid_loan_amount", "loan_amnt > 0 AND loan_amnt <= 450000"),
    rl.Rule.check("valid_funded_amount", "funded_amnt >= 0 AND funded_amnt <= loan_amnt"),
    rl.Rule.check("valid_paid_amount", "paid_amnt >= 0"),
    rl.Rule.check("valid_state", "length(addr_state) = 9"),
    rl.Rule.check("valid_income", "annual_inc IS NULL OR annual_inc > 0"),
]
EXPECTATIONS = {
    "valid_loan_amount": ("loan_amnt > 0 AND loan_amnt < 450000", "drop"),
    "valid_funding": ("funded_amnt > 0", "drop"),
    "valid_term": ("term IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')", "drop"),
    "reasonable_interest_rate": ("int_rate BETWEEN 5 AND 45", "warn"),
}

_BROKEN = {r.name: f"coalesce(NOT ({r.condition.replace('`', '')}), false)" for r in RULES}
PASSED = {n: f"coalesce({c}, false)" for n, (c, _) in EXPECTATIONS.items()}


def _long(pairs: dict[str, str], name: str, value: str, source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS {name}, count(*) FILTER (WHERE {c}) AS {value} FROM {source}" for n, c in pairs.items())


_LOAN_COLUMNS = ["loan_id", "loan_amnt", "funded_amnt", "paid_amnt", "addr_state", "annual_inc", "term", "grade",
                 "int_rate", "dti", "created_at"]


def _null_row(c: str, source: str) -> str:
    nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
    return (f"SELECT '{c}' AS \"column\", {nulls} AS null_count, "
            f"CAST((2 * {nulls} * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS null_percentage FROM {source}")


@query("null_profile", f"WITH {LOANS} " + "\nUNION ALL\n".join(_null_row(c, "loans") for c in _LOAN_COLUMNS))
def null_profile(t: Tables) -> DataFrame:
    return as_double(profile.null_profile(t.loans()))


@query("duplicate_rows", f"""WITH {FLAT}, rows AS (SELECT product_name, price, quantity, state FROM flat)
SELECT (SELECT count(*) FROM rows) AS total_records,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM rows)) AS distinct_records,
       (SELECT count(*) FROM rows) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rows)) AS duplicate_records""")
def duplicate_rows(t: Tables) -> DataFrame:
    return profile.duplicate_rows(t.flat_orders().select("product_name", "price", "quantity", "state"))


_REQUIRED = ["loan_id", "funded_amnt", "paid_amnt", "addr_state"]


@query("required_nulls", f"WITH {LOANS} " + _long({c: f"{c} IS NULL" for c in _REQUIRED}, '"column"', "null_count", "loans"))
def required_nulls(t: Tables) -> DataFrame:
    return profile.required_nulls(t.loans(), _REQUIRED)


@query("empty_orders", """SELECT o_orderkey AS order_number, c_name AS customer_name
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def empty_orders(t: Tables) -> DataFrame:
    return ops.empty_arrays(t.sales_orders()).select("order_number", "customer_name")


_RANGES = {
    "price_not_positive": "price <= 0",
    "quantity_not_positive": "quantity <= 0",
    "price_unrealistic": "price < 905 OR price > 995",
    "line_total_unrealistic": "line_total > 45000",
}


@query("range_violations", f"WITH {FLAT} " + _long(_RANGES, "rule", "violations", "flat"))
def range_violations(t: Tables) -> DataFrame:
    return profile.range_violations(t.flat_orders(), {n: F.expr(c) for n, c in _RANGES.items()})


# The names and figures of the reports.
_UNPAID = "sum(CASE WHEN paid_amnt = 0 THEN 1 ELSE 0 END)"
QUALITY = {"total_records": "count(*)", "unique_groups": "count(DISTINCT addr_state)", "avg_amount": "round(avg(loan_amnt), 2)",
           "min_amount": "min(loan_amnt)", "max_amount": "max(loan_amnt)", "unpaid": _UNPAID,
           "fully_paid": "sum(CASE WHEN paid_amnt >= funded_amnt THEN 1 ELSE 0 END)",
           "avg_repayment_pct": "round(avg(CASE WHEN paid_amnt > 0 THEN CAST(paid_amnt / funded_amnt * 100 AS DECIMAL(18,6)) END), 2)"}
MONITOR = {"table_name": "'loans'", "record_count": "count(*)", "last_updated": "max(created_at)",
           "unique_states": "count(DISTINCT addr_state)", "avg_amount": "round(avg(loan_amnt), 2)", "unpaid_count": _UNPAID,
           "unpaid_pct": f"round({_UNPAID} * CAST(100 AS DECIMAL(5,0)) / count(*), 2)"}
_PCT = "CAST(round(CAST(paid_amnt * 100 AS DOUBLE) / funded_amnt, 6) AS DECIMAL(18,6))"


@query("quality_metrics", f"""WITH {LOANS}
SELECT count(*) AS total_records, count(DISTINCT addr_state) AS unique_groups, {avg2('loan_amnt')} AS avg_amount,
       CAST(min(loan_amnt) AS DOUBLE) AS min_amount, CAST(max(loan_amnt) AS DOUBLE) AS max_amount,
       CAST(sum(CASE WHEN paid_amnt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unpaid,
       CAST(sum(CASE WHEN paid_amnt >= funded_amnt THEN 1 ELSE 0 END) AS BIGINT) AS fully_paid,
       round(avg(CASE WHEN paid_amnt > 0 THEN {_PCT} END), 2) AS avg_repayment_pct
FROM loans""")
def quality_metrics(t: Tables) -> DataFrame:
    return as_double(agg.report(t.loans(), [], QUALITY))


@query("monitor_view", f"""WITH {LOANS}
SELECT 'loans' AS table_name, count(*) AS record_count, max(created_at) AS last_updated,
       count(DISTINCT addr_state) AS unique_states, {avg2('loan_amnt')} AS avg_amount,
       CAST(sum(CASE WHEN paid_amnt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unpaid_count,
       CAST((2 * CAST(sum(CASE WHEN paid_amnt = 0 THEN 1 ELSE 0 END) AS BIGINT) * 10000 + count(*)) // (2 * count(*))
            AS DOUBLE) / 100 AS unpaid_pct
FROM loans""")
def monitor_view(t: Tables) -> DataFrame:
    view = f"monitor_{uuid.uuid4().hex[:12]}"
    profile.monitoring_view(agg.report(t.loans(), [], MONITOR), view)
    return as_double(t.spark.table(view).drop("metrics_timestamp"))


@query("alert_daily_count", """WITH days AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS record_count, max(ts) AS last_update,
         count(*) FILTER (WHERE value > 300) AS violations FROM events GROUP BY 1),
seen AS (
  SELECT *, sum(record_count) OVER past AS before_sum, count(*) OVER past AS before_days,
         floor(epoch(last_update)) - floor(epoch(lag(last_update) OVER (ORDER BY day))) AS secs,
         sum(record_count) OVER (ORDER BY day) AS size,
         sum(record_count) OVER (ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 7 DAY PRECEDING) AS size_week
  FROM days WINDOW past AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT strftime(day, '%Y-%m-%d') AS day, record_count,
       coalesce(record_count * before_days * 10 < before_sum * 9, false) AS low_count,
       coalesce(secs > 86400, false) AS stale, violations > 0 AS dirty,
       coalesce(size * 2 > size_week * 3, false) AS growth
FROM seen""")
def alert_daily_count(t: Tables) -> DataFrame:
    days = profile.daily_metrics(t.read("events"), "ts", F.col("value") > 300)
    return profile.alerts(days).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("constraint_report", f"WITH {LOANS} " + _long(_BROKEN, "rule", "violations", "loans"))
def constraint_report(t: Tables) -> DataFrame:
    return rl.constraint_report(t.loans(), RULES)


_KEPT = "loan_id, CAST(loan_amnt AS DOUBLE) AS loan_amnt, CAST(funded_amnt AS DOUBLE) AS funded_amnt, addr_state"


@query("valid_rows", f"WITH {LOANS} SELECT {_KEPT} FROM loans WHERE NOT ({' OR '.join(_BROKEN.values())})")
def valid_rows(t: Tables) -> DataFrame:
    valid, _ = rl.split_valid(t.loans(), RULES)
    return as_double(valid.select("loan_id", "loan_amnt", "funded_amnt", "addr_state"))


@query("rejected_rows", f"""WITH {LOANS}
SELECT {_KEPT}, concat_ws(',', {', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _BROKEN.items())}) AS reasons
FROM loans WHERE {' OR '.join(_BROKEN.values())}""")
def rejected_rows(t: Tables) -> DataFrame:
    _, rejected = rl.write_split(t.loans(), RULES, t.scratch("split"))
    return as_double(rejected.select("loan_id", "loan_amnt", "funded_amnt", "addr_state",
                                     F.array_join("violations", ",").alias("reasons")))


@query("expect_drop", f"""WITH {LOANS}
SELECT {_KEPT} FROM loans
WHERE {' AND '.join(PASSED[n] for n, (_, action) in EXPECTATIONS.items() if action == 'drop')}""")
def expect_drop(t: Tables) -> DataFrame:
    kept = rl.expect(t.loans(), EXPECTATIONS)
    return as_double(kept.select("loan_id", "loan_amnt", "funded_amnt", "addr_state"))


def _metric_row(name: str, passed: str) -> str:
    failed = f"count(*) FILTER (WHERE NOT {passed})"
    return (f"SELECT '{name}' AS expectation_name, count(*) FILTER (WHERE {passed}) AS passed_records, "
            f"{failed} AS failed_records, "
            f"CAST((2 * {failed} * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS failure_rate FROM loans")


@query("expectation_metrics", f"WITH {LOANS} " + "\nUNION ALL\n".join(_metric_row(n, c) for n, c in PASSED.items()))
def expectation_metrics(t: Tables) -> DataFrame:
    return as_double(rl.expectation_metrics(t.loans(), EXPECTATIONS))


@query("identity_rows", """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS loan_id, o_orderkey, o_orderdate
FROM orders""")
def identity_rows(t: Tables) -> DataFrame:
    rows = t.read("orders").select("o_orderkey", "o_orderdate")
    return schema.assign_identity(rows, ["o_orderdate", "o_orderkey"], "loan_id")


@query("defaults", f"""WITH {LOANS}
SELECT loan_id, CAST(coalesce(funded_amnt, 0) AS DOUBLE) AS funded_amnt,
       CAST(loan_amnt - coalesce(paid_amnt, 0) AS DOUBLE) AS open_amnt, TIMESTAMP '2024-03-01 12:00:00' AS updated_at
FROM loans""")
def defaults(t: Tables) -> DataFrame:
    filled = schema.with_defaults(t.loans(), {
        "funded_amnt": F.lit(0),
        "open_amnt": F.col("loan_amnt") - F.coalesce("paid_amnt", F.lit(0)),
        "updated_at": F.lit("2024-03-01 12:00:00").cast("timestamp_ntz"),
    })
    return as_double(filled.select("loan_id", "funded_amnt", "open_amnt", "updated_at"))
