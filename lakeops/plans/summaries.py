"""Aggregations, top-k reports and medallion gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.operators import aggregates as agg
from lakeops.plans.bindings import Tables, as_double
from lakeops.plans.registry import query
from lakeops.plans.shaping import SILVER_SQL, clean_loans
from lakeops.plans.sql import FLAT, KEYED, LOANS, avg2, total


@query("row_count", "SELECT count(*) AS total_records FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return t.read("lineitem").agg(F.count(F.lit(1)).alias("total_records"))


@query("orders_by_customer", f"""WITH {KEYED}
SELECT customer_id, customer_name, count(*) AS order_count FROM keyed GROUP BY customer_id, customer_name""")
def orders_by_customer(t: Tables) -> DataFrame:
    return agg.count_by(t.keyed_orders(), ["customer_id", "customer_name"], "order_count")


@query("count_by_state", f"WITH {KEYED} SELECT state, count(*) AS order_count FROM keyed GROUP BY state")
def count_by_state(t: Tables) -> DataFrame:
    return agg.count_by(t.keyed_orders(), ["state"], "order_count")


_STATS = f"""stats AS (
  SELECT product_name, count(*) AS times_ordered, {avg2('price')} AS avg_price, {total('line_total')} AS total_revenue,
         {avg2('CAST(quantity AS DECIMAL(10,2))')} AS avg_qty
  FROM flat GROUP BY product_name)"""


# The names and statistics of the reports.
PRODUCT_STATS = {"times_ordered": "count(*)", "avg_price": "round(avg(price), 2)", "total_revenue": "round(sum(line_total), 2)",
                 "avg_qty": "round(avg(CAST(quantity AS DECIMAL(10,2))), 2)"}
REVENUE = {"order_count": "count(*)", "avg_order_value": "round(avg(line_total), 2)", "total_revenue": "round(sum(line_total), 2)"}
CUSTOMER_STATS = {"num_orders": "count(*)", "avg_products_per_order": "round(CAST(sum(items) AS DECIMAL(20,0)) / count(*), 2)"}
GOLD_BY_STATE = {"total_loans": "count(*)", "total_loan_amount": "sum(loan_amount)", "avg_loan_amount": "avg(loan_amount)",
                 "avg_interest_rate": "avg(interest_rate)"}
GOLD_BY_GRADE = {"total_loans": "count(*)", "avg_loan_amount": "avg(loan_amount)", "avg_interest_rate": "avg(interest_rate)"}


def products(t: Tables) -> DataFrame:
    return agg.report(t.flat_orders(), ["product_name"], PRODUCT_STATS)


def customers(t: Tables) -> DataFrame:
    keys = ["customer_id", "customer_name"]
    orders = agg.nested_sizes(t.sales_orders(), [*keys, "order_number"], "ordered_products", "items")
    return agg.report(orders, keys, CUSTOMER_STATS)


@query("product_stats", f"WITH {FLAT}, {_STATS} SELECT * FROM stats")
def product_stats(t: Tables) -> DataFrame:
    return as_double(products(t))


@query("top_products", f"WITH {FLAT}, {_STATS} SELECT * FROM stats ORDER BY total_revenue DESC, product_name LIMIT 10")
def top_products(t: Tables) -> DataFrame:
    return as_double(agg.top_k(products(t), "total_revenue", 10, ["product_name"]))


@query("order_totals", f"""WITH {FLAT}
SELECT order_number, customer_name, {total('line_total')} AS order_total, count(*) AS num_products
FROM flat GROUP BY order_number, customer_name""")
def order_totals(t: Tables) -> DataFrame:
    return as_double(agg.order_totals(t.flat_orders(), ["order_number", "customer_name"]))


REVENUE_SQL = f"""SELECT state, count(*) AS order_count, {avg2('line_total')} AS avg_order_value,
       {total('line_total')} AS total_revenue FROM flat GROUP BY state"""


@query("revenue_by_state", f"WITH {FLAT} {REVENUE_SQL} ORDER BY total_revenue DESC, state LIMIT 10")
def revenue_by_state(t: Tables) -> DataFrame:
    return as_double(agg.top_k(agg.report(t.flat_orders(), ["state"], REVENUE), "total_revenue", 10, ["state"]))


_CUSTOMER_STATS = """per_order AS (
  SELECT o_orderkey, o_custkey AS customer_id, c_name AS customer_name, count(l_orderkey) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_custkey, c_name),
stats AS (
  SELECT customer_id, customer_name, count(*) AS num_orders,
         CAST((2 * CAST(sum(n) AS BIGINT) * 100 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_products_per_order
  FROM per_order GROUP BY customer_id, customer_name)"""


@query("customer_stats", f"WITH {_CUSTOMER_STATS} SELECT * FROM stats")
def customer_stats(t: Tables) -> DataFrame:
    return as_double(customers(t))


@query("top_customers", f"WITH {_CUSTOMER_STATS} SELECT * FROM stats ORDER BY num_orders DESC, customer_id LIMIT 20")
def top_customers(t: Tables) -> DataFrame:
    return as_double(agg.top_k(customers(t), "num_orders", 20, ["customer_id"]))


@query("distinct_rows", f"WITH {FLAT} SELECT DISTINCT product_name, CAST(price AS DOUBLE) AS price, state FROM flat")
def distinct_rows(t: Tables) -> DataFrame:
    return as_double(agg.distinct_rows(t.flat_orders().select("product_name", "price", "state")))


@query("column_summary", """WITH v AS (
  SELECT 'o_orderkey' AS "column", o_orderkey::DOUBLE AS x FROM orders
  UNION ALL SELECT 'o_custkey', o_custkey FROM orders
  UNION ALL SELECT 'o_totalprice', o_totalprice FROM orders)
SELECT "column", CAST(count(x) AS DOUBLE) AS count, round(avg(x), 4) AS mean, round(stddev(x), 4) AS stddev,
       min(x) AS min, max(x) AS max FROM v GROUP BY "column" """)
def column_summary(t: Tables) -> DataFrame:
    # The quartiles are approximate: column_quartiles checks their error.
    return agg.column_summary(t.read("orders"), ["o_orderkey", "o_custkey", "o_totalprice"]).select(
        "column", "count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "min", "max")


@query("column_quartiles", """SELECT 'o_totalprice' AS "column", count(*) AS rows, true AS close FROM orders
UNION ALL SELECT 'o_custkey', count(*), true FROM orders""")
def column_quartiles(t: Tables) -> DataFrame:
    """Whether each approximate quartile has its share of the rows at or below it, within a thousandth."""
    orders, columns = t.read("orders"), ["o_totalprice", "o_custkey"]
    summary = agg.column_summary(orders, columns)
    values = orders.select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("double"))])).alias("column", "x"))

    def close(quartile: str, part: float) -> Column:
        # Of equal values some lie on either side.
        below, up_to = F.count_if(F.col("x") < F.col(quartile)), F.count_if(F.col("x") <= F.col(quartile))
        rows = F.count(F.lit(1))
        return (below <= rows * (part + 0.001) + 1) & (up_to >= rows * (part - 0.001) - 1)

    return values.join(F.broadcast(summary), "column").groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), (close("q25", 0.25) & close("q50", 0.5) & close("q75", 0.75)).alias("close"))


@query("text_summary", """SELECT 'o_orderpriority' AS "column", count(o_orderpriority) AS count, min(o_orderpriority) AS min,
       max(o_orderpriority) AS max FROM orders
UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', count(o_orderdate), strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'),
       strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders""")
def text_summary(t: Tables) -> DataFrame:
    return agg.text_summary(t.read("orders"), ["o_orderpriority", "o_orderstatus", "o_orderdate"])


@query("ordered_report", """SELECT row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS position, o_orderpriority, n
FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority)""")
def ordered_report(t: Tables) -> DataFrame:
    """A sorted report with the position of each row: the order itself is compared."""
    counts = agg.count_by(t.read("orders"), ["o_orderpriority"], "n").orderBy(F.desc("n"), "o_orderpriority")
    return counts.coalesce(1).select(F.monotonically_increasing_id().alias("position"), "o_orderpriority", "n")


def silver(t: Tables) -> DataFrame:
    return clean_loans(t.loans())


def by_state(silver_rows: DataFrame) -> DataFrame:
    return agg.report(silver_rows, ["state"], GOLD_BY_STATE).orderBy(F.desc("total_loan_amount"))


def by_grade(silver_rows: DataFrame) -> DataFrame:
    return agg.report(silver_rows, ["loan_grade", "loan_term"], GOLD_BY_GRADE).orderBy("loan_grade", "loan_term")


def rounded_gold(df: DataFrame) -> DataFrame:
    return as_double(df.withColumns({c: F.round(c, 2) for c in df.columns if c.startswith("avg_")}))


GOLD_STATE_SQL = f"""SELECT state, count(*) AS total_loans, {total('loan_amount')} AS total_loan_amount,
       {avg2('loan_amount')} AS avg_loan_amount, {avg2('interest_rate')} AS avg_interest_rate
FROM silver GROUP BY state"""


@query("gold_by_state", f"WITH {LOANS}, {SILVER_SQL} {GOLD_STATE_SQL}")
def gold_by_state(t: Tables) -> DataFrame:
    return rounded_gold(by_state(silver(t)))


@query("gold_by_grade", f"""WITH {LOANS}, {SILVER_SQL}
SELECT loan_grade, loan_term, count(*) AS total_loans, {avg2('loan_amount')} AS avg_loan_amount,
       {avg2('interest_rate')} AS avg_interest_rate
FROM silver GROUP BY loan_grade, loan_term""")
def gold_by_grade(t: Tables) -> DataFrame:
    return rounded_gold(by_grade(silver(t)))
