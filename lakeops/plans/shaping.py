"""Projections, filters, derived columns, joins and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions import band, bin_width
from lakeops.operators import joins, orders as ops, privacy, sampling, schema
from lakeops.operators.aggregates import count_by, order_totals
from lakeops.plans.bindings import Tables, as_double, ntz
from lakeops.plans.registry import query
from lakeops.plans.sql import CUSTOMERS, EVENTS, FLAT, KEYED, LOANS
from lakeops.streaming.medallion import renamed

ORDER_KEYS = ["order_number", "customer_id", "customer_name"]


@query("order_lines", f"""WITH {FLAT}
SELECT order_number, customer_id, customer_name, product_name, CAST(price AS DOUBLE) AS price, quantity,
       CAST(line_total AS DOUBLE) AS line_total FROM flat""")
def order_lines(t: Tables) -> DataFrame:
    return as_double(ops.explode_orders(t.sales_orders(), ORDER_KEYS))


@query("order_lines_outer", f"""WITH {FLAT}
SELECT o_orderkey AS order_number, product_name, CAST(price AS DOUBLE) AS price, quantity,
       CAST(line_total AS DOUBLE) AS line_total
FROM orders LEFT JOIN flat ON order_number = o_orderkey""")
def order_lines_outer(t: Tables) -> DataFrame:
    return as_double(ops.explode_orders(t.sales_orders(), ["order_number"], outer=True))


@query("order_time", """SELECT o_orderkey AS order_number, CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS order_datetime,
       o_orderdate AS order_datetime_ts, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders""")
def order_time(t: Tables) -> DataFrame:
    timed = ops.with_order_time(t.order_heads())
    return timed.select("order_number", "order_datetime", ntz("order_datetime_ts").alias("order_datetime_ts"),
                        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"))


@query("filter_customer", """SELECT o_orderkey AS order_number, o_custkey AS customer_id, o_orderstatus AS status
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_name = 'Customer#000000042'""")
def filter_customer(t: Tables) -> DataFrame:
    return (t.keyed_orders().where(F.col("customer_name") == "Customer#000000042")
            .select("order_number", "customer_id", "status"))


@query("filter_ranges", f"""WITH {FLAT}
SELECT order_number, product_name, quantity, CAST(price AS DOUBLE) AS price FROM flat
WHERE (quantity > 0 AND price > 0 AND quantity <= 5) OR price < 910 OR price >= 1000""")
def filter_ranges(t: Tables) -> DataFrame:
    price, qty = F.col("price"), F.col("quantity")
    lines = t.flat_orders().select("order_number", "product_name", "quantity", "price")
    return as_double(lines.where(((qty > 0) & (price > 0) & (qty <= 5)) | (price < 910) | (price >= 1000)))


@query("filter_exists", f"""WITH {FLAT}
SELECT order_number, customer_name FROM flat GROUP BY order_number, customer_name HAVING max(price) > 990""")
def filter_exists(t: Tables) -> DataFrame:
    hits = ops.orders_with_item_over(t.sales_orders(), 990)
    return hits.select("order_number", "customer_name").distinct()  # an order may be several records


@query("filter_predicates", f"""WITH {KEYED}
SELECT order_number, customer_name, state, status FROM keyed
WHERE state IN ('NATION_13', 'NATION_8', 'NATION_7') OR (customer_name LIKE '%7' AND line_total BETWEEN 100000 AND 200000)
   OR loyalty_segment IS NULL""")
def filter_predicates(t: Tables) -> DataFrame:
    c = F.col
    return t.keyed_orders().where(
        c("state").isin("NATION_13", "NATION_8", "NATION_7")
        | (c("customer_name").like("%7") & c("line_total").between(100000, 200000))
        | c("loyalty_segment").isNull()).select("order_number", "customer_name", "state", "status")


# Order bands, scaled to the prices of the test tables (see FIXTURES.md).
BAND_EDGES = (25_000, 100_000)
BAND_LABELS = ("Small", "Medium", "Large")


@query("order_band", f"""WITH {FLAT}, totals AS (
  SELECT order_number, sum(line_total) AS order_total FROM flat GROUP BY order_number)
SELECT CASE WHEN order_total < 25000 THEN 'Small' WHEN order_total < 100000 THEN 'Medium' ELSE 'Large' END
         AS order_category, count(*) AS count
FROM totals GROUP BY 1""")
def order_band(t: Tables) -> DataFrame:
    totals = order_totals(t.flat_orders(), ["order_number"])
    return count_by(totals.withColumn("order_category", band("order_total", BAND_EDGES, BAND_LABELS)),
                    ["order_category"])


@query("order_histogram", f"""WITH {FLAT}, totals AS (
  SELECT order_number, sum(line_total) AS order_total FROM flat GROUP BY order_number)
SELECT CAST(floor(order_total / 10000) * 10000 AS BIGINT) AS value_bin, count(*) AS count FROM totals GROUP BY 1""")
def order_histogram(t: Tables) -> DataFrame:
    totals = order_totals(t.flat_orders(), ["order_number"])
    return count_by(totals.withColumn("value_bin", bin_width("order_total", 10_000)), ["value_bin"])


# The order statuses of the test tables as grades of low and medium risk.
LOW, MEDIUM = ("F",), ("O",)

# The names and types of the cleaned loan columns.
SILVER = {"loan_id": ("loan_id", None), "loan_amount": ("loan_amnt", "decimal(10,2)"),
          "funded_amount": ("funded_amnt", "decimal(10,2)"), "interest_rate": ("int_rate", "decimal(5,2)"),
          "debt_to_income_ratio": ("dti", "decimal(5,2)"), "loan_term": ("term", None), "loan_grade": ("grade", None),
          "state": ("addr_state", None), "ingestion_timestamp": ("ingestion_timestamp", None)}


def risk(grade: str, low: tuple[str, ...] = LOW, medium: tuple[str, ...] = MEDIUM) -> Column:
    return (F.when(F.col(grade).isin(*low), "Low").when(F.col(grade).isin(*medium), "Medium").otherwise("High"))


def clean_loans(loans: DataFrame) -> DataFrame:
    return renamed(loans, SILVER).withColumn("risk_category", risk("loan_grade"))


SILVER_SQL = """silver AS (
  SELECT loan_id, CAST(loan_amnt AS DECIMAL(10,2)) AS loan_amount, CAST(funded_amnt AS DECIMAL(10,2)) AS funded_amount,
         CAST(int_rate AS DECIMAL(5,2)) AS interest_rate, CAST(dti AS DECIMAL(5,2)) AS debt_to_income_ratio, term AS loan_term,
         grade AS loan_grade, addr_state AS state,
         CASE WHEN grade = 'F' THEN 'Low' WHEN grade = 'O' THEN 'Medium' ELSE 'High' END AS risk_category
  FROM loans)"""


SILVER_COLUMNS = """loan_id, CAST(loan_amount AS DOUBLE) AS loan_amount, CAST(funded_amount AS DOUBLE) AS funded_amount,
  CAST(interest_rate AS DOUBLE) AS interest_rate, CAST(debt_to_income_ratio AS DOUBLE) AS debt_to_income_ratio,
  loan_term, loan_grade, state, risk_category"""


@query("silver_clean", f"WITH {LOANS}, {SILVER_SQL} SELECT {SILVER_COLUMNS} FROM silver")
def silver_clean(t: Tables) -> DataFrame:
    return as_double(clean_loans(t.loans()))


@query("audit_columns", f"""WITH {KEYED}
SELECT order_number, state, 'external_api' AS data_source, TIMESTAMP '2024-03-01 12:00:00' AS last_updated,
       '2024-03-01' AS ingestion_date FROM keyed""")
def audit_columns(t: Tables) -> DataFrame:
    at = F.lit("2024-03-01 12:00:00").cast("timestamp")
    out = schema.with_audit(t.keyed_orders().select("order_number", "state"), "external_api", at)
    return out.select("order_number", "state", "data_source", ntz("last_updated").alias("last_updated"),
                      F.date_format("ingestion_date", "yyyy-MM-dd").alias("ingestion_date"))


@query("random_int")
def random_int(t: Tables) -> DataFrame:
    reviews = t.flat_orders().select("order_number", "product_name", "state")
    return sampling.with_random_int(reviews, "rating", 1, 4, seed=42)


@query("random_int_report", f"""WITH {FLAT} SELECT count(*) AS rows, 1 AS least, 4 AS greatest, true AS even FROM flat""")
def random_int_report(t: Tables) -> DataFrame:
    """Range and evenness of the random numbers: each has a quarter of the rows, within five deviations."""
    rows, n = random_int(t), F.count(F.lit(1))
    off = [F.abs(F.count_if(F.col("rating") == k) - n / 4) <= 5 * F.sqrt(n * 3 / 16) + 1 for k in (1, 2, 3, 4)]
    return rows.agg(n.alias("rows"), F.min("rating").cast("int").alias("least"), F.max("rating").cast("int").alias("greatest"),
                    (off[0] & off[1] & off[2] & off[3]).alias("even"))


@query("mask_rows", f"""WITH {CUSTOMERS}
SELECT customer_id, sha256(customer_name) AS customer_name,
       regexp_replace(regexp_replace(regexp_replace(loyalty_segment, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'),
                      '[0-9]', 'n', 'g') AS loyalty_segment, state
FROM customers WHERE city IN ('ASIA', 'EUROPE')""")
def mask_rows(t: Tables) -> DataFrame:
    regions = t.read("region").select(F.lit("analyst").alias("user"), F.col("r_name").alias("city"))
    grants = regions.where(F.col("city").isin("ASIA", "EUROPE"))
    mine = privacy.row_filter(t.customers(), grants, "analyst", ["city"])
    return privacy.mask_cols(mine, {"customer_name": "hash", "loyalty_segment": "redact"}).select(
        "customer_id", "customer_name", "loyalty_segment", "state")


@query("enrich_orders", f"""WITH {CUSTOMERS}
SELECT o_orderkey AS order_number, o.id AS customer_id, c.c_name AS customer_name, state, city, loyalty_segment
FROM (SELECT *, CASE WHEN o_orderkey % 10 = 3 THEN -o_custkey ELSE o_custkey END AS id FROM orders) o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN customers k ON k.customer_id = o.id AND k.customer_name = c.c_name""")
def enrich_orders(t: Tables) -> DataFrame:
    # A tenth of the orders with an id that no customer has, so that the left join leaves rows unmatched.
    unknown = F.when(F.col("order_number") % 10 == 3, -F.col("customer_id")).otherwise(F.col("customer_id"))
    orders = t.order_heads().withColumn("customer_id", unknown)
    return ops.enrich_orders(orders, t.customers()).select(
        "order_number", "customer_id", "customer_name", "state", "city", "loyalty_segment")


@query("interval_join", f"""WITH {EVENTS}
SELECT c.user_id, c.event_id AS click_id, c.event_time AS clicked_at, p.event_id AS purchase_id,
       p.event_time AS bought_at, CAST(p.line_total AS DOUBLE) AS paid
FROM ev c JOIN ev p ON c.user_id = p.user_id AND c.state = 'click' AND p.state = 'purchase'
 AND p.event_time BETWEEN c.event_time - INTERVAL 5 MINUTE AND c.event_time + INTERVAL 5 MINUTE""")
def interval_join(t: Tables) -> DataFrame:
    return paired_events(t.events(), t.events(), splits=2)


def paired_events(clicks: DataFrame, purchases: DataFrame, splits: int, delay: str | None = None) -> DataFrame:
    """Clicks and purchases of one user within five minutes of each other."""
    left = clicks.where(F.col("state") == "click").select(
        "user_id", "event_time", F.col("event_id").alias("click_id"))
    right = purchases.where(F.col("state") == "purchase").select(
        "user_id", "event_time", F.col("event_id").alias("purchase_id"), F.col("line_total").alias("paid"))
    if delay:
        left, right = left.withWatermark("event_time", delay), right.withWatermark("event_time", delay)
    pairs = joins.interval_join(left, right, ["user_id"], "event_time", before=300, after=300, splits=splits)
    return pairs.select("user_id", "click_id", ntz("event_time").alias("clicked_at"), "purchase_id",
                        ntz("event_time_right").alias("bought_at"), F.col("paid").cast("double").alias("paid"))


@query("orphans", """SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orphans(t: Tables) -> DataFrame:
    return joins.orphans(t.read("orders").select("o_orderkey", "o_custkey"), t.read("lineitem"),
                         {"o_orderkey": "l_orderkey"})


@query("sample_rows")
def sample_rows(t: Tables) -> DataFrame:
    return sampling.sample_rows(t.keyed_orders().select("order_number", "state"), 0.1, seed=42)


@query("sample_report", f"""WITH {KEYED} SELECT true AS distinct, true AS subset, true AS near_share, count(*) AS rows FROM keyed""")
def sample_report(t: Tables) -> DataFrame:
    """Whether the sample is part of the table, without copies, and about a tenth of it."""
    whole = t.keyed_orders().select("order_number", "state").withColumn("picked", F.lit(0))
    both = whole.unionByName(sample_rows(t).withColumn("picked", F.lit(1))).groupBy("order_number", "state").agg(
        F.sum("picked").alias("picked"), F.count_if(F.col("picked") == 0).alias("there"))
    rows, picked = F.sum("there"), F.sum("picked")
    return both.agg((F.max("picked") <= 1).alias("distinct"), (F.min("there") >= 1).alias("subset"),
                    (F.abs(picked - rows * 0.1) <= 5 * F.sqrt(rows * 0.09) + 1).alias("near_share"), rows.alias("rows"))


@query("sample_hash", """SELECT o_orderkey, o_custkey FROM orders
WHERE ((o_orderkey % 1000003) * 618034) % 1000003 * 1000 < CAST(100 AS BIGINT) * 1000003""")
def sample_hash(t: Tables) -> DataFrame:
    return sampling.sample_hash(t.read("orders"), "o_orderkey", 100).select("o_orderkey", "o_custkey")
