"""Oracle SQL shared by the query modules: the logical inputs as CTEs, and exact rounding."""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS state, r_name AS city,
         c_mktsegment AS loyalty_segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FLAT = CUSTOMERS + """,
flat AS (
  SELECT o_orderkey AS order_number, customer_id, customer_name, o_orderdate AS order_datetime_ts,
         CAST(o_orderdate AS DATE) AS order_date, state, city, loyalty_segment, p_name AS product_name,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(16,2)) AS line_total
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customers ON o_custkey = customer_id)"""

KEYED = CUSTOMERS + """,
keyed AS (
  SELECT o_orderkey AS order_number, customer_id, customer_name, o_orderdate AS order_datetime_ts, state,
         loyalty_segment, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS line_total
  FROM orders JOIN customers ON o_custkey = customer_id)"""

LOANS = """loan_lines AS (
  SELECT l_orderkey, CAST(max(l_extendedprice) AS DECIMAL(12,2)) AS funded_amnt,
         CAST(max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS DECIMAL(12,2)) AS paid_amnt,
         CAST(CAST(max(l_discount) AS DECIMAL(12,4)) * 500 AS DECIMAL(12,2)) AS int_rate,
         CAST(CAST(max(l_tax) AS DECIMAL(12,4)) * 100 AS DECIMAL(12,2)) AS dti
  FROM lineitem GROUP BY l_orderkey),
loans AS (
  SELECT o_orderkey AS loan_id, CAST(o_totalprice AS DECIMAL(12,2)) AS loan_amnt, funded_amnt, paid_amnt,
         n_name AS addr_state, CAST(c_acctbal AS DECIMAL(12,2)) AS annual_inc, o_orderpriority AS term,
         o_orderstatus AS grade, int_rate, dti, o_orderdate AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN loan_lines ON o_orderkey = l_orderkey)"""

EVENTS = """ev AS (
  SELECT event_id, ts AS event_time, user_id, event_type AS state, CAST(value AS DECIMAL(12,2)) AS line_total
  FROM events)"""


def avg2(expr: str) -> str:
    """Average of a DECIMAL(p,2) rounded half up to 2 places, by way of 6, in whole numbers.

    The same steps as a decimal average followed by `round(.., 2)`; values are not negative.
    """
    cents, n = f"CAST(sum({expr}) * 100 AS HUGEINT)", f"count({expr})"
    return (f"CASE WHEN {n} > 0 THEN CAST((((2 * {cents} * 10000 + {n}) // (2 * {n})) + 5000) // 10000 "
            f"AS DOUBLE) / 100 END")


def total(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE)"
