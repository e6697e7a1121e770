"""Raw tables as SQL over the star-schema views."""

_LOCATED_CUSTOMER = """customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""
_LOCATED_SUPPLIER = """supplier
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

BRONZE = {
    "customer_demographics": f"""
SELECT c_custkey AS customer_id,
       c_name AS name,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            ELSE DATE '1940-01-01' + CAST(c_custkey * 97 % 25000 AS INTEGER) END AS date_of_birth,
       CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       r_name AS region, n_name AS country,
       CASE WHEN c_custkey % 13 = 0 THEN ''
            ELSE ' City' || CAST(c_custkey % 50 AS VARCHAR) || ' ' END AS city,
       c_mktsegment AS marital_status,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS DECIMAL(18,2)) AS annual_income
FROM {_LOCATED_CUSTOMER}""",
    "customer_service_interactions": """
SELECT CAST(event_id AS VARCHAR) AS interaction_id,
       CAST(ts AS DATE) AS interaction_date,
       event_type AS interaction_type,
       'I' || CAST(user_id % 6 AS VARCHAR) AS issue_category,
       props AS description,
       CAST(CAST(value AS DECIMAL(18,2)) * 0.1 AS DECIMAL(18,2)) AS duration_minutes,
       CASE WHEN event_id % 3 <> 0 THEN 'Resolved' ELSE 'Open' END AS resolution_status,
       CASE WHEN event_id % 4 = 0 THEN 'Yes' ELSE 'No' END AS follow_up_required,
       CAST(user_id % 7 AS INTEGER) AS customer_satisfaction
FROM events""",
    "financial_transactions": """
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
       CAST(o_orderdate AS DATE) AS transaction_date,
       CASE o_orderstatus WHEN 'F' THEN 'Sale' WHEN 'O' THEN 'Refund' ELSE 'Expense' END AS transaction_type,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       o_orderpriority AS payment_method,
       c_mktsegment AS entity, r_name AS region, n_name AS account_code
FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    "promotions_data": """
SELECT 'PR' || CAST(p_partkey AS VARCHAR) AS promotion_id,
       p_brand AS product_category, p_type AS promotion_type,
       CAST(p_size * 0.0095 AS DECIMAL(6,4)) AS discount_percentage,
       DATE '1995-01-01' + CAST(p_partkey % 2400 AS INTEGER) AS start_date,
       DATE '1995-01-01' + CAST(p_partkey % 2400 + p_size - 3 AS INTEGER) AS end_date,
       r_name AS region
FROM part JOIN region ON p_partkey % 5 = r_regionkey""",
    "marketing_campaigns": f"""
SELECT 'C' || CAST(s_suppkey AS VARCHAR) AS campaign_id,
       s_name AS campaign_name,
       'T' || CAST(s_suppkey % 5 AS VARCHAR) AS campaign_type,
       'P' || CAST(s_suppkey % 6 AS VARCHAR) AS product_category,
       'A' || CAST(s_suppkey % 4 AS VARCHAR) AS target_audience,
       DATE '1995-01-01' + CAST(s_suppkey * 37 % 2300 AS INTEGER) AS start_date,
       DATE '1995-01-01' + CAST(s_suppkey * 37 % 2300 + 30 + s_suppkey % 60 AS INTEGER) AS end_date,
       r_name AS region,
       CAST(s_acctbal AS DECIMAL(18,2)) AS budget,
       s_suppkey * 10 AS reach,
       CAST((s_suppkey % 120) * 0.01 AS DECIMAL(6,4)) AS conversion_rate
FROM {_LOCATED_SUPPLIER}""",
    "product_reviews": """
SELECT l_orderkey * 10 + l_linenumber AS review_id,
       'P' || CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS reviewer_id,
       'Reviewer ' || CAST(l_suppkey AS VARCHAR) AS reviewer_name,
       CAST(l_quantity AS INTEGER) % 7 AS rating,
       CAST(l_shipdate AS DATE) AS review_date,
       ' ' || p_name || ' ' AS review_title,
       l_returnflag || ' ' || l_linestatus AS review_text,
       p_type AS product_category
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "logistics_and_shipping": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
       CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(o_orderdate AS DATE) AS ship_date,
       CAST(l_shipdate AS DATE) AS estimated_delivery,
       l_returnflag AS shipping_method,
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In transit' ELSE 'Returned' END AS status,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS shipping_cost,
       r_name AS destination_region, n_name AS destination_country, s_name AS carrier
FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    "supplier_information": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name,
       'P' || CAST(s_suppkey % 6 AS VARCHAR) AS product_category,
       r_name AS region, n_name AS country,
       'City' || CAST(s_suppkey % 50 AS VARCHAR) AS city,
       s_suppkey % 40 - 2 AS lead_time,
       CAST((s_suppkey % 120) * 0.01 AS DECIMAL(6,4)) AS reliability_score,
       CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS quality_rating
FROM {_LOCATED_SUPPLIER}""",
    "employee_records": f"""
SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_name AS name,
       DATE '1940-01-01' + CAST(c_custkey * 97 % 25000 AS INTEGER) AS date_of_birth,
       DATE '2010-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS hire_date,
       c_mktsegment AS department,
       'Grade ' || CAST(c_custkey % 9 AS VARCHAR) AS job_title,
       CAST(c_acctbal AS DECIMAL(18,2)) AS salary,
       r_name AS region, n_name AS country,
       ' ' || upper(c_name) || '@X.COM ' AS email
FROM {_LOCATED_CUSTOMER}""",
    "inventory": """
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS product_id, p_type AS product_category,
       r_name AS region, n_name AS country,
       'W' || CAST(l_suppkey % 3 AS VARCHAR) AS warehouse,
       CAST(CAST(l_quantity AS INTEGER) - 2 AS BIGINT) AS current_stock,
       CAST(l_linenumber * 5 AS BIGINT) AS reorder_point,
       l_suppkey % 30 AS lead_time,
       CAST(l_shipdate AS DATE) AS last_restock_date
FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    "store_locations": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
       'T' || CAST(s_suppkey % 3 AS VARCHAR) AS store_type,
       r_name AS region, n_name AS country,
       'City' || CAST(s_suppkey % 50 AS VARCHAR) AS city,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL
            ELSE CAST(s_suppkey AS VARCHAR) || ' Main Street' END AS address,
       CAST(10000 + s_suppkey AS VARCHAR) AS postal_code,
       CAST(s_acctbal AS DECIMAL(18,2)) AS square_footage,
       s_suppkey % 50 - 1 AS employee_count
FROM {_LOCATED_SUPPLIER}""",
}
