"""ANSI SQL giving the expected result of every registered query.

The SQL is written straight on the test tables, not on the operational source
tables the builders use, so it checks the derivation as well as the operator.
Shared steps are named CTEs; ``with_ctes`` adds those a query needs.
"""

from __future__ import annotations

import re

# -- expressions ----------------------------------------------------------------


def key(*parts: str, digits: int = 15, separator: str = "|") -> str:
    text = f"concat_ws('{separator}', {', '.join(f'CAST({p} AS VARCHAR)' for p in parts)})"
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


def draw(purpose: str, *parts: str) -> str:
    text = f"concat_ws('|', {', '.join(f'CAST({p} AS VARCHAR)' for p in parts)}, '{purpose}')"
    return f"((CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % 1000000) / 1000000.0)"


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the decimal value; rounding the binary double misses ties like 2.675."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def pct(a: str, b: str) -> str:
    return rnd(f"CAST({a} AS DOUBLE) / greatest(CAST({b} AS DOUBLE), 1.0) * 100.0", 2)


def ratio(a: str, b: str, digits: int = 2) -> str:
    return rnd(f"CAST({a} AS DOUBLE) / greatest(CAST({b} AS DOUBLE), 1.0)", digits)


def avg(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


CUSTOMER_KEY = key("c_custkey", "DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER)")
PRODUCT_KEY = key("p_partkey", "DATE '1995-01-01'")
SITE_KEY = key("s_suppkey", "DATE '1995-01-01'")
CATEGORY_ID = (
    "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4"
    " WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END"
)
#: l_extendedprice / l_quantity at four decimals, rounded half up in integers.
UNIT_PRICE = (
    "CAST((CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) * 200 + CAST(l_quantity AS BIGINT))"
    " // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(15,0)) * CAST(0.0001 AS DECIMAL(5,4))"
)
FAR = "DATE '2100-12-31'"
AS_OF = "DATE '2001-12-01'"

# -- shared steps ----------------------------------------------------------------

CTES = {
    "w_geo": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "w_line": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS qty,
               CAST({UNIT_PRICE} AS DECIMAL(19,4)) AS price, CAST(l_discount AS DECIMAL(18,4)) AS share,
               CAST(round(l_discount * 100) AS BIGINT) AS offer
        FROM lineitem""",
    "w_buyer": f"""
        SELECT c_custkey, {CUSTOMER_KEY} AS customer_key,
               CASE WHEN c_custkey % 5 <> 4 THEN -(c_custkey + 1) END AS person,
               CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 97 END AS store_id
        FROM customer""",
    "w_site": f"SELECT s_suppkey, {SITE_KEY} AS site_key FROM supplier",
    "w_goods": f"SELECT p_partkey, {PRODUCT_KEY} AS product_key FROM part",
    "w_sold": """
        SELECT CAST(o_orderdate AS DATE) AS day, c_custkey AS customer_id, p_partkey AS product_id, b.store_id,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey % 97 END AS employee_id,
               l_orderkey AS order_id, l_linenumber AS line_id, qty,
               CAST(price * qty AS DECIMAL(18,2)) AS revenue,
               CAST(price * qty * share AS DECIMAL(18,2)) AS discount,
               CAST(price AS DECIMAL(18,2)) AS unit_price, share,
               CAST(price * qty * (1 - share) AS DECIMAL(18,2)) AS line_total
        FROM w_line JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN w_buyer b ON o_custkey = b.c_custkey LEFT JOIN w_goods ON l_partkey = p_partkey""",
    "w_sale": """
        SELECT s.day, b.customer_key, g.product_key, coalesce(st.site_key, 0) AS store_key,
               coalesce(em.site_key, 0) AS employee_key, s.*
        FROM w_sold s JOIN w_buyer b ON s.customer_id = b.c_custkey JOIN w_goods g ON s.product_id = g.p_partkey
        LEFT JOIN w_site st ON s.store_id = st.s_suppkey LEFT JOIN w_site em ON s.employee_id = em.s_suppkey""",
    "w_address": """
        SELECT -(c_custkey + 1) AS entity, c_nationkey AS nationkey FROM customer WHERE c_custkey % 31 <> 0
        UNION ALL SELECT s_suppkey, s_nationkey FROM supplier""",
    "w_bought": """
        SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
               min(CAST(o_orderdate AS DATE)) AS first_day
        FROM orders GROUP BY o_custkey""",
    "w_d_customer": f"""
        SELECT b.customer_key, c.c_custkey AS customer_id,
               CASE WHEN b.person IS NOT NULL
                    THEN c_mktsegment || ' ' || CASE WHEN c.c_custkey % 2 = 1 THEN 'Q ' ELSE '' END || c_name
                    WHEN b.store_id IS NOT NULL THEN coalesce(s.s_name, 'Unknown Store')
                    ELSE 'Unknown Customer' END AS customer_name,
               CASE WHEN b.person IS NOT NULL THEN lower(c_name) || '@example.com' ELSE '' END AS email,
               CASE WHEN b.person IS NOT NULL AND c.c_custkey % 7 <> 0
                    THEN '555-' || lpad(CAST(c.c_custkey % 10000 AS VARCHAR), 4, '0') ELSE '' END AS phone,
               coalesce('City ' || CAST(a.nationkey AS VARCHAR), 'Unknown') AS city,
               coalesce(n_name || ' State', 'Unknown') AS state, coalesce(n_name, 'Unknown') AS country,
               coalesce(lpad(CAST(a.nationkey AS VARCHAR), 5, '0'), '00000') AS postal_code,
               CASE WHEN i = 6 THEN 'Premium' WHEN i = 4 THEN 'Gold' WHEN i = 3 THEN 'Silver' WHEN i = 2 THEN 'Bronze'
                    WHEN b.store_id IS NOT NULL THEN 'Business' ELSE 'Standard' END AS segment,
               CASE WHEN b.store_id IS NOT NULL THEN 'Business' WHEN b.person IS NOT NULL THEN 'Individual'
                    ELSE 'Unknown' END AS customer_type,
               CASE WHEN o.n > 0 AND o.first_day > DATE '2000-12-01' THEN 'Active' WHEN o.n > 0 THEN 'Inactive'
                    ELSE 'New' END AS status,
               CAST((CASE WHEN b.store_id IS NOT NULL THEN 10000 ELSE 1000 END)
                  * (CASE WHEN o.n >= 20 THEN 3.0 WHEN o.n >= 10 THEN 2.5 WHEN o.n >= 5 THEN 2.0
                          WHEN o.n >= 1 THEN 1.5 ELSE 1.0 END)
                  * (CASE WHEN o.total > 100000 THEN 2.0 WHEN o.total > 50000 THEN 1.5
                          WHEN o.total > 10000 THEN 1.2 ELSE 1.0 END)
                  * (CASE WHEN i = 6 THEN 1.5 WHEN i IN (3, 4) THEN 1.2 ELSE 1.0 END) AS DECIMAL(18,2)) AS credit,
               CAST(CASE i WHEN 6 THEN 175000 WHEN 5 THEN 125000 WHEN 4 THEN 87500 WHEN 3 THEN 62500
                           WHEN 2 THEN 37500 WHEN 1 THEN 17500 ELSE 0 END AS DECIMAL(18,2)) AS income,
               coalesce(CAST(date_sub('year', o.first_day, {AS_OF}) AS INTEGER), 0) AS years,
               DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS since
        FROM (SELECT *, CASE WHEN c_custkey % 5 = 4 THEN 0 WHEN c_acctbal >= 8000 THEN 6 WHEN c_acctbal >= 6500 THEN 5
                             WHEN c_acctbal >= 5000 THEN 4 WHEN c_acctbal >= 3500 THEN 3 WHEN c_acctbal >= 2000 THEN 2
                             WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS i FROM customer) c
        JOIN w_buyer b ON b.c_custkey = c.c_custkey
        LEFT JOIN supplier s ON b.store_id = s.s_suppkey
        LEFT JOIN w_address a ON a.entity = coalesce(b.person, b.store_id)
        LEFT JOIN nation n ON n.n_nationkey = a.nationkey
        LEFT JOIN w_bought o ON o.o_custkey = c.c_custkey""",
    "w_d_product": f"""
        SELECT product_key, p.p_partkey AS product_id, p_name AS name, 'PN-' || CAST(p.p_partkey AS VARCHAR) AS sku,
               CASE WHEN p.p_partkey % 37 <> 0 THEN p_type ELSE 'Uncategorized' END AS category,
               CASE WHEN p.p_partkey % 37 <> 0 THEN p_type || ' ' || p_brand ELSE 'None' END AS subcategory,
               CASE WHEN p.p_partkey % 37 <> 0 THEN {CATEGORY_ID} END AS category_id,
               CASE WHEN p.p_partkey % 4 <> 0 THEN p_brand
                    ELSE ['Road', 'Mountain', 'Touring', 'Standard', 'Generic'][CAST(p.p_partkey % 5 + 1 AS INTEGER)]
                    END AS brand,
               CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.6 AS DECIMAL(18,2)) AS cost,
               CASE WHEN p.p_partkey % 23 = 0 THEN 'Discontinued' WHEN p.p_partkey % 11 = 0 THEN 'Inactive'
                    WHEN p.p_partkey % 29 = 0 THEN 'Pending' ELSE 'Active' END AS status,
               CASE WHEN p.p_partkey % 6 = 0 THEN 'N/A'
                    ELSE ['Red', 'Black', 'Blue'][CAST(p.p_partkey % 3 + 1 AS INTEGER)] END AS color,
               CASE WHEN p.p_partkey % 10 <> 0 THEN CAST(p_size AS VARCHAR) ELSE 'N/A' END AS size,
               CAST(CASE WHEN p.p_partkey % 9 <> 0 THEN p_size * 1.125 ELSE 0 END AS DECIMAL(10,3)) AS weight,
               CASE WHEN p.p_partkey % 29 = 0 THEN DATE '2002-06-01'
                    ELSE {AS_OF} - CAST(p.p_partkey % 400 AS INTEGER) END AS start_day,
               CASE WHEN p.p_partkey % 11 = 0 THEN DATE '2001-06-30' WHEN p.p_partkey % 11 = 1 THEN DATE '2003-01-01'
                    ELSE {FAR} END AS end_day,
               p_size
        FROM part p JOIN w_goods g ON p.p_partkey = g.p_partkey""",
    "w_d_store": """
        SELECT site_key AS store_key, s.s_suppkey AS store_id, s_name AS name,
               CASE WHEN s.s_suppkey % 8 = 0 THEN CASE WHEN s.s_suppkey % 16 = 3 THEN 'Hall B' ELSE 'Unknown' END
                    ELSE CAST(s.s_suppkey AS VARCHAR) || ' Dock Rd'
                         || CASE WHEN s.s_suppkey % 16 = 3 THEN ' Hall B' ELSE '' END END AS address,
               'City ' || CAST(s_nationkey AS VARCHAR) AS city, n_name || ' State' AS state, n_name AS country,
               lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS postal_code, r_name AS region, n_name AS territory,
               CASE WHEN s.s_suppkey % 7 = 0 OR s.s_suppkey % 3 = 2 THEN 'Retail'
                    WHEN s.s_suppkey % 3 = 0 THEN 'BM' ELSE 'BS' END AS store_type,
               CASE WHEN s.s_suppkey % 9 <> 0 AND s.s_suppkey % 10 <> 9
                    THEN 'Agent Supplier#' || lpad(CAST(s.s_suppkey % 10 AS VARCHAR), 9, '0')
                    ELSE 'Unassigned' END AS manager,
               CASE WHEN s.s_suppkey % 7 = 0 THEN DATE '1995-01-01'
                    ELSE make_date(1970 + CAST(s.s_suppkey % 30 AS INTEGER), 1, 1) END AS opened,
               CAST(CASE WHEN s.s_suppkey % 7 = 0 OR s.s_suppkey % 6 = 1 THEN 1000
                    ELSE 1000 + 10 * s.s_suppkey END AS INTEGER) AS square_feet
        FROM supplier s JOIN w_site USING (s_suppkey) JOIN w_geo ON n_nationkey = s_nationkey""",
    "w_d_employee": """
        SELECT site_key AS employee_key, s.s_suppkey AS employee_id,
               'Agent ' || CASE WHEN s.s_suppkey % 4 = 0 THEN 'J ' ELSE '' END || s_name AS name,
               ['Sales Representative', 'Buyer', 'Supervisor'][CAST(s.s_suppkey % 3 + 1 AS INTEGER)] AS title,
               CASE WHEN s.s_suppkey % 7 = 5 THEN 'Unassigned' ELSE 'Department ' || d.r_name END AS department,
               DATE '1990-01-01' + CAST(s.s_suppkey % 1000 AS INTEGER) AS hired,
               CASE WHEN s.s_suppkey % 13 <> 12 THEN 'Active' ELSE 'Inactive' END AS status,
               CASE WHEN s.s_suppkey % 10 <> 9 AND s.s_suppkey % 6 <> 0 THEN w_geo.r_name ELSE 'N/A' END AS region,
               CASE WHEN s.s_suppkey % 10 <> 9 AND s.s_suppkey % 6 <> 0 THEN w_geo.n_name ELSE 'N/A' END AS territory,
               CAST(CASE WHEN s.s_suppkey % 10 < 8 THEN 1200000 + 1200 * (s.s_suppkey % 50) ELSE 0 END
                    AS DECIMAL(18,2)) AS quota
        FROM supplier s JOIN w_site USING (s_suppkey) JOIN w_geo ON n_nationkey = s_nationkey
        JOIN region d ON d.r_regionkey = s.s_suppkey % 5""",
    "w_d_promotion": f"""
        SELECT {key("offer", "DATE '1995-01-01'")} AS promotion_key, offer,
               'Offer ' || CAST(offer AS VARCHAR) AS name,
               CASE WHEN offer = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS kind,
               CAST(offer AS DECIMAL(5,2)) AS percent,
               DATE '1995-01-01' + CAST(offer * 300 AS INTEGER) AS start_day,
               DATE '1995-01-01' + CAST(offer * 300 + 400 AS INTEGER) AS end_day
        FROM (SELECT DISTINCT offer FROM w_line)""",
    "w_d_category": f"""
        SELECT {key(CATEGORY_ID, "p_type", "p_type")} AS category_key, {CATEGORY_ID} AS category_id, p_type AS name
        FROM (SELECT DISTINCT p_type FROM part)""",
    "w_d_warehouse": f"""
        SELECT {key("r_regionkey", "DATE '1995-01-01'")} AS warehouse_key, r_regionkey AS warehouse_id, r_name AS name
        FROM region""",
    "w_d_territory": f"""
        SELECT {key("n_nationkey", "n_name", "r_name", "'C' || n_nationkey")} AS territory_key, n_nationkey, n_name, r_name
        FROM w_geo""",
    "w_d_region": f"""
        SELECT {key("CAST(id AS VARCHAR) || r_name || '|' || n_name")} AS region_key, id, r_name, n_name
        FROM (SELECT *, row_number() OVER (ORDER BY r_name, n_name, n_nationkey) AS id FROM w_geo)""",
    "w_region_name": "SELECT r_name, min_by(region_key, id) AS region_key FROM w_d_region GROUP BY r_name",
    "w_delivered": """
        SELECT o_orderkey % 97 AS vendor, count(*) AS n,
               count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 15 <= 7) AS on_time
        FROM orders GROUP BY 1""",
    "w_d_vendor": f"""
        SELECT site_key AS vendor_key, s.s_suppkey AS vendor_id, 'Vendor ' || s_name AS name,
               CASE WHEN s.s_suppkey % 6 <> 5 THEN c_mktsegment || ' ' || c_name ELSE 'Unknown' END AS contact,
               CASE WHEN s.s_suppkey % 6 <> 5 THEN lower(c_name) || '@example.com' ELSE '' END AS email,
               CASE WHEN s.s_suppkey % 6 <> 5 AND s.s_suppkey % 7 <> 0
                    THEN '555-' || lpad(CAST(s.s_suppkey % 10000 AS VARCHAR), 4, '0') ELSE '' END AS phone,
               CASE WHEN s.s_suppkey % 8 <> 0 THEN CAST(s.s_suppkey AS VARCHAR) || ' Dock Rd' ELSE '' END
                 || CASE WHEN s.s_suppkey % 16 = 3 THEN ', Hall B' ELSE '' END AS address,
               'City ' || CAST(s_nationkey AS VARCHAR) AS city, n_name AS country,
               CAST((1 + s.s_suppkey % 5) / 5.0 AS DECIMAL(3,2)) AS rating,
               CAST(coalesce({rnd("CAST(on_time AS DOUBLE) / n * 100.0", 2)}, 0) AS DECIMAL(5,2)) AS on_time_rate,
               CASE WHEN s.s_suppkey % 12 <> 11 THEN 'Active' ELSE 'Inactive' END AS status
        FROM supplier s JOIN w_site USING (s_suppkey) JOIN w_geo ON n_nationkey = s_nationkey
        JOIN customer ON c_custkey = s.s_suppkey LEFT JOIN w_delivered ON vendor = s.s_suppkey""",
    "w_purchase": """
        SELECT CAST(o_orderdate AS DATE) AS day, s_suppkey AS vendor_id, l_partkey AS product_id, l_orderkey AS order_id,
               l_linenumber AS line_id, qty, CAST(price * qty AS DECIMAL(18,2)) AS amount,
               CAST(price AS DECIMAL(18,2)) AS unit_price, site_key AS vendor_key, product_key
        FROM w_line JOIN orders ON l_orderkey = o_orderkey JOIN w_goods ON l_partkey = p_partkey
        JOIN w_site ON s_suppkey = o_orderkey % 97""",
    "w_last_store": """
        SELECT l_partkey, arg_max(store_id, (day, l_orderkey, store_id)) AS store_id FROM (
            SELECT l_partkey, l_orderkey, CAST(o_orderdate AS DATE) AS day, store_id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN w_buyer ON c_custkey = o_custkey
            JOIN supplier ON s_suppkey = store_id) GROUP BY l_partkey""",
    "w_stock": f"""
        SELECT i.day, i.l_partkey AS product_id, t.store_id, i.place AS warehouse_id, i.qty,
               CAST(date_diff('day', start_day, {AS_OF}) AS INTEGER) AS aging, 2 * p_size AS reorder, 3 * p_size AS safety,
               p.product_key, coalesce(site_key, 0) AS store_key, warehouse_key, p.list_price, p.cost, p.category
        FROM (SELECT l_partkey, CAST(l_suppkey % 5 AS INTEGER) AS place, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
                     max(CAST(l_shipdate AS DATE)) AS day FROM lineitem GROUP BY 1, 2) i
        JOIN w_d_product p ON p.product_id = i.l_partkey JOIN w_d_warehouse w ON w.warehouse_id = i.place
        LEFT JOIN w_last_store t ON t.l_partkey = i.l_partkey LEFT JOIN w_site ON s_suppkey = t.store_id""",
    "w_made": f"""
        SELECT {key("concat_ws('-', l_orderkey, l_linenumber, l_suppkey)", "l_partkey")} AS run_id,
               CAST(l_shipdate AS DATE) AS day, l_partkey AS product_id, product_key, CAST(l_quantity AS INTEGER) AS qty,
               CAST(CASE WHEN l_linestatus = 'F' THEN 6 * (l_partkey % 40)
                    ELSE date_diff('hour', l_shipdate, TIMESTAMP '2001-12-01') END AS DECIMAL(10,2)) AS hours,
               CAST(CAST(l_quantity AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) // 50 AS INTEGER) AS scrapped
        FROM lineitem JOIN w_goods ON l_partkey = p_partkey""",
    "w_production": f"""
        SELECT *, CAST({rnd("CASE WHEN qty > 0 THEN CAST(scrapped AS DOUBLE) / qty * 100.0 ELSE 0.0 END", 2)}
                  AS DECIMAL(5,2)) AS scrap FROM w_made""",
    "w_staff_sale": """
        SELECT CAST(o_orderdate AS DATE) AS day, e.s_suppkey AS employee_id, st.s_suppkey AS store_id,
               CASE WHEN e.s_suppkey % 6 <> 0 THEN e.s_nationkey END AS territory_id,
               CASE WHEN e.s_suppkey % 10 <> 8 THEN 1200000 + 1200 * (e.s_suppkey % 50) END AS quota,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount, count(DISTINCT o_custkey) AS contacts
        FROM orders JOIN supplier e ON e.s_suppkey = o_orderkey % 97 AND o_orderkey % 2 = 1 AND e.s_suppkey % 10 <> 9
        JOIN w_buyer ON c_custkey = o_custkey LEFT JOIN supplier st ON st.s_suppkey = store_id
        GROUP BY ALL""",
    "w_feedback": """
        SELECT CAST(ts AS DATE) AS day, c.c_custkey AS customer_id, p.category_id, CAST(1 + event_id % 5 AS INTEGER) AS score,
               CASE WHEN event_id % 4 <> 0 THEN props ELSE '' END AS comments
        FROM events JOIN w_d_product p ON p.product_id = event_id // 5
        LEFT JOIN w_buyer c ON c.c_custkey = user_id AND c.person IS NOT NULL""",
    "w_promoted": """
        SELECT CAST(o_orderdate AS DATE) AS day, l_partkey AS product_id, store_id, offer,
               CAST(sum(price * qty * (1 - share)) AS DECIMAL(18,2)) AS sales, count(*) AS uses,
               count(DISTINCT o_custkey) AS buyers
        FROM w_line JOIN orders ON l_orderkey = o_orderkey JOIN w_buyer ON c_custkey = o_custkey GROUP BY 1, 2, 3, 4""",
    "w_invoice": """
        SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS customer_id, customer_key, store_id,
               coalesce(site_key, 0) AS store_key, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 5 WHEN o_totalprice < 100 THEN 1
                         WHEN o_totalprice < 1000 THEN 2 WHEN o_totalprice <= 10000 THEN 3 ELSE 4 END AS BIGINT) AS category,
               CAST(CASE WHEN o_orderstatus <> 'O' THEN o_orderkey * 7 % 75 - 30 ELSE 0 END AS INTEGER) AS delay,
               CAST(o_orderkey AS VARCHAR) AS number,
               CASE WHEN o_orderstatus = 'F' THEN 'Shipped' ELSE 'Pending' END AS status
        FROM orders JOIN w_buyer ON c_custkey = o_custkey LEFT JOIN w_site ON s_suppkey = store_id""",
    "w_returned": f"""
        SELECT *, CAST(CASE WHEN qty = 1 THEN 1 ELSE greatest(1, CAST(round(qty * u_quantity * 0.5) AS INTEGER)) END
                  AS INTEGER) AS back
        FROM (SELECT w_line.*, o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, store_id, customer_key, product_key,
                     coalesce(site_key, 0) AS store_key,
                     {", ".join(f"{draw(p, 'l_orderkey', 'l_linenumber', 'l_partkey', 'price')} AS u_{p}"
                                for p in ("sample", "days", "reason", "quantity", "fee", "method", "condition"))}
              FROM w_line JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'
              JOIN w_buyer ON c_custkey = o_custkey JOIN w_goods ON p_partkey = l_partkey
              LEFT JOIN w_site ON s_suppkey = store_id)
        WHERE u_sample < 0.08""",
    "w_back": """
        SELECT day + 15 + CAST(round(u_days * 45) AS INTEGER) AS back_day, l_partkey AS product_id,
               o_custkey AS customer_id, store_id, product_key, customer_key, store_key,
               CAST(CASE WHEN u_reason < 0.15 THEN 4 WHEN u_reason < 0.35 THEN 3 WHEN u_reason < 0.6 THEN 2 ELSE 1 END
                    AS BIGINT) AS reason,
               back, CAST(price * back AS DECIMAL(18,2)) AS refund,
               CAST(CASE WHEN u_fee < 0.7 THEN 0 ELSE price * CAST(0.15 AS DECIMAL(3,2)) * back END
                    AS DECIMAL(18,2)) AS fee,
               'RET-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS return_id,
               CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 2 = 1 THEN 'Direct' WHEN u_method < 0.5 THEN 'Mail' ELSE 'Store' END AS method,
               CASE WHEN u_condition < 0.15 THEN 'Damaged' WHEN u_condition < 0.3 THEN 'Opened'
                    WHEN u_condition < 0.5 THEN 'Like New' ELSE 'New/Sealed' END AS state
        FROM w_returned""",
    "w_sale_wide": """
        SELECT s.*, p.cost, p.category, revenue - discount AS net, revenue - discount - qty * p.cost AS gross
        FROM w_sale s LEFT JOIN w_d_product p ON p.product_key = s.product_key""",
    "w_sale_category": """
        SELECT s.*, coalesce(category_key, 0) AS category_key
        FROM w_sale_wide s LEFT JOIN w_d_category c ON c.name = s.category""",
    "w_sale_region": """
        SELECT s.*, coalesce(region_key, 0) AS region_key, coalesce(territory_key, 0) AS territory_key
        FROM w_sale_category s LEFT JOIN w_d_store t ON t.store_key = s.store_key
        LEFT JOIN w_region_name r ON r.r_name = t.region LEFT JOIN w_d_territory d ON d.n_name = t.territory""",
    "w_order_month": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(o_totalprice AS DECIMAL(18,2)) AS due FROM orders""",
    # -- late members --
    "w_late_buyer": "SELECT * FROM w_buyer WHERE c_custkey % 50 <> 7",
    "w_late_goods": "SELECT * FROM w_goods WHERE p_partkey % 40 <> 3",
    "w_late": """
        SELECT s.*, b.customer_key, g.product_key, coalesce(st.site_key, 0) AS store_key,
               coalesce(em.site_key, 0) AS employee_key,
               CASE WHEN b.customer_key IS NULL THEN 'FK miss: DimCustomer.CustomerID=' || CAST(customer_id AS VARCHAR)
                    || ' not found (IsCurrent=1)' END AS miss_1,
               CASE WHEN g.product_key IS NULL THEN 'FK miss: DimProduct.ProductID=' || CAST(product_id AS VARCHAR)
                    || ' not found (IsCurrent=1)' END AS miss_2
        FROM w_sold s LEFT JOIN w_late_buyer b ON s.customer_id = b.c_custkey
        LEFT JOIN w_late_goods g ON s.product_id = g.p_partkey
        LEFT JOIN w_site st ON s.store_id = st.s_suppkey LEFT JOIN w_site em ON s.employee_id = em.s_suppkey""",
    # -- versions: what the three daily images leave behind --
    "w_versions": f"""
        SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, DATE '1996-01-01' AS valid_from,
               CASE WHEN c_custkey % 17 = 5 OR c_custkey % 10 = 3 THEN DATE '2000-01-01' ELSE {FAR} END AS valid_to,
               CASE WHEN c_custkey % 17 = 5 OR c_custkey % 10 = 3 THEN 0 ELSE 1 END AS live, 1 AS version
        FROM customer WHERE c_custkey % 13 <> 1
        UNION ALL
        SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 IN (3, 4) THEN 'NEXT ' ELSE '' END || c_mktsegment,
               DATE '2000-01-01', {FAR}, 1, CASE WHEN c_custkey % 13 = 1 THEN 1 ELSE 2 END
        FROM customer WHERE c_custkey % 17 <> 5 AND (c_custkey % 10 = 3 OR c_custkey % 13 = 1)""",
    "w_history": f"""
        SELECT {key("id", "valid_from")} AS "CustomerKey", id AS "CustomerID", name AS "CustomerName",
               segment AS "CustomerSegment", valid_from AS "ValidFromDate", valid_to AS "ValidToDate",
               live AS "IsCurrent", CAST(version AS BIGINT) AS "Version"
        FROM w_versions""",
    "w_part_1": """SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, 1 AS day FROM part
                 WHERE p_partkey % 19 <> 4""",
    "w_part_2": """SELECT p_partkey AS id, p_name AS name,
                        CASE WHEN p_partkey % 7 = 2 THEN p_retailprice + 10 ELSE p_retailprice END AS price, 2 AS day
                 FROM part WHERE p_partkey % 23 <> 6""",
    "w_parts": f"""SELECT {key("id", "day")} AS "ProductKey", id AS "ProductID", name AS "ProductName",
                        CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS "ListPrice", day
                 FROM (SELECT * FROM w_part_1 UNION ALL SELECT * FROM w_part_2)""",
    # -- the error log --
    "w_errors": """
        SELECT event_id AS id, ts, k, user_id, value,
               ['FactSales', 'FactPurchases', 'FactReturns'][CAST(user_id % 3 + 1 AS INTEGER)] AS source,
               CASE WHEN k < 50 THEN 'FK_MISS' WHEN k < 65 THEN 'VALIDATION_FAIL' WHEN k < 75 THEN 'OUT_OF_RANGE'
                    WHEN k < 85 THEN 'TYPE_MISMATCH' WHEN k < 92 THEN 'NULL_PK' ELSE 'TIMEOUT' END AS kind,
               CASE WHEN k BETWEEN 85 AND 91 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
               'CustomerID=' || CAST(user_id AS VARCHAR) || ' not found' AS message,
               CASE WHEN k % 4 <> 0 THEN 1 ELSE 0 END AS recoverable, k % 5 AS retries,
               CASE WHEN k % 5 > 0 THEN ts + to_hours(k % 24) END AS last_try,
               CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS resolved
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'error')""",
    "w_due": """
        SELECT * FROM w_errors WHERE resolved = 0 AND recoverable = 1 AND retries < 3""",
    "w_retried": f"""
        SELECT d.*, CASE WHEN user_id % 2 = 0 AND c_custkey IS NOT NULL THEN {key("user_id")} END AS customer_key
        FROM w_due d LEFT JOIN customer ON c_custkey = user_id""",
    "w_doubled": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        WHERE l_partkey % 3 = 0""",
}

_WORD = re.compile(r"[a-z_0-9]+")


def with_ctes(sql: str) -> str:
    """``sql`` preceded by the shared steps it refers to, in definition order."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        for word in set(_WORD.findall(pending.pop())):
            if word in CTES and word not in needed:
                needed.add(word)
                pending.append(CTES[word])
    if not needed:
        return sql.strip()
    steps = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in _by_dependency(needed))
    own = sql.strip()
    return f"WITH {steps},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {steps}\n{own}"


def _by_dependency(names: set[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for word in sorted(set(_WORD.findall(CTES[name]))):
            if word in names and word != name:
                visit(word)
        ordered.append(name)

    for name in CTES:
        if name in names:
            visit(name)
    return ordered


# -- queries ----------------------------------------------------------------------

_VALIDITY = f"""{FAR} AS "ValidToDate", 1 AS "IsCurrent" """


def _calendar(day: str) -> str:
    return (
        f'{day} AS "DateKey", CAST(year({day}) AS INTEGER) AS "Year", CAST(month({day}) AS INTEGER) AS "Month",'
        f' monthname({day}) AS "MonthName"'
    )


_GROSS_BANDS = """CASE WHEN gross > net * 0.3 THEN 'High Margin' WHEN gross > net * 0.15 THEN 'Medium Margin'
    ELSE 'Low Margin' END"""

#: sums and distinct counts of the sales of one member
_MEMBER_SUMS = """CAST(sum(qty) AS BIGINT) AS quantity, sum(revenue) AS revenue, sum(discount) AS discount, sum(net) AS net,
    sum(gross) AS gross, CAST(sum(revenue) AS DOUBLE) / count(*) AS average, min(day) AS first_day, max(day) AS last_day,
    count(*) AS n, count(DISTINCT day) AS days, count(DISTINCT store_key) AS stores,
    count(DISTINCT product_key) AS products, count(DISTINCT employee_key) AS employees,
    count(DISTINCT customer_key) AS customers"""


def _by_member(member: str) -> str:
    return f"(SELECT {member}, {_MEMBER_SUMS} FROM w_sale_wide GROUP BY {member})"


_LATE_OUT = """day AS "SalesDateKey", customer_key AS "CustomerKey", product_key AS "ProductKey", store_key AS "StoreKey",
    employee_key AS "EmployeeKey", order_id AS "SalesOrderID", line_id AS "SalesOrderDetailID", qty AS "QuantitySold",
    CAST(revenue AS DOUBLE) AS "SalesRevenue", CAST(discount AS DOUBLE) AS "DiscountAmount", 1 AS "NumberOfTransactions",
    CAST(unit_price AS DOUBLE) AS "UnitPrice", CAST(share AS DOUBLE) AS "UnitPriceDiscount",
    CAST(line_total AS DOUBLE) AS "LineTotal" """
_SOLD_OUT = """day AS "SalesDateKey", customer_id AS "CustomerID", product_id AS "ProductID", store_id AS "StoreID",
    employee_id AS "EmployeeID", order_id AS "SalesOrderID", line_id AS "SalesOrderDetailID", qty AS "QuantitySold",
    CAST(revenue AS DOUBLE) AS "SalesRevenue", CAST(discount AS DOUBLE) AS "DiscountAmount", 1 AS "NumberOfTransactions",
    CAST(unit_price AS DOUBLE) AS "UnitPrice", CAST(share AS DOUBLE) AS "UnitPriceDiscount",
    CAST(line_total AS DOUBLE) AS "LineTotal" """
_DAILY = """SELECT day AS "SalesDateKey", store_key AS "StoreKey", category_key AS "ProductCategoryKey",
    CAST(sum(revenue) AS DOUBLE) AS "RevenueSum", CAST(sum(qty) AS BIGINT) AS "QuantitySum",
    CAST(sum(discount) AS DOUBLE) AS "DiscountSum", count(*) AS "TransactionCount" FROM w_sale_category"""
_RETRY_STAMP = "TIMESTAMP '2024-01-30 00:00:00'"

_SQL = {
    # dimensions
    "dim_customer_build": f"""
        SELECT customer_key AS "CustomerKey", customer_id AS "CustomerID", customer_name AS "CustomerName", email AS "Email",
               phone AS "Phone", city AS "City", state AS "StateProvince", country AS "Country",
               postal_code AS "PostalCode", segment AS "CustomerSegment", customer_type AS "CustomerType",
               status AS "AccountStatus", CAST(credit AS DOUBLE) AS "CreditLimit", CAST(income AS DOUBLE) AS "AnnualIncome",
               years AS "YearsSinceFirstPurchase", since AS "ValidFromDate", {_VALIDITY}, since AS "SourceUpdateDate",
               since AS "EffectiveStartDate", {FAR} AS "EffectiveEndDate", CAST(1 AS BIGINT) AS "Version"
        FROM w_d_customer""",
    "dim_product_build": f"""
        SELECT product_key AS "ProductKey", product_id AS "ProductID", name AS "ProductName", sku AS "SKU",
               category AS "Category", subcategory AS "SubCategory", brand AS "Brand",
               CAST(list_price AS DOUBLE) AS "ListPrice", CAST(cost AS DOUBLE) AS "Cost", status AS "ProductStatus",
               color AS "Color", size AS "Size", CAST(weight AS DOUBLE) AS "Weight", start_day AS "ValidFromDate",
               {_VALIDITY}, DATE '1995-01-01' AS "SourceUpdateDate", start_day AS "EffectiveStartDate",
               end_day AS "EffectiveEndDate", CAST(1 AS BIGINT) AS "Version"
        FROM w_d_product""",
    "dim_store_build": f"""
        SELECT store_key AS "StoreKey", store_id AS "StoreID", name AS "StoreName", store_id AS "StoreNumber",
               address AS "Address", city AS "City", state AS "StateProvince", country AS "Country",
               postal_code AS "PostalCode", region AS "Region", territory AS "Territory", store_type AS "StoreType",
               'Active' AS "StoreStatus", manager AS "ManagerName", opened AS "OpeningDate",
               square_feet AS "SquareFootage", DATE '1995-01-01' AS "ValidFromDate", {_VALIDITY},
               DATE '1995-01-01' AS "SourceUpdateDate", CAST(1 AS BIGINT) AS "Version"
        FROM w_d_store""",
    "dim_employee_build": f"""
        SELECT employee_key AS "EmployeeKey", employee_id AS "EmployeeID", name AS "EmployeeName", title AS "JobTitle",
               department AS "Department", CAST(NULL AS BIGINT) AS "ReportingManagerKey", hired AS "HireDate",
               status AS "EmployeeStatus", region AS "Region", territory AS "Territory",
               CAST(quota AS DOUBLE) AS "SalesQuota", hired AS "ValidFromDate", {_VALIDITY},
               DATE '1995-01-01' AS "SourceUpdateDate", CAST(1 AS BIGINT) AS "Version"
        FROM w_d_employee""",
    "dim_promotion_build": f"""
        SELECT promotion_key AS "PromotionKey", offer AS "PromotionID", name AS "PromotionName",
               name AS "PromotionDescription", kind AS "PromotionType", CAST(percent AS DOUBLE) AS "DiscountPercentage",
               CAST(0 AS DOUBLE) AS "DiscountAmount",
               CASE WHEN {AS_OF} < start_day THEN 'Scheduled' WHEN {AS_OF} > end_day THEN 'Expired' ELSE 'Active' END
                 AS "PromotionStatus",
               CASE WHEN offer % 2 = 0 THEN 'Reseller' ELSE 'Customer' END AS "TargetCustomerSegment",
               offer AS "CampaignID", CAST(NULL AS BIGINT) AS "TargetProductKey", start_day AS "StartDate",
               end_day AS "EndDate", CASE WHEN {AS_OF} BETWEEN start_day AND end_day THEN 1 ELSE 0 END AS "IsActive"
        FROM w_d_promotion""",
    "dim_product_category_build": """
        SELECT category_key AS "ProductCategoryKey", category_id AS "ProductCategoryID", name AS "CategoryName",
               name AS "CategoryDescription" FROM w_d_category""",
    "dim_warehouse_build": f"""
        SELECT warehouse_key AS "WarehouseKey", warehouse_id AS "WarehouseID", name AS "WarehouseName", name AS "Location",
               'Manufacturing' AS "WarehouseType", CAST(NULL AS BIGINT) AS "ManagerKey",
               DATE '1995-01-01' AS "ValidFromDate", {_VALIDITY}, CAST(1 AS BIGINT) AS "Version"
        FROM w_d_warehouse""",
    "dim_sales_territory_build": """
        SELECT territory_key AS "TerritoryKey", n_nationkey AS "TerritoryID", n_name AS "TerritoryName",
               r_name AS "SalesRegion", 'C' || CAST(n_nationkey AS VARCHAR) AS "Country", 'TBD' AS "Manager",
               n_nationkey * CAST(1000.5 AS DOUBLE) AS "SalesTarget"
        FROM w_d_territory""",
    "dim_vendor_build": f"""
        SELECT vendor_key AS "VendorKey", vendor_id AS "VendorID", name AS "VendorName", contact AS "ContactPerson",
               email AS "Email", phone AS "Phone", address AS "Address", city AS "City", country AS "Country",
               CAST(rating AS DOUBLE) AS "VendorRating", CAST(on_time_rate AS DOUBLE) AS "OnTimeDeliveryRate",
               CAST(85 AS DOUBLE) AS "QualityScore", 'Net 30' AS "PaymentTerms", status AS "VendorStatus",
               DATE '1995-01-01' AS "ValidFromDate", {_VALIDITY}, DATE '1995-01-01' AS "SourceUpdateDate",
               CAST(1 AS BIGINT) AS "Version"
        FROM w_d_vendor""",
    "dim_region_build": """
        SELECT region_key AS "RegionKey", id AS "RegionID", r_name AS "RegionName", n_name AS "Country",
               r_name AS "Continent", 'UTC' AS "TimeZone" FROM w_d_region""",
    "dim_date_build": """
        WITH days AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                             INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
        parts AS (SELECT d, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS n,
                         CAST(isodow(d) AS INTEGER) AS w, CAST(year(d) AS INTEGER) AS y FROM days),
        named AS (SELECT *, CASE
            WHEN m = 1 AND n = 1 THEN 'New Year''s Day'
            WHEN m = 1 AND w = 1 AND (n - 1) // 7 = 2 THEN 'Martin Luther King Jr. Day'
            WHEN m = 2 AND w = 1 AND (n - 1) // 7 = 2 THEN 'Presidents'' Day'
            WHEN m = 5 AND w = 1 AND month(d + 7) = 6 THEN 'Memorial Day'
            WHEN m = 7 AND n = 4 THEN 'Independence Day'
            WHEN m = 9 AND w = 1 AND n <= 7 THEN 'Labor Day'
            WHEN m = 10 AND w = 1 AND (n - 1) // 7 = 1 THEN 'Columbus Day'
            WHEN m = 11 AND n = 11 THEN 'Veterans Day'
            WHEN m = 11 AND w = 4 AND (n - 1) // 7 = 3 THEN 'Thanksgiving'
            WHEN m = 12 AND n = 25 THEN 'Christmas Day' ELSE '' END AS holiday FROM parts)
        SELECT d AS "DateKey", y AS "Year", CAST(quarter(d) AS INTEGER) AS "Quarter", m AS "Month",
               monthname(d) AS "MonthName", CAST(weekofyear(d) AS INTEGER) AS "Week", w AS "DayOfWeek",
               dayname(d) AS "DayName", n AS "DayOfMonth", CAST(dayofyear(d) AS INTEGER) AS "DayOfYear",
               CAST(weekofyear(d) AS INTEGER) AS "WeekOfYear", CASE WHEN w >= 6 THEN 1 ELSE 0 END AS "IsWeekend",
               CASE WHEN holiday <> '' THEN 1 ELSE 0 END AS "IsHoliday", holiday AS "HolidayName",
               CASE WHEN m >= 7 THEN y + 1 ELSE y END AS "FiscalYear",
               CAST([3, 3, 3, 4, 4, 4, 1, 1, 1, 2, 2, 2][m] AS INTEGER) AS "FiscalQuarter",
               CASE WHEN m >= 7 THEN m - 6 ELSE m + 6 END AS "FiscalMonth",
               CASE WHEN m IN (12, 1, 2) THEN 'Winter' WHEN m <= 5 THEN 'Spring' WHEN m <= 8 THEN 'Summer'
                    ELSE 'Fall' END AS "Season"
        FROM named""",
    # facts with natural keys
    "fact_sales_build": f"SELECT {_SOLD_OUT} FROM w_sold",
    "fact_purchases_build": """
        SELECT day AS "PurchaseDateKey", vendor_id AS "VendorID", product_id AS "ProductID", order_id AS "PurchaseOrderID",
               line_id AS "PurchaseOrderDetailID", qty AS "QuantityBought", CAST(amount AS DOUBLE) AS "PurchaseAmount",
               CAST(0 AS DOUBLE) AS "DiscountAmount", 1 AS "NumberOfTransactions",
               CAST(unit_price AS DOUBLE) AS "UnitPrice", CAST(0 AS DOUBLE) AS "UnitPriceDiscount",
               CAST(amount AS DOUBLE) AS "LineTotal"
        FROM w_purchase""",
    "fact_inventory_build": """
        SELECT day AS "InventoryDateKey", product_id AS "ProductID", store_id AS "StoreID", warehouse_id AS "WarehouseID",
               qty AS "QuantityOnHand", aging AS "StockAging", reorder AS "ReorderLevel", safety AS "SafetyStockLevels"
        FROM w_stock""",
    "fact_production_build": """
        SELECT run_id AS "ProductionRunID", day AS "ProductionDateKey", product_id AS "ProductID",
               CAST(NULL AS BIGINT) AS "SupervisorID", qty AS "UnitsProduced", CAST(hours AS DOUBLE) AS "ProductionTimeHours",
               CAST(scrap AS DOUBLE) AS "ScrapRatePercent", scrapped AS "DefectCount" FROM w_production""",
    "fact_employee_sales_build": f"""
        SELECT day AS "SalesDateKey", employee_id AS "EmployeeID", store_id AS "StoreID", territory_id AS "TerritoryID",
               CAST(amount AS DOUBLE) AS "SalesAmount", CAST(coalesce(quota, 0) // 12 AS DOUBLE) AS "SalesTarget",
               CASE WHEN quota > 0 THEN {rnd("CAST(amount AS DOUBLE) / (CAST(quota AS DOUBLE) / 12.0) * 100.0", 4)}
                    ELSE 0.0 END AS "TargetAttainment",
               contacts AS "CustomerContactsCount" FROM w_staff_sale""",
    "fact_customer_feedback_build": """
        SELECT day AS "FeedbackDateKey", customer_id AS "CustomerID", CAST(NULL AS BIGINT) AS "EmployeeID",
               category_id AS "FeedbackCategoryID", score AS "FeedbackScore",
               CASE WHEN score < 3 THEN 1 ELSE 0 END AS "ComplaintCount", CAST(0 AS DOUBLE) AS "ResolutionTimeHours",
               CAST(score * 20 AS DOUBLE) AS "CSATScore", comments AS "Comments", 'Online' AS "Channel" FROM w_feedback""",
    "fact_promotion_response_build": f"""
        SELECT day AS "PromotionDateKey", product_id AS "ProductID", store_id AS "StoreID", offer AS "PromotionID",
               CAST(sales AS DOUBLE) AS "SalesDuringCampaign", uses AS "DiscountUsageCount",
               {rnd("CAST(buyers AS DOUBLE) / uses", 4)} AS "CustomerUptakeRate", CAST(0 AS DOUBLE) AS "PromotionROI"
        FROM w_promoted""",
    "fact_finance_build": """
        SELECT day AS "InvoiceDateKey", customer_id AS "CustomerID", store_id AS "StoreID", category AS "FinanceCategoryKey",
               CAST(amount AS DOUBLE) AS "InvoiceAmount", delay AS "PaymentDelayDays", CAST(0 AS DOUBLE) AS "CreditUsagePct",
               CAST(0 AS DOUBLE) AS "InterestCharges", number AS "InvoiceNumber", status AS "PaymentStatus",
               'USD' AS "CurrencyCode" FROM w_invoice""",
    "fact_returns_build": """
        SELECT back_day AS "ReturnDateKey", product_id AS "ProductID", customer_id AS "CustomerID", store_id AS "StoreID",
               reason AS "ReturnReasonKey", back AS "ReturnedQuantity", CAST(refund AS DOUBLE) AS "RefundAmount",
               CAST(fee AS DOUBLE) AS "RestockingFee", return_id AS "ReturnID", order_id AS "OriginalSalesID",
               method AS "ReturnMethod", state AS "ConditionOnReturn" FROM w_back""",
    # keys and late members
    "fact_sales_resolved": f"SELECT {_LATE_OUT} FROM w_sale",
    "fk_resolve_valid": f"SELECT {_LATE_OUT} FROM w_late WHERE miss_1 IS NULL AND miss_2 IS NULL",
    "fk_resolve_errors": """
        SELECT CAST(order_id AS VARCHAR) || '-' || CAST(line_id AS VARCHAR) AS "RecordNaturalKey",
               concat_ws('; ', miss_1, miss_2) AS "ErrorMessage"
        FROM w_late WHERE miss_1 IS NOT NULL OR miss_2 IS NOT NULL""",
    "error_records_build": f"""
        SELECT {key("'batch_1'", "'FactSales'", "nk", "msg", "payload")} AS "ErrorID",
               TIMESTAMP '2001-12-01 00:00:00' AS "ErrorDate", 'FactSales' AS "SourceTable", nk AS "RecordNaturalKey",
               'FK_MISS' AS "ErrorType", 'WARNING' AS "ErrorSeverity", msg AS "ErrorMessage", payload AS "FailedData",
               'batch_1' AS "ProcessingBatchID", 'load_fact_factsales' AS "TaskName", 1 AS "IsRecoverable",
               0 AS "RetryCount", CAST(NULL AS TIMESTAMP) AS "LastAttemptDate", 0 AS "IsResolved",
               CAST(NULL AS VARCHAR) AS "ResolutionComment"
        FROM (SELECT CAST(order_id AS VARCHAR) || '-' || CAST(line_id AS VARCHAR) AS nk, coalesce(miss_1, miss_2) AS msg,
                     '{{"sample":{{"SalesDateKey":"' || CAST(day AS VARCHAR)
                     || '","CustomerID":' || customer_id || ',"ProductID":' || product_id
                     || ',"StoreID":' || coalesce(CAST(store_id AS VARCHAR), 'null')
                     || ',"EmployeeID":' || coalesce(CAST(employee_id AS VARCHAR), 'null')
                     || ',"SalesOrderID":' || order_id || ',"SalesOrderDetailID":' || line_id
                     || ',"QuantitySold":' || qty || '}}}}' AS payload
              FROM w_late WHERE miss_1 IS NOT NULL OR miss_2 IS NOT NULL)""",
    "late_dim_default": """
        SELECT CAST(year(day) AS INTEGER) AS "SalesYear", count(*) AS "LoadedRows", count(miss_1) AS "UnknownCustomers",
               count(miss_2) AS "UnknownProducts", CAST(sum(revenue) AS DOUBLE) AS "Revenue" FROM w_late GROUP BY 1""",
    "late_dim_query_time": """
        SELECT CASE WHEN l.customer_key IS NOT NULL THEN d.segment END AS "CustomerSegment", count(*) AS "SalesRows",
               CAST(sum(revenue) AS DOUBLE) AS "Revenue"
        FROM w_late l JOIN w_d_customer d ON d.customer_id = l.customer_id GROUP BY 1""",
    "dq_fk_miss_rate": f"""
        WITH counts AS (SELECT count(*) AS n, count(miss_1) AS a, count(miss_2) AS b,
                        count(*) FILTER (WHERE store_key = 0) AS c, count(*) FILTER (WHERE employee_key = 0) AS d FROM w_late),
        listed AS (SELECT n, unnest(['CustomerKey', 'ProductKey', 'StoreKey', 'EmployeeKey']) AS k,
                          unnest([a, b, c, d]) AS m FROM counts)
        SELECT k AS "ForeignKey", n AS "RowCount", m AS "Misses", {rnd("CAST(m AS DOUBLE) / n", 4)} AS "MissRate",
               CASE WHEN {rnd("CAST(m AS DOUBLE) / n", 4)} > 0.05 THEN 1 ELSE 0 END AS "Alert" FROM listed""",
    # versions
    "scd2_history": "SELECT * FROM w_history",
    "scd2_current": 'SELECT * FROM w_history WHERE "IsCurrent" = 1',
    "scd2_expired": 'SELECT * FROM w_history WHERE "IsCurrent" = 0',
    "scd2_new": """
        SELECT c_custkey AS "CustomerID", CASE WHEN c_custkey % 13 = 1 THEN 'NEW' ELSE 'CHANGED' END AS action,
               CASE WHEN c_custkey % 10 IN (3, 4) THEN 'NEXT ' ELSE '' END || c_mktsegment AS "CustomerSegment",
               DATE '2000-01-01' AS "ValidFromDate"
        FROM customer WHERE c_custkey % 17 <> 5 AND (c_custkey % 13 = 1 OR c_custkey % 10 = 3)""",
    "scd2_reappeared": f"""
        SELECT * FROM w_history UNION ALL
        SELECT {key("c_custkey", "DATE '2001-01-01'")}, c_custkey, c_name,
               CASE WHEN c_custkey % 10 IN (3, 4) THEN 'NEXT ' ELSE '' END || c_mktsegment, DATE '2001-01-01', {FAR}, 1,
               CAST(CASE WHEN c_custkey % 13 = 1 THEN 1 ELSE 2 END AS BIGINT)
        FROM customer WHERE c_custkey % 17 = 5""",
    "sync_summary": """
        SELECT count(*) FILTER (WHERE c_custkey % 17 <> 5 AND (c_custkey % 13 = 1 OR c_custkey % 10 = 3)) AS inserted,
               count(*) FILTER (WHERE c_custkey % 17 <> 5 AND c_custkey % 13 <> 1 AND c_custkey % 10 = 3) AS updated,
               count(*) FILTER (WHERE c_custkey % 17 = 5 AND c_custkey % 13 <> 1) AS deleted, CAST(0 AS BIGINT) AS errors
        FROM customer""",
    "scd1_upsert": """
        SELECT coalesce(a."ProductKey", b."ProductKey") AS "ProductKey", b."ProductID", b."ProductName", b."ListPrice"
        FROM w_parts b LEFT JOIN w_parts a ON a."ProductID" = b."ProductID" AND a.day = 1 WHERE b.day = 2""",
    "scd1_summary": """
        SELECT count(*) FILTER (WHERE a.id IS NULL) AS inserted, count(*) FILTER (WHERE a.price <> b.price) AS updated,
               count(*) FILTER (WHERE b.id IS NULL) AS deleted, CAST(0 AS BIGINT) AS errors
        FROM w_part_1 a FULL JOIN w_part_2 b ON a.id = b.id""",
    "dedup_latest": """
        SELECT o_custkey AS "CustomerID", o_orderkey AS "SalesOrderID", CAST(o_orderdate AS DATE) AS "OrderDate"
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "latest_versions": """
        SELECT * REPLACE (CASE WHEN "CustomerID" % 3 = 0 THEN "Version" + 5 ELSE "Version" END AS "Version")
        FROM w_history""",
    "asof_dim_lookup": """
        SELECT * FROM w_history WHERE "ValidFromDate" <= DATE '1999-06-01' AND "ValidToDate" > DATE '1999-06-01'""",
    "asof_sales_by_region": """
        SELECT coalesce(segment, 'Unknown') AS "CustomerSegment",
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS "TotalRevenue", count(*) AS "OrderCount"
        FROM orders LEFT JOIN w_versions ON id = o_custkey AND valid_from <= CAST(o_orderdate AS DATE)
             AND valid_to > CAST(o_orderdate AS DATE) GROUP BY 1""",
    # cleaning
    "clean_values": """
        SELECT o_orderkey AS "OrderID", CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS "CustomerID",
               CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_custkey END AS "Contacts",
               CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' END
                 AS "OrderDateText",
               CASE WHEN o_orderkey % 11 = 0 THEN TIMESTAMP '2100-12-31' ELSE date_trunc('day', o_orderdate) END AS "DueDate",
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS "Total" FROM orders""",
    "coerce_date": f"""
        SELECT o_orderkey AS "OrderID",
               CASE WHEN o_orderkey % 4 IN (0, 1) THEN {AS_OF} ELSE CAST(o_orderdate AS DATE) END AS "OrderDay" FROM orders""",
    "surrogate_keys": f"""
        SELECT c_custkey AS "CustomerID", {key("c_custkey", "'2014-09-12'", digits=8, separator="")} AS "CompactKey",
               {key("c_custkey", "'2014-09-12'")} AS "WideKey" FROM customer""",
    "key_collisions": """
        SELECT "LineKey", count(DISTINCT line) AS "Members" FROM (
            SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey) AS line,
                   CAST('0x' || substr(md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey)), 1, 8) AS BIGINT) AS "LineKey"
            FROM lineitem) GROUP BY 1 HAVING count(DISTINCT line) > 1""",
    # roll-ups
    "agg_daily_sales": f"{_DAILY} GROUP BY 1, 2, 3",
    "agg_daily_sales_increment": f"{_DAILY} WHERE day = DATE '1998-03-02' AND category_key <> 0 GROUP BY 1, 2, 3",
    "agg_weekly_sales": f"""
        SELECT CAST(date_trunc('week', day) AS DATE) AS "WeekStartDateKey", region_key AS "RegionKey",
               category_key AS "ProductCategoryKey", CAST(sum(revenue) AS DOUBLE) AS "RevenueSum",
               {rnd("CAST(sum(revenue) AS DOUBLE) / count(*)", 2)} AS "RevenueAvg", CAST(min(revenue) AS DOUBLE) AS "RevenueMin",
               CAST(max(revenue) AS DOUBLE) AS "RevenueMax", CAST(sum(qty) AS BIGINT) AS "QuantitySum"
        FROM w_sale_region GROUP BY 1, 2, 3""",
    "agg_monthly_sales": f"""
        SELECT CAST(date_trunc('month', day) AS DATE) AS "MonthStartDateKey",
               CAST(['Premium', 'Gold', 'Silver', 'Bronze', 'Standard', 'Business'].list_position(c.segment) AS BIGINT)
                 AS "CustomerSegmentKey",
               region_key AS "RegionKey", CAST(sum(revenue) AS DOUBLE) AS "RevenueSum",
               {rnd("CAST(sum(revenue) AS DOUBLE) / count(*)", 2)} AS "AvgOrderValue",
               count(DISTINCT s.customer_key) AS "DistinctCustomers"
        FROM w_sale_region s JOIN w_d_customer c ON c.customer_key = s.customer_key GROUP BY 1, 2, 3""",
    "agg_daily_inventory": f"""
        SELECT day AS "InventoryDateKey", warehouse_key AS "WarehouseKey", coalesce(category_key, 0) AS "ProductCategoryKey",
               CAST(CASE WHEN aging < 0 THEN 0 WHEN aging <= 30 THEN 1 WHEN aging <= 90 THEN 2 WHEN aging <= 180 THEN 3
                         ELSE 4 END AS BIGINT) AS "AgingTierKey",
               {rnd(avg("qty * cost"), 2)} AS "AvgInventoryValue", {avg("qty")} AS "AvgQuantityOnHand"
        FROM w_stock LEFT JOIN w_d_category ON name = category GROUP BY 1, 2, 3, 4""",
    "agg_monthly_product_performance": f"""
        WITH sales AS (SELECT CAST(date_trunc('month', day) AS DATE) AS m, product_key AS p, store_key AS s,
                              sum(revenue) AS r, CAST(sum(qty) AS BIGINT) AS q FROM w_sale GROUP BY 1, 2, 3),
        returns AS (SELECT CAST(date_trunc('month', back_day) AS DATE) AS m, product_key AS p, store_key AS s,
                           CAST(sum(back) AS BIGINT) AS b FROM w_back GROUP BY 1, 2, 3)
        SELECT m AS "MonthStartDateKey", p AS "ProductKey", s AS "StoreKey", CAST(r AS DOUBLE) AS "RevenueSum",
               q AS "UnitsSold", coalesce(b, 0) AS "ReturnsQty",
               {rnd("CAST(coalesce(b, 0) AS DOUBLE) / q * 100.0", 4)} AS "ReturnsRatePct", CAST(NULL AS DOUBLE) AS "AvgRating"
        FROM sales LEFT JOIN returns USING (m, p, s)""",
    "agg_regional_sales": f"""
        WITH base AS (SELECT CAST(date_trunc('month', day) AS DATE) AS m, region_key AS r, territory_key AS t,
                             sum(revenue) AS v FROM w_sale_region GROUP BY 1, 2, 3),
        steps AS (SELECT *, lag(v) OVER (PARTITION BY r, t ORDER BY m) AS w FROM base)
        SELECT m AS "MonthStartDateKey", r AS "RegionKey", t AS "SalesTerritoryKey", CAST(v AS DOUBLE) AS "RevenueSum",
               {rnd("coalesce(CAST(v - w AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0) * 100.0, 0)", 4)} AS "GrowthRatePct"
        FROM steps""",
    "agg_hourly_sales": """
        SELECT date_trunc('hour', ts) AS "SalesHour", event_id // 5 AS "ProductKey",
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "Revenue", count(*) AS "Quantity",
               count(*) AS "TransactionCount" FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
    "rollup_from_agg": """
        SELECT day AS "SalesDateKey", CAST(sum(revenue) AS DOUBLE) AS "TotalRevenue",
               CAST(sum(qty) AS BIGINT) AS "TotalQuantity", count(*) AS "Transactions" FROM w_sale GROUP BY 1""",
    "precalc_profit": f"""
        SELECT product_key AS "ProductKey", CAST(sum(revenue - qty * cost) AS DOUBLE) AS "Profit",
               {rnd("CAST(sum(revenue - qty * cost) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) * 100.0", 2)} AS "Margin"
        FROM w_sale_wide GROUP BY 1""",
    # views
    "vw_sales_extended_full": f"""
        SELECT s.day AS "SalesDateKey", {_calendar("s.day")}, CAST(quarter(s.day) AS INTEGER) AS "Quarter",
               CAST(weekofyear(s.day) AS INTEGER) AS "Week", CAST(isodow(s.day) AS INTEGER) AS "DayOfWeek",
               CAST(year(s.day + INTERVAL 6 MONTH) AS INTEGER) AS "FiscalYear",
               ['Winter', 'Spring', 'Summer', 'Fall'][CAST(month(s.day) % 12 // 3 + 1 AS INTEGER)] AS "Season",
               s.customer_key AS "CustomerKey", c.customer_name AS "CustomerName", c.city AS "City",
               c.state AS "StateProvince", c.country AS "Country", c.segment AS "CustomerSegment",
               c.customer_type AS "CustomerType", c.status AS "AccountStatus", CAST(c.credit AS DOUBLE) AS "CreditLimit",
               s.product_key AS "ProductKey", p.name AS "ProductName", p.sku AS "SKU", p.category AS "Category",
               p.subcategory AS "SubCategory", p.brand AS "Brand", CAST(p.list_price AS DOUBLE) AS "ListPrice",
               CAST(p.cost AS DOUBLE) AS "Cost", p.status AS "ProductStatus", s.store_key AS "StoreKey",
               t.name AS "StoreName", t.city AS "StoreCity", t.region AS "Region", t.territory AS "Territory",
               t.store_type AS "StoreType", t.square_feet AS "SquareFootage",
               CASE WHEN t.store_key IS NOT NULL THEN 'Active' END AS "StoreStatus", s.employee_key AS "EmployeeKey",
               e.name AS "EmployeeName", e.title AS "JobTitle", e.department AS "Department", e.region AS "EmployeeRegion",
               e.territory AS "EmployeeTerritory", CAST(e.quota AS DOUBLE) AS "SalesQuota",
               CAST(revenue AS DOUBLE) AS "SalesAmount", qty AS "Quantity", CAST(discount AS DOUBLE) AS "DiscountAmount",
               1 AS "TransactionCount", {ratio("revenue", "qty")} AS "UnitPrice",
               {pct("discount", "revenue")} AS "DiscountPercentage", {pct("net", "revenue")} AS "NetRevenuePercent",
               CAST(net AS DOUBLE) AS "NetRevenue", CAST(gross AS DOUBLE) AS "GrossProfit",
               {pct("gross", "revenue")} AS "ProfitMarginPercent", {_GROSS_BANDS} AS "MarginCategory"
        FROM w_sale_wide s LEFT JOIN w_d_customer c ON c.customer_key = s.customer_key
        LEFT JOIN w_d_product p ON p.product_key = s.product_key LEFT JOIN w_d_store t ON t.store_key = s.store_key
        LEFT JOIN w_d_employee e ON e.employee_key = s.employee_key""",
    "vw_sales_by_customer": f"""
        SELECT c.customer_key AS "CustomerKey", c.customer_id AS "CustomerID", customer_name AS "CustomerName",
               city AS "City", state AS "StateProvince", country AS "Country", segment AS "CustomerSegment",
               customer_type AS "CustomerType", status AS "AccountStatus", CAST(credit AS DOUBLE) AS "CreditLimit",
               CAST(income AS DOUBLE) AS "AnnualIncome", years AS "YearsSinceFirstPurchase",
               coalesce(days, 0) AS "PurchaseDays", coalesce(stores, 0) AS "StoresVisited",
               coalesce(products, 0) AS "UniqueProductsPurchased", coalesce(employees, 0) AS "EmployeesInteracted",
               quantity AS "TotalQuantityPurchased", CAST(revenue AS DOUBLE) AS "TotalRevenue",
               CAST(net AS DOUBLE) AS "NetRevenue", CAST(gross AS DOUBLE) AS "TotalProfit",
               {pct("gross", "revenue")} AS "AvgProfitMarginPercent", average AS "AvgOrderValue",
               last_day AS "LastPurchaseDate", first_day AS "FirstPurchaseDate",
               {pct("discount", "revenue")} AS "AvgDiscountPercentage", coalesce(n, 1) AS "TotalTransactions"
        FROM w_d_customer c LEFT JOIN {_by_member("customer_key")} s ON s.customer_key = c.customer_key""",
    "vw_sales_by_product": f"""
        SELECT p.product_key AS "ProductKey", product_id AS "ProductID", name AS "ProductName", sku AS "SKU",
               category AS "Category", subcategory AS "SubCategory", brand AS "Brand",
               CAST(list_price AS DOUBLE) AS "ListPrice", CAST(cost AS DOUBLE) AS "Cost", status AS "ProductStatus",
               color AS "Color", size AS "Size", coalesce(days, 0) AS "SalesDays", coalesce(stores, 0) AS "StoresOffering",
               coalesce(customers, 0) AS "UniqueCustomers", quantity AS "TotalUnitsSold",
               CAST(revenue AS DOUBLE) AS "TotalRevenue", CAST(net AS DOUBLE) AS "NetRevenue",
               CAST(gross AS DOUBLE) AS "GrossProfit", {pct("gross", "revenue")} AS "ProfitMarginPercent",
               {ratio("revenue", "days")} AS "DailyAvenueRevenue", {ratio("quantity", "days")} AS "DailyAverageUnits",
               {pct("discount", "revenue")} AS "AvgDiscountPercentage", {rnd("average", 2)} AS "AvgOrderValue"
        FROM w_d_product p LEFT JOIN {_by_member("product_key")} s ON s.product_key = p.product_key""",
    "vw_sales_by_store": f"""
        SELECT t.store_key AS "StoreKey", store_id AS "StoreID", name AS "StoreName", city AS "City",
               state AS "StateProvince", region AS "Region", territory AS "Territory", store_type AS "StoreType",
               'Active' AS "StoreStatus", square_feet AS "SquareFootage", opened AS "OpeningDate",
               coalesce(days, 0) AS "ActiveSalesDays", coalesce(customers, 0) AS "UniqueCustomers",
               coalesce(products, 0) AS "ProductsOffered", coalesce(employees, 0) AS "ActiveEmployees",
               quantity AS "TotalUnitsSold", CAST(revenue AS DOUBLE) AS "TotalRevenue", CAST(net AS DOUBLE) AS "NetRevenue",
               CAST(gross AS DOUBLE) AS "GrossProfit", {ratio("revenue", "square_feet")} AS "SalesPerSqFt",
               {ratio("net", "square_feet")} AS "NetRevenuePerSqFt", average AS "AvgTransactionValue",
               {pct("discount", "revenue")} AS "AvgDiscountPercentage", last_day AS "LastSalesDate"
        FROM w_d_store t LEFT JOIN {_by_member("store_key")} s ON s.store_key = t.store_key""",
    "vw_sales_by_employee": f"""
        SELECT e.employee_key AS "EmployeeKey", employee_id AS "EmployeeID", name AS "EmployeeName", title AS "JobTitle",
               department AS "Department", region AS "Region", territory AS "Territory", CAST(quota AS DOUBLE) AS "SalesQuota",
               status AS "EmployeeStatus", hired AS "HireDate", coalesce(days, 0) AS "ActiveSalesDays",
               coalesce(customers, 0) AS "CustomersServed", coalesce(products, 0) AS "ProductsSold",
               coalesce(stores, 0) AS "StoresWorked", quantity AS "TotalUnitsSold", CAST(revenue AS DOUBLE) AS "TotalRevenue",
               CAST(net AS DOUBLE) AS "NetRevenue", CAST(gross AS DOUBLE) AS "GrossProfit",
               {pct("net", "quota")} AS "QuotaAttainmentPercent", {ratio("net", "days")} AS "DailyAverageRevenue",
               average AS "AvgOrderValue", {pct("discount", "revenue")} AS "AvgDiscountPercentage",
               last_day AS "LastSalesDate"
        FROM w_d_employee e LEFT JOIN {_by_member("employee_key")} s ON s.employee_key = e.employee_key""",
    "vw_inventory_snapshot": f"""
        SELECT day AS "InventoryDateKey", {_calendar("day")}, i.product_key AS "ProductKey", p.name AS "ProductName",
               p.sku AS "SKU", p.category AS "Category", p.subcategory AS "SubCategory",
               CAST(p.list_price AS DOUBLE) AS "ListPrice", CAST(p.cost AS DOUBLE) AS "Cost", i.store_key AS "StoreKey",
               t.name AS "StoreName", t.region AS "Region", t.territory AS "Territory", qty AS "QuantityOnHand",
               CAST(qty * p.list_price AS DOUBLE) AS "InventoryValueAtListPrice",
               CAST(qty * p.cost AS DOUBLE) AS "InventoryValueAtCost", reorder AS "ReorderLevel",
               safety AS "SafetyStockLevels", aging AS "StockAging",
               CASE WHEN aging > 180 THEN 'Obsolete (180+ days)' WHEN aging > 90 THEN 'Very Aged (91-180 days)'
                    WHEN aging > 30 THEN 'Aged (31-90 days)' ELSE 'Fresh (0-30 days)' END AS "AgingCategory",
               CASE WHEN qty <= reorder THEN 'Critical' WHEN qty <= safety THEN 'Low' WHEN qty >= reorder * 3
                    THEN 'Overstock' ELSE 'Normal' END AS "StockStatus",
               greatest(qty - reorder, 0) AS "ExcessQuantity", greatest(reorder - qty, 0) AS "ShortageQuantity"
        FROM w_stock i JOIN w_d_product p ON p.product_key = i.product_key
        LEFT JOIN w_d_store t ON t.store_key = i.store_key""",
    "vw_inventory_by_product": f"""
        SELECT p.product_key AS "ProductKey", p.product_id AS "ProductID", p.name AS "ProductName", p.sku AS "SKU",
               p.category AS "Category", p.subcategory AS "SubCategory", CAST(p.list_price AS DOUBLE) AS "ListPrice",
               CAST(p.cost AS DOUBLE) AS "Cost", p.status AS "ProductStatus",
               CAST(sum(qty) AS BIGINT) AS "TotalQuantityOnHand", count(DISTINCT i.store_key) AS "StoresStockingProduct",
               CAST(sum(qty * p.list_price) AS DOUBLE) AS "TotalInventoryValueAtListPrice",
               CAST(sum(qty * p.cost) AS DOUBLE) AS "TotalInventoryValueAtCost",
               {rnd(avg("aging"), 2)} AS "AvgStockAgingDays", max(aging) AS "MaxStockAgingDays",
               count(*) FILTER (WHERE qty <= reorder) AS "LocationsBelowReorderLevel",
               count(*) FILTER (WHERE qty <= safety) AS "LocationsAtRiskLevel",
               count(*) FILTER (WHERE qty >= reorder * 3) AS "OverstockedLocations",
               {pct("sum(greatest(qty - reorder, 0))", "sum(qty)")} AS "ExcessPercentage"
        FROM w_d_product p LEFT JOIN w_stock i ON i.product_key = p.product_key GROUP BY ALL""",
    "vw_inventory_by_warehouse": f"""
        SELECT w.warehouse_key AS "WarehouseKey", w.warehouse_id AS "WarehouseID", w.name AS "WarehouseName",
               w.name AS "Location", 'Manufacturing' AS "WarehouseType", CAST(sum(qty) AS BIGINT) AS "TotalQuantityOnHand",
               count(DISTINCT product_key) AS "UniqueProductsStored", count(DISTINCT store_key) AS "ServicedLocations",
               CAST(sum(qty * list_price) AS DOUBLE) AS "TotalInventoryValueAtListPrice",
               CAST(sum(qty * cost) AS DOUBLE) AS "TotalInventoryValueAtCost",
               count(*) FILTER (WHERE qty <= reorder) AS "CriticalStockItems",
               {rnd(avg("aging"), 1)} AS "AvgStockAgingDays",
               CAST(coalesce(sum(qty) FILTER (WHERE aging > 180), 0) AS BIGINT) AS "ObsoleteQuantity",
               CAST(coalesce(sum(qty * cost) FILTER (WHERE aging > 180), 0) AS DOUBLE) AS "ObsoleteValueAtCost"
        FROM w_d_warehouse w LEFT JOIN w_stock i ON i.warehouse_key = w.warehouse_key GROUP BY ALL""",
    "vw_purchases_extended_full": f"""
        SELECT day AS "PurchaseDateKey", {_calendar("day")}, f.product_key AS "ProductKey", p.name AS "ProductName",
               p.sku AS "SKU", p.category AS "Category", p.subcategory AS "SubCategory", p.brand AS "Brand",
               CAST(p.list_price AS DOUBLE) AS "ListPrice", CAST(p.cost AS DOUBLE) AS "Cost", f.vendor_key AS "VendorKey",
               v.name AS "VendorName", v.contact AS "ContactPerson", v.city AS "City", v.country AS "Country",
               CAST(v.rating AS DOUBLE) AS "VendorRating", CAST(v.on_time_rate AS DOUBLE) AS "OnTimeDeliveryRate",
               CAST(85 AS DOUBLE) AS "QualityScore", 'Net 30' AS "PaymentTerms", v.status AS "VendorStatus",
               CAST(amount AS DOUBLE) AS "PurchaseAmount", qty AS "QuantityBought", CAST(unit_price AS DOUBLE) AS "UnitPrice",
               CAST(0 AS DOUBLE) AS "DiscountAmount", CAST(amount AS DOUBLE) AS "NetPurchaseAmount",
               {ratio("amount", "qty", 4)} AS "EffectiveUnitCost", CAST(0 AS DOUBLE) AS "DiscountPercentage",
               {pct("amount - qty * p.cost", "amount")} AS "CostSavingPercent"
        FROM w_purchase f JOIN w_d_product p ON p.product_key = f.product_key
        JOIN w_d_vendor v ON v.vendor_key = f.vendor_key""",
    "vw_vendor_performance": f"""
        SELECT v.vendor_key AS "VendorKey", v.vendor_id AS "VendorID", v.name AS "VendorName", v.contact AS "ContactPerson",
               v.city AS "City", v.country AS "Country", CAST(v.rating AS DOUBLE) AS "VendorRating",
               CAST(v.on_time_rate AS DOUBLE) AS "OnTimeDeliveryRate", CAST(85 AS DOUBLE) AS "QualityScore",
               'Net 30' AS "PaymentTerms", v.status AS "VendorStatus", count(DISTINCT day) AS "PurchaseDays",
               count(DISTINCT f.product_key) AS "UniqueProductsPurchased", CAST(sum(qty) AS BIGINT) AS "TotalQuantityPurchased",
               CAST(sum(amount) AS DOUBLE) AS "TotalPurchaseAmount", CAST(sum(amount) AS DOUBLE) AS "NetPurchaseAmount",
               CAST(sum(amount * 0) AS DOUBLE) AS "TotalDiscountsReceived",
               {pct("sum(amount * 0)", "sum(amount)")} AS "AvgDiscountPercent", {avg("amount")} AS "AvgOrderValue",
               CAST(coalesce(sum(qty) FILTER (WHERE unit_price > p.list_price * 0.8), 0) AS BIGINT) AS "HighCostPurchasesQty",
               CAST(v.rating AS DOUBLE) AS "EffectiveVendorRating", CAST(v.on_time_rate AS DOUBLE) AS "EffectiveOnTimeRate"
        FROM w_d_vendor v LEFT JOIN w_purchase f ON f.vendor_key = v.vendor_key
        LEFT JOIN w_d_product p ON p.product_key = f.product_key GROUP BY ALL""",
    "vw_production_metrics": f"""
        SELECT day AS "ProductionDateKey", {_calendar("day")}, f.product_key AS "ProductKey", p.name AS "ProductName",
               p.sku AS "SKU", p.category AS "Category", p.brand AS "Brand", CAST(0 AS BIGINT) AS "SupervisorKey",
               CAST(NULL AS VARCHAR) AS "EmployeeName", CAST(NULL AS VARCHAR) AS "JobTitle",
               CAST(NULL AS VARCHAR) AS "Department", qty AS "UnitsProduced", CAST(hours AS DOUBLE) AS "ProductionTimeHours",
               CAST(scrap AS DOUBLE) AS "ScrapRatePercent", scrapped AS "DefectCount", {ratio("qty", "hours")} AS "UnitsPerHour",
               {ratio("CAST(qty AS DOUBLE) * (1.0 - CAST(scrap AS DOUBLE) / 100.0)", "hours")} AS "GoodUnitsPerHour",
               CAST(100 - scrap AS DOUBLE) AS "YieldPercent", {pct("scrapped", "qty")} AS "DefectRate",
               CASE WHEN scrap > 10 THEN 'High' WHEN scrap > 5 THEN 'Medium' ELSE 'Low' END AS "ScrapRiskLevel"
        FROM w_production f JOIN w_d_product p ON p.product_key = f.product_key""",
    "vw_feedback_analysis": f"""
        SELECT day AS "FeedbackDateKey", day AS "DateKey", CAST(year(day) AS INTEGER) AS "Year",
               CAST(month(day) AS INTEGER) AS "Month", monthname(day) AS "MonthName",
               coalesce(c.customer_key, 0) AS "CustomerKey", c.customer_name AS "CustomerName", c.city AS "City",
               c.country AS "Country", c.segment AS "CustomerSegment",
               ['Product Quality', 'Service', 'Delivery', 'Pricing', 'General'][category_id] AS "CategoryName",
               score AS "FeedbackScore", CASE WHEN score < 3 THEN 1 ELSE 0 END AS "ComplaintCount",
               CAST(0 AS DOUBLE) AS "ResolutionTimeHours", CAST(score * 20 AS DOUBLE) AS "CSATScore",
               ['Poor', 'Poor', 'Fair', 'Good', 'Excellent'][score] AS "SatisfactionLevel", 'Very Fast' AS "ResolutionSpeed"
        FROM w_feedback f LEFT JOIN w_d_customer c ON c.customer_id = f.customer_id""",
    "vw_feedback_summary": f"""
        SELECT CAST(CASE WHEN category_id <= 5 THEN category_id END AS BIGINT) AS "FeedbackCategoryKey",
               ['Product Quality', 'Service', 'Delivery', 'Pricing', 'General'][category_id] AS "CategoryName",
               count(*) AS "TotalFeedbackCount", {avg("score")} AS "AvgFeedbackScore", {avg("score * 20")} AS "AvgCSATScore",
               count(*) FILTER (WHERE score < 3) AS "TotalComplaints", CAST(0 AS DOUBLE) AS "AvgResolutionTimeHours",
               count(*) FILTER (WHERE score >= 4) AS "PositiveFeedbackCount",
               count(*) FILTER (WHERE score < 3) AS "NegativeFeedbackCount" FROM w_feedback GROUP BY 1, 2""",
    "vw_promotion_response": f"""
        SELECT day AS "PromotionDateKey", {_calendar("day")}, p.product_key AS "ProductKey", p.name AS "ProductName",
               p.category AS "Category", p.subcategory AS "SubCategory", coalesce(t.store_key, 0) AS "StoreKey",
               t.name AS "StoreName", t.region AS "Region", o.promotion_key AS "PromotionKey", o.name AS "PromotionName",
               o.kind AS "PromotionType", CAST(o.percent AS DOUBLE) AS "DiscountPercentage",
               CAST(sales AS DOUBLE) AS "SalesDuringCampaign", uses AS "DiscountUsageCount",
               {rnd("CAST(buyers AS DOUBLE) / uses", 4)} AS "CustomerUptakeRate", CAST(0 AS DOUBLE) AS "PromotionROI",
               'Negative' AS "ROICategory"
        FROM w_promoted f JOIN w_d_product p ON p.product_id = f.product_id JOIN w_d_promotion o ON o.offer = f.offer
        LEFT JOIN w_d_store t ON t.store_id = f.store_id""",
    "vw_finance_analysis": f"""
        SELECT day AS "InvoiceDateKey", {_calendar("day")}, f.customer_key AS "CustomerKey",
               c.customer_name AS "CustomerName", c.city AS "City", c.country AS "Country", c.segment AS "CustomerSegment",
               CAST(c.credit AS DOUBLE) AS "CreditLimit", f.store_key AS "StoreKey", t.name AS "StoreName",
               t.region AS "Region",
               ['Small', 'Medium', 'Large', 'Enterprise', 'Credit'][f.category] || ' Transaction' AS "CategoryName",
               CAST(amount AS DOUBLE) AS "InvoiceAmount", delay AS "PaymentDelayDays", CAST(0 AS DOUBLE) AS "CreditUsagePct",
               CAST(0 AS DOUBLE) AS "InterestCharges", CAST(amount AS DOUBLE) AS "NetInvoiceAmount",
               CASE WHEN delay = 0 THEN 'On Time' WHEN delay <= 10 THEN 'Slightly Late' WHEN delay <= 30 THEN 'Late'
                    ELSE 'Very Late' END AS "DelayStatus", 'Low' AS "CreditRiskLevel"
        FROM w_invoice f JOIN w_d_customer c ON c.customer_key = f.customer_key
        LEFT JOIN w_d_store t ON t.store_key = f.store_key""",
    "vw_returns_analysis": f"""
        SELECT back_day AS "ReturnDateKey", {_calendar("back_day")}, f.customer_key AS "CustomerKey",
               c.customer_name AS "CustomerName", c.city AS "City", c.country AS "Country", c.segment AS "CustomerSegment",
               f.product_key AS "ProductKey", p.name AS "ProductName", p.category AS "Category",
               p.subcategory AS "SubCategory", f.store_key AS "StoreKey", t.name AS "StoreName", t.region AS "Region",
               ['Defective', 'Wrong Item', 'Changed Mind', 'Damaged'][reason] AS "ReturnReasonName",
               back AS "ReturnedQuantity", CAST(refund AS DOUBLE) AS "RefundAmount", CAST(fee AS DOUBLE) AS "RestockingFee",
               CAST(refund - fee AS DOUBLE) AS "NetRefundAmount", {pct("refund - fee", "refund")} AS "NetRefundPercent"
        FROM w_back f JOIN w_d_customer c ON c.customer_key = f.customer_key
        JOIN w_d_product p ON p.product_key = f.product_key LEFT JOIN w_d_store t ON t.store_key = f.store_key""",
    "vw_return_by_product": f"""
        WITH r AS (SELECT product_key, count(*) AS n, CAST(sum(back) AS BIGINT) AS q, sum(refund) AS v, sum(fee) AS f,
                          count(*) FILTER (WHERE reason = 1) AS a, count(*) FILTER (WHERE reason = 2) AS b,
                          count(*) FILTER (WHERE reason = 3) AS c FROM w_back GROUP BY 1),
        s AS (SELECT product_key, count(DISTINCT day) AS days, sum(qty) AS units FROM w_sale GROUP BY 1)
        SELECT p.product_key AS "ProductKey", product_id AS "ProductID", name AS "ProductName", category AS "Category",
               subcategory AS "SubCategory", CAST(list_price AS DOUBLE) AS "ListPrice", CAST(cost AS DOUBLE) AS "Cost",
               coalesce(n, 1) AS "TotalReturnEvents", q AS "TotalReturnedQuantity", CAST(v AS DOUBLE) AS "TotalRefundAmount",
               CAST(f AS DOUBLE) AS "TotalRestockingFees", {ratio("v", "days")} AS "AvgRefundAmount",
               {pct("q", "units")} AS "ReturnRatePercent", coalesce(a, 0) AS "DefectiveReturns",
               coalesce(b, 0) AS "WrongItemReturns", coalesce(c, 0) AS "ChangedMindReturns"
        FROM w_d_product p LEFT JOIN r USING (product_key) LEFT JOIN s USING (product_key)""",
    # reports and primitives
    "report_top_products": """
        SELECT day AS "SalesDateKey", c.customer_name AS "CustomerName", p.name AS "ProductName",
               CAST(sum(revenue) AS DOUBLE) AS "TotalRevenue", count(*) AS "TransactionCount"
        FROM w_sale s JOIN w_d_customer c ON c.customer_key = s.customer_key
        JOIN w_d_product p ON p.product_key = s.product_key WHERE day >= DATE '1998-01-01' GROUP BY 1, 2, 3
        ORDER BY sum(revenue) DESC, 1, 2, 3 LIMIT 10""",
    "sales_by_year": """
        SELECT CAST(month(day) AS INTEGER) AS "Month", CAST(sum(revenue) AS DOUBLE) AS "TotalRevenue",
               count(*) AS "TransactionCount" FROM w_sale WHERE year(day) = 1998 GROUP BY 1""",
    "sales_by_quarter_semi": """
        SELECT day AS "SalesDateKey", CAST(sum(revenue) AS DOUBLE) AS "TotalRevenue"
        FROM w_sale WHERE day BETWEEN DATE '1999-04-01' AND DATE '1999-06-30' GROUP BY 1""",
    "sample_avg_revenue": f"""
        SELECT product_key AS "ProductKey", {avg("revenue")} AS "AvgRevenue", count(*) AS "SampledRows" FROM w_sale
        WHERE {draw("sample", "order_id", "line_id", "customer_key", "store_key", "product_key")} < 0.1 GROUP BY 1""",
    "lateral_latest_store": 'SELECT l_partkey AS "ProductID", store_id AS "StoreID" FROM w_last_store',
    "range_join_aging": """
        SELECT CASE WHEN aging BETWEEN 0 AND 30 THEN 'Fresh' WHEN aging BETWEEN 31 AND 90 THEN 'Aging'
                    WHEN aging BETWEEN 91 AND 180 THEN 'Old' WHEN aging > 180 THEN 'Obsolete' END AS "AgingTierName",
               count(*) AS "StockRows", CAST(sum(qty) AS BIGINT) AS "Quantity" FROM w_stock GROUP BY 1""",
    "incremental_extract": f"SELECT {_SOLD_OUT} FROM w_sold WHERE day > DATE '2001-07-01'",
    "retention_keep": """
        SELECT day AS "SalesDateKey", count(*) AS "KeptRows" FROM w_sold WHERE day >= DATE '1999-12-01' GROUP BY 1""",
    "upsert_keys": """
        SELECT * EXCLUDE (day) FROM w_parts p WHERE day = 2
        OR NOT EXISTS (SELECT 1 FROM w_part_2 n WHERE n.id = p."ProductID")""",
    "delete_by_key": 'SELECT * EXCLUDE (day) FROM w_parts WHERE day = 1 AND "ListPrice" >= 950',
    "update_current_by_key": f"""
        SELECT h.* REPLACE (CASE WHEN c_acctbal < 0 AND "IsCurrent" = 1 THEN 0 ELSE "IsCurrent" END AS "IsCurrent",
               CASE WHEN c_acctbal < 0 AND "IsCurrent" = 1 THEN {AS_OF} ELSE "ValidToDate" END AS "ValidToDate")
        FROM w_history h JOIN customer ON c_custkey = "CustomerID" """,
    # errors and monitoring
    "error_classify": """
        SELECT kind AS "ErrorType", CASE WHEN kind = 'NULL_PK' THEN 'CRITICAL' ELSE 'WARNING' END AS "TypeSeverity",
               CASE kind WHEN 'NULL_PK' THEN 0 WHEN 'TYPE_MISMATCH' THEN NULL ELSE 1 END AS "TypeRecoverable",
               CASE kind WHEN 'FK_MISS' THEN 'Skip row, log, retry tomorrow' WHEN 'NULL_PK' THEN 'Stop load, escalate'
                    WHEN 'TYPE_MISMATCH' THEN 'Try conversion, log if fail' WHEN 'TIMEOUT' THEN 'Retry with backoff'
                    ELSE 'Skip row, log' END AS "Handling", count(*) AS "ErrorCount" FROM w_errors GROUP BY ALL""",
    "reprocess_resolved": """
        SELECT customer_key AS "CustomerKey", value AS "Amount" FROM w_retried WHERE customer_key IS NOT NULL""",
    "reprocess_retry": f"""
        SELECT id AS "ErrorID", CASE WHEN customer_key IS NULL THEN retries + 1 ELSE retries END AS "RetryCount",
               CASE WHEN customer_key IS NULL THEN {_RETRY_STAMP} ELSE last_try END AS "LastAttemptDate",
               CASE WHEN customer_key IS NULL THEN 0 ELSE 1 END AS "IsResolved",
               CASE WHEN customer_key IS NOT NULL THEN 'Auto-resolved on retry' END AS "ResolutionComment" FROM w_retried""",
    "mon_error_summary": f"""
        SELECT kind AS "ErrorType", count(*) AS "ErrorCount", CAST(sum(recoverable) AS BIGINT) AS "Recoverable",
               CAST(sum(1 - recoverable) AS BIGINT) AS "NonRecoverable", {avg("resolved")} AS "ResolvedPercent"
        FROM w_errors WHERE ts >= TIMESTAMP '2024-01-23' GROUP BY 1""",
    "mon_unresolved_critical": """
        SELECT id AS "ErrorID", ts AS "ErrorDate", source AS "SourceTable", kind AS "ErrorType", message AS "ErrorMessage",
               '{"CustomerID":' || user_id || ',"Amount":' || value || '}' AS "FailedData", retries AS "RetryCount"
        FROM w_errors WHERE resolved = 0 AND recoverable = 0 AND ts >= TIMESTAMP '2023-12-31'""",
    "mon_recovery_rate": f"""
        SELECT CAST(ts AS DATE) AS "Day", count(*) AS "TotalErrors", CAST(sum(resolved) AS BIGINT) AS "ResolvedErrors",
               {rnd("CAST(sum(resolved) AS DOUBLE) * 100.0 / count(*)", 2)} AS "RecoveryPercent"
        FROM w_errors WHERE ts >= TIMESTAMP '2023-12-31' GROUP BY 1""",
    "mon_error_trend": """
        SELECT CAST(ts AS DATE) AS "Day", kind AS "ErrorType", count(*) AS "ErrorCount"
        FROM w_errors WHERE ts >= TIMESTAMP '2023-12-31' GROUP BY 1, 2""",
    "mon_error_by_table": """
        SELECT source AS "SourceTable", kind AS "ErrorType", severity AS "ErrorSeverity", count(*) AS "ErrorCount",
               max(ts) AS "LastError" FROM w_errors WHERE ts >= TIMESTAMP '2024-01-23' GROUP BY 1, 2, 3""",
    "mon_stuck_errors": """
        SELECT CAST(user_id AS VARCHAR) || '-' || CAST(id AS VARCHAR) AS "RecordNaturalKey", message AS "ErrorMessage",
               retries AS "RetryCount", last_try AS "LastAttemptDate", ts AS "ErrorDate"
        FROM w_errors WHERE kind = 'FK_MISS' AND resolved = 0 AND retries >= 3""",
    "mon_error_volume": """
        SELECT CAST(ts AS DATE) AS "Day", count(*) AS "ErrorCount", CASE WHEN count(*) > 70 THEN 1 ELSE 0 END AS "Alert"
        FROM w_errors GROUP BY 1""",
    "mon_daily_trend": """
        SELECT day AS "SalesDateKey", count(*) AS "RowCount", CAST(sum(revenue) AS DOUBLE) AS "TotalRevenue"
        FROM w_sale WHERE day >= DATE '2001-07-02' GROUP BY 1""",
    "mon_freshness": """
        SELECT round((epoch(max(l_shipdate)) - epoch(max(o_orderdate))) / 3600.0, 2) AS "LagHours",
               CASE WHEN (epoch(max(l_shipdate)) - epoch(max(o_orderdate))) / 3600.0 <= 4 THEN 1 ELSE 0 END AS "WithinSla"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    # streams
    "stream_monthly_sales": f"""
        SELECT CAST(date_trunc('month', day) AS DATE) AS "Month", CAST(sum(revenue) AS DOUBLE) AS "RevenueSum",
               count(*) AS "RowCount", CAST(min(revenue) AS DOUBLE) AS "RevenueMin", CAST(max(revenue) AS DOUBLE) AS "RevenueMax",
               {rnd("CAST(sum(revenue) AS DOUBLE) / count(*)", 2)} AS "RevenueAvg",
               count(DISTINCT customer_id) AS "DistinctMembers" FROM w_sold GROUP BY 1""",
    "stream_hourly_events": """
        SELECT date_trunc('hour', ts) AS "SalesHour", event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "Revenue",
               count(*) AS "TransactionCount" FROM events GROUP BY 1, 2""",
    "stream_fact_load": f"SELECT {_LATE_OUT} FROM w_late WHERE miss_1 IS NULL AND miss_2 IS NULL",
    "stream_late_hours": """
        WITH e AS (SELECT *, date_trunc('hour', ts) AS h FROM events),
        c AS (SELECT max(ts) AS clock FROM events WHERE event_id % 10 <> 7)
        SELECT h AS "SalesHour", event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "Revenue",
               count(*) AS "TransactionCount",
               count(*) FILTER (WHERE event_id % 10 = 7 AND h + INTERVAL 2 HOUR <= clock) AS "LateCount" FROM e, c GROUP BY 1, 2""",
    "stream_waiting_facts": f"SELECT {_LATE_OUT} FROM w_sale",
    "stream_dimension_merge": f"""
        WITH f AS (
            SELECT c_custkey AS id, c_name AS name, c_mktsegment AS seg, DATE '1996-01-01' AS since, 1 AS block FROM customer WHERE c_custkey % 13 <> 1
            UNION ALL SELECT c_custkey, c_name, p || c_mktsegment, d, 2 FROM customer,
                (VALUES ('A ', DATE '2001-01-01'), ('B ', DATE '2000-06-01'), ('A ', DATE '2000-01-01')) AS v(p, d) WHERE c_custkey % 10 = 3
            UNION ALL SELECT c_custkey, c_name, c_mktsegment, DATE '2000-03-01', 2 FROM customer WHERE c_custkey % 10 = 4
            UNION ALL SELECT c_custkey, c_name, c_mktsegment, DATE '2000-01-01', 2 FROM customer WHERE c_custkey % 13 = 1 AND c_custkey % 10 <> 3
            UNION ALL SELECT c_custkey, c_name, 'EARLY ' || c_mktsegment, DATE '1998-01-01', 3 FROM customer WHERE c_custkey % 10 = 3
            UNION ALL SELECT c_custkey, c_name, 'OTHER', DATE '1996-01-01', 3 FROM customer WHERE c_custkey % 10 = 4),
        h AS (SELECT id, name, seg, since, lag(seg) OVER (PARTITION BY id ORDER BY since) AS was
              FROM (SELECT id, name, seg, since FROM f QUALIFY row_number() OVER (PARTITION BY id, since ORDER BY block) = 1))
        SELECT {key("id", "since")} AS "CustomerKey", id AS "CustomerID", name AS "CustomerName", seg AS "CustomerSegment",
               since AS "ValidFromDate", coalesce(lead(since) OVER w, {FAR}) AS "ValidToDate",
               CAST(lead(since) OVER w IS NULL AS INTEGER) AS "IsCurrent", row_number() OVER w AS "Version"
        FROM h WHERE was IS DISTINCT FROM seg WINDOW w AS (PARTITION BY id ORDER BY since)""",
    # operations on stored tables
    "batch_restart_totals": """
        SELECT CAST(date_trunc('month', day) AS DATE) AS "Month", CAST(sum(revenue) AS DOUBLE) AS "RollupRevenue",
               count(*) AS "RollupLines", CAST(sum(revenue) AS DOUBLE) AS "FactRevenue", count(*) AS "FactLines",
               CAST(0 AS BIGINT) AS "OpenErrors" FROM w_sale GROUP BY 1""",
    "load_validation_errors": """
        WITH x AS (SELECT order_id, CASE WHEN product_id % 50 <> 3 THEN line_id END AS line,
            CASE WHEN product_id % 50 = 4 THEN CAST(qty AS BIGINT) * 1000000000 ELSE qty END AS q,
            CASE WHEN product_id % 50 IN (1, 3) THEN -revenue ELSE revenue END AS r FROM w_sold),
        y AS (SELECT *, CASE WHEN line IS NULL THEN 'NULL_PK' WHEN q > 2147483647 THEN 'TYPE_MISMATCH' ELSE 'VALIDATION_FAIL' END AS kind,
            concat_ws('; ', CASE WHEN line IS NULL THEN 'SalesOrderDetailID is NULL' END,
            CASE WHEN q > 2147483647 THEN 'cannot convert QuantitySold to int' END,
            CASE WHEN r < 0 THEN 'Negative revenue not allowed' END, CASE WHEN q <= 0 THEN 'Quantity must be positive' END,
            CASE WHEN r < q * 0.01 THEN 'Unit price suspiciously low' END) AS v FROM x)
        SELECT kind AS "ErrorType", CASE WHEN kind = 'NULL_PK' THEN 'CRITICAL' ELSE 'WARNING' END AS "ErrorSeverity", v AS "ErrorMessage",
               CASE WHEN kind = 'NULL_PK' THEN 0 ELSE 1 END AS "IsRecoverable", count(*) AS "ErrorRows",
               count(DISTINCT concat(order_id, '-', coalesce(CAST(line AS VARCHAR), 'None'))) AS "Records"
        FROM y WHERE v <> '' GROUP BY ALL""",
    "reload_emptied_periods": """
        SELECT m AS "OrderMonth", count(*) AS "Orders", CAST(sum(due) AS DOUBLE) AS "TotalDue" FROM w_order_month
        WHERE m < DATE '2000-01-01' OR month(m) NOT IN (2, 7) GROUP BY 1""",
    "loaded_ranges": """
        WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
                   WHERE o_custkey % 10 = 3 AND month(o_orderdate) NOT IN (3, 8)),
        n AS (SELECT m, year(m) * 12 + month(m) - row_number() OVER (ORDER BY m) AS island FROM m)
        SELECT 'FactSales' AS "SourceTable", min(m) AS "FirstDay",
               CAST(max(m) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS "LastDay" FROM n GROUP BY island""",
    "retention_then_load": """
        SELECT CASE WHEN m >= DATE '1999-12-01' THEN 'live' ELSE 'archive' END AS "Place", m AS "OrderMonth",
               count(*) AS "Orders" FROM w_order_month GROUP BY 1, 2""",
    "duplicates_removed_in_place": """
        SELECT m AS "OrderMonth", count(*) AS "Orders", count(*) AS "DistinctOrders" FROM w_order_month GROUP BY 1""",
    "appended_facts": 'SELECT CAST(year(m) AS INTEGER) AS "Year", count(*) AS "Orders" FROM w_order_month GROUP BY 1',
    "truncated_and_inserted": """
        SELECT p_partkey, p_brand,
               CAST(CAST('0x' || substr(md5(concat_ws('|', CAST(p_partkey AS VARCHAR), p_brand)), 1, 16) AS UBIGINT) AS VARCHAR) AS "WideKey"
        FROM part WHERE p_partkey % 3 = 0""",
    "logged_errors": """
        SELECT CASE customer_id % 4 WHEN 0 THEN 'b1' ELSE 'b2' END AS "ProcessingBatchID", 'VALIDATION_FAIL' AS "ErrorType",
               count(*) AS "Errors" FROM w_sold WHERE customer_id % 4 < 2 GROUP BY 1""",
    "region_numbers_kept": """
        SELECT r_name AS "RegionName", n_name AS "Country",
               row_number() OVER (ORDER BY n_regionkey <= 1, r_name, n_name) AS "RegionID"
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "range_join_far_values": """
        WITH l AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_suppkey = 3 THEN 1000000000000
                   WHEN l_suppkey = 4 THEN -1000000000000 ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS price FROM lineitem),
        b AS (SELECT s_suppkey AS band, CASE WHEN s_suppkey % 50 = 1 THEN NULL ELSE s_suppkey * 611 % 60000 END AS low,
              CASE WHEN s_suppkey % 50 = 2 THEN NULL WHEN s_suppkey % 50 = 3 THEN 2000000000000
                   ELSE s_suppkey * 611 % 60000 + s_nationkey * s_nationkey * 20 - 30 END AS high FROM supplier)
        SELECT band, count(*) AS "Lines", CAST(sum(price) AS VARCHAR) AS "PriceSum"
        FROM l LEFT JOIN b ON (low IS NULL OR price >= low) AND (high IS NULL OR price <= high) AND price IS NOT NULL GROUP BY 1""",
    # data quality
    "dq_validate_measures": """
        WITH x AS (SELECT l_orderkey, l_linenumber,
            CAST(CASE WHEN l_partkey % 50 = 1 THEN -l_extendedprice WHEN l_partkey % 50 = 2 THEN 0.001
                 ELSE l_extendedprice END AS DECIMAL(18,2)) AS r,
            CAST(CASE WHEN l_suppkey % 10 = 3 THEN 0 ELSE l_quantity END AS INTEGER) AS q FROM lineitem),
        y AS (SELECT *, concat_ws('; ', CASE WHEN r < 0 THEN 'Negative revenue not allowed' END,
            CASE WHEN q <= 0 THEN 'Quantity must be positive' END,
            CASE WHEN r < q * 0.01 THEN 'Unit price suspiciously low' END) AS v FROM x)
        SELECT l_orderkey AS "SalesOrderID", l_linenumber AS "SalesOrderDetailID", CAST(r AS DOUBLE) AS "SalesRevenue",
               q AS "QuantitySold", v AS "Violations" FROM y WHERE v <> ''""",
    "dq_validate_ranges": """
        WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 31 = 0 THEN 130 ELSE p_size END AS a,
            CASE WHEN p_partkey % 17 = 0 THEN -1 ELSE p_size END AS q,
            CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice ELSE p_retailprice END AS p FROM part),
        y AS (SELECT p_partkey, [CASE WHEN a < 0 OR a > 120 THEN 'Age out of range' END,
            CASE WHEN q < 0 THEN 'Negative quantity' END, CASE WHEN p < 0 THEN 'Negative price' END,
            CASE WHEN p < 905 THEN 'Price below cost' END] AS v FROM x)
        SELECT p_partkey AS "ProductID", CAST(list_count(v) AS INTEGER) AS "ViolationCount",
               concat_ws('; ', v[1], v[2], v[3], v[4]) AS "Violations" FROM y""",
    "dq_null_defaults": """
        SELECT c_custkey AS "CustomerID", CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE 'UNKNOWN' END AS "CustomerName",
               CASE WHEN c_custkey % 4 <> 0 THEN lower(c_name) ELSE '' END AS "Email",
               CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey ELSE -1 END AS "Age",
               CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal ELSE 0 END AS "Amount" FROM customer""",
    "dq_type_convert": """
        SELECT o_orderkey AS "OrderID", CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS "Customer",
               CASE WHEN o_orderkey % 10 <> 1 THEN CAST(o_orderdate AS DATE) END AS "Ordered",
               CASE o_orderkey % 10 WHEN 0 THEN 'TYPE_MISMATCH: cannot convert Customer to bigint'
                    WHEN 1 THEN 'TYPE_MISMATCH: cannot convert Ordered to date' ELSE '' END AS "ConversionErrors"
        FROM orders""",
    "dq_distinct": "SELECT DISTINCT * FROM w_doubled",
    "dq_unique_only": """
        SELECT * FROM w_doubled QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
    "dq_duplicate_grain": """
        SELECT l_orderkey AS "SalesOrderID", l_linenumber AS "SalesOrderDetailID", count(*) AS "DuplicateCount"
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_multi_current": """
        SELECT "CustomerID", count(*) AS "VersionCount" FROM w_history
        WHERE "CustomerID" % 20 = 3 OR "IsCurrent" = 1 GROUP BY 1 HAVING count(*) > 1""",
    "dq_load_anomaly": """
        WITH c AS (SELECT day, count(*) AS n FROM w_sold GROUP BY 1)
        SELECT day AS "SalesDateKey", n AS "LoadCount" FROM c WHERE n > (SELECT avg(n) FROM c) * 1.5""",
    "dq_null_profile": """
        WITH c AS (SELECT count(*) AS n, [count(customer_id), count(product_id), count(store_id), count(employee_id),
                   count(revenue)] AS v FROM w_sold),
        r AS (SELECT n, unnest(['CustomerID', 'ProductID', 'StoreID', 'EmployeeID', 'SalesRevenue']) AS k,
                     unnest(v) AS m FROM c)
        SELECT k AS "ColumnName", n AS "TotalRows", m AS "NonNullCount", n - m AS "NullCount" FROM r""",
    "dq_negative_amounts": """
        SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0""",
    "dq_rowcount_drift": f"""
        WITH c AS (SELECT day, count(*) AS n FROM w_sold GROUP BY 1),
        p AS (SELECT a.day, a.n, b.n AS m, CAST(a.n - b.n AS DOUBLE) / b.n AS x
              FROM c a LEFT JOIN c b ON b.day = a.day - 1)
        SELECT day AS "Day", n AS "DayRows", m AS "PreviousRows", {rnd("x * 100.0", 2)} AS "ChangePercent",
               CASE WHEN n < 10 THEN 'TOO_FEW' WHEN n > 40 THEN 'TOO_MANY' ELSE 'OK' END AS "Bounds",
               CASE WHEN abs(x) > 0.10 THEN 1 ELSE 0 END AS "Drift" FROM p""",
    "dq_orphan_fk": """
        SELECT store_key AS "OrphanKey", CASE WHEN store_key = 0 THEN 'DEFAULT' ELSE 'DANGLING' END AS "Kind",
               count(*) AS "FactRows" FROM w_sale WHERE store_key = 0 OR store_id % 11 = 5 GROUP BY 1, 2""",
    "dq_reconcile": """
        SELECT day AS "Day", count(*) AS "SourceRows", CAST(sum(revenue) AS DOUBLE) AS "SourceAmount",
               count(*) FILTER (WHERE ok) AS "TargetRows",
               CAST(coalesce(sum(revenue) FILTER (WHERE ok), 0) AS DOUBLE) AS "TargetAmount",
               count(*) FILTER (WHERE NOT ok) AS "RowDifference",
               CAST(coalesce(sum(revenue) FILTER (WHERE NOT ok), 0) AS DOUBLE) AS "AmountDifference"
        FROM (SELECT *, miss_1 IS NULL AND miss_2 IS NULL AS ok FROM w_late) GROUP BY 1""",
    "dq_pk_checks": """
        WITH x AS (SELECT CASE WHEN l_partkey % 100 <> 0 THEN l_orderkey END AS o, l_linenumber AS l FROM lineitem)
        SELECT CASE WHEN o IS NULL THEN 'NULL_PK' WHEN n > 1 THEN 'DUPLICATE_PK' ELSE 'OK' END AS "KeyCheck",
               count(*) AS "CheckedRows" FROM (SELECT o, count(*) OVER (PARTITION BY o, l) AS n FROM x) GROUP BY 1""",
    "customer_order_averages": """
        SELECT o_custkey AS "CustomerID", count(*) AS "OrderCount",
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS "LifetimeValue",
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS "AvgOrderValue",
               min(CAST(o_orderdate AS DATE)) AS "FirstOrderDate", max(CAST(o_orderdate AS DATE)) AS "LastOrderDate"
        FROM orders GROUP BY 1""",
}

#: A refresh of some months leaves the same roll-up as building all of it.
_SQL["regional_growth_refresh"] = _SQL["agg_regional_sales"]
#: Counts merged from stored words are those of all facts.
_SQL["sales_by_store_merged"] = _SQL["vw_sales_by_store"]
_SQL["sales_by_customer_merged"] = _SQL["vw_sales_by_customer"]

ORACLE: dict[str, str] = {name: with_ctes(sql) for name, sql in _SQL.items()}
