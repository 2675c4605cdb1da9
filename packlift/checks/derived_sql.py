"""The fixture tables of FIXTURES.md section 2 as a SQL ``WITH`` prefix.

Used only by the oracle: DuckDB runs ``WITH <DERIVED> <query>`` on the raw test
tables. The Spark side derives the same tables with the DataFrame API in
``packlift.sources.tpch``; the two derivations are written separately so that
each checks the other.
"""


def _client(x: str) -> str:
    return (f"CAST(CASE {x} % 7 WHEN 0 THEN 16 WHEN 1 THEN 28 WHEN 2 THEN 35 WHEN 3 THEN 36 "
            f"WHEN 4 THEN 37 WHEN 5 THEN 418 ELSE 99 END AS INTEGER)")


DERIVED = f"""
m_sale_k AS (
  SELECT CAST(l.l_partkey AS BIGINT) AS id_sku,
         {_client('l.l_suppkey')} AS id_client,
         CAST(CASE WHEN l.l_orderkey % 41 = 0 THEN NULL ELSE 7700000000 + o.o_custkey END AS BIGINT) AS tin_buyer,
         DATE '2023-09-01' + CAST((l.l_orderkey * 13 + l.l_linenumber * 29) % 360 AS INTEGER) AS operation_date,
         CAST(CASE WHEN l.l_orderkey % 37 = 0 THEN -l.l_quantity
                   WHEN l.l_orderkey % 31 = 0 THEN 0
                   ELSE l.l_quantity % 13 END AS DECIMAL(18,3)) AS quantity,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 3 ELSE 4 END AS INTEGER) AS id_operation_type,
         CASE WHEN l.l_orderkey % 19 = 0 THEN DATE '2024-02-02' ELSE DATE '2000-01-01' END AS delete_date,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
m_sale AS (
  SELECT id_sku, id_client, tin_buyer, operation_date, quantity, id_operation_type, delete_date FROM m_sale_k
),
m_sku AS (
  SELECT CAST(p_partkey AS BIGINT) AS id_sku, CAST(p_partkey // 10 AS INTEGER) AS id_common_sku,
         CASE WHEN p_partkey % 43 = 42 THEN DATE '2024-01-01' END AS delete_date
  FROM part
),
m_common_sku AS (
  SELECT id_common_sku, 'Common ' || CAST(id_common_sku AS VARCHAR) AS common_sku_name,
         CASE WHEN id_common_sku % 10 = 9 THEN DATE '2024-01-01' END AS delete_date
  FROM (SELECT DISTINCT CAST(p_partkey // 10 AS INTEGER) AS id_common_sku FROM part) c
),
m_promo AS (
  SELECT CAST(p_partkey AS INTEGER) AS id_promotion,
         CAST(p_partkey % 4 AS INTEGER) AS id_promotion_type,
         {_client('p_partkey')} AS id_client,
         DATE '2023-09-20' + CAST((p_partkey * 37) % 300 AS INTEGER) AS start_date,
         DATE '2023-09-20' + CAST((p_partkey * 37) % 300
                                  + CASE WHEN p_partkey % 20 = 5 THEN 0 WHEN p_partkey % 50 = 7 THEN -2 ELSE p_size % 28 END AS INTEGER) AS end_date,
         CASE WHEN p_partkey % 11 = 10 THEN DATE '2024-01-01' END AS delete_date
  FROM part
),
m_lnk AS (
  SELECT CAST(p_partkey AS INTEGER) AS id_promotion, CAST(p_partkey // 10 AS INTEGER) AS id_common_sku,
         CAST(NULL AS DATE) AS delete_date
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS INTEGER), CAST(p_partkey // 10 + 3 AS INTEGER),
         CASE WHEN p_partkey % 13 = 12 THEN DATE '2024-01-01' END
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS INTEGER), CAST(p_partkey // 10 AS INTEGER), CAST(NULL AS DATE)
  FROM part WHERE p_partkey % 29 = 3
),
m_exc AS (
  SELECT id_client, id_sku, tin_buyer, operation_date - 5 AS start_date,
         CASE WHEN l_orderkey % 23 = 0 THEN operation_date - 6 ELSE operation_date + 20 END AS end_date
  FROM m_sale_k
  WHERE (l_orderkey * 7 + l_linenumber * 3) % 9 = 0
),
m_pairs AS (
  SELECT k.id_promotion, p.id_promotion_type, k.id_common_sku, p.id_client, p.start_date, p.end_date
  FROM m_lnk k JOIN m_promo p ON p.id_promotion = k.id_promotion
  WHERE k.delete_date IS NULL AND p.delete_date IS NULL
),
m_price AS (
  SELECT id_client, CAST(id_common_sku AS BIGINT) * 10 AS id_sku, start_date AS sale_date,
         CAST(10 + id_promotion % 7 AS DECIMAL(18,2)) AS bonus, CAST(NULL AS DATE) AS delete_date
  FROM m_pairs WHERE id_promotion % 8 <> 7
  UNION ALL
  SELECT id_client, CAST(id_common_sku AS BIGINT) * 10, start_date, CAST(99 AS DECIMAL(18,2)), DATE '2024-01-01'
  FROM m_pairs WHERE id_promotion % 9 = 0
  UNION ALL
  SELECT id_client, CAST(id_common_sku AS BIGINT) * 10 + 1, start_date, CAST(12.5 AS DECIMAL(18,2)), CAST(NULL AS DATE)
  FROM m_pairs WHERE id_promotion % 17 = 0
  UNION ALL
  SELECT id_client, -1 - CAST(id_common_sku AS BIGINT) * 10, start_date, CAST(7 AS DECIMAL(18,2)), CAST(NULL AS DATE)
  FROM m_pairs WHERE id_promotion % 23 = 0
),
m_result AS (
  SELECT CAST(pr.id_common_sku AS BIGINT) * 10 AS id_sku, s.id_client, s.tin_buyer, pr.start_date, pr.end_date,
         CAST(pr.id_promotion_type + CASE WHEN pr.id_promotion % 6 = 5 THEN 3 ELSE 2 END AS INTEGER) AS multiple,
         CAST(10 + pr.id_promotion % 7 AS DECIMAL(18,2)) AS bonus,
         CAST(s.quantity + CASE WHEN s.tin_buyer % 3 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,3)) AS quantity
  FROM m_sale s
  JOIN m_sku k ON k.id_sku = s.id_sku
  JOIN m_pairs pr ON pr.id_common_sku = k.id_common_sku AND pr.id_client = s.id_client
  WHERE s.operation_date BETWEEN pr.start_date AND pr.end_date
    AND s.quantity >= 2 AND s.id_operation_type = 4 AND s.tin_buyer % 5 <> 0
),
m_client AS (
  SELECT {_client('n_nationkey')} AS id_client, n_name AS client_name,
         CASE WHEN n_nationkey = 9 THEN DATE '2024-01-01' END AS delete_date,
         CASE WHEN n_nationkey < 7 THEN DATE '2021-01-01' ELSE DATE '2000-01-01' END AS valid_from,
         CASE WHEN n_nationkey < 7 THEN DATE '9999-12-31' ELSE DATE '2020-12-31' END AS valid_to
  FROM nation
),
m_type AS (
  SELECT CAST(r_regionkey AS INTEGER) AS id_promotion_type,
         CAST(r_regionkey + 1 AS VARCHAR) || '+1' AS promotion_type_name
  FROM region
),
m_entity AS (
  SELECT CAST(7700000000 + c_custkey AS BIGINT) AS id_legal_entity, c_name AS legal_entity_name,
         CASE WHEN c_custkey % 10 = 9 THEN DATE '2024-01-01' END AS delete_date
  FROM customer
)
"""


def with_derived(body: str) -> str:
    """``WITH <derived tables>, <body CTEs ...> SELECT ...``.

    ``body`` either starts with further CTEs (``name AS (...), ... SELECT``) or
    with the final ``SELECT``.
    """
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {DERIVED.strip()}\n{body}"
    return f"WITH {DERIVED.strip()},\n{body}"
