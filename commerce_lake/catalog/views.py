"""The derived tables in SQL, as CTEs for the comparison engine."""

from __future__ import annotations

import re

# Cleaning pattern in the comparison engine's regex dialect.
_KEPT = r"""[^A-Za-z0-9[:space:],.";:!?()_&%$#@]"""


def clean(c: str) -> str:
    return f"ltrim(regexp_replace({c}, '{_KEPT}', '', 'g'))"


def capitalized(c: str) -> str:
    words = f"regexp_extract_all(lower({c}), '[a-z0-9]+|[^a-z0-9]')"
    return f"array_to_string(list_transform({words}, lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')"


def key_of(natural: str, day: str) -> str:
    return f"md5({natural} || '|' || '{day}')"


def hash32(c: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8) AS BIGINT)"


def latest(table: str, key: str, order: str = "updated_at DESC, _seq DESC") -> str:
    """Newest version per key; `order` may be extended where positions tie."""
    return (
        f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM {table}) WHERE rn = 1)"
    )


ITEM_ORDER = "updated_at DESC, _seq DESC, order_id DESC, product_id DESC, quantity DESC, price DESC"
LATEST_ORDER = latest("t_order", "order_id")
LATEST_ITEM = latest("t_order_item", "order_item_id", ITEM_ORDER)
LATEST_PAYMENT = latest("t_payment", "payment_id")

_EPOCH = "TIMESTAMP '1995-01-01 00:00:00'"

VIEWS: dict[str, str] = {
    "t_user": f"""
        SELECT c_custkey AS user_id, c_name AS name,
               'buyer' || c_custkey || '@' || lower(c_mktsegment) || '.example' AS email,
               'h' || c_custkey AS password_hash,
               CASE WHEN c_custkey % 10 <> 0 THEN 'ext ' || c_custkey ELSE '' END AS phone,
               {_EPOCH} + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
               {_EPOCH} + to_days(CAST(c_custkey % 365 AS INTEGER)) AS updated_at,
               CAST(NULL AS TIMESTAMP) AS deleted_at, c_custkey AS _seq
        FROM customer""",
    "t_category": f"""
        SELECT CAST(n_nationkey AS BIGINT) + 1 AS category_id, n_name AS name,
               CASE WHEN n_nationkey % 5 <> 0 THEN CAST(n_regionkey AS BIGINT) + 1 END AS parent_id,
               {_EPOCH} AS created_at, {_EPOCH} AS updated_at,
               CAST(NULL AS TIMESTAMP) AS deleted_at, CAST(n_nationkey AS BIGINT) AS _seq
        FROM nation""",
    "t_product": f"""
        SELECT p_partkey AS product_id, p_name AS name, p_brand || ' / ' || p_type AS description,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(p_size AS INTEGER) AS stock_quantity,
               p_partkey % 26 AS category_id, {_EPOCH} AS created_at, {_EPOCH} AS updated_at,
               CAST(NULL AS TIMESTAMP) AS deleted_at, p_partkey AS _seq
        FROM part""",
    "t_order": """
        SELECT order_id, user_id,
               CASE WHEN _seq = 1 THEN 'created' ELSE final_status END AS order_status,
               total_amount, created_at,
               CASE WHEN _seq = 1 THEN created_at ELSE created_at + to_seconds(order_id % 3600) END AS updated_at,
               _seq
        FROM (SELECT o_orderkey AS order_id, o_custkey AS user_id,
                     CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'cancelled' ELSE 'created' END AS final_status,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
                     o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_at,
                     CAST(v.n AS BIGINT) AS _seq
              FROM orders, (VALUES (1), (2)) AS v(n))""",
    "t_final": "SELECT * FROM t_order WHERE _seq = 2",
    "t_order_item": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               o.created_at AS created_at, l_shipdate AS updated_at,
               l_suppkey * 1000000000 + CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS _seq
        FROM lineitem JOIN t_final o ON l_orderkey = o.order_id""",
    "t_payment": """
        SELECT order_id * 10 + shift AS payment_id, order_id, total_amount AS amount,
               CASE order_id % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'paypal' ELSE 'bank_transfer' END AS payment_method,
               updated_at + to_seconds(delay) AS payment_date,
               CASE WHEN shift > 0 OR order_status = 'completed' THEN 'completed' ELSE 'failed' END AS status,
               created_at, updated_at + to_seconds(delay) AS updated_at, order_id * 10 + shift AS _seq
        FROM t_final, (VALUES (0, 0), (1, 3600)) AS attempt(shift, delay)
        WHERE order_status IN ('completed', 'cancelled') AND (shift = 0 OR order_id % 50 = 0)""",
    "t_shipping": """
        SELECT order_id AS shipping_id, order_id, 'Dock ' || order_id AS address, n_name AS city,
               lpad(CAST(order_id % 100000 AS VARCHAR), 5, '0') AS postal_code, r_name AS country,
               updated_at AS shipping_date,
               CASE WHEN order_id % 7 <> 0 THEN 'PKG' || order_id ELSE '' END AS tracking_number,
               created_at, updated_at, order_id AS _seq
        FROM t_final JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        WHERE order_status <> 'created'""",
    "t_product_review": """
        SELECT order_item_id AS review_id, product_id, user_id, CAST(order_item_id % 5 + 1 AS INTEGER) AS rating,
               CASE WHEN order_item_id % 11 <> 0 THEN 'Item ' || product_id || ' as described' ELSE '' END AS comment,
               i.created_at AS created_at, i.created_at AS updated_at, i._seq AS _seq
        FROM t_order_item i JOIN t_final o USING (order_id)
        WHERE order_status = 'completed'""",
    "t_user_change": """
        SELECT u.* REPLACE ('ext ' || o.order_id || ' new' AS phone,
                            o.updated_at AS updated_at, o.order_id AS _seq)
        FROM t_user u JOIN t_final o USING (user_id)""",
    "t_sold": """
        SELECT l_orderkey AS o, l_partkey AS product_id, f.updated_at AS u
        FROM lineitem JOIN t_final f ON l_orderkey = f.order_id""",
    "t_product_change": """
        SELECT p.* REPLACE (CAST(p.price + o % 100 AS DECIMAL(18,2)) AS price,
                            CAST(p.stock_quantity + o % 7 AS INTEGER) AS stock_quantity,
                            u AS updated_at, o AS _seq)
        FROM t_product p JOIN t_sold USING (product_id)""",
    "t_category_change": """
        SELECT c.* REPLACE (CASE WHEN o % 6 <> 0 THEN o % 6 END AS parent_id, u AS updated_at, o AS _seq)
        FROM t_category c JOIN t_sold s ON c.category_id = s.product_id % 26""",
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the CTEs it needs, directly or through others."""
    known = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + "\n" + sql
