"""The same results in plain SQL, for the queries SQL can express.

Common table expressions are kept once and pulled in by name, together with
whatever they refer to.
"""

from __future__ import annotations

import re


def _round(expr: str, digits: int = 4) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(30,9)), {digits}) AS DOUBLE)"


def _tower(name: str, source: str, keys: str, total: str, average: str, level: int, use_context: bool = True) -> str:
    """Forward pass of a tower over ``source`` with columns keys, vec, total, average."""

    def w(number: int, inputs: int, units: int) -> str:
        return (
            f"(SELECT list_transform(range({units}), lambda j: list_transform(range({inputs}), lambda i: "
            f"CAST(((i*31 + j*17 + {number + level}*13) % 101) - 50 AS DOUBLE) / CAST(500 AS DOUBLE))))"
        )

    def dense(number: int, units: int, x: str, relu: bool, weights: str) -> str:
        value = (
            f"list_inner_product({x}, {weights}[CAST(j + 1 AS INTEGER)]) "
            f"+ CAST(((j*7 + {number + level}) % 11) - 5 AS DOUBLE) / CAST(100 AS DOUBLE)"
        )
        return f"list_transform(range({units}), lambda j: {f'greatest(0.0::DOUBLE, {value})' if relu else value})"

    inputs = 96 if use_context else 64
    context = (
        dense(1, 32, f"[ln(1 + CAST({total} AS DOUBLE)), ln(1 + {average})]", True, "w1") if use_context else "[]::DOUBLE[]"
    )
    return f"""
      SELECT {keys}, list_transform(o, lambda x: x / sqrt(list_inner_product(o, o))) AS v FROM (
        SELECT {keys}, {dense(3, 64, "h", False, "w3")} AS o FROM (
          SELECT {keys}, w3, {dense(2, 128, "x", True, "w2")} AS h FROM (
            SELECT {keys}, w2, w3, list_concat(vec, {context}) AS x
            FROM {source}, (SELECT {w(1, 2, 32)} AS w1, {w(2, inputs, 128)} AS w2, {w(3, 128, 64)} AS w3) AS {name}_w)))"""


_PAIR_HASH = "CAST('0x' || substr(md5(customer_id || '|' || article_id || '|42'), 1, 15) AS BIGINT)"


def _candidates(source: str, items: str) -> str:
    return f"""
      SELECT customer_id, p.article_id AS positive_article_id, i.article_id AS negative_article_id
      FROM (SELECT customer_id, article_id, {_PAIR_HASH} % n AS item_index
            FROM {source}, (SELECT count(*) AS n FROM {items})) p
      JOIN {items} i USING (item_index)"""


def _unpurchased(candidates: str, positives: str) -> str:
    return f"""
      SELECT DISTINCT customer_id, negative_article_id AS article_id FROM {candidates} c
      WHERE NOT EXISTS (SELECT 1 FROM {positives} p
                        WHERE p.customer_id = c.customer_id AND p.article_id = c.negative_article_id)"""


def _index(key: str, index: str, source: str) -> str:
    return f"SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS {index} FROM (SELECT DISTINCT {key} FROM {source})"


def _served(source: str, key: str, prefix: str, index: str) -> str:
    return f"""
      SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS {index}, count(price) AS {prefix}_total_purchases,
        sum(price) / count(price) AS {prefix}_avg_price
      FROM (SELECT {key}, TRY_CAST(price AS DOUBLE) AS price FROM {source})
      WHERE {key} IS NOT NULL AND price IS NOT NULL GROUP BY {key}"""


def _context(source: str, key: str, prefix: str, more: str = "") -> str:
    return (
        f"SELECT {key}, count(*) AS {prefix}_total_purchases, avg(price) AS {prefix}_avg_price{more} "
        f"FROM {source} GROUP BY {key}"
    )


_CTES = {
    "order_lines": """
      SELECT o_custkey AS customer_id, l_partkey AS article_id, CAST(o_orderdate AS DATE) AS t_dat,
        l_extendedprice AS price, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS sales_channel_id,
        l_quantity, l_returnflag, o_orderstatus, o_orderpriority
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "transactions": "SELECT customer_id, article_id, t_dat, price, sales_channel_id FROM order_lines",
    "articles": """
      SELECT p_partkey AS article_id, CAST(floor(p_partkey / 10) AS BIGINT) AS product_code, p_name, p_brand, p_type
      FROM part""",
    "customers": "SELECT c_custkey AS customer_id, c_nationkey, c_mktsegment FROM customer",
    "marked_lines": """
      SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR l_quantity <> 5 THEN customer_id END AS customer_id,
        CASE WHEN l_quantity <> 6 THEN article_id END AS article_id,
        CASE WHEN l_quantity = 7 AND l_returnflag = 'N' THEN 'unknown' ELSE CAST(t_dat AS VARCHAR) END AS t_dat,
        CASE WHEN l_quantity = 1 AND l_returnflag = 'R' THEN '-' || CAST(price AS VARCHAR)
             WHEN l_quantity = 2 AND l_returnflag = 'N' THEN NULL
             WHEN l_quantity = 3 AND l_returnflag = 'A' THEN 'n/a'
             WHEN l_quantity = 4 AND l_returnflag = 'A' THEN '0'
             ELSE CAST(price AS VARCHAR) END AS price,
        sales_channel_id, o_orderstatus
      FROM order_lines""",
    "raw_transactions": """
      SELECT * EXCLUDE (o_orderstatus) FROM marked_lines
      UNION ALL SELECT * EXCLUDE (o_orderstatus) FROM marked_lines WHERE o_orderstatus = 'P'""",
    "raw_articles": """
      SELECT p_partkey AS article_id,
        CASE WHEN p_size <> 1 THEN CAST(floor(p_partkey / 10) AS BIGINT) END AS product_code, p_name, p_brand, p_type
      FROM part
      UNION ALL
      SELECT p_partkey, CASE WHEN p_size <> 2 THEN CAST(floor(p_partkey / 10) AS BIGINT) END, upper(p_name), p_brand, p_type
      FROM part WHERE p_type = 'PROMO'""",
    "keyed_customers": """
      SELECT CASE WHEN c_acctbal >= 0 OR c_nationkey <> 3 THEN c_custkey END AS customer_id, c_nationkey, c_mktsegment
      FROM customer""",
    "raw_customers": """
      SELECT * FROM keyed_customers
      UNION ALL SELECT customer_id, c_nationkey, 'AUTOMOBILE' FROM keyed_customers WHERE c_mktsegment = 'BUILDING'""",
    "cleaned_articles": """
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY product_code, p_name, p_brand, p_type) AS rn
        FROM raw_articles WHERE article_id IS NOT NULL AND product_code IS NOT NULL) WHERE rn = 1""",
    "cleaned_customers": """
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY c_nationkey, c_mktsegment) AS rn
        FROM raw_customers WHERE customer_id IS NOT NULL) WHERE rn = 1""",
    "cleaned_transactions": """
      SELECT customer_id, article_id, TRY_CAST(t_dat AS DATE) AS t_dat, TRY_CAST(price AS DOUBLE) AS price, sales_channel_id
      FROM (SELECT DISTINCT * FROM raw_transactions)
      WHERE customer_id IS NOT NULL AND article_id IS NOT NULL AND TRY_CAST(price AS DOUBLE) > 0
        AND TRY_CAST(t_dat AS DATE) IS NOT NULL""",
    "day_range": "SELECT min(t_dat) AS first_day, max(t_dat) AS last_day FROM transactions",
    "train_bound": """
      SELECT first_day + CAST(trunc((last_day - first_day) * CAST(0.70 AS DOUBLE)) AS INTEGER) AS train_end,
        CAST(trunc((last_day - first_day) * CAST(0.15 AS DOUBLE)) AS INTEGER) AS validation_days FROM day_range""",
    "split_rows": """
      SELECT t.*, CASE WHEN t_dat < train_end THEN 'train' WHEN t_dat < train_end + validation_days THEN 'validation'
        ELSE 'test' END AS split FROM transactions t, train_bound""",
    "train": "SELECT * EXCLUDE (split) FROM split_rows WHERE split = 'train'",
    "users": _index("customer_id", "user_index", "transactions"),
    "items": _index("article_id", "item_index", "transactions"),
    "train_items": _index("article_id", "item_index", "train"),
    "positives": "SELECT DISTINCT customer_id, article_id FROM transactions",
    "train_positives": "SELECT DISTINCT customer_id, article_id FROM train",
    "candidates": _candidates("positives", "items"),
    "train_candidates": _candidates("train_positives", "train_items"),
    "negatives": _unpurchased("candidates", "positives"),
    "train_negatives": _unpurchased("train_candidates", "train_positives"),
    "interactions": """
      SELECT *, CAST(1 AS DOUBLE) AS label FROM positives UNION ALL SELECT *, CAST(0 AS DOUBLE) AS label FROM negatives""",
    "train_interactions": """
      SELECT *, CAST(1 AS DOUBLE) AS label FROM train_positives
      UNION ALL SELECT *, CAST(0 AS DOUBLE) AS label FROM train_negatives""",
    "indexed_interactions": """
      SELECT user_index, item_index, label FROM interactions JOIN users USING (customer_id) JOIN items USING (article_id)""",
    "train_user_context": _context("train", "customer_id", "customer"),
    "train_item_context": _context("train", "article_id", "item"),
    "context_rows": """
      SELECT article_id, customer_id, CAST(1 AS DOUBLE) AS label, item_total_purchases, item_avg_price,
        customer_total_purchases, customer_avg_price
      FROM positives LEFT JOIN train_item_context USING (article_id) LEFT JOIN train_user_context USING (customer_id)""",
    "model_rows": """
      SELECT user_index, item_index, customer_total_purchases, customer_avg_price, item_total_purchases, item_avg_price, label
      FROM train_interactions JOIN users USING (customer_id) JOIN items USING (article_id)
      LEFT JOIN train_user_context USING (customer_id) LEFT JOIN train_item_context USING (article_id)""",
    "numbered_rows": """
      SELECT *, row_number() OVER (
        ORDER BY md5(user_index || '|' || item_index || '|42'), user_index, item_index, label) - 1 AS row_number
      FROM indexed_interactions""",
    "ordered_rows": """
      SELECT *, row_number() OVER (ORDER BY user_index, item_index, label) - 1 AS row_number FROM indexed_interactions""",
    "served_users": _served("transactions", "customer_id", "customer", "user_index"),
    "served_items": _served("transactions", "article_id", "item", "item_index"),
    "raw_served_users": _served("raw_transactions", "customer_id", "customer", "user_index"),
    "raw_served_items": _served("raw_transactions", "article_id", "item", "item_index"),
    "vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings",
    "user_inputs": """
      SELECT u.*, vec FROM served_users u JOIN vectors ON vec_id = user_index % (SELECT count(*) FROM vectors)""",
    "item_inputs": """
      SELECT i.*, vec FROM served_items i JOIN vectors ON vec_id = item_index % (SELECT count(*) FROM vectors)""",
    "user_vectors": _tower(
        "u", "user_inputs", "customer_id, user_index", "customer_total_purchases", "customer_avg_price", 0
    ),
    "item_vectors": _tower("i", "item_inputs", "article_id, item_index", "item_total_purchases", "item_avg_price", 5),
    "plain_item_vectors": _tower("i", "item_inputs", "article_id, item_index", "", "", 5, False),
    "user_item_scores": """
      SELECT customer_id, article_id, item_index, round(list_inner_product(u.v, i.v), 6) + CAST(0 AS DOUBLE) AS similarity
      FROM user_vectors u, item_vectors i""",
    "top_hundred": """
      SELECT customer_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY similarity DESC, article_id) AS INTEGER)
        AS rank, article_id, item_index, similarity FROM user_item_scores
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY similarity DESC, article_id) <= 100""",
    "top_ten": "SELECT * FROM top_hundred WHERE rank <= 10",
    "vector_top_ten": """
      SELECT query_id, CAST(rank AS INTEGER) AS rank, article_id, item_index, similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, article_id) AS rank FROM (
          SELECT q.vec_id AS query_id, i.vec_id AS article_id, i.vec_id AS item_index,
            round(list_inner_product(q.vec, i.vec), 6) + CAST(0 AS DOUBLE) AS similarity
          FROM vectors q, vectors i)) WHERE rank <= 10""",
    "scored_pairs": """
      SELECT user_index, item_index, label, list_inner_product(u.v, i.v) AS score
      FROM indexed_interactions JOIN user_vectors u USING (user_index) JOIN item_vectors i USING (item_index)""",
    "lookups": "SELECT event_id, user_id * 20 AS customer_id FROM events",
    "asked": """
      SELECT event_id AS request_id, CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id * 20 AS VARCHAR) END
        AS customer_id, coalesce(CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS INTEGER) END, 10) AS top_k FROM events""",
    "checked": """
      SELECT a.*, CASE WHEN top_k < 1 OR top_k > 100 THEN 422 WHEN a.customer_id = '' THEN 400
        WHEN u.customer_id IS NULL THEN 404 ELSE 200 END AS status
      FROM asked a LEFT JOIN users u ON a.customer_id = CAST(u.customer_id AS VARCHAR)""",
    "stored": """
      SELECT 'recommendations:user_' || customer_id AS key, customer_id, created_at,
        created_at + INTERVAL 3600 SECOND AS expires_at,
        list(item_index ORDER BY rank) AS items
      FROM (SELECT customer_id, rank, item_index, CAST(first_day AS TIMESTAMP) AS created_at, 5 AS top
            FROM top_ten JOIN (SELECT customer_id, min(t_dat) AS first_day FROM transactions GROUP BY 1) USING (customer_id)
            UNION ALL
            SELECT customer_id, rank, item_index, CAST(last_day AS TIMESTAMP), 10
            FROM top_ten JOIN (SELECT customer_id, max(t_dat) AS last_day FROM transactions GROUP BY 1) USING (customer_id))
      WHERE rank <= top GROUP BY customer_id, created_at, top""",
    "payloads": """
      SELECT key, customer_id, created_at, expires_at, items,
        '{"user_id":' || customer_id || ',"items":[' || array_to_string(items, ',') || ']}' AS payload FROM stored""",
    "live_entries": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY created_at DESC, payload DESC) AS rn FROM payloads)
      WHERE rn = 1 AND expires_at > (SELECT CAST(last_day AS TIMESTAMP) + INTERVAL 30 MINUTE FROM day_range)""",
    "index_checks": """
      SELECT 'user indices are sequential' AS check_name,
        min(user_index) = 0 AND max(user_index) = count(*) - 1 AND count(DISTINCT user_index) = count(*) AS passed FROM users
      UNION ALL SELECT 'customer keys are sorted', count(*) FILTER (a.customer_id >= b.customer_id) = 0
        FROM users a JOIN users b ON b.user_index = a.user_index + 1
      UNION ALL SELECT 'item indices are sequential',
        min(item_index) = 0 AND max(item_index) = count(*) - 1 AND count(DISTINCT item_index) = count(*) FROM items
      UNION ALL SELECT 'article keys are sorted', count(*) FILTER (a.article_id >= b.article_id) = 0
        FROM items a JOIN items b ON b.item_index = a.item_index + 1
      UNION ALL SELECT 'item mappings are identical', count(*) = 0 FROM (
        (SELECT article_id, item_index FROM items EXCEPT ALL SELECT article_id, item_index FROM served_items)
        UNION ALL
        (SELECT article_id, item_index FROM served_items EXCEPT ALL SELECT article_id, item_index FROM items))""",
    "damaged_users": """
      SELECT customer_id, CASE user_index WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE user_index END AS user_index
      FROM users WHERE user_index != 3""",
    "damaged_index_checks": """
      SELECT 'user indices are sequential' AS check_name,
        min(user_index) = 0 AND max(user_index) = count(*) - 1 AND count(DISTINCT user_index) = count(*) AS passed FROM damaged_users
      UNION ALL SELECT 'customer keys are sorted', count(*) FILTER (a.customer_id >= b.customer_id) = 0
        FROM damaged_users a JOIN damaged_users b ON b.user_index = a.user_index + 1
      UNION ALL SELECT 'item indices are sequential',
        min(item_index) = 0 AND max(item_index) = count(*) - 1 AND count(DISTINCT item_index) = count(*) FROM items
      UNION ALL SELECT 'article keys are sorted', count(*) FILTER (a.article_id >= b.article_id) = 0
        FROM items a JOIN items b ON b.item_index = a.item_index + 1
      UNION ALL SELECT 'item mappings are identical', count(*) <= 5 FROM items""",
    "damaged_context_checks": """
      SELECT 'purchase counts are positive' AS check_name, count(*) FILTER (user_index % 11 = 0) = 0 AS passed FROM raw_served_users
      UNION ALL SELECT 'average prices are finite', count(*) FILTER (isfinite(customer_avg_price)) = count(*)
      FROM raw_served_users""",
    "damaged_lists": """
      SELECT customer_id, article_id % 7 AS article_id FROM transactions
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY t_dat, article_id, price) <= 10""",
    "context_checks": """
      SELECT 'purchase counts are positive' AS check_name, count(*) FILTER (customer_total_purchases > 0) = count(*) AS passed
      FROM raw_served_users
      UNION ALL SELECT 'average prices are finite', count(*) FILTER (isfinite(customer_avg_price)) = count(*)
      FROM raw_served_users""",
}


def _components(source: str, keys: str) -> str:
    return f"""
      SELECT {keys}, CAST(c.component AS INTEGER) AS component, {_round("v[CAST(c.component + 1 AS INTEGER)]", 6)} AS value
      FROM {source}, (SELECT unnest(range(64)) AS component) c"""


def _statistics(*columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS value_count, {_round(f'avg({c})')} AS mean, "
        f"{_round(f'stddev_samp({c})')} AS stddev, {_round(f'min({c})')} AS min_value, {_round(f'max({c})')} AS max_value "
        "FROM model_rows"
        for c in columns
    )


def _probe(table: str, source: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, true AS present, count({c}) AS filled_rows, "
        f"count(*) AS table_rows FROM {source}"
        for c in columns
    )


_MODEL_CONTEXT = ("customer_total_purchases", "customer_avg_price", "item_total_purchases", "item_avg_price")

_QUERIES = {
    "scan_articles": "SELECT * FROM articles",
    "scan_customers": "SELECT * FROM customers",
    "scan_transactions": "SELECT * FROM transactions",
    "probe_columns": " UNION ALL ".join(
        [
            _probe("articles", "raw_articles", "article_id", "product_code"),
            _probe("customers", "raw_customers", "customer_id"),
            _probe("transactions", "raw_transactions", "t_dat", "customer_id", "article_id", "price", "sales_channel_id"),
        ]
    ),
    "sample_transactions": "SELECT * FROM transactions ORDER BY customer_id, t_dat, article_id, price LIMIT 5",
    "clean_articles": "SELECT * FROM cleaned_articles",
    "clean_customers": "SELECT * FROM cleaned_customers",
    "clean_transactions": "SELECT * FROM cleaned_transactions",
    "dataset_statistics": """
      SELECT 'articles' AS table_name, count(*) AS row_count, 5 AS column_count, CAST(NULL AS DATE) AS min_date,
        CAST(NULL AS DATE) AS max_date FROM cleaned_articles
      UNION ALL SELECT 'customers', count(*), 3, NULL, NULL FROM cleaned_customers
      UNION ALL SELECT 'transactions', count(*), 5, min(t_dat), max(t_dat) FROM cleaned_transactions""",
    "coerce_and_drop": """
      SELECT customer_id, TRY_CAST(price AS DOUBLE) AS price FROM raw_transactions
      WHERE customer_id IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NOT NULL""",
    "label_all_transactions": "SELECT customer_id, article_id, CAST(1 AS INTEGER) AS label FROM transactions",
    "temporal_split": "SELECT * FROM split_rows",
    "split_statistics": """
      SELECT split, count(*) AS row_count, min(t_dat) AS min_date, max(t_dat) AS max_date FROM split_rows GROUP BY split""",
    "customer_frequency": "SELECT customer_id, count(*) AS purchase_frequency FROM transactions GROUP BY 1",
    "article_popularity": "SELECT article_id, count(*) AS purchase_count FROM transactions GROUP BY 1",
    "customer_article_features": """
      SELECT customer_id, article_id, max(t_dat) AS last_purchase_date, count(*) AS customer_article_purchase_count,
        CAST((SELECT max(t_dat) FROM transactions) - max(t_dat) AS INTEGER) AS recency_days
      FROM transactions GROUP BY 1, 2""",
    "calendar_features": """
      SELECT *, CAST(year(t_dat) AS INTEGER) AS purchase_year, CAST(month(t_dat) AS INTEGER) AS purchase_month,
        CAST(day(t_dat) AS INTEGER) AS purchase_day, CAST(dayofweek(t_dat) + 1 AS INTEGER) AS purchase_day_of_week
      FROM transactions""",
    "customer_features": f"""
      SELECT customer_id, count(*) AS customer_total_purchases, {_round("avg(price)")} AS customer_avg_price,
        max(t_dat) AS customer_last_purchase_date FROM transactions GROUP BY 1""",
    "item_features": f"""
      SELECT article_id, count(*) AS item_total_purchases, {_round("avg(price)")} AS item_avg_price,
        max(t_dat) AS item_last_purchase_date FROM transactions GROUP BY 1""",
    "monthly_item_popularity": """
      SELECT article_id, CAST(year(t_dat) AS INTEGER) AS purchase_year, CAST(month(t_dat) AS INTEGER) AS purchase_month,
        count(*) AS monthly_item_purchases FROM transactions GROUP BY 1, 2, 3""",
    "user_context": f"""
      SELECT customer_id, count(*) AS customer_total_purchases, {_round("avg(price)")} AS customer_avg_price
      FROM transactions GROUP BY 1""",
    "item_context": f"""
      SELECT article_id, count(*) AS item_total_purchases, {_round("avg(price)")} AS item_avg_price
      FROM transactions GROUP BY 1""",
    "real_interactions": f"""
      SELECT customer_id, article_id, count(*) AS interaction_count, min(TRY_CAST(t_dat AS DATE)) AS first_purchase_date,
        max(TRY_CAST(t_dat AS DATE)) AS last_purchase_date, {_round("avg(TRY_CAST(price AS DOUBLE))")} AS average_price,
        max(sales_channel_id) AS sales_channel_id, CAST(1 AS DOUBLE) AS label
      FROM raw_transactions
      WHERE customer_id IS NOT NULL AND article_id IS NOT NULL AND TRY_CAST(t_dat AS DATE) IS NOT NULL
        AND TRY_CAST(price AS DOUBLE) > 0
      GROUP BY 1, 2""",
    "unique_counts": """
      SELECT count(*) AS row_count, count(DISTINCT customer_id) AS unique_customers,
        count(DISTINCT article_id) AS unique_articles FROM transactions""",
    "unique_counts_sketched": """
      SELECT count(*) AS row_count, true AS unique_customers_close, true AS unique_articles_close FROM transactions""",
    "split_bounds_footers": """
      SELECT first_day, train_end, train_end + CAST(floor(days * 0.15::DOUBLE) AS INTEGER) AS validation_end, last_day
      FROM (SELECT *, first_day + CAST(floor(days * 0.7::DOUBLE) AS INTEGER) AS train_end
            FROM (SELECT min(t_dat) AS first_day, max(t_dat) AS last_day, max(t_dat) - min(t_dat) AS days FROM transactions))""",
    "published_user_context": f"""
      SELECT * REPLACE ({_round("customer_avg_price")} AS customer_avg_price) FROM raw_served_users""",
    "user_context_lookup": f"""
      SELECT * REPLACE ({_round("customer_avg_price")} AS customer_avg_price) FROM raw_served_users""",
    "item_context_lookup": f"SELECT * REPLACE ({_round('item_avg_price')} AS item_avg_price) FROM raw_served_items",
    "user_context_vector": """
      SELECT customer_id, user_index, CAST(0 AS INTEGER) AS component, CAST(customer_total_purchases AS DOUBLE) AS value FROM served_users
      UNION ALL SELECT customer_id, user_index, CAST(1 AS INTEGER), round(CAST(CAST(customer_avg_price AS FLOAT) AS DOUBLE), 2)
      FROM served_users""",
    "user_mapping": "SELECT * FROM users",
    "item_mapping": "SELECT * FROM items",
    "two_tower_dataset": """
      SELECT user_index, item_index, price, sales_channel_id, CAST(1 AS INTEGER) AS label
      FROM transactions JOIN users USING (customer_id) JOIN items USING (article_id)""",
    "id_mapped_interactions": """
      SELECT customer_id, article_id, CAST(1 AS DOUBLE) AS label, user_index, item_index
      FROM positives JOIN users USING (customer_id) JOIN items USING (article_id)""",
    "context_joined": f"""
      SELECT * REPLACE ({_round("customer_avg_price")} AS customer_avg_price, {_round("item_avg_price")} AS item_avg_price)
      FROM context_rows""",
    "lookup_user_index": """
      SELECT event_id, customer_id, user_index, user_index IS NOT NULL AS found
      FROM lookups LEFT JOIN served_users USING (customer_id)""",
    "lookup_user_context": f"""
      SELECT event_id, customer_id, customer_total_purchases, {_round("customer_avg_price")} AS customer_avg_price,
        user_index IS NOT NULL AS found FROM lookups LEFT JOIN served_users USING (customer_id)""",
    "lookup_by_fences": f"""
      SELECT event_id, customer_id, customer_total_purchases, {_round("customer_avg_price")} AS customer_avg_price,
        user_index IS NOT NULL AS found FROM lookups LEFT JOIN served_users USING (customer_id)""",
    "positive_interactions": "SELECT customer_id, article_id, CAST(1 AS DOUBLE) AS label FROM positives",
    "positive_counts": "SELECT customer_id, count(*) AS positive_count FROM positives GROUP BY 1",
    "negative_candidates": "SELECT * FROM candidates",
    "negative_candidates_unpurchased": "SELECT * FROM negatives",
    "negative_interactions": "SELECT *, CAST(0 AS DOUBLE) AS label FROM negatives",
    "negative_interactions_half": f"""
      SELECT customer_id, article_id, CAST(0 AS DOUBLE) AS label FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {_PAIR_HASH}, article_id) AS rn FROM negatives)
      JOIN (SELECT customer_id, count(*) AS positive_count FROM positives GROUP BY 1) USING (customer_id)
      WHERE rn <= positive_count * 0.5""",
    "negative_interactions_xxhash64": """
      SELECT customer_id, count(*) AS positives, true AS no_more_negatives, CAST(0 AS BIGINT) AS overlap, CAST(0 AS BIGINT) AS repeated
      FROM positives GROUP BY 1""",
    "als_embeddings": """
      SELECT 'user' AS side, user_index AS index, CAST(64 AS INTEGER) AS size, true AS finite, true AS unit FROM users
      UNION ALL SELECT 'item', item_index, CAST(64 AS INTEGER), true, true FROM items""",
    "context_ranker_loss": "SELECT count(*) AS example_count, true AS better_than_even FROM model_rows",
    "fitted_recall": """
      SELECT count(DISTINCT customer_id) AS user_count, true AS hits_are_customers, true AS recall_is_their_share
      FROM split_rows WHERE split = 'test'""",
    "two_tower_fit": """
      SELECT (SELECT count(DISTINCT customer_id) FROM split_rows WHERE split = 'test') AS user_count,
        count(DISTINCT customer_id) AS user_vectors, count(DISTINCT article_id) AS item_vectors,
        CAST(2 * (32 + 128 + 64) AS BIGINT) AS weight_rows, true AS loss_fell, true AS hits_are_customers
      FROM transactions""",
    "item_topk_ivf": """
      SELECT count(*) AS query_count, true AS recall_reached, true AS fewer_than_all_pairs, true AS all_lists_are_exact
      FROM vectors""",
    "item_topk_float": """
      SELECT article_id AS query_id, true AS unit, true AS finds_itself, CAST(10 AS BIGINT) AS result_count FROM items""",
    "scan_transactions_csv": "SELECT * FROM transactions",
    "damaged_index_quality": """SELECT * FROM damaged_index_checks""",
    "damaged_embedding_contract": """
      SELECT unnest(['embedding count matches mapping', 'stored count matches', 'vector size matches', 'vectors are finite',
                     'vectors have unit length', 'stored vectors match']) AS check_name,
             unnest([true, true, true, true, doubled = 0, false]) AS passed
      FROM (SELECT count(*) FILTER (vec_id % 7 = 3) AS doubled FROM embeddings)""",
    "damaged_context_quality": "SELECT * FROM damaged_context_checks",
    "damaged_recommendation_quality": """
      SELECT 'some list was produced' AS check_name, count(*) > 0 AS passed FROM damaged_lists
      UNION ALL SELECT 'every list has the expected length', bool_and(n = 10)
        FROM (SELECT count(*) AS n FROM damaged_lists GROUP BY customer_id)
      UNION ALL SELECT 'articles of a list are distinct', bool_and(n = u)
        FROM (SELECT count(*) AS n, count(DISTINCT article_id) AS u FROM damaged_lists GROUP BY customer_id)
      UNION ALL SELECT 'scores are finite', true""",
    "damaged_verdict": """
      SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS failed_checks
      FROM (SELECT * FROM damaged_index_checks UNION ALL SELECT * FROM damaged_context_checks)""",
    "training_interactions": "SELECT * FROM interactions",
    "label_distribution": "SELECT label, count(*) AS row_count FROM interactions GROUP BY 1",
    "two_tower_training": "SELECT * FROM indexed_interactions",
    "training_features": f"""
      SELECT * REPLACE ({_round("customer_avg_price")} AS customer_avg_price, {_round("item_avg_price")} AS item_avg_price)
      FROM model_rows""",
    "normalized_context": "SELECT user_index, item_index, "
    + ", ".join(f"{_round(f'ln(1 + {c})', 6)} AS {c}" for c in _MODEL_CONTEXT)
    + ", label FROM model_rows",
    "context_null_counts": "SELECT "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in _MODEL_CONTEXT)
    + " FROM context_rows",
    "context_statistics": _statistics(*_MODEL_CONTEXT),
    "training_batches": """
      SELECT row_number // 1024 AS batch_id, row_number, user_index, item_index, label FROM numbered_rows""",
    "batch_inspection": """
      SELECT row_number // 1024 AS batch_id, count(*) AS row_count, count(*) FILTER (label = 1) AS positive_count
      FROM ordered_rows GROUP BY 1""",
    "pair_similarity": f"""
      SELECT customer_id, article_id, {_round("list_inner_product(a.vec, b.vec)", 6)} AS similarity
      FROM positives JOIN vectors a ON a.vec_id = customer_id % (SELECT count(*) FROM vectors)
      JOIN vectors b ON b.vec_id = article_id % (SELECT count(*) FROM vectors)""",
    "l2_normalize": f"""
      SELECT vec_id, CAST(c.component AS INTEGER) AS component,
        {_round("v[CAST(c.component + 1 AS INTEGER)] / norm", 6)} AS value
      FROM (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm
            FROM (SELECT vec_id, list_transform(vec, lambda x: x + label) AS v FROM vectors)),
        (SELECT unnest(range(64)) AS component) c""",
    "vector_norms": f"SELECT vec_id, {_round('sqrt(list_inner_product(vec, vec))', 6)} AS norm FROM vectors",
    "encode_users": _components("user_vectors", "customer_id, user_index"),
    "encode_items": _components("item_vectors", "article_id, item_index"),
    "encode_items_no_context": _components("plain_item_vectors", "article_id, item_index"),
    "encode_customers_detail": f"""
      SELECT customer_id, u.user_index IS NOT NULL AS found, u.user_index, customer_total_purchases,
        {_round("customer_avg_price")} AS customer_avg_price,
        {_round("ln(1 + customer_total_purchases)")} AS log_customer_total_purchases,
        {_round("ln(1 + customer_avg_price)")} AS log_customer_avg_price,
        {_round("sqrt(list_inner_product(v, v))")} AS norm
      FROM (SELECT DISTINCT customer_id FROM lookups) LEFT JOIN served_users u USING (customer_id)
      LEFT JOIN user_vectors USING (customer_id)""",
    "pair_scores": f"SELECT user_index, item_index, label, {_round('score', 6)} AS score FROM scored_pairs",
    "bce_loss": f"""
      SELECT count(*) AS example_count,
        {_round("avg(greatest(score, 0) - score * label + ln(1 + exp(-abs(score))))")} AS mean_loss FROM scored_pairs""",
    "item_topk": "SELECT * FROM vector_top_ten",
    "item_topk_blocks": "SELECT * FROM vector_top_ten",
    "item_to_item_topk": """
      SELECT query_id, min(rank) FILTER (article_id = query_id) AS self_rank,
        max(similarity) FILTER (article_id = query_id) AS self_similarity, max(similarity) AS best_similarity,
        count(*) AS result_count FROM vector_top_ten GROUP BY 1""",
    "recommend_topk": "SELECT * FROM top_ten",
    "recommend_requests": """
      SELECT request_id, c.customer_id, top_k, CAST(status AS INTEGER) AS status, rank, article_id, item_index, similarity
      FROM checked c LEFT JOIN top_hundred t
        ON c.status = 200 AND c.customer_id = CAST(t.customer_id AS VARCHAR) AND t.rank <= c.top_k""",
    "recall_at_k": f"""
      SELECT count(*) AS user_count, count(*) FILTER (hit) AS hit_count,
        {_round("CAST(count(*) FILTER (hit) AS DOUBLE) / count(*)", 6)} AS recall
      FROM (SELECT t.customer_id, EXISTS (SELECT 1 FROM top_ten r
              WHERE r.customer_id = t.customer_id AND r.article_id = t.article_id) AS hit
            FROM (SELECT customer_id, article_id FROM split_rows WHERE split = 'test'
                  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, article_id DESC) = 1) t)""",
    "rec_store_put": "SELECT key, payload, created_at, expires_at FROM payloads",
    "rec_store_get": """
      SELECT c.customer_id, 'recommendations:user_' || c.customer_id AS key, p.position, p.item_index
      FROM customers c LEFT JOIN (
        SELECT customer_id, CAST(unnest(range(len(items))) AS INTEGER) AS position, unnest(items) AS item_index
        FROM live_entries) p USING (customer_id)""",
    "index_quality": "SELECT * FROM index_checks",
    "embedding_contract": """
      SELECT 'embedding count matches mapping' AS check_name,
        count(*) = (SELECT count(*) FROM items) AND count(item_index) = count(*) AS passed
        FROM item_vectors LEFT JOIN items USING (article_id, item_index)
      UNION ALL SELECT 'stored count matches', count(*) = (SELECT count(*) FROM item_vectors) FROM item_vectors
      UNION ALL SELECT 'vector size matches', count(*) FILTER (len(v) = 64) = count(*) FROM item_vectors
      UNION ALL SELECT 'vectors are finite',
        count(*) FILTER (len(list_filter(v, lambda x: isfinite(x))) = 64) = count(*) FROM item_vectors
      UNION ALL SELECT 'vectors have unit length',
        count(*) FILTER (abs(sqrt(list_inner_product(v, v)) - 1) <= 1e-5) = count(*) FROM item_vectors
      UNION ALL SELECT 'stored vectors match', count(*) = (SELECT count(*) FROM item_vectors)
        FROM item_vectors a JOIN item_vectors b USING (article_id) WHERE a.v = b.v""",
    "context_quality": "SELECT * FROM context_checks",
    "recommendation_quality": """
      SELECT 'some list was produced' AS check_name, count(*) > 0 AS passed FROM top_ten
      UNION ALL SELECT 'every list has the expected length', min(n) = 10 AND max(n) = 10
        FROM (SELECT count(*) AS n FROM top_ten GROUP BY customer_id)
      UNION ALL SELECT 'articles of a list are distinct', bool_and(n = u)
        FROM (SELECT count(*) AS n, count(DISTINCT article_id) AS u FROM top_ten GROUP BY customer_id)
      UNION ALL SELECT 'scores are finite', bool_and(isfinite(similarity)) FROM top_ten""",
    "quality_verdict": """
      SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS failed_checks
      FROM (SELECT * FROM index_checks UNION ALL SELECT * FROM context_checks)""",
    "stream_user_context": f"""
      SELECT user_id AS customer_id, count(value) AS customer_total_purchases,
        {_round("sum(value) / count(value)")} AS customer_avg_price
      FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL AND value IS NOT NULL GROUP BY 1""",
    "stream_item_context": f"""
      SELECT l_partkey AS article_id, count(l_extendedprice) AS item_total_purchases,
        {_round("sum(l_extendedprice) / count(l_extendedprice)")} AS item_avg_price
      FROM lineitem WHERE l_partkey IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1""",
}


_QUERIES["stream_clean_transactions"] = _QUERIES["clean_transactions"]
_QUERIES["two_tower_dataset_bucketed"] = _QUERIES["two_tower_dataset"]
_QUERIES["rec_store_log_get"] = _QUERIES["stream_rec_store"] = _QUERIES["rec_store_get"]


def _needed(sql: str) -> list[str]:
    """Names of the expressions ``sql`` uses, dependencies first."""
    found: list[str] = []
    for name in _CTES:
        if re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", sql):
            for inner in [*_needed(_CTES[name]), name]:
                if inner not in found:
                    found.append(inner)
    return found


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, sql in _QUERIES.items():
        parts = [f"{cte} AS MATERIALIZED ({_CTES[cte].strip()})" for cte in _needed(sql)]
        result[name] = (f"WITH {', '.join(parts)} " if parts else "") + sql.strip()
    return result
