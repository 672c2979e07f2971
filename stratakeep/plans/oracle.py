"""The registered queries in SQL, for an independent check.

Written from the definition of each result, with plain window functions and
joins over whole tables.
"""

from __future__ import annotations

_SAT_ACTIVITY = """
    SELECT cast(user_id AS varchar) AS _id, event_type, md5(cast(user_id AS varchar)) AS user_hash_key,
           md5(cast(user_id AS varchar) || '|' || event_type) AS hash_diff,
           ts AS loaded_at, 'events' AS record_source
    FROM events"""

_LINES = """
    SELECT cast(user_id AS varchar) AS cart_id, event_type AS product_id,
           cast(user_id AS varchar) || '|' || event_type AS id,
           cast(json_extract_string(props, '$.k') AS bigint) AS quantity,
           ts AS added_at_ts, CASE WHEN value < 5 THEN ts END AS removed_at_ts
    FROM events"""

_ADDS_AND_DROPS = f"""
    SELECT id, cart_id, product_id,
           CASE WHEN removed_at_ts IS NULL AND quantity > before THEN quantity - before ELSE 0 END AS quantity_added,
           CASE WHEN removed_at_ts IS NOT NULL THEN quantity
                WHEN quantity < before THEN before - quantity ELSE 0 END AS quantity_dropped,
           coalesce(removed_at_ts, added_at_ts) AS event_time
    FROM (SELECT *, coalesce(lag(quantity) OVER (PARTITION BY id ORDER BY added_at_ts), 0) AS before FROM ({_LINES}))
    WHERE quantity <> before OR removed_at_ts IS NOT NULL"""

_EMAILS = """
    SELECT cast(user_id AS varchar) AS customer_id, cast(user_id AS varchar) || '-' || event_type AS email_id,
           cast(user_id AS varchar) || '@' || event_type || '.example' AS email, value > 50 AS is_primary, ts
    FROM events"""

_LANDED = """
    SELECT '{' || CASE WHEN value <= 200 THEN '"_id":"' || user_id || '",' ELSE '' END
           || '"event_id":' || event_id || ',"event_type":"' || event_type
           || '","quantity":' || json_extract_string(props, '$.k')
           || ',"created_at":{"$date":' || (epoch_us(ts) // 1000) || '}}' AS line,
           event_id, value
    FROM events"""

_POINTS = """
    SELECT md5(cast(user_id AS varchar)) AS customer_hash_key, ts AS loaded_at, ts AS seen_at,
           cast(NULL AS timestamp) AS bought_at
    FROM events WHERE event_type <> 'purchase'
    UNION ALL
    SELECT md5(cast(user_id AS varchar)), cast(date_trunc('day', ts) AS timestamp), NULL,
           cast(date_trunc('day', ts) AS timestamp)
    FROM events WHERE event_type = 'purchase'"""

_PIT = f"""
    SELECT DISTINCT customer_hash_key, loaded_at,
           max(seen_at) OVER w AS sat_seen_loaded_at, max(bought_at) OVER w AS sat_bought_loaded_at
    FROM ({_POINTS})
    WINDOW w AS (PARTITION BY customer_hash_key ORDER BY loaded_at
                 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORACLE: dict[str, str] = {
    "hub_customer": """
        SELECT DISTINCT md5(cast(c_custkey AS varchar)) AS customer_hash_key,
               cast(c_custkey AS varchar) AS customer_internal_application_id,
               'app_customer_collection' AS record_source, TIMESTAMP '2024-02-01 00:00:00' AS created_at
        FROM customer WHERE c_custkey IS NOT NULL""",
    "hub_incremental": """
        SELECT md5(cast(o_custkey AS varchar)) AS customer_hash_key,
               cast(o_custkey AS varchar) AS customer_internal_application_id,
               'app_cart_collection' AS record_source,
               CASE WHEN min(o_orderdate) < TIMESTAMP '1995-07-01 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
                    ELSE TIMESTAMP '2024-02-02 00:00:00' END AS created_at
        FROM orders GROUP BY o_custkey""",
    "link_order_product": """
        SELECT DISTINCT md5(cast(l_orderkey AS varchar)) AS order_hash_key,
               md5(cast(l_partkey AS varchar)) AS product_hash_key,
               md5(cast(l_orderkey AS varchar) || '|' || cast(l_partkey AS varchar)) AS order_product_hash_key,
               TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, 'app_cart_item_collection' AS record_source
        FROM lineitem""",
    "link_incremental": """
        SELECT md5(cast(user_id AS varchar)) AS user_hash_key, md5(k) AS item_hash_key,
               md5(cast(user_id AS varchar) || '|' || k) AS user_item_hash_key,
               CASE WHEN min(ts) < TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
                    ELSE TIMESTAMP '2024-02-02 00:00:00' END AS loaded_at, 'events' AS record_source
        FROM (SELECT user_id, json_extract_string(props, '$.k') AS k, ts FROM events)
        GROUP BY user_id, k""",
    "sat_hash_diff": """
        SELECT event_id, md5(cast(user_id AS varchar)) AS user_hash_key,
               md5(cast(user_id AS varchar) || '|' || event_type || '|' || cast(value > 50 AS varchar) || '|'
                   || coalesce(CASE WHEN value >= 5 THEN json_extract_string(props, '$.k') END, ' ') || '|'
                   || cast(ts AS varchar) || '|' || cast(cast(value AS decimal(18, 2)) AS varchar)) AS hash_diff
        FROM events""",
    "sat_customer": """
        WITH versions AS (SELECT cast(o_custkey AS varchar) AS _id, o_orderstatus AS state, o_orderkey FROM orders),
        compared AS (SELECT *, lag(state) OVER (PARTITION BY _id ORDER BY o_orderkey) AS before FROM versions)
        SELECT _id, state, o_orderkey, md5(_id || '|' || state) AS hash_diff, md5(_id) AS customer_hash_key,
               TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, 'app_customer_collection' AS record_source
        FROM compared WHERE before IS NULL OR before <> state""",
    "sat_batch_delta": f"""
        WITH s AS ({_SAT_ACTIVITY}),
        known AS (SELECT user_hash_key, arg_max(hash_diff, loaded_at) AS hash_diff FROM s
                  WHERE loaded_at < TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_hash_key)
        SELECT DISTINCT s.* FROM s LEFT JOIN known USING (user_hash_key)
        WHERE s.loaded_at >= TIMESTAMP '2024-01-15 00:00:00'
          AND (known.hash_diff IS NULL OR known.hash_diff <> s.hash_diff)""",
    "sat_sequenced": f"""
        WITH s AS ({_SAT_ACTIVITY})
        SELECT _id, event_type, hash_diff, user_hash_key, loaded_at, record_source
        FROM (SELECT *, lag(hash_diff) OVER (PARTITION BY user_hash_key ORDER BY loaded_at) AS before FROM s)
        WHERE before IS NULL OR before <> hash_diff""",
    "sat_event": f"""
        WITH e AS ({_ADDS_AND_DROPS})
        SELECT id AS cart_id_product_id_combined, quantity_added, quantity_dropped, event_time,
               md5(id || '|' || cast(event_time AS varchar) || '|' || cast(quantity_added AS varchar) || '|'
                   || cast(quantity_dropped AS varchar)) AS hash_diff,
               md5(id) AS cart_product_hash_key,
               CASE WHEN event_time < TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
                    ELSE TIMESTAMP '2024-02-02 00:00:00' END AS loaded_at,
               'sat_cart_product' AS record_source
        FROM (SELECT DISTINCT * FROM e)""",
    "sat_link": f"""
        WITH l AS (SELECT *, md5(cart_id || '|' || id || '|' || product_id || '|' || cast(quantity AS varchar))
                          AS hash_diff FROM ({_LINES}))
        SELECT cart_id, product_id, quantity, id AS cart_id_product_id_combined, added_at_ts, hash_diff,
               md5(id) AS cart_product_hash_key, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at,
               'app_cart_item_collection' AS record_source
        FROM (SELECT *, lag(hash_diff) OVER (PARTITION BY id ORDER BY added_at_ts) AS before FROM l)
        WHERE before IS NULL OR before <> hash_diff""",
    "latest_per_key": f"""
        WITH s AS ({_SAT_ACTIVITY})
        SELECT * FROM s WHERE (user_hash_key, loaded_at) IN
               (SELECT (user_hash_key, max(loaded_at)) FROM s GROUP BY user_hash_key)""",
    "pit_customer": _PIT,
    "unix_time": """
        SELECT event_id, date_trunc('millisecond', ts) AS created_at_ts,
               CASE WHEN value > 50 THEN date_trunc('millisecond', ts) END AS updated_at_ts
        FROM events""",
    "unix_time_legacy": """
        SELECT event_id,
               cast(TIMESTAMP '1970-01-01' + to_seconds(seconds) AS date) AS created_at_ts,
               CASE WHEN value > 50 THEN cast(TIMESTAMP '1970-01-01' + to_seconds(seconds) AS date) END AS updated_at_ts
        FROM (SELECT *, (epoch_us(ts) // 1000) - 1562173938000 AS seconds FROM events)""",
    "ingest_json": """
        SELECT cast(user_id AS varchar) AS _id, event_id, event_type,
               cast(json_extract_string(props, '$.k') AS bigint) AS quantity,
               date_trunc('millisecond', ts) AS created_at_ts
        FROM events WHERE value >= 5 AND value <= 200""",
    "ingest_rejects": f"""
        SELECT 'not parsed' AS reject_reason, left(line, length(line) - 4) AS _corrupt_record,
               cast(NULL AS bigint) AS event_id
        FROM ({_LANDED}) WHERE value < 5
        UNION ALL
        SELECT 'null _id', NULL, event_id FROM ({_LANDED}) WHERE value > 200""",
    "email_explode": """
        SELECT cast(user_id AS varchar) AS customer_id, event_id, cast(user_id AS varchar) || '-' || event_type AS _id,
               cast(user_id AS varchar) || '@' || event_type || '.example' AS email, value > 50 AS is_primary
        FROM events WHERE value >= 5
        UNION ALL
        SELECT cast(user_id AS varchar), event_id, cast(user_id AS varchar) || '-spare',
               cast(user_id AS varchar) || '@spare.example', false
        FROM events WHERE value > 100""",
    "primary_email": f"""
        WITH e AS ({_EMAILS}),
        latest AS (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY ts DESC) AS n FROM e),
        owned AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC) AS m
                  FROM latest WHERE n = 1 AND is_primary)
        SELECT customer_id AS customer_internal_application_id, email AS primary_email FROM owned WHERE m = 1""",
    "primary_email_legacy": f"""
        WITH e AS ({_EMAILS})
        SELECT customer_id AS customer_internal_application_id, email AS primary_email
        FROM (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY ts DESC) AS n FROM e WHERE is_primary)
        WHERE n = 1""",
    "cart_adds_drops": f"""
        SELECT id AS cart_id_product_id_combined, quantity_added, quantity_dropped, event_time
        FROM ({_ADDS_AND_DROPS})""",
    "dim_product": """
        WITH changed AS (
            SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
        sat AS (
            SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
            FROM changed WHERE before IS NULL OR before <> event_type)
        SELECT md5(cast(c_custkey AS varchar)) AS product_hash_key, ts AS valid_from, valid_to, event_type AS title,
               upper(event_type) AS product_type, cast(user_id AS varchar) || ' ' || event_type AS description,
               cast(NULL AS varchar) AS vendor, cast(user_id AS varchar) AS store_id,
               cast(json_extract_string(props, '$.k') AS bigint) AS inventory,
               cast(cast(value AS decimal(18, 2)) * 100 AS bigint) AS sale_price_in_cents,
               cast(date_trunc('month', ts) AS timestamp) AS created_at_ts, ts AS updated_at_ts
        FROM customer LEFT JOIN sat ON c_custkey = user_id""",
    "dim_customer_history": f"""
        WITH pit AS ({_PIT}),
        spans AS (SELECT *, lead(loaded_at) OVER (PARTITION BY customer_hash_key ORDER BY loaded_at) AS valid_to
                  FROM pit),
        hub AS (SELECT DISTINCT md5(cast(c_custkey AS varchar)) AS customer_hash_key FROM customer),
        email AS (
            SELECT md5(cast(user_id AS varchar)) AS customer_hash_key,
                   cast(date_trunc('day', ts) AS timestamp) AS loaded_at,
                   arg_max(cast(user_id AS varchar) || '@' || cast(event_id AS varchar), ts) AS primary_email
            FROM events WHERE event_type = 'purchase' GROUP BY ALL),
        seen AS (SELECT *, md5(cast(user_id AS varchar)) AS customer_hash_key
                 FROM events WHERE event_type <> 'purchase')
        SELECT p.customer_hash_key, p.loaded_at AS valid_from, p.valid_to, e.primary_email,
               s.event_type AS currency, cast(s.user_id AS varchar) AS first_name,
               cast(s.event_id AS varchar) AS last_name, cast(s.value AS decimal(18, 2)) AS total_spent,
               s.ts AS last_cart_activity_at_ts,
               cast(date_trunc('day', s.ts) AS timestamp) AS last_cart_created_at_ts,
               cast(NULL AS timestamp) AS log_out_expires_at_ts,
               cast(date_trunc('month', s.ts) AS timestamp) AS confirmed_on_ts,
               CASE WHEN s.value > 50 THEN s.ts END AS confirmation_token_expires_at_ts,
               cast(date_trunc('hour', s.ts) AS timestamp) AS created_at_ts, s.ts AS updated_at_ts
        FROM spans p JOIN hub h ON p.customer_hash_key = h.customer_hash_key
        LEFT JOIN email e ON p.customer_hash_key = e.customer_hash_key AND p.sat_bought_loaded_at = e.loaded_at
        LEFT JOIN seen s ON p.customer_hash_key = s.customer_hash_key AND p.sat_seen_loaded_at = s.ts""",
    "fact_adds_drops": f"""
        SELECT md5(product_id) AS product_hash_key, md5('owner ' || left(cart_id, 1)) AS customer_hash_key,
               quantity_added, quantity_dropped, event_time
        FROM ({_ADDS_AND_DROPS})""",
    "job_rerun": """
        SELECT md5(cast(p_partkey AS varchar)) AS product_hash_key,
               cast(cast(p_retailprice AS decimal(18, 2)) * 100 AS bigint) + CASE WHEN day = 2 THEN 100 ELSE 0 END
                   AS sale_price_in_cents,
               TIMESTAMP '2024-02-01 00:00:00' + to_days(cast(day - 1 AS integer)) AS loaded_at
        FROM part, unnest([1, 2, 3]) AS days(day)""",
    "job_products": """
        WITH base AS (
            SELECT md5(cast(p_partkey AS varchar)) AS product_hash_key, *,
                   cast(cast(p_retailprice AS decimal(18, 2)) * 100 AS bigint) AS cents FROM part),
        versions AS (
            SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS valid_from,
                   CASE WHEN p_size > 25 THEN TIMESTAMP '2024-02-02 00:00:00' END AS valid_to FROM base
            UNION ALL
            SELECT * REPLACE (cents + 100 AS cents), TIMESTAMP '2024-02-02 00:00:00', NULL FROM base WHERE p_size > 25)
        SELECT product_hash_key, valid_from, valid_to, p_name AS title, p_type AS product_type,
               cast(NULL AS varchar) AS description, p_brand AS vendor, cast(NULL AS varchar) AS store_id,
               cast(p_size AS bigint) AS inventory, cents AS sale_price_in_cents,
               TIMESTAMP '2024-01-01 00:00:00' AS created_at_ts, cast(NULL AS timestamp) AS updated_at_ts
        FROM versions""",
    "job_customers": """
        WITH spans AS (
            SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS valid_from, '-1@example' AS mail,
                   CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2024-02-02 00:00:00' END AS valid_to FROM customer
            UNION ALL
            SELECT *, TIMESTAMP '2024-02-02 00:00:00', '-2@example', NULL FROM customer WHERE c_acctbal > 0)
        SELECT md5(cast(c_custkey AS varchar)) AS customer_hash_key, valid_from, valid_to,
               cast(c_custkey AS varchar) || mail AS primary_email, c_mktsegment AS currency, c_name AS first_name,
               cast(NULL AS varchar) AS last_name, cast(c_acctbal AS decimal(18, 2)) AS total_spent,
               cast(NULL AS timestamp) AS last_cart_activity_at_ts, cast(NULL AS timestamp) AS last_cart_created_at_ts,
               cast(NULL AS timestamp) AS log_out_expires_at_ts, cast(NULL AS timestamp) AS confirmed_on_ts,
               cast(NULL AS timestamp) AS confirmation_token_expires_at_ts,
               TIMESTAMP '2024-01-01 00:00:00' AS created_at_ts, cast(NULL AS timestamp) AS updated_at_ts
        FROM spans""",
    "job_carts": """
        WITH lines AS (
            SELECT DISTINCT l_orderkey, l_partkey, cast(l_quantity AS bigint) AS quantity, l_shipdate,
                   l_returnflag = 'R' AS removed FROM lineitem),
        deltas AS (
            SELECT *, coalesce(lag(quantity) OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate), 0) AS before
            FROM lines)
        SELECT md5(cast(l_partkey AS varchar)) AS product_hash_key,
               md5(cast(o_custkey AS varchar)) AS customer_hash_key,
               CASE WHEN NOT removed AND quantity > before THEN quantity - before ELSE 0 END AS quantity_added,
               CASE WHEN removed THEN quantity WHEN quantity < before THEN before - quantity ELSE 0 END
                   AS quantity_dropped,
               l_shipdate AS event_time
        FROM deltas JOIN orders ON l_orderkey = o_orderkey
        WHERE quantity <> before OR removed""",
    "job_late_products": """
        WITH versions AS (
            SELECT 'first' AS known_at, unnest([1, 3]) AS day, * FROM part
            UNION ALL
            SELECT 'second', unnest([1, 2, 3]), * FROM part),
        timed AS (SELECT *, TIMESTAMP '2023-12-31 00:00:00' + to_days(cast(day AS integer)) AS valid_from FROM versions)
        SELECT known_at, md5(cast(p_partkey AS varchar)) AS product_hash_key, valid_from,
               lead(valid_from) OVER (PARTITION BY known_at, p_partkey ORDER BY day) AS valid_to,
               cast(cast(p_retailprice AS decimal(18, 2)) * 100 AS bigint) + 100 * day AS sale_price_in_cents
        FROM timed""",
    "stream_parts": """
        WITH priced AS (
            SELECT *, cast(cast(p_retailprice AS decimal(18, 2)) * 100 AS bigint) AS cents FROM part)
        SELECT md5(cast(p_partkey AS varchar)) AS product_hash_key, cents AS sale_price_in_cents, 1 AS day FROM priced
        UNION ALL
        SELECT md5(cast(p_partkey AS varchar)), cents + 100, 2 FROM priced WHERE p_size > 25""",
}

# Loads out of order give what loads in order give.
ORACLE["job_late_items"] = ORACLE["job_carts"]
