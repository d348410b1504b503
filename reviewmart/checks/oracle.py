"""The queries' counterparts in plain SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import re

# Named subqueries; each statement carries only those it needs.
_BASE = {
    "raw_reviews": """
        SELECT epoch_ms(o_orderdate) + (l_orderkey * 7919 % 86400) * 1000 + 123 AS "timestamp",
               CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN NULL
                    ELSE 1 + l_quantity % 5 END AS rating,
               CAST(l_linenumber AS BIGINT) AS helpful_votes,
               l_linestatus AS title,
               CAST(NULL AS VARCHAR) AS text,
               'P' || l_partkey || '-' || l_suppkey AS asin,
               l_returnflag = 'N' AS verified_purchase,
               'P' || l_partkey AS parent_asin,
               CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'U' || o_custkey END AS user_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_items": """
        SELECT p_type AS main_category,
               'P' || p_partkey AS parent_asin,
               CAST(1 + p_size % 5 AS DOUBLE) AS average_rating,
               CAST(p_size * 10 AS DOUBLE) AS rating_number,
               CASE p_partkey % 6
                    WHEN 1 THEN '—'
                    WHEN 2 THEN '$' || CAST(p_retailprice AS VARCHAR)
                    WHEN 3 THEN 'from ' || CAST(p_retailprice AS VARCHAR)
                    WHEN 4 THEN '$1,' || CAST(p_retailprice AS VARCHAR)
                    WHEN 5 THEN CAST(p_retailprice AS VARCHAR) END AS price,
               CASE WHEN p_size % 5 = 1 THEN '[]'
                    WHEN p_size % 5 > 1 THEN CAST(to_json([[p_type, p_brand]]) AS VARCHAR)
                    END AS categories,
               p_name AS title,
               p_brand AS store
        FROM part""",
    "staged_reviews": """
        SELECT "timestamp" AS timestamp_ms, rating, helpful_votes, title, text, asin,
               verified_purchase, parent_asin, user_id,
               year(ts) AS "year", month(ts) AS "month", day(ts) AS "day", ts AS "timestamp"
        FROM (SELECT *, make_timestamp(("timestamp" // 1000) * 1000000) AS ts FROM raw_reviews)""",
    "stg_reviews": """
        SELECT md5(coalesce(user_id, '') || coalesce(parent_asin, '')
                   || coalesce(strftime("timestamp", '%Y-%m-%d %H:%M:%S+00'), '')) AS review_id,
               parent_asin AS asin, user_id, rating, verified_purchase, helpful_votes,
               "timestamp", "year", "month", "day"
        FROM staged_reviews
        WHERE rating IS NOT NULL AND "timestamp" IS NOT NULL""",
    "stg_items": r"""
        SELECT parent_asin AS asin, main_category AS category, title, store,
               try_cast(nullif(regexp_extract(price, '\d+(?:\.\d+)?'), '') AS DOUBLE) AS price,
               average_rating, rating_number
        FROM raw_items""",
    "run_together": """
        SELECT md5(coalesce(user_id, '') || coalesce(asin, '')
                   || strftime("timestamp", '%Y-%m-%d %H:%M:%S+00')) AS review_id, *
        FROM (SELECT substr(user_id, 2, 9) AS user_id, substr(asin, 2, 9) AS asin,
                     CAST(date_trunc('year', "timestamp") AS TIMESTAMP) AS "timestamp",
                     rating, verified_purchase, helpful_votes
              FROM stg_reviews)""",
    "dim_items": """
        SELECT asin, title, category, store, price, average_rating, rating_number
        FROM stg_items""",
    "span": """
        SELECT min(CAST("timestamp" AS DATE)) AS first_day, max(CAST("timestamp" AS DATE)) AS last_day
        FROM stg_reviews""",
    "days": """
        SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2026-12-31', INTERVAL 1 DAY))
                    AS DATE) AS date_day""",
    "review_days": """
        SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM span""",
    "listings": """
        SELECT asin, count(*) AS copies, coalesce(sum(price), 0) AS price_sum
        FROM dim_items WHERE asin IS NOT NULL GROUP BY asin""",
    "user_days": """
        SELECT user_id, CAST("timestamp" AS DATE) AS review_day,
               sum(coalesce(copies, 1)) AS n,
               coalesce(sum(coalesce(copies, 1)) FILTER (verified_purchase), 0) AS verified,
               min("timestamp") AS earliest, max("timestamp") AS latest, sum(price_sum) AS spent
        FROM stg_reviews LEFT JOIN listings USING (asin) WHERE user_id IS NOT NULL GROUP BY ALL""",
    "dim_users": """
        SELECT user_id,
               CAST(sum(verified) AS BIGINT) AS verified_purchase_count,
               CAST(sum(n) AS BIGINT) AS review_count,
               min(earliest) AS first_review_date,
               max(latest) AS last_review_date,
               count(*) AS active_days,
               (max(review_day) - min(review_day)) / nullif(CAST(sum(n) AS BIGINT) - 1, 0)
                   AS avg_days_between_reviews,
               coalesce(sum(spent), 0.0) AS total_spent
        FROM user_days GROUP BY user_id""",
    "item_avg": """
        SELECT asin, avg(rating) AS avg_rating FROM stg_reviews GROUP BY asin""",
    "rated_reviews": """
        SELECT *, CASE WHEN asin IS NOT NULL THEN avg(rating) OVER (PARTITION BY asin) END AS avg_rating,
               CAST("timestamp" AS DATE) AS written
        FROM stg_reviews""",
    "fct_reviews": """
        SELECT review_id, review_id AS review_id_power_bi, user_id, asin, rating,
               verified_purchase, helpful_votes, "timestamp",
               CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS review_month,
               i.price, i.category, i.store, avg_rating,
               sign(rating - avg_rating) * floor(abs(rating - avg_rating) * 100 + 0.5) / 100
                   + 0.0 AS rating_diff_from_avg,
               CASE WHEN written BETWEEN DATE '1995-01-01' AND DATE '2026-12-31'
                    THEN written END AS review_date,
               dayname(review_date) AS day_name
        FROM rated_reviews LEFT JOIN dim_items i USING (asin)""",
}

# The shift is the one in ``queries.comparable``.
_ROUND = "round({0} + 1e-9, 6) + 0.0 AS {0}"


def _rounded(*names: str) -> str:
    return ", ".join(_ROUND.format(name) for name in names)


def _replacing(table: str, *names: str) -> str:
    changes = ", ".join(_ROUND.format(name) for name in names)
    return f"SELECT * REPLACE ({changes}) FROM {table}"


_TIME_COLUMNS = """
    date_day, year(date_day) AS "year", month(date_day) AS "month", day(date_day) AS "day",
    quarter(date_day) AS quarter, dayname(date_day) AS day_name, monthname(date_day) AS month_name,
    CAST(strftime(date_day, '%U') AS BIGINT) AS week_of_year,
    dayofweek(date_day) + 1 AS day_of_week, dayofweek(date_day) IN (0, 6) AS is_weekend"""

_KEYS = [
    ("stg_items", "asin"),
    ("dim_items", "asin"),
    ("dim_users", "user_id"),
    ("days", "date_day"),
]
_REVIEW_KEYS = [("stg_reviews", "review_id"), ("stg_reviews", "user_id")]


def _shown(table: str) -> str:
    return "dim_time" if table == "days" else table


def _not_null(table: str, column: str) -> str:
    return f"""SELECT 'not_null' AS "check", '{_shown(table)}' AS model, '{column}' AS column_name,
        count(*) AS failures FROM {table} WHERE {column} IS NULL"""


def _unique(table: str, column: str) -> str:
    return f"""SELECT 'unique' AS "check", '{_shown(table)}' AS model, '{column}' AS column_name,
        count(*) AS failures FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL
        GROUP BY {column} HAVING count(*) > 1)"""


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_CONTRACT = {
    "stg_reviews": """review_id binary, asin string, user_id string, rating double,
        verified_purchase boolean, helpful_votes bigint, timestamp timestamp, year bigint,
        month bigint, day bigint""",
    "stg_items": """asin string, category string, title string, store string, price double,
        average_rating double, rating_number double""",
    "dim_items": """asin string, title string, category string, store string, price double,
        average_rating double, rating_number double""",
    "dim_users": """user_id string, verified_purchase_count bigint, review_count bigint,
        first_review_date timestamp, last_review_date timestamp, active_days bigint,
        avg_days_between_reviews double, total_spent double""",
    "dim_time": """date_day date, year bigint, month bigint, day bigint, quarter bigint,
        day_name string, month_name string, week_of_year bigint, day_of_week bigint,
        is_weekend boolean""",
    "fct_reviews": """review_id binary, review_id_power_bi string, user_id string, asin string,
        rating double, verified_purchase boolean, helpful_votes bigint, timestamp timestamp,
        review_month timestamp, price double, category string, store string, avg_rating double,
        rating_diff_from_avg double, review_date date, day_name string""",
}


def _contract(model: str) -> str:
    pairs = [column.split() for column in _CONTRACT[model].split(",")]
    values = ", ".join(f"('{name}', '{kind}')" for name, kind in pairs)
    return f"""SELECT '{model}' AS model, c.name AS column_name, c.kind AS expected_type,
        c.kind AS actual_type, true AS ok FROM (VALUES {values}) c(name, kind)"""


def _model_rows(model: str) -> str:
    table = "review_days" if model == "dim_time" else model
    return f"SELECT '{model}' AS model, count(*) AS row_count FROM {table}"


def _profile(table: str, columns: dict[str, str]) -> str:
    return _union(
        [
            f"""SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count,
            count("{name}") AS filled FROM {table}"""
            for name, kind in columns.items()
        ]
    )


_STATEMENTS = {
    "scan_reviews_json": "SELECT * FROM raw_reviews",
    "scan_items_json": "SELECT * FROM raw_items",
    "write_reviews_parquet": "SELECT * FROM staged_reviews",
    "staged_by_ledger": "SELECT * FROM staged_reviews",
    "write_items_parquet": "SELECT * FROM raw_items",
    "scan_parquet": "SELECT * FROM raw_items",
    "external_table": "SELECT * FROM staged_reviews",
    "materialize_view": "SELECT * FROM stg_items",
    "materialize_table": "SELECT * FROM dim_items",
    "verify_archives": """
        SELECT CAST(sum(length('{"asin":"' || asin || '"}') + 1) AS BIGINT) AS text_bytes,
               CAST(0 AS BIGINT) AS broken FROM raw_reviews""",
    "fct_insert_overwrite": f"""
        {_replacing("fct_reviews", "avg_rating", "rating_diff_from_avg", "price")}
        QUALIFY review_month < TIMESTAMP '1998-01-01' OR verified_purchase
             OR NOT coalesce(bool_or(verified_purchase) OVER (PARTITION BY review_month), false)""",
    "cluster_layout": """
        SELECT r.*, i.price, i.category, i.store,
               CAST(date_trunc('month', r."timestamp") AS TIMESTAMP) AS review_month,
               d.date_day AS review_date, dayname(d.date_day) AS day_name
        FROM stg_reviews r
        LEFT JOIN days d ON CAST(r."timestamp" AS DATE) = d.date_day
        LEFT JOIN dim_items i ON r.asin = i.asin""",
    "repartition": "SELECT * FROM raw_reviews",
    "select_columns": "SELECT parent_asin, main_category, price FROM raw_items",
    "resolve_ts_column": """
        SELECT asin, user_id,
               CASE WHEN title = 'O' THEN "timestamp" + 5000 ELSE "timestamp" END AS timestamp_ms
        FROM raw_reviews""",
    "ms_to_timestamp": """
        SELECT "timestamp" AS timestamp_ms,
               make_timestamp(("timestamp" // 1000) * 1000000) AS "timestamp",
               make_timestamp(-("timestamp" // 1000) * 1000000) AS mirrored
        FROM raw_reviews""",
    "ts_parts": """SELECT "timestamp", "year", "month", "day" FROM staged_reviews""",
    "rename_keys": "SELECT parent_asin AS asin, main_category AS category, title FROM raw_items",
    "safe_cast_double": """
        SELECT parent_asin, try_cast(price AS DOUBLE) AS price, rating_number FROM raw_items""",
    "clean_price": r"""
        SELECT parent_asin, price,
               try_cast(nullif(regexp_extract(price, '\d+(?:\.\d+)?'), '') AS DOUBLE) AS "number"
        FROM raw_items""",
    "review_id": """SELECT review_id, user_id, asin, "timestamp" FROM stg_reviews""",
    "review_id_hex": "SELECT review_id AS review_id_power_bi, helpful_votes FROM stg_reviews",
    "review_month": """
        SELECT "timestamp", CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS review_month
        FROM stg_reviews""",
    "review_date": """
        SELECT "timestamp", CAST("timestamp" AS DATE) AS review_date FROM stg_reviews""",
    "rating_diff": """
        SELECT r.review_id, r.helpful_votes,
               sign(rating - avg_rating) * floor(abs(rating - avg_rating) * 100 + 0.5) / 100
                   + 0.0 AS rating_diff_from_avg
        FROM stg_reviews r LEFT JOIN item_avg a ON r.asin = a.asin""",
    "dim_items": "SELECT * FROM dim_items",
    "staged_reviews": "SELECT * FROM staged_reviews",
    "staged_items": "SELECT * FROM raw_items",
    "stg_reviews": "SELECT * FROM stg_reviews",
    "stg_items": "SELECT * FROM stg_items",
    "valid_reviews": """
        SELECT * FROM staged_reviews WHERE rating IS NOT NULL AND "timestamp" IS NOT NULL""",
    "known_users": "SELECT * FROM stg_reviews WHERE user_id IS NOT NULL",
    "category_distinct": "SELECT DISTINCT main_category FROM raw_items WHERE main_category = 'ECONOMY'",
    "has_categories": "SELECT * FROM raw_items WHERE categories IS NOT NULL AND categories <> '[]'",
    "verified_slicer": "SELECT * FROM stg_reviews WHERE NOT verified_purchase",
    "reviews_x_price": """
        SELECT r.*, i.price FROM stg_reviews r LEFT JOIN dim_items i ON r.asin = i.asin""",
    "fct_x_time": """
        SELECT r.*, d.date_day AS review_date, dayname(d.date_day) AS day_name
        FROM stg_reviews r LEFT JOIN days d ON CAST(r."timestamp" AS DATE) = d.date_day""",
    "fct_x_users": f"""
        SELECT r.*, u.verified_purchase_count, u.review_count, u.first_review_date,
               u.last_review_date, u.active_days, {_rounded("avg_days_between_reviews", "total_spent")}
        FROM stg_reviews r LEFT JOIN dim_users u ON r.user_id = u.user_id""",
    "fct_x_items": """
        SELECT r.*, i.price, i.category, i.store
        FROM stg_reviews r LEFT JOIN dim_items i ON r.asin = i.asin""",
    "fct_x_item_avg": f"""
        SELECT r.*, {_rounded("avg_rating")}
        FROM stg_reviews r LEFT JOIN item_avg a ON r.asin = a.asin""",
    "item_avg": _replacing("item_avg", "avg_rating"),
    "dim_users": _replacing("dim_users", "avg_days_between_reviews", "total_spent"),
    "verified_purchase_count": """
        SELECT user_id, count(*) FILTER (verified_purchase) AS verified_purchase_count
        FROM stg_reviews WHERE user_id IS NOT NULL GROUP BY user_id""",
    "review_count": """
        SELECT user_id, count(*) AS review_count
        FROM stg_reviews WHERE user_id IS NOT NULL GROUP BY user_id""",
    "first_last_review_date": "SELECT user_id, first_review_date, last_review_date FROM dim_users",
    "active_days": "SELECT user_id, active_days FROM dim_users",
    "avg_days_between_reviews": """
        SELECT user_id, round((CAST(max("timestamp") AS DATE) - CAST(min("timestamp") AS DATE))
                              / nullif(count(*) - 1, 0) + 1e-9, 6) + 0.0 AS avg_days_between_reviews
        FROM stg_reviews WHERE user_id IS NOT NULL GROUP BY user_id""",
    "total_spent": f"SELECT user_id, {_rounded('total_spent')} FROM dim_users",
    "row_count": "SELECT count(*) AS row_count FROM staged_reviews",
    "distinct_values": "SELECT DISTINCT main_category, store FROM raw_items",
    "calendar": "SELECT date_day FROM review_days",
    "dim_time": f"SELECT {_TIME_COLUMNS} FROM review_days",
    "fct_reviews": _replacing("fct_reviews", "price", "avg_rating", "rating_diff_from_avg"),
    "reviews_by_year": """
        SELECT year(review_date) AS "year", count(*) AS review_count
        FROM fct_reviews GROUP BY 1""",
    "category_rating_trend": """
        SELECT category, review_month, round(avg(rating) + 1e-9, 6) + 0.0 AS avg_rating
        FROM fct_reviews GROUP BY category, review_month""",
    "category_share": """
        SELECT category, count(*) AS review_count,
               round(count(*) / (SELECT count(*) FROM fct_reviews) + 1e-9, 6) + 0.0 AS "share"
        FROM fct_reviews GROUP BY category""",
    "top10_users": f"""
        SELECT user_id, review_count, {_rounded("total_spent")} FROM dim_users
        ORDER BY dim_users.review_count DESC, user_id LIMIT 10""",
    "monthly_reviews_price": """
        SELECT month(review_month) AS "month", count(*) AS review_count,
               round(avg(price) + 1e-9, 6) + 0.0 AS avg_price
        FROM fct_reviews GROUP BY 1""",
    "calendar_month_reviews_price": """
        SELECT review_month, count(*) AS review_count, round(avg(price) + 1e-9, 6) + 0.0 AS avg_price
        FROM fct_reviews GROUP BY 1""",
    "weekday_trend": "SELECT day_name, count(*) AS review_count FROM fct_reviews GROUP BY day_name",
    "weekday_trend_verified": """
        SELECT day_name, count(*) AS review_count FROM fct_reviews
        WHERE verified_purchase GROUP BY day_name""",
    "loaded_weekday_trend": """
        SELECT day_name, count(*) AS review_count FROM fct_reviews
        WHERE NOT verified_purchase GROUP BY day_name""",
    "check_not_null": _union([_not_null(*key) for key in _KEYS + _REVIEW_KEYS]),
    "check_unique": _union([_unique(*key) for key in _KEYS + _REVIEW_KEYS]),
    "check_keys": _union([check(*key) for key in _KEYS for check in (_not_null, _unique)]),
    "schema_contract": _union([_contract(model) for model in _CONTRACT]),
    "model_rows": _union([_model_rows(model) for model in _CONTRACT]),
    "profile": _profile(
        "staged_reviews",
        {
            "timestamp_ms": "bigint",
            "rating": "double",
            "helpful_votes": "bigint",
            "title": "string",
            "text": "string",
            "asin": "string",
            "verified_purchase": "boolean",
            "parent_asin": "string",
            "user_id": "string",
            "year": "int",
            "month": "int",
            "day": "int",
            "timestamp": "timestamp",
        },
    ),
    "dedup_reviews": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY
                helpful_votes DESC NULLS LAST, rating DESC NULLS LAST,
                verified_purchase DESC NULLS LAST, asin DESC NULLS LAST, user_id DESC NULLS LAST,
                "timestamp" DESC NULLS LAST) AS place
            FROM stg_reviews) WHERE place = 1""",
    "dedup_reviews_exact": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, asin, "timestamp" ORDER BY
                helpful_votes DESC NULLS LAST, rating DESC NULLS LAST,
                verified_purchase DESC NULLS LAST) AS place
            FROM run_together) WHERE place = 1""",
    "key_collisions": """
        SELECT review_id, count(DISTINCT [user_id, asin]) AS keys, count(*) AS reviews
        FROM run_together GROUP BY review_id HAVING count(DISTINCT [user_id, asin]) > 1""",
    "impute_price": """
        SELECT i.* REPLACE (round(coalesce(i.price, s.middle, c.middle, a.middle) + 1e-9, 6) + 0.0 AS price),
               CASE WHEN i.price IS NOT NULL THEN 'item' WHEN s.middle IS NOT NULL THEN 'category+store'
                    WHEN c.middle IS NOT NULL THEN 'category' WHEN a.middle IS NOT NULL THEN 'all'
                    END AS price_from
        FROM stg_items i
        LEFT JOIN (SELECT category, store, median(price) AS middle FROM stg_items GROUP BY ALL) s
               ON s.category IS NOT DISTINCT FROM i.category AND s.store IS NOT DISTINCT FROM i.store
        LEFT JOIN (SELECT category, median(price) AS middle FROM stg_items GROUP BY ALL) c
               ON c.category IS NOT DISTINCT FROM i.category
        CROSS JOIN (SELECT median(price) AS middle FROM stg_items) a""",
    "quarantine_corrupt": """
        SELECT CASE WHEN title <> 'F' THEN asin END AS asin,
               CASE WHEN title <> 'F' THEN user_id END AS user_id,
               CASE WHEN title <> 'F' THEN "timestamp" END AS "timestamp",
               CASE WHEN title = 'F' THEN '{' || coalesce(asin, '') END AS line
        FROM raw_reviews""",
    "quarantine_items": """
        SELECT CASE WHEN average_rating >= 4 THEN categories END AS categories,
               * EXCLUDE (categories), 'kept' AS reason
        FROM raw_items WHERE store <> 'Brand#11'
        UNION ALL BY NAME
        SELECT parent_asin, 'mistyped' AS reason FROM raw_items
        WHERE store <> 'Brand#11' AND average_rating < 4 AND categories <> '[]'
        UNION ALL BY NAME
        SELECT 'unparseable' AS reason FROM raw_items WHERE store = 'Brand#11'""",
    "holiday_flag": f"""
        SELECT {_TIME_COLUMNS}, h.name AS holiday_name, h.name IS NOT NULL AS is_holiday
        FROM review_days
        LEFT JOIN (SELECT DISTINCT CAST("timestamp" AS DATE) AS holiday,
                          CASE strftime("timestamp", '%m-%d') WHEN '01-01' THEN 'New Year'
                               WHEN '12-25' THEN 'Christmas' END AS name
                   FROM stg_reviews) h ON date_day = h.holiday""",
    "handle_missing": """
        SELECT * REPLACE (coalesce(price, 0.0) AS price, coalesce(category, 'Unknown') AS category)
        FROM stg_items""",
}


# Other ways to the same answers: shuffled instead of broadcast, over the loaded fact.
_SAME = {
    "reviews_x_price_shuffled": "reviews_x_price",
    "fct_x_users_shuffled": "fct_x_users",
    "fct_x_items_shuffled": "fct_x_items",
    "fct_x_item_avg_shuffled": "fct_x_item_avg",
    "dim_users_shuffled": "dim_users",
    "fct_reviews_shuffled": "fct_reviews",
    "monthly_reviews_price_shuffled": "monthly_reviews_price",
    "z_order_layout": "cluster_layout",
    "fct_x_users_bucketed": "fct_x_users",
    "dim_users_bucketed": "dim_users",
    "refresh_table": "dim_items",
    "fct_incremental": "fct_reviews",
    "dim_users_incremental": "dim_users",
    "rollup_reviews_by_year": "reviews_by_year",
    "rollup_category_rating_trend": "category_rating_trend",
    "rollup_category_share": "category_share",
    "rollup_monthly_reviews_price": "monthly_reviews_price",
    "rollup_weekday_trend_verified": "weekday_trend_verified",
    "loaded_reviews_by_year": "reviews_by_year",
    "loaded_category_rating_trend": "category_rating_trend",
    "loaded_category_share": "category_share",
    "loaded_monthly_reviews_price": "calendar_month_reviews_price",
}
# The sketches' estimates are compared with exact figures by the query itself.
_STATEMENTS["merged_profile"] = f"SELECT *, true AS near FROM ({_STATEMENTS['profile']})"
_STATEMENTS |= {name: _STATEMENTS[same] for name, same in _SAME.items()}


def _needed(sql: str, found: dict[str, str]) -> dict[str, str]:
    """The named subqueries ``sql`` refers to, those they need themselves first."""
    for name, body in _BASE.items():
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needed(body, found)
            found[name] = body
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for key, sql in _STATEMENTS.items():
        parts = ",\n".join(f"{name} AS ({body})" for name, body in _needed(sql, {}).items())
        statements[key] = f"WITH {parts}\n{sql}" if parts else sql
    return statements
