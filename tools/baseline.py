"""Time the headline queries as straightforward Spark SQL, for comparison with bench.py.

Same tables, same session, same sink and passes as bench.py; each query is one statement over
temporary views of the test tables, as one would write it without knowing the package.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from bench import PASSES  # noqa: E402

VIEWS = {
    "raw_reviews": """
        SELECT unix_millis(CAST(o_orderdate AS TIMESTAMP)) + l_orderkey * 7919 % 86400 * 1000 + 123 AS ms,
               CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN NULL ELSE 1 + l_quantity % 5 END AS rating,
               CAST(l_linenumber AS BIGINT) AS helpful_votes, l_linestatus AS title,
               CAST(NULL AS STRING) AS text, concat('P', l_partkey, '-', l_suppkey) AS item,
               l_returnflag = 'N' AS verified_purchase, concat('P', l_partkey) AS asin,
               CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE concat('U', o_custkey) END AS user_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "staged_reviews": """
        SELECT *, timestamp_seconds(ms DIV 1000) AS ts, year(timestamp_seconds(ms DIV 1000)) AS year,
               month(timestamp_seconds(ms DIV 1000)) AS month, day(timestamp_seconds(ms DIV 1000)) AS day
        FROM raw_reviews""",
    "stg_reviews": """
        SELECT unhex(md5(concat(coalesce(user_id, ''), coalesce(asin, ''), CAST(ts AS STRING)))) AS review_id,
               asin, user_id, rating, verified_purchase, helpful_votes, ts
        FROM staged_reviews WHERE rating IS NOT NULL AND ts IS NOT NULL""",
    "items": r"""
        SELECT concat('P', p_partkey) AS asin, p_type AS category, p_name AS title, p_brand AS store,
               try_cast(regexp_extract(CASE p_partkey % 6
                   WHEN 1 THEN '-' WHEN 2 THEN concat('$', p_retailprice)
                   WHEN 3 THEN concat('from ', p_retailprice) WHEN 4 THEN concat('$1,', p_retailprice)
                   WHEN 5 THEN CAST(p_retailprice AS STRING) END, '[0-9]+([.][0-9]+)?', 0) AS DOUBLE) AS price
        FROM part""",
    "days": """
        SELECT d AS date_day, date_format(d, 'EEEE') AS day_name
        FROM (SELECT explode(sequence(DATE '1995-01-01', DATE '2026-12-31')) AS d)""",
    "users": """
        SELECT user_id, count_if(verified_purchase) AS verified_purchase_count, count(*) AS review_count,
               min(ts) AS first_review_date, max(ts) AS last_review_date,
               count(DISTINCT CAST(ts AS DATE)) AS active_days,
               datediff(max(ts), min(ts)) / nullif(count(*) - 1, 0) AS avg_days_between_reviews,
               sum(coalesce(price, 0)) AS total_spent
        FROM stg_reviews LEFT JOIN items USING (asin) WHERE user_id IS NOT NULL GROUP BY user_id""",
    "fact": """
        SELECT review_id, hex(review_id) AS review_id_power_bi, r.user_id, asin, rating, verified_purchase,
               helpful_votes, ts, date_trunc('MONTH', ts) AS review_month, price, category, store,
               a.avg_rating, round(rating - a.avg_rating, 2) AS diff, date_day AS review_date, day_name
        FROM stg_reviews r
        LEFT JOIN days ON CAST(ts AS DATE) = date_day
        LEFT JOIN (SELECT user_id FROM users) u ON r.user_id = u.user_id
        LEFT JOIN items USING (asin)
        LEFT JOIN (SELECT asin, avg(rating) AS avg_rating FROM stg_reviews GROUP BY asin) a USING (asin)""",
}
QUERIES = {
    "fct_reviews": "SELECT * FROM fact",
    "dim_users": "SELECT * FROM users",
    "reviews_by_year": "SELECT year(review_date), count(*) FROM fact GROUP BY 1",
    "category_rating_trend": "SELECT category, review_month, avg(rating) FROM fact GROUP BY 1, 2",
    "category_share": """
        SELECT category, count(*), count(*) / (SELECT count(*) FROM fact) FROM fact GROUP BY 1""",
    "top10_users": """
        SELECT user_id, review_count, total_spent FROM users ORDER BY review_count DESC, user_id LIMIT 10""",
    "monthly_reviews_price": "SELECT month(review_month), count(*), avg(price) FROM fact GROUP BY 1",
    "weekday_trend": "SELECT day_name, count(*) FROM fact GROUP BY 1",
    "dedup_reviews": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY helpful_votes DESC,
            rating DESC, verified_purchase DESC, asin DESC, user_id DESC, ts DESC) AS n
            FROM stg_reviews) WHERE n = 1""",
    "check_keys": " UNION ALL ".join(
        f"""SELECT '{table}', 'not_null', count(*) FROM {table} WHERE {key} IS NULL UNION ALL
        SELECT '{table}', 'unique', count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL
        GROUP BY {key} HAVING count(*) > 1)"""
        for table, key in (("items", "asin"), ("items", "asin"), ("users", "user_id"), ("days", "date_day"))
    ),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("lineitem", "orders", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)
    out = tempfile.mkdtemp(prefix="baseline-")
    runs = iter(range(1000))

    def noop(sql: str) -> None:
        spark.sql(sql).write.format("noop").mode("overwrite").save()

    def staged() -> None:
        path = f"{out}/{next(runs)}"
        spark.table("staged_reviews").repartition(200).write.parquet(path)
        spark.read.parquet(path).write.format("noop").mode("overwrite").save()

    def reloaded() -> None:
        path, fact = f"{out}/{next(runs)}", spark.table("fact")
        for part in (fact, fact.where("review_month >= '1998-01-01' AND verified_purchase")):
            (
                part.sortWithinPartitions("review_month", "user_id", "asin")
                .write.option("partitionOverwriteMode", "dynamic")
                .mode("overwrite")
                .partitionBy("review_month")
                .parquet(path)
            )
        spark.read.parquet(path).write.format("noop").mode("overwrite").save()

    work = {name: (lambda sql=sql: noop(sql)) for name, sql in QUERIES.items()}
    work |= {"write_reviews_parquet": staged, "fct_insert_overwrite": reloaded}

    def timed(name: str) -> float:
        started = time.perf_counter()
        work[name]()
        return time.perf_counter() - started

    for name in work:
        timed(name)
    seconds = {name: round(min(timed(name) for _ in range(PASSES)), 3) for name in work}
    spark.stop()
    print(json.dumps({"metric": "straightforward_sql_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    main()
