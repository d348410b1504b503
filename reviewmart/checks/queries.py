"""One query per operator and model, over whole test tables.

Binary keys are shown as hexadecimal text and floating-point results are rounded to six
places, so that two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import cached_property, reduce
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart import schemas
from reviewmart.checks import tables
from reviewmart.functions import keys, numbers, times
from reviewmart.operators import aggregates as agg
from reviewmart.operators import calendar as cal
from reviewmart.operators import joins, profiles, quality, rows
from reviewmart.plans import dashboard, incremental, marts, rollup, staging
from reviewmart.session import apply_conf
from reviewmart.sources import archives, ledger, readers, writers
from reviewmart.workspace import cut, fresh_path

# Sums of doubles differ in their last bits by the order of addition. A value halfway between two
# roundings is shifted off the middle by more than that, so that both engines round it alike.
_SHIFT = 1e-9

# Columns of a staged review that no model has.
_UNREAD = ("timestamp_ms", "title", "text", "asin")

Query = Callable[[SparkSession, str], DataFrame]

# Limits under which every right side is shuffled and almost every key is spread, as large ones are.
SHUFFLED = joins.JoinLimits(broadcast_bytes=-1, fair_rows=1)


class Models:
    """The models over one set of test tables, each a lazy DataFrame made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = apply_conf(spark)
        self.sf_dir = sf_dir

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return tables.raw_reviews(self.spark, self.sf_dir)

    @cached_property
    def raw_items(self) -> DataFrame:
        return tables.raw_items(self.spark, self.sf_dir)

    @cached_property
    def staged_reviews(self) -> DataFrame:
        return staging.stage_reviews(self.raw_reviews)

    @cached_property
    def staged_items(self) -> DataFrame:
        return staging.stage_items(self.raw_items)

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.staged_reviews)

    @cached_property
    def review_table(self) -> DataFrame:
        """``stg_reviews`` over a table, for queries that read the reviews more than once."""
        names = [name for name in self.staged_reviews.columns if name not in _UNREAD]
        valid = rows.valid_reviews(self.staged_reviews).select(names)
        return staging.stg_reviews(cut(valid, "staged-reviews", compression="zstd"))

    @cached_property
    def stg_items(self) -> DataFrame:
        return staging.stg_items(self.staged_items)

    @cached_property
    def dim_items(self) -> DataFrame:
        return marts.dim_items(self.stg_items)

    @cached_property
    def item_table(self) -> DataFrame:
        """The items as a table, for joins that measure them first."""
        return cut(self.dim_items, "dim-items")

    @cached_property
    def average_table(self) -> DataFrame:
        return cut(agg.item_avg(self.review_table, counted=True), "item-avg")

    @cached_property
    def dim_time(self) -> DataFrame:
        return cal.dim_time(cal.calendar(self.spark))

    def dim_users(self, limits: joins.JoinLimits = joins.USUAL) -> DataFrame:
        return marts.dim_users(self.review_table, self.dim_items, limits)

    def dated(self, reviews: DataFrame | None = None) -> DataFrame:
        return joins.fct_x_time(self.stg_reviews if reviews is None else reviews, self.dim_time)

    def context(
        self,
        *by: str | Column,
        attributes: Sequence[str] = (),
        dated: bool = False,
        limits: joins.JoinLimits = joins.USUAL,
    ) -> DataFrame:
        """What a dashboard query needs of the fact: item attributes and the columns ``by``."""
        month = times.review_month(F.col("timestamp"))
        reviews = (self.dated() if dated else self.stg_reviews).withColumn("review_month", month)
        return marts.review_context(reviews, self.dim_items, attributes, by, limits)

    def fct_reviews(self, limits: joins.JoinLimits = joins.USUAL) -> DataFrame:
        return marts.fct_reviews(self.review_table, self.dim_items, self.dim_time, limits)

    def loaded_fact(self) -> DataFrame:
        """The fact as a dashboard finds it: loaded, and read from its files."""
        path = self.path("fct_reviews")
        writers.load_fact(self.fct_reviews(), path, derived=marts.fct_derived())
        return writers.read_fact(self.spark, path)

    def path(self, label: str) -> str:
        return fresh_path(self.spark, label)


_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Models], DataFrame]) -> Callable[[Models], DataFrame]:
    """Register ``build`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Models(spark, sf_dir)))

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def comparable(df: DataFrame) -> DataFrame:
    shown: list[Column] = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "binary":
            column = keys.review_id_hex(column)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("long")
        elif kind == "double":
            column = F.round(column + F.lit(_SHIFT), 6) + F.lit(0.0)
        elif kind.startswith("array"):
            column = F.to_json(column)
        shown.append(column.alias(name))
    return df.select(shown)


# --- sources and sinks ---------------------------------------------------------------


@_query
def scan_reviews_json(m: Models) -> DataFrame:
    path = m.path("raw-reviews")
    m.raw_reviews.write.option("compression", "gzip").json(path)
    return readers.scan_reviews_json(m.spark, f"{path}/*.json.gz")


@_query
def scan_items_json(m: Models) -> DataFrame:
    path = m.path("raw-items")
    m.raw_items.write.option("compression", "gzip").json(path)
    return readers.scan_items_json(m.spark, f"{path}/*.json.gz")


@_query
def write_reviews_parquet(m: Models) -> DataFrame:
    path = m.path("review")
    writers.write_reviews_parquet(m.staged_reviews, path)
    return readers.scan_parquet(m.spark, path)


@_query
def staged_by_ledger(m: Models) -> DataFrame:
    """Archives that arrive in two deliveries, the second of which is staged alone."""
    raw, out, known = m.path("raw-reviews"), m.path("review"), m.path("ledger")
    scan = lambda paths: readers.scan_reviews_json(m.spark, paths)
    stage = lambda rows_: staging.stage_reviews(rows_, ledger.ARCHIVE)
    early = F.col("title") == "F"
    for delivery in (early, ~early):
        some = writers.repartition(m.raw_reviews.where(delivery))
        some.write.mode("append").option("compression", "gzip").json(raw)
        ledger.stage_pending(m.spark, f"{raw}/*.json.gz", out, known, scan, stage)
    return readers.scan_parquet(m.spark, out).drop(ledger.ARCHIVE)


@_query
def write_items_parquet(m: Models) -> DataFrame:
    path = m.path("item")
    writers.write_items_parquet(m.staged_items, path)
    return readers.scan_parquet(m.spark, path)


@_query
def scan_parquet(m: Models) -> DataFrame:
    path = m.path("item")
    writers.write_items_parquet(m.staged_items, path, partitions=4)
    return readers.scan_parquet(m.spark, path)


@_query
def external_table(m: Models) -> DataFrame:
    path = m.path("review")
    writers.write_reviews_parquet(m.staged_reviews, path)
    return readers.external_table(m.spark, "stg_reviews_ext", path)


@_query
def materialize_view(m: Models) -> DataFrame:
    return writers.materialize_view(m.stg_items, "stg_items")


@_query
def materialize_table(m: Models) -> DataFrame:
    return writers.materialize_table(m.dim_items, m.path("dim_items"))


@_query
def refresh_table(m: Models) -> DataFrame:
    """A first version, one that fails while it is written, and a second one."""
    name, root = f"items_{uuid4().hex}", m.path("items")
    writers.refresh_table(rows.category_distinct(m.staged_items, "ECONOMY"), name, root)
    broken = m.dim_items.withColumn("title", F.raise_error(F.lit("no such title")))
    try:
        writers.refresh_table(broken, name, root)
    except PySparkException:
        writers.refresh_table(m.dim_items, name, root)
    return m.spark.table(name)


@_query
def verify_archives(m: Models) -> DataFrame:
    """What the archives of the raw reviews inflate to, none of them broken."""
    path = m.path("raw-archives")
    m.raw_reviews.select("asin").write.option("compression", "gzip").json(path)
    report = archives.verify(m.spark, f"{path}/*.json.gz")
    return report.agg(
        F.sum("text_bytes").alias("text_bytes"), F.count("broken_at").alias("broken")
    )


@_query
def fct_insert_overwrite(m: Models) -> DataFrame:
    """Load everything, then reload the later months with verified reviews only."""
    path, derived = m.path("fct_reviews"), marts.fct_derived()
    writers.load_fact(m.fct_reviews(), path, derived=derived)
    late = F.col("review_month") >= F.lit("1998-01-01").cast("timestamp")
    loaded = writers.read_fact(m.spark, path).where(late)
    verified = cut(rows.verified_slicer(loaded, True), "verified", compression="zstd")
    writers.load_fact(verified, path, derived=derived)
    return writers.read_fact(m.spark, path)


@_query
def cluster_layout(m: Models) -> DataFrame:
    joined = joins.fct_x_items(m.dated(), m.item_table)
    month = times.review_month(F.col("timestamp"))
    return writers.cluster_layout(joined.withColumn("review_month", month))


@_query
def z_order_layout(m: Models) -> DataFrame:
    joined = joins.fct_x_items(m.dated(m.review_table), m.item_table)
    month = times.review_month(F.col("timestamp"))
    table = cut(joined.withColumn("review_month", month), "joined", compression="zstd")
    return writers.z_order_layout(table)


@_query
def repartition(m: Models) -> DataFrame:
    return writers.repartition(m.raw_reviews, 16)


# --- projections ---------------------------------------------------------------------


@_query
def select_columns(m: Models) -> DataFrame:
    return rows.select_columns(m.raw_items, "parent_asin", "main_category", "price")


@_query
def resolve_ts_column(m: Models) -> DataFrame:
    late = F.when(F.col("title") == "O", F.col("timestamp") + 5000)
    both = m.raw_reviews.withColumn("sort_timestamp", late)
    return both.select("asin", "user_id", rows.resolve_ts_column(both).alias("timestamp_ms"))


@_query
def ms_to_timestamp(m: Models) -> DataFrame:
    ms = F.col("timestamp")
    return m.raw_reviews.select(
        ms.alias("timestamp_ms"),
        times.ms_to_timestamp(ms).alias("timestamp"),
        times.ms_to_timestamp(-ms).alias("mirrored"),
    )


@_query
def ts_parts(m: Models) -> DataFrame:
    ts = times.ms_to_timestamp(F.col("timestamp"))
    return m.raw_reviews.select(ts.alias("timestamp"), *times.ts_parts(ts))


@_query
def rename_keys(m: Models) -> DataFrame:
    renamed = rows.rename_keys(m.raw_items)
    return renamed.select("asin", "category", "title")


@_query
def safe_cast_double(m: Models) -> DataFrame:
    return m.raw_items.select(
        "parent_asin",
        numbers.safe_double(F.col("price")).alias("price"),
        numbers.safe_double(F.col("rating_number")).alias("rating_number"),
    )


@_query
def clean_price(m: Models) -> DataFrame:
    text = F.col("price")
    return m.raw_items.select("parent_asin", text, numbers.clean_price(text).alias("number"))


@_query
def review_id(m: Models) -> DataFrame:
    return m.stg_reviews.select("review_id", "user_id", "asin", "timestamp")


@_query
def review_id_hex(m: Models) -> DataFrame:
    return m.stg_reviews.select(
        keys.review_id_hex(F.col("review_id")).alias("review_id_power_bi"), "helpful_votes"
    )


@_query
def review_month(m: Models) -> DataFrame:
    ts = F.col("timestamp")
    return m.stg_reviews.select(ts, times.review_month(ts).alias("review_month"))


@_query
def review_date(m: Models) -> DataFrame:
    ts = F.col("timestamp")
    return m.stg_reviews.select(ts, times.review_date(ts).alias("review_date"))


@_query
def rating_diff(m: Models) -> DataFrame:
    return joins.fct_x_item_avg(m.review_table, m.average_table).select(
        "review_id",
        "helpful_votes",
        numbers.rating_diff(F.col("rating"), F.col("avg_rating")).alias("rating_diff_from_avg"),
    )


@_query
def dim_items(m: Models) -> DataFrame:
    return m.dim_items


# --- staging models ------------------------------------------------------------------


@_query
def staged_reviews(m: Models) -> DataFrame:
    return m.staged_reviews


@_query
def staged_items(m: Models) -> DataFrame:
    return m.staged_items


@_query
def stg_reviews(m: Models) -> DataFrame:
    return m.stg_reviews


@_query
def stg_items(m: Models) -> DataFrame:
    return m.stg_items


# --- filters -------------------------------------------------------------------------


@_query
def valid_reviews(m: Models) -> DataFrame:
    return rows.valid_reviews(m.staged_reviews)


@_query
def known_users(m: Models) -> DataFrame:
    return rows.known_users(m.stg_reviews)


@_query
def category_distinct(m: Models) -> DataFrame:
    return rows.category_distinct(m.staged_items, "ECONOMY")


@_query
def has_categories(m: Models) -> DataFrame:
    return rows.has_categories(m.staged_items)


@_query
def verified_slicer(m: Models) -> DataFrame:
    return rows.verified_slicer(m.stg_reviews, False)


# --- joins ---------------------------------------------------------------------------


@_query
def reviews_x_price(m: Models) -> DataFrame:
    return joins.reviews_x_price(m.stg_reviews, m.item_table)


@_query
def reviews_x_price_shuffled(m: Models) -> DataFrame:
    return joins.reviews_x_price(m.stg_reviews, m.item_table, SHUFFLED)


@_query
def fct_x_time(m: Models) -> DataFrame:
    return m.dated()


@_query
def fct_x_users(m: Models) -> DataFrame:
    users = cut(m.dim_users(), "dim-users")
    return joins.fct_x_users(m.review_table, users)


@_query
def fct_x_users_shuffled(m: Models) -> DataFrame:
    users = cut(m.dim_users(SHUFFLED), "dim-users")
    return joins.fct_x_users(m.review_table, users, SHUFFLED)


@_query
def fct_x_items(m: Models) -> DataFrame:
    return joins.fct_x_items(m.stg_reviews, m.item_table)


@_query
def fct_x_items_shuffled(m: Models) -> DataFrame:
    return joins.fct_x_items(m.stg_reviews, m.item_table, SHUFFLED)


@_query
def fct_x_item_avg(m: Models) -> DataFrame:
    return joins.fct_x_item_avg(m.review_table, m.average_table)


@_query
def fct_x_item_avg_shuffled(m: Models) -> DataFrame:
    return joins.fct_x_item_avg(m.review_table, m.average_table, SHUFFLED)


def _bucketed(m: Models, df: DataFrame, label: str) -> DataFrame:
    return writers.bucketed_table(df, f"{label}_{uuid4().hex}", m.path(label))


@_query
def fct_x_users_bucketed(m: Models) -> DataFrame:
    reviews = _bucketed(m, m.review_table, "reviews")
    return joins.bucketed_x_users(reviews, _bucketed(m, m.dim_users(), "users"))


@_query
def dim_users_bucketed(m: Models) -> DataFrame:
    return marts.dim_users(_bucketed(m, m.stg_reviews, "reviews"), m.dim_items)


# --- aggregations and the calendar -----------------------------------------------------


@_query
def item_avg(m: Models) -> DataFrame:
    return agg.item_avg(m.stg_reviews)


@_query
def dim_users(m: Models) -> DataFrame:
    return m.dim_users()


@_query
def dim_users_shuffled(m: Models) -> DataFrame:
    return m.dim_users(SHUFFLED)


def _per_user(m: Models, **measures: Column) -> DataFrame:
    named = [column.alias(name) for name, column in measures.items()]
    return rows.known_users(m.stg_reviews).groupBy("user_id").agg(*named)


@_query
def verified_purchase_count(m: Models) -> DataFrame:
    count = agg.verified_purchase_count(F.col("verified_purchase"))
    return _per_user(m, verified_purchase_count=count)


@_query
def review_count(m: Models) -> DataFrame:
    return _per_user(m, review_count=agg.review_count())


@_query
def first_last_review_date(m: Models) -> DataFrame:
    ts = F.col("timestamp")
    return _per_user(
        m, first_review_date=agg.first_review(ts), last_review_date=agg.last_review(ts)
    )


@_query
def active_days(m: Models) -> DataFrame:
    return _per_user(m, active_days=agg.active_days(F.col("timestamp")))


@_query
def avg_days_between_reviews(m: Models) -> DataFrame:
    gap = agg.avg_days_between_reviews(F.col("timestamp"))
    return _per_user(m, avg_days_between_reviews=gap)


@_query
def total_spent(m: Models) -> DataFrame:
    priced = joins.reviews_x_price(rows.known_users(m.stg_reviews), m.item_table)
    return priced.groupBy("user_id").agg(agg.total_spent(F.col("price")).alias("total_spent"))


@_query
def row_count(m: Models) -> DataFrame:
    return rows.row_count(m.staged_reviews)


@_query
def distinct_values(m: Models) -> DataFrame:
    return rows.distinct_values(m.staged_items, "main_category", "store")


@_query
def calendar(m: Models) -> DataFrame:
    return cal.calendar_of(m.stg_reviews, times.review_date(F.col("timestamp")))


@_query
def dim_time(m: Models) -> DataFrame:
    return cal.dim_time(cal.calendar_of(m.stg_reviews, times.review_date(F.col("timestamp"))))


@_query
def fct_reviews(m: Models) -> DataFrame:
    return m.fct_reviews()


@_query
def fct_reviews_shuffled(m: Models) -> DataFrame:
    return m.fct_reviews(SHUFFLED)


def _loaded_months(m: Models) -> str:
    """Reviews loaded range by range; the middle one first in part, as of an earlier delivery."""
    out = m.path("by-month")
    early = rows.verified_slicer(m.review_table, True)
    incremental.load_months(m.review_table, out, date(1990, 1, 1), date(1996, 12, 31))
    incremental.load_months(early, out, date(1997, 1, 1), date(1998, 6, 30))
    incremental.load_months(m.review_table, out, date(1998, 7, 1), date(2010, 12, 31))
    incremental.load_months(m.review_table, out, date(1997, 1, 15), date(1998, 6, 1))
    return out


@_query
def fct_incremental(m: Models) -> DataFrame:
    return incremental.fct_reviews(m.spark, _loaded_months(m), m.item_table, m.dim_time)


@_query
def dim_users_incremental(m: Models) -> DataFrame:
    return incremental.dim_users(m.spark, _loaded_months(m), m.item_table)


# --- dashboard -----------------------------------------------------------------------


@_query
def reviews_by_year(m: Models) -> DataFrame:
    # Any day of a year stands for it, and there are fewer years than days.
    year = F.trunc("review_date", "year").alias("review_date")
    return dashboard.reviews_by_year(m.context(year, dated=True))


@_query
def category_rating_trend(m: Models) -> DataFrame:
    return dashboard.category_rating_trend(
        m.context("review_month", "rating", attributes=["category"])
    )


@_query
def category_share(m: Models) -> DataFrame:
    return dashboard.category_share(m.context(attributes=["category"]))


@_query
def top10_users(m: Models) -> DataFrame:
    return dashboard.top10_users(m.dim_users())


@_query
def monthly_reviews_price(m: Models) -> DataFrame:
    return dashboard.monthly_reviews_price(m.context("review_month", attributes=["price"]))


@_query
def monthly_reviews_price_shuffled(m: Models) -> DataFrame:
    context = m.context("review_month", attributes=["price"], limits=SHUFFLED)
    return dashboard.monthly_reviews_price(context)


@_query
def calendar_month_reviews_price(m: Models) -> DataFrame:
    context = m.context("review_month", attributes=["price"])
    return dashboard.monthly_reviews_price(context, by_calendar_month=True)


@_query
def weekday_trend(m: Models) -> DataFrame:
    return dashboard.weekday_trend(m.context("day_name", dated=True))


@_query
def weekday_trend_verified(m: Models) -> DataFrame:
    context = m.context("day_name", "verified_purchase", dated=True)
    return dashboard.weekday_trend(context, verified=True)


@_query
def loaded_reviews_by_year(m: Models) -> DataFrame:
    return dashboard.reviews_by_year(m.loaded_fact())


@_query
def loaded_category_rating_trend(m: Models) -> DataFrame:
    return dashboard.category_rating_trend(m.loaded_fact())


@_query
def loaded_category_share(m: Models) -> DataFrame:
    return dashboard.category_share(m.loaded_fact())


@_query
def loaded_monthly_reviews_price(m: Models) -> DataFrame:
    return dashboard.monthly_reviews_price(m.loaded_fact(), by_calendar_month=True)


@_query
def loaded_weekday_trend(m: Models) -> DataFrame:
    return dashboard.weekday_trend(m.loaded_fact(), verified=False)


def _rolled_up(m: Models) -> DataFrame:
    path = m.path("rollup")
    rollup.load_rollup(m.fct_reviews(), path)
    return rollup.read_rollup(m.spark, path)


@_query
def rollup_reviews_by_year(m: Models) -> DataFrame:
    return rollup.reviews_by_year(_rolled_up(m))


@_query
def rollup_category_rating_trend(m: Models) -> DataFrame:
    return rollup.category_rating_trend(_rolled_up(m))


@_query
def rollup_category_share(m: Models) -> DataFrame:
    return rollup.category_share(_rolled_up(m))


@_query
def rollup_monthly_reviews_price(m: Models) -> DataFrame:
    return rollup.monthly_reviews_price(_rolled_up(m))


@_query
def rollup_weekday_trend_verified(m: Models) -> DataFrame:
    return rollup.weekday_trend(_rolled_up(m), verified=True)


# --- quality and documented intents ----------------------------------------------------


def _keyed_models(m: Models) -> dict[str, DataFrame]:
    return {
        "stg_items": m.stg_items,
        "dim_items": m.dim_items,
        "dim_users": m.dim_users(),
        "dim_time": m.dim_time,
    }


def _checked(m: Models, check: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    models = _keyed_models(m)
    checks = [check(models[model], model, column) for model, column in schemas.KEYS.items()]
    # The review key is under no declared check: it shows what a failing one reports.
    checks.append(check(m.stg_reviews, "stg_reviews", "review_id"))
    checks.append(check(m.stg_reviews, "stg_reviews", "user_id"))
    return reduce(DataFrame.unionAll, checks)


@_query
def check_not_null(m: Models) -> DataFrame:
    return _checked(m, quality.check_not_null)


@_query
def check_unique(m: Models) -> DataFrame:
    return _checked(m, quality.check_unique)


@_query
def check_keys(m: Models) -> DataFrame:
    return quality.check_keys(_keyed_models(m))


def _saved_models(m: Models) -> dict[str, DataFrame]:
    """All six models, written and read back; later ones are made of those written before."""
    saved: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        saved[name] = writers.materialize_table(df, m.path(name))
        return saved[name]

    reviews = save("stg_reviews", m.stg_reviews)
    save("stg_items", m.stg_items)
    items = save("dim_items", m.dim_items)
    per_item = marts.item_context(reviews, items)
    counts = per_item.groupBy("asin").agg(F.max("rows").alias("rows"))
    save("dim_users", marts.dim_users(reviews, items, counts=counts))
    days = cal.calendar_of(reviews, times.review_date(F.col("timestamp")))
    save("dim_time", cal.dim_time(days))
    save("fct_reviews", marts.fct_reviews(reviews, items, m.dim_time, per_item=per_item))
    return saved


@_query
def schema_contract(m: Models) -> DataFrame:
    contracts = [
        quality.schema_contract(df, name, schemas.MODELS[name])
        for name, df in _saved_models(m).items()
    ]
    return reduce(DataFrame.unionAll, contracts)


@_query
def model_rows(m: Models) -> DataFrame:
    return quality.model_rows(_saved_models(m))


@_query
def profile(m: Models) -> DataFrame:
    return quality.profile(m.staged_reviews)


@_query
def merged_profile(m: Models) -> DataFrame:
    """A table that grows by a second delivery, profiled file by file, against exact figures."""
    table, state = m.path("growing"), m.path("growing-profile")
    staged = m.staged_reviews
    late = F.col("year") >= 1998
    writers.repartition(staged.where(~late)).write.parquet(table)
    profiles.update_profile(m.spark, table, state)
    writers.repartition(staged.where(late | late.isNull())).write.mode("append").parquet(table)
    profiles.update_profile(m.spark, table, state)
    whole = m.spark.read.parquet(table)
    exact = whole.agg(*(F.count_distinct(name).alias(name) for name in whole.columns)).select(
        F.inline(F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(n).alias("exact")) for n in whole.columns)))
    )
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact")
    merged = profiles.merged_profile(m.spark, table, state).join(exact, "column_name")
    return merged.select("column_name", "data_type", "row_count", "filled", near.alias("near"))


@_query
def dedup_reviews(m: Models) -> DataFrame:
    return rows.dedup_reviews(m.stg_reviews)


@_query
def dedup_reviews_exact(m: Models) -> DataFrame:
    return rows.dedup_reviews(_run_together(m), exact=True)


@_query
def key_collisions(m: Models) -> DataFrame:
    return rows.key_collisions(_run_together(m))


def _run_together(m: Models) -> DataFrame:
    """Reviews by month whose users and products are bare numbers, so that their keys run together."""
    bare = m.stg_reviews.select(
        F.substring("user_id", 2, 9).alias("user_id"),
        F.substring("asin", 2, 9).alias("asin"),
        F.date_trunc("year", "timestamp").alias("timestamp"),
        "rating",
        "verified_purchase",
        "helpful_votes",
    )
    key = keys.review_id(F.col("user_id"), F.col("asin"), F.col("timestamp"))
    return bare.select(key.alias("review_id"), *bare.columns)


@_query
def impute_price(m: Models) -> DataFrame:
    return rows.impute_price(m.stg_items)


@_query
def quarantine_corrupt(m: Models) -> DataFrame:
    """Lines of one status are cut short before they are read back and split."""
    path = m.path("raw-damaged")
    line = F.to_json(F.struct(*m.raw_reviews.columns))
    cut_short = F.concat(F.lit("{"), F.coalesce("asin", F.lit("")))
    damaged = F.when(F.col("title") == "F", cut_short).otherwise(line)
    m.raw_reviews.select(damaged.alias("value")).write.option("compression", "gzip").text(path)
    good, bad = readers.split_corrupt(m.spark, path, schemas.RAW_REVIEW)
    kept = good.select("asin", "user_id", "timestamp", F.lit(None).cast("string").alias("line"))
    return kept.unionByName(bad.select("line"), allowMissingColumns=True)


@_query
def quarantine_items(m: Models) -> DataFrame:
    """Items of small size have flat categories, those of one store are cut short."""
    path = m.path("raw-damaged-items")
    names = [name for name in m.raw_items.columns if name != "categories"]
    flat = F.when(F.size("categories") > 0, F.flatten("categories"))
    line = (
        F.when(F.col("store") == "Brand#11", F.lit('{"parent_asin":'))
        .when(F.col("average_rating") < 4, F.to_json(F.struct(*names, flat.alias("categories"))))
        .otherwise(F.to_json(F.struct(*m.raw_items.columns)))
    )
    m.raw_items.select(line.alias("value")).write.option("compression", "gzip").text(path)
    rows_kept, amiss = readers.split_corrupt(m.spark, path, schemas.RAW_ITEM)
    kept = rows_kept.withColumn("reason", F.lit("kept"))
    listed = amiss.select("reason", F.get_json_object("line", "$.parent_asin").alias("parent_asin"))
    return kept.unionByName(listed, allowMissingColumns=True)


@_query
def holiday_flag(m: Models) -> DataFrame:
    days = cal.calendar_of(m.stg_reviews, times.review_date(F.col("timestamp")))
    return cal.holiday_flag(cal.dim_time(days), tables.holidays(m.stg_reviews))


@_query
def handle_missing(m: Models) -> DataFrame:
    return rows.handle_missing(m.stg_items, {"price": 0.0, "category": "Unknown"})
