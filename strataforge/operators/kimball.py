"""The star schema of orders: dimensions, price history of type 2, facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import FACT_MONEY, ContractError
from ..functions.keys import kimball
from .dedup import first_by, newest_first

UNKNOWN_PRICE = "__UNKNOWN_PRICE__::"
BEGINNING = "1900-01-01 00:00:00"
#: Price intervals of a product that are looked through for one sale.
PAGE = 256


def _audited(df: DataFrame, run_ts: Column) -> DataFrame:
    return df.withColumns({"silver_created_at": run_ts, "silver_updated_at": run_ts})


def _once(df: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """One row per key; a total order over the row keeps it deterministic. ``unique`` says that keys are so already."""
    if unique:
        return df.where(F.col(key).isNotNull())
    broker = [c for c in ("_kafka_timestamp", "_kafka_partition", "_kafka_offset") if c in df.columns]
    return first_by(df.where(F.col(key).isNotNull()), [key], [*newest_first(*broker), F.xxhash64(*[F.col(c) for c in df.columns])])


def dim_date(orders: DataFrame | None, start: date | None = None, end: date | None = None) -> DataFrame:
    """A row per day between both bounds, or of the orders' span if neither is given."""
    if (start is None) != (end is None):
        raise ContractError("give both date bounds or neither")
    if start is not None:
        if start > end:
            raise ContractError("the first date is after the last")
        span = orders.sparkSession.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    else:
        span = orders.agg(F.to_date(F.min("event_timestamp")).alias("a"), F.to_date(F.max("event_timestamp")).alias("b")).where("a is not null")
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    return days.orderBy("full_date").select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), "full_date", F.dayofmonth(d).alias("day_of_month"), F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).alias("week_of_year"), F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"), F.year(d).alias("year_number"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_user(users: DataFrame, run_ts: Column, unique: bool = False) -> DataFrame:
    made = _once(users, "user_id", unique).withColumn("user_key", kimball("USR", "user_id"))
    return _audited(made.select("user_key", "user_id", "username", "email", "signup_date", "device", "loyalty_tier", "location"), run_ts)


def dim_category(categories: DataFrame, run_ts: Column, unique: bool = False) -> DataFrame:
    parent = F.when(F.col("parent_category_id").isNotNull(), kimball("CAT", "parent_category_id"))
    made = _once(categories, "category_id", unique).select(kimball("CAT", "category_id").alias("category_key"), "category_id", F.col("name").alias("category_name"), parent.alias("parent_category_key"), "parent_category_id")
    return _audited(made, run_ts)


def dim_product(products: DataFrame, categories: DataFrame, run_ts: Column, unique: bool = False) -> DataFrame:
    """Products with their category by name, whatever its case. Names should be unique; of several the least id counts."""
    name = lambda c: F.trim(F.lower(F.col(c)))
    named = categories.groupBy(name("category_name").alias("_name")).agg(F.min_by(F.struct("category_key", "category_id", "category_name"), "category_id").alias("_c"))
    joined = _once(products, "product_id", unique).join(named, name("category") == F.col("_name"), "left")
    made = joined.select(
        kimball("PRD", "product_id").alias("product_key"), "product_id", F.col("name").alias("product_name"), "_c.category_key", "_c.category_id",
        F.coalesce("_c.category_name", "category").alias("category_name"), "price", "inventory", "popularity_score",
    )
    return _audited(made, run_ts)


def price_intervals(history: DataFrame) -> DataFrame:
    """valid_from, valid_to and is_current per product; of several prices at one instant the newest record counts."""
    broker = [c for c in ("_kafka_timestamp", "_kafka_partition", "_kafka_offset") if c in history.columns]
    once = first_by(history.where("product_id is not null and valid_from is not null"), ["product_id", "valid_from"], [*newest_first(*broker), F.col("price_history_id").desc()])
    w = Window.partitionBy("product_id").orderBy(F.col("valid_from").asc_nulls_last(), "price_history_id")
    return once.withColumn("valid_to", F.lead("valid_from").over(w)).withColumn("is_current", F.col("valid_to").isNull())


def dim_product_price(history: DataFrame, products: DataFrame, run_ts: Column) -> DataFrame:
    """Type 2 price history; every product also has an unknown price from the beginning, so every sale has an interval."""
    start = F.lit(BEGINNING).cast(dict(history.dtypes).get("valid_from", "timestamp"))
    real = history.select("price_history_id", "product_id", "price", "valid_from", *[c for c in ("_kafka_timestamp", "_kafka_partition", "_kafka_offset") if c in history.columns])
    unknown = products.select(F.concat(F.lit(UNKNOWN_PRICE), F.col("product_id")).alias("price_history_id"), "product_id", F.lit(None).cast(dict(history.dtypes)["price"]).alias("price"), start.alias("valid_from"))
    joined = price_intervals(real.unionByName(unknown, allowMissingColumns=True)).join(products.select("product_id", "product_key"), "product_id", "left")
    made = joined.select(kimball("PPR", "price_history_id").alias("product_price_key"), "price_history_id", "product_key", "product_id", "price", "valid_from", "valid_to", "is_current")
    return _audited(made, run_ts)


def fact_order(orders: DataFrame, users: DataFrame, run_ts: Column, unique: bool = False) -> DataFrame:
    joined = _once(orders, "order_id", unique).join(users.select("user_id", "user_key"), "user_id", "left")
    made = joined.select(
        "order_id", "user_key", "user_id", F.date_format("event_timestamp", "yyyyMMdd").cast("int").alias("order_date_key"), F.col("event_timestamp").alias("order_timestamp"),
        "status", "payment_method", F.col("total").cast(FACT_MONEY).alias("total_amount"), F.lit(1).alias("order_count"),
    )
    return _audited(made, run_ts)


def price_as_of(items: DataFrame, prices: DataFrame, at: str = "order_timestamp") -> DataFrame:
    """Items with the price interval that holds ``at``: valid_from <= at < valid_to.

    Intervals of a product are put in pages of ``PAGE``, each a sorted array with the span that it answers for, and an
    item joins the one page of its time and takes the last start in it. No item is compared with more than a page, and
    a product with very many items is no task of its own: adaptive execution broadcasts pages that are few and splits
    the items of a skewed join. Items without a time find nothing.
    """
    kind = dict(items.dtypes)[at]
    time = lambda c: F.col(c).cast(kind).alias(c)
    by_product = Window.partitionBy("product_id").orderBy("valid_from", "price_history_id")
    starts = prices.where("product_id is not null and valid_from is not null").select("product_id", time("valid_from"), "price_history_id", "product_price_key", "price", time("valid_to"))
    paged = starts.withColumn("_page", F.floor((F.row_number().over(by_product) - 1) / PAGE))
    pages = paged.groupBy("product_id", "_page").agg(F.array_sort(F.collect_list(F.struct(*starts.columns[1:]))).alias("_starts"))
    pages = pages.withColumn("_from", F.col("_starts")[0]["valid_from"])
    pages = pages.select(F.col("product_id").alias("_product"), "_starts", "_from", F.lead("_from").over(Window.partitionBy("product_id").orderBy("_page")).alias("_to"))
    when = F.col(at)
    own = (F.col("product_id") == F.col("_product")) & (when >= F.col("_from")) & (F.col("_to").isNull() | (when < F.col("_to")))
    last = F.try_element_at(F.filter("_starts", lambda x: x["valid_from"] <= when), F.lit(-1))
    found = items.join(pages, own, "left").withColumn("_found", last)
    price = F.when(F.col("_found.valid_to").isNull() | (when < F.col("_found.valid_to")), F.col("_found"))
    return found.withColumn("_found", price).select(*items.columns, "_found.product_price_key", "_found.price_history_id", F.col("_found.price").alias("historical_product_price"))


def fact_order_item(items: DataFrame, orders: DataFrame, products: DataFrame, prices: DataFrame, run_ts: Column, unique: bool = False) -> DataFrame:
    """Items of known orders with the price of their time and money in decimal(29,2). ``orders`` is the order fact."""
    once = _once(items, "order_item_id", unique)
    if "explicit_discount" not in once.columns:
        once = once.withColumn("explicit_discount", F.col("discount_amount") if "discount_amount" in once.columns else F.lit(None).cast(FACT_MONEY))
    placed = once.join(orders.select("order_id", "order_timestamp", "order_date_key"), "order_id").join(products.select("product_id", "product_key"), "product_id", "left")
    kept = placed.select("order_item_id", "order_id", "product_key", "product_id", "order_date_key", "order_timestamp", "quantity", "unit_price", "item_total_amount", "explicit_discount")
    priced = price_as_of(kept, prices)
    money = lambda c: c.cast(FACT_MONEY)
    gross = money(F.col("quantity") * F.col("unit_price"))
    total = F.coalesce(money(F.col("item_total_amount")), money(gross - F.coalesce(money(F.col("explicit_discount")), F.lit(0).cast(FACT_MONEY))))
    made = priced.withColumns({"gross_item_amount": gross, "_total": total})
    made = made.withColumn("discount_amount", money(F.col("gross_item_amount") - F.col("_total")))
    out = made.select(
        "order_item_id", "order_id", "product_key", "product_id", "product_price_key", "order_date_key", "quantity", money(F.col("unit_price")).alias("unit_price"),
        "gross_item_amount", "discount_amount", F.col("_total").alias("item_total_amount"), money(F.col("gross_item_amount") - F.col("discount_amount")).alias("calculated_item_amount"),
        money(F.col("historical_product_price")).alias("historical_product_price"), money(F.col("unit_price") - F.col("historical_product_price")).alias("price_difference"),
    )
    return _audited(out, run_ts)


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_user: DataFrame
    dim_category: DataFrame
    dim_product: DataFrame
    dim_product_price: DataFrame
    fact_order: DataFrame
    fact_order_item: DataFrame

    #: Tables in the order in which they are written, with their keys.
    KEYS = (
        ("dim_date", "date_key"), ("dim_user", "user_key"), ("dim_category", "category_key"), ("dim_product", "product_key"),
        ("dim_product_price", "product_price_key"), ("fact_order", "order_id"), ("fact_order_item", "order_item_id"),
    )


def build_star(users, categories, products, orders, items, history, run_ts: Column, start: date | None = None, end: date | None = None, unique: bool = False, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> Star:
    """All seven tables from cleaned entities; ``unique`` says that these have one row per key, ``stage`` is put on each table."""
    user, category = stage(dim_user(users, run_ts, unique)), stage(dim_category(categories, run_ts, unique))
    product = stage(dim_product(products, category, run_ts, unique))
    price = stage(dim_product_price(history, product, run_ts))
    order = stage(fact_order(orders, user, run_ts, unique))
    return Star(stage(dim_date(orders, start, end)), user, category, product, price, order, stage(fact_order_item(items, order, product, price, run_ts, unique)))


__all__ = ["Star", "build_star", "dim_category", "dim_date", "dim_product", "dim_product_price", "dim_user", "fact_order", "fact_order_item", "price_as_of", "price_intervals"]
