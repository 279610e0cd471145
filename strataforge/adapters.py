"""The driver's tables seen as this model's entities.

Every text is plain SQL that Spark and DuckDB read alike; braces name the tables it reads. Faults are put in by
modulus, so that rules have something to find.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UNIT = "cast(cast(floor(cast(round(l_extendedprice*100) AS bigint) / cast(l_quantity AS int)) AS decimal(16,0)) * cast(0.01 AS decimal(3,2)) AS decimal(18,2))"

_EVENT = """SELECT 'behavioral.events' AS kafka_topic, cast(event_id % 4 AS int) AS kafka_partition, event_id AS kafka_offset, ts AS event_timestamp, event_id AS source_id,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('U', cast(user_id AS string)) END AS user_id,
 CASE WHEN event_id % 101 = 0 THEN ' ' ELSE concat('S', cast(user_id AS string), 'W', cast(weekofyear(ts) AS string)) END AS session_id,
 CASE WHEN event_id % 211 = 0 THEN '' ELSE CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'Product Search' WHEN 'signup' THEN 'add-to-cart'
   WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'checkout_start' WHEN 1 THEN 'payment_attempt' ELSE 'order_complete' END ELSE 'error' END END AS event_type,
 CASE event_id % 7 WHEN 0 THEN 'iOS' WHEN 1 THEN ' Android' WHEN 2 THEN 'web' WHEN 3 THEN 'tablet' WHEN 4 THEN 'PC' WHEN 5 THEN 'n/a' END AS device_type,
 CASE event_id % 5 WHEN 0 THEN 'Google-Ads' WHEN 1 THEN '-' WHEN 2 THEN 'email' END AS utm_source,
 concat('10.0.', cast(event_id % 300 AS string), '.1') AS ip_address, value AS cart_value, cast(event_id % 6 AS int) AS quantity, cast(event_id % 8 AS int) AS rating,
 cast(CASE WHEN event_type = 'error' THEN 450 + event_id % 200 ELSE 200 END AS int) AS http_status, {copy} AS copy_no FROM {{events}}"""

VIEWS = {
    "users": """SELECT concat('U', cast(c_custkey AS string)) AS user_id, c_name AS username,
 concat(lower(replace(c_name,'#','.')), CASE WHEN c_custkey % 17 = 0 THEN '' ELSE '@example.com' END) AS email, cast('2020-01-01' AS date) + cast(c_custkey % 900 AS int) AS signup_date,
 CASE c_custkey % 4 WHEN 0 THEN ' iOS ' WHEN 1 THEN 'Web' WHEN 2 THEN 'n/a' END AS device, c_mktsegment AS loyalty_tier, n_name AS location FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    "categories": "SELECT DISTINCT concat('C', replace(p_brand,'Brand#','')) AS category_id, p_brand AS name, cast(NULL AS string) AS parent_category_id FROM {part}",
    "products": """SELECT concat('P', cast(p_partkey AS string)) AS product_id, p_name AS name, cast(p_retailprice AS decimal(18,2)) AS price, lower(p_brand) AS category,
 p_size - 2 AS inventory, cast(p_partkey % 100 AS decimal(10,2)) AS popularity_score FROM {part}""",
    "orders_src": """SELECT concat('O', cast(o_orderkey AS string)) AS order_id, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE concat('U', cast(o_custkey AS string)) END AS user_id,
 CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE END AS event_timestamp,
 cast(CASE WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS decimal(18,2)) AS total,
 CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN ' pending' ELSE 'CANCELLED' END AS status, o_orderpriority AS payment_method, 0 AS _kafka_partition, o_orderkey AS _kafka_offset,
 o_orderdate + ((o_orderkey % 1440) + 5) * INTERVAL '1' MINUTE AS _kafka_timestamp FROM {orders}""",
    # offsets come from the row's own values: a count over the whole table would be one task
    "items_src": f"""SELECT concat('OI', cast(l_orderkey*10 + l_linenumber AS string)) AS order_item_id,
 concat('O', cast(CASE WHEN l_partkey % 67 = 0 THEN 900000000 + l_orderkey ELSE l_orderkey END AS string)) AS order_id, concat('P', cast(l_partkey AS string)) AS product_id,
 cast(l_quantity AS int) - CASE WHEN l_suppkey % 31 = 0 THEN 60 ELSE 0 END AS quantity, {_UNIT} AS unit_price,
 cast(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2))) AS decimal(18,2)) AS item_total_amount, 0 AS _kafka_partition,
 ((l_partkey % 10000 * 1000 + l_suppkey % 1000) * 100 + cast(l_quantity AS int)) * 100000000 + cast(round(l_extendedprice*100) AS bigint) % 1000000 * 100 + cast(round(l_discount*100) AS bigint) AS _kafka_offset,
 l_shipdate AS _kafka_timestamp FROM {{lineitem}}""",
    "prices_src": f"""SELECT concat('PH', cast(l_partkey*10000 + year(l_shipdate) AS string)) AS price_history_id, concat('P', cast(l_partkey AS string)) AS product_id,
 min({_UNIT}) AS price, date_trunc('year', min(l_shipdate)) AS valid_from FROM {{lineitem}} GROUP BY l_partkey, year(l_shipdate)""",
    "ev": _EVENT.format(copy=0) + "\nUNION ALL\n" + _EVENT.format(copy=1) + " WHERE event_id % 97 = 0",
}


def tables_of(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One entity, with its times as timestamps."""
    df = spark.sql(VIEWS[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(name)})
    times = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(times) if times else df


def duckdb_views(*names: str) -> str:
    """The same entities as common table expressions."""
    fill = lambda sql: re.sub(r"\{(\w+)\}", r"\1", sql)
    return ", ".join(f"{n} AS ({fill(VIEWS[n])})" for n in names)
