import json
import os
import struct
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from strataforge import contracts, jobs
from strataforge.functions import clean, keys
from strataforge.operators import dedup, events, kimball, reports, serving, transactional
from strataforge.plans import backfill, gold, migrate, silver
from strataforge.plans.store import INSERT_ONLY, PRESERVE_BOUNDS, Conflict, Merge, Store
from strataforge.sources import avro, kafka_shape, partitions, registry
from strataforge.streaming import bronze



def ts(text):
    return datetime.fromisoformat(text)


def test_categories_split_as_documented(spark):
    rows = [("C001", "Electronics", None), ("C002", "Books", "C001"), ("C003", "", "C001"), (None, "Invalid", "C001"), ("C004", "Clothing", "C999")]
    checked = transactional.validate(spark.createDataFrame(rows, "category_id string, name string, parent_category_id string"), "categories")
    assert checked.valid.count() == 3
    found = {tuple(r["validation_errors"]) for r in checked.rejected.collect()}
    assert found == {("name:required_value_missing",), ("category_id:required_value_missing",)}
    issues = transactional.quality_issues(checked, "categories", F.lit("2024-01-01").cast("timestamp"))
    assert issues.count() == 2 and issues.select("issue_key").distinct().count() == 2


def test_garbage_never_raises(spark):
    rows = [("O1", "U1", "not a time", "12x", "Completed", None), ("o2", "NA", "1970-01-01 00:00:00", "-5", " ", "n/a"), (None, None, None, None, None, None)]
    raw = spark.createDataFrame(rows, "order_id string, user_id string, event_timestamp string, total string, status string, payment_method string")
    raw = raw.withColumn("_kafka_timestamp", F.lit("2024-05-05 10:00:00"))
    checked = transactional.validate(raw, "orders")
    assert checked.rows.count() == 3
    got = {r["order_id"]: (r["event_timestamp"], r["repair_description"]) for r in checked.rows.collect()}
    assert got["O1"][0] == ts("2024-05-05 10:00:00") and got["o2"][1] == transactional.REPAIR_NOTE
    # an id that means no value doesn't survive cleaning
    assert transactional.clean(checked.rows, "orders").select("order_id").distinct().count() == 2


@pytest.mark.parametrize("token", contracts.NULL_LIKE)
def test_null_like(spark, token):
    row = spark.range(1).select(clean.collapse(F.lit(f"  {token.upper()} ")).alias("a"), clean.device(F.lit(token)).alias("d")).first()
    assert row["a"] is None and row["d"] == "unknown"


def test_coordinates_keep_the_fullest_and_all_incomplete(spark):
    t = ts("2024-01-01 00:00:00")
    rows = [("C1", None, "t", 0, 1, t, t), ("C1", "Books", "t", 0, 1, t, t), ("C2", "x", None, 0, 1, t, t), ("C2", "x", None, 0, 1, t, t)]
    raw = spark.createDataFrame(rows, "category_id string, name string, _kafka_topic string, _kafka_partition int, _kafka_offset bigint, _kafka_timestamp timestamp, bronze_ingestion_timestamp timestamp")
    out = dedup.dedup_coordinates(raw, "categories").collect()
    assert len(out) == 3 and [r["name"] for r in out if r["_kafka_topic"]] == ["Books"]


def prices(spark):
    rows = [("PH1", "P1", 10, ts("2024-01-01 00:00:00")), ("PH2", "P1", 12, ts("2024-02-01 00:00:00")), ("PH3", "P1", 13, ts("2024-02-01 00:00:00"))]
    return spark.createDataFrame(rows, "price_history_id string, product_id string, price int, valid_from timestamp").withColumn("price", F.col("price").cast("decimal(18,2)"))


def test_price_intervals_and_as_of(spark):
    run = F.lit("2024-06-01").cast("timestamp")
    products = spark.createDataFrame([("P1", "k1"), ("P2", "k2")], "product_id string, product_key string")
    dim = kimball.dim_product_price(prices(spark), products, run)
    assert dim.count() == 4 and dim.where("is_current").count() == 2  # two prices at one instant are one
    sales = [(1, "P1", ts("2023-12-31 23:59:59")), (2, "P1", ts("2024-01-01 00:00:00")), (3, "P1", ts("2024-02-01 00:00:00")), (4, "P2", ts("2024-02-01 00:00:00")), (5, "P9", ts("2024-02-01 00:00:00")), (6, "P1", None), (7, "P1", ts("2024-02-01 00:00:00"))]
    items = spark.createDataFrame(sales, "id int, product_id string, order_timestamp timestamp")
    got = {r["id"]: r["price_history_id"] for r in kimball.price_as_of(items, dim).collect()}
    assert got == {1: "__UNKNOWN_PRICE__::P1", 2: "PH1", 3: "PH3", 4: "__UNKNOWN_PRICE__::P2", 5: None, 6: None, 7: "PH3"}


def test_dim_date_bounds(spark):
    orders = spark.createDataFrame([(ts("2024-02-28 12:00:00"),), (ts("2024-03-01 00:00:00"),)], "event_timestamp timestamp")
    assert [r["date_key"] for r in kimball.dim_date(orders).orderBy("date_key").collect()] == [20240228, 20240229, 20240301]
    with pytest.raises(contracts.ContractError):
        kimball.dim_date(orders, start=date(2024, 1, 1))


def test_funnel_is_ordered(spark):
    rows = [("a", "product_search", 1), ("a", "page_view", 2), ("a", "product_search", 3), ("b", "product_search", 1), ("c", "page_view", 1)]
    df = spark.createDataFrame(rows, "session_id string, event_type string, n int").withColumn("event_timestamp", F.timestamp_seconds("n")).withColumn("event_id", F.col("n"))
    got = {r["session_id"]: r["depth"] for r in reports.funnel_sessions(df).collect()}
    assert got == {"a": 2, "c": 1}
    rows = reports.funnel_report(reports.funnel_sessions(df)).orderBy("stage_order").collect()
    assert [r["sessions"] for r in rows] == [2, 1, 0, 0, 0, 0] and rows[1]["conversion_from_previous_percent"] == 50.0


def test_store_merges(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    t = spark.createDataFrame([(1, 5, 5, "a"), (2, 6, 6, "b")], "k int, lo int, hi int, v string")
    s = spark.createDataFrame([(2, 3, 9, "c"), (3, 1, 1, "d")], t.schema)
    store.ensure("t", t.schema)
    store.merge("t", t, ["k"])
    store.merge("t", s, ["k"], Merge(PRESERVE_BOUNDS, least=("lo",), greatest=("hi",)))
    first = sorted(map(tuple, store.read("t").collect()))
    assert first == [(1, 5, 5, "a"), (2, 3, 9, "c"), (3, 1, 1, "d")]
    store.merge("t", s, ["k"], Merge(PRESERVE_BOUNDS, least=("lo",), greatest=("hi",)))
    assert sorted(map(tuple, store.read("t").collect())) == first
    store.merge("t", s.withColumn("v", F.lit("z")), ["k"], Merge(INSERT_ONLY))
    assert sorted(map(tuple, store.read("t").collect())) == first
    for bad in (s.union(s), s.withColumn("k", F.lit(None).cast("int"))):
        with pytest.raises(contracts.ContractError):
            store.merge("t", bad, ["k"])
    with pytest.raises(contracts.ContractError):
        store.merge("t", s.withColumn("extra", F.lit(1)), ["k"])
    store.ensure("t", s.withColumn("extra", F.lit(1)).schema)
    assert {r["extra"] for r in store.read("t").collect()} == {None}
    with pytest.raises(Conflict):
        store._commit("t", 0, {})


def event_rows(spark, n=40):
    made = spark.range(n).select(
        F.lit("ev").alias("kafka_topic"), (F.col("id") % 2).cast("int").alias("kafka_partition"), F.col("id").alias("kafka_offset"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("event_timestamp"),
        F.concat(F.lit("U"), F.col("id") % 3).alias("user_id"), F.when(F.col("id") % 10 == 9, "").otherwise(F.concat(F.lit("S"), F.col("id") % 4)).alias("session_id"), F.lit("Page View").alias("event_type"),
        F.lit("iOS").alias("device_type"), F.timestamp_seconds(F.lit(1_700_100_000)).alias("bronze_ingestion_timestamp"),
    )
    return made.union(made.where("kafka_offset = 3"))


def test_event_day_reruns_equal(spark, tmp_path):
    store, day = Store(spark, f"file://{tmp_path}/s"), date(2023, 11, 14)
    counts = silver.run_events(store, event_rows(spark), day, ts("2023-11-15 01:00:00"))
    assert counts["raw_count"] == counts["rejected_count"] + counts["processable_count"] == 41 and counts["rejected_count"] == 5
    tables = ("fact_events", "dim_session", "dim_device", "dim_event_type", "event_quarantine")
    before = {t: sorted(map(str, store.read(t).collect())) for t in tables}
    silver.run_events(store, event_rows(spark), day, ts("2023-11-15 01:00:00"))
    assert before == {t: sorted(map(str, store.read(t).collect())) for t in tables}
    assert store.read("fact_events").columns == events._FACT and len(events._FACT) == 44
    assert gold.run_behavioral(store, day, ts("2023-11-15 02:00:00")) == 36
    assert store.read("behavioral_obt").columns == contracts.BEHAVIORAL_OBT and len(contracts.BEHAVIORAL_OBT) == 52
    assert backfill.backfill(store, day, day, lambda d: None) == {day: "skipped"}
    assert silver.run_events(store, event_rows(spark, 0), date(2023, 11, 16), ts("2023-11-17 01:00:00"))["raw_count"] == 0
    assert backfill.status_of(store, date(2023, 11, 16)) == "EMPTY"


def test_transactional_day(spark, tmp_path):
    t = "2024-03-05 20:30:00"
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl).withColumns({"_kafka_topic": F.lit("x"), "_kafka_partition": F.lit(0), "_kafka_offset": F.monotonically_increasing_id(), "_kafka_timestamp": F.lit(t)})
    raw = {
        "categories": frame([("C1", "books", None)], "category_id string, name string, parent_category_id string"),
        "users": frame([("U1", "n", "a@b.co", "2020-01-01")], "user_id string, username string, email string, signup_date string"),
        "products": frame([("P1", "p", "9.50", "Books")], "product_id string, name string, price string, category string"),
        "orders": frame([("O1", "U1", t, "19.00", "Completed")], "order_id string, user_id string, event_timestamp string, total string, status string"),
        "order_items": frame([("OI1", "O1", "P1", "2", "9.50"), ("OI2", "O9", "P1", "1", "9.50")], "order_item_id string, order_id string, product_id string, quantity string, unit_price string"),
        "product_price_history": frame([("PH1", "P1", "9.00", "2024-01-01 00:00:00")], "price_history_id string, product_id string, price string, valid_from_timestamp string"),
    }
    store = Store(spark, f"file://{tmp_path}/s")
    silver.run_transactional(store, raw, ts("2024-03-06 01:00:00"))
    silver.run_transactional(store, raw, ts("2024-03-07 01:00:00"))
    item = store.read("fact_order_item").collect()
    assert len(item) == 1 and str(item[0]["price_difference"]) == "0.50" and item[0]["silver_created_at"] == ts("2024-03-06 01:00:00")
    assert store.read("transactional_issues").where("array_contains(validation_errors, 'MISSING_PARENT_ORDER')").count() == 1
    assert gold.run_transactional(store, date(2024, 3, 5)) == 1
    row = store.read("transactional_obt").first()
    assert row["category_name"] == "Books" and len(store.read("transactional_obt").columns) == 35


def zigzag(n):
    n, out = (n << 1) ^ (n >> 63), b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


SCHEMA = json.dumps({"type": "record", "name": "e", "fields": [{"name": "event_id", "type": ["null", "string"]}, {"name": "user_id", "type": "string"}, {"name": "session_id", "type": "string"}, {"name": "event_type", "type": "string"}, {"name": "device", "type": "string"}, {"name": "timestamp", "type": "string"}, {"name": "quantity", "type": ["null", "int"]}, {"name": "cart_value", "type": "double"}, {"name": "tags", "type": {"type": "array", "items": "long"}}]})  # noqa: E501


def message(i, magic=0, schema_id=7, cut=0):
    text = lambda s: zigzag(len(s.encode())) + s.encode()
    body = zigzag(0) + text(f"U{i}") + text("S1") + text(" Page_View ") + text(" iOS") + text("2024-01-01T10:00:00+00:00") + zigzag(1) + zigzag(-i) + struct.pack("<d", 1.5) + zigzag(2) + zigzag(i) + zigzag(300) + zigzag(0)
    data = bytes([magic]) + struct.pack(">i", schema_id) + body
    return data[: len(data) - cut] if cut else data


def records(spark):
    rows = [(None, message(1), "ev", 0, 1), (None, message(2, magic=1), "ev", 0, 2), (None, b"\0\0", "ev", 0, 3), (None, message(4, schema_id=9), "ev", 0, 4), (None, message(5, cut=3), "ev", 0, 5), (None, None, "ev", 0, 6)]
    rows = [(*r, ts("2024-01-01 10:00:05")) for r in rows]
    return spark.createDataFrame(rows, contracts.KAFKA_RECORD)


def test_avro_flags(spark):
    got = {r["offset"]: r for r in avro.decode(records(spark), SCHEMA, 7).collect()}
    assert [got[i]["decode_error"] for i in range(1, 7)] == [None, "invalid_magic_byte", "message_too_short", "schema_id_mismatch", "avro_decode_failed", "avro_decode_failed"]
    assert got[1]["user_id"] == "U1" and got[1]["quantity"] == -1 and got[1]["tags"] == [1, 300] and got[4]["user_id"] is None


def test_stream_equals_batch(spark, tmp_path):
    at = F.lit("2024-01-02").cast("timestamp")
    records(spark).write.parquet(f"{tmp_path}/in")
    batch = bronze.bronze_events(records(spark), SCHEMA, 7, at)
    live = kafka_shape.read_topic(spark, "ev", directory=f"{tmp_path}/in")
    q = bronze.write_stream(bronze.bronze_events(live, SCHEMA, 7, at), f"{tmp_path}/out", f"{tmp_path}/ck", ["year", "month", "day"], "bronze_events")
    bronze.await_all([q], 120)
    assert q.exception() is None
    assert batch.columns[: len(bronze.LINEAGE)] == bronze.LINEAGE and "device" not in batch.columns
    first = batch.where("kafka_offset = 1").first()
    assert first["event_timestamp"] == ts("2024-01-01 10:00:00") and first["kafka_timestamp"] == ts("2024-01-01 10:00:05") and first["is_valid"]
    second = batch.where("kafka_offset = 5").first()["validation_errors"]
    assert second == [f"missing_{c}" for c in ("timestamp", "user_id", "event_type", "device_type", "session_id")] + ["invalid_event_timestamp", "avro_decode_failed"]
    pick = ["kafka_offset", "event_id", "event_type", "device_type", "is_valid", "validation_errors"]
    out = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, out.select(*pick).collect())) == sorted(map(str, batch.select(*pick).collect()))
    one = out.where("kafka_offset = 1").first()
    assert one["is_valid"] and one["device_type"] == "ios" and one["event_type"] == "page_view"


def test_undated_rows_are_kept(spark):
    schema = json.dumps({"type": "record", "name": "c", "fields": [{"name": "category_id", "type": "string"}, {"name": "name", "type": "string"}]})
    value = b"\0" + struct.pack(">i", 3) + zigzag(2) + b"C1" + zigzag(1) + b"x"
    raw = spark.createDataFrame([(None, value, "c", 0, 1, None)], contracts.KAFKA_RECORD)
    row = bronze.bronze_transactional(raw, "categories", schema, 3, F.lit("2024-01-01").cast("timestamp")).first()
    assert row["category_id"] == "C1" and row["partition_date"] == bronze.UNDATED


def test_partition_policy():
    have = ["19700101", "20240101", "20240102", "20240103", "20240105"]
    assert partitions.resolve("categories", "20240104", have) == ["20240103"]
    assert partitions.resolve("users", "20240102", have) == ["19700101", "20240101", "20240102"]
    assert partitions.resolve("orders", "20240102", have) == ["19700101", "20240101", "20240102", "20240103"]
    assert partitions.resolve("order_items", "20240102", have, window=0) == ["20240102"]
    with pytest.raises(contracts.ContractError):
        partitions.resolve("orders", "2024-01-02", have)


def test_schema_drift_and_business_day(spark, tmp_path):
    root = f"{tmp_path}/bronze"
    row = lambda oid, when: spark.sql(f"select '{oid}' order_id, 'U1' user_id, timestamp'{when}' event_timestamp, 'done' status, 'o' _kafka_topic, 0 _kafka_partition, {oid[1:]}L _kafka_offset, timestamp'{when}' _kafka_timestamp")
    row("O1", "2024-01-01 21:00:00").withColumn("total", F.lit(1.5)).write.parquet(f"{root}/orders/20240101")
    row("O2", "2024-01-02 10:00:00").withColumn("total", F.lit("2.50").cast("decimal(18,2)")).write.parquet(f"{root}/orders/20240102")
    out = partitions.read_bronze(spark, f"file://{root}", "orders", "20240102", zone="Asia/Tehran")
    assert {r["order_id"]: str(r["total"]) for r in out.collect()} == {"O1": "1.50", "O2": "2.50"}
    assert [r["order_id"] for r in partitions.read_bronze(spark, f"file://{root}", "orders", "20240101").collect()] == ["O1"]


def test_registry(tmp_path):
    (tmp_path / "s-value.json").write_text(json.dumps({"schema": {"type": "string"}, "id": 4}))
    found = registry.FileRegistry(str(tmp_path)).latest("s-value")
    assert found.schema_id == 4 and json.loads(found.schema) == {"type": "string"}
    with pytest.raises(ValueError):
        registry.check_topics({"a": "t", "b": "t"}, {"a": "x", "b": "y"}, ["a", "b"])


def test_migration(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    raw = events.align(event_rows(spark, 20).dropDuplicates(["kafka_offset"]))
    key, _ = keys.event_identity(raw)
    fact = raw.select(F.when(F.col("kafka_offset") < 5, F.concat(F.lit("old-"), F.col("kafka_offset"))).otherwise(key).alias("event_key"), "kafka_topic", "kafka_partition", "kafka_offset")
    store.ensure("f", fact.schema)
    store.merge("f", fact, ["event_key"])
    assert migrate.migrate(store, "f", raw).stale == 5 and store.read("f").where("event_key like 'old-%'").count() == 5
    assert migrate.migrate(store, "f", raw, dry_run=False).holds
    assert store.read("f").where("event_key like 'old-%'").count() == 0 and store.read("f").select("event_key").distinct().count() == 20


def test_realtime_first_reason(spark):
    rows = [("P1", "n", 5, -1, 200), ("P2", "n", -5, 1, 5), ("P3", "n", 5, 1, 5)]
    df = spark.createDataFrame(rows, "product_id string, name string, price int, inventory int, popularity_score int")
    got = {r["product_id"]: (r["validation_error"], r["is_valid"], r["inventory"]) for r in serving.realtime(df, "products").collect()}
    assert got == {"P1": ("negative_inventory", 0, None), "P2": ("negative_price", 0, 1), "P3": (None, 1, 1)}


def test_replacing_a_partition_writes_it_only(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    rows = spark.range(60).select((F.col("id") % 3).cast("int").alias("p"), "id", F.lit(1).alias("v"))
    store.ensure("t", rows.select("p", "id", "v").schema, ["p"], ["id"])
    first = store.replace_partition("t", rows.where("p = 0"), "p", 0)
    for p in (1, 2):
        store.replace_partition("t", rows.where(f"p = {p}"), "p", p)
    files = lambda: {str(f) for f in (tmp_path / "s" / "t").rglob("*.parquet")}
    before = files()
    store.replace_partition("t", rows.where("p = 1").withColumn("v", F.lit(2)), "p", 1)
    assert all("/p=1/" in f for f in files() - before) and len(files()) > len(before)
    assert {(r["p"], r["v"], r["n"]) for r in store.read("t").groupBy("p", "v").agg(F.count(F.lit(1)).alias("n")).collect()} == {(0, 1, 20), (1, 2, 20), (2, 1, 20)}
    assert store.read("t", first).count() == 20
    store.replace_partition("t", rows.where("p > 5"), "p", 2)
    assert store.read("t").count() == 40
    store.merge("t", spark.createDataFrame([(0, 0, 9), (7, 99, 9)], "p int, id long, v int"), ["id"], Merge())
    assert {r["v"] for r in store.read("t").where("id in (0, 99)").collect()} == {9} and store.read("t").count() == 41


def test_merges_write_touched_folders_only(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    at = F.timestamp_seconds(F.col("id") * 43_200)
    rows = spark.range(8).select("id", at.alias("t"), F.lit(1).alias("v"))
    store.ensure("t", rows.schema, ["days(t)", "bucket(2, id)"])
    store.merge("t", rows, ["id"], Merge(INSERT_ONLY))
    files = lambda: {str(f) for f in (tmp_path / "s" / "t").rglob("*.parquet")}
    old = files()
    assert all("/t_day=1970-01-0" in f and "/id_bucket=" in f for f in old) and store.read("t").columns == ["id", "t", "v"]
    # insert-only adds what is new
    store.merge("t", spark.range(6, 10).select("id", at.alias("t"), F.lit(5).alias("v")), ["id"], Merge(INSERT_ONLY))
    added = files() - old
    assert added and all("t_day=1970-01-05" in f for f in added)
    assert sorted((r["id"], r["v"]) for r in store.read("t").collect()) == [(i, 1 if i < 8 else 5) for i in range(10)]
    # an update moves a row to another day and rewrites its old day and no other
    before = files()
    store.merge("t", spark.createDataFrame([(0, ts("1970-01-20 00:00:00"), 7)], "id long, t timestamp, v int"), ["id"], Merge())
    assert {f.split("t_day=")[1][:10] for f in files() - before} <= {"1970-01-01", "1970-01-20"}
    got = {r["id"]: (r["t"], r["v"]) for r in store.read("t").collect()}
    assert len(got) == 10 and got[0] == (ts("1970-01-20 00:00:00"), 7) and got[1][1] == 1
    store.compact("t")
    assert store.read("t").count() == 10
    with pytest.raises(contracts.ContractError):
        store.ensure("u", rows.withColumnRenamed("v", "t_day").schema, ["days(t)"])


def test_price_pages(spark):
    """More intervals than a page, checked against the definition."""
    prices = spark.range(kimball.PAGE * 2 + 3).select(F.lit("P").alias("product_id"), F.col("id").alias("n")).select(
        "product_id", F.concat(F.lit("k"), "n").alias("product_price_key"), F.col("n").cast("string").alias("price_history_id"), F.col("n").cast("decimal(18,2)").alias("price"),
        F.timestamp_seconds(F.col("n") * 10).alias("valid_from"), F.when(F.col("n") < kimball.PAGE * 2 + 2, F.timestamp_seconds(F.col("n") * 10 + 10)).alias("valid_to"),
    )
    sales = spark.range(-1, kimball.PAGE * 2 + 6).select("id", F.lit("P").alias("product_id"), F.when(F.col("id") != 7, F.timestamp_seconds(F.col("id") * 10 + 3)).alias("order_timestamp"))
    got = {r["id"]: r["price_history_id"] for r in kimball.price_as_of(sales, prices).collect()}
    last = kimball.PAGE * 2 + 2
    assert got == {i: None if i in (-1, 7) else str(min(i, last)) for i in range(-1, last + 4)}


def test_funnel_chains_minutes_and_ignores_copies(spark):
    import random

    draw, stages, rows = random.Random(5), ("a", "b", "c"), []
    for s in range(60):
        rows += [(f"S{s}", draw.choice(stages), ts("2024-01-01 00:00:00").replace(minute=draw.randrange(4), second=draw.randrange(60)), f"{i}") for i in range(draw.randrange(1, 9))]
    want = {}
    for s in {r[0] for r in rows}:
        depth = 0
        for _, kind, _, _ in sorted((r for r in rows if r[0] == s), key=lambda r: (r[2], r[3])):
            depth += kind == (*stages, None)[depth]
        if depth:
            want[s] = depth
    df = spark.createDataFrame(rows + rows[::3], "session_id string, event_type string, event_timestamp timestamp, event_id string")
    assert {r["session_id"]: r["depth"] for r in reports.funnel_sessions(df, stages=stages).collect()} == want
    assert reports.funnel_sessions(df, stages=stages, on=F.to_date("event_timestamp") == F.lit("2024-01-02").cast("date")).count() == 0


def test_keys_keep_faulty_records_apart(spark):
    same = spark.createDataFrame([(" behavioral.events ", 1, 5, "a"), ("behavioral.events", 1, 5, "b")], "kafka_topic string, kafka_partition int, kafka_offset long, event_type string")
    checked = events.validate_events(same)
    assert checked.rows.select("event_key").distinct().count() == 1  # the topic is trimmed
    issues = events.issue_rows(checked, F.lit("2024-01-01").cast("timestamp"))
    assert issues.select("record_key").distinct().count() == 2 and issues.select("source_table").first()[0] == "behavioral_events"
    assert issues.count() == issues.select("issue_key").distinct().count()
    bare = spark.createDataFrame([("s", "x")], "session_id string, event_type string")
    key, source = keys.event_identity(bare)
    got = bare.select(key.alias("k"), source.alias("s"), F.sha2(F.lit("fallback|s|x").cast("binary"), 256).alias("w")).first()
    assert got["k"] == got["w"] and got["s"] == "fallback_fields"


def test_jobs_from_messages_to_wide_table(spark, tmp_path):
    at = f"file://{tmp_path}"
    (tmp_path / "registry").mkdir()
    (tmp_path / "registry" / "ev-value.json").write_text(json.dumps({"schema": SCHEMA, "id": 7}))
    records(spark).write.parquet(f"{tmp_path}/messages")
    env = {"STRATAFORGE_STORE": f"{at}/store", "STRATAFORGE_BRONZE": "overridden", "STRATAFORGE_REGISTRY": f"{tmp_path}/registry", "STRATAFORGE_SHUFFLE_PARTITIONS": "8"}
    config = jobs.Config.of(env, {"bronze": f"{at}/bronze", "messages": f"{tmp_path}/messages", "checkpoints": f"{at}/checkpoints", "events_topic": "ev", "store": None})
    assert config.shuffle_partitions == 8 and config.bronze == f"{at}/bronze"
    day, now = date(2024, 1, 1), ts("2024-01-02 00:00:00")
    jobs.run(spark, "bronze-events", config)
    assert jobs.run(spark, "backfill-events", config, date(2023, 12, 31), day, now) == {date(2023, 12, 31): "no source", day: "run"}
    assert jobs.run(spark, "events-wide", config, day, now=now) == 1
    row = Store(spark, f"{at}/store").read("behavioral_obt").first()
    assert row["event_timestamp"] == ts("2024-01-01 10:00:00") and row["user_id"] == "U1"
    for bad in ({"STRATAFORGE_SHUFFLE_PARTITIONS": "many"}, {"STRATAFORGE_DATES_FROM": "2040-01-01"}):
        with pytest.raises(contracts.ContractError):
            jobs.Config.of(bad)
    for job, missing in (("events", jobs.Config()), ("serve", config), ("nothing", config)):
        with pytest.raises(contracts.ContractError):
            jobs.run(spark, job, missing, day)


def test_footers_in_tasks(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(3).select(F.col("id").cast("string")).write.parquet(f"{tmp_path}/b")
    files = partitions.parquet_files(spark, [f"file://{tmp_path}/a", f"file://{tmp_path}/b"])
    found = partitions.footers(spark, files)
    assert [f for f, _ in found] == files and len({d for _, d in found}) == 2
    assert partitions.footers(spark, []) == []


def test_transactional_day_reads_raw_rows_once(spark, tmp_path):
    seen, t = spark.sparkContext.accumulator(0), "2024-03-05 20:30:00"
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl).withColumns({"_kafka_topic": F.lit("x"), "_kafka_partition": F.lit(0), "_kafka_offset": F.monotonically_increasing_id(), "_kafka_timestamp": F.lit(t)})

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    raw = {
        "categories": frame([("C1", "books", None)], "category_id string, name string, parent_category_id string"),
        "users": frame([("U1", "n", "a@b.co", "2020-01-01")], "user_id string, username string, email string, signup_date string"),
        "products": frame([("P1", "p", "9.50", "Books")], "product_id string, name string, price string, category string"),
        "orders": frame([("O1", "U1", t, "19.00", "Completed")], "order_id string, user_id string, event_timestamp string, total string, status string"),
        "order_items": frame([("OI1", "O1", "P1", "2", "9.50"), ("OI2", "O9", "P1", "1", "9.50")], "order_item_id string, order_id string, product_id string, quantity string, unit_price string"),
        "product_price_history": frame([("PH1", "P1", "9.00", "2024-01-01 00:00:00")], "price_history_id string, product_id string, price string, valid_from_timestamp string"),
    }
    raw = {k: df.withColumn(df.columns[0], counted(df.columns[0])) for k, df in raw.items()}
    star = silver.run_transactional(Store(spark, f"file://{tmp_path}/s"), raw, ts("2024-03-06 01:00:00"))
    assert seen.value == 7 and star.fact_order_item.count() == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_orders_job_keeps_items_of_equal_offsets(spark, tmp_path):
    """Copies with shifted keys have the offsets of the first."""
    from strataforge import job_queries, queries

    con = duckdb.connect()
    shifts = {"lineitem": ("l_orderkey", "l_partkey", "l_suppkey"), "orders": ("o_orderkey", "o_custkey"), "part": ("p_partkey",), "customer": ("c_custkey",), "nation": ()}
    for t, shifted in shifts.items():
        moved = ", ".join(f"{c} + i * 20000 AS {c}" for c in shifted)
        rows = f"SELECT * REPLACE ({moved}) FROM '/root/testdata/sf0.001/{t}.parquet', range(2) r(i)" if moved else f"SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'"
        con.execute(f"COPY (SELECT {'* EXCLUDE (i)' if moved else '*'} FROM ({rows})) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    found = job_queries.orders_job_tables(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(queries.ORACLE_SQL["orders_job_tables"]).fetchall())
