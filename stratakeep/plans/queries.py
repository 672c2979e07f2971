"""Registered queries: every operator over the whole given tables.

The tables play the roles of the landed sources: ``events`` is the change
history (cart = user, product or email = event type), ``customer``, ``part``,
``orders`` and ``lineitem`` are entities and relations. ``oracle`` holds the
same queries in SQL. Load times are literals or taken from the data; no result
holds a clock value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakeep.functions.hashing import key_hash, row_hash
from stratakeep.functions.times import convert_unix_time
from stratakeep.operators.business import cart_adds_and_drops, explode_emails, primary_email, primary_email_legacy
from stratakeep.operators.hub import hub_rows
from stratakeep.operators.link import link_rows
from stratakeep.operators.ordered import latest_per_key
from stratakeep.operators.pit import pit_rows
from stratakeep.operators.satellite import (
    batch_delta,
    event_delta,
    link_satellite_rows,
    satellite_rows,
    sequenced_delta,
)
from stratakeep.plans import marts
from stratakeep.plans.job_queries import JOB_QUERIES
from stratakeep.sources.landing import CORRUPT, REASON, read_landing, split_landing
from stratakeep.sources.schemas import DATE
from stratakeep.sources.tables import scratch_path, stage

FIRST_LOAD = "2024-02-01 00:00:00"
SECOND_LOAD = "2024-02-02 00:00:00"
ORDER_SPLIT = "1995-07-01"
EVENT_SPLIT = "2024-01-15"

CUSTOMER_SOURCE = "app_customer_collection"
CART_SOURCE = "app_cart_collection"
ITEM_SOURCE = "app_cart_item_collection"
PRODUCT_SOURCE = "app_product_collection"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size(spark: SparkSession, sf_dir: str, name: str = "events") -> int:
    """Rows of a table, from file metadata."""
    return table(spark, sf_dir, name).count()


def money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# --- fixtures ---------------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("_id"), "c_name", "c_nationkey", "c_mktsegment", money("c_acctbal").alias("c_acctbal")
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user did last: a history that changes with ``event_type``."""
    return table(spark, sf_dir, "events").select(text("user_id").alias("_id"), "event_type", "ts")


def activity_satellite(rows: DataFrame) -> DataFrame:
    return satellite_rows(
        rows, "_id", "user_hash_key", "events", F.col("ts"), described_by=["_id", "event_type"], carried=["ts"]
    ).drop("ts")


def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("cart_id"),
        F.col("event_type").alias("product_id"),
        prop_k().alias("quantity"),
        F.col("ts").alias("added_at_ts"),
        F.when(F.col("value") < 5, F.col("ts")).alias("removed_at_ts"),
    )


def cart_line_satellite(lines: DataFrame) -> DataFrame:
    return link_satellite_rows(
        lines,
        ["cart_id", "product_id"],
        "cart_id_product_id_combined",
        "cart_product_hash_key",
        ITEM_SOURCE,
        F.col("added_at_ts"),
    )


def email_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        text("user_id").alias("customer_id"),
        F.concat(text("user_id"), F.lit("-"), "event_type").alias("_id"),
        F.concat(text("user_id"), F.lit("@"), "event_type", F.lit(".example")).alias("email"),
        (F.col("value") > 50).alias("is_primary"),
        "ts",
    )


def email_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    emails = email_history(spark, sf_dir)
    sat = satellite_rows(
        emails,
        "_id",
        "email_hash_key",
        CUSTOMER_SOURCE,
        F.col("ts"),
        described_by=["_id", "email", "is_primary"],
    )
    link = link_rows(
        emails.select(F.col("customer_id").alias("customer_hash_key"), F.col("_id").alias("email_hash_key")),
        ["customer_hash_key", "email_hash_key"],
        "customer_email_hash_key",
        CUSTOMER_SOURCE,
        ntz(FIRST_LOAD),
    )
    hub = hub_rows(
        emails,
        "customer_id",
        "customer_internal_application_id",
        "customer_hash_key",
        CUSTOMER_SOURCE,
        ntz(FIRST_LOAD),
    )
    return sat, link, hub


def point_satellites(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Purchases at the start of their day, so that several rows of a user
    share one load time; all other events at their own time."""
    events = table(spark, sf_dir, "events").withColumn("customer_hash_key", key_hash("user_id"))
    seen = events.where("event_type <> 'purchase'").withColumn("loaded_at", F.col("ts"))
    bought = events.where("event_type = 'purchase'").withColumn(
        "loaded_at", F.date_trunc("day", "ts").cast("timestamp_ntz")
    )
    return seen, bought


# --- keys, hubs, links ------------------------------------------------------


def hub_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hub_rows(
        customers(spark, sf_dir),
        "_id",
        "customer_internal_application_id",
        "customer_hash_key",
        CUSTOMER_SOURCE,
        ntz(FIRST_LOAD),
    )


def hub_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    names = ("o_custkey", "customer_internal_application_id", "customer_hash_key", CART_SOURCE)
    early = F.col("o_orderdate") < ntz(ORDER_SPLIT)
    known = hub_rows(orders.where(early), *names, ntz(FIRST_LOAD))
    added = hub_rows(orders.where(~early), *names, ntz(SECOND_LOAD), existing=known)
    return known.unionByName(added)


def link_order_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_hash_key"), F.col("l_partkey").alias("product_hash_key")
    )
    return link_rows(
        lines, ["order_hash_key", "product_hash_key"], "order_product_hash_key", ITEM_SOURCE, ntz(FIRST_LOAD)
    )


def link_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user_hash_key"), prop_k().alias("item_hash_key"), "ts"
    )
    names = (["user_hash_key", "item_hash_key"], "user_item_hash_key", "events")
    early = F.col("ts") < ntz(EVENT_SPLIT)
    known = link_rows(pairs.where(early), *names, ntz(FIRST_LOAD))
    added = link_rows(pairs.where(~early), *names, ntz(SECOND_LOAD), existing=known)
    return known.unionByName(added)


# --- satellites -------------------------------------------------------------


def sat_hash_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        text("user_id").alias("_id"),
        "event_type",
        money("value").alias("value"),
        F.when(F.col("value") >= 5, prop_k()).alias("quantity"),
        (F.col("value") > 50).alias("is_primary"),
        "ts",
    )
    described = ["_id", "event_type", "value", "quantity", "is_primary", "ts"]
    return rows.select("event_id", key_hash("_id").alias("user_hash_key"), row_hash(described).alias("hash_diff"))


def sat_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as versions of its state in one batch, in the order
    of their numbers; a state that stays the same is no change."""
    orders = table(spark, sf_dir, "orders").select(
        text("o_custkey").alias("_id"), F.col("o_orderstatus").alias("state"), "o_orderkey"
    )
    rows = satellite_rows(
        orders,
        "_id",
        "customer_hash_key",
        CUSTOMER_SOURCE,
        ntz(FIRST_LOAD),
        described_by=["_id", "state"],
        carried=["o_orderkey"],
    )
    return sequenced_delta(rows, "customer_hash_key", sequence="o_orderkey", rows=size(spark, sf_dir, "orders"))


def sat_batch_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity_satellite(activity(spark, sf_dir))
    early = F.col("loaded_at") < ntz(EVENT_SPLIT)
    return batch_delta(rows.where(~early), "user_hash_key", stored=rows.where(early), rows=size(spark, sf_dir))


def sat_sequenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity_satellite(activity(spark, sf_dir))
    early = F.col("loaded_at") < ntz(EVENT_SPLIT)
    n = size(spark, sf_dir)
    stored = stage(sequenced_delta(rows.where(early), "user_hash_key", rows=n), "stored")
    return stored.unionByName(sequenced_delta(rows.where(~early), "user_hash_key", stored=stored, rows=n))


def _adds_and_drops_satellite(lines: DataFrame, loaded_at: Column, rows: int) -> DataFrame:
    events = cart_adds_and_drops(cart_line_satellite(lines), rows=rows)
    return satellite_rows(
        events, "cart_id_product_id_combined", "cart_product_hash_key", "sat_cart_product", loaded_at
    )


def sat_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, n = cart_lines(spark, sf_dir), size(spark, sf_dir)
    first = _adds_and_drops_satellite(lines.where(F.col("added_at_ts") < ntz(EVENT_SPLIT)), ntz(FIRST_LOAD), n)
    stored = stage(event_delta(first, "cart_product_hash_key"), "stored")
    again = _adds_and_drops_satellite(lines, ntz(SECOND_LOAD), n)
    return stored.unionByName(event_delta(again, "cart_product_hash_key", stored))


def sat_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = link_satellite_rows(
        cart_lines(spark, sf_dir),
        ["cart_id", "product_id"],
        "cart_id_product_id_combined",
        "cart_product_hash_key",
        ITEM_SOURCE,
        ntz(FIRST_LOAD),
        described_by=["cart_id", "product_id", "quantity"],
        carried=["added_at_ts"],
    )
    return sequenced_delta(rows, "cart_product_hash_key", sequence="added_at_ts", rows=size(spark, sf_dir))


def latest_user_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity_satellite(activity(spark, sf_dir))
    return latest_per_key(rows, ["user_hash_key"], ["loaded_at"])


# --- point in time, business rules -----------------------------------------


def pit_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, bought = point_satellites(spark, sf_dir)
    return pit_rows({"sat_seen": seen, "sat_bought": bought}, "customer_hash_key", rows=size(spark, sf_dir))


def email_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with no list, an empty list, one or two nested emails."""
    entry = T.StructType(
        [
            T.StructField("_id", T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("is_primary", T.BooleanType()),
        ]
    )
    first = F.struct(
        F.concat(text("user_id"), F.lit("-"), "event_type").alias("_id"),
        F.concat(text("user_id"), F.lit("@"), "event_type", F.lit(".example")).alias("email"),
        (F.col("value") > 50).alias("is_primary"),
    )
    second = F.struct(
        F.concat(text("user_id"), F.lit("-spare")).alias("_id"),
        F.concat(text("user_id"), F.lit("@spare.example")).alias("email"),
        F.lit(False).alias("is_primary"),
    )
    emails = (
        F.when(F.col("value") < 2, F.lit(None))
        .when(F.col("value") < 5, F.array().cast(T.ArrayType(entry)))
        .when(F.col("value") > 100, F.array(first, second))
        .otherwise(F.array(first))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text("user_id").alias("_id"), emails.alias("emails"))
    return explode_emails(rows, carried=["event_id"])


def primary_email_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary_email(*email_tables(spark, sf_dir))


def primary_email_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary_email_legacy(*email_tables(spark, sf_dir))


def cart_adds_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart_adds_and_drops(cart_line_satellite(cart_lines(spark, sf_dir)), rows=size(spark, sf_dir))


# --- marts ------------------------------------------------------------------


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products are customers' ids; those without events keep one row."""
    hub = hub_rows(
        customers(spark, sf_dir),
        "_id",
        "product_internal_application_id",
        "product_hash_key",
        PRODUCT_SOURCE,
        ntz(FIRST_LOAD),
    )
    rows = table(spark, sf_dir, "events").select(
        text("user_id").alias("_id"),
        F.col("event_type").alias("title"),
        F.upper("event_type").alias("product_type"),
        F.concat(text("user_id"), F.lit(" "), "event_type").alias("description"),
        F.lit(None).cast("string").alias("vendor"),
        text("user_id").alias("store_id"),
        prop_k().alias("inventory"),
        (money("value") * 100).cast("bigint").alias("sale_price_in_cents"),
        F.date_trunc("month", "ts").cast("timestamp_ntz").alias("created_at_ts"),
        F.col("ts").alias("updated_at_ts"),
    )
    described = ["_id", "title"]
    carried = [name for name in rows.columns if name not in described]
    sat = satellite_rows(
        rows, "_id", "product_hash_key", PRODUCT_SOURCE, F.col("updated_at_ts"), described, carried
    )
    n = size(spark, sf_dir)
    history = stage(sequenced_delta(sat, "product_hash_key", rows=n), "history")
    return marts.dim_product(hub, history, rows=n)


def dim_customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, bought = point_satellites(spark, sf_dir)
    collection = seen.select(
        "customer_hash_key",
        "loaded_at",
        F.col("event_type").alias("currency"),
        text("user_id").alias("first_name"),
        text("event_id").alias("last_name"),
        money("value").alias("total_spent"),
        F.col("ts").alias("last_cart_activity_at_ts"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("last_cart_created_at_ts"),
        F.lit(None).cast("timestamp_ntz").alias("log_out_expires_at_ts"),
        F.date_trunc("month", "ts").cast("timestamp_ntz").alias("confirmed_on_ts"),
        F.when(F.col("value") > 50, F.col("ts")).alias("confirmation_token_expires_at_ts"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("created_at_ts"),
        F.col("ts").alias("updated_at_ts"),
    )
    email = bought.select(
        "customer_hash_key",
        "loaded_at",
        F.col("ts").alias("updated_at_ts"),
        F.concat(text("user_id"), F.lit("@"), text("event_id")).alias("primary_email"),
    )
    n = size(spark, sf_dir)
    frames = {"sat_customer_collection": collection, "sat_customer_primary_email": email}
    pit = stage(pit_rows(frames, "customer_hash_key", rows=n), "pit")
    hub = hub_rows(
        customers(spark, sf_dir),
        "_id",
        "customer_internal_application_id",
        "customer_hash_key",
        CUSTOMER_SOURCE,
        ntz(FIRST_LOAD),
    )
    return marts.dim_customer_history(pit, hub, email, collection, sequence="updated_at_ts", rows=n)


def fact_adds_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cart_lines(spark, sf_dir)
    link_cart_product = link_rows(
        lines.select(F.col("cart_id").alias("cart_hash_key"), F.col("product_id").alias("product_hash_key")),
        ["cart_hash_key", "product_hash_key"],
        "cart_product_hash_key",
        ITEM_SOURCE,
        ntz(FIRST_LOAD),
    )
    link_customer_cart = link_rows(
        lines.select(
            F.col("cart_id").alias("cart_hash_key"),
            F.concat(F.lit("owner "), F.substring("cart_id", 1, 1)).alias("customer_hash_key"),
        ),
        ["cart_hash_key", "customer_hash_key"],
        "customer_cart_hash_key",
        CART_SOURCE,
        ntz(FIRST_LOAD),
    )
    events = _adds_and_drops_satellite(lines, ntz(FIRST_LOAD), size(spark, sf_dir))
    return marts.fact_cart_adds_and_drops(events, link_cart_product, link_customer_cart)


# --- landing ----------------------------------------------------------------


def _epoch_ms(name: str) -> Column:
    return F.timestamp_diff("MILLISECOND", ntz("1970-01-01 00:00:00"), F.col(name))


def _date_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(_epoch_ms("ts").alias("$date")).alias("created_at"),
        F.when(F.col("value") > 50, F.struct(_epoch_ms("ts").alias("$date"))).alias("updated_at"),
    )


def unix_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_unix_time(_date_structs(spark, sf_dir), ["created_at", "updated_at", "removed_at"])


def unix_time_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_unix_time(_date_structs(spark, sf_dir), ["created_at", "updated_at", "removed_at"], legacy=True)


LANDED = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("created_at", DATE),
    ]
)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines and read by the landing reader. Lines of
    events with a value under 5 are cut short; over 200 they lack the key."""
    line = F.to_json(
        F.struct(
            F.when(F.col("value") <= 200, text("user_id")).alias("_id"),
            "event_id",
            "event_type",
            prop_k().alias("quantity"),
            F.struct(_epoch_ms("ts").alias("$date")).alias("created_at"),
        )
    )
    lines = table(spark, sf_dir, "events").select(line.alias("line"), "value")
    cut = F.when(F.col("value") < 5, F.expr("left(line, length(line) - 4)")).otherwise(F.col("line"))
    path = scratch_path(spark, "landing")
    lines.select(cut.alias("line")).write.text(path)
    return stage(read_landing(spark, path, LANDED), "landed")


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_landing(_landed(spark, sf_dir), ["_id"])
    typed = convert_unix_time(good, ["created_at"])
    return typed.select("_id", "event_id", "event_type", "quantity", "created_at_ts")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = split_landing(_landed(spark, sf_dir), ["_id"])
    return rejects.select(REASON, CORRUPT, "event_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hub_customer": hub_customer,
    "hub_incremental": hub_incremental,
    "link_order_product": link_order_product,
    "link_incremental": link_incremental,
    "sat_hash_diff": sat_hash_diff,
    "sat_customer": sat_customer,
    "sat_batch_delta": sat_batch_delta,
    "sat_sequenced": sat_sequenced,
    "sat_event": sat_event,
    "sat_link": sat_link,
    "latest_per_key": latest_user_event,
    "pit_customer": pit_customer,
    "unix_time": unix_time,
    "unix_time_legacy": unix_time_legacy,
    "ingest_json": ingest_json,
    "ingest_rejects": ingest_rejects,
    "email_explode": email_explode,
    "primary_email": primary_email_rule,
    "primary_email_legacy": primary_email_literal,
    "cart_adds_drops": cart_adds_drops,
    "dim_product": dim_product,
    "dim_customer_history": dim_customer_history,
    "fact_adds_drops": fact_adds_drops,
    **JOB_QUERIES,
}
