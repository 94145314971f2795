"""Feeds derived from the star tables, so that every mart can run on them whole.

Each function reads the named columns of one or two tables and gives the staged columns of a
feed. Irregularities (missing keys, restatements, late loads) follow from the rows' own
attributes. The same definitions are written in SQL in ``catalogue.feeds_sql``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import normalised
from ..operators import joins, shaping

MONEY = "decimal(12,2)"

# Last day (inclusive) of each nightly load but the final one.
SHIPMENT_LOADS = ("1997-12-31", "1999-12-31")
DELIVERY_LOADS = ("1997-06-30", "1999-12-31")
ACCOUNT_LOADS = ("2024-01-10", "2024-01-20")
BILLING_LOADS = ("1997-12-31", "1999-12-31")
ROSTER_LOADS = ("1997-02-28", "1999-04-30")
ROSTER_RUNS = ((1, "1997-03-01"), (2, "1999-05-01"), (3, "2001-09-01"))
YEARLY_RUNS = tuple((year, f"{year + 1}-01-01") for year in range(1995, 2002))


class Star:
    """The star tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


def load_number(day: Column, last_days: Sequence[str]) -> Column:
    """1 for days up to the first load's last day, and so on."""
    number = F.lit(len(last_days) + 1)
    for i, last in reversed(list(enumerate(last_days, 1))):
        number = F.when(day <= F.lit(last).cast("date"), i).otherwise(number)
    return number


def priority() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def price() -> Column:
    return F.col("o_totalprice").cast(MONEY)


def order_day() -> Column:
    return F.to_date("o_orderdate")


def customers(s: Star) -> DataFrame:
    return s.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def guest_orders(s: Star) -> DataFrame:
    """Only urgent orders name their customer; pending ones have no amount yet."""
    return s.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderstatus") != "P", price()).alias("amount"),
        F.lower("o_orderstatus").alias("status"),
    )


def nations(s: Star) -> DataFrame:
    return s.nation.join(s.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def customer_attribute(s: Star, orders: DataFrame, attribute: str) -> DataFrame:
    """Orders with one attribute of their customer (or of the customer's nation)."""
    owners = s.customer
    if attribute not in owners.columns:
        owners = owners.join(
            s.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
        )
    return joins.attach(
        orders, owners.select(F.col("c_custkey").alias("o_custkey"), attribute), ["o_custkey"]
    )


def order_export(s: Star) -> DataFrame:
    """Every order once; finished ones a second time, corrected, two days later."""
    first = F.struct(
        F.when(F.col("o_orderstatus") == "F", " Pending")
        .when(F.col("o_orderstatus") == "O", "Completed ")
        .otherwise("CANCELLED")
        .alias("order_status"),
        price().alias("amount_usd"),
        F.expr("o_orderdate + INTERVAL 1 DAY").alias("exported_at"),
    )
    second = F.struct(
        F.lit("completed").alias("order_status"),
        F.when(F.col("o_orderpriority") != "5-LOW", price() + 10).cast(MONEY).alias("amount_usd"),
        F.expr("o_orderdate + INTERVAL 3 DAY").alias("exported_at"),
    )
    sent = F.when(F.col("o_orderstatus") == "F", F.array(first, second)).otherwise(F.array(first))
    return (
        customer_attribute(s, s.orders, "n_name")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("n_name").alias("country_code"),
            F.explode(sent).alias("e"),
        )
        .select("order_id", "country_code", "e.*")
        .withColumn("order_status", normalised(F.col("order_status")))
    )


def country_region(s: Star) -> DataFrame:
    """The analysts have not mapped the Middle East yet."""
    mapped = nations(s).where(F.col("r_name") != "MIDDLE EAST")
    return mapped.select(F.col("n_name").alias("country_code"), F.col("r_name").alias("region"))


def plans(s: Star) -> DataFrame:
    """A plan per nation; in Asia prices are agreed per customer."""
    listed = (F.col("n_nationkey") * 10).cast("decimal(10,2)") + F.lit("9.99").cast("decimal(10,2)")
    return nations(s).select(
        F.col("n_name").alias("plan_code"),
        F.lower("n_name").alias("plan_name"),
        F.col("r_name").alias("tier"),
        F.when(F.col("r_name") != "ASIA", listed).cast("decimal(10,2)").alias("monthly_price_usd"),
    )


def subscriptions(s: Star) -> DataFrame:
    status = (
        F.when(F.col("s_acctbal") < 0, "trialing")
        .when(F.col("s_acctbal") < 3000, "churned")
        .otherwise("active")
    )
    return s.supplier.join(s.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("subscription_id"),
        F.col("n_name").alias("plan_code"),
        status.alias("status"),
    )


def line_id() -> Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def usage_events(s: Star) -> DataFrame:
    return s.lineitem.select(
        line_id().alias("event_id"),
        F.col("l_suppkey").cast("string").alias("subscription_id"),
        F.to_date("l_shipdate").alias("event_date"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int")).alias("units"),
        (F.col("l_returnflag") != "N").alias("is_billable"),
    )


def sellers(s: Star) -> DataFrame:
    """A market per segment; machinery sells in one the contract does not know."""
    segment = F.col("c_mktsegment")
    country = (
        F.when(segment == "AUTOMOBILE", "US")
        .when(segment == "BUILDING", "DE")
        .when(segment == "FURNITURE", "GB")
        .when(segment == "HOUSEHOLD", "PE")
        .otherwise("XX")
    )
    return s.customer.select(
        F.col("c_custkey").alias("seller_id"),
        F.col("c_name").alias("seller_name"),
        country.alias("country"),
    )


def payouts(s: Star) -> DataFrame:
    return s.orders.select(
        F.col("o_orderkey").alias("payout_id"),
        F.col("o_custkey").alias("seller_id"),
        order_day().alias("payout_date"),
        F.when(F.col("o_orderstatus") == "F", "PAID")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("FAILED")
        .alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", "USD").alias("currency"),
        price().alias("payout_amount"),
    )


def payout_lines(s: Star) -> DataFrame:
    """Seventh lines lost their payout; the most discounted ones name one that does not exist."""
    return s.lineitem.select(
        line_id().alias("line_id"),
        F.when(F.col("l_linenumber") == 7, None)
        .when(F.col("l_discount") > 0.095, -1 - F.col("l_orderkey"))
        .otherwise(F.col("l_orderkey"))
        .alias("payout_id"),
        F.when(F.col("l_tax") > 0, "USD").alias("currency"),
        F.col("l_extendedprice").cast(MONEY).alias("line_amount"),
        F.when(F.col("l_returnflag") == "A", "wise")
        .when(F.col("l_returnflag") == "R", "paypal")
        .alias("payment_method"),
    )


def settlement_lines(s: Star) -> DataFrame:
    """Two lines per order that add up to its price; pending orders are one over."""
    hundred = F.lit("100.00").cast(MONEY)
    over = F.when(F.col("o_orderstatus") == "P", F.lit(1)).otherwise(F.lit(0))
    amounts = F.array(hundred, (price() - hundred + over).cast(MONEY))
    return s.orders.select(
        F.col("o_orderkey").alias("payout_id"), F.explode(amounts).alias("line_amount")
    )


def shipments(s: Star) -> DataFrame:
    """State log: in transit on the day, then delivered or cancelled the day after."""
    fields = ("status", "shipping_cost_usd", "updated_at")
    left = (F.lit("IN_TRANSIT"), price(), F.expr("o_orderdate + INTERVAL 6 HOURS"))
    final = F.when(F.col("o_orderstatus") == "F", "DELIVERED").otherwise("CANCELLED")
    done = (
        final,
        (price() + F.lit("1.25").cast(MONEY)).cast(MONEY),
        F.expr("o_orderdate + INTERVAL 31 HOURS"),
    )
    states = [F.struct(*[v.alias(n) for n, v in zip(fields, row)]) for row in (left, done)]
    log = F.when(F.col("o_orderstatus") == "O", F.array(states[0])).otherwise(F.array(*states))
    return (
        s.orders.select(
            F.col("o_orderkey").alias("shipment_id"),
            F.concat(F.lit("WH-"), F.substring("o_orderpriority", 1, 1)).alias("warehouse_code"),
            order_day().alias("ship_date"),
            F.explode(log).alias("e"),
        )
        .select("shipment_id", "warehouse_code", "ship_date", "e.*")
        .withColumn("batch_id", load_number(F.to_date("updated_at"), SHIPMENT_LOADS))
    )


def line_load(last_days: Sequence[str]) -> Column:
    """The load of a child row, by its own date: long before or after its header's."""
    return load_number(F.to_date("l_shipdate"), last_days).alias("batch_id")


def shipment_items(s: Star) -> DataFrame:
    return s.lineitem.select(
        F.col("l_orderkey").alias("shipment_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_quantity") * 0.25).cast("decimal(9,3)").alias("line_weight_kg"),
        line_load(SHIPMENT_LOADS),
    )


def deliveries(s: Star) -> DataFrame:
    """Loaded zero to four days late, by priority."""
    return customer_attribute(s, s.orders, "c_mktsegment").select(
        F.col("o_orderkey").alias("delivery_id"),
        F.col("c_mktsegment").alias("city_code"),
        order_day().alias("delivery_date"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "RETURNED")
        .otherwise("CANCELLED")
        .alias("status"),
        price().alias("payout_base_usd"),
        load_number(F.date_add(order_day(), priority() - 1), DELIVERY_LOADS).alias("batch_id"),
    )


def delivery_adjustments(s: Star) -> DataFrame:
    amount = F.col("l_quantity").cast("decimal(10,2)")
    return s.lineitem.select(
        F.col("l_orderkey").alias("delivery_id"),
        F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("adj_amount_usd"),
        line_load(DELIVERY_LOADS),
    )


def month_load(day: Column) -> Column:
    """Loads of a month share one moment, the first of the next."""
    return F.add_months(F.trunc(day, "month"), 1).cast("timestamp_ntz").alias("loaded_at")


def timed_deliveries(s: Star) -> DataFrame:
    """Deliveries with the moment of their load, zero to four days and up to a month later."""
    late = (F.col("delivery_id") % 5).cast("int")
    return deliveries(s).select("*", month_load(F.date_add("delivery_date", late)))


def timed_adjustments(s: Star) -> DataFrame:
    """Adjustments, loaded long before or after their delivery."""
    amount = F.col("l_quantity").cast("decimal(10,2)")
    return s.lineitem.select(
        F.col("l_orderkey").alias("delivery_id"),
        F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("adj_amount_usd"),
        month_load(F.to_date("l_shipdate")),
    )


def account_versions(s: Star) -> DataFrame:
    """Events other than purchases are changes of the user's state."""
    region = (
        F.when(F.col("value") < 10, "EMEA").when(F.col("value") < 50, "AMER").otherwise("APAC")
    )
    return s.events.where(F.col("event_type") != "purchase").select(
        F.col("user_id").alias("account_id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("account_name"),
        F.col("event_type").alias("contract_tier"),
        region.alias("billing_region"),
        F.when(F.col("event_type") == "error", "CHURNED").otherwise("ACTIVE").alias("account_status"),
        F.col("ts").alias("updated_at"),
        load_number(F.to_date("ts"), ACCOUNT_LOADS).alias("batch_id"),
    )


def account_orders(s: Star) -> DataFrame:
    return s.events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("account_id"),
        F.col("ts").alias("order_ts"),
        F.col("value").cast("decimal(10,2)").alias("order_amount_usd"),
    )


def roster(s: Star, batch: Column) -> DataFrame:
    """Full dumps: a customer is on the roster of a load with its last order of that time."""
    orders = s.orders.withColumn("batch_id", batch)
    latest = shaping.latest_per_key(
        orders, ["o_custkey", "batch_id"], [F.desc("o_orderdate"), F.desc("o_orderkey")]
    )
    band = (
        F.when(F.col("o_totalprice") < 150000, "B1")
        .when(F.col("o_totalprice") < 350000, "B2")
        .otherwise("B3")
    )
    return latest.select(
        F.col("o_custkey").alias("employee_id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("full_name"),
        (priority() - 1).cast("string").alias("department_code"),
        F.col("o_orderstatus").alias("job_title"),
        band.alias("salary_band"),
        F.col("o_orderdate").alias("last_login_at"),
        "batch_id",
    )


def yearly_roster(s: Star) -> DataFrame:
    return roster(s, F.year("o_orderdate"))


def loaded_roster(s: Star) -> DataFrame:
    return roster(s, load_number(order_day(), ROSTER_LOADS))


def departments(s: Star) -> DataFrame:
    return s.region.select(
        F.col("r_regionkey").cast("string").alias("department_code"),
        F.col("r_name").alias("department_name"),
    )


def customer_dump(s: Star, batch: int) -> DataFrame:
    """The customer table as of a load: some moved plan before load 2, some before load 3."""
    moved = F.lit(batch >= 2) & (F.col("c_acctbal") < 0)
    renamed = F.lit(batch >= 3) & (F.col("c_acctbal") > 5000)
    updated = (
        F.when(renamed, "2000-07-04 12:00:00")
        .when(moved, "1998-02-10 10:00:00")
        .otherwise("1994-06-01 00:00:00")
    )
    return s.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(renamed, F.concat("c_name", F.lit(" Ltd"))).otherwise(F.col("c_name")).alias("customer_name"),
        F.when(renamed, "MACHINERY")
        .when(moved, "AUTOMOBILE")
        .otherwise(F.col("c_mktsegment"))
        .alias("plan_code"),
        updated.cast("timestamp_ntz").alias("updated_at"),
    )


def invoices(s: Star) -> DataFrame:
    return s.orders.select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("invoiced_at"),
        load_number(order_day(), BILLING_LOADS).alias("batch_id"),
    )


def invoice_lines(s: Star) -> DataFrame:
    return s.lineitem.select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_extendedprice").cast(MONEY).alias("amount_usd"),
        line_load(BILLING_LOADS),
    )


def invoice_payments(s: Star) -> DataFrame:
    """Nothing for pending orders; the others are paid zero to four days later."""
    return s.orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("invoice_id"),
        price().alias("amount_usd"),
        load_number(F.date_add(order_day(), priority() - 1), BILLING_LOADS).alias("batch_id"),
    )


def merchant_orders(s: Star) -> DataFrame:
    return s.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("merchant_id"),
        F.col("o_orderdate").alias("ordered_at"),
    )


def merchant_payments(s: Star) -> DataFrame:
    number = F.col("l_linenumber")
    method = (
        F.when(number <= 2, "CARD")
        .when(number == 3, "Wallet")
        .when(number == 4, "bank_transfer")
        .when(number == 5, "bnpl")
        .when(number == 6, "")
        .otherwise("gift_card")
    )
    return s.lineitem.select(
        line_id().alias("payment_id"),
        F.col("l_orderkey").alias("order_id"),
        F.nullif(F.lower(method), F.lit("")).alias("payment_method"),
        F.when(F.col("l_linestatus") == "F", "captured").otherwise("failed").alias("status"),
        F.col("l_extendedprice").cast(MONEY).alias("amount_usd"),
        F.col("l_shipdate").alias("paid_at"),
    )


def sales(s: Star) -> DataFrame:
    return s.lineitem.select(
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_orderkey").alias("transaction_id"),
        F.when(F.col("l_discount").between(0.005, 0.015), " GWP ").otherwise("SALE").alias("class"),
    )
