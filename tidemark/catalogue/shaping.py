"""Staging, scalar expressions, joins and latest-row queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import joins, shaping
from ..plans import marts
from ..sources import feeds, star
from ..sources.feeds import FeedSpec, Field, SourceSpec
from ..sources.star import Star
from .feeds_sql import sql

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(oracle)
        return run

    return register


ORDERS = FeedSpec(
    "orders",
    (
        Field("o_orderkey", "order_id", "bigint"),
        Field("o_custkey", "customer_id", "string"),
        Field("o_orderstatus", "order_status", "string", scalars.normalised),
        Field("o_totalprice", "amount_usd", "decimal(12,2)"),
        Field("o_orderdate", "ordered_on", "date"),
    ),
)


@query(
    """
    select o_orderkey as order_id, cast(o_custkey as varchar) as customer_id,
           lower(trim(o_orderstatus)) as order_status,
           cast(o_totalprice as decimal(12,2)) as amount_usd,
           cast(o_orderdate as date) as ordered_on
    from orders
    """
)
def stage_typed(spark, sf_dir):
    return feeds.stage(Star(spark, sf_dir).orders, ORDERS)


@query(
    """
    select o_orderkey as order_id,
           nullif(lower(trim(substr(o_orderpriority, 2))), '-low') as priority_text,
           coalesce(case when o_orderstatus <> 'P' then o_totalprice end, 0) is not null as has_amount,
           coalesce(case when o_orderstatus = 'F' then 'Done' end, 'Unmapped') as state,
           case when o_orderpriority = '1-URGENT' then 'now' when o_orderpriority = '2-HIGH'
                then 'soon' else 'later' end as urgency,
           case when o_orderstatus <> 'P' then o_totalprice end is null as is_unpriced,
           (case when o_orderpriority <> '5-LOW' then o_orderpriority end is null
            or o_orderpriority not in ('1-URGENT', '2-HIGH')) as is_other,
           cast(o_orderdate as date) as order_date,
           cast(date_trunc('month', o_orderdate) as date) as order_month,
           cast(cast(o_orderdate as date) - 4 as date) as window_start,
           cast(null as date) as no_date, date '1900-01-01' as sentinel,
           strftime(o_orderdate, '%Y-%m-%d') as date_text,
           concat('C', cast(o_custkey as varchar)) as customer_ref,
           cast(abs(cast(o_totalprice as decimal(12,2)) - 250000) as decimal(12,2)) as distance,
           cast(round(cast(o_totalprice as decimal(12,2)), 1) as decimal(12,1)) as rounded,
           o_totalprice >= 250000 as is_large
    from orders
    """
)
def scalar_projection(spark, sf_dir):
    amount = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    label = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    exact = F.col("o_totalprice").cast("decimal(12,2)")
    text = scalars.normalised(F.expr("substr(o_orderpriority, 2)"))
    return Star(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.nullif(text, F.lit("-low")).alias("priority_text"),
        F.coalesce(amount, F.lit(0)).isNotNull().alias("has_amount"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", "Done"), F.lit("Unmapped")).alias("state"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "now")
        .when(F.col("o_orderpriority") == "2-HIGH", "soon")
        .otherwise("later")
        .alias("urgency"),
        amount.isNull().alias("is_unpriced"),
        scalars.not_listed(label, ["1-URGENT", "2-HIGH"]).alias("is_other"),
        F.to_date("o_orderdate").alias("order_date"),
        scalars.month_start(F.col("o_orderdate")).alias("order_month"),
        F.date_sub(F.to_date("o_orderdate"), 4).alias("window_start"),
        F.lit(None).cast("date").alias("no_date"),
        F.lit("1900-01-01").cast("date").alias("sentinel"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_ref"),
        F.abs(exact - 250000).cast("decimal(12,2)").alias("distance"),
        F.round(exact, 1).cast("decimal(12,1)").alias("rounded"),
        (F.col("o_totalprice") >= 250000).alias("is_large"),
    )


def _nightly_events(spark, sf_dir):
    """Events tagged with the night that delivered them, counted from the new year."""
    night = F.datediff(F.to_date("ts"), F.lit("2023-12-31").cast("date"))
    return Star(spark, sf_dir).events.select(
        "event_id", "user_id", "event_type", "ts", night.alias("batch_id")
    )


@query(
    """
    select event_id, user_id, event_type, ts from events
    where cast(ts as date) - date '2023-12-31' <= 20
    """
)
def batch_upto(spark, sf_dir):
    """All nights up to the 20th (batch number = night of January)."""
    return feeds.batch_upto(_nightly_events(spark, sf_dir), "batch_id", 20)


@query(
    """
    select event_id, user_id, event_type, ts from events
    where cast(ts as date) - date '2023-12-31' = 20
    """
)
def batch_exact(spark, sf_dir):
    return feeds.batch_exact(_nightly_events(spark, sf_dir), "batch_id", 20)


@query(
    "select order_id, country_code, order_status, amount_usd, exported_at from latest_export"
)
def stage_source_latest(spark, sf_dir):
    """The re-sent export reduced to each order's newest row."""
    return marts.latest_export(star.order_export(Star(spark, sf_dir)))


@query(
    """
    select event_id, user_id, event_type, ts, value
    from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
          from events) where rn = 1
    """
)
def latest_per_key(spark, sf_dir):
    events = Star(spark, sf_dir).events.select("event_id", "user_id", "event_type", "ts", "value")
    return shaping.latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    """
    select account_id, account_name, contract_tier, billing_region, account_status, updated_at
    from (select *, row_number() over (partition by account_id order by updated_at desc) as rn
          from account_versions where batch_id <= 2) where rn = 1
    """
)
def latest_per_key_batch(spark, sf_dir):
    """What the second snapshot run sees of the account feed."""
    log = feeds.batch_upto(star.account_versions(Star(spark, sf_dir)), "batch_id", 2)
    return marts.account_feed_latest(log)


@query(
    """
    select source, max_loaded_at,
           case when max_loaded_at is null or age > interval 24 hour then 'error'
                when age > interval 12 hour then 'warn' else 'pass' end as status
    from (select 'app.events' as source, max(ts) as max_loaded_at,
                 timestamp '2024-01-31 18:00:00' - max(ts) as age from events)
    """
)
def source_freshness(spark, sf_dir):
    sources = feeds.Sources(spark)
    sources.declare(SourceSpec("app.events", "ts", 12, 24), f"{sf_dir}/events.parquet")
    return sources.freshness("app.events", datetime(2024, 1, 31, 18))


@query(
    """
    select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as ordered_at,
           cast(o_totalprice as decimal(12,2)) as amount_usd
    from orders order by o_totalprice desc, o_orderkey limit 25
    """
)
def topn_preview(spark, sf_dir):
    """The 25 largest orders: a report, so the limit is the point."""
    largest = shaping.preview(
        Star(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
        25,
    )
    return largest.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"),
        star.price().alias("amount_usd"),
    )


@query(
    """
    select o_orderkey as order_id, o_custkey as customer_id,
           cast(coalesce(n, 0) as bigint) as line_count,
           cast(coalesce(q, 0) as decimal(28,2)) as quantity,
           cast(coalesce(a, 0) as decimal(28,2)) as amount
    from orders left join (
      select l_orderkey, count(*) as n, sum(cast(l_quantity as decimal(12,2))) as q,
             sum(cast(l_extendedprice as decimal(12,2))) as a
      from lineitem group by 1) on l_orderkey = o_orderkey
    """
)
def header_line_rollup(spark, sf_dir):
    """Every order with its lines' totals; orders without lines have zeros."""
    s = Star(spark, sf_dir)
    headers = s.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    lines = s.lineitem.select(F.col("l_orderkey").alias("order_id"), "l_quantity", "l_extendedprice")
    return joins.rollup_left(
        headers,
        lines,
        ["order_id"],
        {
            "line_count": F.count("*"),
            "quantity": F.sum(F.col("l_quantity").cast("decimal(12,2)")),
            "amount": F.sum(F.col("l_extendedprice").cast("decimal(12,2)")),
        },
        {"line_count": "bigint", "quantity": "decimal(28,2)", "amount": "decimal(28,2)"},
    )


@query(
    """
    select n_nationkey as nation_key, n_name as nation_name,
           cast(coalesce(nc, 0) as bigint) as customer_count,
           cast(coalesce(bc, 0) as decimal(28,2)) as customer_balance,
           cast(coalesce(ns, 0) as bigint) as supplier_count,
           cast(coalesce(bs, 0) as decimal(28,2)) as supplier_balance
    from nation
    left join (select c_nationkey, count(*) as nc, sum(cast(c_acctbal as decimal(12,2))) as bc
               from customer group by 1) on c_nationkey = n_nationkey
    left join (select s_nationkey, count(*) as ns, sum(cast(s_acctbal as decimal(12,2))) as bs
               from supplier group by 1) on s_nationkey = n_nationkey
    """
)
def chasm_two_rollups(spark, sf_dir):
    """Two many sides of a nation, each reduced alone, so neither multiplies the other."""
    s = Star(spark, sf_dir)
    nation = s.nation.select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name")
    )
    sides = []
    for table, who in ((s.customer, "customer"), (s.supplier, "supplier")):
        initial = who[0]
        sides.append(
            (
                table.withColumnRenamed(f"{initial}_nationkey", "nation_key"),
                {
                    f"{who}_count": F.count("*"),
                    f"{who}_balance": F.sum(F.col(f"{initial}_acctbal").cast("decimal(12,2)")),
                },
                {f"{who}_count": "bigint", f"{who}_balance": "decimal(28,2)"},
            )
        )
    return joins.rollup_left_many(nation, ["nation_key"], *sides)
