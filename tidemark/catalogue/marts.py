"""The marts that are plain functions of their feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, joins, pivot, shaping
from ..plans import marts
from ..sources import star
from ..sources.star import Star
from .feeds_sql import sql

QUERIES, ORACLES = {}, {}

METHODS = ["card", "wallet", "bank_transfer"]
METHODS_EXTENDED = [*METHODS, "bnpl"]


def query(oracle: str):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(oracle)
        return run

    return register


@query(
    """
    select c_custkey as customer_id, c_name as customer_name,
           cast(count(g.order_id) as bigint) as order_count,
           cast(coalesce(sum(g.amount), 0) as decimal(28,2)) as total_amount
    from customer left join guest_orders g on g.customer_id = c_custkey
    group by 1, 2
    """
)
def customer_order_summary(spark, sf_dir):
    s = Star(spark, sf_dir)
    return marts.customer_orders(star.customers(s), star.guest_orders(s), wide=True)


@query(
    """
    select coalesce(region, 'Unmapped') as region, cast(count(*) as bigint) as total_order_count,
           cast(sum(case when order_status = 'completed' then 1 else 0 end) as bigint)
               as completed_order_count,
           cast(sum(case when order_status = 'completed' then coalesce(amount_usd, 0) else 0 end)
                as decimal(28,2)) as gross_revenue_usd
    from latest_export left join country_region using (country_code)
    group by 1
    """
)
def region_revenue_unmapped(spark, sf_dir):
    s = Star(spark, sf_dir)
    orders = marts.latest_export(star.order_export(s))
    return marts.region_revenue(orders, star.country_region(s), wide=True)


@query(
    """
    select event_id, subscription_id, plan_code, event_date, units
    from usage_events join subscriptions using (subscription_id)
    where is_billable and status = 'active'
    """
)
def billable_events(spark, sf_dir):
    s = Star(spark, sf_dir)
    return marts.billable_usage(star.usage_events(s), star.subscriptions(s))


@query(
    """
    select event_id, subscription_id, plan_code, event_date, units
    from usage_events join subscriptions using (subscription_id)
    where is_billable and status = 'active'
    """
)
def billable_events_hot_keys(spark, sf_dir):
    """The same with a row limit low enough to treat the busier subscriptions apart."""
    s = Star(spark, sf_dir)
    active = star.subscriptions(s).where(F.col("status") == "active")
    events = star.usage_events(s).where(F.col("is_billable"))
    joined = joins.attach(events, active.drop("status"), ["subscription_id"], hot_rows=400)
    return marts.BILLABLE_USAGE.publish(joined)


@query(
    """
    select plan_code, cast(count(*) as bigint) as subscription_count,
           cast(sum(case when status = 'active' then 1 else 0 end) as bigint)
               as active_subscription_count,
           cast(sum(case when status = 'active' then coalesce(n, 0) else 0 end) as bigint)
               as billable_event_count,
           cast(sum(case when status = 'active' then coalesce(u, 0) else 0 end) as bigint)
               as billable_units
    from subscriptions left join (
      select subscription_id, count(*) as n, sum(units) as u from usage_events
      where is_billable group by 1) using (subscription_id)
    group by 1
    """
)
def plan_usage(spark, sf_dir):
    s = Star(spark, sf_dir)
    return marts.plan_usage(star.subscriptions(s), star.usage_events(s), wide=True)


@query(
    """
    select plan_code, plan_name, tier, monthly_price_usd,
           monthly_price_usd is null as is_custom_priced
    from plans
    """
)
def plan_catalogue_view(spark, sf_dir):
    """Published as a view: a price change shows at once, nothing is stored."""
    marts.plan_catalogue(star.plans(Star(spark, sf_dir))).createOrReplaceTempView("plan_catalogue")
    return spark.table("plan_catalogue")


@query(
    """
    select cast(p.seller_id as varchar) as seller_id, c_name as seller_name,
           cast(count(*) as bigint) as payout_count,
           cast(sum(case when status = 'PAID' then 1 else 0 end) as bigint) as paid_payout_count,
           cast(sum(case when status = 'PAID' then payout_amount else 0 end) as decimal(28,2))
               as paid_amount,
           cast(sum(coalesce(n, 0)) as bigint) as line_count
    from payouts p
    left join (select payout_id, count(*) as n from payout_lines where payout_id is not null
               group by 1) l on l.payout_id = p.payout_id
    left join customer on c_custkey = p.seller_id
    group by 1, 2
    """
)
def seller_payouts(spark, sf_dir):
    s = Star(spark, sf_dir)
    return marts.seller_payouts(
        star.sellers(s), star.payouts(s), star.payout_lines(s), wide=True
    )


@query(
    """
    select payout_id, seller_id, payout_amount from payouts p
    where status = 'PAID'
      and not exists (select 1 from payout_lines l where l.payout_id = p.payout_id)
    """
)
def paid_without_lines(spark, sf_dir):
    s = Star(spark, sf_dir)
    paid = star.payouts(s).where(F.col("status") == "PAID")
    failing = checks.without_children(paid, star.payout_lines(s), "payout_id")
    return failing.select("payout_id", "seller_id", "payout_amount")


@query(
    """
    select p.payout_id, payout_amount, cast(line_sum as decimal(28,2)) as line_sum
    from payouts p join (select payout_id, sum(line_amount) as line_sum from settlement_lines
                         group by 1) l on l.payout_id = p.payout_id
    where payout_amount is distinct from line_sum
    """
)
def header_equals_lines(spark, sf_dir):
    s = Star(spark, sf_dir)
    failing = checks.header_not_equal_lines(
        star.payouts(s), star.settlement_lines(s), "payout_id", "payout_amount", "line_amount"
    )
    return failing.select(
        "payout_id", "payout_amount", F.col("line_sum").cast("decimal(28,2)").alias("line_sum")
    )


@query(
    """
    select payment_id, cast(order_id as varchar) as order_id,
           cast(merchant_id as varchar) as merchant_id, order_month, payment_method,
           cast(amount_usd as decimal(10,2)) as amount_usd
    from captured
    """
)
def captured_payments(spark, sf_dir):
    s = Star(spark, sf_dir)
    return marts.captured_payments(star.merchant_payments(s), star.merchant_orders(s))


def _pivot_sql(methods):
    listed = ", ".join(f"'{m}'" for m in methods)
    tests = {m: f"payment_method = '{m}'" for m in methods}
    tests["other"] = f"(payment_method is null or payment_method not in ({listed}))"
    cells = ",".join(
        f"""cast(coalesce(c.{m}_order_count, 0) as bigint) as {m}_order_count,
            cast(coalesce(c.{m}_amount_usd, 0) as decimal(28,2)) as {m}_amount_usd"""
        for m in tests
    )
    sums = ",".join(
        f"""count(distinct case when {t} then order_id end) as {m}_order_count,
            sum(case when {t} then amount_usd end) as {m}_amount_usd"""
        for m, t in tests.items()
    )
    return f"""
        select cast(s.merchant_id as varchar) as merchant_id, s.order_month,
               cast(s.n as bigint) as order_count,
               cast(coalesce(c.total, 0) as decimal(28,2)) as captured_amount_usd, {cells}
        from (select o_custkey as merchant_id,
                     cast(date_trunc('month', o_orderdate) as date) as order_month, count(*) as n
              from orders group by 1, 2) s
        left join (select merchant_id, order_month, sum(amount_usd) as total, {sums}
                   from captured group by 1, 2) c
          on c.merchant_id = s.merchant_id and c.order_month = s.order_month"""


def _payments_pivot(spark, sf_dir, methods):
    s = Star(spark, sf_dir)
    return marts.merchant_month_payments(
        star.merchant_orders(s), star.merchant_payments(s), methods, wide=True
    )


@query(_pivot_sql(METHODS))
def payments_pivot(spark, sf_dir):
    return _payments_pivot(spark, sf_dir, METHODS)


@query(_pivot_sql(METHODS_EXTENDED))
def payments_pivot_extended(spark, sf_dir):
    """The same call with one more listed method: two more columns, no other change."""
    return _payments_pivot(spark, sf_dir, METHODS_EXTENDED)


@query(
    """
    select cast(merchant_id as varchar) as merchant_id, order_month, payment_method,
           cast(count(distinct order_id) as bigint) as order_count,
           cast(sum(amount_usd) as decimal(28,2)) as amount_usd
    from captured group by 1, 2, 3
    """
)
def payments_long(spark, sf_dir):
    s = Star(spark, sf_dir)
    return pivot.long_metrics(
        marts.captured_payments(star.merchant_payments(s), star.merchant_orders(s)),
        "order_id",
        ["merchant_id", "order_month"],
        "payment_method",
        "amount_usd",
    )


@query(
    f"""
    select cast(merchant_id as varchar) as merchant_id, order_month,
           cast(sum(amount_usd) as decimal(28,2)) as captured_amount_usd,
           cast(sum(case when payment_method in ({", ".join(f"'{m}'" for m in METHODS)})
                    then amount_usd else 0 end) as decimal(28,2)) as parts_usd
    from captured group by 1, 2
    having sum(case when payment_method is null then 1 else 0 end) > 0
        or sum(case when payment_method not in ({", ".join(f"'{m}'" for m in METHODS)})
               then 1 else 0 end) > 0
    """
)
def pivot_parts_equal_total(spark, sf_dir):
    """The partition check on a pivot whose ``other`` amount was lost (set to zero): it must
    report exactly the merchant-months that had any."""
    broken = _payments_pivot(spark, sf_dir, METHODS).withColumn(
        "other_amount_usd", F.lit(0).cast("decimal(28,2)")
    )
    failing = pivot.parts_not_equal_total(broken, METHODS)
    parts = sum((F.col(f"{m}_amount_usd") for m in METHODS), F.lit(0))
    return failing.select(
        "merchant_id",
        "order_month",
        "captured_amount_usd",
        parts.cast("decimal(28,2)").alias("parts_usd"),
    )


@query(
    """
    select customer_id, engaged_rate from (
      select l_suppkey as customer_id, count(distinct l_orderkey) as n,
             cast(floor((count(distinct case when l_discount between 0.005 and 0.015 then l_orderkey end) * 20000
                   + count(distinct l_orderkey)) // (2 * count(distinct l_orderkey)))
                  as decimal(18,2)) as hundredths,
             cast(hundredths / 100 as decimal(7,2)) as engaged_rate
      from lineitem group by 1)
    where n >= 10 and engaged_rate >= 10
    """
)
def engagement_rate(spark, sf_dir):
    return marts.engagement(star.sales(Star(spark, sf_dir)), "GWP")


@query(
    """
    select p_partkey as sku, p_name as part_name from part
    where p_partkey in (
      select l_partkey from lineitem group by 1 having count(distinct l_orderkey) >= 25)
    """
)
def semi_join_busy_parts(spark, sf_dir):
    """Parts sold in at least 25 orders: a key filter by subquery."""
    s = Star(spark, sf_dir)
    per_part = s.lineitem.select("l_partkey", "l_orderkey").distinct().groupBy("l_partkey").count()
    busy = per_part.where(F.col("count") >= 25).select(F.col("l_partkey").alias("p_partkey"))
    return s.part.join(busy, "p_partkey", "left_semi").select(
        F.col("p_partkey").alias("sku"), F.col("p_name").alias("part_name")
    )


@query(
    """
    select c_custkey as customer_id, c_mktsegment as segment,
           coalesce(cast(o.o_orderkey as varchar), 'none') as last_order_id
    from customer left join (
      select o_custkey, o_orderkey,
             row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)
                 as rn
      from orders where o_orderpriority = '1-URGENT') o on o.o_custkey = c_custkey and o.rn = 1
    """
)
def lookup_default(spark, sf_dir):
    """Customers with their last urgent order, or the default where there is none."""
    s = Star(spark, sf_dir)
    last = shaping.latest_per_key(
        s.orders.where(F.col("o_orderpriority") == "1-URGENT"),
        ["o_custkey"],
        [F.desc("o_orderdate"), F.desc("o_orderkey")],
    ).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("last_order_id"),
    )
    people = s.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    return joins.lookup(people, last, "customer_id", "last_order_id", "none")
