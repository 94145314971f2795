"""Every check of a project's contract over the star feeds: feeds, intermediate frames, stored marts.

The feeds break some rules by nature (line numbers repeat within orders, tiers are regions), so each
suite has something to report besides what must pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks
from ..plans import marts, suites
from ..session import fresh_folder
from ..sources import star
from ..sources.star import Star
from ..sources.store import MartStore
from . import history as histories
from . import incremental
from . import marts as registered
from .feeds_sql import sql
from .marts import METHODS
from .suites_sql import SuiteSql, suites_sql

QUERIES, ORACLES = {}, {}


def query(*oracles: SuiteSql):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(suites_sql(*oracles))
        return run

    return register


def _stored(spark, name: str, mart: DataFrame) -> DataFrame:
    store = MartStore(spark, fresh_folder(spark, "checked"))
    store.write(name, 1, mart)
    return store.read(name)


def _differs(*pairs: tuple[str, str]) -> str:
    """How many of the pairs of totals are unequal."""
    unequal = [f"cast(coalesce(({a}), 0) <> coalesce(({b}), 0) as integer)" for a, b in pairs]
    return f"select {' + '.join(unequal)} as n"


# --- customer orders ------------------------------------------------------------------------

_PEOPLE = """(select c_custkey as customer_id, c_name as customer_name,
                     case when c_acctbal >= 0 then concat(c_name, '@example.com') end as email
              from customer)"""


@query(
    SuiteSql("customers", _PEOPLE).unique("customer_id").present("customer_id", "email"),
    SuiteSql("customer_orders", "guest_orders")
    .unique("order_id")
    .present("order_id")
    .known("customer_id", _PEOPLE),
    SuiteSql("customer_order_summary", f"({registered.ORACLES['customer_order_summary']})")
    .unique("customer_id")
    .present("customer_id", "order_count", "total_amount")
    .known("customer_id", _PEOPLE),
)
def suite_customer_orders(spark, sf_dir):
    s = Star(spark, sf_dir)
    email = F.when(F.col("c_acctbal") >= 0, F.concat("c_name", F.lit("@example.com")))
    people = s.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), email.alias("email")
    )
    orders = star.guest_orders(s)
    mart = _stored(spark, "customer_orders", marts.customer_orders(people, orders, wide=True))
    bound = suites.customer_feeds(people, orders) + suites.customer_orders(mart, people)
    return checks.run_suites(bound, suites.EXPECTED["customer_orders"])


# --- region revenue -------------------------------------------------------------------------


@query(
    SuiteSql("erp.orders", "(select order_id as ORDER_ID, exported_at as EXPORTED_AT from order_export)").present(
        "ORDER_ID", "EXPORTED_AT"
    ),
    SuiteSql("latest_export", "latest_export")
    .unique("order_id")
    .present("order_id", "order_status", "country_code", "exported_at")
    .listed("order_status", "completed", "pending", "cancelled"),
    SuiteSql("country_region", "country_region").unique("country_code").present("country_code", "region"),
    SuiteSql("region_revenue", f"({registered.ORACLES['region_revenue_unmapped']})")
    .unique("region")
    .present("region", "total_order_count", "completed_order_count", "gross_revenue_usd"),
)
def suite_region_revenue(spark, sf_dir):
    s = Star(spark, sf_dir)
    export, lookup = star.order_export(s), star.country_region(s)
    latest = marts.latest_export(export)
    mart = _stored(spark, "region_revenue", marts.region_revenue(latest, lookup, wide=True))
    bound = suites.export_feeds(export, latest, lookup) + suites.region_revenue(mart)
    return checks.run_suites(bound, suites.EXPECTED["region_revenue"])


# --- plan usage -----------------------------------------------------------------------------


@query(
    SuiteSql("plans", "plans")
    .unique("plan_code")
    .present("plan_code", "plan_name", "tier")
    .listed("tier", "entry", "mid", "top"),
    SuiteSql("subscriptions", "subscriptions")
    .unique("subscription_id")
    .present("subscription_id", "plan_code", "status")
    .known("plan_code", "plans")
    .listed("status", "active", "churned", "trialing"),
    SuiteSql("usage_events", "usage_events")
    .unique("event_id")
    .present("event_id", "subscription_id", "is_billable")
    .known("subscription_id", "subscriptions"),
    SuiteSql("billable_usage", f"({registered.ORACLES['billable_events']})")
    .unique("event_id")
    .present("event_id", "plan_code"),
    SuiteSql("plan_usage", f"({registered.ORACLES['plan_usage']})")
    .unique("plan_code")
    .present(
        "plan_code",
        "subscription_count",
        "active_subscription_count",
        "billable_event_count",
        "billable_units",
    ),
    SuiteSql("plan_catalogue", f"({registered.ORACLES['plan_catalogue_view']})")
    .unique("plan_code")
    .present("plan_code", "plan_name", "tier", "is_custom_priced"),
)
def suite_plan_usage(spark, sf_dir):
    s = Star(spark, sf_dir)
    plans, subscriptions, events = star.plans(s), star.subscriptions(s), star.usage_events(s)
    billable = marts.billable_usage(events, subscriptions)
    mart = _stored(spark, "plan_usage", marts.plan_usage(subscriptions, events, wide=True))
    bound = suites.usage_feeds(plans, subscriptions, events, billable)
    bound += suites.plan_usage(mart, marts.plan_catalogue(plans))
    return checks.run_suites(bound, suites.EXPECTED["plan_usage"])


# --- daily shipments ------------------------------------------------------------------------

_LOG = """(select o_orderkey as shipment_id, 'WH-' || substr(o_orderpriority, 1, 1) as warehouse_code,
                  cast(o_orderdate as date) as ship_date, 'IN_TRANSIT' as status,
                  o_totalprice as shipping_cost_usd, o_orderdate + interval 6 hour as updated_at
           from orders
           union all
           select o_orderkey, 'WH-' || substr(o_orderpriority, 1, 1), cast(o_orderdate as date),
                  case o_orderstatus when 'F' then 'DELIVERED' else 'CANCELLED' end,
                  o_totalprice + 1.25, o_orderdate + interval 31 hour
           from orders where o_orderstatus <> 'O')"""
_ITEMS = """(select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as item_id,
                    l_orderkey as shipment_id, l_quantity as quantity,
                    l_quantity * 0.25 as line_weight_kg from lineitem)"""


@query(
    SuiteSql("shipments", _LOG)
    .present("shipment_id", "warehouse_code", "ship_date", "status", "shipping_cost_usd", "updated_at")
    .listed("status", "DELIVERED", "IN_TRANSIT", "CANCELLED"),
    SuiteSql("shipment_items", _ITEMS)
    .unique("item_id")
    .present("item_id", "shipment_id", "quantity", "line_weight_kg")
    .known("shipment_id", _LOG),
    SuiteSql("shipment_totals", "(select * from shipments where status <> 'CANCELLED')")
    .unique("shipment_id")
    .present("shipment_id", "ship_date", "warehouse_code"),
    SuiteSql("daily_shipments", f"({sql(incremental.SHIPMENTS_SQL)})")
    .present(
        "ship_date",
        "warehouse_code",
        "shipment_count",
        "delivered_count",
        "shipping_cost_usd",
        "item_quantity",
        "total_weight_kg",
    )
    .grain("ship_date", "warehouse_code")
    .rows_where("shipment_count_at_least_one", "not coalesce(shipment_count >= 1, false)")
    .rows_where(
        "delivered_not_above_shipments", "not coalesce(delivered_count <= shipment_count, false)"
    ),
)
def suite_daily_shipments(spark, sf_dir):
    s = Star(spark, sf_dir)
    log = star.shipments(s)
    items = s.lineitem.select(
        star.line_id().alias("item_id"),
        F.col("l_orderkey").alias("shipment_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_quantity") * 0.25).cast("decimal(9,3)").alias("line_weight_kg"),
    )
    mart = _stored(spark, "daily_shipments", marts.daily_shipments(log, items, wide=True))
    bound = suites.shipment_feeds(log, items, marts.shipment_totals(log, items))
    return checks.run_suites(bound + suites.daily_shipments(mart), suites.EXPECTED["daily_shipments"])


# --- daily payouts --------------------------------------------------------------------------

_DELIVERIES = "(select *, delivery_date as loaded_at from deliveries)"
_ADJUSTMENTS = """(select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as adjustment_id,
                          l_orderkey as delivery_id, l_quantity as adj_amount_usd,
                          case l_returnflag when 'R' then 'PENALTY' when 'A' then 'TIP' else 'BONUS' end
                              as adj_type
                   from lineitem)"""
_DELIVERY_TOTALS = """(select d.*, coalesce(a.total, 0) as adjustment_total_usd
                       from deliveries d left join (select delivery_id, sum(adj_amount_usd) as total
                         from delivery_adjustments group by 1) a using (delivery_id)
                       where d.status <> 'CANCELLED')"""
_PAYOUTS = f"({sql(incremental.PAYOUTS_SQL)})"


@query(
    SuiteSql("deliveries", _DELIVERIES)
    .unique("delivery_id")
    .present("delivery_id", "city_code", "delivery_date", "status", "payout_base_usd", "loaded_at")
    .listed("status", "COMPLETED", "RETURNED", "CANCELLED"),
    SuiteSql("delivery_adjustments", _ADJUSTMENTS)
    .unique("adjustment_id")
    .present("adjustment_id", "delivery_id", "adj_type", "adj_amount_usd")
    .known("delivery_id", "deliveries")
    .listed("adj_type", "TIP", "SURGE", "PENALTY"),
    SuiteSql("delivery_totals", _DELIVERY_TOTALS)
    .unique("delivery_id")
    .present(
        "delivery_id", "city_code", "delivery_date", "status", "payout_base_usd", "adjustment_total_usd"
    )
    .listed("status", "COMPLETED", "RETURNED"),
    SuiteSql("daily_payouts", _PAYOUTS)
    .present(
        "delivery_date",
        "city_code",
        "delivery_count",
        "completed_count",
        "payout_base_usd",
        "adjustment_total_usd",
        "total_payout_usd",
    )
    .grain("delivery_date", "city_code")
    .rows_where("delivery_count_at_least_one", "not coalesce(delivery_count >= 1, false)")
    .rows_where(
        "completed_not_above_deliveries", "not coalesce(completed_count <= delivery_count, false)"
    )
    .counted(
        "reconciles_with_staging_both_ways",
        f"""select count(*) as n from
              (select delivery_date, city_code, count(*) as c from deliveries
               where status <> 'CANCELLED' group by 1, 2) a
            full join {_PAYOUTS} b using (delivery_date, city_code)
            where a.c is distinct from b.delivery_count""",
    )
    .rows_where(
        "total_is_base_plus_adjustments",
        "not coalesce(total_payout_usd = payout_base_usd + adjustment_total_usd, false)",
    ),
)
def suite_daily_payouts(spark, sf_dir):
    s = Star(spark, sf_dir)
    headers = star.deliveries(s).withColumn("loaded_at", F.col("delivery_date").cast("timestamp_ntz"))
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "PENALTY").when(flag == "A", "TIP").otherwise("BONUS")
    amount = F.col("l_quantity").cast("decimal(10,2)")
    lines = s.lineitem.select(
        star.line_id().alias("adjustment_id"),
        F.col("l_orderkey").alias("delivery_id"),
        kind.alias("adj_type"),
        F.when(flag == "R", -amount).otherwise(amount).alias("adj_amount_usd"),
    )
    mart = _stored(spark, "daily_payouts", marts.daily_payouts(headers, lines, wide=True))
    bound = suites.delivery_feeds(headers, lines, marts.delivery_totals(headers, lines))
    return checks.run_suites(bound + suites.daily_payouts(mart, headers), suites.EXPECTED["daily_payouts"])


# --- accounts -------------------------------------------------------------------------------

_ATTRIBUTED = f"({histories.ORACLES['attributed_facts']})"
_NO_OPEN = """select count(*) as n from (select account_id from account_snapshot group by 1
              having count(*) filter (valid_to is null) <> 1)"""
_WRONG_WINDOW = """select count(*) as n from account_snapshot b
    where valid_to <= valid_from or exists (select 1 from account_snapshot a
      where a.account_id = b.account_id and a.valid_from < b.valid_from
        and (a.valid_to is null or a.valid_to > b.valid_from))"""


@query(
    SuiteSql("account_versions", "account_versions")
    .present(
        "account_id", "account_name", "contract_tier", "billing_region", "account_status", "updated_at"
    )
    .listed("contract_tier", *suites.TIERS)
    .listed("account_status", "ACTIVE", "CHURNED"),
    SuiteSql("account_orders", "account_orders")
    .unique("order_id")
    .present("order_id", "account_id", "order_ts", "order_amount_usd"),
    SuiteSql("account_feed_latest", "(select * from account_snapshot where valid_to is null)")
    .unique("account_id")
    .present("account_id"),
    SuiteSql("accounts_history", "account_snapshot")
    .present("account_id", "contract_tier", "valid_from")
    .listed("contract_tier", *suites.TIERS)
    .counted("exactly_one_open", _NO_OPEN)
    .counted("no_overlap_no_empty", _WRONG_WINDOW),
    SuiteSql("accounts_current", "accounts_now")
    .unique("account_id")
    .present("account_id", "account_name", "contract_tier", "billing_region", "current_since"),
    SuiteSql("orders_attributed", _ATTRIBUTED)
    .unique("order_id")
    .present(
        "order_id",
        "account_id",
        "order_ts",
        "order_amount_usd",
        "tier_at_order",
        "region_at_order",
        "current_tier",
    )
    .listed("tier_at_order", *suites.TIERS, marts.UNKNOWN)
    .counted(
        "reconciles_with_orders",
        f"""select count(*) as n from account_orders o full join {_ATTRIBUTED} a
            on a.order_id = cast(o.order_id as varchar)
            where a.order_amount_usd is distinct from o.order_amount_usd""",
    )
    .counted(
        "unknown_only_without_covering_version",
        f"""select count(*) as n from {_ATTRIBUTED} a where tier_at_order = 'UNKNOWN' and exists (
            select 1 from account_snapshot v where cast(v.account_id as varchar) = a.account_id
              and v.valid_from <= a.order_ts and (v.valid_to is null or a.order_ts < v.valid_to))""",
    )
    .counted(
        "current_tier_matches_dimension",
        f"""select count(*) as n from {_ATTRIBUTED} a left join accounts_now c
            on cast(c.account_id as varchar) = a.account_id
            where a.current_tier is distinct from coalesce(c.contract_tier, 'UNKNOWN')""",
    ),
)
def suite_accounts(spark, sf_dir):
    """Feeds, the history of three runs, and the two tables read from it."""
    s = Star(spark, sf_dir)
    versions, orders = star.account_versions(s), star.account_orders(s)
    latest, history = marts.account_feed_latest(versions), histories.account_history(spark, sf_dir)
    now = marts.accounts_current(history)
    current = _stored(spark, "accounts_current", now.withColumn("account_id", F.col("account_id").cast("bigint")))
    attributed = _stored(spark, "orders_attributed", marts.orders_attributed(orders, history, current))
    bound = suites.account_feeds(versions, orders, latest) + suites.accounts_history(history)
    bound += suites.accounts(current, attributed, orders, history)
    return checks.run_suites(bound, suites.EXPECTED["accounts"])


# --- merchant payments ----------------------------------------------------------------------

_MERCHANT_ORDERS = """(select o_orderkey as order_id, o_custkey as merchant_id, o_orderdate as ordered_at
                       from orders)"""
_PIVOT = f"({registered.ORACLES['payments_pivot']})"
_CELLS = [f"{m}_{c}" for m in [*METHODS, "other"] for c in ("order_count", "amount_usd")]


@query(
    SuiteSql("merchant_orders", _MERCHANT_ORDERS)
    .unique("order_id")
    .present("order_id", "merchant_id", "ordered_at"),
    SuiteSql("merchant_payments", "merchant_payments")
    .unique("payment_id")
    .present("payment_id", "order_id", "status", "amount_usd")
    .known("order_id", _MERCHANT_ORDERS)
    .listed("status", "captured", "failed"),
    SuiteSql("captured_payments", "captured")
    .unique("payment_id")
    .present("payment_id", "order_id", "merchant_id", "order_month", "amount_usd"),
    SuiteSql("merchant_month_payments", _PIVOT)
    .present("merchant_id", "order_month", "order_count", "captured_amount_usd")
    .rows_where("generated_columns_populated", " or ".join(f"{c} is null" for c in _CELLS))
    .rows_where(
        "methods_add_up_to_total",
        "captured_amount_usd <> " + " + ".join(c for c in _CELLS if c.endswith("_amount_usd")),
    )
    .grain("merchant_id", "order_month")
    .counted(
        "totals_tie_out_to_staging",
        _differs(
            (f"select sum(order_count) from {_PIVOT}", "select count(*) from orders"),
            (
                f"select sum(captured_amount_usd) from {_PIVOT}",
                "select sum(amount_usd) from merchant_payments where status = 'captured'",
            ),
        ),
    ),
)
def suite_merchant_payments(spark, sf_dir):
    s = Star(spark, sf_dir)
    orders, payments = star.merchant_orders(s), star.merchant_payments(s)
    captured = marts.captured_payments(payments, orders)
    built = marts.merchant_month_payments(orders, payments, METHODS, wide=True)
    mart = _stored(spark, "merchant_month_payments", built)
    bound = suites.merchant_feeds(orders, payments, captured)
    bound += suites.merchant_month_payments(mart, orders, payments, METHODS)
    return checks.run_suites(bound, suites.EXPECTED["merchant_month_payments"])


# --- employees ------------------------------------------------------------------------------

_DUMP = "(select *, last_login_at as record_updated_at from yearly_roster where batch_id = 2001)"
_DEPARTMENTS = """(select cast(r_regionkey as varchar) as department_code, r_name as department_name
                   from region)"""
_CURRENT = f"({histories.ORACLES['employees_current']})"
_HEADCOUNT = f"({histories.ORACLES['department_headcount']})"


@query(
    SuiteSql("employee_dump", _DUMP)
    .unique("employee_id")
    .present("employee_id", "full_name", "department_code", "job_title", "salary_band", "record_updated_at")
    .known("department_code", _DEPARTMENTS)
    .listed("salary_band", *suites.BANDS),
    SuiteSql("departments", _DEPARTMENTS)
    .unique("department_code")
    .present("department_code", "department_name"),
    SuiteSql("employees_history", "yearly_history")
    .present("employee_id", "department_code", "job_title", "salary_band", "valid_from", "is_deleted")
    .listed("is_deleted", "true", "false")
    .counted(
        "exactly_one_open",
        """select count(*) as n from (select employee_id from yearly_history group by 1
           having count(*) filter (valid_to is null) <> 1)""",
    )
    .counted(
        "no_overlap_no_empty",
        """select count(*) as n from yearly_history b
           where valid_to <= valid_from or exists (select 1 from yearly_history a
             where a.employee_id = b.employee_id and a.valid_from < b.valid_from
               and (a.valid_to is null or a.valid_to > b.valid_from))""",
    )
    .counted(
        "open_versions_match_dump",
        f"""select count(*) as n from
              (select * from yearly_history where valid_to is null and not is_deleted) h
            full join {_DUMP} d on d.employee_id = h.employee_id
            where h.department_code is distinct from d.department_code
               or h.job_title is distinct from d.job_title
               or h.salary_band is distinct from d.salary_band""",
    )
    .counted(
        "no_redundant_versions",
        """select count(*) as n from (
             select (department_code, job_title, salary_band, is_deleted) as now,
                    lag((department_code, job_title, salary_band, is_deleted)) over w as before
             from yearly_history window w as (partition by employee_id order by valid_from))
           where now = before""",
    ),
    SuiteSql("employee_history", f"({histories.ORACLES['employee_history']})").present(
        "employee_id", "valid_from", "is_deleted", "is_current"
    ),
    SuiteSql("employees_current", _CURRENT)
    .unique("employee_id")
    .present("employee_id", "full_name", "department_code", "job_title", "salary_band", "current_since")
    .known("department_code", _DEPARTMENTS)
    .counted(
        "reconciles_with_dump",
        f"""select count(*) as n from {_DUMP} d full join {_CURRENT} c
            on c.employee_id = cast(d.employee_id as varchar)
            where d.employee_id is null or c.employee_id is null""",
    ),
    SuiteSql("department_headcount", _HEADCOUNT)
    .unique("department_code")
    .present("department_code", "department_name", "current_headcount", "terminations_to_date")
    .counted(
        "totals_tie_out",
        _differs(
            (f"select sum(current_headcount) from {_HEADCOUNT}", "select count(*) from employees_now"),
            (
                f"select sum(terminations_to_date) from {_HEADCOUNT}",
                "select count(*) from yearly_history where is_deleted",
            ),
        ),
    ),
)
def suite_employees(spark, sf_dir):
    """The history of seven yearly dumps and what is read from it."""
    s = Star(spark, sf_dir)
    dump = histories.latest_dump(spark, sf_dir).withColumn("record_updated_at", F.col("last_login_at"))
    dump, departments = histories._text_key(dump), star.departments(s)
    history = histories._text_key(histories.yearly_history(spark, sf_dir))
    history = _stored(spark, "employees", history)
    view = marts.employee_history(history)
    current = _stored(spark, "employees_current", marts.employees_current(view, dump))
    headcount = marts.department_headcount(departments, current, view, wide=True)
    bound = suites.employee_feeds(dump, departments) + suites.employees_history(history, view, dump)
    bound += suites.employees(current, headcount, dump, departments, view)
    return checks.run_suites(bound, suites.EXPECTED["employees"])


# --- daily revenue --------------------------------------------------------------------------

_CUSTOMER_DUMP = """(select c_custkey as customer_id, c_name as customer_name,
                            case when c_acctbal > 5000 then 'MACHINERY'
                                 when c_acctbal < 0 then 'AUTOMOBILE' else c_mktsegment end as plan_code,
                            c_custkey as updated_at
                     from customer)"""
_INVOICES = """(select o_orderkey as invoice_id, o_custkey as customer_id, o_orderdate as invoiced_at
                from orders)"""
_LINES = """(select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as line_id,
                    l_orderkey as invoice_id, cast(l_extendedprice as decimal(12,2)) as amount_usd,
                    case l_returnflag when 'A' then 'USAGE' when 'R' then 'SEATS' else 'OTHER' end
                        as line_type
             from lineitem)"""
_PAID = """(select o_orderkey as payment_id, o_orderkey as invoice_id, o_orderdate as paid_at,
                   cast(o_totalprice as decimal(12,2)) as amount_usd
            from orders where o_orderstatus <> 'P')"""
_REVENUE = f"({sql(incremental.REVENUE_SQL)})"


@query(
    SuiteSql("customer_dump", _CUSTOMER_DUMP)
    .unique("customer_id")
    .present("customer_id", "customer_name", "plan_code", "updated_at")
    .listed("plan_code", *suites.PLAN_CODES),
    SuiteSql("invoices", _INVOICES)
    .unique("invoice_id")
    .present("invoice_id", "customer_id", "invoiced_at")
    .known("customer_id", _CUSTOMER_DUMP),
    SuiteSql("invoice_lines", _LINES)
    .unique("line_id")
    .present("line_id", "invoice_id", "amount_usd")
    .known("invoice_id", _INVOICES)
    .listed("line_type", "SUBSCRIPTION", "USAGE", "SEATS"),
    SuiteSql("invoice_payments", _PAID)
    .unique("payment_id")
    .present("payment_id", "invoice_id", "paid_at", "amount_usd")
    .known("invoice_id", _INVOICES),
    SuiteSql("customers_history", "plan_versions")
    .present("customer_id", "plan_code", "valid_from")
    .counted(
        "versions_tile_timelines",
        """select count(*) as n from (select 1 from plan_versions group by customer_id, valid_from
           having count(*) > 1)""",
    ),
    SuiteSql("invoice_revenue", "invoice_revenue")
    .unique("invoice_id")
    .present("invoice_id", "invoice_date", "plan_code", "billed_usd", "collected_usd")
    .listed("plan_code", *suites.PLAN_CODES)
    .counted(
        "reconciles_with_invoices",
        """select count(*) as n from orders full join invoice_revenue on invoice_id = o_orderkey
           where o_orderkey is null or invoice_id is null""",
    )
    .counted(
        "plan_is_latest_version_then",
        """select count(*) as n from (
             select r.plan_code, arg_max(v.plan_code, v.valid_from) as latest
             from invoice_revenue r left join plan_versions v
               on v.customer_id = r.customer_id and v.valid_from <= r.invoiced_at
             group by r.invoice_id, r.plan_code)
           where plan_code is distinct from latest""",
    ),
    SuiteSql("daily_revenue", _REVENUE)
    .present("invoice_date", "plan_code", "invoice_count", "billed_usd", "collected_usd", "outstanding_usd")
    .listed("plan_code", *suites.PLAN_CODES)
    .grain("invoice_date", "plan_code")
    .counted(
        "totals_tie_out_to_staging",
        _differs(
            (f"select sum(invoice_count) from {_REVENUE}", f"select count(*) from {_INVOICES}"),
            (f"select sum(billed_usd) from {_REVENUE}", f"select sum(amount_usd) from {_LINES}"),
            (f"select sum(collected_usd) from {_REVENUE}", f"select sum(amount_usd) from {_PAID}"),
        ),
    ),
)
def suite_daily_revenue(spark, sf_dir):
    """Plan history from all edits; invoices attributed to the plan then."""
    s = Star(spark, sf_dir)

    def text_keys(df):
        return df.withColumns({c: F.col(c).cast("string") for c in ("invoice_id", "customer_id") if c in df.columns})

    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "USAGE").when(flag == "R", "SEATS").otherwise("OTHER")
    customers, invoices = text_keys(star.customer_dump(s, 3)), text_keys(star.invoices(s).drop("batch_id"))
    lines = s.lineitem.select(
        star.line_id().alias("line_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_extendedprice").cast(star.MONEY).alias("amount_usd"),
        kind.alias("line_type"),
    )
    payments = s.orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("invoice_id"),
        star.price().alias("amount_usd"),
        F.col("o_orderdate").alias("paid_at"),
    )
    lines, payments = text_keys(lines), text_keys(payments)
    history = _stored(spark, "customers_history", text_keys(incremental.plan_history(spark, sf_dir)))
    revenue = _stored(
        spark, "invoice_revenue", marts.invoice_revenue(invoices, lines, payments, history, wide=True)
    )
    mart = _stored(spark, "daily_revenue", marts.daily_revenue(revenue, wide=True))
    bound = suites.billing_feeds(customers, invoices, lines, payments)
    bound += suites.customers_history(history)
    bound += suites.daily_revenue(revenue, mart, invoices, lines, payments, history)
    return checks.run_suites(bound, suites.EXPECTED["daily_revenue"])
