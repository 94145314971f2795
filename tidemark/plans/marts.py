"""The marts. Each function takes staged frames and returns the published table.

``since`` on an incremental mart keeps only grain dates from that day on; it is applied to
everything that can be cut without changing a kept row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.scalars import month_start, percent, sum_where
from ..operators import joins, pivot, shaping, snapshot, temporal, upsert
from ..operators.upsert import Window

# --- customer orders ---------------------------------------------------------------------

CUSTOMER_ORDERS = Contract(
    ("customer_id", "int"),
    ("customer_name", "string"),
    ("order_count", "bigint"),
    ("total_amount", "decimal(10,2)"),
)


def customer_orders(customers: DataFrame, orders: DataFrame, wide: bool = False) -> DataFrame:
    """Every customer once, with all its orders; guests' orders belong to nobody."""
    result = joins.rollup_left(
        customers,
        orders,
        ["customer_id"],
        {"order_count": F.count("*"), "total_amount": F.sum("amount")},
        {"order_count": "bigint", "total_amount": "decimal(28,2)"},
    )
    return CUSTOMER_ORDERS.publish(result, wide)


# --- region revenue ----------------------------------------------------------------------

REGION_REVENUE = Contract(
    ("region", "string"),
    ("total_order_count", "bigint"),
    ("completed_order_count", "bigint"),
    ("gross_revenue_usd", "decimal(12,2)"),
)
UNMAPPED = "Unmapped"


def latest_export(staged_export: DataFrame) -> DataFrame:
    """One row per order: its newest export, as a whole."""
    newest = [F.desc("exported_at"), F.desc("order_status"), F.desc("amount_usd")]
    return shaping.latest_per_key(staged_export, ["order_id"], newest)


def region_revenue(orders: DataFrame, country_region: DataFrame, wide: bool = False) -> DataFrame:
    """Orders are added up per country before the lookup, so the join sees few rows."""
    completed = F.col("order_status") == "completed"
    per_country = orders.groupBy("country_code").agg(
        F.count("*").alias("n"),
        F.count_if(completed).alias("n_completed"),
        sum_where(completed, F.col("amount_usd")).alias("revenue"),
    )
    result = (
        joins.lookup(per_country, country_region, "country_code", "region", UNMAPPED, None)
        .groupBy("region")
        .agg(
            F.sum("n").alias("total_order_count"),
            F.sum("n_completed").alias("completed_order_count"),
            F.sum("revenue").alias("gross_revenue_usd"),
        )
    )
    return REGION_REVENUE.publish(result, wide)


# --- plan usage --------------------------------------------------------------------------

BILLABLE_USAGE = Contract(
    ("event_id", "string"),
    ("subscription_id", "string"),
    ("plan_code", "string"),
    ("event_date", "date"),
    ("units", "int"),
)
PLAN_USAGE = Contract(
    ("plan_code", "string"),
    ("subscription_count", "bigint"),
    ("active_subscription_count", "bigint"),
    ("billable_event_count", "bigint"),
    ("billable_units", "int"),
)
PLAN_CATALOGUE = Contract(
    ("plan_code", "string"),
    ("plan_name", "string"),
    ("tier", "string"),
    ("monthly_price_usd", "decimal(10,2)"),
    ("is_custom_priced", "boolean"),
)


def billable_usage(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Billable events of active subscriptions; units stay as they are, missing ones too."""
    active = subscriptions.where(F.col("status") == "active").select("subscription_id", "plan_code")
    billable = events.where(F.col("is_billable"))
    return BILLABLE_USAGE.publish(joins.attach(billable, active, ["subscription_id"]))


def plan_usage(subscriptions: DataFrame, events: DataFrame, wide: bool = False) -> DataFrame:
    """Per plan with subscriptions: their number and the usage of the active ones.

    Events are added up per subscription first: a busy subscription becomes one row, the join
    is one to one, and a plan without usage keeps its row.
    """
    per_subscription = joins.rollup(
        events.where(F.col("is_billable")),
        ["subscription_id"],
        {"n": F.count("*"), "units": F.sum("units")},
    )
    active = F.col("status") == "active"
    result = (
        subscriptions.join(per_subscription, "subscription_id", "left")
        .groupBy("plan_code")
        .agg(
            F.count("*").alias("subscription_count"),
            F.count_if(active).alias("active_subscription_count"),
            sum_where(active, F.col("n")).alias("billable_event_count"),
            sum_where(active, F.col("units")).alias("billable_units"),
        )
    )
    return PLAN_USAGE.publish(result, wide)


def plan_catalogue(plans: DataFrame) -> DataFrame:
    """The whole catalogue; a missing price means the plan is priced per customer."""
    return PLAN_CATALOGUE.publish(
        plans.withColumn("is_custom_priced", F.col("monthly_price_usd").isNull())
    )


# --- seller payouts ----------------------------------------------------------------------

SELLER_PAYOUTS = Contract(
    ("seller_id", "string"),
    ("seller_name", "string"),
    ("payout_count", "bigint"),
    ("paid_payout_count", "bigint"),
    ("paid_amount", "decimal(12,2)"),
    ("line_count", "bigint"),
)


def seller_payouts(
    sellers: DataFrame, payouts: DataFrame, lines: DataFrame, wide: bool = False
) -> DataFrame:
    """Two grains on one row: lines are counted per payout before payouts meet their seller."""
    counted = joins.rollup_left(
        payouts, lines, ["payout_id"], {"n_lines": F.count("*")}, {"n_lines": "bigint"}
    )
    paid = F.col("status") == "PAID"
    per_seller = counted.groupBy("seller_id").agg(
        F.count("*").alias("payout_count"),
        F.count_if(paid).alias("paid_payout_count"),
        sum_where(paid, F.col("payout_amount")).alias("paid_amount"),
        F.sum("n_lines").alias("line_count"),
    )
    named = per_seller.join(sellers.select("seller_id", "seller_name"), "seller_id", "left")
    return SELLER_PAYOUTS.publish(named, wide)


# --- daily warehouse shipments -----------------------------------------------------------

DAILY_SHIPMENTS = Contract(
    ("ship_date", "date"),
    ("warehouse_code", "string"),
    ("shipment_count", "int"),
    ("delivered_count", "int"),
    ("shipping_cost_usd", "decimal(10,2)"),
    ("item_quantity", "int"),
    ("total_weight_kg", "decimal(12,3)"),
)


def shipments_latest(log: DataFrame, since: date | Window | None = None) -> DataFrame:
    """Latest state per shipment, then without the cancelled ones (in this order: a cancelled
    shipment must not fall back to an older state). ``since`` is applied to latest states."""
    newest = [F.desc("updated_at"), F.desc("status"), F.desc("shipping_cost_usd")]
    latest = shaping.latest_per_key(log, ["shipment_id"], newest)
    if since is not None:
        latest = latest.where(upsert.within("ship_date", since))
    return latest.where(F.col("status") != "CANCELLED")


def shipment_totals(log: DataFrame, items: DataFrame, since: date | Window | None = None) -> DataFrame:
    """One row per live shipment with its items added up; headers stay at header grain.

    With ``since``, both feeds are first cut to the ids of shipments that have some state on or
    after it; any shipment whose latest state qualifies is among them."""
    if since is not None:
        recent = log.where(upsert.within("ship_date", since))
        log, items = joins.within_key_range(recent, "shipment_id", log, items)
    return joins.rollup_left(
        shipments_latest(log, since),
        items,
        ["shipment_id"],
        {"item_quantity": F.sum("quantity"), "total_weight_kg": F.sum("line_weight_kg")},
        {"item_quantity": "bigint", "total_weight_kg": "decimal(28,3)"},
    )


def daily_shipments(
    log: DataFrame, items: DataFrame, since: date | Window | None = None, wide: bool = False
) -> DataFrame:
    result = shipment_totals(log, items, since).groupBy("ship_date", "warehouse_code").agg(
        F.count("*").alias("shipment_count"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered_count"),
        F.coalesce(F.sum("shipping_cost_usd"), F.lit(0)).alias("shipping_cost_usd"),
        F.sum("item_quantity").alias("item_quantity"),
        F.sum("total_weight_kg").alias("total_weight_kg"),
    )
    return DAILY_SHIPMENTS.publish(result, wide)


# --- daily city payouts ------------------------------------------------------------------

DAILY_PAYOUTS = Contract(
    ("delivery_date", "date"),
    ("city_code", "string"),
    ("delivery_count", "int"),
    ("completed_count", "int"),
    ("payout_base_usd", "decimal(10,2)"),
    ("adjustment_total_usd", "decimal(10,2)"),
    ("total_payout_usd", "decimal(10,2)"),
)
# A delivery is loaded at most this many days after its date.
DELIVERY_SLA_DAYS = 4


def delivery_totals(
    deliveries: DataFrame, adjustments: DataFrame, since: date | Window | None = None
) -> DataFrame:
    """One row per live delivery with its adjustments added up.

    Write-once feed: cancelled deliveries are filtered, nothing is deduplicated."""
    counted = deliveries.where(F.col("status") != "CANCELLED")
    if since is not None:
        counted = counted.where(upsert.within("delivery_date", since))
        (adjustments,) = joins.within_key_range(counted, "delivery_id", adjustments)
    return joins.rollup_left(
        counted,
        adjustments,
        ["delivery_id"],
        {"adjustment_total_usd": F.sum("adj_amount_usd")},
        {"adjustment_total_usd": "decimal(28,2)"},
    )


def daily_payouts(
    deliveries: DataFrame,
    adjustments: DataFrame,
    since: date | Window | None = None,
    wide: bool = False,
) -> DataFrame:
    result = (
        delivery_totals(deliveries, adjustments, since)
        .groupBy("delivery_date", "city_code")
        .agg(
            F.count("*").alias("delivery_count"),
            F.count_if(F.col("status") == "COMPLETED").alias("completed_count"),
            F.coalesce(F.sum("payout_base_usd"), F.lit(0)).alias("payout_base_usd"),
            F.sum("adjustment_total_usd").alias("adjustment_total_usd"),
        )
        .withColumn("total_payout_usd", F.col("payout_base_usd") + F.col("adjustment_total_usd"))
    )
    return DAILY_PAYOUTS.publish(result, wide)


# --- accounts: current and at the time of an order ----------------------------------------

ACCOUNTS_CURRENT = Contract(
    ("account_id", "string"),
    ("account_name", "string"),
    ("contract_tier", "string"),
    ("billing_region", "string"),
    ("current_since", "timestamp_ntz"),
)
ORDERS_ATTRIBUTED = Contract(
    ("order_id", "string"),
    ("account_id", "string"),
    ("order_ts", "timestamp_ntz"),
    ("order_amount_usd", "decimal(10,2)"),
    ("tier_at_order", "string"),
    ("region_at_order", "string"),
    ("current_tier", "string"),
)
UNKNOWN = "UNKNOWN"
ACCOUNTS_SNAPSHOT = snapshot.SnapshotSpec(
    "accounts", ("account_id",), "timestamp", updated_at="updated_at"
)


def account_feed_latest(versions: DataFrame) -> DataFrame:
    """What a snapshot run sees: the newest version of each account delivered so far."""
    newest = [F.desc("updated_at"), F.desc("contract_tier"), F.desc("billing_region")]
    return shaping.latest_per_key(versions, ["account_id"], newest)


def accounts_current(history: DataFrame) -> DataFrame:
    """Accounts whose open version is active; a churned one has no row."""
    rows = snapshot.current_rows(history, F.col("account_status") == "ACTIVE")
    return ACCOUNTS_CURRENT.publish(rows.withColumn("current_since", F.col("valid_from")))


def orders_attributed(orders: DataFrame, history: DataFrame, current: DataFrame) -> DataFrame:
    """Every order with its account's tier and region then, and its tier now."""
    then = temporal.point_in_time_join(
        orders,
        history,
        ["account_id"],
        "order_ts",
        {"contract_tier": "tier_at_order", "billing_region": "region_at_order"},
        {"tier_at_order": UNKNOWN, "region_at_order": UNKNOWN},
    )
    now = current.select("account_id", F.col("contract_tier").alias("current_tier"))
    both = joins.attach(then, now, ["account_id"], "left", counted=orders)
    return ORDERS_ATTRIBUTED.publish(
        both.withColumn("current_tier", F.coalesce("current_tier", F.lit(UNKNOWN)))
    )


# --- employees ---------------------------------------------------------------------------

EMPLOYEE_HISTORY = Contract(
    ("employee_id", "string"),
    ("department_code", "string"),
    ("job_title", "string"),
    ("salary_band", "string"),
    ("valid_from", "timestamp_ntz"),
    ("valid_to", "timestamp_ntz"),
    ("is_deleted", "boolean"),
    ("is_current", "boolean"),
)
EMPLOYEES_CURRENT = Contract(
    ("employee_id", "string"),
    ("full_name", "string"),
    ("department_code", "string"),
    ("job_title", "string"),
    ("salary_band", "string"),
    ("last_login_at", "timestamp_ntz"),
    ("current_since", "timestamp_ntz"),
)
DEPARTMENT_HEADCOUNT = Contract(
    ("department_code", "string"),
    ("department_name", "string"),
    ("current_headcount", "int"),
    ("terminations_to_date", "int"),
)
TRACKED = ("department_code", "job_title", "salary_band")
EMPLOYEES_SNAPSHOT = snapshot.SnapshotSpec(
    "employees",
    ("employee_id",),
    "check",
    check_columns=TRACKED,
    hard_deletes="new_record",
    feed="full_dump",
)


def employee_history(history: DataFrame) -> DataFrame:
    return EMPLOYEE_HISTORY.publish(
        snapshot.history_view(history, ["employee_id", *TRACKED])
    )


def employees_current(history: DataFrame, dump: DataFrame) -> DataFrame:
    """Employed today: tracked columns as versioned, name and login as in today's dump."""
    rows = snapshot.hybrid_current(
        history.where("is_current"), dump, ["employee_id"], ["full_name", "last_login_at"]
    )
    return EMPLOYEES_CURRENT.publish(rows.withColumn("current_since", F.col("valid_from")))


def department_headcount(
    departments: DataFrame, current: DataFrame, history: DataFrame,
    wide: bool = False,
) -> DataFrame:
    """All departments; a termination counts where the employee was then, rehired or not."""
    result = joins.rollup_left_many(
        departments,
        ["department_code"],
        (current, {"current_headcount": F.count("*")}, {"current_headcount": "bigint"}),
        (
            history.where("is_deleted"),
            {"terminations_to_date": F.count("*")},
            {"terminations_to_date": "bigint"},
        ),
    )
    return DEPARTMENT_HEADCOUNT.publish(result, wide)


# --- daily plan revenue ------------------------------------------------------------------

INVOICE_REVENUE = Contract(
    ("invoice_id", "string"),
    ("customer_id", "string"),
    ("invoiced_at", "timestamp_ntz"),
    ("invoice_date", "date"),
    ("plan_code", "string"),
    ("billed_usd", "decimal(12,2)"),
    ("collected_usd", "decimal(12,2)"),
)
DAILY_REVENUE = Contract(
    ("invoice_date", "date"),
    ("plan_code", "string"),
    ("invoice_count", "int"),
    ("billed_usd", "decimal(12,2)"),
    ("collected_usd", "decimal(12,2)"),
    ("outstanding_usd", "decimal(12,2)"),
)
# A payment is loaded at most this many days after its invoice's date.
PAYMENT_SLA_DAYS = 4
PLANS_SNAPSHOT = snapshot.SnapshotSpec(
    "customers", ("customer_id",), "timestamp", updated_at="updated_at"
)


def invoices_since(invoices: DataFrame, since: date | Window) -> DataFrame:
    """Compared as a moment, so that the bound reaches the scan."""
    window = since if isinstance(since, Window) else Window(since)
    inside = F.expr(f"invoiced_at is null or invoiced_at >= timestamp_ntz'{window.since}'")
    if window.reopened:
        inside = inside | window.holds("to_date(invoiced_at)")
    return invoices.where(inside)


def invoice_revenue(
    invoices: DataFrame,
    lines: DataFrame,
    payments: DataFrame,
    history: DataFrame,
    since: date | Window | None = None,
    wide: bool = False,
) -> DataFrame:
    """Every invoice with its plan then, what was billed and what has been paid so far.

    Lines and payments are two independent many sides, each reduced to the invoice first. An
    invoice without lines keeps a missing ``billed_usd`` for the checks to report.
    """
    if since is not None:
        invoices = invoices_since(invoices, since)
        lines, payments = joins.within_key_range(invoices, "invoice_id", lines, payments)
    attributed = temporal.point_in_time_join(
        invoices, history, ["customer_id"], "invoiced_at", {"plan_code": "plan_code"}
    )
    billed = joins.rollup(lines, ["invoice_id"], {"billed_usd": F.sum("amount_usd")})
    paid = joins.rollup_left(
        attributed.join(billed, "invoice_id", "left"),
        payments,
        ["invoice_id"],
        {"collected_usd": F.sum("amount_usd")},
        {"collected_usd": "decimal(28,2)"},
    )
    dated = paid.withColumn("invoice_date", F.to_date("invoiced_at"))
    return INVOICE_REVENUE.publish(dated, wide)


def daily_revenue(revenue: DataFrame, wide: bool = False) -> DataFrame:
    result = (
        revenue.groupBy("invoice_date", "plan_code")
        .agg(
            F.count("*").alias("invoice_count"),
            F.sum("billed_usd").alias("billed_usd"),
            F.sum("collected_usd").alias("collected_usd"),
        )
        .withColumn("outstanding_usd", F.col("billed_usd") - F.col("collected_usd"))
    )
    return DAILY_REVENUE.publish(result, wide)


# --- merchant-month payments -------------------------------------------------------------

CAPTURED_PAYMENTS = Contract(
    ("payment_id", "string"),
    ("order_id", "string"),
    ("merchant_id", "string"),
    ("order_month", "date"),
    ("payment_method", "string"),
    ("amount_usd", "decimal(10,2)"),
)
MERCHANT_MONTH = (("merchant_id", "string"), ("order_month", "date"))


def orders_by_month(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "merchant_id", month_start(F.col("ordered_at")).alias("order_month")
    )


def captured_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Captured payments with the merchant and month of the order they pay for."""
    captured = payments.where(F.col("status") == "captured")
    return CAPTURED_PAYMENTS.publish(
        joins.attach(captured, orders_by_month(orders), ["order_id"])
    )


def merchant_month_payments(
    orders: DataFrame,
    payments: DataFrame,
    methods: Sequence[str] | None,
    wide: bool = False,
) -> DataFrame:
    """Every merchant-month with orders; payments count in the month of their order."""
    captured = payments.where(F.col("status") == "captured")
    table = pivot.pivot_metrics(
        orders_by_month(orders),
        captured,
        "order_id",
        [name for name, _ in MERCHANT_MONTH],
        "payment_method",
        "amount_usd",
        methods,
    )
    return pivot.pivot_contract(MERCHANT_MONTH, methods).publish(table, wide)


# --- engagement rate ---------------------------------------------------------------------

ENGAGEMENT = Contract(("customer_id", "bigint"), ("engaged_rate", "decimal(7,2)"))
ENGAGED = Contract(("customer_id", "bigint"))


def engagement(
    sales: DataFrame, wanted_class: str, min_transactions: int = 10, min_rate: int = 10
) -> DataFrame:
    """Customers with enough transactions and a large enough share of them in a class.

    Sales are folded to one row per transaction first, so both distinct counts become plain
    counts of one aggregate.
    """
    in_class = F.max(F.coalesce(F.trim("class") == wanted_class, F.lit(False)))
    per_transaction = (
        sales.where(F.col("transaction_id").isNotNull())
        .groupBy("customer_id", "transaction_id")
        .agg(in_class.alias("hit"))
    )
    counted = per_transaction.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count_if("hit").alias("n_hit")
    )
    rated = counted.where(F.col("n") >= min_transactions).withColumn(
        "engaged_rate", percent(F.col("n_hit"), F.col("n"))
    )
    return ENGAGEMENT.publish(rated.where(F.col("engaged_rate") >= min_rate))


def engaged_customers(sales: DataFrame, wanted_class: str) -> DataFrame:
    return ENGAGED.publish(engagement(sales, wanted_class))
