"""The raw feeds behind the marts.

Fixed values: the raw column names and staged types are the feeds' published layout, in file
order (except that a batch column, always last, is named apart).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import blank_to_missing, normalised
from ..sources.feeds import FeedSpec, Field, SourceSpec

MONEY, AMOUNT = "decimal(10,2)", "decimal(12,2)"
MOMENT = "timestamp_ntz"


def _fields(text: str) -> tuple[Field, ...]:
    """``SOURCE name type`` per line; the type may be left out for text."""
    rows = [line.split() for line in text.strip().splitlines()]
    return tuple(Field(r[0], r[1], r[2] if len(r) > 2 else "string") for r in rows)


def _ruled(fields: tuple[Field, ...], name: str, rule) -> tuple[Field, ...]:
    return tuple(
        Field(f.source, f.name, f.type, rule) if f.name == name else f for f in fields
    )


CUSTOMERS = FeedSpec(
    "customers",
    _ruled(
        _fields(
            """
            CustomerID customer_id int
            FullName customer_name
            Email email
            SignupDate signup_date date
            Country country
            """
        ),
        "email",
        F.lower,
    ),
)

CUSTOMER_ORDERS = FeedSpec(
    "customer_orders",
    _fields(
        f"""
        OrderID order_id int
        CustomerID customer_id int
        OrderTs ordered_at {MOMENT}
        Amount amount {MONEY}
        Status status
        """
    ),
)

ORDER_EXPORT = FeedSpec(
    "order_export",
    _ruled(
        _fields(
            f"""
            ORDER_ID order_id int
            CUSTOMER_CODE customer_id
            COUNTRY_CODE country_code
            ORDER_STATUS order_status
            ORDER_TS ordered_at {MOMENT}
            AMOUNT_USD amount_usd {AMOUNT}
            EXPORTED_AT exported_at {MOMENT}
            """
        ),
        "order_status",
        normalised,
    ),
)
ORDER_EXPORT_SOURCE = SourceSpec("erp.orders", "EXPORTED_AT", 12, 24)

COUNTRY_REGION = FeedSpec(
    "country_region", _fields("country_code country_code\nregion region")
)

PLANS = FeedSpec(
    "plans",
    _fields(
        f"""
        PLAN_CODE plan_code
        PLAN_NAME plan_name
        TIER tier
        MONTHLY_PRICE_USD monthly_price_usd {MONEY}
        """
    ),
)

SUBSCRIPTIONS = FeedSpec(
    "subscriptions",
    _fields(
        """
        SUBSCRIPTION_ID subscription_id
        ACCOUNT_ID account_id
        PLAN_CODE plan_code
        STATUS status
        STARTED_ON started_on date
        """
    ),
)

USAGE_EVENTS = FeedSpec(
    "usage_events",
    _fields(
        """
        EVENT_ID event_id
        SUBSCRIPTION_ID subscription_id
        EVENT_DATE event_date date
        METRIC metric
        UNITS units int
        IS_BILLABLE is_billable boolean
        """
    ),
)

SELLERS = FeedSpec(
    "sellers",
    _fields(
        """
        SELLER_ID seller_id
        SELLER_NAME seller_name
        COUNTRY country
        IS_ACTIVE is_active boolean
        """
    ),
)

PAYOUTS = FeedSpec(
    "payouts",
    _fields(
        f"""
        PAYOUT_ID payout_id
        SELLER_ID seller_id
        PAYOUT_DATE payout_date date
        STATUS status
        CURRENCY currency
        PAYOUT_AMOUNT payout_amount {AMOUNT}
        """
    ),
)

PAYOUT_LINES = FeedSpec(
    "payout_lines",
    _fields(
        f"""
        LINE_ID line_id
        PAYOUT_ID payout_id
        ORDER_REF order_ref
        CURRENCY currency
        LINE_AMOUNT line_amount {AMOUNT}
        PAYMENT_METHOD payment_method
        """
    ),
)

SHIPMENTS = FeedSpec(
    "shipments",
    _fields(
        f"""
        SHIPMENT_ID shipment_id
        WAREHOUSE_CODE warehouse_code
        SHIP_DATE ship_date date
        STATUS status
        SHIPPING_COST_USD shipping_cost_usd {MONEY}
        UPDATED_AT updated_at {MOMENT}
        """
    ),
    batch="BATCH_ID",
)

SHIPMENT_ITEMS = FeedSpec(
    "shipment_items",
    _fields(
        """
        ITEM_ID item_id
        SHIPMENT_ID shipment_id
        SKU sku
        QUANTITY quantity int
        LINE_WEIGHT_KG line_weight_kg decimal(9,3)
        """
    ),
    batch="BATCH_ID",
)

DELIVERIES = FeedSpec(
    "deliveries",
    _fields(
        f"""
        DELIVERY_ID delivery_id
        COURIER_ID courier_id
        CITY_CODE city_code
        DELIVERY_DATE delivery_date date
        STATUS status
        PAYOUT_BASE_USD payout_base_usd {MONEY}
        LOADED_AT loaded_at {MOMENT}
        """
    ),
    batch="BATCH_ID",
)

DELIVERY_ADJUSTMENTS = FeedSpec(
    "delivery_adjustments",
    _fields(
        f"""
        ADJUSTMENT_ID adjustment_id
        DELIVERY_ID delivery_id
        ADJ_TYPE adj_type
        ADJ_AMOUNT_USD adj_amount_usd {MONEY}
        """
    ),
    batch="BATCH_ID",
)

ACCOUNT_VERSIONS = FeedSpec(
    "account_versions",
    _fields(
        f"""
        ACCOUNT_ID account_id
        ACCOUNT_NAME account_name
        CONTRACT_TIER contract_tier
        BILLING_REGION billing_region
        ACCOUNT_STATUS account_status
        UPDATED_AT updated_at {MOMENT}
        """
    ),
    batch="BATCH_ID",
)

ACCOUNT_ORDERS = FeedSpec(
    "account_orders",
    _fields(
        f"""
        ORDER_ID order_id
        ACCOUNT_ID account_id
        ORDER_TS order_ts {MOMENT}
        ORDER_AMOUNT_USD order_amount_usd {MONEY}
        """
    ),
)

EMPLOYEE_DUMP = FeedSpec(
    "employee_dump",
    _fields(
        f"""
        EMPLOYEE_ID employee_id
        FULL_NAME full_name
        DEPARTMENT_CODE department_code
        JOB_TITLE job_title
        SALARY_BAND salary_band
        RECORD_UPDATED_AT record_updated_at {MOMENT}
        LAST_LOGIN_AT last_login_at {MOMENT}
        """
    ),
    batch="BATCH_ID",
)

DEPARTMENTS = FeedSpec(
    "departments",
    _fields("DEPARTMENT_CODE department_code\nDEPARTMENT_NAME department_name"),
)

CUSTOMER_DUMP = FeedSpec(
    "customer_dump",
    _fields(
        f"""
        CUSTOMER_ID customer_id
        CUSTOMER_NAME customer_name
        PLAN_CODE plan_code
        UPDATED_AT updated_at {MOMENT}
        """
    ),
    batch="BATCH_ID",
)

INVOICES = FeedSpec(
    "invoices",
    _fields(
        f"""
        INVOICE_ID invoice_id
        CUSTOMER_ID customer_id
        INVOICED_AT invoiced_at {MOMENT}
        """
    ),
    batch="BATCH_ID",
)

INVOICE_LINES = FeedSpec(
    "invoice_lines",
    _fields(
        f"""
        LINE_ID line_id
        INVOICE_ID invoice_id
        LINE_TYPE line_type
        AMOUNT_USD amount_usd {MONEY}
        """
    ),
    batch="BATCH_ID",
)

INVOICE_PAYMENTS = FeedSpec(
    "invoice_payments",
    _fields(
        f"""
        PAYMENT_ID payment_id
        INVOICE_ID invoice_id
        PAID_AT paid_at {MOMENT}
        AMOUNT_USD amount_usd {MONEY}
        """
    ),
    batch="BATCH_ID",
)

MERCHANT_ORDERS = FeedSpec(
    "merchant_orders",
    _fields(
        f"""
        order_id order_id
        merchant_id merchant_id
        ordered_at ordered_at {MOMENT}
        """
    ),
)

MERCHANT_PAYMENTS = FeedSpec(
    "merchant_payments",
    _ruled(
        _fields(
            f"""
            payment_id payment_id
            order_id order_id
            payment_method payment_method
            status status
            amount_usd amount_usd {MONEY}
            paid_at paid_at {MOMENT}
            """
        ),
        "payment_method",
        lambda method: blank_to_missing(F.lower(method)),
    ),
)

SALES = FeedSpec(
    "sales",
    _fields(
        """
        SKU sku bigint
        CustomerID customer_id bigint
        TransactionID transaction_id bigint
        Class class
        """
    ),
)

SALES_CUSTOMERS = FeedSpec(
    "sales_customers", _fields("CustomerID customer_id bigint\nZip zip")
)
