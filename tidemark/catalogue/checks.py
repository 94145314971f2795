"""Data-quality checks, run on tables broken on purpose so that each has something to report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks, history_checks, pivot, reconcile, temporal
from ..plans import marts, suites
from ..session import fresh_folder
from ..sources import feeds, star
from ..sources.star import Star
from ..sources.store import MartStore
from . import history as histories
from .feeds_sql import sql
from .incremental import _payouts_at
from .marts import METHODS, _payments_pivot, _pivot_sql

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(oracle)
        return run

    return register


# --- the payments contract as a suite ------------------------------------------------------


def _suite_sql():
    """Every check of the contract, counted on its own."""

    def one(table, name, count, severity="error"):
        return f"""
            select '{table}' as table_name, '{name}' as check_name, '{severity}' as severity,
                   cast(n as bigint) as failing_rows,
                   case when n = 0 then 'pass' else '{severity}' end as status
            from ({count})"""

    def where(table, condition):
        return f"select count(*) as n from {table} where {condition}"

    def missing(table, column, severity="error"):
        return one(table, f"not_null({column})", where(table, f"{column} is null"), severity)

    def repeated(table, column):
        groups = f"select {column} from {table} where {column} is not null group by 1"
        count = f"select count(*) as n from ({groups} having count(*) > 1)"
        return one(table, f"unique({column})", count)

    def unlisted(table, column, *values):
        listed = ", ".join(f"'{v}'" for v in values)
        count = where(table, f"{column} not in ({listed})")
        return one(table, f"accepted_values({column})", count)

    def orphan(table, column, parent, severity="error"):
        count = where(
            f"{table} c",
            f"{column} is not null and not exists "
            f"(select 1 from {parent} p where p.{column} = c.{column})",
        )
        return one(table, f"relationships({column} -> {column})", count, severity)

    def negative(table, column):
        return one(table, f"not_negative({column})", where(table, f"{column} < 0"))

    sums = "(select payout_id, sum(line_amount) as total from payout_lines group by 1)"
    without_lines = where(
        "payouts p",
        "status = 'PAID' and not exists "
        "(select 1 from payout_lines l where l.payout_id = p.payout_id)",
    )
    unequal = (
        f"select count(*) as n from payouts join {sums} using (payout_id) "
        "where payout_amount is distinct from total"
    )
    rows = [repeated("sellers", "seller_id"), unlisted("sellers", "country", "US", "DE", "GB", "PE")]
    rows += [missing("sellers", c) for c in ("seller_id", "seller_name", "country")]
    rows += [repeated("payouts", "payout_id"), orphan("payouts", "seller_id", "sellers")]
    rows += [
        missing("payouts", c)
        for c in ("payout_id", "seller_id", "status", "currency", "payout_amount")
    ]
    rows += [
        unlisted("payouts", "status", "PAID", "PENDING", "FAILED"),
        unlisted("payouts", "currency", "USD", "EUR", "GBP"),
        negative("payouts", "payout_amount"),
        one("payouts", "paid_payout_has_lines", without_lines),
        one("payouts", "payout_amount_equals_lines", unequal),
        repeated("payout_lines", "line_id"),
        missing("payout_lines", "line_id"),
        missing("payout_lines", "line_amount"),
        missing("payout_lines", "payout_id", "warn"),
        missing("payout_lines", "currency", "warn"),
        orphan("payout_lines", "payout_id", "payouts", "warn"),
        unlisted("payout_lines", "currency", "USD", "EUR", "GBP"),
        unlisted("payout_lines", "payment_method", "bank_transfer", "paypal", "wise"),
        negative("payout_lines", "line_amount"),
    ]
    mart_checks = ["unique(seller_id)", "not_null(seller_id)", "not_negative(paid_amount)"]
    measures = ("payout_count", "paid_payout_count", "paid_amount", "line_count")
    mart_checks += [f"not_null({c})" for c in measures]
    rows += [one("seller_payouts", name, "select 0 as n") for name in mart_checks]
    return " union all ".join(rows)


@query(_suite_sql())
def check_suite(spark, sf_dir):
    """One row per check of the payments contract: feeds, then the mart as stored."""
    s, store = Star(spark, sf_dir), MartStore(spark, fresh_folder(spark, "checked"))
    sellers, payouts, lines = star.sellers(s), star.payouts(s), star.payout_lines(s)
    store.write("seller_payouts", 1, marts.seller_payouts(sellers, payouts, lines, wide=True))
    bound = suites.payout_feeds(sellers, payouts, lines)
    bound += suites.seller_payouts(store.read("seller_payouts"))
    return checks.run_suites(bound, suites.EXPECTED["seller_payouts"])


@query(
    """
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem
    group by 1, 2 having count(*) > 1
    """
)
def duplicate_keys(spark, sf_dir):
    """Line numbers repeat within orders: the composite grain does not hold."""
    lines = Star(spark, sf_dir).lineitem
    return checks.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


# --- reconciliation ------------------------------------------------------------------------


def _published(s: Star) -> DataFrame:
    """A copy of the payouts that lost the failed ones, holds the largest twice, and rounds
    pending amounts down."""
    rows = star.payouts(s).select("payout_id", "status", "payout_amount")
    whole = F.floor("payout_amount").cast("decimal(12,2)")
    kept = rows.where(F.col("status") != "FAILED").withColumn(
        "payout_amount",
        F.when(F.col("status") == "PENDING", whole).otherwise(F.col("payout_amount")),
    )
    twice = F.when(F.col("payout_amount") > 480000, 2).otherwise(1)
    repeated = kept.withColumn("_n", F.explode(F.array_repeat(F.lit(1), twice))).drop("_n")
    invented = rows.where(F.col("status") == "FAILED").withColumn(
        "payout_id", -1 - F.col("payout_id")
    )
    return repeated.unionByName(invented)


_PUBLISHED_SQL = """
    (select payout_id, case when status = 'PENDING'
              then cast(floor(payout_amount) as decimal(12,2)) else payout_amount end as amount
     from payouts where status <> 'FAILED'
     union all
     select payout_id, case when status = 'PENDING'
              then cast(floor(payout_amount) as decimal(12,2)) else payout_amount end
     from payouts where status <> 'FAILED' and
       case when status = 'PENDING' then floor(payout_amount) else payout_amount end > 480000
     union all
     select -1 - payout_id, payout_amount from payouts where status = 'FAILED')
"""


@query(
    f"""
    select * from (
      select coalesce(a.payout_id, b.payout_id) as payout_id,
             cast(coalesce(a.n, 0) as bigint) as staged_rows,
             cast(coalesce(b.n, 0) as bigint) as published_rows,
             case when b.n is null then 'missing in published'
                  when a.n is null then 'missing in staged'
                  when a.n <> b.n then 'row count differs'
                  when a.amount is distinct from b.amount then 'amount differs' end as failure
      from (select payout_id, count(*) as n, sum(payout_amount) as amount from payouts group by 1) a
      full outer join (select payout_id, count(*) as n, sum(amount) as amount
                       from {_PUBLISHED_SQL} group by 1) b on b.payout_id = a.payout_id)
    where failure is not null
    """
)
def reconcile_full_outer(spark, sf_dir):
    s = Star(spark, sf_dir)
    failing = reconcile.reconcile(
        star.payouts(s), _published(s), ["payout_id"], ["payout_amount"], ("staged", "published")
    )
    return failing.select("payout_id", "staged_rows", "published_rows", "failure")


def _mart_sql(load):
    return f"""(select delivery_date, city_code, cast(sum(payout_base_usd) as decimal(38,2)) as base
                from deliveries where status <> 'CANCELLED' and batch_id <= {load} group by 1, 2)"""


@query(
    f"""
    select * from (
      select coalesce(a.delivery_date, b.delivery_date) as delivery_date,
             coalesce(a.city_code, b.city_code) as city_code,
             a.base as stale_payout_base_usd, b.base as fresh_payout_base_usd,
             case when b.base is null then 'missing in fresh'
                  when a.base is null then 'missing in stale'
                  when a.base is distinct from b.base then 'amount differs' end as failure
      from {_mart_sql(2)} a full outer join {_mart_sql(3)} b
        on b.delivery_date = a.delivery_date and b.city_code = a.city_code)
    where failure is not null
    """
)
def reconcile_composite(spark, sf_dir):
    """The payout mart as of load 2 against the one as of load 3, by date and city."""
    stale, fresh = _payouts_at(spark, sf_dir, 2), _payouts_at(spark, sf_dir, 3)
    failing = reconcile.reconcile(
        stale, fresh, ["delivery_date", "city_code"], ["payout_base_usd"], ("stale", "fresh")
    )
    return failing.select(
        "delivery_date", "city_code", "stale_payout_base_usd", "fresh_payout_base_usd", "failure"
    )


def _tie_sql(name, published, staged):
    return f"""
        select '{name}' as total, cast(p as decimal(28,2)) as published,
               cast(s as decimal(28,2)) as staged, cast(p - s as decimal(28,2)) as difference
        from (select coalesce(({published}), 0) as p, coalesce(({staged}), 0) as s)"""


@query(
    " union all ".join(
        [
            _tie_sql(
                "invoices",
                "select count(*) from invoice_revenue where plan_code <> 'MACHINERY'",
                "select count(*) from orders",
            ),
            _tie_sql(
                "billed",
                "select sum(billed_usd) from invoice_revenue where plan_code <> 'MACHINERY'",
                "select sum(cast(l_extendedprice as decimal(12,2))) from lineitem",
            ),
            _tie_sql(
                "collected",
                "select sum(collected_usd) from invoice_revenue where plan_code <> 'MACHINERY'",
                "select sum(cast(o_totalprice as decimal(12,2))) from orders "
                "where o_orderstatus <> 'P'",
            ),
        ]
    )
)
def totals_tie_out(spark, sf_dir):
    """A revenue mart that lost one plan against its staged feeds: no total ties."""
    from . import incremental

    s = Star(spark, sf_dir)
    mart = marts.daily_revenue(incremental.invoice_revenue(spark, sf_dir), wide=True)
    broken = mart.where(F.col("plan_code") != "MACHINERY")
    return reconcile.tie_out(
        broken,
        {
            "invoices": (F.sum("invoice_count"), star.invoices(s), F.count("*")),
            "billed": (F.sum("billed_usd"), star.invoice_lines(s), F.sum("amount_usd")),
            "collected": (F.sum("collected_usd"), star.invoice_payments(s), F.sum("amount_usd")),
        },
    )


@query(
    f"""
    select delivery_date, city_code, base as payout_base_usd,
           cast(sum(l) as bigint) as left_rows, cast(sum(r) as bigint) as right_rows
    from (select *, 1 as l, 0 as r from {_mart_sql(2)}
          union all select *, 0, 1 from {_mart_sql(3)})
    group by 1, 2, 3 having sum(l) <> sum(r)
    """
)
def table_diff(spark, sf_dir):
    """Rows that differ between the mart as of load 2 and load 3, from both sides."""

    def at(load):
        return _payouts_at(spark, sf_dir, load).select(
            "delivery_date", "city_code", F.col("payout_base_usd").cast("decimal(38,2)")
        )

    return reconcile.table_diff(at(2), at(3))


# --- history integrity -----------------------------------------------------------------------


def _broken_log(spark, sf_dir, **limits):
    """Error versions last twelve hours too long; APAC sign-ups have an empty window."""
    longer = F.expr("valid_to + INTERVAL 12 HOURS")
    empty = (F.col("contract_tier") == "signup") & (F.col("billing_region") == "APAC")
    return histories.account_log(spark, sf_dir, **limits).withColumn(
        "valid_to",
        F.when(F.col("contract_tier") == "error", longer)
        .when(empty, F.col("valid_from"))
        .otherwise(F.col("valid_to")),
    )


_BROKEN_SQL = """
    (select account_id, contract_tier, billing_region, account_status, valid_from,
            case when contract_tier = 'error' then valid_to + interval 12 hour
                 when contract_tier = 'signup' and billing_region = 'APAC' then valid_from
                 else valid_to end as valid_to
     from account_log)
"""
_OVERLAP_SQL = f"""
    select account_id, valid_from, valid_to,
           case when valid_to <= valid_from then 'empty window' else 'overlap' end as failure
    from {_BROKEN_SQL} b
    where valid_to <= valid_from
       or exists (select 1 from {_BROKEN_SQL} a
                  where a.account_id = b.account_id and a.valid_from < b.valid_from
                    and (a.valid_to is null or a.valid_to > b.valid_from))
"""


@query(_OVERLAP_SQL)
def window_overlaps(spark, sf_dir):
    return history_checks.window_overlaps(_broken_log(spark, sf_dir), ["account_id"])


@query(_OVERLAP_SQL)
def window_overlaps_long_timelines(spark, sf_dir):
    broken = _broken_log(spark, sf_dir, hot_rows=histories.SHORT)
    return history_checks.window_overlaps(broken, ["account_id"], hot_rows=histories.SHORT)


@query(
    f"""
    select account_id, valid_from, valid_to, failure from (
      select account_id, valid_from, valid_to,
             case when valid_to <= valid_from then 'empty window'
                  when valid_to is null and following is not null then 'open but not last'
                  when valid_to is not null and following is null then 'last but closed'
                  when valid_to < following then 'gap'
                  when valid_to > following then 'overlap' end as failure
      from (select *, lead(valid_from) over (partition by account_id order by valid_from)
                      as following from {_BROKEN_SQL}))
    where failure is not null
    """
)
def scd2_tiling(spark, sf_dir):
    return history_checks.not_tiling(_broken_log(spark, sf_dir), ["account_id"])


@query(
    """
    select account_id, cast(sum(case when valid_to is null and account_status = 'ACTIVE'
                                then 1 else 0 end) as bigint) as open_versions
    from account_log
    group by 1
    having sum(case when valid_to is null and account_status = 'ACTIVE' then 1 else 0 end) <> 1
    """
)
def scd2_one_open(spark, sf_dir):
    """A history that closed its churned accounts: they have no open version left."""
    closed = F.coalesce(
        "valid_to", F.when(F.col("account_status") != "ACTIVE", F.lit("2030-01-01").cast("timestamp_ntz"))
    )
    broken = histories.account_log(spark, sf_dir).withColumn("valid_to", closed)
    return history_checks.not_one_open(broken, ["account_id"])


@query(
    """
    select employee_id, failure from (
      select coalesce(h.employee_id, d.employee_id) as employee_id,
             case when h.employee_id is null then 'in dump, not open'
                  when d.employee_id is null then 'open, not in dump'
                  when h.department_code is distinct from d.department_code
                    or h.job_title is distinct from d.job_title
                    or h.salary_band is distinct from d.salary_band
                  then 'tracked columns differ' end as failure
      from (select * from yearly_history where valid_to is null and not is_deleted) h
      full outer join (
        select case when department_code = '0' then -1 - employee_id else employee_id end
                 as employee_id, department_code,
               case when department_code = '1' then 'X' else job_title end as job_title, salary_band
        from yearly_roster where batch_id = 2001) d on d.employee_id = h.employee_id)
    where failure is not null
    """
)
def open_versions_match_dump(spark, sf_dir):
    """The yearly history against a dump with some keys and some titles altered."""
    dump = histories.latest_dump(spark, sf_dir)
    altered = dump.withColumn(
        "employee_id",
        F.when(F.col("department_code") == "0", -1 - F.col("employee_id")).otherwise(
            F.col("employee_id")
        ),
    ).withColumn(
        "job_title", F.when(F.col("department_code") == "1", "X").otherwise(F.col("job_title"))
    )
    return history_checks.open_not_matching_dump(
        histories.yearly_history(spark, sf_dir), altered, ["employee_id"], marts.TRACKED
    )


@query(
    """
    select employee_id, run_ts as valid_from, department_code, job_title, salary_band
    from (select d.*, run_ts, lag(batch_id) over w as p_batch, lag(department_code) over w as p_dep,
                 lag(job_title) over w as p_job, lag(salary_band) over w as p_band
          from yearly_roster d join yearly_runs using (batch_id)
          window w as (partition by employee_id order by batch_id))
    where p_batch = batch_id - 1 and department_code = p_dep and job_title = p_job
      and salary_band = p_band
    """
)
def redundant_versions(spark, sf_dir):
    """Tracking every column makes versions that repeat the one before on those that matter."""
    everything = [*marts.TRACKED, "full_name", "last_login_at"]
    history = histories.yearly_history(spark, sf_dir, tracked=everything)
    return history_checks.redundant_versions(history, ["employee_id"], marts.TRACKED)


_CURRENT_TIER_SQL = """
    (select o.order_id, o.account_id, o.order_ts, c.contract_tier as tier
     from account_orders o left join (select * from account_log where valid_to is null) c
       on c.account_id = o.account_id)
"""


def _attributed_to_current(spark, sf_dir):
    orders = star.account_orders(Star(spark, sf_dir)).drop("order_amount_usd")
    current = histories.account_log(spark, sf_dir).where(F.col("valid_to").isNull())
    return orders.join(
        current.select("account_id", F.col("contract_tier").alias("tier")), "account_id", "left"
    )


@query(
    f"""
    select a.order_id, a.account_id, a.tier, h.contract_tier as derived
    from {_CURRENT_TIER_SQL} a left join account_log h
      on h.account_id = a.account_id and h.valid_from <= a.order_ts
     and (h.valid_to is null or a.order_ts < h.valid_to)
    where a.tier is distinct from h.contract_tier
    """
)
def pit_equals_asof(spark, sf_dir):
    """Purchases attributed to today's tier, checked by the independent as-of derivation."""
    versions = star.account_versions(Star(spark, sf_dir)).withColumnRenamed(
        "updated_at", "valid_from"
    )
    failing = history_checks.attribution_differs(
        _attributed_to_current(spark, sf_dir),
        versions,
        ["account_id"],
        "order_ts",
        "tier",
        "contract_tier",
    )
    return failing.select("order_id", "account_id", "tier", "derived")


@query(
    """
    select o.order_id, o.account_id, h.contract_tier as covering
    from account_orders o join account_log h
      on h.account_id = o.account_id and h.valid_from <= o.order_ts and o.order_ts < h.valid_to
    """
)
def unknown_only_uncovered(spark, sf_dir):
    """Attribution that only knew open versions: defaults where a closed version covers."""
    s, log = Star(spark, sf_dir), histories.account_log(spark, sf_dir)
    orders = star.account_orders(s).drop("order_amount_usd")
    attributed = temporal.point_in_time_join(
        orders,
        log.where(F.col("valid_to").isNull()),
        ["account_id"],
        "order_ts",
        {"contract_tier": "tier"},
        {"tier": marts.UNKNOWN},
    )
    failing = history_checks.default_though_covered(
        attributed, log, ["account_id"], "order_ts", "tier", marts.UNKNOWN, "contract_tier"
    )
    return failing.select("order_id", "account_id", "covering")


@query(
    """
    select order_id, account_id, published, expected from (
      select o.order_id, o.account_id, coalesce(s.contract_tier, 'UNKNOWN') as published,
             coalesce(n.contract_tier, 'UNKNOWN') as expected
      from account_orders o
      left join (select account_id, contract_tier,
                        row_number() over (partition by account_id order by updated_at desc) as rn
                 from account_versions where batch_id <= 2) s
        on s.account_id = o.account_id and s.rn = 1
      left join (select account_id, contract_tier from account_log
                 where valid_to is null and account_status = 'ACTIVE') n
        on n.account_id = o.account_id)
    where published <> expected
    """
)
def current_matches_dim(spark, sf_dir):
    """Current tiers as of load 2, checked against the current dimension."""
    s = Star(spark, sf_dir)
    stale = marts.account_feed_latest(feeds.batch_upto(star.account_versions(s), "batch_id", 2))
    orders = star.account_orders(s).drop("order_amount_usd", "order_ts")
    attributed = orders.join(
        stale.select("account_id", F.col("contract_tier").alias("published")), "account_id", "left"
    ).withColumn("published", F.coalesce("published", F.lit(marts.UNKNOWN)))
    log = histories.account_log(spark, sf_dir)
    current = log.where(F.col("valid_to").isNull() & (F.col("account_status") == "ACTIVE"))
    failing = history_checks.current_differs(
        attributed, current, ["account_id"], "published", "contract_tier", marts.UNKNOWN
    )
    return failing.select("order_id", "account_id", "published", "expected")


# --- generated columns and materialization ----------------------------------------------------


@query(
    f"""
    select merchant_id, order_month, order_count from ({_pivot_sql(METHODS)})
    where {" or ".join(f"{m}_amount_usd = 0" for m in [*METHODS, "other"])}
    """
)
def pivot_generated_populated(spark, sf_dir):
    """A pivot without zero filling: every cell that should be 0 is reported as missing."""
    wide = _payments_pivot(spark, sf_dir, METHODS)
    amounts = [f"{m}_amount_usd" for m in [*METHODS, pivot.OTHER]]
    broken = wide.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in amounts})
    failing = pivot.generated_not_populated(broken, METHODS)
    return failing.select("merchant_id", "order_month", "order_count")


@query(
    """
    select 'plan_usage' as relation, 'table' as kind, count(distinct plan_code) as row_count
    from subscriptions
    union all select 'plan_catalogue', 'view', count(*) from plans
    union all select 'billable_usage', 'ephemeral', count(*)
    from usage_events join subscriptions using (subscription_id)
    where is_billable and status = 'active'
    """
)
def assert_materialization(spark, sf_dir):
    """How each plan relation actually exists: stored, as a view, or nowhere (inlined)."""
    s = Star(spark, sf_dir)
    store = MartStore(spark, fresh_folder(spark, "materialized"))
    subscriptions, events = star.subscriptions(s), star.usage_events(s)
    store.write("plan_usage", 1, marts.plan_usage(subscriptions, events, wide=True))
    marts.plan_catalogue(star.plans(s)).createOrReplaceTempView("plan_catalogue")
    inlined = marts.billable_usage(events, subscriptions)
    relations = {
        "plan_usage": lambda: store.read("plan_usage"),
        "plan_catalogue": lambda: spark.table("plan_catalogue"),
        "billable_usage": lambda: inlined,
    }
    rows = []
    for name, read in relations.items():
        kind = checks.relation_kind(spark, store, name, inlined=["billable_usage"])
        rows.append(
            read()
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(name).alias("relation"), F.lit(kind).alias("kind"), "row_count")
        )
    return reduce(DataFrame.unionByName, rows)
