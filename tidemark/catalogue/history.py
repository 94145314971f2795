"""Version histories, point-in-time attribution and the dimensions read from them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import shaping, snapshot, temporal
from ..plans import marts
from ..session import fresh_folder
from ..sources import feeds, star
from ..sources.star import Star
from ..sources.store import HistoryStore
from .feeds_sql import sql

QUERIES, ORACLES = {}, {}
LOADS = (1, 2, 3)
# Row limits low enough to send these tables down the plan meant for very long timelines.
SHORT = 25

VERSION = ["employee_id", "full_name", "department_code", "job_title", "salary_band"]
VERSION += ["last_login_at", "valid_from", "valid_to", "is_deleted"]


def query(oracle: str):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(oracle)
        return run

    return register


def account_history(spark, sf_dir, runs=LOADS):
    """The account history that nightly snapshot runs build, up to the last of ``runs``."""
    log = star.account_versions(Star(spark, sf_dir))
    store = HistoryStore(spark, fresh_folder(spark, "accounts"))
    history = None
    for run in runs:
        seen = marts.account_feed_latest(feeds.batch_upto(log, "batch_id", run))
        history = snapshot.run_snapshot(
            store, marts.ACCOUNTS_SNAPSHOT, seen, run, star.ACCOUNT_LOADS[-1]
        )
    return history


def account_log(spark, sf_dir, **limits):
    """The complete account history, straight from the version log."""
    log = star.account_versions(Star(spark, sf_dir)).drop("batch_id")
    return temporal.scd2_from_log(log, ["account_id"], "updated_at", **limits)


def roster_snapshots(spark, sf_dir, **changes):
    """Three snapshot runs over full dumps, under a variant of the employees snapshot."""
    spec = replace(marts.EMPLOYEES_SNAPSHOT, **changes)
    dumps = star.loaded_roster(Star(spark, sf_dir))
    store = HistoryStore(spark, fresh_folder(spark, "employees"))
    history = None
    for run, moment in star.ROSTER_RUNS:
        dump = feeds.batch_exact(dumps, "batch_id", run)
        history = snapshot.run_snapshot(store, spec, dump, run, f"{moment} 00:00:00")
    return history.select(*VERSION)


def yearly_history(spark, sf_dir, tracked=marts.TRACKED, hard_deletes="new_record"):
    return temporal.scd2_from_dumps(
        star.yearly_roster(Star(spark, sf_dir)),
        ["employee_id"],
        tracked,
        "batch_id",
        star.YEARLY_RUNS,
        hard_deletes,
    )


def latest_dump(spark, sf_dir):
    return feeds.batch_exact(star.yearly_roster(Star(spark, sf_dir)), "batch_id", 2001)


_VERSION_SQL = ", ".join(VERSION)
_ACCOUNT_SQL = "account_id, contract_tier, billing_region, account_status, valid_from, valid_to"


def _no_deletes_sql(columns):
    """Absence invisible: a version per change between the dumps a key does appear in."""
    changed = " or ".join(f"{c} is distinct from p_{c}" for c in columns)
    before = ", ".join(f"lag({c}) over w as p_{c}" for c in columns)
    return f"""
        select employee_id, full_name, department_code, job_title, salary_band, last_login_at,
               run_ts as valid_from,
               lead(run_ts) over (partition by employee_id order by run_ts) as valid_to,
               false as is_deleted
        from (select d.*, r.run_ts, lag(run_ts) over w as p_run, {before}
              from loaded_roster d join loaded_runs r using (batch_id)
              window w as (partition by employee_id order by run_ts))
        where p_run is null or {changed}"""


@query(f"select {_ACCOUNT_SQL} from account_snapshot")
def snapshot_timestamp(spark, sf_dir):
    """Three runs on the account feed; versions overwritten between two runs are never seen."""
    return account_history(spark, sf_dir).select(*_ACCOUNT_SQL.split(", "))


@query(_no_deletes_sql(marts.TRACKED))
def snapshot_check(spark, sf_dir):
    """A version per change of a tracked column; other columns never make one."""
    return roster_snapshots(spark, sf_dir, hard_deletes="ignore", feed="state")


@query(
    _no_deletes_sql(
        ["full_name", "department_code", "job_title", "salary_band", "last_login_at"]
    )
)
def snapshot_check_all(spark, sf_dir):
    """Comparing every column: each correction of an overwrite column becomes a version."""
    return roster_snapshots(spark, sf_dir, check_columns=snapshot.ALL, hard_deletes="ignore")


@query(f"select {_VERSION_SQL} from loaded_history")
def snapshot_hard_delete_new_record(spark, sf_dir):
    """A key that leaves the dump gets a flagged version; one that returns, a new one."""
    return roster_snapshots(spark, sf_dir)


@query(f"select {_VERSION_SQL} from loaded_history where not is_deleted")
def snapshot_hard_delete_invalidate(spark, sf_dir):
    """A key that leaves the dump has its version closed, nothing more."""
    return roster_snapshots(spark, sf_dir, hard_deletes="invalidate")


@query(_no_deletes_sql(marts.TRACKED))
def snapshot_hard_delete_ignore(spark, sf_dir):
    return roster_snapshots(spark, sf_dir, hard_deletes="ignore")


@query(f"select {_VERSION_SQL} from yearly_history")
def scd2_from_dumps(spark, sf_dir):
    """Seven yearly dumps turned into history in one pass, without a merge per dump."""
    return yearly_history(spark, sf_dir).select(*VERSION)


@query(f"select {_ACCOUNT_SQL} from account_log")
def scd2_from_log(spark, sf_dir):
    return account_log(spark, sf_dir).select(*_ACCOUNT_SQL.split(", "))


@query(f"select {_ACCOUNT_SQL} from account_log")
def scd2_from_log_long_timelines(spark, sf_dir):
    """The same on the plan for keys too long for one task."""
    return account_log(spark, sf_dir, hot_rows=SHORT).select(*_ACCOUNT_SQL.split(", "))


@query(
    """
    select valid_from, 'R' || cast(dense_rank() over (order by valid_from) as varchar) as run_label
    from (select distinct valid_from from yearly_history)
    """
)
def run_labels(spark, sf_dir):
    return shaping.run_labels(yearly_history(spark, sf_dir), "valid_from")


@query(
    """
    select cast(employee_id as varchar) as employee_id, department_code, job_title, salary_band,
           valid_from, valid_to, is_deleted,
           valid_to is null and not is_deleted as is_current
    from yearly_history
    """
)
def employee_history(spark, sf_dir):
    return marts.employee_history(yearly_history(spark, sf_dir))


@query(
    """
    select cast(account_id as varchar) as account_id, account_name, contract_tier,
           billing_region, current_since
    from accounts_now
    """
)
def accounts_current(spark, sf_dir):
    return marts.accounts_current(account_history(spark, sf_dir))


@query(
    """
    select cast(employee_id as varchar) as employee_id, full_name, department_code, job_title,
           salary_band, last_login_at, current_since
    from employees_now
    """
)
def employees_current(spark, sf_dir):
    history = marts.employee_history(yearly_history(spark, sf_dir))
    return marts.employees_current(history, _text_key(latest_dump(spark, sf_dir)))


def _text_key(dump):
    return dump.withColumn("employee_id", F.col("employee_id").cast("string"))


@query(
    """
    select cast(r_regionkey as varchar) as department_code, r_name as department_name,
           cast(coalesce(h, 0) as bigint) as current_headcount,
           cast(coalesce(t, 0) as bigint) as terminations_to_date
    from region
    left join (select department_code, count(*) as h from employees_now group by 1) n
      on n.department_code = cast(r_regionkey as varchar)
    left join (select department_code, count(*) as t from yearly_history where is_deleted
               group by 1) g on g.department_code = cast(r_regionkey as varchar)
    """
)
def department_headcount(spark, sf_dir):
    history = marts.employee_history(yearly_history(spark, sf_dir))
    current = marts.employees_current(history, _text_key(latest_dump(spark, sf_dir)))
    departments = star.departments(Star(spark, sf_dir))
    return marts.department_headcount(departments, current, history, wide=True)


_PIT_SQL = """
    select o.order_id, o.account_id, o.order_ts, o.order_amount_usd,
           coalesce(h.contract_tier, 'UNKNOWN') as tier_at_order,
           coalesce(h.billing_region, 'UNKNOWN') as region_at_order
    from account_orders o left join {history} h
      on h.account_id = o.account_id and h.valid_from <= o.order_ts
     and (h.valid_to is null or o.order_ts < h.valid_to)
"""
_PIT_TAKE = {"contract_tier": "tier_at_order", "billing_region": "region_at_order"}
_PIT_ELSE = {"tier_at_order": marts.UNKNOWN, "region_at_order": marts.UNKNOWN}


def _orders_then(spark, sf_dir, history, **limits):
    return temporal.point_in_time_join(
        star.account_orders(Star(spark, sf_dir)),
        history,
        ["account_id"],
        "order_ts",
        _PIT_TAKE,
        _PIT_ELSE,
        **limits,
    )


@query(_PIT_SQL.format(history="account_log"))
def point_in_time_join(spark, sf_dir):
    """Every purchase with the state in effect then, on the complete history."""
    return _orders_then(spark, sf_dir, account_log(spark, sf_dir))


@query(_PIT_SQL.format(history="account_log"))
def point_in_time_join_long_timelines(spark, sf_dir):
    """The same by carrying versions forward along timelines cut into stretches."""
    history = account_log(spark, sf_dir, hot_rows=SHORT)
    return _orders_then(spark, sf_dir, history, few_versions=1, hot_rows=SHORT)


@query(_PIT_SQL.format(history="account_log"))
def point_in_time_join_hot_keys(spark, sf_dir):
    """The same with every busy account's purchases joined in place to its versions."""
    history = account_log(spark, sf_dir)
    return _orders_then(spark, sf_dir, history, few_versions=500, hot_rows=SHORT // 2)


@query(
    """
    select order_id, account_id, order_ts, contract_tier as tier_then
    from (select o.order_id, o.account_id, o.order_ts, v.contract_tier,
                 row_number() over (partition by o.order_id order by v.valid_from desc) as rn
          from account_orders o left join account_log v
            on v.account_id = o.account_id and v.valid_from <= o.order_ts)
    where rn = 1
    """
)
def asof_latest(spark, sf_dir):
    """The latest version not after each purchase, without reading where versions end."""
    versions = star.account_versions(Star(spark, sf_dir)).withColumnRenamed(
        "updated_at", "valid_from"
    )
    orders = star.account_orders(Star(spark, sf_dir)).drop("order_amount_usd")
    return temporal.asof_latest(
        orders, versions, ["account_id"], "order_ts", {"contract_tier": "tier_then"}
    )


@query(
    f"""
    select cast(p.order_id as varchar) as order_id, cast(p.account_id as varchar) as account_id,
           p.order_ts, p.order_amount_usd, p.tier_at_order, p.region_at_order,
           coalesce(n.contract_tier, 'UNKNOWN') as current_tier
    from ({_PIT_SQL.format(history="account_snapshot")}) p
    left join accounts_now n on n.account_id = p.account_id
    """
)
def attributed_facts(spark, sf_dir):
    """Purchases with tier then and tier now, from the history three snapshot runs built."""
    history = account_history(spark, sf_dir)
    orders = star.account_orders(Star(spark, sf_dir))
    current = marts.accounts_current(history).withColumn(
        "account_id", F.col("account_id").cast("bigint")
    )
    return marts.orders_attributed(orders, history, current)
