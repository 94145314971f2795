"""The feeds of ``sources.star`` as SQL, for the independent oracle."""

from __future__ import annotations

import re

_PRICE = "cast(o_totalprice as decimal(12,2))"
_DAY = "cast(o_orderdate as date)"
_PRIORITY = "cast(substr(o_orderpriority, 1, 1) as integer)"


def _load(day: str, first: str, second: str) -> str:
    return (
        f"case when {day} <= date '{first}' then 1 when {day} <= date '{second}' then 2 else 3 end"
    )


def _roster(batch: str) -> str:
    return f"""
        select o_custkey as employee_id,
               concat('order ', cast(o_orderkey as varchar)) as full_name,
               cast({_PRIORITY} - 1 as varchar) as department_code,
               o_orderstatus as job_title,
               case when o_totalprice < 150000 then 'B1' when o_totalprice < 350000 then 'B2'
                    else 'B3' end as salary_band,
               o_orderdate as last_login_at, batch_id
        from (select *, {batch} as batch_id,
                     row_number() over (partition by o_custkey, {batch}
                                        order by o_orderdate desc, o_orderkey desc) as rn
              from orders)
        where rn = 1"""


# The history a nightly run on full dumps builds, set-based over a key x run grid: presence and
# last recorded values per grid cell, then changes. {roster} and {runs} name CTEs.
def _history(roster: str, runs: str) -> str:
    return f"""
        select employee_id, full_name, department_code, job_title, salary_band, last_login_at,
               valid_from, lead(valid_from) over (partition by employee_id order by valid_from)
                   as valid_to, gone as is_deleted
        from (
          select employee_id, valid_from, gone,
                 last_value(case when gone then null else full_name end ignore nulls) over w as full_name,
                 last_value(case when gone then null else department_code end ignore nulls) over w as department_code,
                 last_value(case when gone then null else job_title end ignore nulls) over w as job_title,
                 last_value(case when gone then null else salary_band end ignore nulls) over w as salary_band,
                 last_value(case when gone then null else last_login_at end ignore nulls) over w as last_login_at
          from (
            select employee_id, run_ts as valid_from, full_name, department_code, job_title,
                   salary_band, last_login_at, full_name is null as gone
            from (
              select g.employee_id, g.batch_id, g.run_ts, d.full_name, d.department_code,
                     d.job_title, d.salary_band, d.last_login_at,
                     lag(d.full_name is not null) over p as was_there,
                     lag(d.department_code) over p as p_dep, lag(d.job_title) over p as p_job,
                     lag(d.salary_band) over p as p_band
              from (select k.employee_id, r.batch_id, r.run_ts
                    from (select employee_id, min(batch_id) as first_batch from {roster} group by 1) k
                    join {runs} r on r.batch_id >= k.first_batch) g
              left join {roster} d on d.employee_id = g.employee_id and d.batch_id = g.batch_id
              window p as (partition by g.employee_id order by g.batch_id)
            )
            where (full_name is not null and (was_there is null or not was_there
                     or department_code is distinct from p_dep or job_title is distinct from p_job
                     or salary_band is distinct from p_band))
               or (full_name is null and was_there)
          )
          window w as (partition by employee_id order by valid_from
                       rows between unbounded preceding and current row)
        )"""


FEEDS = {
    "guest_orders": f"""
        select o_orderkey as order_id,
               case when o_orderpriority = '1-URGENT' then o_custkey end as customer_id,
               case when o_orderstatus <> 'P' then {_PRICE} end as amount
        from orders""",
    "order_export": f"""
        select o_orderkey as order_id, n_name as country_code,
               case o_orderstatus when 'F' then 'pending' when 'O' then 'completed'
                    else 'cancelled' end as order_status,
               {_PRICE} as amount_usd, o_orderdate + interval 1 day as exported_at
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
        union all
        select o_orderkey, n_name, 'completed',
               case when o_orderpriority = '5-LOW' then null
                    else cast({_PRICE} + 10 as decimal(12,2)) end,
               o_orderdate + interval 3 day
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
        where o_orderstatus = 'F'""",
    "latest_export": """
        select order_id, country_code, order_status, amount_usd, exported_at
        from (select *, row_number() over (partition by order_id order by exported_at desc) as rn
              from order_export) where rn = 1""",
    "country_region": """
        select n_name as country_code, r_name as region
        from nation join region on r_regionkey = n_regionkey where r_name <> 'MIDDLE EAST'""",
    "plans": """
        select n_name as plan_code, lower(n_name) as plan_name, r_name as tier,
               case when r_name <> 'ASIA' then cast(n_nationkey * 10 + 9.99 as decimal(10,2)) end
                   as monthly_price_usd
        from nation join region on r_regionkey = n_regionkey""",
    "subscriptions": """
        select cast(s_suppkey as varchar) as subscription_id, n_name as plan_code,
               case when s_acctbal < 0 then 'trialing' when s_acctbal < 3000 then 'churned'
                    else 'active' end as status
        from supplier join nation on n_nationkey = s_nationkey""",
    "usage_events": """
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as event_id,
               cast(l_suppkey as varchar) as subscription_id, cast(l_shipdate as date) as event_date,
               case when l_linenumber <> 7 then cast(l_quantity as integer) end as units,
               l_returnflag <> 'N' as is_billable
        from lineitem""",
    "sellers": """
        select c_custkey as seller_id, c_name as seller_name,
               case c_mktsegment when 'AUTOMOBILE' then 'US' when 'BUILDING' then 'DE'
                    when 'FURNITURE' then 'GB' when 'HOUSEHOLD' then 'PE' else 'XX' end as country
        from customer""",
    "payouts": f"""
        select o_orderkey as payout_id, o_custkey as seller_id,
               case o_orderstatus when 'F' then 'PAID' when 'O' then 'PENDING' else 'FAILED' end
                   as status,
               case when o_orderpriority <> '5-LOW' then 'USD' end as currency,
               {_PRICE} as payout_amount
        from orders""",
    "payout_lines": """
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as line_id,
               case when l_linenumber = 7 then null when l_discount > 0.095 then -1 - l_orderkey
                    else l_orderkey end as payout_id,
               case when l_tax > 0 then 'USD' end as currency,
               cast(l_extendedprice as decimal(12,2)) as line_amount,
               case l_returnflag when 'A' then 'wise' when 'R' then 'paypal' end as payment_method
        from lineitem""",
    "settlement_lines": f"""
        select o_orderkey as payout_id, cast(100 as decimal(12,2)) as line_amount from orders
        union all
        select o_orderkey,
               cast({_PRICE} - 100 + case when o_orderstatus = 'P' then 1 else 0 end
                    as decimal(12,2))
        from orders""",
    "shipments": f"""
        select o_orderkey as shipment_id, 'WH-' || substr(o_orderpriority, 1, 1) as warehouse_code,
               {_DAY} as ship_date,
               case o_orderstatus when 'F' then 'DELIVERED' when 'P' then 'CANCELLED'
                    else 'IN_TRANSIT' end as status,
               case when o_orderstatus = 'O' then {_PRICE}
                    else cast({_PRICE} + 1.25 as decimal(12,2)) end as shipping_cost_usd
        from orders""",
    "deliveries": f"""
        select o_orderkey as delivery_id, c_mktsegment as city_code, {_DAY} as delivery_date,
               case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'RETURNED'
                    else 'CANCELLED' end as status,
               {_PRICE} as payout_base_usd,
               {_load(f"({_DAY} + {_PRIORITY} - 1)", "1997-06-30", "1999-12-31")} as batch_id
        from orders join customer on c_custkey = o_custkey""",
    "delivery_adjustments": """
        select l_orderkey as delivery_id,
               cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end
                    as decimal(10,2)) as adj_amount_usd
        from lineitem""",
    "daily_payouts": """
        select delivery_date, city_code, count(*) as delivery_count,
               sum(case when status = 'COMPLETED' then 1 else 0 end) as completed_count,
               cast(sum(payout_base_usd) as decimal(28,2)) as payout_base_usd,
               cast(sum(adjustment) as decimal(28,2)) as adjustment_total_usd,
               cast(sum(payout_base_usd) + sum(adjustment) as decimal(28,2)) as total_payout_usd
        from (select d.*, coalesce(a.adjustment, 0) as adjustment
              from deliveries d
              left join (select delivery_id, sum(adj_amount_usd) as adjustment
                         from delivery_adjustments group by 1) a using (delivery_id)
              where d.status <> 'CANCELLED')
        group by 1, 2""",
    "account_versions": f"""
        select user_id as account_id, 'user ' || cast(user_id as varchar) as account_name,
               event_type as contract_tier,
               case when value < 10 then 'EMEA' when value < 50 then 'AMER' else 'APAC' end
                   as billing_region,
               case when event_type = 'error' then 'CHURNED' else 'ACTIVE' end as account_status,
               ts as updated_at,
               {_load("cast(ts as date)", "2024-01-10", "2024-01-20")} as batch_id
        from events where event_type <> 'purchase'""",
    "account_orders": """
        select event_id as order_id, user_id as account_id, ts as order_ts,
               cast(value as decimal(10,2)) as order_amount_usd
        from events where event_type = 'purchase'""",
    # What three runs see: the newest version per account at each run; a run that sees the same
    # version again adds nothing.
    "account_snapshot": """
        select account_id, account_name, contract_tier, billing_region, account_status, updated_at,
               updated_at as valid_from,
               lead(updated_at) over (partition by account_id order by updated_at) as valid_to
        from (select distinct account_id, account_name, contract_tier, billing_region,
                     account_status, updated_at
              from (select v.*, row_number() over (partition by account_id, b.n
                                                   order by updated_at desc) as rn
                    from account_versions v
                    join (values (1), (2), (3)) b(n) on v.batch_id <= b.n)
              where rn = 1)""",
    "account_log": """
        select account_id, account_name, contract_tier, billing_region, account_status,
               updated_at as valid_from,
               lead(updated_at) over (partition by account_id order by updated_at) as valid_to
        from account_versions""",
    "accounts_now": """
        select account_id, account_name, contract_tier, billing_region,
               valid_from as current_since
        from account_snapshot where valid_to is null and account_status = 'ACTIVE'""",
    "yearly_roster": _roster("year(o_orderdate)"),
    "yearly_runs": """
        select y as batch_id, make_timestamp(y + 1, 1, 1, 0, 0, 0) as run_ts
        from (values (1995), (1996), (1997), (1998), (1999), (2000), (2001)) r(y)""",
    "yearly_history": _history("yearly_roster", "yearly_runs"),
    "loaded_roster": _roster(_load(_DAY, "1997-02-28", "1999-04-30")),
    "loaded_runs": """
        select * from (values (1, timestamp '1997-03-01'), (2, timestamp '1999-05-01'),
                              (3, timestamp '2001-09-01')) r(batch_id, run_ts)""",
    "loaded_history": _history("loaded_roster", "loaded_runs"),
    "employees_now": """
        select h.employee_id, d.full_name, h.department_code, h.job_title, h.salary_band,
               d.last_login_at, h.valid_from as current_since
        from yearly_history h join yearly_roster d
          on d.employee_id = h.employee_id and d.batch_id = 2001
        where h.valid_to is null and not h.is_deleted""",
    # Plan changes as the source recorded them, one row per edit.
    "plan_versions": """
        select c_custkey as customer_id, c_name as customer_name, c_mktsegment as plan_code,
               timestamp '1994-06-01 00:00:00' as valid_from from customer
        union all
        select c_custkey, c_name, 'AUTOMOBILE', timestamp '1998-02-10 10:00:00'
        from customer where c_acctbal < 0
        union all
        select c_custkey, c_name || ' Ltd', 'MACHINERY', timestamp '2000-07-04 12:00:00'
        from customer where c_acctbal > 5000""",
    "invoice_revenue": f"""
        select o_orderkey as invoice_id, o_custkey as customer_id, o_orderdate as invoiced_at,
               {_DAY} as invoice_date, plan_code,
               cast(billed as decimal(28,2)) as billed_usd,
               cast(case when o_orderstatus <> 'P' then {_PRICE} else 0 end as decimal(28,2))
                   as collected_usd
        from orders
        left join (select l_orderkey, sum(cast(l_extendedprice as decimal(12,2))) as billed
                   from lineitem group by 1) on l_orderkey = o_orderkey
        left join (select *, lead(valid_from) over (partition by customer_id order by valid_from)
                             as valid_to from plan_versions) v
          on v.customer_id = o_custkey and v.valid_from <= o_orderdate
         and (v.valid_to is null or o_orderdate < v.valid_to)""",
    "merchant_payments": """
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as payment_id,
               l_orderkey as order_id,
               case when l_linenumber <= 2 then 'card' when l_linenumber = 3 then 'wallet'
                    when l_linenumber = 4 then 'bank_transfer' when l_linenumber = 5 then 'bnpl'
                    when l_linenumber = 6 then null else 'gift_card' end as payment_method,
               case when l_linestatus = 'F' then 'captured' else 'failed' end as status,
               cast(l_extendedprice as decimal(12,2)) as amount_usd
        from lineitem""",
    "captured": """
        select p.*, o_custkey as merchant_id, cast(date_trunc('month', o_orderdate) as date)
                   as order_month
        from merchant_payments p join orders on o_orderkey = p.order_id
        where p.status = 'captured'""",
}


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in FEEDS if name in words]


def sql(body: str) -> str:
    """``body`` preceded by the feeds it names, and theirs, in order of definition."""
    wanted: set[str] = set()
    todo = [body]
    while todo:
        for name in _needs(todo.pop()):
            if name not in wanted:
                wanted.add(name)
                todo.append(FEEDS[name])
    parts = [f"{name} as ({FEEDS[name]})" for name in FEEDS if name in wanted]
    return (f"with {', '.join(parts)} " if parts else "") + body
