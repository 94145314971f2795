"""What happens at the edges of a run: thresholds, kept failures, blocked steps, refused histories,
empty targets and changed columns."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks, snapshot, upsert
from ..operators.checks import WARN, CheckCountMismatch, ChecksFailed, CheckSuite
from ..plans import marts
from ..session import fresh_folder
from ..sources import feeds, star
from ..sources.star import Star
from ..sources.store import HistoryStore, MartStore, NotRebuildable
from .feeds_sql import sql
from .history import account_history
from .incremental import SHIPMENTS_SQL
from .marts import METHODS, _payments_pivot, _pivot_sql

QUERIES, ORACLES = {}, {}
#: A number of failing rows that no table reaches.
NEVER = 10**15


def query(oracle: str):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(oracle)
        return run

    return register


# --- checks --------------------------------------------------------------------------------


def _line_rules() -> list[checks.Check]:
    """Checks on payout lines, under every combination of severity and threshold."""
    priced = F.col("line_amount") > 2000
    return [
        checks.all_not_null(["payout_id", "currency", "payment_method"]),
        replace(checks.not_null("payout_id"), error_if=NEVER),
        replace(checks.not_null("currency"), error_if=NEVER, warn_if=NEVER),
        checks.not_null("payment_method", WARN),
        replace(checks.not_null("line_amount"), warn_if=0, error_if=NEVER),
        checks.row_rule("line_is_priced", priced),
        # the rule is NULL where the currency is missing, and such rows fail
        checks.row_rule("line_in_usd", F.col("currency") == "USD", WARN),
        checks.grain_unique(["payout_id", "payment_method"]),
    ]


def _counted(name: str, severity: str, count: str, status: str) -> str:
    return f"""
        select 'payout_lines' as table_name, '{name}' as check_name, '{severity}' as severity,
               cast(n as bigint) as failing_rows, {status} as status
        from (select count(*) as n from {count})"""


_FAILS, _WARNS = ("case when n >= 1 then '{}' else 'pass' end".format(s) for s in ("error", "warn"))


@query(
    " union all ".join(
        [
            _counted(
                "all_not_null(payout_id, currency, payment_method)",
                "error",
                "payout_lines where payout_id is null or currency is null or payment_method is null",
                _FAILS,
            ),
            _counted("not_null(payout_id)", "error", "payout_lines where payout_id is null", _WARNS),
            _counted("not_null(currency)", "error", "payout_lines where currency is null", "'pass'"),
            _counted(
                "not_null(payment_method)", "warn", "payout_lines where payment_method is null", _WARNS
            ),
            _counted("not_null(line_amount)", "error", "payout_lines where line_amount is null", "'warn'"),
            _counted(
                "line_is_priced",
                "error",
                "payout_lines where not coalesce(line_amount > 2000, false)",
                _FAILS,
            ),
            _counted(
                "line_in_usd", "warn", "payout_lines where currency is distinct from 'USD'", _WARNS
            ),
            _counted(
                "grain_unique(payout_id, payment_method)",
                "error",
                "(select 1 from payout_lines group by payout_id, payment_method having count(*) > 1)",
                _FAILS,
            ),
        ]
    )
)
def check_thresholds(spark, sf_dir):
    """Severity is a ceiling; below it the counts from which a check warns or errors decide."""
    lines = star.payout_lines(Star(spark, sf_dir))
    return CheckSuite("payout_lines", lines, _line_rules(), expected=8).results()


@query(
    """
    select 'line_is_priced' as check_name, line_id from payout_lines
    where not coalesce(line_amount > 2000, false)
    union all select 'line_in_usd', line_id from payout_lines where currency is distinct from 'USD'
    """
)
def check_kept_rows(spark, sf_dir):
    """Failing rows of two checks, read from where the suite kept them."""
    lines, folder = star.payout_lines(Star(spark, sf_dir)), fresh_folder(spark, "failures")
    rules = [c for c in _line_rules() if c.name.startswith("line_")]
    CheckSuite("payout_lines", lines, rules).store_failures(folder)
    kept = [
        spark.read.parquet(f"{folder}/payout_lines/{i}").select(
            F.lit(rule.name).alias("check_name"), "line_id"
        )
        for i, rule in enumerate(rules)
    ]
    return reduce(DataFrame.unionByName, kept)


def _step(name: str, table: str, failing: str) -> str:
    return f"""
        select '{name}' as step, case when bad = 0 then 'published' else 'ChecksFailed' end as outcome,
               cast(case when bad = 0 then n else 0 end as bigint) as row_count
        from (select count(*) as n, count(*) filter ({failing}) as bad from {table})"""


@query(
    " union all ".join(
        [
            _step("payouts", "payouts", "payout_id is null"),
            _step("payout lines", "payout_lines", "payout_id is null"),
            _step("warned payout lines", "payout_lines", "false"),
            "select 'uncounted sellers', 'CheckCountMismatch', cast(0 as bigint)",
        ]
    )
)
def check_gate(spark, sf_dir):
    """What each step publishes: a failing error check blocks it, a warning or a pass does not,
    and a suite with a check too few does not start."""
    s = Star(spark, sf_dir)
    keyed, warned = checks.not_null("payout_id"), checks.not_null("payout_id", WARN)
    steps = [
        ("payouts", star.payouts(s), [keyed], 1),
        ("payout lines", star.payout_lines(s), [keyed], 1),
        ("warned payout lines", star.payout_lines(s), [warned], 1),
        ("uncounted sellers", star.sellers(s), [checks.not_null("seller_id")], 2),
    ]
    outcomes = []
    for name, table, bound, expected in steps:
        outcome = "published"
        try:
            table = CheckSuite(name, table, bound, expected).gate()
        except (ChecksFailed, CheckCountMismatch) as refused:
            outcome, table = type(refused).__name__, table.where("false")
        outcomes.append(
            table.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("step"), F.lit(outcome).alias("outcome"), "row_count"
            )
        )
    return reduce(DataFrame.unionByName, outcomes)


@query(_pivot_sql(METHODS))
def payments_pivot_normalised(spark, sf_dir):
    """A list in any case gives the columns and cells of the lower-case one."""
    return _payments_pivot(spark, sf_dir, [m.title() for m in METHODS])


# --- histories -----------------------------------------------------------------------------


@query(
    """
    select account_id, valid_from, updated_at as version_updated_at, false as is_deleted,
           sha256(cast(account_id as varchar) || '~' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f'))
               as version_id
    from account_snapshot
    """
)
def snapshot_metadata(spark, sf_dir):
    """The columns a snapshot adds to each version."""
    return account_history(spark, sf_dir).select(
        "account_id", "valid_from", "version_updated_at", "is_deleted", "version_id"
    )


@query(
    """
    select attempt, outcome, cast(n as bigint) as version_count
    from (select 'several rows per key' as attempt,
                 case when exists (select 1 from account_versions group by account_id having count(*) > 1)
                      then 'NotOneRowPerKey' else 'stored' end as outcome
          union all select 'newest run again', 'stored'
          union all select 'older run rewritten', 'NotRebuildable'
          union all select 'drop', 'NotRebuildable')
    cross join (
      select count(distinct (account_id, updated_at)) as n
      from (select account_id, updated_at,
                   row_number() over (partition by account_id, b.n order by updated_at desc) as rn
            from account_versions v join (values (1), (2)) b(n) on v.batch_id <= b.n)
      where rn = 1)
    """
)
def snapshot_refused(spark, sf_dir):
    """What a history refuses, and the versions it holds after each attempt: always the same."""
    log = star.account_versions(Star(spark, sf_dir))
    spec, clock = marts.ACCOUNTS_SNAPSHOT, star.ACCOUNT_LOADS[-1]
    store = HistoryStore(spark, fresh_folder(spark, "refused"))

    def seen(load):
        return marts.account_feed_latest(feeds.batch_upto(log, "batch_id", load))

    for run in (1, 2):
        history = snapshot.run_snapshot(store, spec, seen(run), run, clock)
    schema = spec.history_schema(seen(2).schema)
    attempts = {
        "several rows per key": lambda: snapshot.run_snapshot(
            store, spec, feeds.batch_upto(log, "batch_id", 3).select(*seen(3).columns), 3, clock
        ),
        "newest run again": lambda: snapshot.run_snapshot(store, spec, seen(3), 2, clock),
        "older run rewritten": lambda: store.write(spec.name, 1, history.withColumn("state", F.lit("open"))),
        "drop": lambda: store.drop(spec.name),
    }
    rows = []
    for attempt, act in attempts.items():
        outcome = "stored"
        try:
            act()
        except (snapshot.NotOneRowPerKey, NotRebuildable) as refused:
            outcome = type(refused).__name__
        held = store.read(spec.name, schema).agg(F.count("*").alias("version_count"))
        rows.append(held.select(F.lit(attempt).alias("attempt"), F.lit(outcome).alias("outcome"), "version_count"))
    return reduce(DataFrame.unionByName, rows)


# --- incremental marts ---------------------------------------------------------------------


@query(SHIPMENTS_SQL)
def daily_shipments_empty_target(spark, sf_dir):
    """The first load brings nothing; the next finds an empty mart and builds everything."""
    s = Star(spark, sf_dir)
    store = MartStore(spark, fresh_folder(spark, "empty"), "year")
    log, items = star.shipments(s), star.shipment_items(s)

    def one_run(load):
        seen = feeds.batch_upto(log, "batch_id", load)
        return upsert.run_incremental(
            store,
            "daily_shipments",
            lambda since: marts.daily_shipments(seen, items, since, wide=True),
            "ship_date",
            load,
        )

    return upsert.replay((0, 3), one_run)


def _payouts_with_new_column(spark, sf_dir, on_schema_change):
    """Load 2 builds the mart without its totals, load 3 with them."""
    s = Star(spark, sf_dir)
    store = MartStore(spark, fresh_folder(spark, "changed"), "year")
    deliveries, adjustments = star.deliveries(s), star.delivery_adjustments(s)

    def one_run(load):
        seen = feeds.batch_upto(deliveries, "batch_id", load)
        hidden = ["total_payout_usd"] if load == 2 else []
        return upsert.run_incremental(
            store,
            "daily_payouts",
            lambda since: marts.daily_payouts(seen, adjustments, since, wide=True).drop(*hidden),
            "delivery_date",
            load,
            lookback_days=marts.DELIVERY_SLA_DAYS,
            on_schema_change=on_schema_change,
        )

    return upsert.replay((2, 3), one_run)


_OPEN_SQL = f"""
    (select max(delivery_date) - {marts.DELIVERY_SLA_DAYS} from deliveries
     where batch_id <= 2 and status <> 'CANCELLED')
"""
_PAYOUT_COLUMNS = """
    delivery_date, city_code, delivery_count, cast(completed_count as bigint) as completed_count,
    payout_base_usd, adjustment_total_usd
"""


@query(
    f"""
    select {_PAYOUT_COLUMNS},
           case when delivery_date >= {_OPEN_SQL} then total_payout_usd end as total_payout_usd
    from daily_payouts
    """
)
def daily_payouts_new_column(spark, sf_dir):
    """A column that appears later is filled from the reopened days on, and missing before."""
    return _payouts_with_new_column(spark, sf_dir, "append_new_columns")


@query(f"select {_PAYOUT_COLUMNS} from daily_payouts")
def daily_payouts_ignored_column(spark, sf_dir):
    """Under ``ignore`` the mart keeps the columns it was built with."""
    return _payouts_with_new_column(spark, sf_dir, "ignore")

