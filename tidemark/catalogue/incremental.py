"""Incremental marts replayed over nightly loads, and the upserts themselves."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import reconcile, snapshot, temporal, upsert
from ..plans import marts
from ..session import fresh_folder
from ..sources import feeds, star, summaries
from ..sources.arrivals import HighWater
from ..sources.star import Star
from ..sources.store import HistoryStore, MartStore
from ..streaming import nightly
from .feeds_sql import sql

QUERIES, ORACLES = {}, {}
LOADS = (1, 2, 3)
#: A few thousand mart rows: a partition a year.
PERIOD = "year"


def query(oracle: str):
    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql(oracle)
        return run

    return register


SHIPMENTS_SQL = """
    select ship_date, warehouse_code, count(*) as shipment_count,
           cast(sum(case when status = 'DELIVERED' then 1 else 0 end) as bigint) as delivered_count,
           cast(sum(shipping_cost_usd) as decimal(28,2)) as shipping_cost_usd,
           cast(coalesce(sum(q), 0) as bigint) as item_quantity,
           cast(coalesce(sum(w), 0) as decimal(28,3)) as total_weight_kg
    from shipments left join (
      select l_orderkey, sum(cast(l_quantity as integer)) as q,
             sum(cast(l_quantity * 0.25 as decimal(9,3))) as w
      from lineitem group by 1) on l_orderkey = shipment_id
    where status <> 'CANCELLED'
    group by 1, 2
"""
PAYOUTS_SQL = """
    select delivery_date, city_code, delivery_count,
           cast(completed_count as bigint) as completed_count, payout_base_usd,
           adjustment_total_usd, total_payout_usd
    from daily_payouts
"""
REVENUE_SQL = """
    select invoice_date, plan_code, count(*) as invoice_count,
           cast(sum(billed_usd) as decimal(28,2)) as billed_usd,
           cast(sum(collected_usd) as decimal(28,2)) as collected_usd,
           cast(sum(billed_usd) - sum(collected_usd) as decimal(28,2)) as outstanding_usd
    from invoice_revenue group by 1, 2
"""


@query(SHIPMENTS_SQL)
def daily_warehouse_shipments(spark, sf_dir):
    """Three nightly loads of a state log and of items that come earlier or later than their shipment;
    each rebuilds the newest stored day, and the days that items have arrived for."""
    s = Star(spark, sf_dir)
    store = MartStore(spark, fresh_folder(spark, "shipments"), PERIOD)
    log, items = star.shipments(s), star.shipment_items(s)

    def one_run(load):
        seen, parts = (feeds.batch_upto(feed, "batch_id", load) for feed in (log, items))
        arrived = feeds.batch_exact(items, "batch_id", load)
        return upsert.run_incremental(
            store,
            "daily_shipments",
            lambda window: marts.daily_shipments(seen, parts, window, wide=True),
            "ship_date",
            load,
            reopened=lambda _: upsert.touched_dates(seen, arrived, ["shipment_id"], "ship_date"),
        )

    return upsert.replay(LOADS, one_run)


def _payout_runs(spark, sf_dir, strategy="replace_window", loads=LOADS):
    s = Star(spark, sf_dir)
    store = MartStore(spark, fresh_folder(spark, "payouts"), PERIOD)
    deliveries, adjustments = star.deliveries(s), star.delivery_adjustments(s)

    def one_run(load):
        seen, lines = (feeds.batch_upto(feed, "batch_id", load) for feed in (deliveries, adjustments))
        arrived = feeds.batch_exact(adjustments, "batch_id", load)
        return upsert.run_incremental(
            store,
            "daily_payouts",
            lambda window: marts.daily_payouts(seen, lines, window, wide=True),
            "delivery_date",
            load,
            lookback_days=marts.DELIVERY_SLA_DAYS,
            strategy=strategy,
            keys=["delivery_date", "city_code"],
            reopened=lambda _: upsert.touched_dates(seen, arrived, ["delivery_id"], "delivery_date"),
        )

    return upsert.replay(loads, one_run)


def _payouts_at(spark, sf_dir, load):
    s = Star(spark, sf_dir)
    seen, lines = (feeds.batch_upto(feed(s), "batch_id", load) for feed in (star.deliveries, star.delivery_adjustments))
    return marts.daily_payouts(seen, lines, wide=True)


@query(PAYOUTS_SQL)
def daily_city_payouts(spark, sf_dir):
    """Three nightly loads with deliveries up to four days late."""
    return _payout_runs(spark, sf_dir)


@query(PAYOUTS_SQL)
def daily_payouts_full(spark, sf_dir):
    return _payouts_at(spark, sf_dir, 3)


@query(PAYOUTS_SQL)
def daily_city_payouts_merge(spark, sf_dir):
    """The same replay with keyed upserts instead of window replacement."""
    return _payout_runs(spark, sf_dir, "merge")


@query("select cast(0 as bigint) as differing_rows, count(*) as mart_rows from daily_payouts")
def incremental_equals_full(spark, sf_dir):
    """The replayed mart against a full rebuild, cell for cell and type for type."""
    incremental, full = _payout_runs(spark, sf_dir), _payouts_at(spark, sf_dir, 3)
    return reconcile.side_counts(incremental, full).agg(
        F.count_if(F.col("left_rows") != F.col("right_rows")).alias("differing_rows"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("mart_rows"),
    )


@query(PAYOUTS_SQL)
def touched_keys_recompute(spark, sf_dir):
    """Load 3 applied to the mart of load 2 by rebuilding only the groups its rows belong to:
    deliveries, and adjustments of deliveries loaded before."""
    s = Star(spark, sf_dir)
    deliveries, adjustments = star.deliveries(s), star.delivery_adjustments(s)
    everything = feeds.batch_upto(deliveries, "batch_id", 3)
    arrived = feeds.batch_exact(deliveries, "batch_id", 3).select("delivery_id").unionByName(
        feeds.batch_exact(adjustments, "batch_id", 3).select("delivery_id")
    )
    return upsert.recompute_touched(
        _payouts_at(spark, sf_dir, 2),
        everything.join(arrived.distinct(), "delivery_id", "left_semi"),
        everything,
        ["delivery_date", "city_code"],
        lambda rows: marts.daily_payouts(rows, adjustments, wide=True),
    )


#: What nightly runs by load time can see: loads before a moment, and half of the load at it.
MOMENTS = ("1997-07-01", "2000-01-01", None)


@query(PAYOUTS_SQL)
def payouts_by_load_time(spark, sf_dir):
    """Three nightly runs that recompute the dates of rows loaded since the last: the stored mark of
    load times finds them, the half that arrives at the very mark included."""
    s = Star(spark, sf_dir)
    root = fresh_folder(spark, "load-time")
    store, marks = MartStore(spark, root, PERIOD), HighWater(spark, root)
    deliveries, adjustments = star.timed_deliveries(s), star.timed_adjustments(s)

    def one_run(run):
        at = F.lit(MOMENTS[run - 1]).cast("timestamp_ntz")
        seen = at.isNull() | (F.col("loaded_at") < at) | ((F.col("loaded_at") == at) & (F.col("delivery_id") % 2 == 0))
        headers, lines = deliveries.where(seen), adjustments.where(seen)
        return upsert.run_arrivals(
            store,
            "daily_payouts",
            lambda window: marts.daily_payouts(headers, lines, window, wide=True),
            "delivery_date",
            run,
            marks,
            {"deliveries": (headers, "loaded_at"), "adjustments": (lines, "loaded_at")},
            lambda new: new["deliveries"].select("delivery_date").unionByName(
                upsert.touched_dates(headers, new["adjustments"], ["delivery_id"], "delivery_date")
            ),
        )

    return upsert.replay(LOADS, one_run)


def _stored_payouts(spark, sf_dir, root):
    """Deliveries logged by batch and the mart that each batch leaves: yields (load, mart, log)."""
    s = Star(spark, sf_dir)
    store, log = MartStore(spark, root, PERIOD), summaries.FeedLog(spark, f"{root}/feeds")
    deliveries, adjustments = star.deliveries(s), star.delivery_adjustments(s).drop("batch_id")
    schema = deliveries.drop("batch_id").schema
    for load in LOADS:
        log.deliver("deliveries", feeds.batch_exact(deliveries, "batch_id", load), load)
        seen = log.upto("deliveries", schema, load)
        upsert.run_incremental(
            store,
            "daily_payouts",
            lambda window: marts.daily_payouts(seen, adjustments, window, wide=True),  # noqa: B023
            "delivery_date",
            load,
            lookback_days=marts.DELIVERY_SLA_DAYS,
        )
        yield load, summaries.of_mart(store, "daily_payouts", "delivery_date"), log.partitioned("deliveries", schema, load)


def _totals_sql() -> str:
    values = {"deliveries": "count(*)", "completed": "count(*) filter (status = 'COMPLETED')", "payout": "sum(payout_base_usd)"}
    rows = [
        f"""select {load} as load, '{name}' as total, cast(coalesce({value}, 0) as decimal(28,2)) as published
            from deliveries where status <> 'CANCELLED' and batch_id <= {load}"""
        for load in LOADS
        for name, value in values.items()
    ]
    both = " union all ".join(rows)
    return f"select *, published as staged, cast(0 as decimal(28,2)) as difference from ({both})"


@query(_totals_sql())
def totals_tie_out_stored(spark, sf_dir):
    """Each night's mart against its feed by kept totals: of the feed only the new batch is read, of the
    mart only the periods that the night wrote."""
    root = fresh_folder(spark, "totals")
    kept, ties = summaries.Summaries(spark, root), None
    live = F.col("status") != "CANCELLED"
    for load, mart, log in _stored_payouts(spark, sf_dir, root):
        published = kept.of(
            "mart-totals",
            mart,
            {
                "deliveries": F.sum("delivery_count"),
                "completed": F.sum("completed_count"),
                "payout": F.sum("payout_base_usd").cast("decimal(38,2)"),
            },
        )
        staged = kept.of(
            "feed-totals",
            log,
            {
                "deliveries": F.count_if(live),
                "completed": F.count_if(F.col("status") == "COMPLETED"),
                "payout": F.sum(F.when(live, F.col("payout_base_usd"))).cast("decimal(38,2)"),
            },
        )
        totals = {name: (F.sum(name), staged, F.sum(name)) for name in ("deliveries", "completed", "payout")}
        # noted before the next night writes over the periods that these totals were read from
        tie = reconcile.tie_out(published, totals).select(F.lit(load).alias("load"), "*")
        tie.write.mode("overwrite").parquet(f"{root}/ties/night={load}")
        tie = spark.read.schema(tie.schema).parquet(f"{root}/ties/night={load}")
        ties = tie if ties is None else ties.unionByName(tie)
    return ties


_NEWEST_SQL = f"""
    (select * from ({PAYOUTS_SQL}) where delivery_date = (select max(delivery_date) from daily_payouts))
"""


@query(
    f"""
    select *, cast(1 as bigint) as left_rows, cast(0 as bigint) as right_rows from {_NEWEST_SQL}
    union all
    select * replace (delivery_count + 1 as delivery_count), cast(0 as bigint), cast(1 as bigint) from {_NEWEST_SQL}
    """
)
def stored_diff_one_period(spark, sf_dir):
    """The replayed mart against a stored rebuild whose newest day counts one delivery too many: digests
    tell which period differs, and only its rows are compared."""
    root = fresh_folder(spark, "digests")
    *_, (_, mart, _) = _stored_payouts(spark, sf_dir, root)
    s, rebuilt = Star(spark, sf_dir), MartStore(spark, f"{root}/rebuilt", PERIOD)
    full = marts.daily_payouts(
        star.deliveries(s).drop("batch_id"), star.delivery_adjustments(s).drop("batch_id"), wide=True
    )
    newest = MartStore(spark, root, PERIOD).newest("daily_payouts", "delivery_date")
    one_more = F.when(F.col("delivery_date") == F.lit(newest), 1).otherwise(0)
    broken = full.withColumn("delivery_count", F.col("delivery_count") + one_more)
    rebuilt.write("daily_payouts", 1, broken, "delivery_date")
    other = summaries.of_mart(rebuilt, "daily_payouts", "delivery_date")
    kept = summaries.Summaries(spark, root)
    return summaries.stored_diff(
        mart,
        summaries.digests(kept, "mart-digests", mart),
        other,
        summaries.digests(kept, "rebuilt-digests", other),
    )


# The upserts on one pair of tables: the target is the payout mart of load 2; the new rows are
# the days from the bound on as of load 3, in which one city has been withdrawn altogether.
BOUND = date(1999, 12, 1)
_AT_SQL = """
    (select delivery_date, city_code, count(*) as delivery_count,
            cast(sum(payout_base_usd) as decimal(28,2)) as payout_base_usd
     from deliveries where status <> 'CANCELLED' and batch_id <= {load} group by 1, 2)
"""
_TARGET_SQL = _AT_SQL.format(load=2)
_NEW_SQL = f"""(select * from {_AT_SQL.format(load=3)}
                where delivery_date >= date '{BOUND}' and city_code <> 'MACHINERY')"""


def _target_and_new(spark, sf_dir):
    deliveries = star.deliveries(Star(spark, sf_dir)).where(F.col("status") != "CANCELLED")

    def at(load):
        seen = feeds.batch_upto(deliveries, "batch_id", load)
        return seen.groupBy("delivery_date", "city_code").agg(
            F.count("*").alias("delivery_count"),
            F.sum("payout_base_usd").cast("decimal(28,2)").alias("payout_base_usd"),
        )

    new = at(3).where((F.col("delivery_date") >= F.lit(BOUND)) & (F.col("city_code") != "MACHINERY"))
    return at(2), new


_KEYED_SQL = f"""
    select * from {_TARGET_SQL} t
    where not exists (select 1 from {_NEW_SQL} n where n.delivery_date = t.delivery_date
                      and n.city_code = t.city_code)
    union all select * from {_NEW_SQL}
"""


@query(_KEYED_SQL)
def upsert_delete_insert(spark, sf_dir):
    """Keyed: the withdrawn city's old rows stay behind."""
    target, new = _target_and_new(spark, sf_dir)
    return upsert.delete_insert(target, new, ["delivery_date", "city_code"])


@query(_KEYED_SQL)
def upsert_merge(spark, sf_dir):
    target, new = _target_and_new(spark, sf_dir)
    return upsert.merge(target, new, ["delivery_date", "city_code"])


@query(
    f"""
    select * from {_TARGET_SQL}
    where delivery_date not in (select delivery_date from {_NEW_SQL})
    union all select * from {_NEW_SQL}
    """
)
def upsert_coarse_key(spark, sf_dir):
    """A key coarser than the grain: every city of a recomputed day is wiped."""
    target, new = _target_and_new(spark, sf_dir)
    return upsert.delete_insert(target, new, ["delivery_date"])


@query(f"select * from {_TARGET_SQL} union all select * from {_NEW_SQL}")
def upsert_append(spark, sf_dir):
    target, new = _target_and_new(spark, sf_dir)
    return upsert.append(target, new)


@query(
    f"""
    select * from {_TARGET_SQL} where delivery_date < date '{BOUND}'
    union all select * from {_NEW_SQL}
    """
)
def upsert_replace_window(spark, sf_dir):
    """The withdrawn city leaves the window, as it would in a full rebuild."""
    target, new = _target_and_new(spark, sf_dir)
    return upsert.replace_window(target, new, "delivery_date", BOUND)


@query(REVENUE_SQL)
def daily_plan_revenue(spark, sf_dir):
    """Three nightly loads: plan history by snapshot, invoices attributed to the plan then,
    payments up to four days late, mart rows recomputed over the lookback window."""
    s = Star(spark, sf_dir)
    root = fresh_folder(spark, "revenue")
    histories, store = HistoryStore(spark, f"{root}/history"), MartStore(spark, f"{root}/marts", PERIOD)
    invoices, lines, payments = star.invoices(s), star.invoice_lines(s), star.invoice_payments(s)

    def one_run(load):
        history = snapshot.run_snapshot(
            histories, marts.PLANS_SNAPSHOT, star.customer_dump(s, load), load, "2002-01-01"
        )
        known, billed, paid = (feeds.batch_upto(feed, "batch_id", load) for feed in (invoices, lines, payments))
        arrived = feeds.batch_exact(lines, "batch_id", load).select("invoice_id").unionByName(
            feeds.batch_exact(payments, "batch_id", load).select("invoice_id")
        )
        dated = known.select("invoice_id", F.to_date("invoiced_at").alias("invoice_date"))
        return upsert.run_incremental(
            store,
            "daily_revenue",
            lambda window: marts.daily_revenue(
                marts.invoice_revenue(known, billed, paid, history, window, wide=True), wide=True
            ),
            "invoice_date",
            load,
            lookback_days=marts.PAYMENT_SLA_DAYS,
            reopened=lambda _: upsert.touched_dates(dated, arrived, ["invoice_id"], "invoice_date"),
        )

    return upsert.replay(LOADS, one_run)


def plan_history(spark, sf_dir):
    """Every customer's plans over time, from the edits that its dumps show."""
    s = Star(spark, sf_dir)
    edits = star.customer_dump(s, 1)
    for load in (2, 3):
        edits = edits.unionByName(star.customer_dump(s, load))
    # Dumps repeat unchanged customers: the edits are the distinct (customer, moment) rows.
    return temporal.scd2_from_log(edits.distinct(), ["customer_id"], "updated_at")


@query(
    """
    select cast(invoice_id as varchar) as invoice_id, cast(customer_id as varchar) as customer_id,
           invoiced_at, invoice_date, plan_code, billed_usd, collected_usd
    from invoice_revenue
    """
)
def invoice_revenue(spark, sf_dir):
    """Every invoice with the plan in effect then, from the history of the source's edits."""
    s, history = Star(spark, sf_dir), plan_history(spark, sf_dir)
    return marts.invoice_revenue(
        star.invoices(s).drop("batch_id"),
        star.invoice_lines(s),
        star.invoice_payments(s).drop("batch_id"),
        history,
        wide=True,
    )


@query(PAYOUTS_SQL)
def nightly_stream_payouts(spark, sf_dir):
    """The late-data replay with the loads delivered as a stream of files: each micro-batch
    lands in the raw log and runs the same incremental mart."""
    s = Star(spark, sf_dir)
    root = fresh_folder(spark, "stream")
    deliveries, adjustments = star.deliveries(s), star.delivery_adjustments(s)
    landed = f"{root}/landing"

    def one_night(load):
        nightly.deliver(feeds.batch_exact(deliveries, "batch_id", load), landed, load)
        return nightly.stream_mart(
            spark,
            landed,
            deliveries.drop("batch_id").schema,
            root,
            "daily_payouts",
            lambda seen, since: marts.daily_payouts(seen, adjustments, since, wide=True),
            "delivery_date",
            marts.DELIVERY_SLA_DAYS,
            PERIOD,
        )

    return upsert.replay(LOADS, one_night)
