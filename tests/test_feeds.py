import pytest
from pyspark.sql import functions as F

from tidemark.plans import feeds as specs
from tidemark.session import shared_folder
from tidemark.sources import feeds


def test_delimited_feed_keeps_blanks_and_reads_empty_as_missing(spark, tmp_path, bag):
    path = tmp_path / "export.csv"
    path.write_text(
        "ORDER_ID,CUSTOMER_CODE,COUNTRY_CODE,ORDER_STATUS,ORDER_TS,AMOUNT_USD,EXPORTED_AT\n"
        "1,K1, FR,Completed ,2025-05-01 10:00:00,,2025-05-02 01:00:00\n"
        "2,,NL, pending,2025-05-01 11:30:00,12.5,2025-05-02 01:00:00\n"
    )
    raw = feeds.read_delimited(spark, str(path), specs.ORDER_EXPORT)
    assert [r[0] for r in raw.orderBy("ORDER_ID").select("ORDER_STATUS").collect()] == [
        "Completed ",
        " pending",
    ]
    staged = feeds.stage(raw, specs.ORDER_EXPORT)
    assert bag(staged) == [
        (1, "K1", " FR", "completed", "2025-05-01 10:00:00", None, "2025-05-02 01:00:00"),
        (2, None, "NL", "pending", "2025-05-01 11:30:00", "12.50", "2025-05-02 01:00:00"),
    ]
    assert staged.schema["amount_usd"].dataType.simpleString() == "decimal(12,2)"
    assert staged.schema["ordered_at"].dataType.simpleString() == "timestamp_ntz"


def test_staging_neither_filters_nor_repairs(rows):
    raw = rows(
        "LINE_ID string, PAYOUT_ID string, ORDER_REF string, CURRENCY string, "
        "LINE_AMOUNT string, PAYMENT_METHOD string",
        ("a", None, "r", None, "-5", None),
        ("a", None, "r", None, "-5", None),
    )
    assert feeds.stage(raw, specs.PAYOUT_LINES).count() == 2


def test_bad_value_raises_instead_of_becoming_missing(rows):
    raw = rows("order_id string, merchant_id string, ordered_at string", ("1", "m", "yesterday"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feeds.stage(raw, specs.MERCHANT_ORDERS).collect()


def test_log_is_read_up_to_a_batch_and_a_dump_exactly(rows, bag):
    feed = rows("k string, b string", ("x", "1"), ("y", "2"), ("z", "10"))
    assert bag(feeds.batch_upto(feed, "b", 2)) == [("x",), ("y",)]
    assert bag(feeds.batch_exact(feed, "b", 2)) == [("y",)]


@pytest.mark.parametrize(
    "as_of, status",
    [
        ("2025-01-01 12:00:00", "pass"),
        ("2025-01-01 12:00:01", "warn"),
        ("2025-01-02 00:00:00", "warn"),
        ("2025-01-02 00:00:01", "error"),
    ],
)
def test_freshness_limits(rows, as_of, status):
    feed = rows("EXPORTED_AT timestamp_ntz", ("2025-01-01 00:00:00",), ("2024-12-31 00:00:00",))
    result = feeds.freshness(feed, specs.ORDER_EXPORT_SOURCE, as_of).first()
    assert result.status == status


def test_freshness_of_an_empty_source_is_an_error(rows):
    feed = rows("EXPORTED_AT timestamp_ntz", ("2025-01-01 00:00:00",)).where(F.lit(False))
    assert feeds.freshness(feed, specs.ORDER_EXPORT_SOURCE, "2025-01-01").first().status == "error"


def test_sources_are_folders_or_tables(spark, rows, tmp_path):
    feed = rows("EXPORTED_AT timestamp_ntz", ("2025-01-01 00:00:00",))
    feed.write.parquet(str(tmp_path / "export"))
    feed.createOrReplaceTempView("export_table")
    sources = feeds.Sources(spark)
    for location in (str(tmp_path / "export"), "export_table"):
        sources.declare(specs.ORDER_EXPORT_SOURCE, location)
        assert sources.freshness("erp.orders", "2025-01-01 01:00:00").first().status == "pass"


def test_undeclared_source_is_refused(spark):
    with pytest.raises(KeyError):
        feeds.Sources(spark).read("erp.orders")


def test_every_feed_spec_has_a_raw_layout():
    named = [v for v in vars(specs).values() if isinstance(v, feeds.FeedSpec)]
    assert len(named) == 26
    for spec in named:
        assert len(spec.raw_schema) == len(spec.fields) + (spec.batch is not None)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
