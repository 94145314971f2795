"""Nightly loads delivered as files and processed as micro-batches.

``trigger(availableNow=True)`` works through whatever has been delivered since the last run and
stops. Spark's checkpoint remembers which files were seen; a micro-batch that is repeated after a
failure overwrites what its first attempt wrote. The raw log is kept by load, and a micro-batch
writes each load it meets from all files that the load's folder holds by then: a load that is delivered
again replaces its rows instead of adding to them, and one that arrives in several micro-batches ends
whole. Landing folders therefore stay complete. Rows of a load that the log has met before, or that
comes after a newer one, may be older than the mart's window; such a run rebuilds the mart.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import run_incremental
from ..sources.store import MartStore


def deliver(rows: DataFrame, landing: str, load: int) -> None:
    """Puts one load's rows into the landing folder, as the upstream job would."""
    rows.write.mode("overwrite").parquet(f"{landing}/load={load}")


def read_landing(spark: SparkSession, landing: str, schema: T.StructType) -> DataFrame:
    """New rows with the ``load`` they belong to, which is named by their folder."""
    load = F.regexp_extract(F.input_file_name(), r"/load=(\d+)/", 1).cast("int")
    return spark.readStream.schema(schema).parquet(f"{landing}/load=*").withColumn("load", load)


def stream_mart(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    root: str,
    name: str,
    build: Callable[[DataFrame, date | None], DataFrame],
    grain: str,
    lookback_days: int,
    period: str = "month",
) -> DataFrame:
    """Brings the mart up to date with everything delivered, and returns it.

    The loads of each micro-batch are put into the raw log and the mart's incremental step runs on the
    whole log, exactly as a scheduled nightly run would.
    """
    store, log = MartStore(spark, f"{root}/marts", period), f"{root}/log"
    logged = T.StructType([*schema, T.StructField("load", T.IntegerType())])

    def one_batch(rows: DataFrame, number: int) -> None:
        loads = sorted(r["load"] for r in rows.select("load").distinct().collect())
        whole, newest = rows, None
        if loads:
            folders = [f"{landing}/load={load}" for load in loads]
            whole = spark.read.schema(logged).option("basePath", landing).parquet(*folders)
            if store.exists(name):
                newest = spark.read.schema(logged).parquet(log).agg(F.max("load")).first()[0]
        by_load = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        by_load.partitionBy("load").parquet(log)
        seen = spark.read.schema(schema).parquet(log).select(*schema.names)
        run_incremental(store, name, lambda since: build(seen, since), grain, number + 1,
                        lookback_days=lookback_days,
                        full_refresh=newest is not None and loads[0] <= newest)

    stream = (
        read_landing(spark, landing, schema)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return store.read(name)
