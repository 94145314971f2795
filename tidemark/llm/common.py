"""What the operators share: the word rule, scratch tables, table reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_folder

#: Words are what these six ASCII characters separate.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a missing text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits that name an id with its text, either of them possibly missing.

    A missing value gives the marker ``-``, a present one follows ``+``, so none is like another.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(part(id_col), F.lit(" "), part(text_col))))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: an executor lost later costs a read of the table, not a second run of what
    made it. Folders are named ``llm-<purpose>-<id>``; whoever owns the shared folder empties it.
    """
    path = fresh_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
