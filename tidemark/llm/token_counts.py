"""Token counts from flat token files, by a scan for separators.

A flat file is nothing but ids of fixed width, documents ended by an end-of-document id; it has no
index. The scan cuts files into blocks of bytes, and tasks look for the end id in each block by one
vector comparison, wherever documents begin. A block reports how many ends it holds and what lies
before its first and after its last. A prefix scan over the blocks' reports then says which document
each block starts in and how many ids of it came before: documents may span any number of blocks.

Files are written where the texts are read, without a shuffle; each attempt of a task names its own
file, and the list of documents says which one counts.

Defined cases: a missing or empty text has no tokens; repeated rows and ids, and rows without id, are
documents of their own; ids after a file's last end are a document without an end and
are not counted; an empty table has no files and no rows. A file whose size is not a whole number
of ids raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_folder
from .common import shuffle_partitions, staged, table
from .files import opened, written
from .vocab import public_vocabulary, word_encoder

#: ``<|endoftext|>`` of the vocabulary; in texts its name is ordinary text.
END = 49407
BLOCK_BYTES = 1 << 22


def write_flat(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end: int = END
) -> DataFrame:
    """Writes one flat file per partition; returns (part, path, place, id), a row per document."""
    spark = docs.sparkSession
    vocabulary, folder = vocabulary or public_vocabulary(), fresh_folder(spark, "llm-flat")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task = word_encoder(vocabulary, plain_specials=True), TaskContext.get()
        part, stop, place = task.partitionId(), np.array([end], "<u2").tobytes(), 0
        path = f"{folder}/part-{part:06d}-{task.taskAttemptId()}.u16"
        first = next(batches, None)
        if first is None:
            return
        with written(path) as out:
            while first is not None:
                for ids in encoder.each(first["text"]):
                    out.write(ids.astype("<u2").tobytes() + stop)
                yield pd.DataFrame(
                    {"part": part, "path": path, "place": np.arange(place, place + len(first)), "id": first["id"].astype("Int64")}
                )
                place += len(first)
                first = next(batches, None)

    return staged(plain.mapInPandas(write, "part int, path string, place long, id long"), "flat")


def file_sizes(paths: DataFrame) -> DataFrame:
    """Adds ``size`` in bytes to the distinct ``path`` of each file."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for path in batch["path"]:
                with opened(path) as source:
                    sizes.append(source.size())
            yield batch.assign(size=np.array(sizes, "int64"))

    return paths.mapInPandas(measure, "part int, path string, size long")


def scan_flat(files: DataFrame, end: int = END, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(part, place, n_tokens) of every document in ``files`` (part, path, size), end id excluded."""
    spark = files.sparkSession
    if block_bytes % width:
        raise ValueError("blocks hold whole ids")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(block_bytes).cast("long"))
    blocks = files.where("size > 0").select("part", "path", "size", F.explode(starts).alias("at"))
    blocks = blocks.repartition(shuffle_partitions(spark), "part", "at")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, path, size, at in batch[["part", "path", "size", "at"]].itertuples(index=False):
                if size % width:
                    raise ValueError(f"{path} does not hold whole ids")
                with opened(path) as source:
                    ids = np.frombuffer(source.read_at(min(block_bytes, size - at), at), f"<u{width}")
                yield pd.DataFrame(
                    {"part": [part], "at": [at], "n_ids": [len(ids)], "ends": [np.flatnonzero(ids == end).astype("int32")]}
                )

    found = staged(blocks.mapInPandas(scan, "part int, at long, n_ids int, ends array<int>"), "scan")
    reports = found.select(
        "part", "at", F.size("ends").alias("n"),
        F.when(F.size("ends") == 0, F.col("n_ids")).otherwise(F.col("n_ids") - F.element_at("ends", -1) - 1).alias("open"),
    )
    # prefix scan: per file, ends before a block and ids since the last of them; a row per block
    before = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    runs = reports.withColumn("place", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # a document is open in the block that ends the one before it, by that block's rest, and in full
    # in the blocks without any end that follow
    carry = runs.groupBy("part", (F.col("place") + F.col("n")).alias("place")).agg(F.sum("open").alias("carry"))
    closing = runs.where("n > 0").join(carry, ["part", "place"], "left")
    return (
        found.join(closing.select("part", "at", "place", "carry"), ["part", "at"])
        .select("part", "place", F.coalesce("carry", F.lit(0)).alias("carry"), F.posexplode("ends").alias("k", "stop"), "ends")
        .select(
            "part",
            (F.col("place") + F.col("k")).alias("place"),
            F.when(F.col("k") == 0, F.col("carry") + F.col("stop"))
            .otherwise(F.col("stop") - F.get("ends", F.col("k") - 1) - 1)
            .cast("long")
            .alias("n_tokens"),
        )
    )


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every row, counted in the flat files it is written to."""
    placed = write_flat(docs, id_col, text_col)
    files = staged(file_sizes(placed.select("part", "path").distinct()), "sizes")
    counted = scan_flat(files)
    return placed.join(counted, ["part", "place"], "left").select(F.col("id").alias(id_col), "n_tokens")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES: dict[str, str] = {}
