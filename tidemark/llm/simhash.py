"""SimHash near-duplicates with covering locality-sensitive hashing.

Each of the 64 bits belongs to one of seven groups, numbered by the nonzero vectors of three bits;
table ``v`` keeps the groups whose vector has an odd product with ``v``. Two differing bits span at
most two vectors, so some ``v`` is orthogonal to both: every pair within two bits agrees on the
36 or 37 bits that some table keeps. The masks give no false negatives at any corpus size.

Fingerprints that meet another one in a table go on. They are linked through points: two
fingerprints are within two bits exactly if some 64-bit value is within one bit of both. Each
fingerprint names its 65 values and links to the least fingerprint that names the same, so a bucket
of any size costs rows in proportion to its members and never its pairs.

Equal fingerprints are one node, which removes groups of copies before anything else happens.

Defined cases: a missing or empty text has fingerprint zero and is linked like any other; repeated
rows and ids are rows of their own; a row without id is fingerprinted, linked, and never names a
component unless all rows of its component lack one (then the component is missing, too).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import row_key, staged, table
from .components import components

WIDTH = 3
RADIUS = 2
BITS = 64
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    tokens = text.encode().lower().split() if text else []  # bytes: ASCII case and spaces only
    if not tokens:
        return 0
    parts = [tokens[k:] for k in range(width)] if len(tokens) >= width else [[t] for t in tokens]
    shingles = zip(*parts, strict=False)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles), np.uint64, max(1, len(tokens) - width + 1)
    )
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _CHUNK):  # bounded memory for very long texts
        block = hashes[start : start + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(width: int):
    @pandas_udf("long")
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([signed(fingerprint(t, width)) for t in batch], dtype="int64")

    return udf


def covering_masks(radius: int = RADIUS) -> list[int]:
    """Masks of the covering tables: 2**(radius+1) - 1, whatever the radius."""
    vectors = (1 << (radius + 1)) - 1
    group = [bit % vectors + 1 for bit in range(BITS)]
    return [
        sum(1 << bit for bit in range(BITS) if (group[bit] & v).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints within ``radius`` 2 into components.

    ``distinct`` has the column ``fp`` without repeats.
    """
    if radius != 2:
        raise ValueError("values within one bit link fingerprints within two; other radii need other balls")
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
            for t, m in enumerate(covering_masks(radius))
        ]
    )
    keyed = distinct.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    shared = keyed.groupBy("t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi")
    met = staged(keyed.join(shared.select("t", "key"), ["t", "key"]).select("fp").distinct(), "met")
    ball = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(signed(1 << bit))) for bit in range(BITS)]
    points = met.select("fp", F.explode(F.array(*ball)).alias("point"))
    named = points.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("hi")).where("b != hi")
    return points.join(named.select("point", "b"), "point").select(F.col("fp").alias("a"), "b").distinct()


def _classes(prints: DataFrame, radius: int, order: list[str]) -> DataFrame:
    """(fp, lead) per distinct fingerprint of ``prints`` (id, fp, ...).

    ``lead`` has the ``order`` columns of the first row of the fingerprint's component: the one with
    the least id (missing ids last), then the least of the other columns.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), *order)).alias("least")
    nodes = staged(prints.groupBy("fp").agg(first), "nodes")
    rooted = components(links(nodes.select("fp"), radius))
    linked = rooted.join(nodes, F.col("node") == F.col("fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("lead"))
    named = rooted.join(least, "root").select("node", "lead")
    joined = nodes.join(named, F.col("fp") == F.col("node"), "left")
    return staged(joined.select("fp", F.coalesce("lead", "least").alias("lead")), "classes")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS
) -> DataFrame:
    """(id, fingerprint as long, component_id), one row per row of ``docs``."""
    prints = staged(
        docs.select(F.col(id_col).alias("id"), fingerprints(width)(F.col(text_col)).alias("fp")), "prints"
    )
    found = prints.join(_classes(prints, radius, ["id"]), "fp")
    return found.select(F.col("id").alias(id_col), "fp", F.col("lead.id").alias("component_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component: one with the least id, missing ids last.

    Ids may be missing or stand for unlike texts, so rows are decided by a hash of id and text.
    Texts of one component that share the least id are decided by fingerprint, then by that hash; of
    rows that are equal in id and text the one whose other columns hash lowest stays.
    """
    prints = staged(
        docs.select(
            F.col(id_col).alias("id"),
            row_key(id_col, text_col).alias("key"),
            fingerprints(WIDTH)(F.col(text_col)).alias("fp"),
        ),
        "prints",
    )
    classes = _classes(prints, RADIUS, ["id", "fp", "key"])
    counted = staged(
        prints.groupBy("fp", "key").count().join(classes, "fp").select(
            "key", "count", (F.col("key") == F.col("lead.key")).alias("chosen")
        ),
        "decided",
    )
    gone = counted.where("not chosen").select("key")
    repeated = counted.where("chosen and count > 1").select("key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key(id_col, text_col).alias("key"))
    kept = rows.join(gone, "key", "left_anti")
    if not repeated.isEmpty():
        # a group of equal rows may be large, so its first row is found by an aggregate
        again = kept.join(repeated, "key", "left_semi").withColumn("order", F.sha2(F.col("row").cast("string"), 256))
        single = again.groupBy("key").agg(F.min_by("row", "order").alias("row"))
        kept = kept.join(repeated, "key", "left_anti").unionByName(single.select(*kept.columns))
    return kept.select("row.*")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}
ORACLES: dict[str, str] = {}
