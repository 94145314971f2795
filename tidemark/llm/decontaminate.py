r"""Benchmark decontamination by size-partitioned MinHash containment (native).

An item is found in a document if the document holds at least 80 % of the item's distinct five-word
shingles. Items are short and documents long, so similarity of whole sets says little; what is
estimated is the containment of the item. Items are partitioned by size: class ``k`` has those with
2**k to 2**(k+1) - 1 shingles. An item's sketch is its shingles with the least hashes (its bottom
MinHash values), one more than the number an item of its size may miss. Hence a document without
any sketch shingle misses too many for a match: candidates are complete, whatever the hashes.
Documents too small for a class skip its sketches. Candidates are then verified by the exact share
of shingles, compared as text.

Words are runs of letters, marks and digits, lower-cased. A text with fewer than five words is one
shingle; one without words has none and matches nothing. A document or item is an id with a text, told
apart by a 128-bit hash of both: texts that share an id, or lack one, are searched each for itself
and reported under the id they have; rows with equal id and text are one. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_key, staged, table

WIDTH = 5
CONTAINMENT = 0.8
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"
#: Sketches of fewer rows (16 bytes each) are sent to every executor; others are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _shingle_rows(df: DataFrame, width: int, *keep: str) -> DataFrame:
    """A row per shingle of ``_w`` with its first place ``_i``; the words are not copied.

    Places are generated by an expression: for a bare column, Spark would add a filter on its size
    and split every text twice.
    """
    places = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.greatest(F.size("_w") - width, F.lit(0))))
    return df.select(*keep, "_w", F.explode(places).alias("_i"))


def _hash(width: int) -> Column:
    return F.xxhash64(*[F.get("_w", F.col("_i") + k) for k in range(width)])


def _gram(width: int) -> Column:
    return F.concat_ws(" ", *[F.get("_w", F.col("_i") + k) for k in range(width)])


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """(item, item_key, gram, h, n, class): the distinct shingles of every item."""
    worded = items.select(
        F.col(id_col).alias("item"),
        row_key(id_col, text_col).alias("item_key"),
        plain_words(F.col(text_col)).alias("_w"),
    )
    named = _shingle_rows(worded, width, "item", "item_key")
    grams = named.select("item", "item_key", _gram(width).alias("gram"), _hash(width).alias("h"))
    grams = grams.distinct()
    sizes = grams.groupBy("item_key").agg(F.count("*").alias("n"))
    return grams.join(sizes, "item_key").withColumn("class", F.floor(F.log2("n")).cast("int"))


def sketches(shingles: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(h, class): bottom MinHash values per item, as many as its size class needs.

    An item of n shingles may miss n - ceil(containment * n); the class takes that of its largest.
    The rank is kept per item, which is a short text.
    """
    largest = F.pow(F.lit(2.0), F.col("class") + 1) - 1
    needed = F.floor(largest * (1 - containment) + 1e-9) + 1
    place = F.row_number().over(Window.partitionBy("item_key").orderBy(F.xxhash64("h"), "gram"))
    return shingles.withColumn("_r", place).where(F.col("_r") <= needed).select("h", "class").distinct()


def _leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    item_id: str,
    item_text: str,
    width: int,
    containment: float,
) -> DataFrame:
    """(doc, doc_key, item, n, shared): a row per document and item it holds."""
    shingles = staged(item_shingles(items, item_id, item_text, width), "items")
    sketch = staged(sketches(shingles, containment), "sketches")
    if sketch.count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)
    worded = docs.select(
        F.col(id_col).alias("doc"), row_key(id_col, text_col).alias("doc_key"), plain_words(F.col(text_col)).alias("_w")
    )
    # a document is large enough for a class if it can hold the share of the class's least size
    room = F.floor(F.log2(F.size("_w") / F.lit(containment) + F.lit(1e-9)))
    hit = (
        _shingle_rows(worded, width, "doc_key")
        .select("doc_key", _hash(width).alias("h"), room.alias("room"))
        .join(sketch, "h")
        .where("class <= room")
        .groupBy("doc_key")
        .count()
        .select("doc_key")
    )
    candidates = staged(hit, "candidates")
    held = (
        _shingle_rows(worded.join(candidates, "doc_key", "left_semi"), width, "doc", "doc_key")
        .select("doc", "doc_key", _gram(width).alias("gram"), _hash(width).alias("h"))
        .join(shingles.select("item", "item_key", "n", "h", "gram"), ["h", "gram"])
        .groupBy("doc", "doc_key", "item", "item_key", "n")
        .agg(F.countDistinct("gram").alias("shared"))
    )
    return held.where(F.col("shared") >= F.ceil(F.col("n") * F.lit(containment) - F.lit(1e-9)))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """(id, item, item_shingles, shared_shingles, containment) of every leaked item."""
    return _leaks(docs, items, id_col, text_col, item_id, item_text, width, containment).select(
        F.col("doc").alias(id_col),
        F.col("item").alias(item_id),
        F.col("n").alias("item_shingles"),
        F.col("shared").alias("shared_shingles"),
        (F.col("shared") / F.col("n")).alias("containment"),
    )


def decontaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """``docs`` without the documents that hold an item, with or without ids."""
    plain = docs.select(id_col, text_col)
    leaks = _leaks(plain, items.select(item_id, "text"), id_col, text_col, item_id, "text", WIDTH, CONTAINMENT)
    leaked = staged(leaks.select("doc_key").distinct(), "leaked")
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key(id_col, text_col).alias("doc_key"))
    return rows.join(leaked, "doc_key", "left_anti").select("row.*")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )


LEAKS_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, * FROM (
    SELECT DISTINCT 'doc' AS kind, doc_id AS id, text FROM documents
    UNION ALL
    SELECT DISTINCT 'item', item_id, text FROM benchmark
  ) WHERE text IS NOT NULL
), words AS (
  SELECT row, kind, id,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM texts
), grams AS (
  SELECT DISTINCT row, kind, id, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT row, kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT row, count(*) AS n FROM grams WHERE kind = 'item' GROUP BY row)
SELECT d.id AS doc_id, i.id AS item_id, n AS item_shingles, count(*) AS shared_shingles,
       count(*)::DOUBLE / n AS containment
FROM grams d JOIN grams i ON d.gram = i.gram AND d.kind = 'doc' AND i.kind = 'item' JOIN sizes ON sizes.row = i.row
GROUP BY d.row, d.id, i.row, i.id, n
HAVING count(*) >= ceil(n * 0.8::DOUBLE - 1e-9)
"""

QUERIES = {"op1_benchmark_decontamination": op1_benchmark_decontamination}
ORACLES = {"op1_benchmark_decontamination": LEAKS_SQL}
