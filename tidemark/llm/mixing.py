"""Mixing sources to target weights (native).

Words are summed per source, targets follow from weights, and ``target / size`` is the source's
repetition rate. A document is emitted ``floor(rate)`` times, plus once more if a hash of its id,
its text and the seed falls below the fraction; reruns therefore agree.

Defined cases: a missing text has size 0; a missing source is a source of its own, ordered last;
documents of a source without any words are not taken; rows that repeat both id and text fare alike,
texts without an id or with a shared one are drawn each for itself. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged, table, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def ranked(keys: DataFrame, key: str) -> DataFrame:
    """Distinct ``keys`` with ``rank`` from 0 in code point order, missing last.

    A range sort with the counts of its partitions as offsets: no task sees all keys.
    """
    order = [F.col(key).isNull(), F.col(key)]
    sorted_keys = staged(
        keys.repartitionByRange(shuffle_partitions(keys.sparkSession), *order).withColumn(
            "_part", F.spark_partition_id()
        ),
        "ranks",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sorted_keys.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition
    offsets = offsets.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        sorted_keys.withColumn("_place", place)
        .join(offsets, "_part")
        .withColumn("rank", F.col("_before") + F.col("_place") - 1)
        .drop("_part", "_before", "_place")
    )


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to ``sources`` (source, source_size).

    What a source can't take is shared among the others by weight. Each pass settles all sources
    that the shares so far would lift above their limit; the settled set only grows, and the driver
    sees three sums per pass.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = staged(ranked(sources, "source").withColumn("weight", weight), "weights")
    limit = F.lit(most) * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    settled, full = -1, F.lit(False)
    while True:
        sums = weighed.agg(
            F.sum(F.when(full, limit).otherwise(0)).alias("limits"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(F.when(full, 1).otherwise(0)).alias("full"),
        ).first()
        left, weights_left = float(total * share - (sums["limits"] or 0)), sums["weights"] or 0
        part = F.lit(left) * F.col("weight") / F.lit(max(weights_left, 1))
        if sums["full"] == settled or not weights_left:
            break
        settled, full = sums["full"], part >= limit
    return weighed.select("source", "source_size", F.when(full, limit.cast("double")).otherwise(part).alias("target"))


def chance(id_col: str, digest: Column, seed: str) -> Column:
    """A number in [0, 1) from the id and the text's ``digest``, the same in every run and engine."""
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), digest)
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def text_digest(text: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def rated(sized: DataFrame, id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows with source, size and digest."""
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    shares = per_source.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = chance(id_col, F.col("digest"), seed)
    return (
        sized.join(shares, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_rate", rate)
        .withColumn(
            "copies",
            F.floor("_rate") + F.when(draw < F.col("_rate") - F.floor("_rate"), 1).otherwise(0),
        )
        .drop("_rate", "_source")
    )


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("size", F.size(words(F.col(text))).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    The per-source shares are small and joined in place; texts are not shuffled.
    """
    shares = targets(
        sized(docs.select("source", "text")).groupBy("source").agg(F.sum("size").alias("source_size"))
    ).select(
        F.col("source").alias("_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
    )
    draw = chance(id_col, text_digest(), seed)
    copies = F.floor("_rate") + F.when(draw < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)
    joined = docs.join(staged(shares, "shares"), F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(MOST)))).where(
        F.col("_copy") <= copies
    ).select(*docs.columns)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    docs = docs.withColumn("digest", text_digest()).drop("text")
    return rated(staged(docs, "sizes")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, sum(2 * source_size) OVER o - 2 * source_size AS limits_before,
         sum(weight) OVER () - sum(weight) OVER o + weight AS weight_left,
         1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sources WINDOW o AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)
), flagged AS (
  SELECT *, (total - limits_before::DOUBLE) * weight / weight_left >= 2 * source_size AS above FROM ordered
), rest AS (
  SELECT total - coalesce(sum(2 * source_size) FILTER (above), 0)::DOUBLE AS words_left,
         sum(weight) FILTER (NOT above) AS weights_left
  FROM flagged GROUP BY total
), targets AS (
  SELECT source, source_size, CASE WHEN above THEN (2 * source_size)::DOUBLE
         ELSE words_left * weight / weights_left END AS target
  FROM flagged, rest
), rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || digest), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS chance
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""

QUERIES = {"op10_mix_sources": op10_mix_sources}
ORACLES = {"op10_mix_sources": MIX_SQL}
