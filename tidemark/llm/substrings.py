"""Substring dedup by recompression: words of repeated 13-word windows go.

A window is repeated if its words also start in a document with a smaller id. Recompression
(``recompress``) gives each window a key, the symbol it picks; equal windows have equal keys, and
about five neighbouring windows share one occurrence of it.

1. Keys per document, without the windows; Spark keeps those that two documents share.
2. The windows of shared keys are named by the polynomial hash of their words; the least id per name
   decides. A name is a 64-bit hash, and meets only windows whose keys agree in 16 further bits.
3. Places of repeated windows go back to their documents, which drop the words they cover.

Texts are parsed twice rather than kept, as what they would leave on disk is larger than they are.
Keys that very many documents share are salted by document: every salt keeps its first document,
and only those meet in a second grouping, so no task sees a whole hot group. Shared keys are sent to
all executors while there are at most ``BROADCAST_KEYS``, else joined by shuffle.

Defined cases: a missing or empty text has no words, nothing removed and the hash of the empty
string; texts of fewer than 13 words stay; rows without id neither lose words nor cost others any;
rows that share an id do not remove each other's words and are told apart by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table
from .recompress import Prefixes, window_keys

WIDTH = 13
#: Words parsed at a time; a longer text is parsed alone.
BATCH_WORDS = 200_000
#: At 8 bytes each, and about 40 in an executor's table.
BROADCAST_KEYS = 4_000_000
HOT = 100_000
SALTS = 64
#: A place is the window's first word below a tag of the text it is in.
TAG_SHIFT, TAG_BITS = 40, 23


def _words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def tag(text: str | None) -> int:
    return xxhash.xxh64_intdigest((text or "").encode()) & ((1 << TAG_BITS) - 1)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word hashes, id of each place, place in its text under its tag) of many texts.

    A zero parts the texts; no window across it is used, and symbols beside it are seen by none.
    """
    hashes, ids, places, size = [], [], [], 0
    for batch in batches:
        for doc, text in zip(batch["id"], batch["text"], strict=True):
            words = _words(text)
            if len(words) < WIDTH:
                continue
            n = len(words)
            hashes += [np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n) | np.uint64(1), np.zeros(1, np.uint64)]
            ids.append(np.full(n + 1, doc, np.int64))
            places.append((tag(text) << TAG_SHIFT) + np.arange(n + 1, dtype=np.int64))
            size += n + 1
            if size >= BATCH_WORDS:
                yield np.concatenate(hashes), np.concatenate(ids), np.concatenate(places)
                hashes, ids, places, size = [], [], [], 0
    if size:
        yield np.concatenate(hashes), np.concatenate(ids), np.concatenate(places)


def _keyed(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows within one text: their first places, their keys, and where runs of one key begin."""
    keys = window_keys(hashes, width)
    apart = np.concatenate([[0], np.cumsum(hashes == 0)])
    at = np.flatnonzero(apart[width:] == apart[: len(keys)])
    keys = keys[at]
    first = np.ones(len(at), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1)
    return at, keys, np.flatnonzero(first)


def key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for hashes, ids, _ in _gathered(batches):
        at, keys, runs = _keyed(hashes, WIDTH)
        yield pd.DataFrame({"key": keys[runs].view(np.int64), "id": ids[at[runs]]}).drop_duplicates()


def window_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for hashes, ids, places in _gathered(batches):
        at, keys, runs = _keyed(hashes, WIDTH)
        names = Prefixes(hashes).of(at, at + WIDTH).view(np.int64)
        yield pd.DataFrame(
            {
                "key": keys[runs].view(np.int64),
                "id": ids[at[runs]],
                "place": places[at[runs]],
                "names": np.split(names, runs[1:]),
            }
        )


def repeated_windows(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(id, places): the windows of each document that start in a document with a smaller id.

    ``docs`` has id and text.
    """
    named = docs.where("id is not null")
    keys = named.mapInPandas(key_rows, "key long, id long").groupBy("key")
    keys = keys.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    shared = staged(keys.where("lo != hi").select("key", (F.col("n") > hot).alias("hot")), "shared-keys")
    few = shared.count() <= BROADCAST_KEYS
    rows = named.mapInPandas(window_rows, "key long, id long, place long, names array<long>")
    rows = rows.join(F.broadcast(shared) if few else shared, "key")
    # 16 bits of the key beside the name, and the salt below them: 0 for keys that are not hot
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS)) + 1).otherwise(0)
    part = (F.col("key").bitwiseAND(F.lit(0xFFFF)) * (2 * SALTS) + salt).cast("int")
    windows = rows.select("id", "place", part.alias("part"), F.posexplode("names").alias("k", "name")).select(
        "name", "part", "id", (F.col("place") + F.col("k")).alias("place")
    )
    # one exchange: with a salt, the first document of each salt goes on to the second grouping
    firsts = windows.withColumn("least", F.min("id").over(Window.partitionBy("name", "part")))
    salted = firsts.where((F.col("part") % (2 * SALTS) > 0) & (F.col("id") == F.col("least")))
    bits = F.floor(F.col("part") / (2 * SALTS))
    met = salted.withColumn("least", F.min("id").over(Window.partitionBy("name", bits)))
    repeated = firsts.where("id > least").select("id", "place")
    if shared.where("hot").limit(1).count():
        repeated = repeated.unionByName(met.where("id > least").select("id", "place"))
    return repeated.groupBy("id").agg(F.collect_list("place").alias("places"))


def covered(places: np.ndarray, n: int, width: int = WIDTH) -> np.ndarray:
    """Which of n places lie in a window of ``width`` that starts at one of ``places``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, places, 1)
    np.add.at(steps, np.minimum(places + width, n), -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per row: the kept words, and how many there were and went."""
    for batch in batches:
        rows = []
        for doc, text, places in zip(batch["id"], batch["text"], batch["places"], strict=True):
            words, gone = _words(text), 0
            n = len(words)
            if places is not None and n >= WIDTH:
                own = np.asarray(places, np.int64)
                own = own[own >> TAG_SHIFT == tag(text)] & ((1 << TAG_SHIFT) - 1)
                drop = covered(own, n)
                gone = int(drop.sum())
                words = [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
            rows.append((doc, n, gone, b" ".join(words).decode()))
        out = pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "kept"])
        yield out.assign(id=out["id"].astype("Int64"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_words, n_removed, kept text) of every row."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    places = staged(repeated_windows(plain, hot), "places")
    joined = plain.join(places, "id", "left").select("id", "text", "places")
    out = joined.mapInPandas(without_repeats, "id long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SUBSTRINGS_SQL = r"""
WITH split AS (
  SELECT doc_id, text, row_number() OVER () AS rid,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split WHERE len(w) >= 13)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM windows)
  WHERE doc_id > least
), gone AS (
  SELECT rid, list(DISTINCT p) AS places FROM (SELECT rid, unnest(range(i, i + 13)) AS p FROM repeated) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(places, x[2])), lambda x: x[1])
       END, ' ')) AS kept_sha256
FROM split LEFT JOIN gone USING (rid)
"""

QUERIES = {"op6_substring_dedup": op6_substring_dedup}
ORACLES = {"op6_substring_dedup": SUBSTRINGS_SQL}
