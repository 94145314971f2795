"""Suffix dedup: bytes of 200-byte strings that occur twice anywhere go.

All suffixes of a corpus are too many to sort, and nearly all are met by no other for 200 bytes.
Each 200-byte window picks an anchor, the 64-byte string in it with the least hash; equal windows
pick equal anchors at equal places, and neighbouring windows share one, about one per 69 bytes.

1. Spark counts the anchors' hashes and keeps those that occur twice.
2. Stretches (the windows that share one occurrence of such an anchor) with equal bytes are one
   class. All windows of a class that occurs twice are repeated.
3. Where an anchor stands in several classes, the classes meet in one bucket as suffixes, aligned by
   their anchor, once each however often they occur. A mergesort orders them; suffixes are compared
   by their common extension, which a binary search finds on prefix polynomial hashes, and equal ones
   are verified byte by byte. Ranges of windows are settled from whole stretches down by halving.
4. Repeated bytes go back to their documents, which drop them.

Stretches are named by two independent 64-bit hashes besides the anchor's. Texts are read in pieces
of ``PIECE`` bytes that overlap by a window, so no text is too long. A bucket holds the distinct
surroundings of one 64-byte string, under 340 bytes each; copies were folded before. An anchor with
more than ``BUCKET_ROWS`` surroundings gets no bucket: the windows of its stretches, 137 each at
most, are counted by two independent 64-bit hashes instead, which gathers nothing in one task.

Defined cases: a missing or empty text has no bytes and no spans; texts under 200 bytes stay; a row
that repeats id and text is elsewhere, so both lose their bytes; rows that share an id are told
apart by their text; rows without id take part under a hash of their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table
from .recompress import Prefixes, powers
from .substrings import BROADCAST_KEYS, TAG_SHIFT, tag

WIDTH = 200
ANCHOR = 64
#: Bytes handled at a time; about 100 bytes of memory each.
PIECE = 1 << 20
#: Surroundings of one anchor that are sorted in one task, in about 300 MB.
BUCKET_ROWS = 10_000


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """``pick`` over every ``width`` consecutive values, by doubling."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    return pick(out[: len(values) - width + 1], out[width - reach :]) if reach < width else out


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Texts joined to about ``PIECE`` bytes: the bytes, and (begin, end, id, place) of each part."""
    joined, parts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch["id"], batch["text"], strict=True):
            data = text.encode() if text else b""
            if len(data) < WIDTH:
                continue
            base = tag(text) << TAG_SHIFT
            for start in range(0, len(data) - WIDTH + 1, PIECE):
                part = data[start : start + PIECE + WIDTH - 1]
                parts.append((size, size + len(part), int(doc), base + start))
                joined.append(part)
                size += len(part)
                if size >= PIECE:
                    yield b"".join(joined), parts
                    joined, parts, size = [], [], 0
    if size:
        yield b"".join(joined), parts


def stretches(data: bytes, parts: list[tuple[int, int, int, int]]):
    """Runs of windows by anchor: first window, last window, anchor's place, key, name; and part."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    hashes = Prefixes(raw)
    at = np.arange(n - ANCHOR + 1)
    keys = hashes.of(at, at + ANCHOR)
    ends = np.array([p[1] for p in parts])
    begins = np.array([p[0] for p in parts])
    inner = np.ones(n - ANCHOR + 1, bool)  # anchors within one part
    good = np.zeros(n - WIDTH + 1, bool)  # windows within one part
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        inner[max(b - ANCHOR + 1, a) : b] = False
        good[a : b - WIDTH + 1] = True
    least = np.iinfo(np.uint64).max
    ranked = np.where(inner, keys, least)
    reach = WIDTH - ANCHOR + 1
    low = sliding(ranked, reach)
    fresh = good.copy()
    fresh[1:] &= ~good[:-1] | (low[1:] != low[:-1]) | (ranked[: len(low) - 1] == low[:-1])
    first = np.flatnonzero(fresh)
    # the leftmost place with the least hash: places are tried from the window's start
    places = np.flatnonzero(ranked[: len(low) + reach - 1] <= _widest(low, reach))
    j = np.searchsorted(places, first)
    open_ = np.arange(len(first))
    while len(open_):
        open_ = open_[ranked[places[j[open_]]] != low[first[open_]]]
        j[open_] += 1
    anchor = places[j]
    part = np.searchsorted(begins, first, "right") - 1
    last = np.append(first[1:], n) - 1
    last = np.minimum(last, ends[part] - WIDTH)
    name = hashes.of(first, last + WIDTH) ^ (anchor - first).astype(np.uint64)
    return first, last, anchor, keys[anchor], name, part


def _widest(low: np.ndarray, reach: int) -> np.ndarray:
    """For every place the greatest least hash of the windows over it; only such places are anchors."""
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), low, np.zeros(reach - 1, np.uint64)])
    return sliding(padded, reach, np.maximum)


def anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for data, parts in _pieces(batches):
        yield pd.DataFrame({"key": stretches(data, parts)[3].view(np.int64)})


STRETCH = "key long, name long, id long, place long, lead int, bytes binary"


def stretch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for data, parts in _pieces(batches):
        first, last, anchor, key, name, part = stretches(data, parts)
        begin, ids, base = (np.array([p[k] for p in parts])[part] for k in (0, 2, 3))
        yield pd.DataFrame(
            {
                "key": key.view(np.int64),
                "name": name.view(np.int64),
                "id": ids,
                "place": base + first - begin,
                "lead": (anchor - first).astype(np.int32),
                "bytes": [data[a : b + WIDTH] for a, b in zip(first.tolist(), last.tolist(), strict=True)],
            }
        )


class Suffixes:
    """Suffixes of joined byte strings, compared by hashes of their prefixes."""

    MASK = (1 << 64) - 1

    def __init__(self, strings: list[bytes]):
        self.data = b"".join(strings)
        values = np.frombuffer(self.data, np.uint8)
        n = len(values)
        hashes = Prefixes(values)
        self.sums = hashes.sums.tolist()
        self.inverse = powers(pow(Prefixes.BASE, -1, 1 << 64), n + 1)[: n + 1].tolist()

    def _equal(self, a: int, b: int, size: int) -> bool:
        sums, inverse = self.sums, self.inverse
        left = (sums[a + size] - sums[a]) * inverse[a]
        return (left - (sums[b + size] - sums[b]) * inverse[b]) & self.MASK == 0

    def extension(self, a: int, b: int, limit: int) -> int:
        """Length of the common prefix of two suffixes, up to ``limit``; verified where it is full."""
        if self._equal(a, b, limit) and self.data[a : a + limit] == self.data[b : b + limit]:
            return limit
        low, high = 0, limit  # equal for low, unequal for high
        while high - low > 1:
            middle = (low + high) // 2
            if self._equal(a, b, middle):
                low = middle
            else:
                high = middle
        if self.data[a : a + low] != self.data[b : b + low]:  # hashes met by chance
            low = next(k for k in range(low) if self.data[a + k] != self.data[b + k])
        return low

    def classes(self, starts: list[tuple[int, int]], limit: int) -> list[list[int]]:
        """Groups of (start, item) whose suffixes agree for ``limit`` bytes: sorted neighbours do."""

        def compare(x, y):
            common = self.extension(x[0], y[0], limit)
            if common == limit:
                return 0
            return self.data[x[0] + common] - self.data[y[0] + common]

        ordered = sorted(starts, key=cmp_to_key(compare))
        groups = [[ordered[0][1]]]
        for x, y in zip(ordered, ordered[1:], strict=False):
            if self.extension(x[0], y[0], limit) == limit:
                groups[-1].append(y[1])
            else:
                groups.append([y[1]])
        return groups


def repeated_in_bucket(strings: list[bytes], leads: list[int]) -> list[tuple[int, int] | None]:
    """Per stretch with one anchor, the first and last of its windows that occur in another one.

    A window is told by how far it starts before the anchor, ``x``. For windows x1..x2 there is a
    string that all of them hold and one that holds all: without another stretch that has the first,
    none of them is repeated; with one that has the second, all are. Else the range is halved.
    """
    bases = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).tolist()
    suffixes = Suffixes(strings)
    anchors = [b + lead for b, lead in zip(bases, leads, strict=False)]
    least = [lead - (len(s) - WIDTH) for s, lead in zip(strings, leads, strict=True)]
    found: list[list[int]] = [[] for _ in strings]
    todo = [(list(range(len(strings))), min(least), max(leads))]
    while todo:
        items, x1, x2 = todo.pop()
        items = [i for i in items if least[i] <= x2 and leads[i] >= x1]
        if len(items) < 2:
            continue
        span = x2 - x1
        for sharing in suffixes.classes([(anchors[i] - x1, i) for i in items], WIDTH - span):
            if len(sharing) < 2:
                continue
            whole = [i for i in sharing if least[i] <= x1 and leads[i] >= x2]
            rest = [i for i in sharing if least[i] > x1 or leads[i] < x2]
            if whole:
                for equal in suffixes.classes([(anchors[i] - x2, i) for i in whole], WIDTH + span):
                    rest.append(equal[0])
                    if len(equal) > 1:
                        for i in equal:
                            found[i] += [x1, x2]
            if span and len(rest) > 1:
                middle = (x1 + x2) // 2
                todo += [(rest, x1, middle), (rest, middle + 1, x2)]
    return [(leads[i] - max(x), leads[i] - min(x)) if x else None for i, x in enumerate(found)]


BUCKET = "key long, name long, proof long, first int, last int"


def sorted_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key, in batches; a bucket may span batches."""
    waiting: list[tuple] = []

    def settled():
        spans = repeated_in_bucket([w[3] for w in waiting], [w[4] for w in waiting])
        return [(*w[:3], *s) for w, s in zip(waiting, spans, strict=True) if s]

    for batch in batches:
        out = []
        for row in batch[["key", "name", "proof", "bytes", "lead"]].itertuples(index=False, name=None):
            if waiting and row[0] != waiting[0][0]:
                out += settled()
                waiting = []
            waiting.append(row)
        yield pd.DataFrame(out, columns=["key", "name", "proof", "first", "last"])
    if waiting:
        yield pd.DataFrame(settled(), columns=["key", "name", "proof", "first", "last"])


def repeated_windows(stretches: DataFrame) -> DataFrame:
    """Per stretch the first and last of its windows that occur in another one with its anchor (native)."""
    windows = stretches.select(
        "key", "name", "proof", "lead", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - WIDTH)).alias("at")
    ).withColumn("window", F.expr(f"substring(bytes, at + 1, {WIDTH})"))
    hashed = windows.select(
        "key", "name", "proof", "at", (F.col("lead") - F.col("at")).alias("ahead"),
        F.xxhash64("window").alias("h"), F.xxhash64(F.lit(1), "window").alias("h2"),
    )
    window = ["key", "ahead", "h", "h2"]
    twice = staged(hashed.groupBy(*window).count().where("count > 1").select(*window), "windows")
    found = hashed.join(twice, window, "left_semi").groupBy("key", "name", "proof")
    return found.agg(F.min("at").alias("first"), F.max("at").alias("last"))


def repeated_bytes(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id, spans of (place, stop)): bytes in repeated windows. ``docs`` has id and text, no id missing."""
    counted = docs.mapInPandas(anchor_rows, "key long").groupBy("key").count()
    shared = staged(counted.where("count > 1").select("key"), "shared-anchors")
    few = shared.count() <= BROADCAST_KEYS
    rows = docs.mapInPandas(stretch_rows, STRETCH).join(F.broadcast(shared) if few else shared, "key", "left_semi")
    met = staged(rows.withColumn("proof", F.xxhash64("bytes", "lead")), "stretches")
    name = ["key", "name", "proof"]
    # each class once, however often it occurs: combined before anything is dealt by anchor
    classes = met.groupBy(*name).agg(
        F.count("*").alias("n"),
        F.first(F.length("bytes")).alias("size"),
        F.first("bytes").alias("bytes"),
        F.first("lead").alias("lead"),
    )
    classes = staged(classes, "classes")
    several = staged(classes.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "several")

    def folded(keys: DataFrame) -> DataFrame:
        return classes.select(*name, "bytes", "lead").join(keys.select("key"), "key", "left_semi")

    # the window brings an anchor's classes together and in order; it deals them out again only if the join has not
    place = F.row_number().over(Window.partitionBy("key").orderBy("name", "proof"))
    ordered = folded(several.where(F.col("c") <= bucket_rows)).withColumn("k", place)
    partly = ordered.mapInPandas(sorted_buckets, BUCKET)
    crowded = several.where(F.col("c") > bucket_rows)
    if not crowded.isEmpty():
        partly = partly.unionByName(repeated_windows(folded(crowded)))
    fully = classes.where("n > 1").select(*name, F.lit(0).alias("first"), (F.col("size") - WIDTH).alias("last"))
    # a class that occurs twice is repeated in full, whatever its bucket adds
    spans = staged(fully.unionByName(partly).groupBy(*name).agg(F.min("first").alias("first"), F.max("last").alias("last")), "spans")
    placed = met.select(*name, "id", "place").join(spans, name).select(
        "id", F.struct((F.col("place") + F.col("first")).alias("place"), (F.col("place") + F.col("last") + WIDTH).alias("stop")).alias("span")
    )
    return placed.groupBy("id").agg(F.collect_list("span").alias("spans"))


def dropped(n: int, spans: np.ndarray) -> np.ndarray:
    """Mask of the bytes in [place, stop) spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, spans[:, 0], 1)
    np.add.at(steps, spans[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text, spans in zip(batch["id"], batch["text"], batch["spans"], strict=True):
            data, gone, runs = text.encode() if text else b"", 0, 0
            n = len(data)
            if spans is not None and n >= WIDTH:
                own = np.array([(s["place"], s["stop"]) for s in spans], np.int64)
                own = own[own[:, 0] >> TAG_SHIFT == tag(text)] & ((1 << TAG_SHIFT) - 1)
                drop = dropped(n, own)
                gone, runs = int(drop.sum()), int(drop[0]) + int((drop[1:] & ~drop[:-1]).sum())
                data = np.frombuffer(data, np.uint8)[~drop].tobytes()
            rows.append((doc, n, gone, runs, data))
        out = pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept"])
        yield out.assign(id=out["id"].astype("Int64"))


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept bytes) of every row."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # a text without id takes part under a hash of it; places carry a tag of their text besides
    name = F.coalesce("id", F.xxhash64("text"))
    spans = staged(repeated_bytes(plain.select(name.alias("id"), "text"), bucket_rows), "byte-spans")
    spans = spans.withColumnRenamed("id", "_name")
    joined = plain.withColumn("_name", name).join(spans, "_name", "left").select("id", "text", "spans")
    out = joined.mapInPandas(without_repeats, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLES: dict[str, str] = {}
