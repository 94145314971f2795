"""The trie of conversation prefixes, over range partitions and a skeleton of their splitters.

A conversation is the path of its turns; a node is a distinct sequence of first turns. Turns are named by
the first 16 bytes of a SHA-256 of role and text, so a path is a byte string whose order puts the
members of any node next to each other.

1. Splitters, taken from a bounded sample of the paths, cut the order of (path, id) into shards. Whatever
   begins a splitter's path may lie in several shards: these prefixes, the skeleton, are broadcast. Every other node lies in one
   shard whole. Equal paths part by id, so a path that a third of all conversations follow spans many shards.
2. A shard is sorted and read once, with only the open path in memory. It finishes each node
   outside the skeleton as the path leaves it, and reports sums for skeleton nodes.
3. The reports of a skeleton node are added up by Spark; a pass from the deepest nodes to the root, over no more rows
   than the skeleton has, completes them.
4. A node's hash covers the ids that end in it in ascending order. In a skeleton node these come from several shards, which
   report them as text in bounded chunks; one task reads a node's chunks in turn and keeps only the hash.

Defined cases: rows without a conversation id belong to none and are left out; a missing role or text counts as empty; turns without
a number come first; turns of one number follow by their digest, repeated rows are turns of
their own; other columns are left out; without any conversation there is no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged, table

#: Bytes of a turn's digest.
DIGEST = 16
#: Paths sampled per shard, and bytes of paths sampled in all; the sample only places the splitters.
SAMPLED = 20
SAMPLED_BYTES = 1 << 26
#: Ids per chunk of a skeleton node's ends, and nodes per batch of rows.
CHUNK = 1 << 16
ROWS = 1 << 14
_HEADS = 5


def shared_turns(conversations: DataFrame) -> DataFrame:
    """The query's conversations: (conv_id, turns), each led by turns of the first of its hundred.

    ``turns`` is an array of (digest, points), the digest of a turn and the code points of its text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn"),
            # the role's length keeps (role, text) apart from any other split of the same letters
            F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role), role, text), 256), 1, 2 * DIGEST)).alias("digest"),
            F.length(text).alias("points"),
        ).alias("turn"),
    )
    own = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("t"))
    own = own.select(
        "conv_id",
        F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["points"].alias("points"))).alias("t"),
        F.expr("conv_id - pmod(conv_id, 100)").alias("lead"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int").alias("h"),
    )
    heads = own.where("conv_id = lead").select("lead", F.slice("t", 1, _HEADS).alias("first"))
    return own.join(heads, "lead", "left").select(
        "conv_id", F.expr("concat(slice(coalesce(first, slice(t, 1, 0)), 1, h), slice(t, h + 1, size(t)))").alias("turns")
    )


def _path(turns: Column) -> Column:
    return F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["digest"])), ""))


class Skeleton:
    """All prefixes of the splitters' paths, numbered so that parents come before children."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.number: dict[tuple[int, bytes], int] = {}  # (parent, digest)
        self.parent, self.depth = [-1], [0]
        for path, _ in splitters:
            at = 0
            for k in range(0, len(path), DIGEST):
                key = (at, path[k : k + DIGEST])
                if key not in self.number:
                    self.number[key] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.number[key]


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """``shards`` - 1 places in the order of (path, id), from the conversations whose ids hash least.

    At most ``SAMPLED`` paths per shard and ``SAMPLED_BYTES`` of them reach the driver.
    """
    longest = paths.agg(F.max(F.length("path"))).first()[0] or 0
    rows = min(SAMPLED * shards, max(shards, SAMPLED_BYTES // max(longest, 1)))
    picked = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id"), "conv_id").limit(rows)
    sample = sorted((bytes(r["path"]), r["conv_id"]) for r in picked.collect())
    if not sample:
        return []
    return sorted({sample[len(sample) * k // shards] for k in range(1, shards)})


class _Open:
    """A node of the open path: what its subtree and members add up to so far."""

    __slots__ = ("skeleton", "least", "members", "children", "leaves", "saved", "points", "hash", "ends", "waiting")

    def __init__(self, skeleton: int, points: int):
        self.skeleton, self.points = skeleton, points
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.hash = self.ends = None
        self.waiting: list[tuple] = []  # finished children, which need this node's least member


NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, parent int, node int, points long, place long, ends string"
)
_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("parent", pa.int32()), ("node", pa.int32())]
    + [("points", pa.int64()), ("place", pa.int64()), ("ends", pa.string())]
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class _Shard:
    """Reads one shard's sorted rows and writes rows of ``NODES``.

    Three kinds: finished nodes (``node`` missing; ``parent`` is set if the parent belongs to the skeleton), sums
    for a skeleton node (``node`` set), and a chunk of its ends (``ends`` set, too).
    """

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.rows: list[tuple] = []
        self.path, self.open = b"", [_Open(0, 0)]
        self.first = None

    def add(self, path: bytes, conv: int, points) -> None:
        keep, known = 0, self.path
        if path != known:
            most = min(len(path), len(known))
            keep = _common(path, known, most) // DIGEST
            self._leave(keep)
            for k in range(keep, len(path) // DIGEST):
                above = self.open[-1]
                number = -1
                if above.skeleton >= 0:
                    number = self.skeleton.number.get((above.skeleton, path[k * DIGEST : (k + 1) * DIGEST]), -1)
                    if number < 0:
                        above.children += 1
                else:
                    above.children += 1
                self.open.append(_Open(number, int(points[k])))
            self.path = path
        end = self.open[-1]
        end.members += 1
        end.least = conv if end.least is None else min(end.least, conv)
        if end.skeleton >= 0:
            if end.ends is None:
                end.ends = []
            end.ends.append(conv)
            if len(end.ends) == CHUNK:
                self._chunk(end)
        elif end.hash is None:
            end.hash = hashlib.sha256(b"%d" % conv)
        else:
            end.hash.update(b",%d" % conv)

    def _chunk(self, node: _Open) -> None:
        blank = (None,) * 9
        self.rows.append((*blank, node.skeleton, None, node.ends[0], ",".join(map(str, node.ends))))
        node.ends = None

    def _leave(self, keep: int) -> None:
        while len(self.open) > keep + 1:
            node, depth = self.open.pop(), len(self.open)
            above = self.open[-1]
            above.members += node.members
            above.least = node.least if above.least is None else min(above.least, node.least)
            if node.skeleton >= 0:
                self._report(node, depth)
                continue
            leaves = node.leaves or 1
            saved = node.saved + (node.members - 1) * node.points
            above.leaves += leaves
            above.saved += saved
            digest = node.hash.hexdigest() if node.hash else _NO_ENDS
            parent = above.skeleton if above.skeleton >= 0 else None
            row = (node.least, depth, None, node.members, node.children, leaves, saved, digest, parent, None, None, None, None)
            self._settle(node)
            if parent is None:
                above.waiting.append(row)
            else:
                self.rows.append(row)

    def _settle(self, node: _Open) -> None:
        """The finished children learn their parent's least member."""
        least = node.least
        self.rows.extend(row[:2] + (least,) + row[3:] for row in node.waiting)

    def _report(self, node: _Open, depth: int) -> None:
        if node.ends:
            self._chunk(node)
        self.rows.append(
            (node.least, depth, None, node.members, node.children, node.leaves, node.saved, None, None, node.skeleton, node.points, None, None)
        )

    def close(self) -> None:
        self._leave(0)
        if self.open[0].members:
            self._report(self.open[0], 0)

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(_SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
        )


def _common(a: bytes, b: bytes, most: int) -> int:
    """How many first bytes agree."""
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # agree up to low, not up to high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of ``conversations`` (conv_id, turns as of ``shared_turns``), ids not repeated.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    spark = conversations.sparkSession
    shards = shards or shuffle_partitions(spark)
    paths = staged(
        conversations.select("conv_id", _path(F.col("turns")).alias("path"), F.col("turns.points").alias("points")), "paths"
    )
    skeleton = Skeleton(splitters(paths, shards))
    shared = spark.sparkContext.broadcast(skeleton)

    @F.arrow_udf("int")
    def shard_of(path: pa.Array, conv: pa.Array) -> pa.Array:
        from bisect import bisect_right

        cuts = shared.value.splitters
        return pa.array([bisect_right(cuts, row) for row in zip(path.to_pylist(), conv.to_pylist(), strict=True)], pa.int32())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, None
        for batch in batches:
            points = batch.column(3)
            flat, ends = points.values.to_numpy(zero_copy_only=False), points.offsets.to_numpy()
            for k, (part, path, conv) in enumerate(
                zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ):
                if part != at:  # a task may be dealt more than one shard
                    if shard is not None:
                        shard.close()
                        yield shard.taken()
                    shard, at = _Shard(shared.value), part
                shard.add(path, conv, flat[ends[k] : ends[k + 1]])
                if len(shard.rows) >= ROWS:
                    yield shard.taken()
        if shard is not None:
            shard.close()
            yield shard.taken()

    dealt = paths.select(shard_of("path", "conv_id").alias("shard"), "path", "conv_id", "points")
    sorted_ = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = staged(sorted_.mapInArrow(read, NODES), "nodes")
    top = staged(_completed(found, skeleton, shards), "skeleton")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    local = found.where("node is null").select("parent", *names)
    led = top.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    return (
        local.join(F.broadcast(led), "parent", "left")  # at most as many rows as the skeleton has
        .withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id"))
        .select(*names)
        .unionByName(top.select(*names))
    )


def _completed(found: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """The skeleton's nodes from the shards' reports."""
    spark = found.sparkSession
    sums = (
        found.where("node is not null and ends is null")
        .groupBy("node")
        .agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("points").alias("points"),
        )
    )
    shared = spark.sparkContext.broadcast((np.array(skeleton.parent), np.array(skeleton.depth)))

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not sum(b.num_rows for b in got):
            return
        rows = pa.Table.from_batches(got).to_pydict()
        parent, depth = shared.value
        n = len(parent)
        node = np.array(rows["node"])
        least, members, children, leaves, saved, points = (
            _placed(rows[c], node, n) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "points")
        )
        there = np.zeros(n, bool)
        there[node] = True
        np.add.at(children, parent[1:], there[1:].astype(np.int64))
        saved += np.where(there, (members - 1) * points, 0)
        for k in range(n - 1, -1, -1):  # children have greater numbers than their parents
            if there[k]:
                leaves[k] = leaves[k] if children[k] else 1
                if k:
                    leaves[parent[k]] += leaves[k]
                    saved[parent[k]] += saved[k]
        k = np.flatnonzero(there)
        above = pa.array(np.where(k > 0, least[parent[k]], 0), pa.int64(), mask=k == 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(least[k]), pa.array(depth[k]), above]
            + [pa.array(v[k]) for v in (members, children, leaves, saved)],
            ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"],
        )

    done = sums.repartition(1).mapInArrow(
        complete,
        "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long",
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, work = None, None
        out: list[tuple] = []
        for batch in batches:
            for node, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node != at:
                    if at is not None:
                        out.append((at, work.hexdigest()))
                    at, work = node, hashlib.sha256(ends.encode())
                else:
                    work.update(b"," + ends.encode())
        if at is not None:
            out.append((at, work.hexdigest()))
        nodes, digests = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array(digests, pa.string())], ["node", "digest"])

    # within a node ids ascend from shard to shard, so chunks follow by their first id
    chunks = found.where("ends is not null").select("node", "ends", "place")
    digests = (
        chunks.repartitionById(shards, F.pmod("node", F.lit(shards)))
        .sortWithinPartitions("node", "place")
        .select("node", "ends")
        .mapInArrow(hashed, "node int, digest string")
    )
    return (
        done.join(digests, "node", "left")
        .withColumn("ends_sha256", F.coalesce("digest", F.lit(_NO_ENDS)))
        .drop("digest")
    )


def _placed(values: list, node: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[node] = values
    return out


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(shared_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLES: dict[str, str] = {}
