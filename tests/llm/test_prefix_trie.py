"""The conversation trie against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(turns, key=lambda v: v[:2])] for c, turns in own.items()}
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        path = own.get(c - c % 100, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append((c, len(path) == d))
    below = {}
    for k in nodes:
        if k:
            below.setdefault(k[:-1], []).append(k)
    sums = {}
    for k in sorted(nodes, key=len, reverse=True):
        kids = below.get(k, [])
        leaves = sum(sums[x][1] for x in kids) if kids else 1
        saved = sum(sums[x][2] for x in kids) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
        sums[k] = (len(kids), leaves, saved)
    return [
        (
            min(c for c, _ in members), len(k), min(c for c, _ in nodes[k[:-1]]) if k else None, len(members), *sums[k],
            hashlib.sha256(",".join(map(str, sorted(c for c, ends in members if ends))).encode()).hexdigest(),
        )
        for k, members in nodes.items()
    ]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def nodes(df):
    return ordered(tuple(r[n] for n in NAMES) for r in df.collect())


def random_rows(seed):
    rng = random.Random(seed)
    return [
        (c, None if k == 0 and rng.random() < 0.5 else k, rng.choice(["u", None]), rng.choice(["a", "bb", None]) if rng.random() < 0.6 else "same")
        for c in rng.sample(range(-150, 500), 120)
        for k in range(rng.randrange(1, 9))
    ]


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_nodes_equal_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = random_rows(shards)
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(prefix_trie.prefix_trie(prefix_trie.shared_turns(df), shards)) == ordered(brute(rows))


def test_one_path_in_many_shards(spark, monkeypatch):
    """Two thirds of all conversations are alike: their path is cut by id."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 5)
    rows = [(c, k, "u", f"turn {k}" if c % 3 else f"turn {k} {c}") for c in range(300) for k in range(4)]
    turns = prefix_trie.shared_turns(spark.createDataFrame(rows, SCHEMA))
    paths = turns.select("conv_id", prefix_trie._path(F.col("turns")).alias("path"))
    cuts = prefix_trie.splitters(paths, 8)
    assert len({path for path, _ in cuts}) < len(cuts)
    assert nodes(prefix_trie.prefix_trie(turns, 8)) == ordered(brute(rows))


def test_hard_rows(spark, sf_dir):
    """Ids and numbers missing, repeated rows, turnless conversations, very long texts, clashing columns."""
    rows = [
        (None, 0, "user", "lost"), (100, 0, "user", "a"), (100, 0, "user", "a"), (101, None, "user", "first"), (101, 0, None, None),
        (101, 1, "", ""), (102, 0, "user", "x" * 300_000), (102, 1, "assistant", "é🙂"), (250, 0, "user", "alone"), (-5, 0, "user", "a"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("turns", "path", "lead", "t", "h", "node", "shard", "points", "ends"):
        df = df.withColumn(name, F.lit("clash"))
    got = prefix_trie.op13_prefix_trie(spark, sf_dir(conversations=df))
    assert got.columns == NAMES
    assert any(split == 0 for split in (r[4] for r in brute(rows)))
    assert nodes(got) == ordered(brute(rows))


def test_empty_table_has_no_root(spark, sf_dir):
    assert prefix_trie.op13_prefix_trie(spark, sf_dir(conversations=spark.createDataFrame([], SCHEMA))).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(prefix_trie.op13_prefix_trie(spark, "/root/testdata/sf0.01")) == ordered(brute(rows))


def test_equal_first_bytes():
    for a, b in ((b"", b""), (b"abc", b"abd"), (b"abc", b"abc"), (b"x", b"y")):
        want = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        assert prefix_trie._common(a, b, len(a)) == want
