"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import runs

from llm.conftest import ROWS


def brute(w):
    """All runs (start, length, period) by comparing every word with the one q further on."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if (size := i + q - s) >= max(6, 4 * q):
                found[s, size] = min(q, found.get((s, size), q))
            i += 1
    return sorted((s, size, q) for (s, size), q in found.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def kept(w, found):
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def random_words(rng):
    letters, n, out = rng.choice([1, 2, 2, 3, 5]), rng.randrange(80), []
    if rng.randrange(5) == 0:
        return [rng.randrange(letters) for _ in range(n)]
    while len(out) < n:
        base = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
        out += (base * rng.randrange(1, 9))[: rng.randrange(1, 60)]
    return out


def by_text(texts):
    lengths = np.array([len(t) for t in texts])
    found = runs.runs_of(np.array([x for t in texts for x in t], np.int64), lengths)
    out = [[] for _ in texts]
    for text, *run in zip(*(v.tolist() for v in found), strict=True):
        out[text].append(tuple(run))
    return out


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(3)
    for _ in range(300):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 12))]
        assert by_text(texts) == [brute(t) for t in texts]


def test_runs_of_nested_and_long_repeats():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    nested = ([1, 1, 1, 1, 1, 1, 2] * 6 + [3]) * 5
    texts = [b, nested, [7] * 5000, [1, 2, 3] * 1000, [1, 2, 3] * 4 + [1, 2], [5] * 5, [5] * 6, []]
    assert by_text(texts) == [brute(t) for t in texts]


def test_candidates_tried_in_parts(monkeypatch):
    monkeypatch.setattr(runs, "TRIED", 7)
    texts = [[1, 2] * 30, list(range(40)), [4] * 50]
    assert by_text(texts) == [brute(t) for t in texts]


def test_agreement_equals_brute_force_both_ways():
    rng = random.Random(4)
    for _ in range(40):
        w = random_words(rng) + [1, 1, 2]
        grammar = runs.Grammar(np.array(w), np.zeros(len(w), np.int64))
        pairs = [(i, j) for i in range(len(w)) for j in range(i + 1, len(w))]
        i, j = (np.array(p) for p in zip(*pairs, strict=True))
        ahead, behind = grammar.agree(i, j), grammar.agree(i, j, back=True)
        for (a, b), f, g in zip(pairs, ahead.tolist(), behind.tolist(), strict=True):
            assert f == next((k for k in range(len(w) - b) if w[a + k] != w[b + k]), len(w) - b)
            assert g == next((k for k in range(a) if w[a - 1 - k] != w[b - 1 - k]), a)


def expected(doc, text, plant):
    w = split(text)
    if plant and doc is not None and w:
        h = zlib.crc32(str(doc).encode())
        a, n = h // 10 % len(w), len(w)
        p = 1 + (n - a) // (3 + h // 10 % 8)
        if h % 10 == 0:
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w) if len(w) < 3000 else runs_of_repeated(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    told = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc, len(found), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (told, kept(w, found))))


def runs_of_repeated(w):
    """The one long text is a phrase of three words over and over."""
    assert w == w[:3] * (len(w) // 3)
    return [(0, len(w), 3)]


DOCS = [*ROWS, *((100 + k, f"a b c {'x y ' * (k % 9)}{'z ' * (k % 13)}end of {k} " * (1 + k % 5), "en", "a", k) for k in range(80))]


def test_query_on_hard_rows(spark, docs, sf_dir):
    df = spark.createDataFrame(DOCS, docs.schema)
    for name in ("runs", "start", "w", "h", "p", "best", "collapsed"):
        df = df.withColumn(name, F.lit("clash"))
    got = runs.op12_periodic_runs(spark, sf_dir(documents=df))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and split(r[1]) for r in DOCS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(r[0], r[1], True) for r in DOCS), key=str)


def test_texts_taken_together_or_alone(spark, docs, monkeypatch):
    got = [
        sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect()), key=str)
        for monkeypatch_size in (1, 1 << 18)
        if monkeypatch.setattr(runs, "TOGETHER", monkeypatch_size) is None
    ]
    assert got[0] == got[1]


def test_empty_table(spark, empty, sf_dir):
    assert runs.op12_periodic_runs(spark, sf_dir(documents=empty)).collect() == []
