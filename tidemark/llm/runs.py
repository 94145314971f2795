"""Periodic runs of words, found with a run-length grammar of each text.

1. Words are named by numbers. Rounds of recompression then alternate two steps: equal neighbours
   become one block (symbol, length), and blocks fall in two halves by a hash of their names, where one
   of the left half followed by one of the right half becomes a pair. Names are numbered exactly, so
   equal symbols are equal words. A symbol that stands once in its text can meet no other and is left
   out of all further rounds, which ends them after a few.
2. How far two places agree is read off the grammar: climb while both stand at the edge of equal
   larger symbols, pass equal ones at once (of two blocks the shorter one's length), and go down where
   they differ. The same walk to the left gives the extension backwards.
3. A run of period q holds at least 4 q words, so it meets a place i that divides by 3 q with its
   partner i + q inside. Those places, n / 3 q for each q up to n / 4, are the candidates (a harmonic sum); where
   the two words agree, the extensions to both sides give the run. Of equal stretches the least period is the run's.

Texts are taken together up to ``TOGETHER`` words, a longer one alone; each is whole in one task, at about
200 bytes a word. Spark deals the texts out; nothing is shuffled.

Defined cases: a missing or empty text has no words and no runs and collapses to an empty text; repeated rows and
ids, and rows without id, are rows of their own; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, words

#: A run has at least this many words and this many times its period.
LEAST = 6
TIMES = 4
#: Words handled together, and candidate places tried at a time.
TOGETHER = 1 << 18
TRIED = 1 << 21


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, counts): equal keys get equal names, numbered from 0; counts by name."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts


def _side(names: np.ndarray, round_: int) -> np.ndarray:
    """The half of each name in one round: a bit of a mixed product."""
    mixed = (names.astype(np.uint64) + np.uint64(1 + round_)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 1


class Grammar:
    """All rounds in flat arrays; a symbol's children and parent are places in them.

    ``ids`` numbers the words of several texts in turn and ``owner`` the texts. A place between two
    texts never agrees with anything, as symbols are named per text and never span two.
    """

    def __init__(self, ids: np.ndarray, owner: np.ndarray):
        n = len(ids)
        begin = np.arange(n) + owner  # a gap of one place between texts
        self.slot = np.full(int(begin[-1]) + 3 if n else 3, -1, np.int64)
        names, counts = _numbered(owner * (int(ids.max(initial=0)) + 1) + ids)
        live = np.flatnonzero(counts[names] > 1)
        symbol, begin, end = names[live], begin[live], begin[live] + 1
        self.slot[begin] = np.arange(len(live))
        first = last = np.full(len(live), -1, np.int64)
        levels, base, round_ = [], 0, 0
        while len(symbol):
            size = len(symbol)
            touching = np.flatnonzero(begin[1:] == end[:-1])
            # blocks: runs of equal neighbours
            fresh = np.ones(size, bool)
            fresh[1 + touching[symbol[1 + touching] == symbol[touching]]] = False
            heads = np.flatnonzero(fresh)
            tails = np.append(heads[1:], size) - 1
            run_begin = np.repeat(heads, tails - heads + 1)
            run_end = np.repeat(tails, tails - heads + 1)
            parent = np.full(size, -1, np.int64)
            levels.append((symbol, begin, end, first, last, base + run_begin, base + run_end, parent))
            if not len(touching):
                break
            block, _ = _numbered(symbol[heads] * (size + 1) + (tails - heads + 1))
            # pairs: a block of the left half with a block of the right half that follows at once
            right = _side(block, round_)
            met = np.flatnonzero(~right[:-1] & right[1:] & (begin[heads[1:]] == end[tails[:-1]]))
            paired = np.zeros(len(heads), bool)
            paired[met] = True
            single = np.ones(len(heads), bool)
            single[met] = single[met + 1] = False
            lead = np.flatnonzero(single | paired)
            close = lead + paired[lead]
            second = np.where(paired[lead], block[close] + 1, 0)
            names, counts = _numbered(block[lead] * (len(heads) + 1) + second)
            kept = np.flatnonzero(counts[names] > 1)
            lead, close, symbol = lead[kept], close[kept], names[kept]
            up = base + size
            first, last = heads[lead] + base, tails[close] + base
            parent_of = parent
            spans = last - first + 1
            parent_of[np.repeat(first - base - np.append(0, np.cumsum(spans)[:-1]), spans) + np.arange(spans.sum())] = (
                up + np.repeat(np.arange(len(lead)), spans)
            )
            begin, end = begin[heads[lead]], end[tails[close]]
            base, round_ = up, round_ + 1
        if not levels:
            levels.append(tuple(np.empty(0, np.int64) for _ in range(8)))
        self.ground = len(levels[0][0])
        flat = [np.concatenate([level[k] for level in levels] + [np.array([-1 - k])]) for k in range(8)]
        self.symbol, self.begin, self.end, self.first, self.last, self.run_begin, self.run_end, self.parent = flat

    def agree(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from the places ``i`` and ``j`` on, or before them if ``back``."""
        if back:
            inner, outer, run, near, far, step = self.last, self.first, self.run_begin, self.end, self.begin, -1
            a, b = self.slot[i - 1], self.slot[j - 1]
        else:
            inner, outer, run, near, far, step = self.first, self.last, self.run_end, self.begin, self.end, 1
            a, b = self.slot[i], self.slot[j]
        symbol, parent, ground = self.symbol, self.parent, self.ground
        reach = i.copy()
        who = np.flatnonzero((a >= 0) & (b >= 0))
        a, b = a[who], b[who]
        while len(who):
            up_a, up_b = parent[a], parent[b]
            climbs = (up_a >= 0) & (up_b >= 0)
            climbs &= (inner[up_a] == a) & (inner[up_b] == b) & (symbol[up_a] == symbol[up_b])
            equal = symbol[a] == symbol[b]
            passes = equal & ~climbs
            a, b = np.where(climbs, up_a, a), np.where(climbs, up_b, b)
            # pass what both runs of this symbol still hold, then stand at what follows
            p = np.flatnonzero(passes)
            done = np.zeros(len(who), bool)
            if len(p):
                pa_, pb = a[p], b[p]
                many = step * np.minimum(np.abs(run[pa_] - pa_), np.abs(run[pb] - pb))
                pa_, pb = pa_ + many, pb + many
                reach[who[p]] = far[pa_]
                open_ = np.arange(len(p))
                while len(open_):
                    qa, qb = pa_[open_], pb[open_]
                    follows = (near[qa + step] == far[qa]) & (near[qb + step] == far[qb])
                    pa_[open_[follows]] += step
                    pb[open_[follows]] += step
                    open_, qa, qb = open_[~follows], qa[~follows], qb[~follows]
                    bottom = qa < ground
                    done[p[open_[bottom]]] = True
                    open_ = open_[~bottom]
                    pa_[open_], pb[open_] = outer[pa_[open_]], outer[pb[open_]]
                a[p], b[p] = pa_, pb
            # go down where the symbols differ
            d = np.flatnonzero(~equal)
            done[d[a[d] < ground]] = True
            d = d[a[d] >= ground]
            a[d], b[d] = inner[a[d]], inner[b[d]]
            stay = ~done
            who, a, b = who[stay], a[stay], b[stay]
        return np.abs(reach - i)


def _candidates(lengths: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grids of all texts, about ``TRIED`` at a time."""
    tops = np.where(lengths >= LEAST, lengths // TIMES, 0)
    text = np.repeat(np.arange(len(lengths)), tops)
    period = np.arange(len(text)) - np.repeat(np.cumsum(tops) - tops, tops) + 1
    grid = (TIMES - 1) * period
    many = -(-(lengths[text] - period) // grid)
    ends = np.cumsum(many)
    begin = 0
    while begin < len(many):
        done = int(ends[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + TRIED, "right")))
        n = many[begin:stop]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[text[begin:stop]], n) + k * np.repeat(grid[begin:stop], n), np.repeat(period[begin:stop], n)
        begin = stop


def runs_of(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``ids`` are the numbered words of several texts in turn, ``lengths`` of them each.
    """
    lengths = lengths.astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    word_starts = np.cumsum(lengths) - lengths
    starts = word_starts + np.arange(len(lengths))  # places count a gap between texts
    grammar, found = None, []
    for place, period in _candidates(lengths, starts):
        at = place - owner[_word(place, starts, word_starts)] if len(lengths) > 1 else place
        same = np.flatnonzero(ids[at] == ids[at + period])
        if not len(same):
            continue
        grammar = grammar or Grammar(ids, owner)
        i, q = place[same], period[same]
        ahead = grammar.agree(i, i + q)
        behind = grammar.agree(i, i + q, back=True)
        size = behind + q + ahead
        good = size >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([i[good] - behind[good], size[good], q[good]]))
    if not found:
        return (np.empty(0, np.int64),) * 4
    start, size, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, size, start))
    start, size, period = start[order], size[order], period[order]
    fresh = np.ones(len(start), bool)  # the least period of each stretch
    fresh[1:] = (start[1:] != start[:-1]) | (size[1:] != size[:-1])
    start, size, period = start[fresh], size[fresh], period[fresh]
    text = np.searchsorted(starts, start, "right") - 1
    start -= starts[text]
    order = np.lexsort((period, start, text))
    return text[order], start[order], size[order], period[order]


def _word(place: np.ndarray, starts: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """The number, among all words, of the word at each place."""
    text = np.searchsorted(starts, place, "right") - 1
    return place - starts[text] + word_starts[text]


def collapsed(text: list[bytes], start: np.ndarray, size: np.ndarray, period: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period, joined by spaces."""
    if not len(start):
        return b" ".join(text)
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([text[k] for k in kept.tolist()])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _rows(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    coded = pa.array([w for text in texts for w in text], pa.binary()).dictionary_encode()
    text, start, size, period = runs_of(coded.indices.to_numpy().astype(np.int64), lengths)
    cuts = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(start), pa.array(size), pa.array(period)], fields=list(_RUN))
    joined = [
        collapsed(words_, start[a:b], size[a:b], period[a:b])
        for words_, a, b in zip(texts, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(cuts), runs), pa.array(joined, pa.binary()).cast(pa.string())],
        ["id", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs by start and period, the text collapsed to one period of each run), a row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                found = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if held and held + len(found) > TOGETHER:
                    yield _rows(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc.as_py())
                texts.append(found)
                held += len(found)
        if ids:
            yield _rows(ids, texts)

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, FOUND).withColumnRenamed("id", id_col)


def planted(docs: DataFrame) -> DataFrame:
    """The query's texts: one in ten repeats its words from word ``a`` on with period ``p``."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    sized = split.select("doc_id", "text", "w", F.floor(F.col("h") / 10).alias("g"), F.size("w").alias("n"))
    placed = sized.select("*", F.expr("int(if(n > 0, g % n, 0))").alias("a"))
    rated = placed.select("*", F.expr("int(1 + (n - a) div (3 + g % 8))").alias("p"))
    return rated.select(
        "doc_id",
        F.expr(
            "if(n > 0, array_join(concat(slice(w, 1, a),"
            " slice(flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)), ' '), text)"
        ).alias("text"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # the greatest length; of equal ones the smallest start, then period
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("rate")))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.rate")).alias("period"),
        F.expr("1000 * best.length div -best.rate").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(told, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES: dict[str, str] = {}
