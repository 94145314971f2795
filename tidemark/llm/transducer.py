"""A minimal acyclic transducer from byte strings to id sequences, kept as flat arrays.

Sorted words are added one by one. What a new word does not share with the one before is finished:
each of its states is looked up among the finished ones by its arcs, so equal rests of words share
their states. Ids stand on the arcs as early as all words through an arc agree on them. Every word
ends with an arc labelled ``STOP`` into the last state, so no state needs an output of its own.

The file is a header and seven arrays; it is mapped into memory where the path is a file's.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

from .files import opened, written

#: Labels are 1 + byte, so that the end of a word comes before all that continue it.
STOP = 0
_LABELS = 257
MAGIC = b"TMLEX001"
HEADER = struct.Struct("<8sIIII")


def _shared(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Compiler:
    def __init__(self):
        self.known: dict[tuple, int] = {(): 0}
        self.path: list[list] = [[]]  # states of the last word; an arc is [label, target, ids]
        self.last: bytes | None = None

    def add(self, word: bytes, ids: tuple) -> None:
        if self.last is not None and word <= self.last:
            raise ValueError("words come sorted, once each")
        keep = _shared(word, self.last) if self.last is not None else 0
        self._finish(keep)
        path = self.path
        for depth in range(keep):
            arc = path[depth][-1]
            n = _shared(arc[2], ids)
            rest = arc[2][n:]
            if rest:
                arc[2] = arc[2][:n]
                for later in path[depth + 1]:
                    later[2] = rest + later[2]
            ids = ids[n:]
        for label in [*(1 + b for b in word[keep:]), STOP]:
            path[-1].append([label, None, ids])
            path.append([])
            ids = ()
        self.last = word

    def _finish(self, keep: int) -> None:
        path = self.path
        while len(path) > keep + 1:
            arcs = tuple(map(tuple, path.pop()))
            path[-1][-1][1] = self.known.setdefault(arcs, len(self.known))


def compiled(entries: Iterable[tuple[bytes, tuple]]) -> bytes:
    """The file of the sorted ``entries`` (word, ids)."""
    work, longest = _Compiler(), 0
    for word, ids in entries:
        work.add(word, ids)
        longest = max(longest, len(word))
    work._finish(0)
    root = work.known.setdefault(tuple(map(tuple, work.path[0])), len(work.known))
    pool: dict[tuple, int] = {}
    flat: list[int] = []
    keys, targets, at, size = [], [], [], []
    for arcs, state in work.known.items():  # ascending states, arcs by label: the keys are sorted
        for label, target, ids in arcs:
            if ids not in pool:
                pool[ids] = len(flat)
                flat.extend(ids)
            keys.append(state * _LABELS + label)
            targets.append(target)
            at.append(pool[ids])
            size.append(len(ids))
    parts = (np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(at, "<i4"), np.array(size, "<i4"), np.array(flat, "<u4"))
    return HEADER.pack(MAGIC, root, longest, len(keys), len(flat)) + b"".join(p.tobytes() for p in parts)


def write(path: str, entries: Iterable[tuple[bytes, tuple]]) -> None:
    with written(path) as out:
        out.write(compiled(entries))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[k], starts[k] + 1, ... of every k in turn, ``sizes[k]`` of them."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Lexicon:
    """Looks up many words at once, a byte of each at a time."""

    def __init__(self, data):
        magic, self.root, self.longest, n_arcs, n_ids = HEADER.unpack(bytes(data[: HEADER.size]))
        if magic != MAGIC:
            raise ValueError("not a lexicon file")
        place = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal place
            part = np.frombuffer(data, kind, count, place)
            place += part.nbytes
            return part

        self.keys, self.targets = take("<i8", n_arcs), take("<i4", n_arcs)
        self.at, self.size, self.ids = take("<i4", n_arcs), take("<i4", n_arcs), take("<u4", n_ids)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        if "://" not in path or path.startswith("file:"):
            local = "/" + path.removeprefix("file:").lstrip("/")
            return cls(np.memmap(local, np.uint8, "r"))  # one copy a machine, whatever its workers
        with opened(path) as source:
            return cls(source.read())

    def find(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, sizes, ids): whether each word is listed, how many ids it has, all ids in turn.

        Word k is the bytes text[starts[k]], ... , ``lengths[k]`` of them.
        """
        n = len(lengths)
        live = np.flatnonzero(lengths <= self.longest) if len(self.keys) else np.empty(0, np.int64)
        state = np.full(len(live), self.root, np.int64)
        known, steps = np.zeros(n, bool), []
        for k in range(self.longest + 1):
            if not len(live):
                break
            stops = lengths[live] == k
            label = np.full(len(live), STOP, np.int64)
            label[~stops] = text[starts[live[~stops]] + k].astype(np.int64) + 1
            key = state * _LABELS + label
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            known[live[stops & there]] = True
            steps.append((live[there], arc[there]))
            goes = there & ~stops
            live, state = live[goes], self.targets[arc[goes]].astype(np.int64)
        if not steps:
            return known, np.zeros(n, np.int64), np.empty(0, np.uint32)
        word, arc = (np.concatenate(part) for part in zip(*steps, strict=True))
        kept = known[word] & (self.size[arc] > 0)
        word, arc = word[kept], arc[kept]
        order = np.argsort(word, kind="stable")  # steps of a word stay in order
        word, arc = word[order], arc[order]
        sizes = np.bincount(word, self.size[arc], minlength=n).astype(np.int64)
        return known, sizes, self.ids[ranges(self.at[arc].astype(np.int64), self.size[arc].astype(np.int64))]
