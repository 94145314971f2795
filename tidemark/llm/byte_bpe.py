"""Byte-level BPE, encoded through a lexicon of the corpus's frequent words, and decoded.

1. Texts are split by the vocabulary's own rule; Spark counts the pieces of all texts.
2. The ``WORDS`` most frequent pieces are merged and compiled into a minimal acyclic transducer
   (``transducer``), a file of a few MB in the shared folder that workers map into memory.
3. The second reading looks up the distinct pieces of about a megabyte of text at once, byte by byte;
   pieces that the lexicon has not got are merged exactly, lowest rank first, leftmost first.
4. Decoding joins the bytes of the ids and reads them as UTF-8, what is not UTF-8 replaced.

The lexicon changes speed only: ids equal those of the vocabulary's library for any text.

Defined cases: a missing or empty text has no ids and decodes to an empty text; rows that repeat an
id, or lack one, are encoded row by row; other columns are left out; an empty table gives no rows. Texts of
any length are split in parts of about ``PART`` characters, cut where no piece can span.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_folder
from . import transducer
from .common import table

#: Pieces in the lexicon at most; it holds the most frequent ones.
WORDS = 1 << 17
#: Characters encoded at a time.
PART = 1 << 20
#: Distinct pieces a task counts at a time, and merged pieces a worker remembers before it starts anew.
HELD = 200_000
#: Characters a task counts at a time, as pieces may be long.
READ = 1 << 26

_BITS = 32
_ID = (1 << _BITS) - 1
_NONE = 1 << 63

#: The split rule of byte-level vocabularies with ``use_regex``; a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where all characters are of this class, the faster engine splits alike.
_PLAIN = re.compile("[\t-\r -~ -ɏ‐-‧]*")
_LETTERS, _DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_PLAIN_SPLIT = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\\s{_LETTERS}{_DIGITS}]+|\\s+(?!\\S)|\\s+"
)
#: Characters that all editions of the character tables since long class alike; the tokenizer's own
#: splitter takes texts with others, as its edition differs from that of this Python.
_SETTLED = re.compile(
    "[\x00-\x1b\x20-՗ՙ-֊֑-ׇא-ת؀-܍ऀ-ઃก-ฺ"
    "Ⴀ-Ⴥა-ჼᄀ-ቈḀ-ἕ -⁤⁰⁴-₎₠-₹"
    "℀-↉←-⏳─-⛿✁-➿　-〿ぁ-ゖ゙-ヿㄅ-ㄭ"
    "一-龥가-힣！-ﾾ\U0001f300-\U0001f5ff\U0001f600-\U0001f64f]*"
)
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])[ \n]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """What the vocabulary file says, and the exact merging of one piece."""

    def __init__(self, path: str):
        with open(path) as source:
            told = json.load(source)
        first, model = told["pre_tokenizer"], told["model"]
        if first["type"] != "ByteLevel" or not first["use_regex"] or first["add_prefix_space"] or told["normalizer"]:
            raise ValueError("a byte-level vocabulary without normalizer and added space is needed")
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a plain BPE model is needed")
        added = told["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens are plain strings here")
        letters, vocab = byte_letters(), model["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.bytes_of = [b""] * self.size
        for word, at in vocab.items():
            self.bytes_of[at] = bytes(letters[c] for c in word)
        self.added = {t["content"]: t["id"] for t in added}
        for word, at in self.added.items():
            self.bytes_of[at] = word.encode()
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # a pair of ids, in one number, names its rank and the id that it becomes
        self.merges = {
            vocab[a] << _BITS | vocab[b]: rank << _BITS | vocab[a + b] for rank, (a, b) in enumerate(pairs)
        }
        # longer names first, as the leftmost longest one counts
        names = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.path = path
        self.rule = regex.compile(SPLIT)
        self.merged: dict[bytes, list[int]] = {}

    @cached_property
    def own(self):
        """The library's splitter, loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).pre_tokenizer

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without added tokens."""
        if _PLAIN.fullmatch(text):
            return _PLAIN_SPLIT.findall(text)
        if _SETTLED.fullmatch(text):
            return self.rule.findall(text)
        return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]

    def parts(self, text: str, size: int = PART) -> Iterator[tuple[list[str], int | None]]:
        """Pieces in turn, each list followed by the added token that ends it, if one does."""
        cut = self.specials.split(text) if self.specials else [text]
        for k in range(0, len(cut), 2):
            plain, at = cut[k], 0
            while len(plain) - at > size:  # a space after another character always begins a piece
                found = _CUT.search(plain, at + size)
                if found is None:
                    break
                yield self.pieces(plain[at : found.start()]), None
                at = found.start()
            yield self.pieces(plain[at:]), self.added[cut[k + 1]] if k + 1 < len(cut) else None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank goes first, of equal ones the leftmost."""
        ids = [self.byte_ids[b] for b in piece]
        if len(ids) >= 64:
            return self._merge_long(ids)
        rank_of = self.merges.get
        ranks = [rank_of(a << _BITS | b, _NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (low := min(ranks)) != _NONE:
            k = ranks.index(low)
            ids[k : k + 2] = (low & _ID,)
            del ranks[k]
            if k:
                ranks[k - 1] = rank_of(ids[k - 1] << _BITS | ids[k], _NONE)
            if k < len(ranks):
                ranks[k] = rank_of(ids[k] << _BITS | ids[k + 1], _NONE)
        return ids

    def _merge_long(self, ids: list) -> list[int]:
        """The same with places linked to their neighbours and the pairs in a heap."""
        rank_of = self.merges.get
        left, right = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        heap: list[tuple[int, int]] = []

        def rank(k: int) -> int:
            return _NONE if k < 0 or right[k] < 0 else rank_of(ids[k] << _BITS | ids[right[k]], _NONE)

        def offer(k: int) -> None:
            if (found := rank(k)) != _NONE:
                heapq.heappush(heap, (found, k))

        for k in range(len(ids) - 1):
            offer(k)
        while heap:
            low, k = heapq.heappop(heap)
            if ids[k] is None or rank(k) != low:
                continue
            gone = right[k]
            ids[k], ids[gone], right[k] = low & _ID, None, right[gone]
            if right[k] >= 0:
                left[right[k]] = k
            offer(left[k])
            offer(k)
        return [i for i in ids if i is not None]

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        if len(self.merged) + len(pieces) > HELD:
            self.merged.clear()
        known, merged = self.merged, []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = self.merge(piece)
                if len(piece) < 64:
                    known[piece] = ids
            merged.append(ids)
        return merged

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=2)
def lexicon(path: str) -> transducer.Lexicon:
    return transducer.Lexicon.open(path)


def public_byte_vocabulary() -> str:
    """Default vocabulary file; its place is a parameter everywhere."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def counted(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """(word, n) of the pieces of the first column, a row per distinct piece as long as ``HELD`` and ``READ`` allow."""
    bpe, held, read = byte_bpe(vocabulary), Counter(), 0

    def rows() -> pa.RecordBatch:
        words, n = pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())
        held.clear()
        return pa.RecordBatch.from_arrays([words.cast(pa.binary()), n], ["word", "n"])

    for batch in batches:
        for text in batch.column(0):
            plain = text.as_py() or ""
            for pieces, _ in bpe.parts(plain):
                held.update(pieces)
                if len(held) > HELD:
                    yield rows()
            read += len(plain)
            if read > READ:
                yield rows()
                read = 0
    yield rows()


def word_counts(texts: DataFrame, vocabulary: str) -> DataFrame:
    """(word, n): how often each piece occurs in the column ``text``, all rows counted."""
    found = texts.select("text").mapInArrow(lambda batches: counted(batches, vocabulary), "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, words: int) -> DataFrame:
    """The rows of ``counts`` (word, n) with the greatest n, ``words`` at most.

    Counts are told in steps of a 64th of a doubling, so the bound is found from a few thousand
    numbers, and no task sees more than its share; words of the step that would overflow stay out.
    """
    stepped = counts.withColumn("step", F.floor(64 * F.log2("n")).cast("int"))
    held, least = 0, None
    for r in sorted(stepped.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        held += r["count"]
        if held > words:
            break
        least = r["step"]
    return stepped.where("false" if least is None else f"step >= {least}").drop("step")


def compile_lexicon(texts: DataFrame, vocabulary: str | None = None, words: int = WORDS) -> str:
    """Path of the lexicon of the most frequent pieces of the column ``text``.

    The listed words, ``words`` of them at most, are merged and compiled on the driver. The counts are read twice
    and kept on the executors' disks for that.
    """
    vocabulary = vocabulary or public_byte_vocabulary()
    path = f"{fresh_folder(texts.sparkSession, 'llm-lexicon')}/words.lex"
    counts = word_counts(texts, vocabulary).persist(StorageLevel.DISK_ONLY)
    listed = sorted(frequent(counts, words).select("word").toArrow().column(0).to_pylist())
    counts.unpersist()
    bpe = byte_bpe(vocabulary)
    transducer.write(path, ((w, tuple(bpe.merge(w))) for w in listed))
    return path


class Encoder:
    def __init__(self, vocabulary: str, path: str):
        self.bpe, self.lexicon = byte_bpe(vocabulary), lexicon(path)

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids): how many ids each text has, and all ids in turn."""
        sizes, out = np.zeros(len(texts), np.int64), []
        held: list[str] = []  # pieces in turn; an empty one stands for the next of ``specials``
        specials: list[int] = []
        owners: list[tuple[int, int]] = []  # row, number of pieces
        for row, text in enumerate(texts):
            for pieces, special in self.bpe.parts(text) if text else ():
                before = len(held)
                held.extend(pieces)
                if special is not None:
                    held.append("")
                    specials.append(special)
                owners.append((row, len(held) - before))
                if len(held) > PART // 4:
                    out.append(self._flush(held, specials, owners, sizes))
                    held, specials, owners = [], [], []
        if held:
            out.append(self._flush(held, specials, owners, sizes))
        return sizes, np.concatenate(out) if out else np.empty(0, np.uint32)

    def _flush(self, held: list[str], specials: list[int], owners: list, sizes: np.ndarray) -> np.ndarray:
        coded = pa.array(held, pa.string()).dictionary_encode()
        slot, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        _, offsets, data = words.buffers()
        cuts = np.frombuffer(offsets, np.int32, len(words) + 1).astype(np.int64)
        text = np.frombuffer(data, np.uint8, int(cuts[-1])) if data is not None else np.empty(0, np.uint8)
        known, counts, ids = self.lexicon.find(text, cuts[:-1], np.diff(cuts))
        starts = np.cumsum(counts) - counts  # unknown words count none so far
        fresh, raw = np.flatnonzero(~known), text.tobytes()
        merged = self.bpe.merge_all([raw[cuts[k] : cuts[k + 1]] for k in fresh.tolist()])
        counts[fresh] = [len(m) for m in merged]
        starts[fresh] = len(ids) + np.cumsum(counts[fresh]) - counts[fresh]
        rest = [i for m in merged for i in m]
        pool = np.concatenate([ids, np.array(rest + specials, np.uint32)])
        at, many = starts[slot], counts[slot]
        if specials:
            named = np.flatnonzero(slot == slot[held.index("")])
            at[named], many[named] = len(pool) - len(specials) + np.arange(len(specials)), 1
        ends, place = np.append(0, np.cumsum(many)), 0
        for row, n in owners:
            sizes[row] += int(ends[place + n] - ends[place])
            place += n
        return pool[transducer.ranges(at, many)]


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    then: Callable[[ByteBpe, pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = "id long, ids array<int>",
) -> DataFrame:
    """(id, ids array<int>) of every row, encoded through the lexicon at ``path``.

    ``then`` may turn the batches of ids, while they are at hand, into rows of another ``schema``.
    """
    vocabulary = vocabulary or public_byte_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, path)
        for batch in batches:
            for start, stop in _slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                sizes, ids = encoder.ids(part.column(1).to_pylist())
                offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                found = pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "ids"])
                yield then(encoder.bpe, found) if then else found

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _lists(ids: pa.Array) -> Iterator[list[int]]:
    flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield flat[a:b].tolist()


def _slices(texts: pa.Array, limit: int = 4 * PART) -> Iterator[tuple[int, int]]:
    """Rows of a batch, as runs of about ``limit`` bytes of text; a longer text is one run."""
    begin, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held >= limit:
            yield begin, k + 1
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def decode(encoded: DataFrame, ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of its ids, added tokens by their names; no ids, no text."""
    vocabulary = vocabulary or public_byte_vocabulary()

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = byte_bpe(vocabulary)
        for ids in batches:
            yield pa.array([bpe.decode(row) for row in _lists(ids)], pa.string())

    return encoded.withColumn("decoded", text_of(F.col(ids_col)))


DIGESTS = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(bpe: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
    """The query's figures of each row: of its ids, and of the text that they decode to."""
    rows = [
        (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(bpe.decode(ids).encode()).hexdigest(),
        )
        for ids in _lists(batch.column(1))
    ]
    n, encoded, decoded = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(n, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
        ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, compile_lexicon(docs), then=digests, schema=DIGESTS)


QUERIES = {"op11_bpe_round_trip": op11_bpe_round_trip}
ORACLES: dict[str, str] = {}
