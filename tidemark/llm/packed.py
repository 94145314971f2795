"""Token ids as bit-packed files.

A file holds the documents of one range of ids, in ascending order. Ids are packed at the fewest
bits that the vocabulary needs, in blocks of ``BLOCK`` ids; after the blocks come their offsets and
the documents' ids and starts, and a footer of fixed size that names them. Any run of ids is read
by unpacking the blocks it touches.

    blocks | block offsets u64[n_blocks + 1] | doc ids i64[n_docs] | missing u8[n_docs]
    | doc starts u64[n_docs + 1] | footer: magic, bits, block, n_ids, n_docs

Defined cases: a missing or empty text is the end id alone; documents that repeat an id follow each
other, ordered by text; documents without id come last; an empty table writes no file with rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_folder
from .common import shuffle_partitions, staged, table
from .files import opened, written
from .vocab import public_vocabulary, vocabulary_size, word_encoder

MAGIC = b"TMBITS01"
FOOTER = struct.Struct("<8sIIQQ")
#: Ids per block; a multiple of 8, so that every block is whole bytes.
BLOCK = 8192
END = 1


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


#: Widths that are whole words of the machine need no bits moved.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in _WHOLE:
        return ids.astype(_WHOLE[bits]).tobytes()
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(planes[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in _WHOLE:
        return np.frombuffer(data, _WHOLE[bits], count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=bits * count, bitorder="little").reshape(-1, bits)
    planes = np.zeros((count, 32), np.uint8)
    planes[:, :bits] = flat
    return np.packbits(planes, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Packs ids as they come; holds one block and the documents' starts."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.written = 0
        self.offsets, self.starts, self.docs = [0], [0], []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for start in range(0, count, BLOCK):
            data = pack(ids[start : min(start + BLOCK, count)], self.bits)
            self.out.write(data)
            self.written += len(data)
            self.offsets.append(self.written)
        self.waiting = [ids[count:]]
        self.n_waiting = len(ids) - count

    def close(self) -> None:
        self._flush(self.n_waiting)
        missing = np.array([d is None for d in self.docs], np.uint8)
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self.out.write(missing.tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(FOOTER.pack(MAGIC, self.bits, BLOCK, self.n_ids, len(self.docs)))


class Reader:
    """Random access to one packed file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        magic, self.bits, self.block, self.n_ids, self.n_docs = FOOTER.unpack(
            source.read_at(FOOTER.size, size - FOOTER.size)
        )
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        at = size - FOOTER.size - 8 * (self.n_docs + 1)
        self.starts = np.frombuffer(source.read_at(8 * (self.n_docs + 1), at), "<u8").astype(np.int64)
        at -= self.n_docs
        self.missing = np.frombuffer(source.read_at(self.n_docs, at), np.uint8).astype(bool)
        at -= 8 * self.n_docs
        self.docs = np.frombuffer(source.read_at(8 * self.n_docs, at), "<i8")
        n_blocks = -(-self.n_ids // self.block)
        at -= 8 * (n_blocks + 1)
        self.offsets = np.frombuffer(source.read_at(8 * (n_blocks + 1), at), "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids of the places [start, stop), from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        lo, hi = int(self.offsets[first]), int(self.offsets[last + 1])
        count = min((last + 1) * self.block, self.n_ids) - first * self.block
        found = unpack(self.source.read_at(hi - lo, lo), self.bits, count)
        return found[start - first * self.block : stop - first * self.block]

    def documents(self, run: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc, start, ids) in order; about ``run`` ids are unpacked at a time."""
        k = 0
        while k < self.n_docs:
            stop = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + run, "right")) - 1)
            base = int(self.starts[k])
            ids = self.ids(base, int(self.starts[stop]))
            for d in range(k, stop):
                a, b = int(self.starts[d]), int(self.starts[d + 1])
                yield None if self.missing[d] else int(self.docs[d]), a, ids[a - base : b - base]
            k = stop


MANIFEST = "part int, path string, n_docs long, n_ids long"


def write_packed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end: int = END
) -> DataFrame:
    """Encodes ``docs`` into packed files, one per range of ids; returns the manifest, as a table."""
    spark = docs.sparkSession
    vocabulary = vocabulary or public_vocabulary()
    folder, bits = fresh_folder(spark, "llm-packed"), bits_for(vocabulary_size(vocabulary))
    order = [F.col("id").isNull(), F.col("id"), F.col("text")]
    ranged = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), *order[:2])
        .sortWithinPartitions(*order)
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = word_encoder(vocabulary), TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.ids"
        first = next(batches, None)
        if first is None:
            return
        with written(path) as out:
            writer, stop = Writer(out, bits), np.array([end], np.uint32)
            while first is not None:
                for doc, ids in zip(first["id"], encoder.each(first["text"]), strict=True):
                    writer.add(None if pd.isna(doc) else int(doc), np.concatenate([ids, stop]))
                first = next(batches, None)
            writer.close()
        yield pd.DataFrame(
            {"part": [part], "path": [path], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]}
        )

    return staged(ranged.mapInPandas(write, MANIFEST), "manifest")


def read_packed(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    spark = manifest.sparkSession
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file, so the running total is over as many rows as there are partitions
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long")))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"], strict=True):
                with opened(path) as source:
                    rows = []
                    for doc, start, ids in Reader(source).documents():
                        rows.append((doc, int(base) + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    files = placed.select("path", "base").repartition(shuffle_partitions(spark), "path")
    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list) -> pd.DataFrame:
    doc, start, n, crc = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pd.DataFrame(
        {"doc_id": pd.array(doc, "Int64"), "start": np.array(start, "int64"), "n_tokens": np.array(n, "int64"), "ids_crc32": np.array(crc, "int64")}
    )


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_packed(write_packed(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op8_token_id_output": op8_token_id_output}
ORACLES: dict[str, str] = {}
