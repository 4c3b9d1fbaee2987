"""Token-ID output: ids bit-packed at a fixed width, with block offsets for vectorised reading and random access.

A shard is one byte string:

    8 bytes   magic and version
    u32       bits of an id        u32  ids of a block (the last one may be shorter)
    u64       number of documents  u64  number of ids  u64  number of blocks
    i64 * d   document ids (with a bit in the next array where it is null)
    u8  * ..  null bits
    u64 * d   ids of each document, in the same order
    u64 * b   where each block begins, in bytes from the first
    blocks    ids, least significant bit first, each block padded to a whole byte

Shards are rows of a Parquet table in ascending order, so that Spark commits, lists and reads them in any store.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import materialise
from .bpe import document_ids, encoder
from .words import frugal

MAGIC = b"TWTOKEN1"
BLOCK_IDS = 1 << 16
SHARD_IDS = 1 << 20
_HEAD = struct.Struct("<8sIIQQQ")


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits((ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1, bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype("<u4")
    flags = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flags.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def write_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    blocks = [pack(ids[i : i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    starts = np.cumsum([0, *map(len, blocks)], dtype="<u8")[: len(blocks)]
    nulls = np.packbits([d is None for d in doc_ids]).tobytes()
    head = _HEAD.pack(MAGIC, bits, block_ids, len(doc_ids), len(ids), len(blocks))
    names = np.array([d or 0 for d in doc_ids], dtype="<i8")
    return b"".join([head, names.tobytes(), nulls, np.array(lengths, dtype="<u8").tobytes(), starts.tobytes(), *blocks])


class Shard:
    """Read access to the bytes of a shard; only the blocks asked for are unpacked."""

    def __init__(self, data: bytes) -> None:
        magic, self.bits, self.block_ids, docs, self.n_ids, blocks = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        names, at = np.frombuffer(data, "<i8", docs, at).tolist(), at + 8 * docs
        nulls, at = np.unpackbits(np.frombuffer(data, np.uint8, -(-docs // 8), at), count=docs), at + -(-docs // 8)
        self.doc_ids = [None if null else name for name, null in zip(names, nulls.tolist(), strict=True)]
        self.lengths, at = np.frombuffer(data, "<u8", docs, at).astype(np.int64), at + 8 * docs
        self.starts, at = np.frombuffer(data, "<u8", blocks, at), at + 8 * blocks
        self.body = memoryview(data)[at:]

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, dtype="<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        parts = [unpack(self.body[int(self.starts[b]) :], self.bits, min(self.block_ids, self.n_ids - b * self.block_ids)) for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]


def write_token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append the end id and write shards in ascending order of the id, nulls first.

    Returns the written table: ``part`` and ``first`` (ids of the part before the shard) give the order, ``n_ids`` and
    ``shard`` the content. Null and empty texts are the end id alone; rows that share an id stay separate, next to each
    other. Other columns are ignored. The rows are dealt by ranges of the id, so no task sees more than its range.
    """

    @frugal
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, first = encoder(tokenizer), TaskContext.get().partitionId(), 0
        names, lengths, ids, held = [], [], [], 0

        def shard() -> pa.RecordBatch:
            data = write_shard(names, lengths, np.concatenate(ids), bits_for(encode.size))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "first": [first], "n_ids": [held], "shard": pa.array([data], pa.binary())})

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(document_ids(encode, text.as_py()))
                names.append(name.as_py())
                lengths.append(len(ids[-1]))
                held += lengths[-1]
                if held >= SHARD_IDS:
                    yield shard()
                    first, held = first + held, 0
                    names, lengths, ids = [], [], []
        if names:
            yield shard()

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange(parts, "id").sortWithinPartitions("id")
    return materialise(ordered.mapInArrow(write, "part int, first long, n_ids long, shard binary"), "tokens")


def read_token_table(shards: DataFrame) -> DataFrame:
    """One row for each document of a written table: ``id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""

    @frugal
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, data in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                shard = Shard(data.as_py())
                ids, ends = shard.read(0, shard.n_ids), np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part.as_py()] * len(crcs), pa.int32()), "id": pa.array(shard.doc_ids, pa.int64()), "start": pa.array(starts + first.as_py(), pa.int64()),
                    "n_tokens": pa.array(shard.lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    rows = shards.select("part", "first", "shard").mapInArrow(read, "part int, id long, start long, n_tokens long, ids_crc32 long")
    # One row for each part of the written table: as many as the writer had partitions.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = shards.groupBy("part").agg(F.sum("n_ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select("id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
