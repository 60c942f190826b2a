"""Token ids in binary shards whose document boundaries are Elias-Fano encoded.

Documents are dealt by ranges of doc_id, so that shard k holds smaller ids than shard k + 1, and sorted in each shard. A
shard is a run of blocks of about BLOCK_IDS ids; a document lies whole in one block. A block is a self-contained file
image (layout at Block), kept as one binary value of a Parquet row, so that Spark's committer makes the write safe
against lost and repeated tasks and any store will do.

Boundaries b_1 <= ... <= b_n (the end of each document in the block's id array of length u) are split into
l = floor(log2(u / n)) low bits, packed, and high parts, set in unary at position (b_i >> l) + i - 1 of a bit array of
n + (u >> l) + 1 bits. select(i) gives b_i back: the file has a directory of the positions of every 64th one bit, 32 bits
each, from which it scans few words. This takes about 2.5 + l bits a document where a table of 64-bit offsets takes 64.
Readers go through the directory too.

Defined results: null and empty text hold the end id alone; rows with a null doc_id come first; repeated ids keep all
their rows, ordered by text; other columns are not read; an empty table writes no block.
"""

from __future__ import annotations

import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracewell.llm.bpe_count import Memo, Splitter, Words, byte_symbols
from tracewell.llm.common import shared_dir, tables_of_worker

BLOCK_IDS = 1 << 20
KEPT_PIECES = 1_000_000
KEPT_WORDS = 1_000_000
END_ID = 0
MAGIC = b"EFT2"
STEP = 64
FILE_SCHEMA = "shard int, block int, doc_ids array<long>, n_ids long, payload binary"
READ_SCHEMA = "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of integers below or at u; starts: the positions of every STEP-th one bit of high."""

    def __init__(self, n: int, u: int, low_bits: int, low: np.ndarray, high: np.ndarray, starts: np.ndarray):
        self.n, self.u, self.low_bits, self.low, self.high, self.starts = n, u, low_bits, low, high, starts

    @classmethod
    def of(cls, values: np.ndarray, u: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, (u // n).bit_length() - 1) if n else 0
        high = np.zeros((n + (u >> low_bits) + 8) // 8 + 1, np.uint8)
        if len(high) >= 1 << 29:
            raise ValueError("too many documents in a block")
        at = (values >> low_bits) + np.arange(n)
        np.bitwise_or.at(high, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
        bits = (values[:, None] >> np.arange(low_bits)) & 1 if low_bits else np.zeros((n, 0), np.int64)
        return cls(n, u, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"), high, at[::STEP].astype("<u4"))

    def group(self, g: int) -> np.ndarray:
        """The values from STEP * g on, STEP of them at most: reads the bits from one entry of the directory to the next."""
        first = STEP * g
        count = min(STEP, self.n - first)
        begin = int(self.starts[g]) >> 3
        past = (int(self.starts[g + 1]) >> 3) + 1 if g + 1 < len(self.starts) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:past], bitorder="little")) + 8 * begin
        ones = ones[ones >= int(self.starts[g])][:count]
        low, bit = np.zeros(count, np.int64), first * self.low_bits
        if self.low_bits:
            part = self.low[bit >> 3 : (bit + count * self.low_bits + 7) >> 3]
            bits = np.unpackbits(part, bitorder="little")[bit & 7 :][: count * self.low_bits].reshape(count, self.low_bits)
            low = bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (ones - np.arange(first, first + count)) << self.low_bits | low

    def select(self, i: int) -> int:
        """The i-th value, from 0: scans from the directory's last entry before it."""
        return int(self.group(i // STEP)[i % STEP])

    def __iter__(self) -> Iterator[int]:
        """All values, STEP at a time."""
        for g in range(len(self.starts)):
            yield from self.group(g).tolist()

    def size(self) -> int:
        """Bytes of all structures."""
        return len(self.low) + len(self.high) + self.starts.nbytes


class Block:
    """magic, bytes an id (2 or 4), low bits, documents, ids, bytes of low and high; then low, high, directory, ids. Little-endian."""

    HEAD = struct.Struct("<4sBBQQQQ")

    @staticmethod
    def write(ends: np.ndarray, ids: bytes, width: int) -> bytes:
        u = len(ids) // width
        ef = EliasFano.of(np.asarray(ends, np.int64), u)
        return Block.HEAD.pack(MAGIC, width, ef.low_bits, ef.n, u, len(ef.low), len(ef.high)) + ef.low.tobytes() + ef.high.tobytes() + ef.starts.tobytes() + ids

    @staticmethod
    def read(data: bytes) -> tuple[EliasFano, np.ndarray]:
        magic, width, low_bits, n, u, n_low, n_high = Block.HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        at = Block.HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        starts = np.frombuffer(data, "<u4", -(-n // STEP), at + n_low + n_high)
        return EliasFano(n, u, low_bits, low, high, starts), np.frombuffer(data, f"<u{width}", u, at + n_low + n_high + starts.nbytes)


class Encoder:
    """The library's ids of texts. Words and pieces repeat, so those in bounded tables don't go through the library again."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.known = Memo(self.of_piece, KEPT_PIECES)
        self.stand_ins = {b: c for c, b in byte_symbols().items()}
        self.split, self.units = Splitter(), Words(self.of_pieces, KEPT_WORDS)
        self.special = {x.content: self.raw([i]) for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def raw(self, ids: list[int]) -> bytes:
        values = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            values.byteswap()
        return values.tobytes()

    def of_piece(self, piece: str) -> bytes:
        """By the library's model, which takes bytes as their printable stand-ins."""
        symbols = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.stand_ins)
        return self.raw([t.id for t in self.tokenizer.model.tokenize(symbols)])

    def of_pieces(self, text: str) -> bytes:
        if not any(x in text for x in self.special):
            return b"".join(map(self.known.__getitem__, self.split(text)))
        return b"".join(self.special[p] if k % 2 else b"".join(map(self.known.__getitem__, self.split(p))) for k, p in enumerate(self.parts.split(text)))

    def __call__(self, text: str) -> bytes:
        return b"".join(self.units(text))


@tables_of_worker
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)


def write_shards(documents: DataFrame, vocabulary: str, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encodes every text and writes the shards below path; returns the rows of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, block = encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = encode.raw([end_id])
        doc_ids: list[int | None] = []
        ends: list[int] = []
        ids = bytearray()

        def flush() -> pa.RecordBatch:
            nonlocal block
            payload, n = Block.write(np.array(ends), bytes(ids), encode.width), len(ids) // encode.width
            row = pa.record_batch([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([n], pa.int64()), pa.array([payload], pa.binary())], ["shard", "block", "doc_ids", "n_ids", "payload"])
            doc_ids.clear(), ends.clear(), ids.clear()
            block += 1
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids += encode(text or "") + end
                doc_ids.append(doc_id)
                ends.append(len(ids) // encode.width)
                if ends[-1] >= block_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    dealt = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    dealt.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(FILE_SCHEMA).parquet(path)


def read_shards(files: DataFrame) -> DataFrame:
    """One row for each document of the files: its place among all ids, its number of ids and their CRC-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, doc_ids, payload in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                bounds, ids = Block.read(payload)
                starts, sizes, crc, start, n = [], [], [], 0, bounds.n
                for end in bounds:
                    starts.append(start)
                    sizes.append(end - start)
                    crc.append(zlib.crc32(ids[start:end].astype("<u4")))
                    start = end
                yield pa.record_batch([pa.array([shard] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    # the ids before a block: those of earlier shards, and those of earlier blocks of its shard; one row for each block
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("in_shard"))
    shards = shards.select("shard", (F.sum("in_shard").over(Window.orderBy("shard")) - F.col("in_shard")).alias("before_shard"))
    blocks = files.select("shard", "block", "n_ids").withColumn("before_block", F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids"))
    before = blocks.join(shards, "shard").select("shard", "block", (F.col("before_shard") + F.col("before_block")).alias("before"))
    documents = files.select("shard", "block", "doc_ids", "payload").mapInArrow(run, READ_SCHEMA)
    return documents.join(before, ["shard", "block"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(documents: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Writes the shards (below the shared folder unless path says otherwise) and reads them back."""
    place = path or f"{shared_dir(documents.sparkSession)}/tracewell/token-ids-{uuid.uuid4().hex}"
    return read_shards(write_shards(documents, vocabulary, place))
