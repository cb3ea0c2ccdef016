"""Token ids in binary shards of patched frame-of-reference blocks.

A segment holds the ids of some documents, in order, as blocks of `BLOCK` ids. Of a block's ids the
least is subtracted; the rest is packed at the bit width that a given share of them needs, and the
larger ones (exceptions) are listed with their places. An index holds where each block starts, so
that a reader decodes only the blocks it needs. A segment's bytes:

    magic "PFOR", version u1, id bytes u1, u2 zero, ids u8, documents u4, blocks u4, start in shard u8
    documents' ids i8 (least value: null), documents' first ids u8 (in the segment)
    block starts u8 (from the segment's begin, with the end), then the blocks:
    least u4, width u1, u1 zero, exceptions u2, packed bits, exception places u2, exception values u4

Numbers are little-endian. Spark's own writer commits the segments as binary cells, so that a lost
executor or a repeated task leaves no half file, on every store that Spark can write.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.registry import query, table
from lakeops.llm.tokens import encoded_rows, vocabulary, worker_encoder
from lakeops.session import scratch_dir

BLOCK = 1024
SEGMENT_IDS = 1 << 18  # a segment ends after the document that reaches this
SHARD_ROWS = 20_000
HEAD = "<4sBBHQIIQ"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
NO_ID = np.iinfo(np.int64).min


def _pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2 ** width as rows of bytes, lowest bit first."""
    bits = (rest[:, :, None] >> np.arange(width, dtype=rest.dtype)) & 1
    return np.packbits(bits.astype(np.uint8).reshape(len(rest), -1), axis=1, bitorder="little")


def _unpack(rows: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(rows, axis=1, bitorder="little")[:, : BLOCK * width].reshape(len(rows), BLOCK, width)
    out = np.zeros(bits.shape[:2], np.uint32)
    for i in range(width):
        out |= bits[:, :, i].astype(np.uint32) << np.uint32(i)
    return out


def encode_blocks(ids: np.ndarray, percent: int = 90) -> list[bytes]:
    """The blocks of an array of ids; `percent` of a block's ids fit its width."""
    if not len(ids):
        return []
    count = -(-len(ids) // BLOCK)
    full = np.full(count * BLOCK, ids[-1], np.uint32)  # the last block is filled up with its last id
    full[: len(ids)] = ids
    grid = full.reshape(count, BLOCK)
    least = grid.min(axis=1)
    rest = grid - least[:, None]
    place = -(-percent * BLOCK // 100) - 1
    limit = np.partition(rest, place, axis=1)[:, place]
    widths = np.ceil(np.log2(limit.astype(np.float64) + 1)).astype(np.int64)
    over = rest >> np.minimum(widths, 31).astype(np.uint32)[:, None] != 0
    over[widths >= 32] = False
    blocks: list[bytes] = [b""] * count
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        packed = _pack(np.where(over[rows], 0, rest[rows]), int(width)) if width else np.zeros((len(rows), 0), np.uint8)
        for row, data in zip(rows, packed):
            at = np.flatnonzero(over[row])
            head = np.array([(least[row], width, 0, len(at))], BLOCK_HEAD)
            blocks[row] = b"".join((head.tobytes(), data.tobytes(), at.astype("<u2").tobytes(),
                                    rest[row, at].astype("<u4").tobytes()))
    return blocks


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The ids of blocks, a multiple of `BLOCK`."""
    heads = [np.frombuffer(b, BLOCK_HEAD, 1)[0] for b in blocks]
    out = np.zeros((len(blocks), BLOCK), np.uint32)
    widths = np.array([h["width"] for h in heads], np.int64)
    for width in np.unique(widths):
        rows, size = np.flatnonzero(widths == width), int(width) * BLOCK // 8
        if width:
            data = np.stack([np.frombuffer(blocks[r], np.uint8, size, BLOCK_HEAD.itemsize) for r in rows])
            out[rows] = _unpack(data, int(width))
        for r in rows:
            n, at = int(heads[r]["exceptions"]), BLOCK_HEAD.itemsize + size
            if n:
                places = np.frombuffer(blocks[r], "<u2", n, at)
                out[r, places] = np.frombuffer(blocks[r], "<u4", n, at + 2 * n)
    return out + np.array([h["least"] for h in heads], np.uint32)[:, None] if blocks else out


def write_segment(doc_ids: list[int | None], ids: list[np.ndarray], start: int) -> bytes:
    """The bytes of a segment; `start` ids lie before it in its shard."""
    lengths = np.array([len(x) for x in ids], np.uint64)
    blocks = encode_blocks(np.concatenate(ids))
    index_at = HEAD_BYTES + 16 * len(ids)
    sizes = np.array([index_at + 8 * (len(blocks) + 1), *map(len, blocks)], np.uint64)
    first = np.cumsum(lengths) - lengths
    keys = np.array([NO_ID if d is None else d for d in doc_ids], "<i8")
    head = struct.pack(HEAD, b"PFOR", 1, 4, 0, int(lengths.sum()), len(ids), len(blocks), start)
    return b"".join((head, keys.tobytes(), first.astype("<u8").tobytes(), np.cumsum(sizes).astype("<u8").tobytes(), *blocks))


class Segment:
    """Reads a segment's bytes."""

    def __init__(self, data: bytes):
        magic, version, _, _, self.n_ids, docs, blocks, self.start = struct.unpack_from(HEAD, data)
        if magic != b"PFOR" or version != 1:
            raise ValueError("not a segment of token ids")
        self.data = data
        self.doc_ids = np.frombuffer(data, "<i8", docs, HEAD_BYTES)
        self.first = np.append(np.frombuffer(data, "<u8", docs, HEAD_BYTES + 8 * docs), np.uint64(self.n_ids)).astype(np.int64)
        self.index = np.frombuffer(data, "<u8", blocks + 1, HEAD_BYTES + 16 * docs).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from `begin` to `end`, decoding only the blocks that hold them."""
        lo, hi = begin // BLOCK, -(-end // BLOCK)
        blocks = [self.data[self.index[k]:self.index[k + 1]] for k in range(lo, hi)]
        return decode_blocks(blocks).reshape(-1)[begin - lo * BLOCK:end - lo * BLOCK]


def write_tokens(docs: DataFrame, path: str, vocabulary_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_rows: int = SHARD_ROWS, added_ids: bool = False) -> None:
    """Encode whole texts and write their ids, each with `end_id`, in ascending order of the id.

    The rows are range-partitioned by id, about `shard_rows` in a shard, and a task writes its shard
    segment by segment. A null text is empty; null ids come first; rows with equal ids are ordered by the first
    64 characters of their text, then by its hash, and may lie in several shards, exact copies too. Other columns aren't read; an empty table leaves an empty table. `added_ids`: see `Encoder`.
    """
    shards = max(1, -(-docs.count() // shard_rows))
    rows = (docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
            .withColumn("head", F.substring("text", 1, 64)).withColumn("ties", F.xxhash64("text"))
            .withColumn("place", F.monotonically_increasing_id())
            .repartitionByRange(shards, "id", "head", "ties", "place").sortWithinPartitions("id", "head", "ties").select("id", "text"))
    schema = pa.schema([("shard", pa.int64()), ("segment", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary_path, end_id, added_ids)
        shard, segment, start, keys, parts, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def done():
            data = write_segment(keys, parts, start)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((shard, segment, held, data), schema.types)], schema=schema)

        for key, data in encoded_rows(batches, encoder):
            ids = np.frombuffer(data, encoder.dtype)
            keys.append(key)
            parts.append(ids)
            held += len(ids)
            if held >= SEGMENT_IDS:
                yield done()
                segment, start, keys, parts, held = segment + 1, start + held, [], [], 0
        if keys:
            yield done()

    (rows.mapInArrow(encode, "shard bigint, segment bigint, n_ids bigint, payload binary")
     .write.option("compression", "none").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a written table: doc_id, start, n_tokens and `ids` (u4, little-endian).

    `start` counts the ids of all documents before it. Only the shards' totals, one row each, are
    broadcast.
    """
    written = spark.read.parquet(path)
    totals = written.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.expr("coalesce(sum(n) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    placed = written.join(F.broadcast(totals.select("shard", before.alias("before"))), "shard").select("before", "payload")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                segment = Segment(payload.as_buffer().to_pybytes())
                ids, first = segment.ids(0, segment.n_ids).astype("<u4"), segment.first
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if d == NO_ID else int(d) for d in segment.doc_ids], pa.int64()),
                    pa.array(before + segment.start + first[:-1], pa.int64()),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())], schema=schema)

    return placed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


@query("op2_token_output")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), 0, added_ids=True)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
