"""Packing documents into token sequences with little padding, by minimum bin slack.

A document's ids are cut into whole windows and a rest. The rests of a group of documents are packed
window by window: the longest rest opens a window, and a subset-sum dynamic program over the multiset
of the other lengths, a bitset of reachable fills for each length, picks those that come closest to
its capacity; walking the bitsets backwards gives the count of each length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.registry import query, table
from lakeops.llm.tokens import encoded_rows, vocabulary, worker_encoder
from lakeops.llm.workers import release
from lakeops.session import scratch_dir

GROUP_ROWS = 10_000
GROUP_BYTES = 128 << 20  # of rests, four bytes an id
# A window may be padded by this much; others that aren't full are cut anew.
SLACK = 64


def closest_fill(lengths: list[int], counts: Counter, capacity: int) -> Counter:
    """The counts of `lengths` (ascending) whose sum comes closest to `capacity` from below."""
    mask, reach, stages, full = (1 << (capacity + 1)) - 1, 1, [], 1 << capacity
    for k in range(bisect.bisect_right(lengths, capacity) - 1, -1, -1):
        length = lengths[k]
        stages.append((length, reach))
        left, step = min(counts[length], capacity // length), 1
        while left:
            use = min(step, left)
            reach |= (reach << (length * use)) & mask
            left, step = left - use, step * 2
        if reach & full:
            break
    picked, at = Counter(), reach.bit_length() - 1
    for length, before in reversed(stages):
        while not before >> at & 1:
            picked[length] += 1
            at -= length
    return picked


def windows_of(stock: Counter, capacity: int) -> Iterator[Counter]:
    """Window by window, the counts of the lengths it takes, until the stock is used up."""
    counts, lengths = Counter(stock), sorted(stock)
    while lengths:
        longest = lengths[-1]
        window = Counter({longest: 1})
        _take(counts, lengths, window)
        more = closest_fill(lengths, counts, capacity - longest)
        _take(counts, lengths, more)
        window.update(more)
        yield window


def _take(counts: Counter, lengths: list[int], taken: Counter) -> None:
    for length, n in taken.items():
        counts[length] -= n
        if not counts[length]:
            del lengths[bisect.bisect_left(lengths, length)]


Piece = tuple[int, int, int]  # row of the document, first id there, number of ids


def recut(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Windows of pieces cut freely: whole ones, then powers of two, which need no padding."""
    out: list[list[Piece]] = []
    left, room, window = sum(p[2] for p in pieces), 0, []
    for doc, start, length in pieces:
        while length:
            if not room:
                room = capacity if left >= capacity - SLACK else 1 << (left.bit_length() - 1)
                window = []
                out.append(window)
            n = min(length, room)
            window.append((doc, start, n))
            start, length, room, left = start + n, length - n, room - n, left - n
    return out


def pack_lengths(lengths: list[int], capacity: int) -> list[list[Piece]]:
    """Sequences of pieces for documents of these lengths; each id lies in exactly one piece."""
    sequences: list[list[Piece]] = []
    rests: dict[int, list[Piece]] = {}
    for doc, n in enumerate(lengths):
        sequences += [[(doc, at, capacity)] for at in range(0, n - capacity + 1, capacity)]
        if n % capacity:
            rests.setdefault(n % capacity, []).append((doc, n - n % capacity, n % capacity))
    loose: list[Piece] = []
    for window in windows_of(Counter({k: len(v) for k, v in rests.items()}), capacity):
        pieces = [rests[length].pop() for length in sorted(window, reverse=True) for _ in range(window[length])]
        fill = sum(p[2] for p in pieces)
        if fill >= capacity - SLACK or fill & (fill - 1) == 0:
            sequences.append(pieces)
        else:
            loose += pieces
    return sequences + recut(loose, capacity)


PACKED = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
NAMES = [c.split()[0] for c in PACKED.split(", ")]
KINDS = [pa.int64()] * 6 + [pa.binary()]
# Sequence ids of whole windows have this bit; below it are the encoding task and the window's number there.
ALONE = 1 << 62
OUT_BYTES = 2 << 20


def _rows(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], names=NAMES)


def pack_documents(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text", group_rows: int = GROUP_ROWS, group_bytes: int = GROUP_BYTES,
                   added_ids: bool = False) -> DataFrame:
    """One row per piece (`PACKED`): its ids (u4, little-endian) and its place in a sequence.

    Ids begin at `start` in their document, whose `doc_tokens` count the end id; pieces of a sequence
    lie gapless from offset 0. Whole windows of a document are sequences as the encoding task finds them. Rests, of less than
    `capacity` ids, are dealt to groups of about `group_rows`, and of `group_bytes` at most, by a hash of content, encoding task and place there, so
    that neither copies nor a repeated id crowd one group; each group is packed alone, and its number heads its sequence ids.
    A null text is empty (its end id alone); rows with a null or repeated id are documents of their own; an empty table
    gives no rows; other columns aren't read. `added_ids`: see `Encoder`.
    """
    groups = max(1, -(-docs.count() // max(1, min(group_rows, group_bytes // (4 * capacity)))))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = worker_encoder(vocabulary_path, end_id, added_ids), TaskContext.get().partitionId()
        out, held, place, window = [[] for _ in NAMES], 0, 0, 0
        for key, data in encoded_rows(batches, encoder):
            ids = np.frombuffer(data, encoder.dtype)
            rest = len(ids) - len(ids) % capacity
            for at in range(0, len(ids), capacity):
                if at < rest:
                    number = ALONE | task << 32 | window
                    window += 1
                else:  # a group's number, below 0, for now
                    number = -1 - zlib.crc32(data, task * 0x9E3779B1 + place & 0xFFFFFFFF) % groups
                part = ids[at:at + capacity].astype("<u4").tobytes() if at < rest else ids[at:].tobytes()
                for column, value in zip(out, (key, at, min(capacity, len(ids) - at), len(ids), number, 0, part)):
                    column.append(value)
                held += len(part) + 64
                if held >= OUT_BYTES:
                    yield _rows(out)
                    out, held = [[] for _ in NAMES], 0
            place += 1
        if out[0]:
            yield _rows(out)
        release()

    path = scratch_dir(docs.sparkSession, "encoded")
    rows.mapInArrow(encode, PACKED).write.parquet(path)
    encoded = docs.sparkSession.read.parquet(path)
    narrow = worker_encoder(vocabulary_path, end_id, added_ids).dtype

    def pack(group: pa.Table) -> pa.Table:
        # The order of rows within a shuffled group isn't fixed: sort, so that a repeated task agrees.
        keys, starts, totals, ids = (group.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, ids[i], totals[i]))
        head, out = (-1 - group.column("sequence_id")[0].as_py() if group.num_rows else 0) << 32, [[] for _ in NAMES]
        for number, pieces in enumerate(pack_lengths([group_length(ids[i], narrow) for i in order], capacity)):
            offset = 0
            for doc, start, length in pieces:
                i = order[doc]
                part = np.frombuffer(ids[i], narrow)[start:start + length].astype("<u4").tobytes()
                for column, value in zip(out, (keys[i], starts[i] + start, length, totals[i], head + number, offset, part)):
                    column.append(value)
                offset += length
        release(every=1.0)
        return pa.Table.from_batches([_rows(out)])

    return (encoded.where(F.col("sequence_id") >= 0)
            .unionByName(encoded.where(F.col("sequence_id") < 0).groupBy("sequence_id").applyInArrow(pack, PACKED)))


def group_length(ids: bytes, dtype: str) -> int:
    return len(ids) // np.dtype(dtype).itemsize


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(table(spark, sf_dir, "documents"))


def packed_digests(docs: DataFrame) -> DataFrame:
    """The pieces of documents packed with the query's parameters, ids as their checksum."""
    return (pack_documents(docs, vocabulary("word_bpe_49k.json"), 2, added_ids=True)
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))
