"""Removing repeated byte strings with a distributed sparse suffix array.

A string of `LENGTH` bytes that also starts in a document with a smaller id is removed. Each such
string (window) has a leading token: of its runs of `TOKEN` bytes the one with the least hash, the
leftmost if equal. Equal windows have equal tokens at equal places, so it is enough to sort the
suffixes that start at a token, one for about 17 bytes of text, each with the bytes before it that
its windows reach back to.

1. Texts equal to one with a smaller id are taken out: all of their windows repeat.
2. Hashes of the tokens are dealt to buckets; suffixes whose token no other document has are left out.
3. Splitters from a sample of the other suffixes, drawn by a hash of text and place, cut them into ranges; a suffix as frequent as several
   ranges is dealt to all of these.
4. Each range is sorted by a multikey quicksort. For each distance from a window's start to its
   token, neighbours that agree on the rest of the window form runs; within a run, windows with
   equal bytes before the token are equal, and all but those of the least document are removed.
5. Runs that reach a range's end may go on in the next one: of each of their windows, the least
   document's is compared across ranges, by hash, in one aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm.hashing import mix, powers
from lakeops.llm.registry import query, table
from lakeops.llm.workers import release
from lakeops.session import scratch_dir

LENGTH, TOKEN = 50, 20
REACH = LENGTH - TOKEN + 1  # places of a token in a window
SECTION = 1 << 20  # tokens are searched in so many bytes at a time
BUCKET_TOKENS, RANGE_SUFFIXES = 500_000, 100_000
SAMPLE, RANGE_SAMPLE = 20_000, 20  # suffixes drawn for splitters: at least, and for each range
FLUSH_BYTES = 4 << 20
# So many groups of copies may be sent to every task (24 bytes each); beyond, they are joined by shuffle.
MAX_BROADCAST_GROUPS = 200_000
MARK = b"\x01"  # behind a suffix's bytes, since arrays of bytes drop zeros at the end
LAST = (1 << 63) - 1  # the place of a null id: after all others


def run_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the `n` bytes from each place on."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * up[n - 1:len(data)])


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The leading tokens of all windows: place, first and last window that it leads, hash."""
    found = []
    for begin in range(0, max(0, len(data) - LENGTH + 1), SECTION - LENGTH):
        part = data[begin:begin + SECTION]
        if len(part) < LENGTH:
            break
        hashes = run_hashes(part, TOKEN)
        # The hash's upper bits, then the place: the least is the leftmost of equal ones.
        least = (hashes & ~np.uint64(SECTION - 1)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while size * 2 <= REACH:
            least, size = np.minimum(least[:-size], least[size:]), size * 2
        if size < REACH:
            least = np.minimum(least[:size - REACH], least[REACH - size:])
        place = (least & np.uint64(SECTION - 1)).astype(np.int64)
        if begin + SECTION < len(data):  # the last windows are the next section's
            place = place[:SECTION - LENGTH]
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        found.append((place[first] + begin, first + begin, last + begin, hashes[place[first]]))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], "<u4").tobytes()
    body = head + b"".join(a.tobytes() for a in arrays)
    return len(body).to_bytes(4, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    body = pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)
    sizes, at, out = np.frombuffer(body, "<u4", len(kinds)), 4 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(body, kind, n, at))
        at += out[-1].nbytes
    return out


KNOWN = np.uint32(1 << 31)  # marks a place whose token is known to be shared


# Buckets that a task deals to directly; more are reached in two steps, by groups of buckets.
DIRECT = 2048


def _tokens_of(ids: np.ndarray, keys: np.ndarray, doc: np.ndarray, hashes: np.ndarray, place: np.ndarray, kind: str) -> bytes:
    """Some tokens, packed with the ids of their documents; hashes as `kind` (in a bucket, the lower half will do)."""
    docs, index = np.unique(doc, return_inverse=True)
    return _pack(ids[docs], keys[docs], index.astype("<u4"), hashes.astype(kind), place)


def _unpacked_tokens(parts: list[bytes], kind: str) -> tuple[np.ndarray, ...]:
    """Ids, text hashes, and per token its document's place there, hash and place in the text."""
    found = [_unpack(x, "<i8", "<i8", "<u4", kind, "<u4") for x in parts]
    base = np.cumsum([0] + [len(p[0]) for p in found])
    doc = np.concatenate([p[2].astype(np.int64) + b for p, b in zip(found, base)])
    return (*(np.concatenate([p[i] for p in found]) for i in (0, 1)), doc, *(np.concatenate([p[i] for p in found]) for i in (3, 4)))


def _dealt(bucket: np.ndarray, rows: np.ndarray, packed) -> list[tuple[int, bytes]]:
    """(bucket, packed rows) of each bucket that is met; `rows` are in the order of their buckets."""
    if not len(rows):
        return []
    of = bucket[rows]
    begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    return [(int(of[a]), packed(rows[a:b])) for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(rows)])]


def _bucket_rows(out: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())],
                                      names=["bucket", "tokens"])


def _deal_again(buckets: int, groups: int):
    """(group, packed tokens) -> (bucket, packed tokens): the second step of dealing, for the buckets of a task's groups."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None

        def flush() -> pa.RecordBatch:
            ids, keys, doc, hashes, place = _unpacked_tokens(held, "<u8")
            bucket = (hashes >> np.uint64(33)) % np.uint64(buckets)
            # Others than those of the group's buckets were spread, and are again, over these.
            mine = np.arange(now, buckets, groups, dtype=np.uint64)
            spread = bucket % np.uint64(groups) != now
            bucket[spread] = mine[mix(hashes[spread] + doc[spread].astype(np.uint64)) % np.uint64(len(mine))]
            rows = np.argsort(bucket, kind="stable")
            return _bucket_rows(_dealt(bucket, rows, lambda m: _tokens_of(ids, keys, doc[m], hashes[m], place[m], "<u4")))

        for batch in batches:
            for group, tokens_ in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (group != now or size >= FLUSH_BYTES // 4):
                    yield flush()
                    held, size = [], 0
                now = group
                held.append(tokens_)
                size += len(tokens_)
        if held:
            yield flush()
        release()

    return deal


def _deal_tokens(buckets: int, groups: int):
    """(doc, text_hash, text) -> (group of buckets, packed tokens), a row for each group met by some megabytes of text.

    A bucket's group is its number modulo `groups`; with as many groups as buckets, it is the bucket.
    """
    kind = "<u4" if groups == buckets else "<u8"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            counts = [len(h[3]) for h in held]
            doc = np.repeat(np.arange(len(held), dtype=np.uint32), counts)
            place = np.concatenate([h[2] for h in held]).astype(np.uint32)
            hashes = np.concatenate([h[3] for h in held])
            bucket = (hashes >> np.uint64(33)) % np.uint64(buckets)
            # A token that two documents here share: one stands for all in its bucket, the rest need
            # no comparison any more and are spread, so that a frequent token fills no bucket.
            order = np.lexsort((doc, hashes))
            same = hashes[order][1:] == hashes[order][:-1]
            group = np.concatenate(([0], np.cumsum(~same)))
            first = np.concatenate(([True], ~same))
            shared = np.maximum.reduceat(doc[order], np.flatnonzero(first)) > np.minimum.reduceat(doc[order], np.flatnonzero(first))
            known = order[shared[group]]
            spread = order[shared[group] & ~first]
            bucket[spread] = mix(hashes[spread] + doc[spread]) % np.uint64(buckets)
            bucket %= np.uint64(groups)
            place[known] |= KNOWN
            ids, keys = (np.array([h[i] for h in held], np.int64) for i in (0, 1))
            rows = np.argsort(bucket, kind="stable")
            return _bucket_rows(_dealt(bucket, rows, lambda m: _tokens_of(ids, keys, doc[m], hashes[m], place[m], kind)))

        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(_bytes_of(batch.column(2)[row].as_py()), np.uint8)
                place, _, _, hashes = tokens(data)
                if len(place):
                    # A token may lead windows in two stretches: one place.
                    place, keep = np.unique(place, return_index=True)
                    held.append((batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), place, hashes[keep]))
                    size += len(data)
                if size >= FLUSH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        release()

    return deal


def _shared_tokens(group: pa.Table) -> pa.Table:
    """The places of a bucket's tokens that several documents have, by document."""
    ids, keys, doc, hashes, place = _unpacked_tokens(group.column("tokens").to_pylist(), "<u4")
    pairs, renumbered = np.unique(np.stack((ids, keys)), axis=1, return_inverse=True)  # a row may be repeated
    doc = renumbered.reshape(-1)[doc]
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
    group_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    known = place & KNOWN != 0
    shared = ((np.maximum.reduceat(doc[order], first) > np.minimum.reduceat(doc[order], first))
              | np.maximum.reduceat(known[order], first))[group_of]
    rows = order[shared]
    rows = rows[np.lexsort((place[rows], doc[rows]))]
    docs, begin = np.unique(doc[rows], return_index=True)
    places = np.split((place[rows] & ~KNOWN).astype("<u4"), begin[1:]) if len(rows) else []
    return pa.table({"doc": pa.array(pairs[0][docs], pa.int64()), "text_hash": pa.array(pairs[1][docs], pa.int64()),
                     "n": pa.array([len(p) for p in places], pa.int64()), "places": pa.array([p.tobytes() for p in places], pa.binary())})


SUFFIX = "part int, right binary, left binary, doc bigint, text_hash bigint, place bigint"


def _suffixes(splitters: list[bytes]):
    """(doc, text_hash, packed text, places) -> the suffixes at these places, each in its range."""
    cuts = np.array(splitters, f"S{LENGTH + 1}") if splitters else np.zeros(0, "S1")
    schema = pa.schema([("part", pa.int32()), ("right", pa.binary()), ("left", pa.binary()), ("doc", pa.int64()),
                        ("text_hash", pa.int64()), ("place", pa.int64())])

    def ranged(right: list[bytes], left: list[bytes], held: list[tuple]) -> pa.RecordBatch:
        doc, text_hash = (np.repeat(np.array([h[i] for h in held], np.int64), [len(h[2]) for h in held]) for i in (0, 1))
        keys = np.array([r + MARK for r in right], cuts.dtype) if len(cuts) else np.zeros(len(right), "S1")
        low, high = np.searchsorted(cuts, keys, "left"), np.searchsorted(cuts, keys, "right")
        part = low + (mix(doc.view(np.uint64)) % (high - low + 1).astype(np.uint64)).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(part, pa.int32()), pa.array(right, pa.binary()), pa.array(left, pa.binary()), pa.array(doc),
            pa.array(text_hash), pa.array(np.concatenate([h[2] for h in held]))], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, left, held = [], [], []
        for batch in batches:
            for doc, text_hash, packed, lists in zip(*(c.to_pylist() for c in batch.columns)):
                (data,) = _unpack(packed, "u1")
                raw = data.tobytes()
                place, first, last, _ = tokens(data)
                mine = np.isin(place, np.frombuffer(b"".join(lists), "<u4").astype(np.int64))
                place, first, last = place[mine], first[mine].tolist(), last[mine].tolist()
                at = place.tolist()
                right += [raw[a:b + LENGTH] for a, b in zip(at, last)]
                left += [raw[b:a] for a, b in zip(at, first)]
                held.append((doc, text_hash, place))
                if len(right) >= 20_000:
                    yield ranged(right, left, held)
                    right, left, held = [], [], []
        if right:
            yield ranged(right, left, held)
        release()

    return cut


def _sampled(share: int):
    """(doc, text_hash, places) -> the same with one in `share` of the places, chosen by text and place."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text_hash, packed in zip(*(c.to_pylist() for c in batch.columns)):
                place = np.frombuffer(packed, "<u4")
                key = mix(place.astype(np.uint64) + np.array([text_hash], np.int64).view(np.uint64))
                mine = place[key % np.uint64(share) == 0]
                if len(mine):
                    out.append((doc, text_hash, mine.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             names=["doc", "text_hash", "places"])

    return sample


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, places) -> what `_suffixes` cuts from these places on; reads the bytes near them only."""
    for batch in batches:
        right: list[bytes] = []
        for text, lists in zip(*(c.to_pylist() for c in batch.columns)):
            raw = _bytes_of(text)
            for at in np.frombuffer(b"".join(lists), "<u4").tolist():
                begin = max(0, at - REACH + 1)  # of the first window that the token may lead
                near = raw[begin:at + LENGTH]
                place, _, last, _ = tokens(np.frombuffer(near, np.uint8))
                right += [near[at - begin:b + LENGTH] for b in last[place == at - begin].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(right, pa.binary())], names=["right"])


# Rows that are sorted at once; longer stretches are cut in three.
SMALL = 2048


def multikey_sort(rows: np.ndarray) -> np.ndarray:
    """The order of rows of 64-bit words, by multikey quicksort; equal rows keep their order.

    A stretch of rows that agree on their first words is cut in three by the next word of a middle row: those below it, those equal to it,
    which go on with the word after, and those above it.
    """
    order, words = np.arange(len(rows)), rows.shape[1]
    open_ = [(0, len(rows), 0)]
    while open_:
        a, b, word = open_.pop()
        part = order[a:b]
        if b - a <= SMALL:
            order[a:b] = part[np.lexsort(rows[part, word:].T[::-1])]
            continue
        keys = rows[part, word]
        drawn = np.sort(keys[:: max(1, (b - a) // 63)])
        pivot = drawn[len(drawn) // 2]
        sides = [part[keys < pivot], part[keys == pivot], part[keys > pivot]]
        order[a:b] = np.concatenate(sides)
        below, equal = a + len(sides[0]), a + len(sides[0]) + len(sides[1])
        open_ += [s for s in ((a, below, word), (below, equal, word + 1), (equal, b, word)) if s[1] - s[0] > 1 and s[2] < words]
    return order


def common_prefix(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each row of bytes with the one before it (0 for the first), the bytes they share."""
    out = np.zeros(len(rows), np.int64)
    differ = rows[1:] != rows[:-1]
    out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    out[1:] = np.minimum(out[1:], np.minimum(lengths[1:], lengths[:-1]))
    return out


FOUND = "doc bigint, text_hash bigint, begin bigint, end bigint, window bigint"


def _padded(column: pa.ChunkedArray, width: int, mark: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Byte strings and a mark behind them as rows of `width`, filled up with zeros; the strings' lengths."""
    strings = column.to_pylist()
    lengths = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join((s + mark).ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width), lengths


def _compare_range(group: pa.Table) -> pa.Table:
    """Repeated stretches of a range's suffixes, and the windows (by hash) that other ranges may hold, too."""
    # Marked like the splitters' keys, so that rows lie in the order of the ranges whatever bytes they hold.
    width = -(-(LENGTH + 1) // 8) * 8
    right, right_n = _padded(group.column("right"), width, MARK)
    order = multikey_sort(right.view(">u8"))
    right, right_n = right[order], right_n[order]
    left, left_n = _padded(group.column("left"), REACH)
    left, left_n = left[order], left_n[order]
    doc, text_hash, place = (group.column(c).to_numpy()[order] for c in ("doc", "text_hash", "place"))
    shared = common_prefix(right, right_n)
    up = powers(LENGTH + 1)[0]
    # Hashes of the last bytes before the token, and of the first bytes from it on, byte by byte.
    before = np.zeros(len(doc), np.uint64)
    after = [np.zeros(len(doc), np.uint64)]
    for k in range(LENGTH):
        after.append(after[-1] + (right[:, k].astype(np.uint64) + np.uint64(1)) * up[k])
    furthest, nearest = np.full(len(doc), -1), np.full(len(doc), LENGTH)
    open_rows = []
    for back in range(REACH):
        if back:  # the byte `back` before the token; rows are filled up from the left's begin
            at = left_n - back
            byte = left[np.arange(len(doc)), np.maximum(at, 0)]
            before = before * np.uint64(0x9E3779B97F4A7C15) + np.where(at >= 0, byte, 0).astype(np.uint64) + np.uint64(1)
        need = LENGTH - back
        rows = np.flatnonzero((left_n >= back) & (right_n >= need))
        if not len(rows):
            continue
        run = np.cumsum(shared < need)  # suffixes that agree on the rest of the window
        keys = mix(before[rows] + mix(run[rows].astype(np.uint64)))
        unique, group_of = np.unique(keys, return_inverse=True)
        least = np.full(len(unique), LAST, np.int64)
        np.minimum.at(least, group_of, doc[rows])
        first = least[group_of] == doc[rows]
        outer = first & np.isin(run[rows], (run[0], run[-1]))  # only the range's first may have an earlier one elsewhere
        hit = rows[~first]
        furthest[hit] = back
        nearest[hit] = np.minimum(nearest[hit], back)
        if outer.any():
            edge = rows[outer]
            window = mix(mix(before[edge] + np.uint64(back)) + after[need][edge])
            open_rows.append((doc[edge], text_hash[edge], place[edge] - back, place[edge] - back + LENGTH, window.view(np.int64)))
    hit = np.flatnonzero(furthest >= 0)
    parts = [(doc[hit], text_hash[hit], place[hit] - furthest[hit], place[hit] - nearest[hit] + LENGTH), *open_rows]
    columns = [np.concatenate([p[i] for p in parts]) for i in range(4)]
    release(every=1.0)
    windows = [None] * len(hit) + [w for p in open_rows for w in p[4].tolist()]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc", "text_hash", "begin", "end", "window"), [*columns, windows])})


def merged(begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(begins[1:] > reach[:-1]) + 1
    return list(zip(begins[np.append(0, new)].tolist(), reach[np.append(new, len(reach)) - 1].tolist())) if len(begins) else []


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _compressed(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, text) with the text's bytes packed: a third of the shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                packed = [_pack(np.frombuffer(_bytes_of(t), np.uint8)) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())],
                                                 names=["doc", "text_hash", "packed"])

    return docs.select("doc", "text_hash", "text").mapInArrow(pack, "doc bigint, text_hash bigint, packed binary")


def repeated_spans(sources: DataFrame, total_bytes: int) -> DataFrame:
    """(doc, text_hash, begin, end): stretches of `sources` (doc, text_hash, text) that repeat smaller docs'.

    Tokens are dealt to buckets of about `BUCKET_TOKENS`; beyond `DIRECT` buckets in two steps, so that a task never
    makes more rows than some for each megabyte it reads.
    """
    spark = sources.sparkSession
    buckets = max(1, -(-total_bytes * 2 // (REACH + 1) // BUCKET_TOKENS))
    groups = buckets if buckets <= DIRECT else math.isqrt(buckets - 1) + 1
    dealt = sources.mapInArrow(_deal_tokens(buckets, groups), "bucket int, tokens binary")
    if groups < buckets:
        dealt = (dealt.repartition("bucket").sortWithinPartitions("bucket")
                 .mapInArrow(_deal_again(buckets, groups), "bucket int, tokens binary"))
    places = _saved(dealt.groupBy("bucket")
                    .applyInArrow(_shared_tokens, "doc bigint, text_hash bigint, n bigint, places binary"), "tokens")
    total = places.agg(F.sum("n")).first()[0] or 0

    ranges = max(1, -(-total // RANGE_SUFFIXES))
    splitters: list[bytes] = []
    if ranges > 1:
        # About so many suffixes of at most LENGTH bytes come to the driver.
        wanted = max(SAMPLE, RANGE_SAMPLE * ranges)
        chosen = (places.select("doc", "text_hash", "places")
                  .mapInArrow(_sampled(max(1, total // wanted)), "doc bigint, text_hash bigint, places binary")
                  .groupBy("doc", "text_hash").agg(F.collect_list("places").alias("lists")))
        if wanted <= MAX_BROADCAST_GROUPS:
            chosen = F.broadcast(chosen)
        drawn = (sources.join(chosen, ["doc", "text_hash"]).select("text", "lists")
                 .mapInArrow(_drawn, "right binary").toArrow().column("right").to_pylist())
        drawn = sorted(r + MARK for r in drawn)
        splitters = [drawn[len(drawn) * i // ranges] for i in range(1, ranges)] if drawn else []
    lists = places.groupBy("doc", "text_hash").agg(F.collect_list("places").alias("lists"))
    # Always a shuffled join: with a broadcast one, a task would need two Python workers, and idle ones keep memory.
    suffixes = (_compressed(sources).join(lists.hint("merge"), ["doc", "text_hash"])
                .select("doc", "text_hash", "packed", "lists").mapInArrow(_suffixes(splitters), SUFFIX))
    found = _saved(suffixes.groupBy("part").applyInArrow(_compare_range, FOUND), "repeats")
    open_ = found.where("window is not null")
    least = open_.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    across = open_.join(least, "window").where("least < doc").select("doc", "text_hash", "begin", "end")
    return found.where("window is null").select("doc", "text_hash", "begin", "end").unionAll(across)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, `spans` (removed stretches, in order), `kept`, the other
    bytes, and `kept_text`, the whole characters among them.

    With `carry`, `row` holds all columns of `docs`.

    A byte is removed if a string of 50 bytes that covers it starts in a document with a smaller id,
    too; strings are taken from whole texts before any removal. Null texts are empty. A null id is
    greater than all others; rows that share an id don't remove from each other, and are documents
    of their own. An empty table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(1), text).alias("text_hash2"), text.alias("text"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    more = ["row"] if carry else []
    sizes = _saved(rows.groupBy("text_hash", "text_hash2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"),
                                                              F.max(F.octet_length("text")).cast("bigint").alias("bytes")), "texts")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    copied = sizes.where(f"first < last AND bytes >= {LENGTH}").select("text_hash", "text_hash2", "first")
    if copied.count() <= MAX_BROADCAST_GROUPS:
        copied = F.broadcast(copied)
    marked = (rows.join(copied, ["text_hash", "text_hash2"], "left")
              .withColumn("copy", F.coalesce(F.col("first") < F.col("doc"), F.lit(False))))
    sources = marked.where("NOT copy").select("doc", "text_hash", "text")
    spans = (repeated_spans(sources, total).groupBy("doc", "text_hash")
             .agg(F.collect_list(F.shiftleft("begin", 32).bitwiseOR(F.col("end"))).alias("found")))  # a text has below 2 ** 31 bytes
    span_type = "array<struct<begin:bigint,end:bigint>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()),
                           ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("kept_text", pa.string())])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out, part = [], batch.slice(at, 256)
                for key, copy, content, found in zip(*(c.to_pylist() for c in part.columns[:4])):
                    data = _bytes_of(content)
                    spans = np.array([len(data)] if copy else found or [], np.int64)
                    gone = merged(spans >> 32, spans & 0xFFFFFFFF)
                    edges = [0, *(x for s in gone for x in s), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((key, len(data), [{"begin": a, "end": b} for a, b in gone], kept, kept.decode("utf-8", "ignore")))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*out), kinds.types)), *part.columns[4:]],
                                                 names=[*kinds.names, *more])

    joined = marked.select("id", "copy", "text", "doc", "text_hash", *more).join(spans, ["doc", "text_hash"], "left")
    schema = f"id bigint, n_bytes bigint, spans {span_type}, kept binary, kept_text string"
    if carry:
        schema = T._parse_datatype_string(schema).add("row", joined.schema["row"].dataType)
    return (joined.select("id", "copy", "text", "found", *more).mapInArrow(cut, schema)
            .select(F.col("id").alias(id_col), "n_bytes", "spans", "kept", "kept_text", *more))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with what remains of their texts.

    Where a cut leaves part of a character, that part goes, too. A null text becomes an empty one.
    """
    rows = remove_repeats(docs, id_col, text_col, carry=True)
    return rows.select(*[F.col("kept_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["begin"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
