"""Near duplicates of texts: fast similarity sketches, banding, exact verification.

A sketch has `COORDINATES` bins. In round i every shingle falls into a bin and leaves a hash there,
marked with the round; a bin keeps its least, so earlier rounds win. After as many rounds as bins,
further rounds put every shingle into one bin each, so that every coordinate is filled however few
shingles there are, and equal coordinates estimate the similarity as independent ones would, or better.

Texts with equal sets are one class. Classes that agree on a band of four coordinates meet in a
bucket, where each is paired with one representative, another one in each band. The likeliest pairs of each class are tested
on whole texts, in two rounds, and the pairs of buckets of two until none joins two components. Buckets that
still hold several components are then searched block against block: their whole sets are compared there, without listing
pairs (very large ones by finer sketches). So components are exact up to the sketches' error (README).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.components import components
from lakeops.llm.hashing import mix, shingles
from lakeops.llm.registry import query, table
from lakeops.llm.workers import release
from lakeops.session import scratch_dir

COORDINATES, ROWS = 128, 4
BANDS = COORDINATES // ROWS
# Pairs below this estimate aren't tested: more than four standard deviations under 0.75.
LEAST_ESTIMATE = 0.58
# The same for the finer sketches of classes in buckets that hold several components.
FINE_COORDINATES, LEAST_FINE = 1024, 0.69
BLOCK_ROWS = 512


def sketch(items: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """The sketch of a set of 64-bit hashes: round and hash for each of `size` bins (a power of two).

    Not for the empty set.
    """
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    shift = np.uint64(64 - (size.bit_length() - 1))
    begin = 0
    while begin < size:
        # As many rounds at once as make about 4096 hashes.
        rounds = np.arange(begin, min(size, begin + max(1, 4096 // len(items))), dtype=np.uint64)
        hashes = mix(items[None, :] + mix(rounds + np.uint64(1))[:, None])
        values = (hashes >> np.uint64(12)) | (rounds << np.uint64(52))[:, None]
        # The bin is taken from the top bits, the value's order from others.
        np.minimum.at(bins, (mix(hashes) >> shift).ravel(), values.ravel())
        begin += len(rounds)
        if bins.max() < np.uint64(begin << 52):
            return bins
    for i in np.flatnonzero(bins == np.iinfo(np.uint64).max):
        r = np.array([size + i], np.uint64)
        bins[i] = (mix(items + mix(r + np.uint64(1))) >> np.uint64(12)).min() | (r << np.uint64(52))[0]
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in bins.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def fingerprint(items: np.ndarray) -> int:
    """A 64-bit name of the set, whatever its order: equal sets are one class."""
    one = mix(items ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64, keepdims=True)
    two = mix(items + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(mix(one) + two).view(np.int64)[0])


SKETCHED = "id bigint, text_hash bigint, n bigint, class bigint, bands array<bigint>, marks binary"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, hash of the text, text) -> `SKETCHED`; a text without words has no class."""
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("class", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("marks", pa.binary())])
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            out = []
            for key, text_hash, text in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)):
                items = shingles(text)
                if not len(items):
                    out.append((key, text_hash, 0, None, None, None))
                    continue
                bins = sketch(items)
                out.append((key, text_hash, len(items), fingerprint(items), band_keys(bins), mix(bins).astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    release()


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> the pairs whose whole sets are similar enough."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            a, b, ta, tb = (c.to_pylist() for c in batch.slice(at, 256).columns)
            out, last = [], (None, None)
            for row in range(len(a)):
                if last[0] != ta[row]:
                    last = (ta[row], shingles(ta[row]))
                x, y = last[1], shingles(tb[row])
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    out.append((a[row], b[row]))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    release()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of the marks (one byte for a coordinate) along the last axis; broadcasts."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COORDINATES) for i in (2, 3)]
        found = estimate(*marks)
        keep = np.flatnonzero(found >= LEAST_ESTIMATE)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)),
                                          pa.array(found[keep], pa.float64())], names=["a", "b", "likely"])


# Sets of up to so many shingles are compared whole within blocks; larger ones by finer sketches first, then as texts.
WHOLE = 100_000
# Sets of one block, in bytes.
BLOCK_BYTES = 16 << 20


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, n, text) -> (class, its whole set or, if that is too large, a byte for each coordinate of a finer sketch)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = []
            for n, text in zip(part.column(1).to_pylist(), part.column(2)):
                items = shingles(text.as_py())
                out.append(items.tobytes() if n <= WHOLE else mix(sketch(items, FINE_COORDINATES)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=["class", "content"])
    release()


def common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many items each of some sets shares with each of some others: products of 0/1 matrices, `width` items at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out.astype(np.int64)
    sides, known = [], None
    for sets in (left, right):
        items = np.concatenate(sets)
        sides.append((items, np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
        known = np.unique(items) if known is None else np.intersect1d(known, items)
    # Items of one side only count for nothing.
    places = []
    for items, row in sides:
        at = np.minimum(np.searchsorted(known, items), max(len(known) - 1, 0))
        met = known[at] == items if len(known) else np.zeros(len(items), bool)
        at, row = at[met], row[met]
        order = np.argsort(at, kind="stable")
        places.append((at[order], row[order]))
    for begin in range(0, len(known), width):
        block = []
        for (at, row), sets in zip(places, (left, right)):
            lo, hi = np.searchsorted(at, (begin, begin + width))
            dense = np.zeros((len(sets), min(width, len(known) - begin)), np.float32)
            dense[row[lo:hi], at[lo:hi] - begin] = 1
            block.append(dense)
        out += block[0] @ block[1].T
    return out.astype(np.int64)


def _block_links(group: pa.Table) -> pa.Table:
    """What two blocks of a bucket say about their pairs of different components.

    Pairs of whole sets are tested here: of those that link, a forest is returned, with `likely` null, so that there are no more rows
    than classes. Pairs with a larger set are returned if their finer sketches make a link likely. A pair that meets in several buckets is looked
    at in the first band's.
    """
    node, part, root, n = (group.column(c).to_numpy() for c in ("class", "part", "root", "n"))
    marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(len(node), -1)
    contents = group.column("content").to_pylist()
    bands = np.array(group.column("bands").to_pylist(), np.int64)
    i, j, band = (group.column(c)[0].as_py() for c in ("i", "j", "band"))
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    small = n <= WHOLE
    whole = [rows[small[rows]] for rows in (left, right)]
    shared = common_counts(*([np.frombuffer(contents[r], np.uint64) for r in rows] for rows in whole))
    at = [{int(r): k for k, r in enumerate(rows)} for rows in whole]
    links, likely = [], []
    for row in left:
        others = right[(root[right] != root[row]) & (4 * np.minimum(n[right], n[row]) >= 3 * np.maximum(n[right], n[row]))]
        others = others[~(bands[row, :band] == bands[others, :band]).any(axis=1)]
        if small[row]:
            mine = others[small[others]]
            both = shared[at[0][int(row)], [at[1][int(o)] for o in mine]] if len(mine) else np.zeros(0, np.int64)
            links += [(row, o) for o in mine[100 * both >= 75 * (n[row] + n[mine] - both)]]
            others = others[~small[others]]
        others = others[estimate(marks[row], marks[others]) >= LEAST_ESTIMATE]
        if len(others):
            fine = [np.frombuffer(contents[r] if n[r] > WHOLE else mix(sketch(np.frombuffer(contents[r], np.uint64), FINE_COORDINATES)).astype(
                np.uint8).tobytes(), np.uint8) for r in (row, *others)]
            found = estimate(fine[0], np.stack(fine[1:]))
            likely += [(min(node[row], node[o]), max(node[row], node[o]), float(p)) for o, p in zip(others, found) if p >= LEAST_FINE]
    # A forest over the components that these links join.
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for a, b in links:
        x, y = find(int(root[a])), find(int(root[b]))
        if x != y:
            top[y] = x
            out.append((min(node[a], node[b]), max(node[a], node[b]), None))
    rows = [*out, *set(likely)]
    release(every=1.0)
    return pa.table({"a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int64()),
                     "likely": pa.array([r[2] for r in rows], pa.float64())})


class _Search:
    """The links found so far among the classes of one run, and the pairs tested."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes, self.spark = docs, classes, docs.sparkSession
        self.links: DataFrame | None = None
        self.tested: DataFrame | None = None
        self.groups: DataFrame | None = None

    def rooted(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """The frame with the component of `column` as `name`; its own class where it has no link."""
        if self.groups is None:
            return df.withColumn(name, F.col(column))
        groups = self.groups.select(F.col("node").alias("_node"), F.col("component").alias("_root"))
        return (df.join(groups, F.col(column) == F.col("_node"), "left")
                .withColumn(name, F.coalesce("_root", column)).drop("_node", "_root"))

    def between(self, pairs: DataFrame) -> DataFrame:
        """The untested pairs that would join two components."""
        left = self.rooted(self.rooted(pairs, "a", "ra"), "b", "rb").where("ra <> rb").select("a", "b", "likely")
        return left if self.tested is None else left.join(self.tested, ["a", "b"], "left_anti")

    def texts(self, wanted: DataFrame, *more: str) -> DataFrame:
        """(class, text) of the classes in column `class`, with `more` of their columns between."""
        ids = self.classes.join(wanted, "class", "left_semi").select("class", *more, "rep.id", "rep.text_hash")
        return (ids.alias("i").join(self.docs.alias("d"), F.expr("i.text_hash = d.text_hash AND i.id <=> d.id"))
                .select("class", *more, "text"))

    def test(self, pairs: DataFrame) -> None:
        """Test pairs on their whole texts and bring the components up to date."""
        pairs = saved(pairs.select("a", "b").distinct(), "pairs")
        if pairs.isEmpty():
            return
        texts = self.texts(pairs.select(F.col("a").alias("class")).unionAll(pairs.select("b")).distinct())
        one = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
        found = saved(pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
                      .mapInArrow(_links, "a bigint, b bigint"), "links")
        self.tested = pairs if self.tested is None else self.tested.unionAll(pairs)
        self.add(found)

    def add(self, found: DataFrame) -> None:
        """Bring the components up to date with some links."""
        if found.isEmpty():
            return
        self.links = found if self.links is None else self.links.unionAll(found)
        self.groups = saved(components(self.links), "groups")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def best_pairs(pairs: DataFrame) -> DataFrame:
    """For each class its likeliest pair: no more pairs than classes."""
    best = F.max(F.struct("likely", "a", "b")).alias("p")
    ends = pairs.select(F.col("a").alias("x"), "likely", "a", "b").unionAll(pairs.select("b", "likely", "a", "b"))
    return ends.groupBy("x").agg(best).select("p.a", "p.b", "p.likely")


def similar_size(x: str, y: str) -> Column:
    """No pair of sets whose sizes differ more can be similar enough."""
    return F.expr(f"4 * least({x}, {y}) >= 3 * greatest({x}, {y})")


def _grouped(docs: DataFrame, id_col: str, text_col: str, block_rows: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, text_hash and n of each row, and `top`: the least (id, text_hash) of its component; null without shingles."""
    key = F.col(f"`{id_col}`").cast("bigint").alias("id")
    texts = docs.select(key, F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    rows = saved(texts.mapInArrow(_sketched, SKETCHED), "sketches")
    rep = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("rep")
    classes = saved(rows.where("n > 0").groupBy("class", "n").agg(rep, F.first("bands").alias("bands"), F.first("marks").alias("marks")),
                    "classes")
    salt = F.xxhash64("band")
    banded = classes.select("class", F.posexplode("bands").alias("band", "key"))
    buckets = (banded.groupBy("key", "band").agg(F.min(F.col("class").bitwiseXOR(salt)).alias("least"), F.count(F.lit(1)).alias("size"))
               .where("size > 1").select("key", "band", F.col("least").bitwiseXOR(salt).alias("star"), "size"))
    members = saved(banded.join(buckets, ["key", "band"]), "buckets")
    marked = classes.select("class", "n", "marks")
    one, two = (marked.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), F.col("marks").alias(f"m{c}")) for c in "ab")
    stars = members.where("class <> star").select(F.least("class", "star").alias("a"), F.greatest("class", "star").alias("b")).distinct()
    pairs = saved(stars.join(one, "a").join(two, "b").where(similar_size("na", "nb")).select("a", "b", "ma", "mb")
                  .mapInArrow(_estimated, "a bigint, b bigint, likely double"), "likely")
    search = _Search(texts.where("text is not null"), classes)
    search.test(best_pairs(pairs))
    search.test(best_pairs(search.between(pairs)))
    # Buckets of two have no other pair; in larger ones, what is left is compared in blocks.
    alone = members.where("size = 2 AND class <> star").select(F.least("class", "star").alias("a"), F.greatest("class", "star").alias("b")).distinct()
    search.test(search.between(pairs.join(alone, ["a", "b"], "left_semi")))
    # Buckets of three and more that still hold several components.
    rooted = saved(search.rooted(members.where("size > 2").select("key", "band", "class"), "class", "root"), "rooted")
    sized = rooted.join(classes.select(F.col("class").alias("_c"), "n"), F.col("class") == F.col("_c")).drop("_c")
    parts = F.greatest(F.ceil(F.col("members") / block_rows), F.ceil(F.col("items") * 8 / F.lit(block_bytes)))
    open_keys = (sized.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"),
                                          F.sum(F.least("n", F.lit(WHOLE))).alias("items"))
                 .where("lo <> hi").select("key", parts.cast("int").alias("parts")))
    open_rows = saved(rooted.join(open_keys, "key"), "open")
    contents = search.texts(open_rows.select("class").distinct(), "n").mapInArrow(_contents, "class bigint, content binary").dropDuplicates(["class"])
    blocks = (open_rows.join(classes.select("class", "n", "marks", "bands"), "class").join(contents, "class")
              .withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))
    more = saved(blocks.select("key", "band", "i", "j", "part", "class", "root", "n", "marks", "bands", "content").groupBy("key", "band", "i", "j")
                 .applyInArrow(_block_links, "a bigint, b bigint, likely double"), "more")
    search.add(more.where("likely IS NULL").select("a", "b"))
    search.test(search.between(more.where("likely IS NOT NULL")))
    roots = search.rooted(classes.select("class", "rep"), "class", "root")
    least = roots.groupBy("root").agg(F.min("rep").alias("top")).withColumnRenamed("root", "r")
    named = roots.join(least, F.col("root") == F.col("r")).select(F.col("class").alias("c"), "top")
    return rows.select("id", "text_hash", "n", "class").join(named, F.col("class") == F.col("c"), "left").select("id", "text_hash", "n", "top")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id and kept.

    Documents link if their sets of five-word shingles (hashed to 64 bits) have a similarity of at
    least 0.75. Null texts and texts without words have no shingles and link with nothing. Rows that
    repeat an id are documents of their own; null ids link, but name a component (as null) only where
    it has no other. An empty table gives no rows; other columns aren't read.
    """
    component = F.when(F.col("n") > 0, F.col("top.id")).otherwise(F.col("id"))
    return (_grouped(docs, id_col, text_col, block_rows)
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                    component.eqNullSafe(F.col("id")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row of each component, that with the least id (of its repeats, that with the least hash of its columns), and all rows without words.

    Rows keep all their columns. What goes is joined away by id and text, so that texts move only if
    the list of what goes is too long to send to every task.
    """
    rows = saved(_grouped(docs, id_col, text_col, block_rows), "grouped")
    gone = rows.where("n > 0 AND NOT (id <=> top.id AND text_hash = top.text_hash)").select("id", "text_hash").distinct()
    text_hash = F.xxhash64(F.col(f"`{text_col}`"))
    key = F.col(f"`{id_col}`").cast("bigint")
    left = docs.join(gone, key.eqNullSafe(gone["id"]) & (text_hash == gone["text_hash"]), "left_anti")
    repeated = rows.where("n > 0").groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    if repeated.isEmpty():
        return left
    # Repeats of a row: one stays. Only their rows meet by key; `docs` may have columns of any name.
    held = left.select(key.alias("id"), text_hash.alias("text_hash"), F.struct(*[left[c] for c in left.columns]).alias("row"))
    marked = held.join(repeated, held["id"].eqNullSafe(repeated["id"]) & (held["text_hash"] == repeated["text_hash"]), "left").select(
        held["id"], held["text_hash"], "row", "copies")
    alone = marked.where("copies IS NULL").select("row.*")
    # The same one on every run: that with the least hash of all its columns, as JSON if they can't be compared.
    whole = F.to_json("row")
    firsts = (marked.where("copies IS NOT NULL").groupBy("id", "text_hash")
              .agg(F.min_by("row", F.struct(F.xxhash64(whole), whole)).alias("row")))
    return alone.unionAll(firsts.select("row.*"))


@query("op1_minhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
