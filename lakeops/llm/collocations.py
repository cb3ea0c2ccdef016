"""Phrase collocation mining by direct-address tiling.

Texts are kept as blocks of word ids. Words are ranked by frequency, so that the ids of frequent words lie close
together; the pairs of adjacent ids of a block are dealt to square tiles of the id plane. A tile that holds many is
counted by one dense bincount over its cells, the sparse ones together as sorted coordinates; Spark sums the counts
of all blocks. Frequent pairs are ranked by frequency in turn and replace the words in the blocks: adjacent pairs
are phrases of three words, and so on. A phrase longer than a word is thus a pair of overlapping phrases.

Blocks are numbered from by their own dictionaries: the distinct words (or pairs) of a block are joined with the
ranked table and gathered by block, so that no table of the whole corpus goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeops.llm.hashing import word_hashes
from lakeops.llm.registry import query, table
from lakeops.operators.schema import assign_identity
from lakeops.session import scratch_dir

BLOCK_BYTES = (2 << 20) - 1024
# All unfinished blocks of a task (one for each language it meets).
HELD_BYTES = 8 << 20
TILE_BITS = 8
# Pairs that make a tile worth a dense count of its cells.
DENSE = 1 << (2 * TILE_BITS - 3)
OUT_ROWS = 1 << 16

# The characters that end a piece and those that separate words.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
WORD, BLANK, BREAK = range(3)
CLASS = np.zeros(256, np.int8)
CLASS[list(BLANKS)] = BLANK
CLASS[list(BREAKS)] = BREAK

BLOCKS = "block bigint, lang string, n bigint, words array<string>, counts array<bigint>, seq binary"


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words, and whether a word begins a new piece."""
    kind = CLASS[data]
    change = np.flatnonzero(np.diff(np.concatenate(([False], kind == WORD, [False])).astype(np.int8)))
    begins, ends = change[::2], change[1::2]
    breaks = np.cumsum(kind == BREAK, dtype=np.int32)
    at = breaks[begins]
    return begins, ends, np.append(True, at[1:] != at[:-1])[:len(begins)]


def sections(text: bytes, context: int, size: int = BLOCK_BYTES) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about `size` bytes, cut behind words, and how many bytes of context head each.

    The context is what the last `context` words of the piece that goes on were.
    """
    if len(text) <= size:
        yield text, 0
        return
    data, at, head = np.frombuffer(text, np.uint8), 0, b""
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and CLASS[data[end]] == WORD:
            step = data[end:end + 4096]
            inside = CLASS[step] == WORD
            end += len(step) if inside.all() else int(inside.argmin())
        part = head + text[at:end]
        yield part, len(head)
        begins, ends, fresh = spans(np.frombuffer(part, np.uint8))
        kept: list[bytes] = []
        if len(begins) and not (CLASS[np.frombuffer(part[ends[-1]:], np.uint8)] == BREAK).any():
            for i in range(len(begins) - 1, max(-1, len(begins) - 1 - context), -1):
                kept.append(part[begins[i]:ends[i]])
                if fresh[i]:
                    break
        head, at = b" ".join(reversed(kept)) + b" " if kept else b"", end


def block_of(parts: list[tuple[bytes, int]]) -> tuple[int, list[str], list[int], bytes]:
    """Own words, dictionary, its counts and the sequence of some sections.

    The sequence holds, as u4, 0 where a piece ends and else twice the word's place in the dictionary from 1 on, plus 1
    for the section's own words (others are context, and counted elsewhere).
    """
    raw = b"\n".join(p for p, _ in parts)
    data = np.frombuffer(raw, np.uint8)
    begins, ends, fresh = spans(data)
    keys, first, local = np.unique(word_hashes(data, begins, ends), return_index=True, return_inverse=True)
    own = np.ones(len(begins), bool)
    at = 0
    for part, head in parts:
        if head:
            own[np.searchsorted(begins, at):np.searchsorted(begins, at + head)] = False
        at += len(part) + 1
    seq = np.zeros(len(begins) + int(fresh.sum()), "<u4")
    seq[np.arange(len(begins)) + np.cumsum(fresh)] = ((local + 1) << 1) | own
    words = [raw[begins[i]:ends[i]].decode("utf-8", "surrogatepass") for i in first]
    return int(own.sum()), words, np.bincount(local[own], minlength=len(keys)).tolist(), seq.tobytes()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
             "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in ddl.split(", "))])


def _blocks(context: int, block_bytes: int):
    schema = _schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, total = TaskContext.get().partitionId() << 33, {}, 0

        def done(lang: str) -> pa.RecordBatch:
            nonlocal number, total
            parts = held.pop(lang)
            total -= sum(len(p) for p, _ in parts)
            number += 1
            row = (number, lang, *block_of(parts))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                lang, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if not text:
                    continue
                for part in sections(text.encode("utf-8", "surrogatepass").lower(), context, block_bytes):
                    if lang in held and sum(len(p) for p, _ in held[lang]) + len(part[0]) > block_bytes:
                        yield done(lang)
                    held.setdefault(lang, []).append(part)
                    total += len(part[0])
                while total > max(HELD_BYTES, block_bytes):
                    yield done(max(held, key=lambda k: sum(len(p) for p, _ in held[k])))
        for lang in list(held):
            yield done(lang)

    return run


def saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, f"collocations-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_blocks(docs: DataFrame, lang_col: str, text_col: str, context: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(_blocks(context, block_bytes), BLOCKS)


def condensed(ids: np.ndarray, own: np.ndarray) -> bytes:
    """A sequence of ids (0: none) and own marks as i8, without what can't be part of a pair.

    Runs of ids are kept whole where they have two ids or more, with one 0 behind each.
    """
    some = np.concatenate(([False], ids > 0, [False]))
    keep = some[1:-1] & (some[:-2] | some[2:])
    end = ~some[1:-1] & np.concatenate(([False], keep[:-1]))[:len(ids)] if len(ids) else keep
    return np.where(ids > 0, (ids << 1) | own, 0)[keep | end].astype("<i8").tobytes()


def adjacent(seq: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places t of a condensed sequence where ids stand at t - 1 and t, and the two ids."""
    values = np.frombuffer(seq, "<i8")
    ids = values >> 1
    at = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0)) + 1 if len(ids) else np.zeros(0, np.int64)
    return at, ids[at - 1], ids[at]


def pair_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids and how often they occur, tile by tile."""
    if not len(left):
        return left, right, left
    rows, columns = left >> TILE_BITS, right >> TILE_BITS
    tile = rows * (int(columns.max()) + 1) + columns
    cell = ((left & ((1 << TILE_BITS) - 1)) << TILE_BITS) | (right & ((1 << TILE_BITS) - 1))
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    begins = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
    sizes = np.diff(np.append(begins, len(tile)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in np.flatnonzero(sizes >= DENSE).tolist():
        a = begins[k]
        dense = np.bincount(cell[a:a + sizes[k]], minlength=1 << (2 * TILE_BITS))
        cells = np.flatnonzero(dense)
        out.append((np.full(len(cells), k), cells, dense[cells]))
    run = np.repeat(np.arange(len(begins)), sizes)
    sparse = np.repeat(sizes < DENSE, sizes)
    codes, counts = np.unique((run[sparse] << (2 * TILE_BITS)) | cell[sparse], return_counts=True)
    out.append((codes >> (2 * TILE_BITS), codes & ((1 << (2 * TILE_BITS)) - 1), counts))
    run, cell, counts = (np.concatenate(x) for x in zip(*out))
    first = order[begins[run]]
    return ((left[first] >> TILE_BITS << TILE_BITS) | (cell >> TILE_BITS),
            (right[first] >> TILE_BITS << TILE_BITS) | (cell & ((1 << TILE_BITS) - 1)), counts)


def _sequence(block: int, seq: bytes) -> pa.Table:
    return pa.table({"block": pa.array([block], pa.int64()), "seq": pa.array([seq], pa.binary())})


def _words_to_ids(block: pa.Table, known: pa.Table) -> pa.Table:
    """One block's sequence by the ids of its dictionary; `known` has block, place and id."""
    old = np.frombuffer(block.column("seq")[0].as_py(), "<u4")
    place, ids = (known.column(c).to_numpy() for c in ("place", "id"))
    to = np.zeros(int(max(old.max(initial=0) >> 1, place.max(initial=0) + 1)) + 1, np.int64)
    to[place + 1] = ids
    return _sequence(block.column("block")[0].as_py(), condensed(to[old >> 1], old & 1))


def _pairs_to_ids(block: pa.Table, known: pa.Table) -> pa.Table:
    """One block's sequence by the ids of its pairs, each at its last word; `known` has block, left, right and id."""
    seq = block.column("seq")[0].as_py()
    left, right, ids = (known.column(c).to_numpy() for c in ("left", "right", "id"))
    at, a, b = adjacent(seq)
    new = np.zeros(len(seq) // 8, np.int64)
    if len(ids) and len(at):
        lefts, rights = np.unique(left), np.unique(right)
        key = np.searchsorted(lefts, left) * len(rights) + np.searchsorted(rights, right)
        order = np.argsort(key)
        i, j = (np.minimum(np.searchsorted(known_, x), len(known_) - 1) for known_, x in ((lefts, a), (rights, b)))
        met = (lefts[i] == a) & (rights[j] == b)
        wanted = i * len(rights) + j
        place = np.minimum(np.searchsorted(key[order], wanted), len(key) - 1)
        met &= key[order][place] == wanted
        new[at[met]] = ids[order][place[met]]
    return _sequence(block.column("block")[0].as_py(), condensed(new, np.frombuffer(seq, "<i8") & 1))


# A map of so many bits tells blocks which pairs can't be frequent; the join behind it decides.
MAP_BITS = 1 << 26
STRIDE, WRAP = 31337, 1_000_003


def frequent_map(pairs: DataFrame) -> np.ndarray:
    """A map of `MAP_BITS` (8 MB, whatever the pairs) with the bits of these pairs set."""
    bit = (F.col("left") % WRAP * STRIDE + F.col("right")) % MAP_BITS
    out = np.zeros(MAP_BITS // 8, np.uint8)
    rows = (pairs.select((bit + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    for r in rows.toLocalIterator():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * len(part):r["bucket"] * len(part)] = part
    return out


def _counted(frequent=None):
    """Over (block, seq): block, left, right and count of each pair that ends in an own word.

    With the broadcast map `frequent`, of all pairs, but for those whose bit isn't set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                seq = batch.column(1)[r].as_py()
                at, left, right = adjacent(seq)
                if frequent is None:
                    mine = (np.frombuffer(seq, "<i8")[at] & 1) > 0
                else:
                    bit = (left % WRAP * STRIDE + right) % MAP_BITS
                    mine = (frequent.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                left, right, counts = pair_counts(left[mine], right[mine])
                for a in range(0, len(left), OUT_ROWS):
                    part = slice(a, a + OUT_ROWS)
                    block = pa.array(np.full(len(left[part]), batch.column(0)[r].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([block, *(pa.array(x[part].astype(np.int64)) for x in (left, right, counts))],
                                                     ["block", "left", "right", "c"])

    return run


PAIRS = "block bigint, left bigint, right bigint, c bigint"


def ranked(df: DataFrame, *ties: str) -> DataFrame:
    """With `id`, from 1 on by falling `a`."""
    counted = saved(df, "counted")
    return saved(assign_identity(counted.withColumn("_less", -F.col("a")), ["_less", *ties]).drop("_less"), "ranked")


def _resolved(blocks: DataFrame, known: DataFrame, to_ids) -> DataFrame:
    """The blocks by the ids their own entries were given; blocks without any go."""

    def run(block: pa.Table, entries: pa.Table) -> pa.Table:
        if not block.num_rows or not entries.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "seq": pa.array([], pa.binary())})
        return to_ids(block, entries)

    return blocks.groupBy("block").cogroup(known.withColumnRenamed("block", "of").groupBy("of")).applyInArrow(run, "block bigint, seq binary")


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, longest: int = 3,
                     block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(phrases, lang and n): words and phrases of up to `longest` words that occur `least` times in a language.

    Columns of the phrases: id (within a size), lang, size, words, a (occurrences), pre (those of its first 1, 2, ... words),
    suf (of its last 1, 2, ...), left and right (ids of the phrases one word shorter; null for words).
    """
    blocks = saved(text_blocks(docs, lang_col, text_col, longest - 1, block_bytes), "blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    entries = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("e")).select("lang", "e.words", "e.counts")
    words = ranked(entries.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("a")).where(F.col("a") >= least), "lang", "word")
    none = F.array().cast("array<bigint>")
    null = F.lit(None).cast("bigint")
    levels = [words.select("id", "lang", F.lit(1).alias("size"), F.array("word").alias("words"), "a", none.alias("pre"), none.alias("suf"),
                           null.alias("left"), null.alias("right"))]
    if longest < 2:
        return levels[0], totals
    entries = blocks.select("block", "lang", F.posexplode("words").alias("place", "word"))
    known = entries.join(words.select("lang", "word", "id"), ["lang", "word"]).select("block", "place", "id")
    seqs = saved(_resolved(blocks.select("block", "seq"), known, _words_to_ids), "words")
    for size in range(2, longest + 1):
        counts = (seqs.mapInArrow(_counted(), PAIRS).groupBy("left", "right").agg(F.sum("c").alias("a")).where(F.col("a") >= least))
        pairs = ranked(counts, "left", "right")
        below = levels[-1]
        one, two = (below.select(*(F.col(c).alias(f"{side}_{c}") for c in ("id", "lang", "words", "a", "pre", "suf"))) for side in "lr")
        levels.append(saved(
            pairs.join(one, F.col("left") == F.col("l_id")).join(two, F.col("right") == F.col("r_id"))
            .select("id", F.col("l_lang").alias("lang"), F.lit(size).alias("size"),
                    F.concat("l_words", F.slice("r_words", -1, 1)).alias("words"), "a",
                    F.concat("l_pre", F.array("l_a")).alias("pre"), F.concat("r_suf", F.array("r_a")).alias("suf"), "left", "right"), "level"))
        if size < longest:
            frequent = docs.sparkSession.sparkContext.broadcast(frequent_map(pairs))
            known = (seqs.mapInArrow(_counted(frequent), PAIRS).join(pairs.select("left", "right", "id"), ["left", "right"])
                     .select("block", "left", "right", "id"))
            seqs = saved(_resolved(seqs, known, _pairs_to_ids), "pairs")
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return phrases, totals


def _score(a: str, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact: products have up to 38 digits."""
    whole = F.col(a).cast("decimal(15,0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * whole * whole
    return F.call_function("div", top, left.cast("decimal(19,0)") * right.cast("decimal(19,0)"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, longest: int = 3, percent: int = 50,
                 top: int = 2000, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `longest` words.

    Phrases occur `least` times within pieces of texts. A phrase scores by the cut into two parts that gives
    the least a * a / (l * r). One that lies in a longer frequent phrase with `percent` of its occurrences is left out;
    since that holds for any size if it holds for one more word, only these are compared. Ties go by a, then
    by the phrase's bytes. A null language is "und"; null and empty texts have no words, repeated rows count as often as they
    stand there; an empty table gives no rows; other columns aren't read. Words of a block are told apart by 64-bit hashes.
    """
    phrases, totals = frequent_phrases(docs, lang_col, text_col, least, longest, block_bytes)
    found = phrases.where("size > 1")
    # The most frequent phrase of one more word around each.
    around = (found.where("size > 2").select((F.col("size") - 1).alias("o_size"), F.explode(F.array("left", "right")).alias("o_id"), "a")
              .groupBy("o_size", "o_id").agg(F.max("a").alias("o_a")))
    kept = (found.join(around, (F.col("id") == F.col("o_id")) & (F.col("size") == F.col("o_size")), "left")
            .where(F.col("o_a").isNull() | (100 * F.col("o_a") < percent * F.col("a"))))
    cuts = [F.when(F.col("size") > k, F.struct(
        _score("a", F.get("pre", F.lit(k - 1)), F.get("suf", (F.col("size") - k - 1).cast("int"))).alias("score"), F.lit(k).alias("k"),
        F.get("pre", F.lit(k - 1)).alias("l"), F.get("suf", (F.col("size") - k - 1).cast("int")).alias("r"))) for k in range(1, longest)]
    cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    scored = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", cut.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, p FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
words AS (SELECT piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
tokens AS (SELECT piece, lang, unnest(ws) AS w1, unnest(range(1, len(ws) + 1)) AS i FROM words),
runs AS (
  SELECT lang, w1, lead(w1) OVER (PARTITION BY piece ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY piece ORDER BY i) AS w3 FROM tokens),
uni AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
total AS (SELECT lang, count(*) AS n FROM runs GROUP BY ALL),
bi AS (SELECT lang, w1, w2, count(*) AS a FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
tri AS (SELECT lang, w1, w2, w3, count(*) AS a FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
around AS (
  SELECT lang, x, y, max(a) AS o FROM (
    SELECT lang, w1 AS x, w2 AS y, a FROM tri UNION ALL SELECT lang, w2, w3, a FROM tri) GROUP BY ALL),
cuts AS (
  SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.a, 1 AS k, u.f AS l, v.f AS r FROM bi b
  JOIN uni u ON u.lang = b.lang AND u.w1 = b.w1 JOIN uni v ON v.lang = b.lang AND v.w1 = b.w2
  LEFT JOIN around o ON o.lang = b.lang AND o.x = b.w1 AND o.y = b.w2 WHERE o.o IS NULL OR 100 * o.o < 50 * b.a
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, u.f, b.a FROM tri t
  JOIN uni u ON u.lang = t.lang AND u.w1 = t.w1 JOIN bi b ON b.lang = t.lang AND b.w1 = t.w2 AND b.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, b.a, u.f FROM tri t
  JOIN bi b ON b.lang = t.lang AND b.w1 = t.w1 AND b.w2 = t.w2 JOIN uni u ON u.lang = t.lang AND u.w1 = t.w3),
scored AS (SELECT *, (1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (l::HUGEINT * r::HUGEINT) AS s FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY s, k) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s DESC, a DESC, phrase) AS rank FROM best)
SELECT top.lang, rank, phrase, a, l, r, n, s::BIGINT AS score FROM top JOIN total ON total.lang = top.lang WHERE rank <= 2000
"""


@query("op12_collocations", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
