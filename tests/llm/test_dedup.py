import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL, rows
from lakeops.llm import embedding_dedup, minhash, suffix_dedup
from lakeops.llm.components import components
from lakeops.llm.hashing import shingles


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(rng, text, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in text.split())


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 200)]
    ring = [(1000 + i, 1000 + (i * 7 + 7) % 49) for i in range(49)] + [(5, 5)]
    links = spark.createDataFrame(chain + star + ring, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(links).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and {got[i] for i in range(100, 300)} == {100}
    assert components(links.limit(0)).count() == 0


def test_shingles_are_five_words_in_lower_case():
    same = [("A b C d E f", "a B c\td\n\ne F"), ("One  two", " one two "), ("É x", "É X")]
    assert all(np.array_equal(shingles(a), shingles(b)) for a, b in same)
    assert not np.array_equal(shingles("É x"), shingles("é x")) and not np.array_equal(shingles("a b"), shingles("ab"))
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a")) == 1 and len(shingles(" \n")) == len(shingles(None)) == 0
    assert len(shingles("x " * 1000)) == 1


@pytest.mark.parametrize("n", [1, 2, 5, 60, 700])
def test_sketches_fill_and_estimate(n):
    rng = np.random.default_rng(n)
    found = []
    for _ in range(60):
        items = rng.integers(0, 2**63, 2 * n, np.uint64)
        a, b = minhash.sketch(np.unique(items[: n + n // 2])), minhash.sketch(np.unique(items[n // 2:]))
        assert a.max() < np.iinfo(np.uint64).max
        found.append((a == b).mean())
    assert abs(np.mean(found) - 0.5) < 0.06  # n items of 2n are in both


def document_cases(rng):
    base = [prose(rng, rng.choice([4, 30, 80, 300])) for _ in range(25)]
    docs = [(i, t) for i, t in enumerate(base)]
    docs += [(100 + i, changed(rng, rng.choice(base), rng.choice([0.0, 0.02, 0.05, 0.06, 0.2]))) for i in range(120)]
    hot = prose(rng, 120)
    docs += [(300 + i, changed(rng, hot, 0.03)) for i in range(60)]  # all near the same text, not all near each other
    docs += [(400, None), (401, ""), (402, " \n\t"), (403, "one"), (404, "ONE"), (405, "long " * 20_000), (406, prose(rng, 20_000))]
    return docs


def test_near_duplicates_against_all_pairs(spark):
    docs = document_cases(random.Random(1))
    frame = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "doc_id long, text string, n int, class string, top string")
    got = {r.doc_id: r for r in minhash.near_duplicates(frame.repartition(5), block_rows=16).collect()}
    for (key, _), (n, least) in zip(docs, brute.near_duplicates(docs)):
        assert (got[key].n_shingles, got[key].component_id, got[key].kept) == (n, least, key == least), key
    kept = minhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_near_duplicates_of_repeated_rows_null_ids_and_nothing(spark):
    rng = random.Random(2)
    a, b = prose(rng, 50), prose(rng, 50)
    docs = [(1, a), (1, a), (1, b), (2, a), (None, a), (None, b), (None, None), (None, None), (3, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(minhash.near_duplicates(frame).select("doc_id", "component_id", "kept")) == rows(spark.createDataFrame(
        [(1, 1, True)] * 3 + [(2, 1, False), (None, 1, False), (None, 1, False), (None, None, True), (None, None, True), (3, 3, True)],
        "a long, b long, c boolean"))
    kept = minhash.drop_near_duplicates(frame)
    assert rows(kept) == rows(spark.createDataFrame([(1, a), (1, b), (None, None), (None, None), (3, "")], kept.schema))
    empty = frame.limit(0)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.drop_near_duplicates(empty).count() == 0


def byte_cases(rng):
    passages = [prose(rng, rng.choice([8, 12, 40])) for _ in range(6)]
    docs = []
    for i in range(150):
        parts = [prose(rng, rng.randrange(0, 12)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        docs.append((rng.randrange(10**6), "".join(parts)))
    docs += [(7, "a" * 300), (8, "a" * 49), (9, "a" * 51), (10, "é" * 80), (11, "x" + "é" * 80), (12, "ab" * 60 + "c"), (13, "b" + "ab" * 60)]
    docs += [(20, None), (21, ""), (22, "\0" * 120), (23, "z" + "\0" * 90), (24, docs[0][1]), (5, docs[1][1])]
    zeros = ["".join(rng.choice("\0\0\0\x01") for _ in range(70)) for _ in range(4)]
    docs += [(1000 + i, rng.choice(zeros)[rng.randrange(15):] + "\0" * rng.randrange(40) + rng.choice(zeros)) for i in range(60)]
    long = prose(rng, 4000)
    return docs + [(30, long), (31, long[:9000] + "!" + long[9000:])]


@pytest.mark.parametrize("sizes", [(10**6, 10**6, 4 << 20, 2048), (40, 50, 3000, 2048), (40, 50, 3000, 5)])
def test_repeats_against_a_dictionary_of_strings(spark, monkeypatch, sizes):
    for name, value in zip(("RANGE_SUFFIXES", "BUCKET_TOKENS", "FLUSH_BYTES", "DIRECT"), sizes):
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = byte_cases(random.Random(3))
    frame = spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id long, text string, doc int, packed string").repartition(6)
    got = {(r.doc_id, r.n_bytes, tuple((s.begin, s.end) for s in r.spans), bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame).collect()}
    assert got == {(key, n, tuple(spans), kept) for (key, _), (n, spans, kept) in zip(docs, brute.removed(docs))}


def test_few_long_documents_are_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_SUFFIXES", 400)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 300)
    cuts, suffixes = [], suffix_dedup._suffixes
    monkeypatch.setattr(suffix_dedup, "_suffixes", lambda splitters: cuts.append(splitters) or suffixes(splitters))
    rng = random.Random(9)
    text = prose(rng, 8000)
    docs = [(i, text[:9000 * i] + prose(rng, 20) + text[9000 * i:]) for i in range(1, 4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, tuple((s.begin, s.end) for s in r.spans), bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame).collect()}
    assert got == {(key, tuple(spans), kept) for (key, _), (_, spans, kept) in zip(docs, brute.removed(docs))}
    assert len(set(cuts[-1])) > 10


def test_drawn_suffixes_are_those_that_are_cut(spark):
    rng = random.Random(10)
    for text in (prose(rng, 300), "ab" * 60 + "c", "a" * 300, "\0" * 120, "é" * 80):
        data = np.frombuffer(text.encode(), np.uint8)
        place, _, last, _ = suffix_dedup.tokens(data)
        batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([[np.unique(place).astype("<u4").tobytes()]])], names=["text", "lists"])
        (out,) = suffix_dedup._drawn([batch])
        assert sorted(out.column(0).to_pylist()) == sorted(data.tobytes()[a:b + suffix_dedup.LENGTH] for a, b in zip(place, last))


def test_repeats_in_sections_null_ids_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SECTION", 256)
    rng = random.Random(4)
    a, b = prose(rng, 200), prose(rng, 30)
    docs = [(1, a), (1, a), (1, a[:400]), (2, a[300:700]), (None, a), (None, b), (None, b), (3, b + a[100:200])]
    frame = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, row long")
    got = {r.row.row: r for r in suffix_dedup.remove_repeats(frame, carry=True).collect()}
    for i, (n, spans, kept) in enumerate(brute.removed(docs)):
        assert (got[i].n_bytes, [(s.begin, s.end) for s in got[i].spans], bytes(got[i].kept)) == (n, spans, kept), i
    cleaned = suffix_dedup.without_repeats(frame)
    assert cleaned.columns == frame.columns and cleaned.where("row = 4").first().text == ""
    assert suffix_dedup.remove_repeats(frame.limit(0)).count() == 0


def test_cut_characters_are_dropped_from_the_text(spark):
    # The 50th byte of the shared stretch lies inside a character.
    docs = spark.createDataFrame([(1, "é" * 40 + "a"), (2, "xè" + "é" * 40 + "b")], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    assert texts[1] == "é" * 40 + "a" and texts[2].strip("xèéb") == ""


@pytest.mark.parametrize("cells", [1024, 3])
def test_vectors_against_all_pairs(spark, monkeypatch, cells):
    monkeypatch.setattr(embedding_dedup, "MAX_CELLS", cells)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    data = []
    for i in range(300):
        v = base[i % 40] + rng.normal(size=16) * rng.choice([0, 0.05, 0.15, 0.2])
        data.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    hot = base[0] / np.linalg.norm(base[0])
    data += [(400 + i, [float(x) for x in hot + rng.normal(size=16) * 0.02], 1) for i in range(80)]
    data += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [float("nan")] + [1.0] * 15, 1), (504, [None] + [1.0] * 15, 1),
             (505, [1.0] * 8, 1), (506, [2.0] * 8, 1), (507, [1.0] * 8, None), (508, [float("inf")] + [1.0] * 15, 1), (509, [1e200] * 8, 1)]
    frame = spark.createDataFrame([(*d, 1, "c") for d in data], "vec_id long, embedding array<double>, label int, n int, cell string")
    for block in (1024, 32):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
               embedding_dedup.near_vectors(frame, cell_rows=50 if cells > 3 else 10, block_rows=block).collect()}
        for (key, *_), (links, least) in zip(data, brute.vector_links(data)):
            assert got[key] == (links, least, key == least), key


def test_vectors_that_repeat_and_none_at_all(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)],
                                  "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_vectors(frame)
    assert rows(got.select("vec_id", "n_links", "component_id")) == [(None, 0, None), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_queries_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    assert [tuple(r) for r in minhash.op1(spark, SF_SMALL).orderBy("doc_id").collect()] == [
        (k, n, least, k == least) for (k, _), (n, least) in zip(docs, brute.near_duplicates(docs))]
    assert [tuple(r) for r in suffix_dedup.op5(spark, SF_SMALL).orderBy("doc_id").collect()] == [
        (k, n, sum(b - a for a, b in spans), len(spans), brute.sha(kept)) for (k, _), (n, spans, kept) in zip(docs, brute.removed(docs))]
    data = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    assert [tuple(r) for r in embedding_dedup.op9(spark, SF_SMALL).orderBy("vec_id").collect()] == [
        (k, links, least, k == least) for (k, *_), (links, least) in zip(data, brute.vector_links(data))]


@pytest.mark.parametrize("small", [1, 5, 2048])
def test_multikey_quicksort_is_a_stable_sort_by_words(monkeypatch, small):
    monkeypatch.setattr(suffix_dedup, "SMALL", small)
    rng = np.random.default_rng(4)
    for words, high in ((1, 3), (3, 2), (7, 2**63)):
        rows = rng.integers(0, high, (3000, words)).astype(">u8")
        assert suffix_dedup.multikey_sort(rows).tolist() == np.lexsort(rows.T[::-1]).tolist()
    assert suffix_dedup.multikey_sort(np.zeros((0, 2), ">u8")).tolist() == []


def test_rows_dealt_follow_the_text_however_many_buckets():
    rng = random.Random(6)
    texts = [prose(rng, 3000) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(range(40), pa.int64()), pa.array(texts)], ["doc", "text_hash", "text"])
    dealt = {}
    for buckets in (64, 4096, 125_000):
        groups = buckets if buckets <= suffix_dedup.DIRECT else int(buckets ** 0.5) + 1
        out = list(suffix_dedup._deal_tokens(buckets, groups)(iter([batch])))
        dealt[buckets] = sum(b.num_rows for b in out)
        again = list(suffix_dedup._deal_again(buckets, groups)(iter(out))) if groups < buckets else out
        assert sum(len(suffix_dedup._unpacked_tokens([t], "<u4")[3]) for b in again for t in b.column(1).to_pylist()) > 10_000
    assert dealt[64] == 64 and dealt[4096] <= 65 and dealt[125_000] <= 354


def test_repeats_with_clashing_columns_leave_the_same_row_each_time(spark):
    text = prose(random.Random(9), 60)
    docs = [(1, text, k, "r", "t") for k in range(20)] + [(2, text, 0, "r", "t")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _repeated int, _repeated_text string, copies string")
    kept = {tuple(minhash.drop_near_duplicates(frame.repartition(n)).first()) for n in (1, 3, 7)}
    assert len(kept) == 1 and minhash.drop_near_duplicates(frame).columns == frame.columns


def test_common_counts_are_those_of_sets():
    rng = np.random.default_rng(7)
    sets = [[np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(n)] for n in (9, 5)]
    want = [[len(np.intersect1d(a, b)) for b in sets[1]] for a in sets[0]]
    for width in (1, 7, 4096):
        assert minhash.common_counts(*sets, width).tolist() == want
    assert minhash.common_counts([], sets[1]).shape == (0, 5)


@pytest.mark.parametrize("whole", [100_000, 300])
def test_variants_below_the_threshold_are_compared_in_blocks(spark, monkeypatch, whole):
    """Variants of one text that lie just below or above 0.75 from each other."""
    monkeypatch.setattr(minhash, "WHOLE", whole)
    rng = random.Random(10)
    base = prose(rng, 400).split()
    docs = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice([5, 6, 11, 12, 13])):
            words[at] = f"w{i}x{at}"
        docs.append((i, " ".join(words)))
    tested = []
    plain = minhash._Search.test

    def counting(self, pairs):
        tested.append(pairs.select("a", "b").distinct().count())
        plain(self, pairs)

    monkeypatch.setattr(minhash._Search, "test", counting)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), block_rows=32).collect()}
    assert [got[k] for k, _ in docs] == brute.near_duplicates(docs)
    if whole > 400:
        assert sum(tested) < 10 * len(docs)


def test_cells_grow_beyond_the_first_level(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MAX_CELLS", 4)
    units = np.random.default_rng(1).normal(size=(2000, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    cells = embedding_dedup.fit_cells(units, 40)
    assert len(cells.centers) == 4 and 30 <= sum(map(len, cells.parts)) <= 40
    lives = [(r, c) for r, c, home, inner in embedding_dedup.dealt_to(units, cells, 0.02) if home and inner]
    assert [r for r, _ in sorted(lives)] == list(range(2000)) and len({c for _, c in lives}) >= 30
