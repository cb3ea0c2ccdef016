import os
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from lakeops.llm import tokens
from lakeops.llm.packing import ALONE, closest_fill, op3, pack_documents, pack_lengths
from lakeops.llm.token_output import BLOCK, Segment, op2, read_tokens, write_segment, write_tokens
from lakeops.llm.tokens import Encoder, vocabulary

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD = ["", " ", "a", "  two  spaces\n\n\nlines \t end ", "x  y  z　", "it's I'LL don't 12 345 ...  !", "<|endoftext|> a <|startoftext|>",
       "é ́x İ ΑΣ ΑΣ. \U0001f600‍", "a\x1c b\x85c", "日本語 テキスト 한국어", "᠎ x", "a\x00b"]


def plain(path, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]


@pytest.mark.parametrize("path,end", [(BYTE, 0), (WORD, 2)])
def test_units_encode_as_whole_texts(path, end):
    encoder, want = Encoder(path, end), plain(path, end)
    texts = [*ODD, None, " ".join(ODD), "word " * 3000]
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)] == [want(t) for t in texts]

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n'sdre ́")), max_size=40))
    def agrees(text):
        assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == want(text)

    agrees()


@pytest.mark.parametrize("top", [0, 1, 255, 50_257, 2**32 - 1])
def test_segments_round_trip(top):
    rng = np.random.default_rng(top)
    docs = [rng.integers(0, top, n, np.uint32, endpoint=True) for n in (0, 1, BLOCK, 5 * BLOCK + 7, 3)]
    docs.append(np.where(np.arange(3 * BLOCK) % 50 == 0, top, 5).astype(np.uint32))
    segment = Segment(write_segment([1, None, 3, 4, -5, 6], docs, 17))
    whole = np.concatenate(docs)
    assert segment.start == 17 and np.array_equal(segment.ids(0, segment.n_ids), whole)
    for a, b in ((0, 1), (BLOCK - 1, BLOCK + 1), (1500, 4000), (len(whole) - 1, len(whole)), (5, 5)):
        assert np.array_equal(segment.ids(a, b), whole[a:b])


def docs_of(spark, extra=()):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(7, "seven"), (7, "seven"), (None, "no id"), (None, None), (90, None), (91, "long text " * 9000)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, ids string, shard int")


def test_written_tokens_are_those_of_the_texts(spark, tmp_path):
    docs, want = docs_of(spark), plain(BYTE, 0)
    write_tokens(docs, str(tmp_path / "t"), BYTE, 0, shard_rows=5)
    got = sorted(read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [want(t) for _, t in rows]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]


def test_empty_tables(spark, tmp_path):
    empty = docs_of(spark).limit(0)
    write_tokens(empty, str(tmp_path / "t"), BYTE, 0)
    assert read_tokens(spark, str(tmp_path / "t")).count() == 0
    assert pack_documents(empty, WORD, 2).count() == 0


def test_op2_on_the_small_table(spark):
    want, start = [], 0
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(plain(BYTE, 0)(r.text) if r.text else [0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in op2(spark, SF_SMALL).collect()) == want


def test_queries_give_the_ids_of_the_default_call(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a <|endoftext|> b", "x<|startoftext|><|endoftext|>\n c", "plain <| text |>", None])],
                                 "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for query, path, end in ((op2, BYTE, 0), (op3, WORD, 2)):
        tokenizer = Tokenizer.from_file(path)
        want = {k: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, end], "<u4") for k, t in texts.items()}
        got = {r.doc_id: (r["n_tokens" if query is op2 else "length"], r.ids_crc32) for r in query(spark, str(tmp_path)).collect()}
        assert got == {k: (len(x), zlib.crc32(x.tobytes())) for k, x in want.items()}


def check_pieces(pieces, lengths, capacity, slack=64):
    """Each id in one piece; sequences gapless. Returns the share of padding."""
    spans, rows = defaultdict(list), defaultdict(list)
    for doc, start, length, seq, offset in pieces:
        spans[doc].append((start, length))
        rows[seq].append((offset, length))
    assert {d: sum(n for _, n in s) for d, s in spans.items()} == lengths
    for s in (*spans.values(), *rows.values()):
        at = 0
        for start, length in sorted(s):
            assert start == at and length > 0
            at += length
    fills = [sum(n for _, n in s) for s in rows.values()]
    assert max(fills) <= capacity
    padding = sum(0 if f & (f - 1) == 0 else capacity - f for f in fills)
    return padding / max(1, sum(fills))


def test_closest_fill_is_the_best_subset():
    rng = random.Random(5)
    for _ in range(200):
        counts = Counter(rng.choices(range(1, 30), k=rng.randint(0, 8)))
        capacity = rng.randint(0, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + j * length for s in sums for j in range(n + 1)}
        picked = closest_fill(sorted(counts), counts, capacity)
        assert sum(k * n for k, n in picked.items()) == max(s for s in sums if s <= capacity)
        assert all(n <= counts[k] for k, n in picked.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=60))
def test_packing_keeps_every_id(lengths):
    pieces = [(d, s, n, q, o) for q, seq in enumerate(pack_lengths(lengths, 256))
              for (d, s, n), o in zip(seq, np.cumsum([0] + [p[2] for p in seq]))]
    if lengths:
        check_pieces(pieces, dict(enumerate(lengths)), 256)


def test_packed_documents(spark):
    docs, want = docs_of(spark).where("doc_id is not null").dropDuplicates(["doc_id"]), plain(WORD, 2)
    texts = {r.doc_id: want(r.text) for r in docs.collect()}
    out = pack_documents(docs, WORD, 2, capacity=64, group_rows=4).collect()
    check_pieces([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in out], {d: len(t) for d, t in texts.items()}, 64)
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == texts[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(texts[r.doc_id])
    everything = docs_of(spark)
    total = sum(len(want(r.text)) for r in everything.collect())
    assert pack_documents(everything, WORD, 2).agg(F.sum("length")).first()[0] == total


def test_groups_of_long_documents_are_bounded_by_bytes(spark):
    docs = spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(
        F.lit(" word and more"), 10_000)).alias("text"))
    out = pack_documents(docs, WORD, 2, group_bytes=4 << 20).select("doc_id", "start", "length", "sequence_id", "offset", "doc_tokens").collect()
    # Whole windows stay with the task that encodes them; groups hold rests, four bytes an id.
    held = Counter()
    for r in out:
        if r.sequence_id < ALONE:
            held[r.sequence_id >> 32] += r.length
        else:
            assert r.length == 4096 and r.offset == 0
    assert len(held) == 2 and max(held.values()) * 4 <= 4 << 20
    check_pieces([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in out], {r.doc_id: r.doc_tokens for r in out}, 4096)


def test_op3_pads_little(spark):
    out = op3(spark, SF_SMALL).collect()
    docs = {r.doc_id: r.doc_tokens for r in out}
    assert len(docs) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert check_pieces([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in out], docs, 4096) < 0.002


def test_equal_rows_and_null_ids_are_spread(spark, tmp_path):
    docs = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same few words").alias("text"))
    ids = plain(WORD, 2)("the same few words")
    out = pack_documents(docs, WORD, 2)
    groups = out.groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(F.sum("length").alias("n")).collect()
    assert len(groups) == 4 and max(r.n for r in groups) < 0.3 * 30_000 * len(ids)
    write_tokens(docs, str(tmp_path / "t"), BYTE, 0, shard_rows=5000)
    shards = spark.read.parquet(str(tmp_path / "t")).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    assert len(shards) == 6 and max(r.n for r in shards) < 2 * min(r.n for r in shards)
    assert read_tokens(spark, str(tmp_path / "t")).agg(F.count("ids"), F.count_distinct("start")).first() == (30_000, 30_000)


@pytest.mark.parametrize("path,end", [(BYTE, 0), (WORD, 2)])
def test_long_texts_are_encoded_in_parts(monkeypatch, path, end):
    encoder, want = Encoder(path, end), plain(path, end)
    monkeypatch.setattr(tokens, "PART_CHARS", 40)
    rng = random.Random(8)
    for _ in range(40):
        text = "".join(rng.choice(["a", "Bc", " ", " ", "7", "  ", ".", "é", "\u00a0", "\u3000", "'s", "\n", "日", "<|endoftext|>"]) for _ in range(300))
        assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == want(text)
    added = Encoder(path, end, added_ids=True)
    whole = Tokenizer.from_file(path).encode("x y <|endoftext|> z w " * 30, add_special_tokens=False).ids
    assert np.frombuffer(added.encode(["x y <|endoftext|> z w " * 30])[0], added.dtype).tolist() == [*whole, end]


def peak_mb(code):
    """MB that a process needs on top of its imports."""
    head = ("import resource\nfrom lakeops.llm import hashing, classifier, tokens\nimport random\nrng = random.Random(1)\n"
            "words = [''.join(rng.choices('abcdefghijklmnop', k=rng.randrange(1, 9))) for _ in range(200_000)]\n"
            "text = ' '.join(words * 50)\nassert len(text) > 50_000_000\n"
            "peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024\n")
    out = subprocess.run([sys.executable, "-c", head + "before = peak()\n" + code + "\nprint(peak() - before)"], capture_output=True, text=True, check=True,
                         cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    return float(out.stdout.split()[-1])


@pytest.mark.parametrize("code", ["hashing.shingles(text)", "classifier.features(text)",
                                  f"tokens.Encoder('{WORD}', 2).encode([text])", f"tokens.Encoder('{BYTE}', 0).encode([text])"])
def test_texts_of_50_mb_take_bounded_memory(code):
    assert peak_mb(code) < 400
