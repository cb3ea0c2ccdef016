"""Each stage of the corpus pipeline on odd rows, and the whole against plain steps."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL, rows
from lakeops.llm.tokens import Encoder, vocabulary

STAGES = dict(corpus_pipeline.STAGES)
EXTRA = "id int, row string, text_hash string, size int, copies string, top string, n int, `window` string, part int, label int"


def prose(rng, n):
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(900)}" for _ in range(n)) + "."


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null, empty, blank and long texts, ties, copies, null sources, and columns with names that stages use."""
    rng = random.Random(12)
    plain = [(i, prose(rng, 60), "en", f"s{i % 3}") for i in range(40)]
    odd = [(None, None, None, None), (None, prose(rng, 30), None, None), (50, None, "en", "s0"), (51, "", "en", "s1"), (52, " \n", "de", None),
           (53, prose(rng, 150_000), "en", "s2"), (54, "x" * 300_000, "en", "s2"), (55, "é\x00😀 " * 40, "fr", "")]
    copies = [plain[0], plain[0], (60, plain[1][1], "en", "s0"), (60, plain[2][1], "en", "s0"), (61, plain[3][1] + " more", "en", "s9")]
    data = [(*d, len(d[1]) if d[1] is not None else None, 1, "r", "t", 2, "c", "p", 3, "w", 4, 5) for d in (*plain, *odd, *copies)]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    return spark.createDataFrame(data, schema).repartition(5).cache()


def same_columns(out, docs):
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]


def test_the_classifier_keeps_rows_as_they_are(spark, odd):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    both = documents.unionByName(odd, allowMissingColumns=True)
    out = STAGES["quality_classifier"](spark, both, SF_SMALL)
    same_columns(out, both)
    kept = out.where("id IS NOT NULL")
    assert kept.exceptAll(odd.select(*kept.columns)).count() == 0 and out.where("id IS NULL").count() > 50
    # The same rows on every run, and repeats alike.
    assert rows(kept.select("doc_id", F.xxhash64("text"))) == rows(
        STAGES["quality_classifier"](spark, both.repartition(3), SF_SMALL).where("id IS NOT NULL").select("doc_id", F.xxhash64("text")))


def test_near_duplicates_leave_one_of_each_group(spark, odd):
    out = STAGES["minhash_dedup"](spark, odd, SF_SMALL)
    same_columns(out, odd)
    # Without words nothing is a copy: 50, 51, 52 and the row without anything stay; of equal or near texts the least id does.
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in out.select("doc_id").collect()) == [
        (False, 0), (False, 0), *((True, i) for i in (*range(40), *range(50, 56)))]


def test_passages_go_and_the_length_follows(spark, odd):
    out = STAGES["suffix_dedup"](spark, odd, SF_SMALL)
    same_columns(out, odd)
    assert out.count() == odd.count()
    got = {(r.doc_id, r.text) for r in out.where("doc_id IN (0, 1, 50, 51, 52, 55, 60)").collect()}
    first = {r.doc_id: r.text for r in odd.where("doc_id < 3").collect()}
    assert (50, "") in got and (51, "") in got and (52, " \n") in got and (0, first[0]) in got and (60, "") in got
    assert out.where("n_chars <> length(text)").count() == 0


def test_the_mix_repeats_whole_rows(spark, odd):
    out = STAGES["mixing"](spark, odd, SF_SMALL)
    same_columns(out, odd)
    assert out.exceptAll(odd.unionAll(odd).unionAll(odd)).count() == 0  # no document is taken more than three times
    assert out.count() > 0
    assert rows(out.select("doc_id", F.xxhash64("text"))) == rows(STAGES["mixing"](spark, odd.repartition(2), SF_SMALL).select("doc_id", F.xxhash64("text")))


def test_packing_keeps_every_token(spark, odd):
    out = STAGES["packing"](spark, odd, SF_SMALL)
    encoder = Encoder(vocabulary("word_bpe_49k.json"), 2, added_ids=True)
    want = sum(len(x) for x in encoder.encode([r.text for r in odd.select("text").collect()])) // 2
    assert out.agg(F.sum("length")).first()[0] == want
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, odd, name):
    out = STAGES[name](spark, odd.limit(0), SF_SMALL)
    assert out.count() == 0
    if name != "packing":
        same_columns(out, odd)


def test_stages_follow_the_contract():
    assert list(STAGES) == ["quality_classifier", "minhash_dedup", "suffix_dedup", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and all("null" in f.__doc__.lower() for f in STAGES.values())
