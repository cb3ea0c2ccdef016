import hashlib
import heapq
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL, rows
from lakeops.llm import mixing, warc


def docs_of(spark):
    rng = random.Random(6)
    docs = [(i, f"s{min(int(rng.expovariate(0.6)), 6)}", " ".join(["w"] * rng.choice([1, 5, 20, 200]))) for i in range(900)]
    docs += [(2000, None, "a b"), (2001, None, None), (2002, "empty", ""), (2003, "S", "x " * 3000), (None, "s0", "a b c"), (2004, "é", "a")]
    return spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, source string, text string, size int, key double")


def test_targets_by_repeated_resharing(spark):
    rng = random.Random(7)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 10, 500, 10_000]) for s in (None, "b", "a", "B", "é", "z", "aa")}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(frame, (5, 2, 1), 1.5, 2.0).collect()}
        assert got == {s: pytest.approx(t, abs=1e-6) for s, t in brute.targets(sizes).items()}


@pytest.mark.parametrize("slice_rows", [100_000, 40])
def test_a_mix_comes_near_its_targets(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(mixing.mix_plan, "__defaults__", (slice_rows,))
    docs = docs_of(spark)
    out = mixing.mixed(docs).collect()
    assert len(out) == docs.count()
    sizes = defaultdict(int)
    for r in out:
        sizes[r.source] += r.size
        assert r.size == len(brute.words({d.doc_id: d.text for d in docs.collect()}[r.id])) if r.id and r.id < 3 else True
    want = brute.targets(sizes)
    for source in sizes:
        mine = [r for r in out if r.source == source]
        assert {round(r.target, 6) for r in mine} == {round(want[source], 6)} and {r.source_size for r in mine} == {sizes[source]}
        taken, largest = sum(r.size * r.times for r in mine), max(r.size for r in mine)
        assert abs(taken - want[source]) <= largest / 2 + 1e-6 and all(r.times <= 2 for r in mine if r.size)
    assert rows(mixing.mixed(docs.repartition(5))) == rows(mixing.mixed(docs))
    copies = Counter(r.doc_id for r in mixing.mixture(docs).collect())
    assert copies == Counter({r.id: r.times for r in out if r.times}) and mixing.mixture(docs).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0


def test_heavier_documents_come_sooner(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("w w").alias("text"))
    quality = F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    out = mixing.mixed(docs, quality=quality, share=0.3).where("times > 0")
    even = out.where("id % 2 = 0").count()
    assert 1190 <= out.count() <= 1210 and 0.66 < even / out.count() < 0.78  # 3/4 at first, less as they run out


def test_loser_tree_merges_like_a_heap():
    rng = random.Random(8)
    for k in range(7):
        runs = [sorted((rng.randrange(20), i, j) for j in range(rng.randrange(30))) for i in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x[0])) == list(heapq.merge(*runs, key=lambda x: x[0]))


PAGES = [(1, "http://a.com/x?b", "<p>" + "long " * 40), (2, "http://A.com/x#f", "<p>" + "long " * 40), (3, "http://b.a.com/", "short"),
         (4, "http://b.a.com/", "short"), (5, None, None), (6, "no scheme", ""), (7, "http://c.com/\r\nWARC-Type: fake", "é" * 60),
         (8, "http://c.com/", "body\r\n\r\nWARC/1.1\r\n\r\n" * 30), (9, "http://c.com/", "x" * 400_000), (0, "http://z.com", "é" * 60),
         (2, "http://A.com/x#f", "<p>" + "long " * 40), (1, "http://again.com/", "<p>" + "long " * 40), (None, "http://n.com", "é" * 60)]


def test_archives_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(*p, "d") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    date = F.timestamp_seconds(F.lit(1_700_000_000) - F.coalesce("page_id", F.lit(0)))
    path, runs = str(tmp_path / "warc"), str(tmp_path / "runs")
    warc.write_archives(frame, path, date, records_per_file=2)
    warc.index_runs(spark, path).write.parquet(runs)
    merged = warc.merge_runs(spark.read.parquet(runs), range_rows=3, batch_rows=2)
    got = merged.collect()
    first = {}
    for key, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        if len((html or "").encode()) >= 100:
            first.setdefault(html, key)
    want = Counter()
    for key, _, html in PAGES:
        data = (html or "").encode()
        leads = first.get(html, key)
        want[(key, len(data), hashlib.sha256(data).hexdigest(), "response" if leads == key else "revisit", None if leads == key else leads)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    order = [(r.url_key, r.timestamp, -1 if r.page_id is None else r.page_id) for r in got]
    assert order == sorted(order) and order[-1][0] == "no scheme"
    # An index line finds its record by file, offset and length.
    files = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    for r in got:
        (fields, _, _, block), = warc.parse_records(files[r.run][r.offset:r.offset + r.length])
        assert fields["warc-type"] == r.record_type and len(block) >= (r.payload_bytes if r.record_type == "response" else 0)


def test_archives_of_large_pages_are_bounded_by_bytes(spark, tmp_path):
    html = F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), F.when(
        F.col("id") % 100 == 7, 3_000_000).when(F.col("id") % 3 == 0, 10).otherwise(120_000)))
    pages = spark.range(0, 900, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://a.com/").alias("url"), html.alias("html"))
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, F.timestamp_seconds(F.col("page_id")))
    sizes = [f.stat().st_size for f in (tmp_path / "warc").glob("part-*")]
    assert max(sizes) <= 64 << 20 < sum(sizes) and len(sizes) < 10
    lines = warc.index_runs(spark, path).select("page_id", "payload_bytes").collect()
    assert {r.page_id for r in lines} == set(range(900)) and len(lines) == 900
    assert sum(r.payload_bytes for r in lines) == pages.agg(F.sum(F.octet_length("html"))).first()[0]


def test_no_pages_make_no_records(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, str(tmp_path / "w"), F.current_timestamp())
    assert warc.index_runs(spark, str(tmp_path / "w")).count() == 0
    empty = spark.createDataFrame([], warc.INDEX)
    assert warc.merge_runs(empty).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from lakeops.llm import classifier, minhash, packing, suffix_dedup

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = classifier.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    stages = dict(pipeline.STAGES)
    pairs = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    good = stages["quality_classifier"](spark, docs, SF_SMALL)
    assert pairs(good) == [(k, t) for k, t in pairs(docs) if model.score(t) >= classifier.CUT] and good.schema == docs.schema
    distinct = stages["minhash_dedup"](spark, good, SF_SMALL)
    held = pairs(good)
    assert pairs(distinct) == [(k, t) for (k, t), (_, least) in zip(held, brute.near_duplicates(held)) if k == least]
    unique = stages["suffix_dedup"](spark, distinct, SF_SMALL)
    held = pairs(distinct)
    assert pairs(unique) == [(k, kept.decode("utf-8", "ignore")) for (k, _), (_, _, kept) in zip(held, brute.removed(held))]
    assert unique.columns == docs.columns and unique.where("n_chars <> length(text)").count() == 0
    mixed = stages["mixing"](spark, unique, SF_SMALL)
    taken = {r.id: r.times for r in mixing.mixed(unique).collect()}
    assert Counter(k for k, _ in pairs(mixed)) == Counter({k: n for k, n in taken.items() if n}) and mixed.columns == docs.columns
    packed = stages["packing"](spark, mixed, SF_SMALL)
    want = packing.packed_digests(mixed)
    assert rows(packed) == rows(want) and rows(pipeline.run(spark, SF_SMALL)) == rows(want)


def test_the_weight_reads_the_column_it_is_given(spark):
    docs = docs_of(spark).limit(50)
    body = docs.select("doc_id", "source", F.col("text").alias("body"))
    want = rows(mixing.mixture(docs.select("doc_id", "source", "text")))
    assert rows(mixing.mixture(body, text_col="body")) == want
