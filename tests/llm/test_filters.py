import numpy as np
import pytest
from pyspark.sql import functions as F

from check import connect, rows_of
from conftest import SF, SF_SMALL, rows
from lakeops.llm import classifier, quality_rules, url_filter
from lakeops.llm.queries import ORACLES, QUERIES

WITH_SQL = sorted(ORACLES)


@pytest.mark.parametrize("name", WITH_SQL)
def test_queries_match_their_sql(spark, name):
    con = connect(SF)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op4_url_filter", "op8_quality_rules"])
def test_native_queries_run_no_python_and_join_nothing(spark, name):
    plan = plans(QUERIES[name](spark, SF_SMALL))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Join"))


URLS = ["http://example.net/en/1", "HTTPS://Sub.Example.NET/en/", "http://example.net/EN/1", "https://a.net", "http://net/x?y://z/",
        "http://notnet/x", "http://example.com/de/", "http://www.example.com/de", "http://x.org/fr/?a", "http://org/fr/", "ftp://org#/fr/",
        "http://u@h.org:80/fr/", "example.net/en/", "://net/", "http://", "", None, "http://a\nb.net/\nx", "http://.net/", "x" * 100_000 + "://net/"]
RULES = (("net/", "example.com/de/"), ("example.net/en/", "org/fr/"))


def judged(url, block, allow):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    found = []
    for verdict, listed in (("block", block), ("allow", allow)):
        for rule in listed:
            h, p = url_filter.split_rule(rule)
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                found.append((len(rule), h.count("."), rule, verdict))
    best = max(found, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_against_plain_matching(spark):
    frame = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, None, "", ""), (0, URLS[0], "h", "r")],
                                  "page_id long, url string, host string, rule string")
    got = rows(url_filter.judge_urls(frame, "page_id", "url", *RULES))
    want = [(i, *judged(u, *RULES)) for i, u in enumerate(URLS)] + [(None, *judged(None, *RULES)), (0, *judged(URLS[0], *RULES))]
    assert got == rows(spark.createDataFrame(want, "a long, b string, c string, d string, e string"))
    assert url_filter.judge_urls(frame.limit(0), "page_id", "url", *RULES).count() == 0
    assert url_filter.judge_urls(frame, "page_id", "url", (), ()).where("rule IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        url_filter.judge_urls(frame, "page_id", "url", ("net/",), ("net/",))


def test_cascades_answer_exactly_for_every_key(spark):
    universe = spark.range(3000).select(F.concat(F.lit("host"), F.col("id"), F.lit("/")).alias("key"))
    listed = universe.where(F.xxhash64("key") % 7 == 0)
    for first in ((2, 1), (12, 6)):  # a poor first level needs many more
        cascade = url_filter.build_cascade(listed, universe, first)
        assert len(cascade.levels) >= (3 if first == (2, 1) else 1)
        said = universe.select("key", cascade.contains(F.col("key")).alias("is"))
        assert rows(said.where("is").select("key")) == rows(listed)


def measure(text):
    words = __import__("brute").words(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if __import__("brute").words(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(lines), len(again))


TEXTS = [None, "", " \n\t", "one", "a b c d e f g h " * 3, "a b c d e f g h i j " * 2, "x " * 40, "line\nline\n\nline two\n line\nline",
         "# * $ % & | < >", "é\u00a0ü x\u2003y", "a\x0bb\x0cc\rd", " ".join(map(str, range(30))) + " " + " ".join(map(str, range(30)))]


def test_quality_measures_against_plain_counting(spark):
    frame = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(TEXTS)] + [(None, None, 1, "y")], "doc_id long, text string, n_words int, words string")
    book = quality_rules.ledger(frame)
    got = {r.doc_id: tuple(r[m] for m in quality_rules.MEASURES) for r in book.collect()}
    assert got == {**{i: measure(t) for i, t in enumerate(TEXTS)}, None: measure(None)}
    assert quality_rules.ledger(frame.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "some words " * 60_000)], "doc_id long, text string")
    assert quality_rules.ledger(long).first().n_repeat_words == 120_000


def test_policies_and_ablations_need_the_ledger_only(spark):
    book = spark.createDataFrame([(0,), (1,), (3,), (2,), (4,), (6,)], "failures long")
    assert [r.rejected for r in book.select(quality_rules.rejected("v1").alias("rejected")).collect()] == [False, True, True, True, False, True]
    out = {r.rule: (r.failed, r.only_this) for r in quality_rules.ablation(book, "v2").collect()}
    assert out["few_words"] == (2, 1) and out["repeated_words"] == (3, 1) and out["symbols"] == (2, 1) and out["long_words"] == (0, 0)


def test_dual_coordinate_descent_reaches_the_optimum():
    # Two features, separable: the widest margin lies between the nearest points.
    rows_, y = [np.array([0], np.uint32), np.array([1], np.uint32)] * 5, np.array([1, 0] * 5)
    values = [np.array([1.0])] * 10
    w, bias = classifier.dual_coordinate_descent(rows_, values, y, np.full(10, 1e6), epochs=500)
    assert w[0] == pytest.approx(1, abs=1e-2) and w[1] == pytest.approx(-1, abs=1e-2) and abs(bias) < 1e-2


def test_classifier_is_right_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, SF).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 50 and sum(q == r.predicted for q, r in held) / len(held) >= 0.97
    assert all(r.predicted == 1 for q, r in held if q == 1)
    # Labels that are held out aren't learned from: flipping them changes nothing.
    flipped = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    model, other = classifier.train(docs, labels), classifier.train(docs, flipped)
    assert np.array_equal(model.weights, other.weights) and model.offset == other.offset


def test_classifier_on_odd_rows(spark):
    good, bad = "plain words in a row that say something. " * 5, "bad$$$ words%%% here### all&&& the*** time$$$ " * 5
    docs = spark.createDataFrame([(i, good if i % 2 else bad, i, "s") for i in range(60)] + [(None, good, 1, "s"), (100, None, 1, "s"), (101, "", 1, "s"),
                                 (102, good * 5000, 1, "s"), (103, good, 1, "s"), (103, good, 1, "s")], "doc_id long, text string, score int, label string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, 0, 0), (None, 1, 0), (3, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    model = classifier.train(docs, labels)
    out = classifier.score_quality(docs, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 66
    got = {r.doc_id: r.score for r in out.collect()}
    assert got[100] == got[101] and got[102] > 0.5 > got[0] and all(0 <= s <= 1 for s in got.values())
    kept = classifier.keep_good(docs, model)
    assert kept.schema == docs.schema and kept.where("doc_id < 60").count() == 30
    assert classifier.score_quality(docs.limit(0), model).count() == 0
    nothing = classifier.train(docs.limit(0), labels.limit(0))
    assert classifier.score_quality(docs, nothing).where("score <> 0.5").count() == 0


def test_levels_stay_small_whatever_the_corpus_holds(spark, monkeypatch):
    """A level that would be too large gets a stronger one before it; too many listed keys raise."""
    monkeypatch.setattr(url_filter, "MAX_LEVEL_BYTES", 128)
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.where("key IN ('k1', 'k77', 'k19999')")
    cascade = url_filter.build_cascade(listed, universe, (4, 1), (2, 1))
    assert all(8 * len(level.words) <= 128 for level in cascade.levels) and cascade.levels[0].hashes > 1
    said = universe.select("key", cascade.contains(F.col("key")).alias("is"))
    assert sorted(r.key for r in said.where("is").collect()) == ["k1", "k19999", "k77"]
    with pytest.raises(url_filter.LevelTooLarge):
        url_filter.build_cascade(universe, universe)


@pytest.mark.parametrize("size", [1, 17, 400])
def test_texts_read_part_by_part_give_the_same_features(monkeypatch, size):
    """Shingles, n-grams and word shapes don't depend on where a text is cut; hashes of words not on where their bytes are."""
    import random

    import numpy as np

    from lakeops.llm import classifier, hashing

    rng = random.Random(size)
    texts = ["".join(rng.choice(["a", "Bé", " ", "\n", "word ", "7", ".", "x" * 30, "日 "]) for _ in range(rng.randrange(300))) for _ in range(40)] + ["", " ", "a"]
    want = [(hashing.shingles(t), classifier.features(t)) for t in texts]
    words = [hashing.word_hashes(d, *hashing.word_spans(d)) for d in (np.frombuffer(t.encode(), np.uint8) for t in texts)]
    monkeypatch.setattr(hashing, "PART", size)
    monkeypatch.setattr(hashing, "SECTION", size)
    for t, (shingles, features), hashes in zip(texts, want, words):
        data = np.frombuffer(t.encode(), np.uint8)
        assert hashing.word_hashes(data, *hashing.word_spans(data)).tolist() == hashes.tolist()
        assert hashing.shingles(t).tolist() == shingles.tolist() and classifier.features(t).tolist() == features.tolist()


def test_features_are_those_of_plain_loops():
    """The classifier's features from strings and loops, one by one."""
    import math
    import re

    import numpy as np

    from lakeops.llm import classifier
    from lakeops.llm.hashing import mix

    def number(gram, family):
        return int(mix(np.array([gram * 16 + family], dtype=object).astype(np.uint64) if gram < 1 << 59 else np.array(
            [(gram * 16 + family) % (1 << 64)], np.uint64))[0]) >> (64 - classifier.BITS)

    def plain(text):
        data, found = text.encode(), set()
        for n in (1, 2, 3):
            for i in range(len(data) - n + 1):
                found.add(number(int.from_bytes(data[i:i + n], "big"), n))
        words, shapes = re.findall(rb"[^\x20\x09-\x0D]+", data), []
        for i, w in enumerate(words):
            again = 1 if i and words[i - 1] == w else 2 if i > 1 and words[i - 2] == w else 0
            kind = int(classifier.KIND[w[0]]) * 4 + int(classifier.KIND[w[-1]])
            shapes.append(((kind * 8) + min(int(math.log2(len(w) + 1)), 7)) * 3 + again + 1)
        for n in (1, 2, 3):
            for i in range(len(shapes) - n + 1):
                gram = 0
                for s in shapes[i:i + n]:
                    gram = gram * 512 + s
                found.add(number(gram, 8 + n))
        return sorted(found)

    for text in ("", "a", "The the THE, the 12 (x) é. x x\n y x", "one two one  two\tone! " * 3):
        assert classifier.features(text).tolist() == plain(text)
