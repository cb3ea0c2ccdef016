import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm import collocations as module
from lakeops.llm.collocations import collocations, pair_counts, sections

SCHEMA = "lang string, text string"


def plain(docs, least=10, longest=3, top=2000):
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            held = counts.setdefault(lang, Counter())
            for size in range(1, longest + 1):
                held.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, held in counts.items():
        candidates = {p: a for p, a in held.items() if len(p) > 1 and a >= least}
        dropped = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and p[i:j] in candidates and 100 * a >= 50 * candidates[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((1000000 * a * a // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p)))
                scored.append((score, a, " ".join(p), held[p[:k]], held[p[k:]]))
        scored.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, left, right, totals[lang], score) for i, (score, a, p, left, right) in enumerate(scored[:top])]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def texts(seed, docs=150, words=400):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "é", "xx", "a" * 40, "#1", "日本"] + [f"w{i}" for i in range(30)]
    joins = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", " ! ", "\r\n", "\x0b", "  "]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(rng.choice(["en", "de", None, ""]), "".join(w + rng.choice(joins) for w in rng.choices(vocabulary, weights, k=rng.randrange(words))))
            for _ in range(docs)]


@pytest.mark.parametrize("block_bytes", [module.BLOCK_BYTES, 700])
def test_equals_the_plain_version(spark, block_bytes):
    docs = texts(1)
    docs += [("en", None), (None, ""), ("en", " .. \n")] + docs[:5] * 3
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = found(collocations(df, block_bytes=block_bytes))
    assert got == plain(docs) and len(got) > 100
    assert found(collocations(df, block_bytes=block_bytes, longest=4, least=5, top=50)) == plain(docs, 5, 4, 50)


def test_dense_tiles_count_as_sparse_ones(monkeypatch):
    rng = np.random.default_rng(5)
    left, right = (np.minimum(rng.zipf(1.3, 50_000), 5_000_000_000).astype(np.int64) for _ in range(2))
    want = Counter(zip(left.tolist(), right.tolist()))
    for dense in (1, 500, 1 << 60):
        monkeypatch.setattr(module, "DENSE", dense)
        a, b, c = pair_counts(left, right)
        assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == want and len(a) == len(want)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=200), st.integers(1, 40))
def test_sections_hold_each_word_once_with_its_context(text, size):
    whole, parts = text.encode(), list(sections(text.encode(), 2, size))
    assert b"".join(p[h:] for p, h in parts) == whole
    for part, head in parts:
        assert len(part[:head].split()) <= 2


def test_long_texts_empty_tables_and_other_columns(spark):
    long = ("one two three four. " * 300_000) + "five" * 3_000_000 + " six" * 12
    docs = [("en", long), ("en", "one two")]
    df = spark.createDataFrame([(*r, 1, 2) for r in docs], SCHEMA + ", word string, block int")
    assert found(collocations(df)) == plain(docs)
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations(spark.createDataFrame([("en", None)], SCHEMA)).collect() == []
