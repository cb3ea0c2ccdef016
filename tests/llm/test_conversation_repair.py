import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from brute import sha
from conftest import SF_SMALL
from lakeops.llm.conversation_repair import damaged, op13, repair_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACES = " \t\n\x0b\x0c\r"
GOAL, PREFIX = re.compile("(s?(ua)+)?"), re.compile("(s?(ua)*u?)?")


def cheapest(rows):
    """(cost, audit, repaired lines): edits tried in order of cost and audit until they give a whole conversation.

    `rows`: (role, text, must go, truncated).
    """
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and GOAL.fullmatch(roles):
            return cost, audit, out
        more = [(3, "I", i, r[0], f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, must, cut = rows[i]
            more.append((4, "D", i + 1, "", None))
            if not must:
                more += [(3 + 3 * cut, "R", i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
                if role:
                    more.append((3 * cut, "K", i + 1, role[0], f"{role}:{text}"))
        for price, letter, at, initial, line in more:
            if PREFIX.fullmatch(roles + initial):
                heapq.heappush(heap, (cost + price, audit + letter, at, roles + initial, out if line is None else (*out, line)))


def plain(rows, harm=True):
    """The contract's columns by conversation, of (conv, turn, role, text) rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text, held = " " if role is None else role, " " if text is None else text, convs[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        pick = zlib.crc32(key.encode()) % 20 if harm else 19
        if pick == 0:
            continue
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        held += [(turn, "user" if pick == 4 else role, text)] * (2 if pick == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2].encode())))
        counts, seen, facts = [0, 0, 0], set(), []
        for _, role, text in held:
            left = text.rstrip(SPACES)
            fault = 0 if not left else 1 if (role, text) in seen else 2 if left[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append((role, text, fault in (0, 1), fault == 2))
        pairs = [(a[1][:1], b[1][:1]) for a, b in zip(held, held[1:])]
        illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in pairs)
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = cheapest(facts)
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(lines).encode()))
    return out


def found(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_the_query_equals_the_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13(spark, SF_SMALL)) == plain(rows)


def odd_rows(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "User"]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Why? \t", "a.b", "é!"]
    return [(c, rng.choice([None, *range(longest)]), rng.choice(roles[:rng.choice([3, 9])]), rng.choice(texts))
            for c in [None, *range(convs)] for _ in range(rng.randrange(longest))]


@pytest.mark.parametrize("long_rows,slice_rows", [(10_000, 10), (2, 5), (0, 40)])
def test_odd_rows_whole_or_in_slices(spark, long_rows, slice_rows):
    rows = odd_rows(7, 40, 7)
    df = spark.createDataFrame(rows + [rows[0]] * 3, SCHEMA)
    got = found(repair_conversations(damaged(df), long_rows=long_rows, slice_rows=slice_rows))
    assert got == plain(rows + [rows[0]] * 3)


def test_a_hot_conversation_is_cut(spark):
    """One conversation holds most rows: the slices give what one task gives."""
    rng = random.Random(3)
    rows = [(5, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"No {t}", f"Why {t}?", "", "x" * 2000 + "."]))
            for t in range(3000)] + [(6, 0, "user", "Hello."), (6, 1, "assistant", "Yes.")]
    df = damaged(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = found(repair_conversations(df))
    assert found(repair_conversations(df, long_rows=100, slice_rows=300)) == want
    assert found(repair_conversations(df, long_bytes=1000, slice_rows=300)) == want
    assert want[5][5] > 1000


def test_long_texts_empty_tables_and_other_columns(spark):
    big = "word " * 2_000_000 + "end."
    rows = [(1, 0, "user", big), (1, 1, "assistant", big)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", conv bigint, digest string")
    assert found(repair_conversations(damaged(df))) == plain(rows)
    assert found(repair_conversations(damaged(df), long_bytes=100)) == plain(rows)
    none = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(damaged(none)).collect() == []
    # Every row of this conversation is dropped by its damage.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(repair_conversations(damaged(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA)))) == {
        gone: (0, 0, 0, 0, 0, 0, "", sha(b""))}
