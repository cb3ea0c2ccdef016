"""Repairing the structure of conversations: cheapest edits, the least audit among them.

A conversation's rows are consumed in turn order by an automaton of four states (nothing yet, after the system
row, after a user row, after an assistant row). A cost sweep from the end gives each node (row, state) its cheapest
rest; the arcs on cheapest ways form a graph in which a node has at most one arc of each edit. Its nodes are ranked
by prefix doubling: by the first edit of their audit, then by the first 2, 4, 8, ... from the ranks of a node and of
the node its doubled pointer leads to. The least arc of each node by edit and rank, followed through the doubled
pointers, is the audit.

Conversations of up to `long_rows` rows are repaired within one task, many at a time. Longer ones are cut into
slices by range, each with a 4 x 4 matrix of the costs from its entry states to its exit states; folding these
from the end gives each slice the cost of what follows, and folding its least ways from the begin its entry state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.registry import query, table
from lakeops.operators.skew import range_slices
from lakeops.session import scratch_dir

BLANKS = " \t\n\x0b\x0c\r"
LONG_ROWS = 10_000
LONG_BYTES = 32 << 20
SLICE_ROWS = 100_000
# Rows repaired at once, and bytes of repaired text handed on at once.
BATCH_ROWS = 20_000
CHUNK_BYTES = 1 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# The state after a further row of the pattern, if that isn't the system row.
NEXT = np.array([USER, USER, ASSISTANT, USER])
NAMES = {USER: "user", ASSISTANT: "assistant"}
# Edits in ASCII order of their initials, and their costs.
END, DELETE, INSERT, KEEP, REROLE = range(5)
LETTERS = " DIKR"
COST = {DELETE: 4, INSERT: 3, REROLE: 3, "truncated": 3}
FAR = 1 << 40
# Cost of the inserts that end a conversation, by state.
DONE = np.array([0, 2 * COST[INSERT], COST[INSERT], 0], np.int64)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


class Costs:
    """Rows of some pieces, one after the other, with the costs of their edits.

    `initial` holds the state a row's role leads to (0: another role), `must` the rows that have to go, `cut`
    the truncated ones, `lengths` the rows of each piece.
    """

    def __init__(self, initial: np.ndarray, must: np.ndarray, cut: np.ndarray, lengths: np.ndarray):
        self.lengths, n = lengths, len(initial)
        self.first = np.cumsum(lengths) - lengths
        extra = np.where(must, FAR, COST["truncated"] * cut)
        self.keep = np.full((n, 4), FAR, np.int64)  # by the state before it
        for state in range(4):
            fits = (initial == NEXT[state]) | ((state == START) & (initial == SYSTEM))
            self.keep[fits, state] = extra[fits]
        self.rerole = np.minimum(COST[REROLE] + extra, FAR)
        # Where the kept row leads: as the pattern goes on, or to the system row.
        self.kept_to = np.where((initial == SYSTEM)[:, None] & (np.arange(4) == START), SYSTEM, NEXT)

    def sweep(self, ends: np.ndarray) -> np.ndarray:
        """Cheapest rest of each node; `ends` (pieces, 4, m) holds that of the last nodes, for m cases at once.

        A piece of L rows has L + 1 layers of four nodes.
        """
        pieces, m = len(self.lengths), ends.shape[2]
        out = np.full((int(self.lengths.sum()) + pieces, 4, m), FAR, np.int64)
        top = self.first + np.arange(pieces)
        out[top + self.lengths] = ends
        order = np.argsort(-self.lengths, kind="stable")
        longest = self.lengths[order]
        for left in range(1, int(longest[0]) + 1 if pieces else 0):
            live = order[:np.searchsorted(-longest, -left, side="right")]
            row, at = self.first[live] + self.lengths[live] - left, top[live] + self.lengths[live] - left
            after = out[at + 1]
            best = np.minimum(after + COST[DELETE], after[:, NEXT] + self.rerole[row, None, None])
            kept = np.take_along_axis(after, np.broadcast_to(self.kept_to[row][:, :, None], after.shape), 1)
            best = np.minimum(best, kept + self.keep[row][:, :, None])
            for _ in range(2):  # two inserts in a row at most: a third leads back to the same state
                best = np.minimum(best, best[:, NEXT] + COST[INSERT])
            out[at] = best
        return np.minimum(out, FAR)

    def arcs(self, rest: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Target of each node's optimal arc by edit (nodes, 5), or -1; `last`: the pieces that end a conversation."""
        pieces = len(self.lengths)
        layers = len(rest)
        target = np.full((layers, 4, 5), -1, np.int64)
        state = np.arange(4)
        top = self.first + np.arange(pieces)
        at = np.ones(layers, bool)
        at[top + self.lengths] = False
        at = np.flatnonzero(at)  # layers that a row follows; the rows are in the same order
        here, after = rest[at], rest[at + 1]
        ways = (
            (DELETE, np.broadcast_to(state, here.shape), np.full(here.shape, COST[DELETE])),
            (KEEP, self.kept_to, self.keep),
            (REROLE, np.broadcast_to(NEXT, here.shape), np.repeat(self.rerole[:, None], 4, 1)),
        )
        for edit, to, cost in ways:
            fits = (here < FAR) & (here == np.take_along_axis(after, to, 1) + cost)
            target[at, :, edit] = np.where(fits, 4 * (at[:, None] + 1) + to, -1)
        inserting = np.concatenate((at, (top + self.lengths)[last]))
        here = rest[inserting]
        fits = (here < FAR) & (here == here[:, NEXT] + COST[INSERT])
        target[inserting, :, INSERT] = np.where(fits, 4 * inserting[:, None] + NEXT, -1)
        return target.reshape(-1, 5), 4 * top


def ranked(target: np.ndarray) -> np.ndarray:
    """Rank of each node's least audit: after k rounds, of its first 2 ** k edits. Nodes without arcs rank first."""
    some = target >= 0
    rank = np.where(some.any(1), some.argmax(1), END)
    over = rank == END
    ahead = np.where(over, np.arange(len(target)), target[np.arange(len(target)), rank])
    while not over[ahead].all():
        rank = np.unique(rank * (rank.max() + 1) + rank[ahead], return_inverse=True)[1]
        ahead = ahead[ahead]
    return rank


def least_paths(target: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, node, edit, next node) of all steps in order, and the last node of each piece."""
    rank = ranked(target)
    # The least arc by edit, and by the rank of where it leads.
    score = np.where(target >= 0, np.arange(5) * (len(target) + 1) + rank[np.maximum(target, 0)], np.iinfo(np.int64).max)
    edit = np.where((target >= 0).any(1), score.argmin(1), END)
    ahead = np.where(edit == END, np.arange(len(target)), target[np.arange(len(target)), edit])
    piece, node, offset, step = np.arange(len(begins)), begins, np.zeros(len(begins), np.int64), 1
    jump = ahead
    while True:
        further = jump[node]
        inside = edit[further] != END
        if not inside.any():
            break
        piece, node = np.concatenate((piece, piece[inside])), np.concatenate((node, further[inside]))
        offset = np.concatenate((offset, offset[inside] + step))
        jump, step = jump[jump], 2 * step
    some = edit[node] != END
    order = np.lexsort((offset[some], piece[some]))
    piece, node = piece[some][order], node[some][order]
    ends = begins.copy()
    last = np.append(piece[1:] != piece[:-1], True) if len(piece) else np.zeros(0, bool)
    ends[piece[last]] = ahead[node[last]]
    return piece, node, edit[node], ahead[node], ends


def codes(roles: list[str]) -> np.ndarray:
    return np.array([INITIALS.get(r[:1], 0) for r in roles], np.int64)


def illegal_pairs(initial: np.ndarray) -> np.ndarray:
    """Whether a row's role may not follow that of the row before it, from the second row on."""
    a, b = initial[:-1], initial[1:]
    return ~((((a == SYSTEM) | (a == ASSISTANT)) & (b == USER)) | ((a == USER) & (b == ASSISTANT)))


def lines(edits: np.ndarray, rows: np.ndarray, to: np.ndarray, roles: list[str], texts: list[str]) -> Iterator[str]:
    """The repaired rows of some steps; `rows` holds the row each step looks at, `to` the state it leads to."""
    for edit, row, state in zip(edits.tolist(), rows.tolist(), to.tolist()):
        if edit == KEEP:
            yield f"{roles[row]}:{texts[row]}"
        elif edit == REROLE:
            yield f"{NAMES[state]}:{texts[row]}"
        elif edit == INSERT:
            yield f"{NAMES[state]}:"


def steps_of(target: np.ndarray, begins: np.ndarray, lengths: np.ndarray):
    """least_paths with rows instead of nodes: per step (piece, edit, row, state it leads to), and the last nodes."""
    piece, node, edit, ahead, ends = least_paths(target, begins)
    return piece, edit, node // 4 - piece, ahead % 4, ends


def repair(convs: list, turns: list, roles: list[str], texts: list[str], last: list[str]) -> Iterator[tuple]:
    """The `RESULT` rows of whole conversations, whose rows follow each other in order."""
    n = len(convs)
    head = np.array([i == 0 or convs[i] != convs[i - 1] for i in range(n)], bool)
    begins = np.flatnonzero(head)
    lengths = np.diff(np.append(begins, n))
    blank = np.array([x == "" for x in last], bool)
    duplicate = np.zeros(n, bool)
    for a, length in zip(begins.tolist(), lengths.tolist()):
        seen: set = set()
        for i in range(a, a + length):
            key = (roles[i], texts[i])
            duplicate[i] = key in seen
            seen.add(key)
    duplicate &= ~blank
    cut = np.array([x not in (".", "!", "?") for x in last], bool) & ~blank & ~duplicate
    initial = codes(roles)
    costs = Costs(initial, blank | duplicate, cut, lengths)
    rest = costs.sweep(np.repeat(DONE[None, :, None], len(begins), 0))[:, :, 0]
    target, nodes = costs.arcs(rest, np.ones(len(begins), bool))
    piece, edit, row, to, _ = steps_of(target, nodes, lengths)
    bad = np.append(False, illegal_pairs(initial)) & ~head
    bounds = np.searchsorted(piece, np.arange(len(begins) + 1))
    letters = np.frombuffer(LETTERS.encode(), np.uint8)[edit].tobytes().decode()
    for k, (a, length) in enumerate(zip(begins.tolist(), lengths.tolist())):
        b, part = a + length, slice(bounds[k], bounds[k + 1])
        known = [t for t in turns[a:b] if t is not None]
        text = "\n".join(lines(edit[part], row[part], to[part], roles, texts))
        yield (convs[a], max(known) - min(known) + 1 - len(set(known)) if known else 0, int(blank[a:b].sum()),
               int(duplicate[a:b].sum()), int(cut[a:b].sum()), int(bad[a:b].sum()), int(rest[nodes[k] // 4, START]),
               letters[part], hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


RESULT_KINDS = [pa.int64()] * 7 + [pa.string()] * 2
RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def result_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(RESULT_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, RESULT_KINDS)], RESULT_NAMES)


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (conv, turn, role, text, last) in order: a `RESULT` row for each conversation."""
    held: list[list] = [[], [], [], [], []]
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            for column, more in zip(held, part.columns[:5]):
                column += more.to_pylist()
            size += part.nbytes
            if len(held[0]) < BATCH_ROWS and size < CHUNK_BYTES * 8:
                continue
            # The last conversation may go on.
            end = len(held[0])
            while end and held[0][end - 1] == held[0][-1]:
                end -= 1
            if end:
                yield result_batch(list(repair(*(c[:end] for c in held))))
                held, size = [c[end:] for c in held], 0
    if held[0]:
        yield result_batch(list(repair(*held)))


# --- conversations that one task can't hold ---

FLAGS = "_slice bigint, _pos bigint, conv bigint, turn bigint, role string, text string, last string, duplicate boolean"
MATRIX = "_slice bigint, conv bigint, costs array<bigint>"
ENTRY = "_slice bigint, conv bigint, rest array<bigint>, last boolean"
EXITS = "_slice bigint, conv bigint, rest array<bigint>, last boolean, total bigint, exits array<int>"
PIECE = ("conv bigint, _slice bigint, seq bigint, chunk binary, audit string, blank bigint, duplicate bigint, truncated bigint, "
         "illegal bigint, cost bigint, first_role int, last_role int, first_turn bigint, last_turn bigint, turns bigint")


def _arrow(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.Table.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


class Slice:
    """The rows of one slice in order, as pieces of conversations."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("_pos")
        self.rows, self.slice = rows, rows.column("_slice")[0].as_py() if rows.num_rows else 0
        self.convs, last = rows.column("conv").to_pylist(), rows.column("last").to_pylist()
        n = len(self.convs)
        self.head = np.array([i == 0 or self.convs[i] != self.convs[i - 1] for i in range(n)], bool)
        self.begins = np.flatnonzero(self.head)
        self.lengths = np.diff(np.append(self.begins, n))
        self.roles = rows.column("role").to_pylist()
        self.initial = codes(self.roles)
        self.blank = np.array([x == "" for x in last], bool)
        self.duplicate = np.array(rows.column("duplicate").to_pylist(), bool) & ~self.blank
        self.cut = np.array([x not in (".", "!", "?") for x in last], bool) & ~self.blank & ~self.duplicate
        self.costs = Costs(self.initial, self.blank | self.duplicate, self.cut, self.lengths)

    def matrices(self) -> pa.Table:
        """Cost from each entry state to each exit state, row by row, of each piece."""
        unit = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
        rest = self.costs.sweep(np.repeat(unit[None], len(self.begins), 0))
        top = self.costs.first + np.arange(len(self.begins))
        return _arrow([(self.slice, self.convs[a], rest[t].reshape(-1).tolist()) for a, t in zip(self.begins.tolist(), top.tolist())], MATRIX)

    def ways(self, entries: pa.Table):
        """Costs and optimal arcs, given what follows each piece."""
        given = {r["conv"]: r for r in entries.to_pylist()}
        mine = [given[self.convs[a]] for a in self.begins.tolist()]
        ends = np.array([r["rest"] for r in mine], np.int64).reshape(-1, 4, 1)
        rest = self.costs.sweep(ends)[:, :, 0]
        target, nodes = self.costs.arcs(rest, np.array([r["last"] for r in mine], bool))
        return mine, rest, target, nodes


def _slice_exits(rows: pa.Table, entries: pa.Table) -> pa.Table:
    """The state in which each piece's least way leaves it, by entry state, and the cost from the start."""
    part = Slice(rows)
    mine, rest, target, nodes = part.ways(entries)
    ends = [least_paths(target, nodes + s)[4] for s in range(4)]
    return _arrow([(part.slice, r["conv"], r["rest"], r["last"], int(rest[nodes[k] // 4, START]), [int(e[k] % 4) for e in ends])
                   for k, r in enumerate(mine)], EXITS)


def _slice_pieces(rows: pa.Table, entries: pa.Table) -> pa.Table:
    """Repaired lines in chunks, audits and counts of each piece, from its entry state."""
    part = Slice(rows)
    mine, rest, target, nodes = part.ways(entries)
    states = np.array([r["entry"] for r in mine], np.int64)
    piece, edit, row, to, _ = steps_of(target, nodes + states, part.lengths)
    bounds = np.searchsorted(piece, np.arange(len(nodes) + 1))
    texts, turns = part.rows.column("text").to_pylist(), part.rows.column("turn").to_pylist()
    bad = np.append(False, illegal_pairs(part.initial)) & ~part.head
    out = []
    for k, r in enumerate(mine):
        a, b, steps = int(part.begins[k]), int(part.begins[k] + part.lengths[k]), slice(bounds[k], bounds[k + 1])
        known = [t for t in turns[a:b] if t is not None]
        counts = tuple(int(x[a:b].sum()) for x in (part.blank, part.duplicate, part.cut, bad))
        audit = np.frombuffer(LETTERS.encode(), np.uint8)[edit[steps]].tobytes().decode()
        facts = (*counts, r["total"] if r["first"] else 0, int(part.initial[a]), int(part.initial[b - 1]),
                 known[0] if known else None, known[-1] if known else None, len(set(known)))
        seq, held, size = 0, [], 0
        for line in lines(edit[steps], row[steps], to[steps], part.roles, texts):
            held.append(line.encode("utf-8", "surrogatepass") + b"\n")
            size += len(held[-1])
            if size >= CHUNK_BYTES:
                out.append((r["conv"], part.slice, seq, b"".join(held), audit if not seq else "",
                            *(facts if not seq else (0, 0, 0, 0, 0, None, None, None, None, None))))
                seq, held, size = seq + 1, [], 0
        if held or not seq:
            out.append((r["conv"], part.slice, seq, b"".join(held), audit if not seq else "",
                        *(facts if not seq else (0, 0, 0, 0, 0, None, None, None, None, None))))
    return _arrow(out, PIECE)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over `PIECE` rows in order: a conversation's digest runs over its chunks, held one at a time."""
    now, state = object(), None

    def done():
        # The newline behind the last line isn't part of the text.
        digest, least, most = state["digest"], state["least"], state["most"]
        digest.update(state["tail"][:-1])
        gaps = most - least + 1 - state["turns"] if least is not None else 0
        return result_batch([(now, gaps, *state["counts"], "".join(state["audit"]), digest.hexdigest())])

    for batch in batches:
        for r in batch.to_pylist():
            if state is None or r["conv"] != now:
                if state is not None:
                    yield done()
                now, state = r["conv"], {"digest": hashlib.sha256(), "tail": b"", "counts": [0] * 5, "audit": [], "least": None,
                                         "most": None, "turns": 0, "role": None}
            if r["chunk"]:
                state["digest"].update(state["tail"])
                state["tail"] = r["chunk"]
            if r["seq"]:
                continue
            state["audit"].append(r["audit"])
            for i, name in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                state["counts"][i] += r[name]
            if state["role"] is not None and (state["role"], r["first_role"]) not in LEGAL:
                state["counts"][3] += 1
            state["role"] = r["last_role"]
            if r["turns"]:
                state["turns"] += r["turns"] - (state["most"] == r["first_turn"])
                state["least"] = r["first_turn"] if state["least"] is None else state["least"]
                state["most"] = r["last_turn"]
    if state is not None:
        yield done()


def _fold_back(group: pa.Table) -> pa.Table:
    """The cheapest rest at the end of each piece of a conversation, from the matrices of those behind it."""
    rows = sorted(group.to_pylist(), key=lambda r: -r["_slice"])
    rest, out = DONE, []
    for k, r in enumerate(rows):
        out.append((r["_slice"], r["conv"], rest.tolist(), k == 0))
        rest = np.minimum((np.array(r["costs"], np.int64).reshape(4, 4) + rest).min(1), FAR)
    return _arrow(out, ENTRY)


ENTERED = "_slice bigint, conv bigint, rest array<bigint>, last boolean, total bigint, entry int, first boolean"


def _fold_on(group: pa.Table) -> pa.Table:
    """The state in which each piece is entered, from the exits of those before it."""
    state, out = START, []
    for k, r in enumerate(sorted(group.to_pylist(), key=lambda r: r["_slice"])):
        out.append((r["_slice"], r["conv"], r["rest"], r["last"], r["total"], state, k == 0))
        state = r["exits"][state]
    return _arrow(out, ENTERED)


def saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, f"repair-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _repair_long(rows: DataFrame, total: int, slice_rows: int) -> DataFrame:
    """`RESULT` of conversations of any length; only the digest of one reads it in one task, a chunk at a time."""
    cut = range_slices(rows, ["conv", "turn", "role", "digest"], max(1, -(-total // slice_rows)))
    where = F.struct("_slice", "_pos")
    firsts = (cut.groupBy("conv", "role", "digest").agg(F.min(where).alias("first"))
              .select(*(F.col(c).alias(f"f_{c}") for c in ("conv", "role", "digest")), "first"))
    same = cut["conv"].eqNullSafe(F.col("f_conv")) & (cut["role"] == F.col("f_role")) & (cut["digest"] == F.col("f_digest"))
    flagged = saved(cut.join(firsts, same).withColumn("duplicate", where != F.col("first"))
                    .select(*(c.split()[0] for c in FLAGS.split(", "))), "rows")
    narrow = flagged.drop("text").withColumn("text", F.lit(None).cast("string"))

    def matrices(group: pa.Table) -> pa.Table:
        return Slice(group).matrices()

    entries = narrow.groupBy("_slice").applyInArrow(matrices, MATRIX).groupBy("conv").applyInArrow(_fold_back, ENTRY)
    exits = narrow.groupBy("_slice").cogroup(entries.groupBy("_slice")).applyInArrow(_slice_exits, EXITS)
    entered = saved(exits.groupBy("conv").applyInArrow(_fold_on, ENTERED), "entries")
    pieces = flagged.groupBy("_slice").cogroup(entered.groupBy("_slice")).applyInArrow(_slice_pieces, PIECE)
    return (pieces.repartition("conv").sortWithinPartitions("conv", "_slice", "seq").mapInArrow(_joined, RESULT))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv, turn, role, text and `copies` of each row after damage drawn from crc32 of "conv:turn"; null texts are one space.

    Of 20 cases, 0 drops the row (no copies), 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    conv, turn = (F.col(f"`{c}`").cast("bigint") for c in (conv_col, turn_col))
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    key = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)))
    pick = F.crc32(key) % 20
    return rows.select(
        conv.alias("conv"), turn.alias("turn"), F.when(pick == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(pick == 1, F.lit("")).when(pick == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(pick == 0, 0).when(pick == 3, 2).otherwise(1).alias("copies"))


def repair_conversations(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES,
                         slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One `RESULT` row per `conv` of rows with conv, turn, role, text and copies (how often the row stands there).

    Rows of a conversation are taken by turn, nulls first; within a turn by role, then by the SHA-256 of the text,
    copies side by side. A null conv is a conversation of its own, null roles and texts count as one space. Roles go
    by their first letter; one that is empty or begins otherwise than s, u or a can't be kept. Repeated rows are
    duplicates. A conversation without rows gives zeros, an empty audit and the digest of no text; an empty table
    gives no rows; other columns aren't read. Conversations over `long_rows` rows or `long_bytes` of text are cut into
    slices of about `slice_rows`, with the same result.
    """
    bytes_of = F.coalesce(F.octet_length("text"), F.lit(0)) * F.col("copies")
    sizes = saved(rows.groupBy("conv").agg(F.sum("copies").cast("bigint").alias("n"), F.sum(bytes_of.cast("bigint")).alias("bytes")), "sizes")
    long = sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes))
    extent = long.agg(F.sum("n").alias("n")).first()["n"]
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    full = (rows.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("conv", "turn", role.alias("role"), text.alias("text"), F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1)).alias("last"),
                    F.sha2(text, 256).alias("digest")))
    names = ["conv", "turn", "role", "text", "last"]
    if extent:
        marks = long.select(F.col("conv").alias("l_conv"))
        same = full["conv"].eqNullSafe(F.col("l_conv"))
        short = full.join(marks, same, "left_anti")
    else:
        short = full
    out = (short.repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest").select(*names)
           .mapInArrow(repaired, RESULT))
    none = sizes.where("n = 0").select(
        F.col("conv").alias("conv_id"), *(F.lit(0).cast("bigint").alias(c) for c in RESULT_NAMES[1:7]), F.lit("").alias("audit"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("repaired_sha256"))
    out = out.unionAll(none)
    if extent:
        out = out.unionAll(_repair_long(full.join(marks, same, "left_semi"), extent, slice_rows))
    return out


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))
