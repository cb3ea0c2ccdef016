"""Encoding whole texts with a public tokenizer, inside Python tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from lakeops.llm.hashing import SPACE, word_hashes
from lakeops.llm.workers import release

# White space that `units` doesn't know; texts that hold any are encoded in one piece.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")
# Distinct units remembered by a worker, about 24 bytes each; beyond, it begins anew.
MAX_UNITS = 1_000_000
SLICE_BYTES = 1 << 20
BATCH = 2048
# A text of more characters is encoded in parts, cut before a blank between letters or digits: no pre-token, added
# token or normalised character reaches over such a place.
PART_CHARS = 1 << 20
CUT = re.compile("[0-9A-Za-z](?= [0-9A-Za-z])")

ALNUM, MARK, LETTER_LEAD = (np.zeros(256, bool) for _ in range(3))
for _low, _high in ((48, 57), (65, 90), (97, 122)):
    ALNUM[_low:_high + 1] = True
for _low, _high in ((33, 47), (58, 64), (91, 96), (123, 126)):
    MARK[_low:_high + 1] = True
LETTER_LEAD[0xC3:0xCA] = True  # of two-byte letters, but for the signs of multiplication and division


def units(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the units of some UTF-8 texts begin; `begins` are the texts' own begins.

    A unit is white space and what follows, up to the next white space, or to a sentence mark behind
    a letter or digit. No pre-token of the tokenizers used here reaches over these places, so that
    units encode alone as they do in their text.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    start = np.zeros(len(data), bool)
    space, mark = SPACE[data], MARK[data]
    start[1:] = space[1:] & ~space[:-1]
    before = ALNUM[data[:-1]]
    long = (data[1:-1] & 0xC0 == 0x80) & LETTER_LEAD[data[:-2]] & ~((data[:-2] == 0xC3) & ((data[1:-1] == 0x97) | (data[1:-1] == 0xB7)))
    before[1:] |= long
    start[1:] |= mark[1:] & before
    start[begins[begins < len(data)]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of whole texts as little-endian unsigned integers of `dtype`, with an end id.

    Units seen before in the task are looked up by a 64-bit hash; only new ones go to the tokenizer.
    The result is that of the tokenizer on the text. Strings of added tokens (as "<|endoftext|>") in a
    text are ordinary text, or, with `added_ids`, their tokens' ids, as in the library's default call.
    """

    def __init__(self, path: str, end_id: int, added_ids: bool = False):
        # One thread: a pool of them holds memory for each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_ids
        # Texts that hold any of these are encoded in one piece.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_ids else []
        self.dtype = "<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.dtype).tobytes()
        self._forget()

    def _forget(self) -> None:
        # Sorted hashes of the known units; where their ids begin and end in the pool.
        self.keys, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        # The library's results take a kilobyte each: few at a time.
        return [e.ids for a in range(0, len(texts), BATCH) for e in self.tokenizer.encode_batch(texts[a:a + BATCH], add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        found = self._whole(texts)
        length = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), self.dtype, int(length.sum()))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool[:self.used], np.zeros(max(self.used // 2, len(ids)), self.dtype)))
        self.pool[self.used:self.used + len(ids)] = ids
        at = np.searchsorted(self.keys, keys)  # both are sorted
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(length) - length)
        self.length = np.insert(self.length, at, length)
        self.keys, self.used = np.insert(self.keys, at, keys), self.used + len(ids)

    def _slice(self, texts: list[bytes]) -> list[bytes]:
        sizes = np.array([len(t) for t in texts], np.int64)
        raw, text_begin = b"".join(texts), np.cumsum(sizes) - sizes
        data = np.frombuffer(raw, np.uint8)
        begins = units(data, text_begin)
        ends = np.append(begins[1:], len(data))[:len(begins)]
        keys, first, unit = np.unique(word_hashes(data, begins, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MAX_UNITS or self.used > 4 * MAX_UNITS:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(keys[new], [raw[begins[i]:ends[i]].decode("utf-8", "surrogatepass") for i in first[new]])
            at = np.searchsorted(self.keys, keys)
        length = self.length[at][unit].astype(np.int64)
        stop = np.cumsum(length)
        # Ids of all units in order: where each unit's ids lie in the pool, id by id.
        ids = self.pool[np.repeat(self.begin[at][unit] - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)]
        bounds = np.concatenate(([0], stop))[np.searchsorted(begins, np.append(text_begin, len(data)))]
        return [ids[a:b].tobytes() + self.end for a, b in zip(bounds[:-1], bounds[1:])]

    def _odd(self, text: str) -> bool:
        return bool(ODD_SPACE.search(text)) or any(a in text for a in self.added)

    def _part(self, text: str) -> bytes:
        """Ids of one part of a text, without the end id."""
        if self._odd(text):
            return np.array(self._whole([text])[0], self.dtype).tobytes()
        return self._slice([text.encode("utf-8", "surrogatepass")])[0][:-len(self.end)]

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            cut = CUT.search(text, at + PART_CHARS // 2)
            end = cut.end() if cut else len(text)
            yield text[at:end]
            at = end

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The bytes of each text's ids and the end id; null is an empty text."""
        out: list[bytes] = []
        held: list[bytes] = []
        for text in texts:
            if text and len(text) > PART_CHARS:
                out += self._slice(held) if held else []
                held = []
                out.append(b"".join(map(self._part, self._parts(text))) + self.end)
            elif text and self._odd(text):
                out += self._slice(held) if held else []
                held = []
                out.append(self._part(text) + self.end)
            else:
                held.append((text or "").encode("utf-8", "surrogatepass"))
                if sum(map(len, held)) > SLICE_BYTES:
                    out += self._slice(held)
                    held = []
        return out + (self._slice(held) if held else [])


ENCODERS: dict[tuple[str, int, bool], Encoder] = {}


def worker_encoder(path: str, end_id: int, added_ids: bool = False) -> Encoder:
    """This Python worker's encoder, with the units of its earlier tasks where the package can be imported."""
    try:
        from lakeops.llm import tokens as home
    except ImportError:
        return Encoder(path, end_id, added_ids)
    if (path, end_id, added_ids) not in home.ENCODERS:
        home.ENCODERS[path, end_id, added_ids] = home.Encoder(path, end_id, added_ids)
    return home.ENCODERS[path, end_id, added_ids]


def encoded_rows(batches: Iterator[pa.RecordBatch], encoder: Encoder, step: int = 512) -> Iterator[tuple[int | None, bytes]]:
    """(first column, ids of the second) of each row; `step` rows are encoded at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()))
            release(every=0.5)
    release()


def vocabulary(name: str) -> str:
    """Where this machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
