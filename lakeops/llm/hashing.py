"""Vectorised hashes of a text's words and shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64, for i below at least n."""
    if not _powers or len(_powers["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words (runs of bytes that are no ASCII white space)."""
    change = np.flatnonzero(np.diff(np.concatenate(([True], SPACE[data], [True])).astype(np.int8)))
    return change[::2], change[1::2]


# Bytes hashed at once: a text of any length takes no more memory than its words' places and hashes.
SECTION = 1 << 18


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word (ascending, not overlapping places)."""
    up, down = powers(min(len(data), SECTION) + 1)
    out = np.zeros(len(begins), np.uint64)
    for a in range(0, len(data), SECTION):
        b = min(a + SECTION, len(data))
        i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(begins, b, side="left"))
        if i >= j:
            continue
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * down[:b - a], out=sums[1:])
        low, high = np.maximum(begins[i:j] - a, 0), np.minimum(ends[i:j] - a, b - a)
        if begins[i] < a:  # a word that goes on: what came before moves up by the bytes here
            out[i] = (int(out[i]) * pow(BASE, int(high[0]), 1 << 64)) % (1 << 64)
        out[i:j] += (sums[high] - sums[low]) * up[high - 1]
    return mix(out + (ends - begins).astype(np.uint64))


# Bytes of a text whose words are looked at together.
PART = 1 << 20


def parts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begins and ends of parts of about `PART` bytes; none cuts a word."""
    at = 0
    while at < len(data):
        end = min(at + PART, len(data))
        while end < len(data) and not SPACE[data[end]]:
            step = SPACE[data[end:end + 4096]]
            end += int(step.argmax()) if step.any() else len(step)
        yield at, end
        at = end


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words."""
    count = len(words) - size + 1
    steps = mix(np.arange(1, size + 1, dtype=np.uint64) + np.uint64(size << 32)) | np.uint64(1)
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total += mix(words[k:k + count] * steps[k])
    return np.unique(mix(total))


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of `n` words, with A-Z in lower case.

    Fewer words make one shingle of them all; no words, none. Long texts are read part by part.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    before, found = np.zeros(0, np.uint64), []
    for a, b in parts(data):
        begins, ends = word_spans(data[a:b])
        words = np.concatenate((before, word_hashes(data[a:b], begins, ends)))
        if len(words) >= n:
            found.append(_runs(words, n))
            words = words[len(words) - n + 1:]
        before = words
        if len(found) > 64:
            found = [np.unique(np.concatenate(found))]
    if not found:
        return _runs(before, len(before)) if len(before) else before
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))
