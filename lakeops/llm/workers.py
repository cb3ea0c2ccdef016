"""Memory of Python workers: they stay for later tasks, and should not keep what an earlier one needed."""

from __future__ import annotations

import ctypes
import time

import pyarrow as pa

_last = 0.0


def release(every: float = 0.0) -> None:
    """Give memory that isn't used back to the system; with `every`, at most once in so many seconds.

    Tasks call it at their end. Allocators otherwise keep the greatest amount that any task has had, in
    each of the idle workers of an executor.
    """
    global _last
    now = time.monotonic()
    if now - _last < every:
        return
    _last = now
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
