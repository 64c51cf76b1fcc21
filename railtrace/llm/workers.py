"""What Python workers keep between tasks: the caches of one operator at a time.

A worker lives longer than a task and serves one operator after the other; what one has
cached would stay beside what the next one needs.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

_CACHES: list[Callable[[], None]] = []
_OWNER = [""]


def cache(clear: Callable[[], None]) -> None:
    """Make a cache known by what empties it."""
    _CACHES.append(clear)


def claim(owner: str) -> None:
    """Empty all caches and give their memory back, if another operator used this worker last."""
    if _OWNER[0] == owner:
        return
    _OWNER[0] = owner
    for clear in _CACHES:
        clear()
    release()


def release() -> None:
    """Give freed memory back to the machine, where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
