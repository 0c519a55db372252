"""Word caches of a Python worker: one operator's at a time.

Spark reuses worker processes for the stages that follow, so what one operator remembered
would stay in memory while the next one works. Memory that Arrow and the C library hold back
for later goes back to the system as well."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_CLEAR: dict[str, Callable[[], None]] = {}


def register(name: str, clear: Callable[[], None]) -> None:
    _CLEAR[name] = clear


def use(name: str) -> None:
    """Called at the start of a task: empties the caches of all other operators."""
    for other, clear in _CLEAR.items():
        if other != name:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
