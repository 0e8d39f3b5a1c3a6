"""Tables that a Python worker keeps between tasks: those of one operator at a time.

Spark's workers outlive a stage. What one operator keeps to be quick would stand beside the tables of the next, and a
pipeline of operators would need the memory of all of them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

# Freed arrays stay with the process until the C library is told to return them; not every system has one that can.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_tables: dict[Hashable, Any] = {}


def resident(key: Hashable, make: Callable[[], Any]) -> Any:
    """The table of that key, made if another or none is kept."""
    if key not in _tables:
        vacate()
        _tables[key] = make()
    return _tables[key]


def vacate() -> None:
    """Keep none, for operators that have no such table, and give back what the batches before have left."""
    _tables.clear()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
