"""The large tables of one operator that a Python worker keeps between its tasks.

Spark uses a worker again for whatever comes next, so tables left behind add to the memory of every
later operator. There is room for one: making another drops it, and so does `release`, which
operators with large working arrays of their own call first.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_tables: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]):
    """What `make` gave for `key`, kept until other tables are."""
    if key not in _tables:
        release()
        _tables[key] = make()
    return _tables[key]


def release() -> None:
    """Drops the tables, and gives Arrow's spare memory back to the system."""
    _tables.clear()
    pa.default_memory_pool().release_unused()
