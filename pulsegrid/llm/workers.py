"""What a Python worker keeps from task to task: the tables of one operator, and no more memory than that.

Spark's workers outlive a query. What one operator holds, and memory it has freed but the allocators kept, would stay
beside what the next one needs; so a worker lets go of it before another operator begins.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from contextlib import suppress

import pyarrow as pa

_held: dict[object, object] = {}
_operator = ""


def begin(operator: str) -> None:
    """To be called by an operator's tasks: drops what another one has left in this worker."""
    global _operator
    if operator == _operator:
        return
    _operator = operator
    _held.clear()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def held(operator: str, key: object, make: Callable[[], object]) -> object:
    """What make gives, made once for each worker while the same operator goes on; the last key's alone is held."""
    begin(operator)
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]
