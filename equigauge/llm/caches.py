"""What a Python worker keeps between tasks."""

from __future__ import annotations

import contextlib
import ctypes
import gc

_held: dict[str, dict] = {}


def _give_back() -> None:
    """Return what was freed to the system; the C library would keep it for the worker."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def cache_of(operator: str) -> dict:
    """The cache of `operator` in this worker. Those of other operators are dropped, as workers serve one after another."""
    others = [name for name in _held if name != operator]
    for other in others:
        del _held[other]
    if others:
        _give_back()
    return _held.setdefault(operator, {})
