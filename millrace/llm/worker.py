"""Bounded memory in Python workers, which outlive their tasks and stand beside a JVM that fills its share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

SLICE = 2 << 20

#: Tables that modules keep for the length of a task; emptied at its end.
KEPT: list[dict | list] = []


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in batches of at most SLICE bytes or one row."""
    for batch in batches:
        left = [batch]
        while left:
            part = left.pop()
            half = part.num_rows // 2
            if half and part.nbytes > SLICE:
                left += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def trim() -> None:
    """Free memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not a GNU libc
        pass


def give_back() -> None:
    for x in KEPT:
        x.clear()
    trim()


def lean(run: Callable) -> Callable:
    """``run``, a function for ``mapInArrow``, over small batches; what it held is given back when it ends."""

    def bounded(batches):
        try:
            yield from run(slices(batches))
        finally:
            give_back()

    return bounded
