"""Memory of Python workers."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which the worker gives back the memory it has freed.

    Workers wait for their next task beside the executor; what they keep is missing in its other stages.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return wrapped
