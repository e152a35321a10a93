"""Memory of Python workers, which go on to live beside the JVM's work once their tasks have ended."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def release() -> None:
    """Give back what Arrow and, where there is one, glibc's allocator keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """``run``, a function for ``mapInArrow``, whose worker gives its free memory back after the last batch."""
    def whole(batches):
        yield from run(batches)
        release()

    return whole
