"""Memory of Python workers."""

import ctypes

import pyarrow as pa


def hand_back():
    """Give what allocators still hold back to the system.

    A Python worker outlives its task and waits for another one; what it keeps meanwhile is
    missing in every later stage on the machine.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
