"""Python workers serve one task after another; between tasks they give memory back that they no longer use."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa


def release_memory() -> None:
    """Return what Arrow and the C library hold in reserve to the system; without glibc only Arrow's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`work` on one group, whose arrays are given back after it."""

    def of_group(table: pa.Table) -> pa.Table:
        result = work(table)
        release_memory()
        return result

    return of_group


def releasing_both(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """As `releasing`, for cogroups."""

    def of_groups(table: pa.Table, other: pa.Table) -> pa.Table:
        result = work(table, other)
        release_memory()
        return result

    return of_groups
