"""Words of a batch of texts as numbers: each distinct word is looked at once in a batch."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in steps of so many bytes (a longer text alone), so memory stays bounded.
STEP_BYTES = 4 << 20


def release() -> None:
    """Give freed memory back to the system: two workers share an executor's with its JVM."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None


def steps(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about STEP_BYTES."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64))
    group = sizes // STEP_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)
        release()


def parts(texts: pa.Array, split: Callable[[pa.Array], pa.ListArray]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first part of each text and the end, number of each part's word, the distinct words)."""
    lists = split(texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    coded = lists.flatten().dictionary_encode()
    return ends.astype(np.int64), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def by_space(texts: pa.Array) -> pa.ListArray:
    return pc.split_pattern(texts, " ")
