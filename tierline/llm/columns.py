"""Arrow columns as numpy arrays, for functions that work batch by batch."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where each row starts (one entry more than rows).

    A null counts as an empty text.
    """
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    binary = pc.cast(pc.fill_null(column, ""), pa.large_string()).cast(pa.large_binary())
    _, places, data = binary.buffers()
    starts = np.frombuffer(places, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The reverse of utf8(): rows of text over the same bytes."""
    return pa.Array.from_buffers(
        pa.large_string(),
        len(starts) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(data)],
    )


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
