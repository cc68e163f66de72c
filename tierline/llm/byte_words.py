"""Words of whole texts, found by byte classes in Arrow batches."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tierline.llm.columns import strings, utf8

#: Bytes of text that a step looks at together; a longer text is one step of its own.
STEP_BYTES = 1 << 22


def steps(batch: pa.RecordBatch, text: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most `most` bytes together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    row = 0
    while row < len(batch):
        before = int(ends[row - 1]) if row else 0
        upto = max(int(np.searchsorted(ends, before + most, side="right")), row + 1)
        yield batch.slice(row, upto - row)
        row = upto


def found_words(texts: pa.Array, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal runs of word bytes: their bytes, where each starts there, and its text's row.

    `kept` gives for each byte what it becomes in a word, 0 where it is in none. A null has no words.
    """
    data, starts = utf8(texts)
    mapped = kept[data]
    return runs_of(mapped, mapped != 0, starts)


def runs_of(
    data: np.ndarray, inside: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of bytes that are `inside`, none of which goes on from one row into the next."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][np.diff(starts) > 0]
    begins[edges] = inside[edges]
    first = np.flatnonzero(begins)
    stops = np.append(inside[1:] < inside[:-1], inside[-1:])  # the last byte of a run
    within = edges[edges > 0]
    stops[within - 1] |= inside[within - 1]
    lengths = np.flatnonzero(stops) + 1 - first
    rows = np.searchsorted(starts, first, side="right") - 1
    return data[inside], np.append(0, np.cumsum(lengths)), rows


def coded(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the distinct words in the order of their numbers."""
    encoded = strings(data, places).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
