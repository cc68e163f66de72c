"""Encode long texts by their distinct chunks.

A tokenizer whose tokens never reach from a visible character into the space after it gives a text
the tokens of its parts, cut before such spaces. Words recur, so most parts are known already.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tierline.llm.columns import spread, strings, utf8


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks start: at each text, and at each space after a character known to be visible.

    Visible here: printable ASCII, and the two-byte letters that begin with byte C3. After anything
    else the chunk goes on, which is always right, only longer.
    """
    first = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        before = data[:-1]
        visible = (before > 0x20) & (before < 0x7F)
        visible[1:] |= (before[1:] >= 0x80) & (before[:-1] == 0xC3)
        first[1:-1] = visible & (data[1:] == 0x20)
    first[starts] = True
    first[len(data)] = False
    return np.flatnonzero(first)


def finer_cuts(data: np.ndarray, starts: np.ndarray, joined: bytes) -> np.ndarray:
    """cuts(), and those between words, punctuation and line breaks.

    For tokenizers that first split a text into runs of letters, of digits, of other characters and
    of white space, with one space before a run. A run of letters ends at punctuation, and any run
    before a line break; a single break between a visible character and a letter is a run too. The
    bytes `joined` occur in special strings, which stay whole.
    """
    kinds = np.zeros(256, np.uint8)  # 1: letter, 2: punctuation, 4: visible ASCII
    kinds[0x21:0x7F] = 6
    for first, last in ((b"0", b"9"), (b"A", b"Z"), (b"a", b"z")):
        kinds[first[0] : last[0] + 1] = 4 if first == b"0" else 5
    kinds[list(joined)] &= 5
    kind = kinds[data]
    coarse = cuts(data, starts)
    if len(data) < 3:
        return coarse
    letter = (kind & 1).astype(bool)
    two = np.zeros(len(data), bool)
    two[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    visible = (kind & 4).astype(bool) | two
    line = data == 0x0A
    first = np.zeros(len(data), bool)
    first[coarse] = True
    first[1:] |= (letter | two)[:-1] & (kind & 2).astype(bool)[1:]
    first[1:] |= visible[:-1] & line[1:]
    own = line[1:-1] & visible[:-2] & letter[2:]
    own &= ~_starts_within(starts, len(data))[1:-1]  # the visible character is of the same text
    first[2:] |= own
    return np.flatnonzero(first)


def _starts_within(starts: np.ndarray, size: int) -> np.ndarray:
    marks = np.zeros(size + 1, bool)
    marks[starts] = True
    return marks[:size]


class ChunkCodes:
    """Token ids of whole texts, with a bounded memory of chunks seen before."""

    def __init__(
        self,
        encode: Callable[[list[str]], list],
        capacity: int = 600_000,
        cut: Callable[[np.ndarray, np.ndarray], np.ndarray] = cuts,
    ) -> None:
        """`encode` gives the ids of each string of a list.

        Beyond `capacity` chunks (some 200 bytes each), or 64 bytes of text for each, all are
        forgotten and learned anew. `cut` tells where chunks start.
        """
        self._encode, self._capacity, self._cut = encode, capacity, cut
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._held = 0
        self._ids = np.zeros(1 << 16, np.uint32)
        self._ends = np.zeros(1 << 12, np.int64)  # chunk c has the ids from ends[c] to ends[c + 1]

    def _learn(self, chunks: list[str]) -> None:
        count, filled = len(self._known), int(self._ends[len(self._known)])
        rows = self._encode(chunks)
        ends = filled + np.cumsum([len(row) for row in rows])
        while len(self._ids) < ends[-1]:
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while len(self._ends) < count + len(rows) + 1:
            self._ends = np.concatenate([self._ends, np.zeros_like(self._ends)])
        self._ends[count + 1 : count + 1 + len(rows)] = ends
        self._ids[filled : ends[-1]] = np.fromiter(
            (i for row in rows for i in row), np.uint32, int(ends[-1]) - filled
        )
        self._known.update(zip(chunks, range(count, count + len(rows)), strict=True))
        self._held += sum(map(len, chunks))

    def _codes(self, chunks: list[str]) -> np.ndarray:
        if len(self._known) > self._capacity or self._held > 64 * self._capacity:
            self._forget()
        known = self._known
        unknown = [chunk for chunk in chunks if chunk not in known]
        if unknown:
            self._learn(unknown)
        return np.fromiter(map(self._known.__getitem__, chunks), np.int64, len(chunks))

    def _chunked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The code of each chunk, and the place of each text's first chunk."""
        data, starts = utf8(texts)
        first = self._cut(data, starts)
        pieces = strings(data, np.append(first, len(data))).dictionary_encode()
        distinct = self._codes(pieces.dictionary.to_pylist())
        return distinct[pieces.indices.to_numpy()], np.searchsorted(first, starts)

    def count(self, texts: pa.Array) -> np.ndarray:
        """How many tokens each text has."""
        codes, places = self._chunked(texts)
        lengths = self._ends[codes + 1] - self._ends[codes]
        return np.diff(np.append(0, np.cumsum(lengths))[places])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start (one entry more)."""
        codes, places = self._chunked(texts)
        starts = self._ends[codes]
        lengths = self._ends[codes + 1] - starts
        ids = self._ids[spread(starts, lengths)]
        return ids, np.append(0, np.cumsum(lengths))[places]
