"""Packing of token sequences by Karmarkar-Karp differencing."""

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.vocabularies import chunk_codes, path_of

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint"
)


def difference(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Deal items out to so many windows of nearly equal sums; multiway Karmarkar-Karp.

    Every item begins as a partition of its own: one window holds it, the rest are empty. The two
    partitions with the largest imbalances are merged, the fullest window of one with the emptiest
    of the other, until a single partition is left. Ties go to the earlier item.
    """
    if windows < 1 or not len(sizes):
        return [[] for _ in range(windows)]
    following = np.full(len(sizes), -1)

    def alone(item: int):
        sums, head = np.zeros(windows, np.int64), np.full(windows, -1)
        sums[0], head[0] = sizes[item], item
        return sums, head, head.copy()

    # Sums are kept in falling order; what all windows have in common does not count.
    heap = [(-int(size), item, None) for item, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        (_, one, a), (_, other, b) = heapq.heappop(heap), heapq.heappop(heap)
        sums, head, tail = a or alone(one)
        more, more_head, more_tail = (x[::-1] for x in b or alone(other))
        joined = (tail >= 0) & (more_head >= 0)
        following[tail[joined]] = more_head[joined]
        sums = sums + more
        head = np.where(head >= 0, head, more_head)
        tail = np.where(more_tail >= 0, more_tail, tail)
        order = np.argsort(-sums, kind="stable")
        sums, head, tail = sums[order], head[order], tail[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), made, (sums - sums[-1], head, tail)))
        made += 1
    heads = (heap[0][2] or alone(heap[0][1]))[1]
    dealt = []
    for item in heads:
        window = []
        while item >= 0:
            window.append(int(item))
            item = following[item]
        dealt.append(window)
    return dealt


def pack(sizes: np.ndarray, capacity: int, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, start, length); sizes are over 0 and at most the capacity.

    The fewest possible windows are tried first. Where differencing leaves some over the capacity,
    the excess is cut off and fills the room in others, the roomiest first; without `cut` the number
    of windows rises until all fit.
    """
    total = int(sizes.sum())
    windows = -(-total // capacity)
    while True:
        dealt = difference(sizes, windows)
        most = max((int(sizes[items].sum()) for items in dealt if items), default=0)
        if most <= capacity or cut:
            break
        windows += 1
    full: list[list[tuple[int, int, int]]] = []
    excess: list[tuple[int, int, int]] = []
    room = []
    for items in dealt:
        window, used = [], 0
        for item in items:
            size = int(sizes[item])
            fits = min(size, capacity - used)
            if fits:
                window.append((item, 0, fits))
            if fits < size:
                excess.append((item, fits, size - fits))
            used += fits
        full.append(window)
        room.append(capacity - used)
    by_room = sorted((n for n, left in enumerate(room) if left), key=lambda n: (-room[n], n))
    for item, start, size in excess:
        while size:
            n = by_room[0]
            fits = min(size, room[n])
            full[n].append((item, start, fits))
            start, size, room[n] = start + fits, size - fits, room[n] - fits
            if not room[n]:
                by_room.pop(0)
    return full


def _packer(path: str, capacity: int, end_id: int, at_once: int):
    def sequences(documents: list[tuple]) -> Iterator[list[tuple]]:
        """The pieces of each sequence over these documents (id, token ids)."""
        rest, where = [], []
        for n, (_, ids) in enumerate(documents):
            whole = len(ids) // capacity * capacity
            for start in range(0, whole, capacity):
                yield [(n, start, capacity)]
            if len(ids) > whole:
                rest.append(len(ids) - whole)
                where.append((n, whole))
        for window in pack(np.array(rest, np.int64), capacity):
            yield [
                (where[item][0], where[item][1] + start, length) for item, start, length in window
            ]

    def packed(documents: list[tuple], sequence_id: int) -> tuple[pa.RecordBatch, int]:
        rows = []
        for pieces in sequences(documents):
            offset = 0
            for n, start, length in pieces:
                doc_id, ids = documents[n]
                crc = zlib.crc32(ids[start : start + length].tobytes())
                rows.append((doc_id, start, length, crc, len(ids), sequence_id, offset))
                offset += length
            sequence_id += 1
        names = [field.split()[0] for field in PIECES.split(", ")]
        columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names), sequence_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = chunk_codes(path)
        sequence_id = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        held = 0
        for batch in batches:
            ids, starts = codes.ids(batch.column("text"))
            for n, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[starts[n] : starts[n + 1]], np.uint32(end_id)).astype("<u4")
                waiting.append((doc_id, own))
                held += len(own)
                if len(waiting) >= at_once or held >= at_once * capacity * 2:
                    out, sequence_id = packed(waiting, sequence_id)
                    yield out
                    waiting, held = [], 0
        if waiting:
            yield packed(waiting, sequence_id)[0]

    return run


def pack_documents(
    documents: DataFrame,
    vocabulary: str | None = None,
    capacity: int = 1024,
    end_id: int = 0,
    at_once: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut and pack whole documents into sequences of at most `capacity` tokens.

    One row for each piece: `doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`.
    A document's ids are those of its text (null: empty) and `end_id`. Full sequences are cut off
    first; what is left of up to `at_once` documents is dealt out by differencing, so a task holds
    the ids of that many documents (fewer if they are long) and nothing is shuffled. A sequence
    that is not full is to be padded; that is under one sequence for each `at_once` documents.

    Sequence ids hold the partition and a running number: they are unique, not gapless. A task that
    runs again gives the same pieces if its rows come in the same order, as from files. Null and
    repeated ids are packed like others, a row each; other columns are ignored; no rows, no pieces.
    """
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_packer(vocabulary or path_of(DEFAULT_VOCABULARY), capacity, end_id, at_once), PIECES)
