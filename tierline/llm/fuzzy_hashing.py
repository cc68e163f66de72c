"""Near-duplicate texts: SimHash fingerprints, found by Golay codewords of their segments."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline import workspace
from tierline.llm import golay
from tierline.llm.components import EDGES, components

SEED = 42
WORDS = 4
MOST_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length; each fits a codeword


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text.

    A-Z are lower-cased, words are what ASCII white space separates, and shingles are four words
    in a row, repeats included (fewer words: all of them). A bit is 1 if more than half of the
    shingles' hashes have it; without words it is 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - WORDS + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[:count].tolist()
    stops = ends[min(WORDS, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, count, 1 << 16):
        part = zip(starts[low : low + (1 << 16)], stops[low : low + (1 << 16)], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > count, bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(documents: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """`doc_id, fingerprint bigint` of every row; see fingerprint()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))],
                names=["doc_id", "fingerprint"],
            )

    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, "doc_id bigint, fingerprint bigint")


def keys_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key and position of all keys of 64-bit fingerprints: two within four bits share one.

    Four errors on three segments leave one of two cases.
    - A segment has none. Of the two others, one has two at most, so that its near codewords include
      one of the other fingerprint's. The key is that codeword and the whole segment without error.
    - All have some: two of them one each, the third one or two. One fingerprint's own codeword of
      the first and a near one of the second are a key of the other too, as it gives its near
      codewords of the first with its own of the second. Of three parts of the third segment, one is
      without error and goes into the key.
    """
    values = values.astype(np.uint64)
    parts = [
        (values >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64)
        for at, size in SEGMENTS
    ]
    own = [golay.indices()[part].astype(np.int64) for part in parts]
    near = [golay.near(part, size) for part, (_, size) in zip(parts, SEGMENTS, strict=True)]
    keys, rows = [], []

    def add(kind: int, exact: np.ndarray, words: np.ndarray) -> None:
        """`words` holds codewords in rows, -1 for none."""
        row, column = np.nonzero(words >= 0)
        keys.append((exact[row] << 28) + (words[row, column] << 4) + kind)
        rows.append(row)

    for first in range(3):
        second, third = (first + 1) % 3, (first + 2) % 3
        add(first, parts[first], near[second])
        add(first + 3, parts[first], near[third])
        forward = np.where(near[second] < 0, -1, own[first][:, None] * 4096 + near[second])
        # The pair of own codewords is in there already.
        rest = (near[first] < 0) | (near[first] == own[first][:, None])
        backward = np.where(rest, -1, near[first] * 4096 + own[second][:, None])
        both = np.concatenate([forward, backward], axis=1)
        for part, (low, size) in enumerate(((0, 7), (7, 7), (14, 8))):
            add(6 + 3 * first + part, parts[third] >> low & ((1 << size) - 1), both)
    return np.concatenate(keys), np.concatenate(rows)


def _keyed(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fingerprint").to_numpy()
            keys, rows = keys_of(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(values[rows])], names=["key", "fingerprint"]
            )

    return distinct.select("fingerprint").mapInArrow(run, "key bigint, fingerprint bigint")


def roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each of `count` positions is linked to by edges a-b."""
    label = np.arange(count)
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def links(group: np.ndarray, values: np.ndarray, most_bits: int, room: int = 1 << 21):
    """Pairs that join all values that are linked within their group; rows lie group by group.

    Every pair of a group is compared. Only a spanning forest is kept, so that a group of n linked
    values gives n - 1 pairs; `room` bounds the pairs held meanwhile.
    """
    count = len(values)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    live = np.arange(count)
    shift = 1
    while len(live):
        live = live[live + shift < count]
        live = live[group[live] == group[live + shift]]
        far = np.bitwise_count(values[live] ^ values[live + shift])
        found = live[far <= most_bits]
        a, b = np.append(a, found), np.append(b, found + shift)
        if len(a) > room:
            root = roots(count, a, b)
            b = np.flatnonzero(root != np.arange(count))
            a = root[b]
        shift += 1
    root = roots(count, a, b)
    b = np.flatnonzero(root != np.arange(count))
    return root[b], b


FOUND = "a bigint, b bigint, key bigint, block bigint, members array<bigint>"


def _edges(group: np.ndarray, values: np.ndarray, most_bits: int) -> np.ndarray:
    a, b = links(group, values.view(np.uint64), most_bits)
    return np.unique(np.stack([values[a], values[b]], axis=1), axis=0)


def _linker(most_bits: int, block_rows: int, rows_at_once: int):
    def found(edges: np.ndarray, blocks: list[tuple]) -> pa.RecordBatch:
        none = [None] * len(blocks)
        keys, numbers, members = zip(*blocks, strict=True) if blocks else ((), (), ())
        empty = [None] * len(edges)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*edges[:, 0].tolist(), *none], pa.int64()),
                pa.array([*edges[:, 1].tolist(), *none], pa.int64()),
                pa.array([*empty, *keys], pa.int64()),
                pa.array([*empty, *numbers], pa.int64()),
                pa.array([*empty, *members], pa.list_(pa.int64())),
            ],
            names=["a", "b", "key", "block", "members"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        large, block = None, 0  # a key whose first blocks are out, and how many

        def settle(last: bool) -> pa.RecordBatch:
            """Compare the keys that are complete; give out the large ones in blocks."""
            nonlocal parts, held, large, block
            key, values = (np.concatenate(x) for x in zip(*parts, strict=True))
            end = len(key) if last else int(np.searchsorted(key, key[-1]))
            first = np.flatnonzero(np.append(True, key[1:end] != key[: end - 1])) if end else []
            sizes = np.diff(np.append(first, end)).astype(np.int64)
            big = sizes > block_rows
            if end and large is not None:
                big[0] |= key[0] == large
            blocks = []
            for start, size in zip(np.asarray(first)[big], sizes[big], strict=True):
                if large != key[start]:
                    large, block = int(key[start]), 0
                for low in range(start, start + size, block_rows):
                    high = min(low + block_rows, start + size)
                    blocks.append((large, block, values[low:high].tolist()))
                    block += 1
            small = np.repeat(~big, sizes)
            edges = _edges(key[:end][small], values[:end][small], most_bits)
            rest, tail = key[end:], values[end:]
            if len(rest) > block_rows:  # the last key may go on, and is large already
                if large != rest[0]:
                    large, block = int(rest[0]), 0
                whole = len(rest) // block_rows * block_rows
                for low in range(0, whole, block_rows):
                    blocks.append((large, block, tail[low : low + block_rows].tolist()))
                    block += 1
                rest, tail = rest[whole:], tail[whole:]
            parts, held = ([(rest, tail)] if len(rest) else []), len(rest)
            return found(edges, blocks)

        for batch in batches:
            parts.append((batch.column("key").to_numpy(), batch.column("fingerprint").to_numpy()))
            held += batch.num_rows
            if held >= rows_at_once:
                yield settle(last=False)
        if held:
            yield settle(last=True)

    return run


def _pair_linker(most_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, other in zip(*(batch.column(n).to_pylist() for n in range(2)), strict=True):
                values = np.unique(np.array(one + other, np.int64))
                edges = _edges(np.zeros(len(values), np.int64), values, most_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"]
                )

    return run


def link_fingerprints(
    distinct: DataFrame,
    most_bits: int = MOST_BITS,
    block_rows: int = 1000,
    rows_at_once: int = 1 << 16,
) -> DataFrame:
    """Edges a, b (bigint) that join all distinct fingerprints at `most_bits` or fewer bits.

    Rows are dealt out by key and sorted; a fingerprint gives a key one of its about 119 rows, so no
    key has more than a hundredth of all rows. The fingerprints of a key are compared with each
    other where they are, if there are `block_rows` or fewer. A larger key leaves its task in blocks,
    and each two blocks of it meet in a row of a second step, dealt out by key and both numbers, so
    that all pairs are compared, whatever the size, by many tasks. Not the pairs but a spanning forest comes out. Chance meetings of unrelated
    fingerprints grow with the square of their number, at about one in 700,000 pairs.
    """
    spark = distinct.sparkSession
    if most_bits > MOST_BITS:
        raise ValueError(f"keys are made for {MOST_BITS} bits at most")
    place = workspace.new_folder(spark, "linked-keys")
    tasks = max(1, -(-distinct.count() // 20_000))  # some 2.4 million keys each
    (
        _keyed(distinct.select("fingerprint").repartition(tasks, "fingerprint"))
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_linker(most_bits, block_rows, rows_at_once), FOUND)
        .write.parquet(place)
    )
    found = spark.read.schema(FOUND).parquet(place)
    blocks = found.where("key IS NOT NULL").select("key", "block", "members")
    numbers = blocks.groupBy("key").agg(F.max("block").alias("last"))
    # Two blocks of a key meet by their numbers, not by the key, which may have most of them.
    lower = blocks.join(numbers, "key").select(
        "key",
        F.col("block").alias("low"),
        F.explode(F.sequence("block", "last")).alias("high"),
        "members",
    )
    upper = blocks.select(
        "key",
        F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("low"),
        F.col("block").alias("high"),
        F.col("members").alias("members2"),
    )
    met = lower.join(upper, ["key", "low", "high"]).select("members", "members2")
    return found.where("key IS NULL").select("a", "b").union(
        met.mapInArrow(_pair_linker(most_bits), EDGES)
    )


def near_duplicates(
    documents: DataFrame,
    most_bits: int = MOST_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, fingerprint, component_id` of every row.

    Fingerprints at `most_bits` or fewer differing bits are linked; a component is what links
    reach, named by its smallest id. Equal fingerprints count as one from the start, so a group of
    exact copies costs no comparisons.

    Null texts and texts without words have fingerprint 0, linked like any other. Null ids are
    never the smallest, and a component of null ids alone has a null name. Repeated rows stay;
    other columns are ignored; no rows give no rows.
    """
    spark = documents.sparkSession
    place = workspace.new_folder(spark, "fingerprints")
    fingerprints(documents, id_col, text_col).write.parquet(f"{place}/all")
    own = spark.read.schema("doc_id bigint, fingerprint bigint").parquet(f"{place}/all")
    own.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).write.parquet(f"{place}/distinct")
    distinct = spark.read.schema("fingerprint bigint, first bigint").parquet(f"{place}/distinct")
    linked = components(link_fingerprints(distinct, most_bits))
    rooted = distinct.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint").alias("mark"),
        F.coalesce("root", "fingerprint").alias("root"),
        "first",
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    rooted.join(names, "root").select("mark", "component_id").write.parquet(f"{place}/names")
    named = spark.read.schema("mark bigint, component_id bigint").parquet(f"{place}/names")
    return own.join(named, F.col("fingerprint") == F.col("mark")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
