"""Exact substring deduplication by a depth-limited radix sort of suffixes.

Two suffixes need only be ordered through WIDTH bytes to see whether they begin alike. The first
digit of a suffix is not its first bytes but the gram (GRAM bytes) of least hash among those in its
first WIDTH bytes, its anchor: suffixes that begin with the same window have the same anchor at the
same place, and some thirty suffixes in a row share one. So the first pass sorts runs of suffixes,
drops what is alone in its bucket, and settles runs that are equal as a whole. The second pass sorts
what is left by the digest of the whole window; equal groups are exactly the repeated windows.
"""

import gc
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import workspace
from tierline.llm.columns import spread, utf8

WIDTH = 100
GRAM = 40
PIECE = 1 << 21  # bytes whose suffixes are looked at together
PLACE_BITS = 22
DONE, CHECK, ALONE, SHARED = 0, 1, 2, 3  # what a row of the first pass says of its run

FIRST_PASS = "key bigint, whole bigint, doc bigint, place bigint"
SECOND_PASS = "high bigint, low bigint, doc bigint, place bigint"
MARKS = "doc bigint, place bigint"


def place_of(digest, start, count, kind):
    """Orders runs of one document: 23 bits of its digest, 32 of the start, 6 of the length, 2 of
    the kind."""
    return (digest << 40) | (start << 8) | (count << 2) | kind


def start_of(place):
    return (place >> 8) & 0xFFFFFFFF


def count_of(place):
    return (place >> 2) & 0x3F


def kind_of(place):
    return place & 3


def keyed(documents: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    """The documents with `doc` and `digest`, which order rows and tell them apart, and `body`.

    Rows of one id and text are the same document. A null id becomes a number below all ids, made of
    the text's hash. The digest is 0 but for ids that occur with different texts.
    """
    spark = documents.sparkSession
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = F.xxhash64(body)
    low = F.lit(-(1 << 62)) - hashed.bitwiseAND(F.lit((1 << 62) - 1))
    doc = F.coalesce(F.col(id_col).cast("long"), low)
    place = f"{folder}/ambiguous"
    # From here on no name comes from the table.
    named = documents.select(
        doc.alias("doc"),
        hashed.alias("hashed"),
        body.alias("text"),
        F.struct(*[F.col(f"`{n}`") for n in documents.columns if n != text_col]).alias("row"),
    )
    (
        named.select(F.col("doc").alias("twice"), "hashed")
        .groupBy("twice")
        .agg(F.min("hashed").alias("least"), F.max("hashed").alias("most"))
        .where("least <> most")
        .select("twice")
        .write.parquet(place)
    )
    twice = spark.read.schema("twice bigint").parquet(place)
    digest = F.when(
        F.col("twice").isNotNull(), F.col("hashed").bitwiseAND(F.lit((1 << 23) - 1))
    )
    return named.join(twice, F.col("doc") == F.col("twice"), "left").select(
        "doc", F.coalesce(digest, F.lit(0).cast("long")).alias("digest"), "text", "row"
    )


def _byte_table() -> np.ndarray:
    mixed = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


BYTES = _byte_table()


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` bytes from each position, by doubling."""
    factor, span = np.uint64(0xC2B2AE3D27D4EB4F), 1
    current, found, have = BYTES[data], None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & span:
                if found is None:
                    found, have = current, span
                else:
                    size = len(data) - have - span + 1
                    found, have = found[:size] * factor + current[have : have + size], have + span
            if span * 2 > length:
                break
            current = current[: len(current) - span] * factor + current[span:]
            factor, span = factor * factor + np.uint64(2), span * 2
        found = (found ^ (found >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return found ^ (found >> np.uint64(29))


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    least, span = values, 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    size = len(values) - width + 1
    return np.minimum(least[:size], least[width - span : width - span + size])


def runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text number, first position, windows, hash of the anchor.

    `starts` tells where the texts begin in `data`, which has PIECE bytes and a window at most.
    """
    nothing = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(data) < WIDTH:
        return nothing
    hashes = gram_hashes(data, GRAM)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    anchor = (least_in((hashes & ~low) | place, WIDTH - GRAM + 1) & low).astype(np.int64)
    at = np.arange(len(anchor))
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
    inside = at + WIDTH <= starts[1:][text]
    at, text, anchor = at[inside], text[inside], anchor[inside]
    if not len(at):
        return nothing
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return text[first], at[first], count, hashes[anchor[first]]


def pieces(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """Texts in pieces of bounded size: first text, its offset, bytes, and where texts begin.

    Many short texts make a piece. A long text is cut into several, each WIDTH - 1 bytes into the
    next, so that every window is in exactly one.
    """
    text, count = 0, len(starts) - 1
    while text < count:
        last = int(np.searchsorted(starts, starts[text] + PIECE, "right")) - 1
        if last > text:
            yield text, 0, data[starts[text] : starts[last]], starts[text : last + 1] - starts[text]
            text = last
            continue
        size = int(starts[text + 1] - starts[text])
        for offset in range(0, max(1, size - WIDTH + 1), PIECE):
            end = min(size, offset + PIECE + WIDTH - 1)
            own = data[starts[text] + offset : starts[text] + end]
            yield text, offset, own, np.array([0, len(own)])
        text += 1


def _same(*columns: np.ndarray) -> np.ndarray:
    """Whether a row equals the one before it in all columns."""
    same = np.ones(len(columns[0]), bool)
    same[:1] = False
    for column in columns:
        same[1:] &= column[1:] == column[:-1]
    return same


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _first_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each batch, combined before they are shuffled.

    Of equal runs only the first goes on; the others are repeated for sure. If different runs of the
    batch share an anchor, all are to be checked, and one row tells other batches so. Hence a task
    of the next step gets one or two rows of an anchor from each piece, however common it is.
    """
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        doc, digest = (batch.column(n).to_numpy() for n in ("doc", "digest"))
        for text, offset, own, begins in pieces(data, starts):
            number, at, count, key = runs(own, begins)
            if not len(at):
                continue
            content = own.tobytes()
            digest64 = xxhash.xxh3_64_intdigest
            ends = at + count + WIDTH - 1
            whole = np.fromiter(
                (digest64(content[a:b]) for a, b in zip(at.tolist(), ends.tolist(), strict=True)),
                np.uint64,
                len(at),
            )
            number = number + text
            place = place_of(digest[number], at - begins[number - text] + offset, count, 0)
            order = np.lexsort((place, doc[number], whole, key))
            key, whole = key[order].view(np.int64), whole[order].view(np.int64)
            own_doc, place = doc[number][order], place[order]
            equal = _same(key, whole)
            again = _same(key, whole, own_doc, place)  # the same document, in another row
            group = np.cumsum(~_same(key)) - 1
            several = np.bincount(group, weights=~equal) > 1
            kind = np.where(equal, DONE, np.where(several[group], CHECK, ALONE))
            out = [key, whole, own_doc, place | kind]
            told = np.flatnonzero(~_same(key) & several[group])
            shared = [key[told], whole[told], own_doc[told], place[told] | SHARED]
            kept = ~again
            yield _batch(
                FIRST_PASS,
                *(np.append(a[kept], b) for a, b in zip(out, shared, strict=True)),
            )


def _sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor, run and document: settle each anchor's runs.

    Of equal runs the first stays and the others are done. A first run is checked if its anchor has
    other runs. What is carried from batch to batch is the last row and one run that may be alone.
    """
    last: tuple | None = None  # key, whole, document and place of the row before
    many = False  # whether the last key is known to have several runs
    waiting: tuple | None = None  # the only run of the last key so far
    for batch in batches:
        key, whole, doc, place = (batch.column(n).to_numpy() for n in range(4))
        keep = kind_of(place) >= ALONE
        out = [doc[~keep], place[~keep]]
        key, whole, doc, place = (x[keep] for x in (key, whole, doc, place))
        if not len(key):
            yield _batch(MARKS, *out)
            continue
        skip = int(last is not None)
        if last is not None:
            # The row before this batch comes again, to be compared with; its outcome is not.
            key, whole, doc, place = (
                np.append(np.int64(a), b) for a, b in zip(last, (key, whole, doc, place), strict=True)
            )
        alone = kind_of(place) == ALONE
        where = place >> 2
        same_run = _same(key, whole)
        group = np.cumsum(~_same(key)) - 1
        several = (np.bincount(group, weights=~alone) > 0) | (
            np.bincount(group, weights=~same_run) > 1
        )
        if skip and many:
            several[0] = True
        fresh = np.arange(len(key)) >= skip
        done = same_run & ~_same(key, whole, doc, where) & alone & fresh
        first = ~same_run & alone & fresh
        check = first & several[group]
        marks = np.concatenate([(where[done] << 2) | DONE, (where[check] << 2) | CHECK])
        out = [np.concatenate([out[0], doc[done], doc[check]]), np.append(out[1], marks)]
        if waiting is not None and several[0]:
            out = [np.append(a, b) for a, b in zip(out, waiting, strict=True)]
        if several[0] or group[-1]:
            waiting = None
        open_ = np.flatnonzero(first & (group == group[-1]))
        if len(open_) and not several[-1]:
            waiting = (doc[open_[0]], (where[open_[0]] << 2) | CHECK)
        many = bool(several[-1])
        last = tuple(int(x[-1]) for x in (key, whole, doc, place))
        yield _batch(MARKS, *out)


def _second_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of runs to be checked, by their digests; equal ones of a piece are combined."""
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        doc, digest = (batch.column(n).to_numpy() for n in ("doc", "digest"))
        places = batch.column("places")
        offsets = np.asarray(places.offsets)
        values = np.asarray(places.values, np.int64)
        number = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        values = values[offsets[0] : offsets[-1]]
        start, count = start_of(values), count_of(values)
        content = data.tobytes()
        ends = np.cumsum(count)
        low = 0
        while low < len(values):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + PIECE, "right")))
            part = slice(low, high)
            at = spread(start[part], count[part])
            own = np.repeat(number[part], count[part])
            # The part of the document's key that is in the places of its rows.
            place = place_of(digest[own], at, 1, 0)
            window = xxhash.xxh3_128_digest
            hashed = b"".join(
                window(content[a : a + WIDTH]) for a in (starts[own] + at).tolist()
            )
            halves = np.frombuffer(hashed, np.int64).reshape(-1, 2)
            order = np.lexsort((place, doc[own], halves[:, 1], halves[:, 0]))
            first, second = halves[order, 0], halves[order, 1]
            own_doc, place = doc[own][order], place[order]
            kept = ~_same(first, second, own_doc, place)
            first, second, own_doc, place = (x[kept] for x in (first, second, own_doc, place))
            kind = np.where(_same(first, second), DONE, ALONE)
            yield _batch(SECOND_PASS, first, second, own_doc, place | kind)
            low = high


def _sort_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by window and document: all but the first of a window are repeated."""
    last: list | None = None
    for batch in batches:
        row = [batch.column(n).to_numpy() for n in range(4)]
        keep = kind_of(row[3]) == ALONE
        out = [row[2][~keep], row[3][~keep]]
        row = [x[keep] for x in row]
        if len(row[0]):
            skip = int(last is not None)
            if last is not None:
                row = [np.append(a, b) for a, b in zip(last, row, strict=True)]
            # The same place of a document may come from several tasks, for rows that repeat.
            group = np.cumsum(~_same(row[0], row[1])) - 1
            first = np.searchsorted(group, group)
            repeated = (row[2] != row[2][first]) | (row[3] != row[3][first])
            repeated[:skip] = False
            marks = ((row[3][repeated] >> 2) << 2) | DONE
            out = [np.append(out[0], row[2][repeated]), np.append(out[1], marks)]
            last = [x[first[-1]] for x in row]
        yield _batch(MARKS, *out)


def _release(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go: Spark deletes those of collected garbage.

    Two rounds, since the driver's Python holds on to the plans that the first one frees.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def _marks(spark: SparkSession, frame: DataFrame, place: str) -> DataFrame:
    frame.write.parquet(place)
    _release(spark)
    return spark.read.schema(MARKS).parquet(place)


def _by_document(marks: DataFrame) -> DataFrame:
    """The marked runs of each document; as many as it has bytes, at most."""
    return marks.groupBy(
        F.col("doc").alias("own"), F.shiftright("place", 40).alias("own_digest")
    ).agg(F.collect_list("place").alias("places"))


def _apart(key: str) -> Column:
    """What rows are dealt out by; settled rows need no neighbours and are spread."""
    settled = F.col("place").bitwiseAND(F.lit(3)) <= CHECK
    return F.when(settled, F.xxhash64("doc", "place")).otherwise(F.col(key))


def repeated_runs(texts: DataFrame, folder: str) -> DataFrame:
    """`doc, place` of runs of windows that also begin earlier; `texts` comes from keyed()."""
    spark = texts.sparkSession
    kind = F.col("place").bitwiseAND(F.lit(3))
    runs_ = (
        texts.select("doc", "digest", "text")
        .mapInArrow(_first_digits, FIRST_PASS)
        .repartition(_apart("key"))
        .sortWithinPartitions("key", "whole", "doc", "place")
        .mapInArrow(_sort_runs, MARKS)
    )
    marks = _marks(spark, runs_, f"{folder}/first")
    unsettled = _by_document(marks.where(kind == CHECK).distinct())
    windows = (
        texts.join(
            unsettled, (F.col("doc") == F.col("own")) & (F.col("digest") == F.col("own_digest"))
        )
        .select("doc", "digest", "text", "places")
        .mapInArrow(_second_digits, SECOND_PASS)
        .repartition(_apart("high"))
        .sortWithinPartitions("high", "low", "doc", "place")
        .mapInArrow(_sort_windows, MARKS)
    )
    more = _marks(spark, windows, f"{folder}/second")
    return marks.where(kind == DONE).union(more)


def _cut(batches: Iterator[pa.RecordBatch], content: str | None) -> Iterator[pa.RecordBatch]:
    """Adds what is left of each text, and how much was removed in how many spans."""
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        rest, removed, spans = [], [], []
        for row, places in enumerate(batch.column("places").to_pylist()):
            own = data[starts[row] : starts[row + 1]]
            if not places:
                rest.append(own.tobytes())
                removed.append(0)
                spans.append(0)
                continue
            runs_ = np.array(places, np.int64)
            begin = start_of(runs_)
            end = begin + count_of(runs_) + WIDTH - 1
            change = np.zeros(len(own) + 1, np.int64)
            np.add.at(change, begin, 1)
            np.add.at(change, end, -1)
            gone = np.cumsum(change[:-1]) > 0
            rest.append(own[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
        sizes = np.diff(starts)
        shas = [hashlib.sha256(r).hexdigest() for r in rest]
        if content == "text":
            kept = pa.array([r.decode("utf-8", "ignore") for r in rest], pa.string())
        else:
            kept = pa.array(rest if content else [None] * len(rest), pa.binary())
        columns = [
            kept,
            pa.array(sizes, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(spans, pa.int64()),
            pa.array(shas, pa.string()),
        ]
        others = [batch.column(n) for n in batch.schema.names if n not in ("text", "places")]
        names = [n for n in batch.schema.names if n not in ("text", "places")]
        yield pa.RecordBatch.from_arrays([*others, *columns], names=[*names, *LEFT])


LEFT = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeated(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    content: str | None = "bytes",
) -> DataFrame:
    """`doc_id, kept, n_bytes, n_removed, n_spans, kept_sha256` of every row.

    With `carry` all columns but the text come along as a struct `row`. `kept` is a string without
    halves of characters if `content` is "text", and null if it is None.

    Every byte is removed that a window of 100 bytes covers which also begins earlier: in a document
    with a smaller id, or before in the same one. Windows are of the UTF-8 bytes as given and do not
    reach over the ends of texts, so what is kept may begin or end within a character.

    A null text is empty. Rows with one id and one text are the same document and do not repeat each
    other; rows with one id and different texts are ordered by a hash (23 bits tell them apart). A
    null id is smaller than all ids, which must be over -2^62. Other columns are ignored; texts of
    any length are cut into pieces for the work; no rows give no rows.
    """
    folder = workspace.new_folder(documents.sparkSession, "repeated-windows")
    texts = keyed(documents, id_col, text_col, folder)
    found = _by_document(repeated_runs(texts, folder))
    own_id = F.col(f"row.`{id_col}`").alias("own_id")
    joined = texts.join(
        found, (F.col("doc") == F.col("own")) & (F.col("digest") == F.col("own_digest")), "left"
    ).select(own_id, *["row"] * carry, "text", "places")
    kept = "string" if content == "text" else "binary"
    kinds = dict(zip(LEFT, (kept, "long", "long", "long", "string"), strict=True))
    schema = T.StructType(
        [
            T.StructField(f.name, f.dataType)
            for f in joined.schema
            if f.name not in ("text", "places")
        ]
    )
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    cut = joined.mapInArrow(lambda batches: _cut(batches, content), schema)
    return cut.select(F.col("own_id").alias("doc_id"), *LEFT, *["row"] * carry)
