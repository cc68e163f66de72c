"""Words that differ by one letter, found by Bloom-guided neighbourhoods.

Every word makes its edits, and Bloom filters of the vocabulary say which may be words. Only those
few are shuffled to the vocabulary, where an exact join removes what the filters let through.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.byte_words import coded, runs_of, steps
from tierline.llm.columns import utf8

WORDS = "word string, n bigint"
EDITS = "edit string, word string, n bigint"
BLOCKS = "shard int, block bigint, bits bigint"

#: Lengths from here on share shards, by their remainder: there are at most twice so many shards.
LONG = 64
#: Words to a block of 64 bits. A word sets up to five bits, so about one edit in 200 passes falsely.
BLOCK_WORDS = 4
#: Blocks broadcast at a time (eight bytes each). A vocabulary with more takes several passes.
PASS_BLOCKS = 1 << 21
#: Edits that a task looks at together, and words for which it makes them.
CELLS, STEP_WORDS = 1 << 19, 1 << 14
#: Words a task of the edit stage gets, about.
TASK_WORDS = 20_000

# An odd base makes every power invertible modulo 2^64, so a letter can be taken out of a hash.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _bit_patterns() -> np.ndarray:
    """4,096 blocks with up to five bits, a rule of their numbers."""
    numbers = _mixed(np.arange(1, 4097, dtype=np.uint64) * np.uint64(_BASE))
    patterns = np.zeros(4096, np.uint64)
    for turn in range(5):
        patterns |= np.uint64(1) << ((numbers >> np.uint64(6 * turn)) & np.uint64(63))
    return patterns


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(_MIX[0])
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(_MIX[1])
    return hashes ^ (hashes >> np.uint64(31))


_PATTERNS = _bit_patterns()


def shard_of(length: int) -> int:
    return length if length < LONG else LONG + length % LONG


def _powers(count: int) -> np.ndarray:
    bases = np.full(count, _BASE, np.uint64)
    bases[:1] = 1
    return np.multiply.accumulate(bases)


def _places(hashes: np.ndarray, length: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each word in its shard's filter, and its bits there."""
    mixed = _mixed(hashes + np.uint64(length * _BASE % (1 << 64)))
    return ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), _PATTERNS[
        (mixed & np.uint64(4095)).astype(np.int64)
    ]


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points, a row for each word of this length."""
    return np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length)


def by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """Words of each length: the length, their rows, and the words."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        # Long words are taken a few at a time, so that their letters fit in memory.
        most = max(CELLS // int(length), 1)
        for at in range(0, len(rows), most):
            some = rows[at : at + most]
            yield int(length), some, words.take(pa.array(some)).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], rows: int = STEP_WORDS) -> Iterator[pa.RecordBatch]:
    """Batches of about so many rows each, out of smaller ones."""
    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += len(batch)
        if held >= rows:
            yield pa.concat_batches(waiting)
            waiting, held = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _counter(least: int, every: int):
    """Documents to words and how often they occur, a row for each step of a task."""
    kept = np.zeros(256, np.uint8)
    small = list(b"abcdefghijklmnopqrstuvwxyz")
    kept[small] = kept[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = small

    def counted(part: pa.RecordBatch) -> dict[str, int]:
        data, starts = utf8(part.column("text"))
        # U+00C0 to U+00FF are the characters of two bytes that begin with C3.
        lead = data == 0xC3
        lead[1:] |= lead[:-1]
        mapped = np.where(lead, data, kept[data])
        data, places, rows = runs_of(mapped, mapped != 0, starts)
        accents = np.append(0, np.cumsum(data == 0xC3))
        lengths = np.diff(places) - np.diff(accents[places])
        long = lengths >= least  # a letter less never makes a word longer
        sizes = np.diff(places)
        data = data[np.repeat(long, sizes)]
        places = np.append(0, np.cumsum(sizes[long]))
        numbers, distinct = coded(data, places)
        runs = pc.cast(distinct, pa.large_binary()).to_pylist()
        of_run = np.zeros(len(runs), np.int64)
        of_run[numbers] = lengths[long]
        pairs, times = np.unique(rows[long] * max(len(runs), 1) + numbers, return_counts=True)
        owners, numbers = np.divmod(pairs, max(len(runs), 1))
        ids = part.column("doc_id").to_pylist()
        heads = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
        crcs = np.fromiter(
            map(zlib.crc32, map(runs.__getitem__, numbers.tolist()), map(heads.__getitem__, owners.tolist())),
            np.int64,
            len(numbers),
        )
        cut = crcs % every == 0
        totals = np.bincount(numbers[~cut], times[~cut], minlength=len(runs)).astype(np.int64)
        found = {runs[n].decode(): int(totals[n]) for n in np.flatnonzero(totals).tolist()}
        places = crcs % np.maximum(of_run[numbers], 1)
        for n, place, count in zip(
            numbers[cut].tolist(), places[cut].tolist(), times[cut].tolist(), strict=True
        ):
            run = runs[n].decode()
            if len(run) > least:
                word = run[:place] + run[place + 1 :]
                found[word] = found.get(word, 0) + count
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                found = counted(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                    names=["word", "n"],
                )

    return run


def words_of(
    documents: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    every: int = 31,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Distinct words of all texts with their counts: `word, n`.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Where `every` divides
    the CRC-32 of "<id>:<run>", the run loses the letter at that CRC modulo its length: a misspelling
    that depends on nothing but the document and the word. A null id is empty there.
    """
    return (
        documents.select(
            F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text")
        )
        .mapInArrow(_counter(least_length, every), WORDS)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _bits(sizes: dict[int, int], ranges: dict[int, tuple[int, int]]):
    """Words to the bits they set in the blocks of a pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            for length, _, words in by_length(batch.column("word")):
                shard = shard_of(length)
                if shard not in ranges:
                    continue
                low, high = ranges[shard]
                hashes = (letters(words, length) * _powers(length)).sum(1, np.uint64)
                blocks, bits = _places(hashes, length, sizes[shard])
                own = (blocks >= low) & (blocks < high)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(int(own.sum()), shard, np.int32)),
                        pa.array(blocks[own].astype(np.int64)),
                        pa.array(bits[own].view(np.int64)),
                    ],
                    names=["shard", "block", "bits"],
                )

    return run


def edits_of(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple]:
    """Hashes of all edits of words of one length: (length, rows, places, letters, hashes).

    An edit leaves a letter out (0 in `letters`) or puts a later one of the alphabet in its place:
    of two near words, the longer or the one with the smaller letter makes the other, once.
    """
    words, length = codes.shape
    powers = _powers(length)
    worth = codes * powers
    before = np.cumsum(worth, 1, np.uint64) - worth
    hashes = worth.sum(1, np.uint64)
    # Leaving out any letter of a run of equal ones gives the same word: only the first is left out.
    once = np.ones(codes.shape, bool)
    once[:, 1:] = codes[:, 1:] != codes[:, :-1]
    rows, places = np.nonzero(once)
    for at in range(0, len(rows), CELLS):
        row, place = rows[at : at + CELLS], places[at : at + CELLS]
        head = before[row, place]
        tail = (hashes[row] - head - worth[row, place]) * np.uint64(_INVERSE)
        yield length - 1, row, place, np.zeros(len(row), np.uint64), head + tail
    most = max(CELLS // max(len(alphabet), 1), 1)
    for at in range(0, words * length, most):
        row, place = np.divmod(np.arange(at, min(at + most, words * length)), length)
        old = codes[row, place].astype(np.uint64)
        rest = hashes[row] - worth[row, place]
        later, letter = np.nonzero(alphabet[None, :] > old[:, None])
        new = alphabet[letter]
        yield length, row[later], place[later], new, rest[later] + new * powers[place[later]]


def _prober(filters, alphabet: np.ndarray, sizes: dict[int, int], ranges: dict[int, tuple[int, int]]):
    """Words to those of their edits that the filters of a pass let through."""

    def passed(length: int, hashes: np.ndarray) -> np.ndarray:
        shard = shard_of(length)
        if shard not in ranges:
            return np.zeros(0, np.int64)
        low, high = ranges[shard]
        blocks, bits = _places(hashes, length, sizes[shard])
        if (low, high) == (0, sizes[shard]):
            return np.flatnonzero(filters.value[shard][blocks] & bits == bits)
        own = np.flatnonzero((blocks >= low) & (blocks < high))
        bits = bits[own]
        return own[filters.value[shard][blocks[own] - np.uint64(low)] & bits == bits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches):
            counts = part.column("n").to_numpy()
            for length, own, words in by_length(part.column("word")):
                codes = letters(words, length)
                for target, rows, places, new, hashes in edits_of(codes, alphabet):
                    hits = passed(target, hashes)
                    if len(hits):
                        yield batch_of(words, counts[own], rows[hits], places[hits], new[hits])

    def batch_of(words, counts, rows, places, new) -> pa.RecordBatch:
        sources = [words[row] for row in rows.tolist()]
        edits = [
            word[:place] + (chr(letter) if letter else "") + word[place + 1 :]
            for word, place, letter in zip(sources, places.tolist(), new.tolist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(edits, pa.string()), pa.array(sources, pa.string()), pa.array(counts[rows])],
            names=["edit", "word", "n"],
        )

    return run


def passes(sizes: dict[int, int], most: int = PASS_BLOCKS) -> Iterator[dict[int, tuple[int, int]]]:
    """Ranges of blocks, by shard, that hold at most `most` blocks together and all of them in turn."""
    own, room = {}, most
    for shard, blocks in sorted(sizes.items()):
        low = 0
        while low < blocks:
            high = min(blocks, low + room)
            own[shard] = (low, high)
            room -= high - low
            low = high
            if not room:
                yield own
                own, room = {}, most
    if own:
        yield own


def near_words(vocabulary: DataFrame, most_blocks: int = PASS_BLOCKS) -> DataFrame:
    """Pairs of words of a stored vocabulary that differ by one letter, in both directions.

    `word, n, near, near_n`. Filters are sharded by the length of words. They are broadcast
    `most_blocks` blocks at a time; a larger vocabulary is probed once for each such pass. A word has
    at most as many near words as edits, so no key of the joins is hot.
    """
    spark = vocabulary.sparkSession
    length = F.length("word")
    shard = F.when(length < LONG, length).otherwise(F.lit(LONG) + length % LONG)
    counts = {r.shard: r["count"] for r in vocabulary.groupBy(shard.alias("shard")).count().collect()}
    if not counts:
        empty = "word string, n bigint, near string, near_n bigint"
        return spark.createDataFrame([], empty)
    sizes = {shard: -(-count // BLOCK_WORDS) for shard, count in counts.items()}
    # At most the letters of the words' pattern.
    used = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = np.array(sorted(ord(row.letter) for row in used.collect() if row.letter), np.uint64)
    tasks = max(-(-sum(counts.values()) // TASK_WORDS), 1)
    dealt = vocabulary.repartition(tasks, "word")
    found = None
    for ranges in passes(sizes, most_blocks):
        bits = vocabulary.select("word").mapInArrow(_bits(sizes, ranges), BLOCKS)
        blocks = bits.groupBy("shard", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
        filters = {shard: np.zeros(high - low, np.uint64) for shard, (low, high) in ranges.items()}
        shards, places, bits = (
            blocks.column(name).to_numpy() for name in ("shard", "block", "bits")
        )
        for shard, (low, _) in ranges.items():
            own = shards == shard
            filters[shard][places[own] - low] = bits[own].view(np.uint64)
        shared = spark.sparkContext.broadcast(filters)
        part = dealt.mapInArrow(_prober(shared, alphabet, sizes, ranges), EDITS)
        found = part if found is None else found.unionByName(part)
    known = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    pairs = found.join(known, "edit")
    way = [F.struct(*[F.col(c).alias(a) for c, a in zip(ends, ("word", "n", "near", "near_n"), strict=True)])
           for ends in (("word", "n", "edit", "edit_n"), ("edit", "edit_n", "word", "n"))]
    return pairs.select(F.inline(F.array(*way)))


def with_roots(words: DataFrame, most: int, factor: int) -> DataFrame:
    """Adds `root`, the end of the chain of forms. A form is `factor` times as frequent, so with
    counts up to `most` a chain has few links; each step doubles what is followed."""
    links = max(int(math.log(max(most, 1), factor)), 0) + 1
    ways = words.where("form is not null").select(F.col("word").alias("at"), F.col("form").alias("goal"))
    done = 1
    while done < links:
        further = ways.select(F.col("at").alias("goal"), F.col("goal").alias("further"))
        ways = ways.join(further, "goal", "left").select(
            "at", F.coalesce("further", "goal").alias("goal")
        )
        done *= 2
    ends = ways.select(F.col("at").alias("word"), F.col("goal").alias("root"))
    return words.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    documents: DataFrame, place: str, factor: int = 10, most_blocks: int = PASS_BLOCKS, **choice
) -> DataFrame:
    """Words, their near words and the forms they are variants of: `word, form, root, n, n_near, form_n`.

    Two words are near if one letter is put in, left out or replaced. The form of a word is its most
    frequent near word (of equally frequent ones the first in code point order), if that occurs at
    least `factor` times as often; the root is where the forms lead. `choice` goes to words_of().

    The vocabulary is stored below `place` and kept for the caller; all later steps work on words
    rather than on texts. Null and empty texts have no words, a very long text or word is taken
    whole, rows with equal ids are documents of their own, and without words there are no rows.
    Other columns are ignored.
    """
    spark = documents.sparkSession
    words_of(documents, **choice).write.mode("overwrite").parquet(f"{place}/words")
    vocabulary = spark.read.schema(WORDS).parquet(f"{place}/words")
    near = near_words(vocabulary, most_blocks)
    best = F.min(F.struct((-F.col("near_n")).alias("rare"), "near"))
    sums = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.rare") >= factor * F.col("n"), F.col("best.near"))
    judged = vocabulary.join(sums, "word", "left").select(
        "word",
        form.alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form.isNotNull(), -F.col("best.rare")).alias("form_n"),
    )
    judged.write.mode("overwrite").parquet(f"{place}/judged")
    judged = spark.read.schema(judged.schema).parquet(f"{place}/judged")
    most = judged.agg(F.max("n").alias("n")).first().n
    return with_roots(judged, most or 1, factor).select("word", "form", "root", "n", "n_near", "form_n")
