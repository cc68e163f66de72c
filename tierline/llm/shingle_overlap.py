"""Near-duplicate texts by the overlap of their word shingles.

Fingerprints (see fuzzy_hashing) and MinHash keys find what is compared.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline import workspace
from tierline.llm.components import EDGES, components
from tierline.llm.fuzzy_hashing import near_duplicates, roots

SEED = 42
WORDS = 5
LEAST = 0.8
# Two texts that share four fifths of their shingles miss all keys in one of 150,000 cases.
BANDS, ROWS = 30, 5
#: Texts of a key that are compared in one task.
BLOCK_ROWS = 500

_FACTORS = np.random.Generator(np.random.Philox(key=[SEED, WORDS])).integers(
    0, 1 << 63, BANDS * ROWS, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, in order.

    A-Z are lower-cased, words are what ASCII white space separates, and shingles are five words
    in a row (fewer words: all of them). A text without words has one shingle, the empty one.
    """
    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    count = max(1, len(words) - WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends + 1)[:count].tolist()
    stops = ends[min(WORDS, len(words)) - 1 :].tolist() if words else [0]
    digest = xxhash.xxh64_intdigest
    found = (digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True))
    return np.unique(np.fromiter(found, np.uint64, count))


def keys_of(hashes: np.ndarray) -> np.ndarray:
    """A key for each band: the hash of the least shingles under its permutations."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), 1 << 12):
        mixed = hashes[low : low + (1 << 12)] * _FACTORS[:, None]
        least = np.minimum(least, mixed.min(axis=1))
    bands = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), n) for n, band in enumerate(bands)]
    return np.array(keys, np.uint64).view(np.int64)


def _keyed(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, first = np.unique(batch.column("mark").to_numpy(), return_index=True)
            texts = batch.column("text").take(pa.array(first)).to_pylist()
            keys = np.array([keys_of(shingles(t)) for t in texts], np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.repeat(marks, BANDS))], names=["key", "mark"]
            )

    return texts.mapInArrow(run, "key bigint, mark bigint")


def _fingerprint_keys(texts: DataFrame) -> DataFrame:
    """A key for each group of fingerprints that links of few bits reach, with the marks of its texts."""
    found = near_duplicates(texts, id_col="mark")
    key = F.xxhash64(F.lit("fingerprints"), "component_id").alias("key")
    return found.select(key, F.col("doc_id").alias("mark"))


def _sets(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t).view(np.int64) for t in batch.column("text").to_pylist()]
            hashes = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("mark"), hashes], names=["mark", "hashes"])

    return texts.mapInArrow(run, "mark bigint, hashes array<bigint>")


def links(sets: list[np.ndarray], least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join all sets linked by a Jaccard similarity of `least`, directly or by others.

    Only pairs that are joined already are not compared.
    """
    sizes = np.array([len(s) for s in sets])
    starts = np.append(0, np.cumsum(sizes))
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = np.arange(len(sets))
    for n in range(len(sets) - 1):
        if (label == label[0]).all():
            break
        own = np.zeros(len(distinct), np.int64)
        own[codes[starts[n] : starts[n + 1]]] = 1
        shared = np.add.reduceat(own[codes[starts[n + 1] :]], starts[n + 1 : -1] - starts[n + 1])
        union = sizes[n] + sizes[n + 1 :] - shared
        found = n + 1 + np.flatnonzero(shared >= least * union - 1e-9)
        found = found[label[found] != label[n]]
        if len(found):
            a, b = np.append(a, np.full(len(found), n)), np.append(b, found)
            label = roots(len(sets), a, b)
            b = np.flatnonzero(label != np.arange(len(sets)))
            a = label[b]
    return a, b


def _linker(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, marks, sets = None, [], []
        edges: list[np.ndarray] = []

        def settle() -> None:
            if len(marks) > 1:
                a, b = links(sets, least)
                edges.append(np.array(marks, np.int64)[np.stack([a, b])])

        def out() -> pa.RecordBatch:
            both = np.concatenate([np.zeros((2, 0), np.int64), *edges], axis=1)
            edges.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in both], names=["a", "b"])

        for batch in batches:
            own = [batch.column(n).to_pylist() for n in ("key", "low", "high", "mark")]
            for row, (key, low, high, mark) in enumerate(zip(*own, strict=True)):
                if (key, low, high) != cell:
                    settle()
                    cell, marks, sets = (key, low, high), [], []
                marks.append(mark)
                sets.append(np.array(batch.column("hashes")[row].values, np.int64))
            yield out()
        settle()
        yield out()

    return run


def _linked(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Edges a, b among the rows of each cell (key, low, high); stored."""
    spark = members.sparkSession
    place = workspace.new_folder(spark, "shingle-links")
    cell = ["key", "low", "high"]
    (
        members.select(*cell, "mark")
        .join(sets, "mark")
        .repartition(*cell)
        .sortWithinPartitions(*cell)
        .mapInArrow(_linker(least), EDGES)
        .write.parquet(place)
    )
    return spark.read.schema(EDGES).parquet(place)


def link_texts(texts: DataFrame, least: float = LEAST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`node, root` of every mark that is linked to another; texts have a `mark` and a `text`.

    Texts whose fingerprints are linked (see near_duplicates()), or with a MinHash key in common, are
    compared by their whole sets of shingles, those of a large key in blocks; keys with the same texts are taken once. Blocks of a key meet each other only where its
    texts are not joined yet, so that a large group of near copies costs no more than its rows.
    """
    spark = texts.sparkSession
    place = workspace.new_folder(spark, "shingle-keys")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{place}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{place}/{name}")

    keyed = stored(_keyed(texts).union(_fingerprint_keys(texts)).distinct(), "keyed")
    groups = (
        keyed.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("mark").cast("decimal(38,0)")).alias("sum"),
        )
        .where("n > 1")
        .groupBy("n", "sum")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("n") / block_rows).alias("blocks"))
    )
    members = stored(
        keyed.join(groups, "key").select(
            "key", "mark", "blocks", F.pmod(F.xxhash64("mark"), "blocks").alias("low")
        ),
        "members",
    )
    chosen = members.select("mark").distinct()
    once = texts.join(chosen, "mark", "left_semi").groupBy("mark").agg(F.first("text").alias("text"))
    sets = stored(_sets(once), "sets")
    edges = _linked(members.withColumn("high", F.col("low")), sets, least)
    linked = components(edges)
    large = members.where("blocks > 1")
    if large.isEmpty():
        return linked
    root = F.coalesce("root", "mark")
    apart = (
        large.join(linked, F.col("mark") == F.col("node"), "left")
        .groupBy("key")
        .agg(F.min(root).alias("one"), F.max(root).alias("other"))
        .where("one <> other")
        .select("key")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (
        large.join(apart, "key")
        .withColumn("other", other)
        .where("low <> other")
        .select("key", "mark", F.least("low", "other").alias("low"), F.greatest("low", "other").alias("high"))
    )
    return components(edges.union(_linked(met, sets, least)))


def first_of_similar(
    documents: DataFrame,
    least: float = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`first`: the smallest id of each group of documents that links reach; each once.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is
    `least` or more; see shingles(). Equal texts (64-bit hashes) count as one from the start, and
    texts without words are alike. Null ids are never the smallest, and groups without any id have no
    row; no rows give no rows.
    """
    spark = documents.sparkSession
    place = workspace.new_folder(spark, "marks")
    texts = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    texts.groupBy("mark").agg(F.min("doc_id").alias("first")).write.parquet(place)
    marks = spark.read.schema("mark bigint, first bigint").parquet(place)
    linked = link_texts(texts.select("mark", "text"), least, block_rows)
    return (
        marks.join(linked, F.col("mark") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "mark").alias("root"))
        .agg(F.min("first").alias("first"))
        .where("first IS NOT NULL")
        .select("first")
        .distinct()
    )
