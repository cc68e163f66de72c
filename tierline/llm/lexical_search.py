"""Ranked lexical search that scores every class of documents with equal bags once.

Of a document only the counts of terms that an item asks for matter, and its length by way of the
integer m. Documents with equal counts and equal m form a class: all have the same score for every
item, so a class is scored once and its members follow in the order of their ids.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.byte_words import coded, found_words, steps
from tierline.llm.columns import spread

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Items of a block have at most so many distinct terms, bytes of terms, and are at most so many:
#: that is what a task holds of them. Each block is one pass over the documents.
BLOCK_TERMS, BLOCK_BYTES, BLOCK_ITEMS = 200_000, 1 << 24, 20_000
#: Cells (class, item), and postings times items, that are added up at a time.
CELLS = 1 << 21
#: Stands for a null id, which comes after all others.
NO_ID = (1 << 63) - 1

BAG = "doc_id bigint, terms bigint, codes array<int>, counts array<int>"
FOUND = "item bigint, item_id bigint, doc_id bigint, score bigint"


def _term_bytes() -> np.ndarray:
    kept = np.arange(256, dtype=np.uint8)
    kept[:0x80] = 0
    for letters in ("0123456789", LOWER):
        kept[list(letters.encode())] = list(letters.encode())
    kept[list(UPPER.encode())] = list(LOWER.encode())
    return kept


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    terms = F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))
    return (
        items.select(F.col(item_col).cast("long").alias("item_id"), F.explode(terms).alias("term"))
        .groupBy("item_id")
        .agg(F.collect_set("term").alias("terms"))
    )


def item_blocks(
    item_terms: DataFrame,
    most_terms: int = BLOCK_TERMS,
    most_bytes: int = BLOCK_BYTES,
    most_items: int = BLOCK_ITEMS,
) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items in blocks of a bounded size, one item at least; the driver holds one block at a time."""
    block, seen, size = [], set(), 0
    for item_id, terms in item_terms.toLocalIterator():
        new = set(terms) - seen
        more = sum(len(term.encode()) for term in new)
        full = len(seen) + len(new) > most_terms or size + more > most_bytes
        if block and (full or len(block) == most_items):
            yield block
            block, seen, size = [], set(), 0
            new, more = set(terms), sum(len(term.encode()) for term in terms)
        block.append((item_id, terms))
        seen |= new
        size += more
    if block:
        yield block


def _bagger(vocabulary):
    """Documents to their numbers of terms and the counts of the terms in the vocabulary."""
    kept = _term_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(vocabulary.value, pa.large_string())
        for batch in batches:
            for part in steps(batch):
                data, places, rows = found_words(part.column("text"), kept)
                numbers, distinct = coded(data, places)
                codes = pc.fill_null(pc.index_in(distinct, wanted), -1).to_numpy()[numbers]
                of_item = codes >= 0
                bags, counts = np.unique(
                    rows[of_item] * len(wanted) + codes[of_item], return_counts=True
                )
                owners, codes = np.divmod(bags, len(wanted))
                ends = np.searchsorted(owners, np.arange(len(part) + 1))
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(values.astype(np.int32))
                    )
                    for values in (codes, counts)
                ]
                terms = np.bincount(rows, minlength=len(part))
                out = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(terms, pa.int64()), *lists],
                    names=["doc_id", "terms", "codes", "counts"],
                )
                yield out.filter(pa.array(terms > 0))

    return run


def classes_of(bags: DataFrame, k: int) -> DataFrame:
    """Documents with equal (m, codes, counts) as one row with the k smallest ids of its members.

    Rows meet by a hash and are the same class only if the vectors are: both are in the key. No task
    sends more than k rows of a class (a WindowGroupLimit before the shuffle), however large it is.
    """
    key = ["mark", "m", "codes", "counts"]
    marked = bags.withColumn("mark", F.xxhash64("m", "codes", "counts"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id"))
    return (
        marked.withColumn("place", place)
        .where(F.col("place") <= k)
        .groupBy(*key)
        .agg(F.collect_list("doc_id").alias("members"))
    )


class _Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(items)  # scores below it do not count; 0 never does
        self.items = self.docs = np.zeros(0, np.int64)
        self.scores = np.zeros(0)

    def add(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        items, docs, scores = (
            np.concatenate(pair)
            for pair in ((self.items, items), (self.docs, docs), (self.scores, scores))
        )
        order = np.lexsort((docs, -scores, items))
        items, docs, scores = items[order], docs[order], scores[order]
        place = np.arange(len(items)) - np.searchsorted(items, items)
        kept = place < self.k
        self.items, self.docs, self.scores = items[kept], docs[kept], scores[kept]
        last = place == self.k - 1
        self.least[items[last]] = scores[last]


def _scorer(weights_and_items, k: int):
    """Classes to the k best documents of each item among them."""

    def parts(costs: np.ndarray, items: int) -> Iterator[tuple[int, int]]:
        most = max(CELLS // items, 1)
        ends, row = np.cumsum(costs), 0
        while row < len(costs):
            before = int(ends[row - 1]) if row else 0
            upto = int(np.searchsorted(ends, before + CELLS, side="right"))
            upto = min(max(upto, row + 1), row + most)
            yield row, upto
            row = upto

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The items that ask for a code lie between asked[code] and asked[code + 1].
        weights, asked, items, ids = weights_and_items.value
        best = _Best(int(items.max(initial=0)) + 1, k)
        width = len(best.least)
        for batch in batches:
            m = batch.column("m").to_numpy()
            codes = batch.column("codes").flatten().to_numpy()
            counts = batch.column("counts").flatten().to_numpy().astype(np.int64)
            sizes = pc.list_value_length(batch.column("codes")).to_numpy()
            members = batch.column("members").flatten().to_numpy()
            n_members = pc.list_value_length(batch.column("members")).to_numpy()
            first = np.append(0, np.cumsum(sizes))
            first_member = np.append(0, np.cumsum(n_members))
            rows = np.repeat(np.arange(len(batch)), sizes)
            values = weights[codes] * (1_000_000_000 * counts // (1000 * counts + 8 * m[rows]))
            reach = asked[codes + 1] - asked[codes]
            costs = np.add.reduceat(np.append(reach, 0), first[:-1])
            for start, stop in parts(costs, width):
                at = slice(first[start], first[stop])
                cells = np.repeat((rows[at] - start) * width, reach[at])
                cells += items[spread(asked[codes[at]], reach[at])]
                # Sums of doubles are exact here: a weight is under 45,000, its factor under 10^6,
                # and an item of a block has at most 200,000 terms, which is below 2^53.
                sums = np.bincount(
                    cells, np.repeat(values[at], reach[at]), minlength=(stop - start) * width
                ).reshape(-1, width)
                least = best.least
                if len(sums) > k:
                    least = np.maximum(least, np.partition(sums, len(sums) - k, axis=0)[-k])
                own, item = np.nonzero(sums >= least)
                owned = n_members[own + start]
                best.add(
                    np.repeat(item, owned),
                    members[spread(first_member[own + start], owned)],
                    np.repeat(sums[own, item], owned),
                )
        docs, nothing = pa.array(best.docs), pa.scalar(None, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.items),
                pa.array(ids, pa.int64()).take(pa.array(best.items)),
                pc.if_else(pc.equal(docs, NO_ID), nothing, docs),
                pa.array(best.scores.astype(np.int64)),
            ],
            names=["item", "item_id", "doc_id", "score"],
        )

    return run


def _search_block(texts: DataFrame, block: list, place: str, k: int) -> DataFrame | None:
    spark = texts.sparkSession
    vocabulary = sorted({term for _, terms in block for term in terms})
    shared = spark.sparkContext.broadcast(vocabulary)
    texts.mapInArrow(_bagger(shared), BAG).write.mode("overwrite").parquet(place)
    bags = spark.read.schema(BAG).parquet(place)
    held = bags.agg(F.count("*").alias("texts"), F.sum("terms").alias("terms")).first()
    if not held.texts:
        return None
    holders = np.zeros(len(vocabulary), np.int64)
    for code, count in bags.select(F.explode("codes").alias("code")).groupBy("code").count().collect():
        holders[code] = count
    weights = np.array(
        [math.floor(1000 * math.log((2 * held.texts + 2) / (2 * int(df) + 1))) for df in holders],
        np.int64,
    )
    number = {term: n for n, term in enumerate(vocabulary)}
    pairs = np.array(
        sorted((number[term], item) for item, (_, terms) in enumerate(block) for term in terms), np.int64
    )
    asked = np.searchsorted(pairs[:, 0], np.arange(len(vocabulary) + 1))
    ids = [item_id for item_id, _ in block]
    scoring = spark.sparkContext.broadcast((weights, asked, pairs[:, 1].copy(), ids))
    # Decimals, since 90 times the terms of a document times all documents may pass 64 bits.
    m = F.expr(f"10 + cast(terms as decimal(18, 0)) * {90 * held.texts}BD div {held.terms}BD")
    scored = bags.where(F.size("codes") > 0).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), m.alias("m"), "codes", "counts"
    )
    best = classes_of(scored, k).select("m", "codes", "counts", "members")
    found = best.mapInArrow(_scorer(scoring, k), FOUND)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(
    documents: DataFrame,
    items: DataFrame,
    place: str,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    blocks: dict | None = None,
) -> DataFrame:
    """The k best documents of each item: `item_id, rank, doc_id, score`, best first.

    Terms are runs of digits, letters and all characters beyond ASCII, with A-Z in lower case. The
    weight of a term falls with the number of documents that hold it, its share in a score rises
    with its count and falls with the length of the document against the mean. Documents without
    any of an item's terms, or only with terms of weight 0, are not returned; equal scores go by id.

    Every document is read as a whole; a very long one makes a task's step larger, not shorter. One
    pass over the documents stores bags below `place` (kept for the caller), from which the numbers
    of holders are counted and the classes come. Items are taken in blocks of a bounded size (see
    item_blocks; `blocks` sets other bounds), each a pass of its own: only a block is broadcast.

    A null text, and one without terms, counts nowhere. Documents with equal ids are documents of
    their own; those without id are found too and come last among equals (the largest possible id
    is read as none). Rows of one item id are one item with the terms of all, also those without id.
    Items without terms, and either table without rows, give no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    asked = _item_terms(items, item_col, item_text_col)
    found = None
    for n, block in enumerate(item_blocks(asked, **(blocks or {}))):
        part = _search_block(texts, block, f"{place}/bags-{n}", k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found
