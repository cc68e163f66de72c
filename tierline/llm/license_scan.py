"""License notices in text, by phrases and by an exact set-similarity join with templates.

Only DataFrame functions: nothing here runs in Python workers.

A text block is a window of 2s words that begins at a multiple of s, so that whatever is at most s
words long lies whole in some block. s is 8, 16, 32, ...: a template meets the blocks of the smallest
s that its words fit in. A block matches if it holds the given share of a template's distinct words.
"""

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What lies between words, once A-Z are in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose words stand one after the other, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Usual sentences of license notices, and their labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, version 2.0"),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution International License"),
    ("cc0", "dedicated to the public domain under the Creative Commons CC0 Public Domain Dedication"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "may not be reproduced or distributed without the prior written permission of the publisher"),
)

SHORTEST = 8
#: Bounds of the template list: its words are literals of the plan, its tables are broadcast.
MOST_TEMPLATES, MOST_WORDS = 2_000, 100_000


def template_words(text: str) -> list[str]:
    """The words of a template, which must be ASCII."""
    if not text.isascii():
        raise ValueError(f"templates and phrases are ASCII, this is not: {text!r}")
    return re.findall("[0-9a-z]+", text.lower())


def size_of(words: int) -> int:
    """The s of the blocks that a template with so many words meets."""
    size = SHORTEST
    while size < words:
        size *= 2
    return size


def needed(words: int, share: float) -> int:
    """How many of its distinct words a block must hold."""
    return next(n for n in range(1, words + 1) if n >= share * words - 1e-9)


def _check(templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    split = [(label, template_words(text)) for label, text in templates]
    if len(split) > MOST_TEMPLATES or sum(len(words) for _, words in split) > MOST_WORDS:
        raise ValueError(f"at most {MOST_TEMPLATES} templates with {MOST_WORDS} words are taken")
    return [(label, words) for label, words in split if words]


def words_of(texts: DataFrame) -> DataFrame:
    """`words`: all words of the `text`, in order, in place of it. A null text has none."""
    parts = F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), BETWEEN)
    # Only the first and the last part can be empty.
    before = F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0)
    after = F.when(F.element_at("words", -1) == "", 1).otherwise(0)
    return texts.withColumn("words", parts).drop("text").withColumn(
        "words", F.slice("words", before + 1, F.greatest(F.size("words") - before - after, F.lit(0)))
    )


def word_counts(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often each of these words occurs in all texts."""
    found = (
        words.select(
            F.explode(F.filter("words", lambda word: word.isin(*vocabulary))).alias("word")
        )
        .groupBy("word")
        .count()
    )
    counts = {row.word: row["count"] for row in found.collect()}
    return {word: counts.get(word, 0) for word in vocabulary}


def _rows(spark: SparkSession, fields: str, rows: Sequence[Sequence[str]]) -> DataFrame:
    """A small table of literals."""
    listed = ", ".join(f"({', '.join(row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS rows({fields})")


def _places(phrase: Sequence[str], anchor: str) -> Column:
    """Where the words of a phrase stand one after the other, found from hits of its rarest word."""
    offset = phrase.index(anchor)

    def stands(hit: Column) -> Column:
        here = hit.word == anchor
        for n, other in enumerate(phrase):
            here = here & (F.get("words", hit.at - offset + n) == other)
        return here

    return F.transform(F.filter("hits", stands), lambda hit: hit.at - offset)


def _blocks(size: int, prefix: Sequence[str]) -> Column:
    """The blocks of one size that hold any of the prefix words."""
    own = F.filter("hits", lambda hit: hit.word.isin(*prefix))
    numbers = F.array_distinct(
        F.flatten(
            F.transform(
                own,
                lambda hit: F.array(
                    F.floor(hit.at / size).cast("int") - 1, F.floor(hit.at / size).cast("int")
                ),
            )
        )
    )
    real = F.filter(numbers, lambda number: number >= 0)
    return F.transform(
        real,
        lambda number: F.struct(
            F.lit(size).alias("size"),
            number.alias("block"),
            F.slice("words", number * size + 1, 2 * size).alias("words"),
        ),
    )


def matches(blocks: DataFrame, templates: DataFrame, ranks: DataFrame) -> DataFrame:
    """Set-similarity join: every block and template that share enough words.

    `blocks`: `doc_id, digest, size, block, words`. Words are numbered by their frequency in all
    texts, rare ones first; those that no template has never count. A block and a template can share
    enough only if their prefixes meet (what is left after `needed - 1` words), if the block is long
    enough, and if enough words are left from the first shared one on. The rest is counted.
    """
    key = ["doc_id", "digest", "size", "block"]
    numbered = (
        blocks.select(*key, F.explode(F.array_distinct("words")).alias("word"))
        .join(ranks, "word")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("rank")).alias("held"))
    )
    prefixes = templates.select(
        "template", "label", "size", "needed", "ranks", F.posexplode("ranks").alias("i", "rank")
    ).where(F.col("i") <= F.size("ranks") - F.col("needed"))
    met = (
        numbered.select(*key, "held", F.posexplode("held").alias("j", "rank"))
        .join(prefixes, ["size", "rank"])
        .where(F.size("held") >= F.col("needed"))
        .where(F.col("j") <= F.size("held") - F.col("needed"))
        .groupBy(*key, "template")
        .agg(
            F.min("i").alias("i"),
            F.min("j").alias("j"),
            *[F.first(name).alias(name) for name in ("held", "ranks", "label", "needed")],
        )
    )
    left = F.least(F.size("ranks") - F.col("i"), F.size("held") - F.col("j"))
    return (
        met.where(left >= F.col("needed"))
        .withColumn("shared", F.array_intersect("held", "ranks"))
        .where(F.size("shared") >= F.col("needed"))
        .select(*key, "template", "label", "shared", (F.size("shared") / F.size("ranks")).alias("share"))
    )


def strongest(matched: DataFrame) -> DataFrame:
    """Matches without those that another one explains, in the same block or a neighbour of its size:
    one that shares the same words and more, or the same words of a shorter template. Two notices
    beside each other both stay."""
    key = ["doc_id", "digest", "size"]

    def explains(other: Column, match: Column) -> Column:
        both = F.size(F.array_intersect(other.shared, match.shared)) == F.size(match.shared)
        more = F.size(other.shared) > F.size(match.shared)
        return both & (more | (other.share > match.share))

    match = F.struct("block", "template", "label", "shared", "share")
    paired = (
        matched.withColumn("pair", F.explode(F.array(F.col("block"), F.col("block") + 1)))
        .groupBy(*key, "pair")
        .agg(F.collect_list(match).alias("found"))
    )
    told = F.transform(
        "found",
        lambda match: F.struct(
            match.block.alias("block"),
            match.template.alias("template"),
            match.label.alias("label"),
            match.share.alias("share"),
            F.exists("found", lambda other: explains(other, match)).alias("explained"),
        ),
    )
    return (
        paired.select(*key, F.inline(told))
        .groupBy(*key, "block", "template", "label", "share")
        .agg(F.bool_or("explained").alias("explained"))
        .where(~F.col("explained"))
    )


def scan(
    documents: DataFrame,
    place: str,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    share: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """License labels of every text: `doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`.

    `n_base` counts the places of phrases, `first_word` and `last_word` are the smallest and largest
    of them. `labels` adds the labels of the templates of which some block holds at least `share` of
    the distinct words. `score` is the largest share of a template that was found, 1 with a phrase.

    Two passes over the texts: one counts the words of the templates, one finds phrases and the few
    blocks that hold a rare enough word; these, and no texts, are stored below `place` and kept for
    the caller. Null and empty texts have no words, no labels and score 0. Long texts are scanned
    whole. Rows may have equal or no ids; equal rows have equal results. An empty table gives no
    rows, other columns are ignored. Templates may be none; at most MOST_TEMPLATES are taken.
    """
    spark = documents.sparkSession
    known = _check(templates)
    split = [(template_words(phrase), label) for phrase, label in phrases.items()]
    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vocabulary = sorted({word for _, words in known for word in words})
    wanted = sorted({*vocabulary, *(word for words, _ in split for word in words)})
    counts = word_counts(words_of(texts), wanted) if wanted else {}
    order = sorted(vocabulary, key=lambda word: (counts[word], word))
    rank = {word: n for n, word in enumerate(order)}
    ranked = []
    prefix: dict[int, set[str]] = {}
    for number, (label, words) in enumerate(known):
        held = sorted({rank[word] for word in words})
        least, size = needed(len(held), share), size_of(len(words))
        ranked.append((number, label, size, least, held))
        prefix.setdefault(size, set()).update(order[r] for r in held[: len(held) - least + 1])
    anchors = [min(words, key=lambda word: (counts[word], word)) for words, _ in split]
    rare = sorted(set(anchors).union(*prefix.values()))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))

    def hit(word: Column, at: Column) -> Column:
        return F.when(word.isin(*rare), F.struct(at.alias("at"), word.alias("word")))

    hits = F.array().cast("array<struct<at:int,word:string>>")
    if rare:
        hits = F.filter(F.transform("words", hit), lambda found: found.isNotNull())
    blocks = F.array().cast("array<struct<size:int,block:int,words:array<string>>>")
    if known:
        blocks = F.concat(*[_blocks(size, sorted(own)) for size, own in sorted(prefix.items())])
    found = [f"places_{n}" for n in range(len(split))]
    places = [
        _places(words, anchor).alias(name)
        for name, (words, _), anchor in zip(found, split, anchors, strict=True)
    ]
    labels = [
        F.when(F.size(name) > 0, F.lit(label)) for name, (_, label) in zip(found, split, strict=True)
    ]
    words_of(texts.withColumn("digest", digest)).withColumn("hits", hits).select(
        "doc_id",
        "digest",
        F.size("words").cast("long").alias("n_words"),
        *places,
        blocks.alias("blocks"),
    ).select(
        "doc_id",
        "digest",
        "n_words",
        F.concat(F.array().cast("array<int>"), *found).alias("places"),
        F.array_compact(F.array(F.lit(None).cast("string"), *labels)).alias("base"),
        "blocks",
    ).write.mode("overwrite").parquet(place)
    scanned = spark.read.parquet(place)
    if known:
        table = _rows(
            spark,
            "template, label, size, needed, ranks",
            [
                (str(n), _quoted(label), str(size), str(least), f"array({', '.join(map(str, held))})")
                for n, label, size, least, held in ranked
            ],
        )
        ranks = _rows(spark, "word, rank", [(_quoted(word), str(n)) for word, n in rank.items()])
        blocks = scanned.select("doc_id", "digest", F.inline("blocks")).distinct()
        joined = (
            strongest(matches(blocks, table, ranks))
            .groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
            .agg(F.collect_set("label").alias("own"), F.max("share").alias("share"))
        )
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
        scanned = scanned.join(joined, same, "left")
    else:
        scanned = scanned.withColumns(
            {"own": F.array().cast("array<string>"), "share": F.lit(None).cast("double")}
        )

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.size("places") > 0
    own = F.coalesce("own", F.array().cast("array<string>"))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", own)).alias("labels"),
        F.when(base, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
