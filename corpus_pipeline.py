"""From raw documents to packed training sequences, stage by stage."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import workspace
from tierline.llm import language_profiles, packing, repeated_windows, shingle_overlap
from tierline.llm.session import prepare


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a null `lang` becomes the language found.

    Null and empty texts go, long ones are judged whole, equal rows alike, and no rows give no rows.
    Without labels, or without a column `lang`, no language is known and no document stays.
    """
    prepare(spark)
    return language_profiles.recognised(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    These share four fifths or more of their five-word shingles, directly or through others; their
    fingerprints (op3) and MinHash keys, for those whose fingerprints lie apart, tell what to compare. Rows
    that repeat its id are the same document and stay with it; documents without id cannot be chosen
    among, and stay.
    """
    prepare(spark)
    first = shingle_overlap.first_of_similar(docs)
    same = F.col("docs.doc_id") == F.col("found.first")
    kept = docs.alias("docs").join(first.alias("found"), same, "left_semi")
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def remove_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones, or they themselves, have held before.

    Where a cut goes through a character, the character goes. `n_chars` follows the text. Documents
    of which nothing but white space is left go; a null text becomes empty.
    """
    prepare(spark)
    found = repeated_windows.remove_repeated(docs, content="text", carry=True)
    found = found.where((F.col("n_removed") == 0) | (F.trim("kept") != ""))
    new = {
        "text": F.col("kept").alias("text"),
        "n_chars": F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long"))
        .otherwise(F.col("row.n_chars"))
        .cast(docs.schema["n_chars"].dataType)
        .alias("n_chars"),
    }
    return found.select(*[new.get(n, F.col(f"row.`{n}`")) for n in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; see packing.pack_documents()."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_text", remove_repeated_text),
    ("packing", pack),
]

# Neither trained models, hashes nor tokenizers can be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each reads what the one before it has stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        place = workspace.new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.schema(docs.schema).parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
