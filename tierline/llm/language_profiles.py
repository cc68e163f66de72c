"""Language identification with hyperdimensional profiles."""

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
BLOCK = 4096  # n-grams whose vectors are made at a time
CELLS = 1 << 21  # counts (documents by n-grams) held at a time
LETTERS = 1 << 19  # characters looked at together, unless one text has more
NOISE = 6.0  # cosines of unlike vectors stay below this over the root of their dimensions
SCRIPT_SHARE = 0.01  # of a language's letters, for a script to be its own


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point the lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


@lru_cache(maxsize=100_000)
def _script(code: int) -> str:
    """The first word of a letter's name: LATIN, CYRILLIC, CJK."""
    return unicodedata.name(chr(code), "").split(" ")[0]


def _scripts(text: str) -> Counter:
    """How many letters of each script a text has."""
    letters = _letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    found = Counter()
    for code, count in zip(*np.unique(letters[letters != 0], return_counts=True), strict=True):
        found[_script(int(code))] += int(count)
    return found


@lru_cache(maxsize=100_000)
def _letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The random signs of a letter; 0 stands for what lies between words."""
    signs = np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dimensions)
    return (2 * signs - 1).astype(np.int8)


class Grams:
    """The trigrams of a batch of texts, by document, and the vectors they are bound into."""

    def __init__(self, texts: list[str | None], dimensions: int, seed: int) -> None:
        self.documents, self._dimensions = len(texts), dimensions
        lengths = np.array([len(text or "") for text in texts], np.int64)
        joined = "".join(f"{text or ''} " for text in texts)
        symbols = _letters()[np.frombuffer(f" {joined}".encode("utf-32-le"), np.uint32)]
        document = np.append(0, np.repeat(np.arange(len(texts)), lengths + 1))
        # What lies between two words counts once.
        kept = np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))
        symbols, document = symbols[kept], document[kept]
        alphabet = np.flatnonzero(np.bincount(symbols, minlength=1))
        place = np.searchsorted(alphabet, symbols)
        middle = np.flatnonzero(symbols[1:-1]) + 1 if len(symbols) > 2 else np.zeros(0, int)
        base = len(alphabet)
        codes = (place[middle - 1] * base + place[middle]) * base + place[middle + 1]
        self.document = document[middle]
        if base**3 <= CELLS:
            self._distinct = np.flatnonzero(np.bincount(codes, minlength=1))
            index = np.zeros(base**3, np.int64)
            index[self._distinct] = np.arange(len(self._distinct))
            self.gram = index[codes]
        else:
            self._distinct, self.gram = np.unique(codes, return_inverse=True)
        letters = np.array([_letter_vector(int(c), dimensions, seed) for c in alphabet], np.int8)
        letters = letters.reshape(base, dimensions)
        self._base = base
        self._shifted = [np.roll(letters, shift, axis=1) for shift in (2, 1, 0)]

    def _vectors(self, low: int, high: int) -> np.ndarray:
        """Each trigram's letters, permuted by their place and multiplied."""
        codes, base = self._distinct[low:high], self._base
        first, second, third = self._shifted
        bound = first[codes // base**2] * second[codes // base % base] * third[codes % base]
        return bound.astype(np.float32)

    def bundled(self, group: np.ndarray, groups: int) -> np.ndarray:
        """The sum of trigram vectors of each group; `group` gives a document's, or -1."""
        sums = np.zeros((groups, self._dimensions))
        own = group[self.document]
        for low in range(0, len(self._distinct), BLOCK):
            high = min(len(self._distinct), low + BLOCK)
            vectors = self._vectors(low, high)
            step = max(1, CELLS // BLOCK)
            for start in range(0, groups, step):
                end = min(groups, start + step)
                here = (self.gram >= low) & (self.gram < high) & (own >= start) & (own < end)
                cell = (own[here] - start) * (high - low) + self.gram[here] - low
                counts = np.bincount(cell, minlength=(end - start) * (high - low))
                counts = counts.reshape(end - start, high - low).astype(np.float32)
                sums[start:end] += counts @ vectors
        return sums


def _parts(texts: list[str | None]) -> Iterator[slice]:
    """Texts in slices of bounded size; a long text is a slice of its own."""
    low, held = 0, 0
    for n, text in enumerate(texts):
        size = len(text or "")
        if n > low and held + size > LETTERS:
            yield slice(low, n)
            low, held = n, 0
        held += size
    if low < len(texts):
        yield slice(low, len(texts))


def learn(
    labelled: DataFrame, dimensions: int = 1024, seed: int = 7, text_col="text", lang_col="lang"
) -> dict[str, np.ndarray]:
    """A prototype for each language: the bundle of all trigrams of its texts.

    Tasks bundle what they read; their sums are added up by component. Only the prototypes, as many
    as there are languages, reach the driver. Rows without a language or text do not count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()])],
                names=["lang", "vector"],
            )

        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs = batch.column("lang").dictionary_encode()
            names, group = langs.dictionary.to_pylist(), np.asarray(langs.indices, np.int64)
            for part in _parts(texts):
                found = Grams(texts[part], dimensions, seed).bundled(group[part], len(names))
                for name, row in zip(names, found, strict=True):
                    sums[name] = sums.get(name, 0) + row
            if len(sums) > 1000:
                yield out()
                sums.clear()
        if sums:
            yield out()

    rows = (
        labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(run, "lang string, vector array<double>")
        .select("lang", F.posexplode("vector").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("vector"))
        .collect()
    )
    found = {row["lang"]: np.array([c["value"] for c in row["vector"]]) for row in rows}
    return {lang: found[lang] for lang in sorted(found) if found[lang].any()}


def learned_scripts(labelled: DataFrame, text_col="text", lang_col="lang") -> frozenset[str]:
    """The scripts that one in a hundred letters or more of some language are written in.

    The driver gets a row for each language and script.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            texts, langs = (batch.column(n).to_pylist() for n in ("text", "lang"))
            for part in _parts(texts):
                together: dict[str, list[str]] = {}
                for text, lang in zip(texts[part], langs[part], strict=True):
                    together.setdefault(lang, []).append(text)
                for lang, own in together.items():
                    for script, count in _scripts("".join(own)).items():
                        counts[lang, script] += count
            rows = [(*key, count) for key, count in counts.items()]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["lang", "script", "n"],
            )

    rows = (
        labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(run, "lang string, script string, n bigint")
        .groupBy("lang", "script")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    total = Counter()
    for row in rows:
        total[row["lang"]] += row["n"]
    return frozenset(r["script"] for r in rows if r["n"] >= SCRIPT_SHARE * total[r["lang"]])


def predict(
    documents: DataFrame,
    prototypes: dict[str, np.ndarray],
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    scripts: frozenset[str] | None = None,
) -> DataFrame:
    """`doc_id, lang_pred, score`: the language whose prototype is nearest by cosine.

    With `carry` all columns come along as a struct `row`. With `scripts`, a text is `und` with score
    0 too if its score is noise and less than half of its letters are of these scripts.
    The score is that cosine, 0 at least. A text that is null or has no letter, and every text if
    nothing was learned, is `und` with score 0; ties go to the language first in the alphabet.
    Short texts are padded by what lies between words, so that one letter is enough. Ids may be
    null or repeat, a row gives a row; other columns are ignored; no rows give no rows.
    """
    names = list(prototypes)

    def foreign(text: str) -> bool:
        found = _scripts(text)
        return 2 * sum(found[script] for script in scripts) < found.total()

    matrix = np.array([prototypes[name] / np.linalg.norm(prototypes[name]) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            langs, scores = np.full(count, UNKNOWN, object), np.zeros(count)
            texts = batch.column("text").to_pylist() if names else []
            for part in _parts(texts):
                own = np.arange(part.stop - part.start)
                grams = Grams(texts[part], matrix.shape[1], seed)
                bundles = grams.bundled(own, len(own))
                norms = np.linalg.norm(bundles, axis=1)
                cosines = bundles @ matrix.T / np.where(norms, norms, 1)[:, None]
                best = cosines.argmax(axis=1)
                lettered = np.bincount(grams.document, minlength=len(own)) > 0
                langs[part] = np.where(lettered, np.array(names, object)[best], UNKNOWN)
                scores[part] = np.where(lettered, np.clip(cosines[own, best], 0, 1), 0.0)
                if scripts is not None:
                    noise = NOISE / np.sqrt(matrix.shape[1])
                    for n in part.start + np.flatnonzero(lettered & (scores[part] < noise)):
                        if foreign(texts[n]):
                            langs[n], scores[n] = UNKNOWN, 0.0
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, others), pa.array(langs, pa.string()), pa.array(scores)],
                names=[*others, "lang_pred", "score"],
            )

    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.struct("*").alias("row")] * carry,
    )
    fields = [T.StructField(f.name, f.dataType) for f in chosen.schema if f.name != "text"]
    schema = T.StructType(fields).add("lang_pred", "string").add("score", "double")
    return chosen.mapInArrow(run, schema)


def recognised(documents: DataFrame, dimensions: int = 1024, seed: int = 7) -> DataFrame:
    """The documents whose language is recognised, all columns; a null `lang` is filled in.

    Rejected are texts without letters, and those in scripts not learned here: cosines of unlike
    vectors are noise, which stays below 6 / sqrt(dimensions), and a text with so low a score goes
    if less than half of its letters are of the scripts learned. A low score alone rejects nothing,
    as single words of a language learned have it too; so a text of another language in the same
    script stays, under the nearest language.
    Learned from the labelled documents among them, so without labels, or a column `lang`, nothing is
    recognised. Null and empty texts have no letters and go; a very long text is one vector like any
    other; repeated rows are judged alike; an empty table stays empty; other columns are kept.
    """
    given = documents.columns
    if "lang" not in given:
        documents = documents.withColumn("lang", F.lit(None).cast("string"))
    prototypes, scripts = learn(documents, dimensions, seed), learned_scripts(documents)
    found = predict(documents, prototypes, seed, carry=True, scripts=scripts)
    lang = F.coalesce("row.lang", "lang_pred").alias("lang")
    return found.where(F.col("lang_pred") != UNKNOWN).select(
        *[lang if name == "lang" else F.col(f"row.`{name}`") for name in given]
    )


def held_out(doc_id, folds: int = 5):
    """Whether a document is in the fold that nothing is learned from; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def identify(documents: DataFrame, dimensions: int = 1024, seed: int = 7) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` of every document; see learn() and predict().

    Learned from `text` and `lang` of the documents outside the held-out fold. A document without
    id is in neither part: nothing is learned from it, and `held_out` is false.
    """
    seen = documents.where(~held_out(F.col("doc_id")))
    found = predict(documents, learn(seen, dimensions, seed), seed)
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
