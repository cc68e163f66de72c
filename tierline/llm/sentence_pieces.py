"""SentencePiece models on the tokenizers library."""

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.byte_words import steps
from tierline.llm.chunk_codes import ChunkCodes
from tierline.llm.columns import spread
from tierline.llm.vocabularies import path_of

DEFAULT_MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Fixed values of the model format: kinds of model, kinds of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def merges_of(scores: dict[str, float]) -> list[tuple[str, str]]:
    """Every pair of pieces that joins to a piece, best joined score first.

    The model joins the leftmost of equally good pairs. Equal scores occur for runs of the mark, the
    leftmost of which is also the longest, so of equal scores the longer left part comes first.
    """
    found = [
        (-score, -cut, piece)
        for piece, score in scores.items()
        for cut in range(1, len(piece))
        if piece[:cut] in scores and piece[cut:] in scores
    ]
    return [(piece[:-cut], piece[-cut:]) for _, cut, piece in sorted(found)]


def rebuild(model: bytes):
    """A tokenizer of the tokenizers library that equals the serialised SentencePiece model.

    Normaliser, mark for spaces, scores or merges and byte fallback come from the model. Control
    pieces have ids, but their strings inside a text are ordinary text.
    """
    from sentencepiece import sentencepiece_model_pb2
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    spec, trainer = proto.normalizer_spec, proto.trainer_spec
    if trainer.treat_whitespace_as_suffix:
        raise ValueError("models that mark the ends of words are not supported")
    unknown = next(n for n, p in enumerate(proto.pieces) if p.type == UNKNOWN)
    if trainer.model_type == UNIGRAM:
        # Strings of control pieces would match text; a character that texts cannot have hides them.
        hidden = (CONTROL, UNUSED)
        core = models.Unigram(
            [("\uffff" * (p.type in hidden) + p.piece, p.score) for p in proto.pieces],
            unknown,
            trainer.byte_fallback,
        )
    elif trainer.model_type == BPE:
        core = models.BPE(
            {p.piece: n for n, p in enumerate(proto.pieces)},
            merges_of({p.piece: p.score for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)}),
            unk_token=proto.pieces[unknown].piece,
            fuse_unk=True,
            byte_fallback=trainer.byte_fallback,
        )
    else:
        raise ValueError(f"model type {trainer.model_type} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    own = [p.piece for p in proto.pieces if p.type == USER_DEFINED]
    if own:
        tokenizer.add_tokens([AddedToken(piece, normalized=True) for piece in own])
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if spec.add_dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer, proto


def splits_at_spaces(proto) -> bool:
    """Whether no piece goes on past a space, so that texts may be encoded in chunks."""
    plain = not proto.normalizer_spec.precompiled_charsmap
    plain = plain and not proto.normalizer_spec.remove_extra_whitespaces
    return plain and not any(
        p.type in (NORMAL, USER_DEFINED) and MARK in p.piece.lstrip(MARK) for p in proto.pieces
    )


#: Chunks, and runs of ids, that a worker remembers.
REMEMBERED = 600_000


class _CheckedCodes(ChunkCodes):
    """Remembers of each chunk too whether the original library gives the same ids."""

    def _forget(self) -> None:
        super()._forget()
        self.equal = np.ones(1 << 12, bool)

    def _learn(self, chunks: list[str]) -> None:
        count = len(self._known)
        super()._learn(chunks)
        while len(self.equal) < len(self._known):
            self.equal = np.concatenate([self.equal, np.ones_like(self.equal)])
        self.equal[count : len(self._known)] = self.last_equal

    def all_equal(self, texts: pa.Array) -> np.ndarray:
        """Whether all chunks of a text have equal ids."""
        codes, places = self._chunked(texts)
        return np.diff(np.append(0, np.cumsum(~self.equal[codes]))[places]) == 0


class Codec:
    """Encodes batches with several threads, checked against the original library."""

    def __init__(self, path: str, threads: int) -> None:
        if threads > 1:
            os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        import sentencepiece

        with open(path, "rb") as file:
            self.tokenizer, proto = rebuild(file.read())
        self._original = sentencepiece.SentencePieceProcessor(model_file=path)
        self._threads, self._prefix = threads, proto.normalizer_spec.add_dummy_prefix
        whole = not splits_at_spaces(proto)
        self._chunks = None if whole else _CheckedCodes(self._encode_chunks, REMEMBERED)

    def _checked(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        original = self._original.encode(texts, num_threads=self._threads)
        return rows, [a == b for a, b in zip(rows, original, strict=True)]

    def _encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        # A chunk that begins with a space gets its mark as the prefix that every text gets.
        texts = [c[1:] if self._prefix and c[:1] == " " else c for c in chunks]
        rows, self._chunks.last_equal = self._checked(texts)
        if self._prefix:  # the library gives an empty text no prefix
            for n, chunk in enumerate(chunks):
                if chunk == " ":
                    rows[n] = [self.tokenizer.token_to_id(MARK)]
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Ids, where each text's ids start, and whether the original library gives the same."""
        if self._chunks is None:
            rows, equal = self._checked([t or "" for t in texts.to_pylist()])
            starts = np.cumsum([0, *map(len, rows)])
            return np.array([i for row in rows for i in row], np.int32), starts, equal
        # The prefix of a text that begins with a space is a space more; see _encode_chunks.
        more = pc.starts_with(texts, " ") if self._prefix else pa.scalar(False)
        cut = pc.if_else(more, pc.binary_join_element_wise(" ", texts, ""), texts)
        ids, starts = self._chunks.ids(cut)
        equal = [True] * len(texts)
        if not self._chunks.equal.all():
            # A chunk that differs does not tell of its text; the text does.
            for n in np.flatnonzero(~self._chunks.all_equal(cut)).tolist():
                own = ids[starts[n] : starts[n + 1]].tolist()
                equal[n] = own == self._original.encode(texts[n].as_py() or "")
        return ids.astype(np.int32), starts, equal


class Decoder:
    """Decodes batches with the rebuilt tokenizer: each distinct run of ids from mark to mark once."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self._tokenizer, proto = rebuild(file.read())
        self._prefix = proto.normalizer_spec.add_dummy_prefix
        self._marked = np.array([p.piece.startswith(MARK) for p in proto.pieces])
        # These stand alone: control pieces have no text, the unknown piece has the model's.
        unknown = proto.trainer_spec.unk_surface.encode()
        apart = {n: p for n, p in enumerate(proto.pieces) if p.type in (CONTROL, UNKNOWN)}
        self._apart = list(apart)
        self._silent = {
            np.int32(n).tobytes(): unknown * (p.type == UNKNOWN) for n, p in apart.items()
        }
        self._known = dict(self._silent)
        self._held = 0

    def _texts(self, runs: list[bytes]) -> list[bytes]:
        if len(self._known) > REMEMBERED or self._held > 64 * REMEMBERED:
            self._known, self._held = dict(self._silent), 0
        new = [run for run in runs if run not in self._known]
        flat = np.frombuffer(b"".join(new), np.int32)
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new))) // 4
        starts = np.append(0, ends)[:-1]
        ids = flat.tolist()
        rows = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        texts = self._tokenizer.decode_batch(rows, skip_special_tokens=False)
        if self._prefix:
            # The decoder takes a text's first space for the prefix; a run's is a space.
            spaces = self._marked[flat[starts]].tolist()
            texts = [" " + text if space else text for text, space in zip(texts, spaces, strict=True)]
        self._known.update(zip(new, map(str.encode, texts), strict=True))
        self._held += 4 * len(flat) + sum(map(len, texts))
        return [self._known[run] for run in runs]

    def texts(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The text of each row of ids; the mark that encoding puts first is taken off."""
        ids = np.ascontiguousarray(ids, np.int32)
        apart = np.isin(ids, self._apart)
        first = self._marked[ids] | apart
        first[1:] |= apart[:-1]
        first[starts[:-1][np.diff(starts) > 0]] = True
        first = np.flatnonzero(first)
        bounds = np.append(first, len(ids)) * 4
        runs = pa.Array.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]
        ).dictionary_encode()
        pieces = self._texts(runs.dictionary.to_pylist())
        numbers = runs.indices.to_numpy()
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begins = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(pieces), np.uint8)
        whole = data[spread(begins[numbers], lengths[numbers])].tobytes()
        places = np.append(0, np.cumsum(lengths[numbers]))[np.searchsorted(first, starts)].tolist()
        rows = [whole[a:b] for a, b in zip(places, places[1:], strict=False)]
        if self._prefix:
            rows = [row.removeprefix(b" ") for row in rows]
        return [row.decode() for row in rows]


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


@lru_cache(maxsize=2)
def codec(path: str, threads: int) -> Codec:
    return Codec(path, threads)


def encode(
    documents: DataFrame,
    model: str | None = None,
    threads: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The ids of every text: `doc_id, text, ids array<int>, parity`.

    `parity` tells that the SentencePiece library gives the same ids. Where no piece of the model
    reaches past a space, both libraries encode the distinct chunks of a batch rather than each
    text, and a text holding a chunk they disagree on is compared as a whole.

    A null text is empty: no ids. Ids of rows may be null or repeat; other columns are ignored; no
    rows give no rows. Texts are encoded whole, without begin and end pieces.
    """
    path = model or path_of(DEFAULT_MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, threads)
        for batch in batches:
            ids, starts, equal = own.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(equal, pa.bool_()),
                ],
                names=["doc_id", "text", "ids", "parity"],
            )

    chosen = documents.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = T.StructType(
        [
            *(T.StructField(f.name, f.dataType) for f in chosen.schema),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("parity", T.BooleanType()),
        ]
    )
    return chosen.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None, ids_col: str = "ids") -> DataFrame:
    """All columns, and `decoded`: the text of the ids. Null or no ids give an empty text.

    The rebuilt tokenizer decodes: bytes that are no UTF-8 become U+FFFD. Control pieces have no
    text. A column named `decoded` is replaced.
    """
    path = model or path_of(DEFAULT_MODEL)
    rest = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            lists = batch.column(ids_col)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = own.texts(ids, np.append(0, np.cumsum(sizes)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in rest.schema]
        + [T.StructField("decoded", T.StringType())]
    )
    return rest.mapInArrow(run, schema)


def round_trips(
    documents: DataFrame,
    model: str | None = None,
    threads: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """encode() and decode() of every text in one pass: `doc_id, ids, parity, round_trip`.

    `round_trip` tells that the ids give the text again, but for the mark, which becomes a space. One
    worker does both, a few megabytes of text at a time; texts do not leave it. Nulls, empty tables,
    repeated rows and other columns are as in encode(); a very long text is a step of its own.
    """
    path = model or path_of(DEFAULT_MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forth, back = codec(path, threads), decoder(path)
        for batch in batches:
            for part in steps(batch):
                texts = part.column("text")
                ids, starts, equal = forth.encode(texts)
                again = back.texts(ids, starts)
                same = [a == b.replace(MARK, " ") for a, b in zip(again, texts.to_pylist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(equal, pa.bool_()), pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "parity", "round_trip"],
                )

    chosen = documents.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", chosen.schema["doc_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("parity", T.BooleanType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    return chosen.mapInArrow(run, schema)
