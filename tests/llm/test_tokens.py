import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tierline import workspace
from tierline.llm import packing, sentence_pieces, token_counts
from tierline.llm.chunk_codes import ChunkCodes
from tierline.llm.vocabularies import chunk_codes, path_of

FOLDER = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", " a", "a ", "a  b", "a\n b \tc\x0bd\x1ce\x85f\xa0g　h  i", "it's  's 12",
    "x <|endoftext|> y<|endoftext|>z <|startoftext|>", "<|ENDOFTEXT|>", "Äé ß ﬁ İ ς Σ ñ ̃",
    "日本語 テスト 😀\x00\x7f z", "<s> </s> <unk> <0x41>", "▁ ▁a▁b ▁", "…  . ,", "a" * 3000 + " " + "b" * 40,
]


def library(name):
    return Tokenizer.from_file(path_of(name))


@pytest.fixture(scope="module")
def texts(spark):
    return ODD + [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_whole_texts(texts, name):
    expected = [library(name).encode(t or "", add_special_tokens=False).ids for t in texts]
    for codes in (chunk_codes(path_of(name)), ChunkCodes(chunk_codes(path_of(name))._encode, 50)):
        ids, starts = codes.ids(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == expected
        for low in range(0, len(texts), 40):
            counts = codes.count(pa.array(texts[low : low + 40], pa.string()))
            assert counts.tolist() == [len(e) for e in expected[low : low + 40]]


def test_counts_come_from_the_cache(spark, documents, texts):
    rows = [(n % 50, t) for n, t in enumerate(texts)] + [(None, "a"), (None, "  a "), (7, None)]
    cache = workspace.new_folder(spark, "test-counts")
    tokenizer = library("word_bpe_49k.json")
    expected = sorted(
        (
            (i, len((t or "").encode()), n := len(tokenizer.encode(t or "").ids), n > 100)
            for i, t in rows
        ),
        key=str,
    )
    half = documents(*rows[: len(rows) // 2])
    token_counts.token_counts(half, cache, limit=100).collect()
    for _ in range(2):
        found = token_counts.token_counts(documents(*rows), cache, limit=100).collect()
        assert sorted((tuple(r) for r in found), key=str) == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content_digest").distinct().count()
    before = sorted(workspace.matching(spark, f"{cache}/part-*"))
    assert token_counts.token_counts(documents(*rows).limit(0), cache).collect() == []
    token_counts.token_counts(documents(*rows), cache).collect()
    assert sorted(workspace.matching(spark, f"{cache}/part-*")) == before


def test_counts_of_rows_of_one_id_or_none(spark, documents):
    cache = workspace.new_folder(spark, "test-counts")
    rows = [(i, f"word {n}  " + "more " * (n % 7)) for i in (None, 3) for n in range(300)] * 2
    tokenizer = library("word_bpe_49k.json")
    expected = sorted(
        ((i, len(t), n := len(tokenizer.encode(t).ids), n > 5) for i, t in rows), key=str
    )
    found = token_counts.token_counts(documents(*rows), cache, limit=5).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected


def test_a_shared_content_is_joined_without_an_aggregate_in_the_way(spark, documents):
    cache = workspace.new_folder(spark, "test-counts")
    frame = token_counts.token_counts(documents((1, "a"), (2, "a"), (3, "b")), cache)
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in text


def test_counts_of_another_tokenizer_do_not_serve(spark, documents):
    cache = workspace.new_folder(spark, "test-counts")
    frame = documents((1, "some words, here"))
    counts = [
        token_counts.token_counts(frame, cache, path_of(name)).first().n_tokens
        for name in ("word_bpe_49k.json", "byte_bpe_50k.json")
    ]
    assert spark.read.parquet(cache).count() == 2 and counts == [4, 4]


def test_differencing():
    for sizes, windows in (([8, 7, 6, 5, 4], 2), ([5, 5, 5], 3), ([9], 3), ([3, 3, 2, 2, 2], 2)):
        dealt = packing.difference(np.array(sizes), windows)
        assert len(dealt) == windows and sorted(sum(dealt, [])) == list(range(len(sizes)))
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference(np.array([8, 7, 6, 5, 4]), 2))
    assert sums == [14, 16]  # the known result of the method
    random = np.random.default_rng(1)
    sizes = random.integers(1, 200, 600)
    sums = [int(sizes[w].sum()) for w in packing.difference(sizes, 20)]
    assert max(sums) - min(sums) <= 5
    assert packing.difference(np.zeros(0, int), 0) == []


@pytest.mark.parametrize("cut", [True, False])
def test_windows_hold_everything_once(cut):
    random = np.random.default_rng(2)
    for count in (0, 1, 2, 7, 150):
        sizes = random.integers(1, 65, count)
        windows = packing.pack(sizes, 64, cut)
        assert all(sum(p[2] for p in w) <= 64 for w in windows)
        for item, size in enumerate(sizes):
            own = sorted((s, n) for w in windows for i, s, n in w if i == item)
            assert sum(n for _, n in own) == size and len(own) == 1 or cut
            assert [s for s, _ in own] == list(np.cumsum([0, *[n for _, n in own]])[:-1])
        if cut:
            assert len(windows) == -(-int(sizes.sum()) // 64)


def test_packed_documents(documents, texts):
    rows = [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again"), (999, "long text " * 30_000)]
    found = packing.pack_documents(documents(*rows), at_once=40).collect()
    tokenizer = library("byte_bpe_50k.json")
    expected = {}
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.setdefault(i, []).append(ids)
    sequences, pieces = {}, {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end <= 1024
    assert set(pieces) == set(expected)
    for i, own in pieces.items():
        assert sum(p.length for p in own) == sum(map(len, expected[i]))
        for p in own:
            parts = [e[p.start : p.start + p.length].tobytes() for e in expected[i] if len(e) == p.doc_tokens]
            assert p.ids_crc32 in map(zlib.crc32, parts)
    total = sum(r.length for r in found)
    padded = sum(1024 - sum(n for _, n in s) for s in sequences.values())
    assert padded < 0.1 * total
    assert packing.pack_documents(documents((1, "a")).limit(0)).collect() == []


def test_pieces_equal_the_original_library(spark, documents, texts):
    import sentencepiece

    original = sentencepiece.SentencePieceProcessor(model_file=path_of("piece_bpe_32k.model"))
    spaces = ["x" + " " * n + "y" + " " * n for n in range(40)] + [" " * n + "é" for n in range(40)]
    rows = [*enumerate(texts + spaces), (None, "no id"), (3, "again"), (3, "again")]
    encoded = sentence_pieces.encode(documents(*rows))
    found = sentence_pieces.decode(encoded.withColumn("decoded", encoded["doc_id"])).collect()
    expected = sorted(((i, t or "", original.encode(t or "")) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.text, r.ids) for r in found), key=str) == expected
    assert all(r.parity for r in found)
    assert all(r.decoded == r.text.replace("▁", " ") for r in found)
    assert sentence_pieces.encode(documents((1, "a")).limit(0)).collect() == []
    odd = spark.createDataFrame([(None,), ([],), ([1, 264],)], "ids array<int>")
    assert [r.decoded for r in sentence_pieces.decode(odd).collect()] == ["", "", "a"]


def test_round_trips_in_one_pass(spark, documents, texts):
    rows = [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again"), (998, "▁a ▁"), (999, "long te\x00xt " * 9000)]
    encoded = sentence_pieces.decode(sentence_pieces.encode(documents(*rows))).collect()
    found = sentence_pieces.round_trips(documents(*rows))
    assert found.columns == ["doc_id", "ids", "parity", "round_trip"]
    expected = [(r.doc_id, r.ids, r.parity, r.decoded == r.text.replace("▁", " ")) for r in encoded]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert sentence_pieces.round_trips(documents((1, "a")).limit(0)).collect() == []


def test_chunks_that_differ_are_told_by_their_texts():
    """Ids that the original library does not give, and texts whose chunks alone differ."""
    codec = sentence_pieces.Codec(path_of("piece_bpe_32k.model"), 1)

    class Other:
        def encode(self, texts, num_threads=1):
            whole = codec.tokenizer.encode_batch_fast([texts] if isinstance(texts, str) else texts, add_special_tokens=False)
            rows = [[7] if t in ("b", "a b") else e.ids for t, e in zip([texts] if isinstance(texts, str) else texts, whole, strict=True)]
            return rows[0] if isinstance(texts, str) else rows

    codec._original = Other()
    assert codec.encode(pa.array(["a", "a b", "c b", "b", None]))[2] == [True, False, True, False, True]


@pytest.mark.parametrize("joined", [b"", b"<|endoftext|>"])
def test_finer_cuts_are_cuts_too(joined):
    from tierline.llm.chunk_codes import cuts, finer_cuts
    from tierline.llm.columns import utf8

    data, starts = utf8(pa.array(["ab, c.\nThe ×, é!", None, "\nx", "a", "\nb\n\nc<|endoftext|>d"]))
    first = finer_cuts(data, starts, joined)
    assert set(cuts(data, starts)) <= set(first)
    pieces = [data[a:b].tobytes().decode() for a, b in zip(first, [*first[1:], len(data)], strict=True)]
    special = ["c<|endoftext|>d"] if joined else ["c", "<|endoftext", "|>d"]
    assert pieces == ["ab", ",", " c", ".", "\n", "The", " ×,", " é", "!", "\nx", "a", "\nb", "\n\n" + special[0], *special[1:]]


def proto(kind, pieces, **options):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.trainer_spec.model_type = kind
    model.trainer_spec.byte_fallback = True
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.escape_whitespaces = True
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.name = "identity"
    for name, value in options.items():
        setattr(model.normalizer_spec, name, value)
    for piece, score, kind_of in pieces:
        model.pieces.add(piece=piece, score=score, type=kind_of)
    return model


@pytest.mark.parametrize("extra", [False, True])
def test_unigram_scores_and_byte_fallback(tmp_path, extra):
    """A model written by hand: scores, not merges, decide."""
    sp = sentence_pieces
    pieces = [("<unk>", 0, sp.UNKNOWN), ("<s>", 0, sp.CONTROL)]
    pieces += [(f"<0x{n:02X}>", 0, sp.BYTE) for n in range(256)]
    pieces += [("▁", -3, 1), ("a", -4, 1), ("b", -4, 1), ("ab", -5, 1), ("▁a", -4.5, 1), ("▁ab", -9, 1)]
    pieces += [("ba", -6, 1), ("bab", -7.5, 1)]
    path = tmp_path / "unigram.model"
    path.write_bytes(proto(sp.UNIGRAM, pieces, remove_extra_whitespaces=extra).SerializeToString())
    codec = sp.Codec(str(path), 1)
    texts = ["ab", "abab", " ab  ba", "é", "a é b", "", "babab aab", "<s>", "  "]
    ids, starts, equal = codec.encode(pa.array(texts))
    assert all(equal)
    rows = [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)]
    assert rows == [codec._original.encode(t) for t in texts]
    surfaces = sp.Decoder(str(path))
    assert surfaces.texts(ids, starts) == [codec._original.decode(r) for r in rows]
    assert surfaces.texts(ids, starts) == codec.tokenizer.decode_batch(rows)
    assert extra or surfaces.texts(ids, starts) == texts
    assert surfaces.texts(np.array([1, 0]), np.array([0, 1, 2])) == ["", "⁇ "]


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="neither"):
        sentence_pieces.rebuild(proto(3, [("<unk>", 0, 2)]).SerializeToString())
