"""Tokenizers of the tokenizers library, loaded once a Python worker."""

import hashlib
import json
import os
from functools import lru_cache, partial
from pathlib import Path

from tierline.llm.chunk_codes import ChunkCodes, cuts, finer_cuts


def path_of(name: str) -> str:
    """Where the installed vocabulary file lies; executors need it at the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def version_digest(path: str) -> str:
    """Names a tokenizer: its file's content and the library that runs it."""
    import tokenizers

    return hashlib.sha256(
        Path(path).read_bytes() + f"|tokenizers {tokenizers.__version__}".encode()
    ).hexdigest()


def _way_to_cut(path: str):
    """Byte-level tokenizers with their usual split into runs allow finer cuts than at spaces."""
    content = json.loads(Path(path).read_bytes())
    split = content.get("pre_tokenizer") or {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex", True)
    if not usual or split.get("add_prefix_space") or content.get("normalizer"):
        return cuts
    joined = "".join(token["content"] for token in content.get("added_tokens", []))
    return partial(finer_cuts, joined=joined.encode())


@lru_cache(maxsize=4)
def chunk_codes(path: str) -> ChunkCodes:
    """Encodes without added special tokens, truncation or padding.

    Special strings inside a text become their own ids, as is the library's default.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return ChunkCodes(
        lambda chunks: [
            row.ids for row in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        ],
        cut=_way_to_cut(path),
    )
