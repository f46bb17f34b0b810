"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are handed to the library in pieces that end where no match of the
pre-splitting pattern can span: between a character that is no white space and a
blank or line feed after it. So the pieces' ids, joined, are the ids of the whole
text, and a text is never held twice in the library. A text without such a place
stays in one piece.

Defined results: null text counts as empty and has no ids; decoding null ids gives
no bytes; ids outside the vocabulary raise. Strings that name special tokens are
ordinary text. Existing columns of the output names are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import python_ready

PIECE = 1 << 16  # characters handed to the library at once, up to the next safe place

_SAFE = re.compile(r"(?<=\S)(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text, cut at safe places at least ``size`` characters apart."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def text_ids(text: str | None, encoder: tiktoken.Encoding, size: int = PIECE) -> np.ndarray:
    if not text:
        return np.empty(0, np.int32)
    parts = [encoder.encode_to_numpy(piece, disallowed_special=()) for piece in pieces(text, size)]
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)).astype(np.int32, copy=False)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of each text as ``array<int>``."""
    @F.arrow_udf("array<int>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoding(rank_file, pattern)
        for batch in texts:
            found = [text_ids(value.as_py(), encoder) for value in batch]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found or [np.empty(0, np.int32)])))

    python_ready(docs.sparkSession)
    return docs.withColumn(ids, run(F.col(f"`{text}`")))


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the raw bytes that the ids stand for."""
    @F.arrow_udf("binary")
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = encoding(rank_file, pattern)
        for batch in lists:
            yield pa.array([decoder.decode_bytes(value.as_py() or []) for value in batch], pa.binary())

    python_ready(encoded.sparkSession)
    return encoded.withColumn(out, run(F.col(f"`{ids}`")))
