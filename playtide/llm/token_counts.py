"""Token counts of whole texts for a sentencepiece BPE model, mostly without encoding.

The library turns blanks into a word mark and puts one mark before the text. No
vocabulary string has a mark behind another character (checked when the model is
loaded), so no merge crosses from a character to a following mark, and a text's count
is the sum over its pre-tokens: marks followed by other characters. Offline, every
vocabulary string of that shape is encoded alone; those that come back as one token
count one wherever they stand as a pre-token. Only the other pre-tokens are merged, by
the library, short ones once each while they stay in a bounded memory.

Defined results: null and empty texts have no tokens; strings that name special tokens
are ordinary text, as the library treats them. An existing output column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import python_ready

MARK = "▁"
REMEMBERED, LONG = 600_000, 64  # merged pre-tokens that a worker remembers, of so many characters at most
PIECE = 1 << 20  # characters that are split into pre-tokens at once

_PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}]*")


class PreTokenCounts(dict):
    """Tokens of each pre-token: proven ones from the start, others when they are asked for."""

    def __init__(self, model_file: str):
        super().__init__()
        self._model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._mark_alone = len(self._model.encode("x ", num_threads=1)) - len(self._model.encode("x", num_threads=1))
        strings = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
        if any(MARK in string.lstrip(MARK) for string in strings):
            raise ValueError("a vocabulary string has a word mark inside; pre-tokens can't be counted alone")
        shaped = [(i, s) for i, s in enumerate(strings) if len(s) > 1 and s[0] == MARK and s[1:].strip(MARK)]
        for (i, string), found in zip(shaped, self._model.encode([s[1:] for _, s in shaped], num_threads=1)):
            if found == [i]:
                self[string] = 1
        self.proven = dict(self)

    def __missing__(self, pre_token: str) -> int:
        """The library puts the first mark there itself, so it is taken off before."""
        rest = pre_token[1:]
        count = len(self._model.encode(rest, num_threads=1)) if rest else self._mark_alone
        if len(pre_token) <= LONG:  # longer ones hardly come again, and would fill the memory
            if len(self) >= REMEMBERED + len(self.proven):
                self.clear()
                self.update(self.proven)
            self[pre_token] = count
        return count

    def of_text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        total = start = 0
        while len(marked) - start > PIECE:
            cut = _boundary(marked, start + PIECE)
            if cut < 0:
                break
            total += sum(map(self.__getitem__, _PRE_TOKEN.findall(marked, start, cut)))
            start = cut
        return total + sum(map(self.__getitem__, _PRE_TOKEN.findall(marked, start)))


def _boundary(marked: str, start: int) -> int:
    """The next place where a pre-token begins, or -1."""
    place = marked.find(MARK, start)
    while place > 0 and marked[place - 1] == MARK:
        place = marked.find(MARK, place + 1)
    return place


@lru_cache(maxsize=2)
def pre_token_counts(model_file: str) -> PreTokenCounts:
    return PreTokenCounts(model_file)


def count_tokens(docs: DataFrame, model_file: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text."""
    @F.arrow_udf("bigint")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = pre_token_counts(model_file)
        for batch in texts:
            yield pa.array([counts.of_text(value.as_py()) for value in batch], pa.int64())

    python_ready(docs.sparkSession)
    return docs.withColumn(out, run(F.col(f"`{text}`")))
