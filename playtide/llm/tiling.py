"""Benchmark decontamination by greedy string tiling.

Every run of ``min_match`` words that a text shares with a benchmark item is a seed, found
by Karp-Rabin hashes over word numbers. Seeds that no equal word precedes are grown word by
word to maximal matches; the seeds inside a match are never listed, so a line that both sides
repeat costs what its matches cost. Equal items are compared once, and an item that the shared
seeds together can't cover is left out before any match is listed. The longest match whose words are free on both sides is marked,
again and again; a match that lost words to a longer one is cut down to what is left of it,
as long as that has ``min_match`` words. The share of an item's words under tiles is its
coverage, which does not depend on the order of the passages: a text that holds an item's
sentences shuffled covers it too.

The benchmark goes to the tasks in blocks of bounded size; texts are read once per block,
whole, and never shuffled. Words are runs of letters, digits and underscores in lower case.

Defined results: null and empty texts, and items with fewer than ``min_match`` words, match
nothing. Repeated documents or items each get their own rows. Ties between matches of equal
length go to the earlier place in the text, then in the item. An empty benchmark leaves all
documents as they are.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from playtide.llm.frames import python_ready

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 4 << 20  # of benchmark text that a task holds at once

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def rolling(numbers: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2**64, of every run of ``size`` numbers."""
    count = len(numbers) - size + 1
    total = np.zeros(max(count, 0), np.uint64)
    for i in range(size):
        total = total * _BASE + numbers[i:i + len(total)].astype(np.uint64)
    return total


def greedy_tiles(pairs: np.ndarray, min_match: int, text_words: int, item_words: int) -> list[tuple[int, int, int]]:
    """Tiles ``(text place, item place, words)`` out of the places where runs of ``min_match`` words are equal.

    A third column gives the words of matches that are already as long as they can be.
    """
    if pairs.shape[1] == 2:
        pairs = pairs[np.lexsort((pairs[:, 0], pairs[:, 0] - pairs[:, 1]))]
        diagonal = pairs[:, 0] - pairs[:, 1]
        starts = np.flatnonzero(np.r_[True, (np.diff(diagonal) != 0) | (np.diff(pairs[:, 0]) != 1)])
        lengths = np.diff(np.r_[starts, len(pairs)]) + min_match - 1
        pairs = np.column_stack([pairs[starts], lengths])
    matches = [(-n, i, j) for i, j, n in pairs.tolist()]
    heapq.heapify(matches)
    reached = covered_by(pairs[:, 1], pairs[:, 2], item_words)
    in_text, in_item = np.zeros(text_words, bool), np.zeros(item_words, bool)
    tiles, looked = [], -1
    while matches and not in_item.all():
        length, i, j = heapq.heappop(matches)
        free = ~(in_text[i:i - length] | in_item[j:j - length])
        if free.all():
            in_text[i:i - length] = in_item[j:j - length] = True
            tiles.append((i, j, -length))
            continue
        if looked < len(tiles):  # is there room for another tile at all?
            looked = len(tiles)
            left = np.cumsum(np.r_[0, reached & ~in_item])
            if not (left[min_match:] - left[:-min_match] == min_match).any():
                break
        edges = np.flatnonzero(np.diff(np.r_[False, free, False]))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start >= min_match:
                heapq.heappush(matches, (start - stop, i + start, j + start))
    return tiles


def covered_by(starts: np.ndarray, lengths: np.ndarray | int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the runs."""
    steps = np.bincount(starts, minlength=size + 1) - np.bincount(starts + lengths, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


class Item:
    """The words of a benchmark item, and its runs by hash, then by the word before the run."""

    def __init__(self, words: np.ndarray, min_match: int, vocabulary: int):
        self.words, self.min_match, self.span = words, min_match, vocabulary + 3
        hashes = rolling(words, min_match)
        before = np.r_[-2, words[:len(hashes) - 1]]
        self.place = np.lexsort((before, hashes))
        self.hash, group, counts = np.unique(hashes[self.place], return_inverse=True, return_counts=True)
        self.bounds = np.r_[0, np.cumsum(counts)]
        self.key = group * self.span + before[self.place] + 2

    def reached(self, hashes: np.ndarray) -> int:
        """How many words lie in a run with one of the hashes, which are sorted: no text with these covers more."""
        at = np.minimum(np.searchsorted(hashes, self.hash), len(hashes) - 1)
        runs = np.repeat(hashes[at] == self.hash, np.diff(self.bounds))
        return int(covered_by(self.place[runs], self.min_match, len(self.words)).sum())

    def matches(self, numbers: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """``(text place, item place, words)`` of the longest equal runs.

        Only pairs of runs with different words before them are listed: the others are the
        inside of a longer match. So a repeated line gives a match per diagonal, not per pair.
        """
        group = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        here = self.hash[group] == hashes
        group, places = group[here], places[here]
        before = np.where(places > 0, numbers[places - 1], -1)
        key = group * self.span + before + 2
        low, high = np.searchsorted(self.key, key), np.searchsorted(self.key, key, "right")
        ranges = np.concatenate([self.bounds[group], high]), np.concatenate([low, self.bounds[group + 1]])
        counts = ranges[1] - ranges[0]
        at = np.repeat(np.concatenate([places, places]), counts)
        index = np.arange(len(at)) + np.repeat(ranges[0] - np.cumsum(counts) + counts, counts)
        return self._longest(numbers, at, self.place[index])

    def _longest(self, numbers: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        length = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        while len(live) > 64:
            a, b = i[live] + length[live], j[live] + length[live]
            inside = (a < len(numbers)) & (b < len(self.words))
            live, a, b = live[inside], a[inside], b[inside]
            live = live[numbers[a] == self.words[b]]
            length[live] += 1
        for m in live.tolist():
            a, b = i[m] + length[m], j[m] + length[m]
            most = min(len(numbers) - a, len(self.words) - b)
            other = np.flatnonzero(numbers[a:a + most] != self.words[b:b + most])
            length[m] += other[0] if len(other) else most
        sure = length >= self.min_match  # the others had equal hashes only
        return np.column_stack([i, j, length])[sure]


class Block:
    """Some benchmark items, equal ones once, and which of them have a run with a hash."""

    def __init__(self, items: list[tuple], min_match: int):
        self.min_match = min_match
        self.vocabulary: dict[str, int] = {}
        self.ids: list = []
        owners: dict[tuple[str, ...], list] = {}
        for item_id, text in items:
            found = tuple(words_of(text))
            if len(found) >= min_match:
                self.ids.append(item_id)
                owners.setdefault(found, []).append(item_id)
        number = lambda word: self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        words = [np.array([*map(number, found)], np.int64) for found in owners]
        self.owners = list(owners.values())
        self.items = [Item(x, min_match, len(self.vocabulary)) for x in words]
        hashes = np.concatenate([x.hash for x in self.items] or [np.empty(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        self.of_hash = np.repeat(np.arange(len(self.items)), [len(x.hash) for x in self.items])[order]
        self.hash, first = np.unique(hashes[order], return_index=True)
        self.bounds = np.r_[first, len(hashes)]

    def numbers(self, text: str | None) -> np.ndarray:
        found = words_of(text)
        return np.fromiter(map(self.vocabulary.get, found, itertools.repeat(0)), np.int64, len(found))

    def matches(self, text: str | None, coverage: float) -> list[dict]:
        """Items that the text covers to the given share."""
        numbers, size = self.numbers(text), self.min_match
        if len(numbers) < size or not len(self.hash):
            return []
        known = np.cumsum(np.r_[0, numbers > 0])
        places = np.flatnonzero(known[size:] - known[:-size] == size)
        hashes = rolling(numbers, size)[places]
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        hit = self.hash[at] == hashes
        places, hashes = places[hit], hashes[hit]
        shared = np.unique(at[hit])
        near = np.unique(np.concatenate([self.of_hash[self.bounds[x]:self.bounds[x + 1]] for x in shared])) \
            if len(shared) else []
        found = []
        for index in near:
            item = self.items[index]
            words = len(item.words)
            if item.reached(self.hash[shared]) < coverage * words:
                continue
            matches = item.matches(numbers, places, hashes)
            tiles = greedy_tiles(matches, size, len(numbers), words)
            covered = sum(tile[2] for tile in tiles)
            if tiles and covered >= coverage * words:
                found += [{"item_id": owner, "item_words": words, "covered_words": covered,
                           "tiles": [{"text_place": i, "item_place": j, "words": n} for i, j, n in tiles]}
                          for owner in self.owners[index]]
        return found


def blocks(benchmark: DataFrame, min_match: int = MIN_MATCH, text: str = "text", id_column: str = "item_id",
           block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes``, one at a time on the driver."""
    items = benchmark.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = total // block_bytes + 1
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block).orderBy("id", "text").collect()
        yield Block([tuple(row) for row in rows], min_match)


def _matches(block: Block, coverage: float, id_type: DataType, text: str) -> Column:
    kind = (f"array<struct<item_id:{id_type.simpleString()},item_words:bigint,covered_words:bigint,"
            "tiles:array<struct<text_place:bigint,item_place:bigint,words:bigint>>>>")
    @F.arrow_udf(kind)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        arrow = None
        for batch in texts:
            found = [block.matches(value.as_py(), coverage) for value in batch]
            if arrow is None:
                tile = pa.struct([(name, pa.int64()) for name in ("text_place", "item_place", "words")])
                arrow = pa.list_(pa.struct([("item_id", to_arrow_type(id_type)), ("item_words", pa.int64()),
                                            ("covered_words", pa.int64()), ("tiles", pa.list_(tile))]))
            yield pa.array(found, arrow)

    return run(F.col(f"`{text}`"))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                 text: str = "text", id_column: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """One row per document and item it covers: ids, words of the item, words covered, and the tiles."""
    python_ready(docs.sparkSession)
    id_type = benchmark.schema[item_id].dataType
    result = None
    for block in blocks(benchmark, min_match, id_column=item_id):
        found = (docs.select(F.col(f"`{id_column}`").alias(id_column),
                             F.explode(_matches(block, coverage, id_type, text)).alias("match"))
                 .select(id_column, "match.*"))
        result = found if result is None else result.union(found)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                      coverage: float = COVERAGE, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents that cover no item."""
    python_ready(docs.sparkSession)
    id_type = benchmark.schema[item_id].dataType
    for block in blocks(benchmark, min_match, id_column=item_id):
        docs = docs.where(F.size(_matches(block, coverage, id_type, text)) == 0)
    return docs
