"""Language-model scores by causal self-attention over subword ids, in numpy.

Texts are lower-cased (A-Z), cut at ASCII white space into words, and each word, with a blank
before it, into subword ids of a public byte-level BPE; one end mark closes a text. The
probability of an id is that of its class given the ids before it, times its share in that
class. Classes group ids that stand in like surroundings. Words, ids and their neighbours are counted
over all training rows. The attention layer that predicts classes is trained by back-propagation on all
windows of all training rows: it starts from weights that ``STEPS`` batches of about ``WINDOWS`` drawn
windows give (they go several times over a small input); then, in ``ROUNDS`` rounds that together hold
every training row once, each core learns all windows of its part, and the means of the weights go on.

A window holds ``CONTEXT`` earlier ids and the ``SCORED`` ids that it scores; the next window
starts ``SCORED`` ids later, so every id is scored once with at least ``CONTEXT`` ids before
it (fewer at the beginning), and thousands of windows are scored at a time.

Word counts of the whole corpus never meet in one place: each task lists the different words of the
blocks of text that it reads and stores texts as places in that list. The words of the lists meet their
equals of other blocks in a shuffle by word, are cut into subword ids once there, and counts and ids
return to the block that asked. The ids of whole texts are stored, and neighbours, training and scores
read them there.

Defined results: null and empty texts are one end mark. A null id is a training row. Without
training rows all counts are 0 and the network keeps its starting weights. Repeated rows
count as often as they occur and get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.byte_bpe import encoding
from playtide.llm.frames import python_ready, slices, stored, whole_text
from playtide.llm.simhash import words_of

CONTEXT, SCORED = 16, 16
LENGTH = CONTEXT + SCORED
WIDTH = 16  # of an id's vector
CLASSES = 128
CLUSTERED = 4000  # most frequent ids that are classed by their surroundings
NEIGHBOURS = 256  # most frequent ids that count as surroundings
STEPS, BATCH = 1000, 256
WINDOWS = 1 << 16  # drawn for the first weights: each is used about four times
ROUNDS, LEARNT_AT_ONCE, RATE = 2, 1 << 12, 0.01  # of training on all windows
IDS_BYTES = 1 << 20  # of stored ids that are worked on at once
BLOCK_BYTES = 16 << 20  # of text whose words are listed together
WORDS_AT_ONCE = 1 << 18  # of blocks' lists that are cut into subword ids together
CHUNK, LEARNT_CHUNK = 1 << 6, 1 << 6  # windows scored at once, and learnt from at once
STEPPED = 1 << 11  # rows of weights that a step changes at once
SAFE = 60.0  # exponents up to this need no shift in 32 bits
WORDS_REMEMBERED, LONG_WORD = 200_000, 64  # words up to so many bytes are remembered
END_WORD = b"\n"  # stands for the end mark among words, which hold no white space


class Ids:
    """Subword ids of words; a bounded memory."""

    def __init__(self, rank_file: str, pattern: str):
        self.encoder = encoding(rank_file, pattern)
        self.end = self.encoder.max_token_value + 1
        self.start, self.none = self.end + 1, self.end + 2
        self.size = self.end + 1  # ids that can be predicted
        self._known: dict[bytes, list[int]] = {}

    def encode(self, word: bytes) -> list[int]:
        return [self.end] if word == END_WORD else self.encoder.encode_ordinary(" " + word.decode())

    def of_word(self, word: bytes) -> list[int]:
        if len(word) > LONG_WORD:
            return self.encode(word)
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= WORDS_REMEMBERED:
                self._known.clear()
            found = self._known[word] = self.encode(word)
        return found


_IDS: dict[tuple[str, str], Ids] = {}


def ids_for(rank_file: str, pattern: str) -> Ids:
    return _IDS.setdefault((rank_file, pattern), Ids(rank_file, pattern))


def words(text: str | None) -> list[bytes]:
    return [*words_of(text), END_WORD]


def windows(ids: np.ndarray, lengths: np.ndarray, start: int, none: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs ``(windows, LENGTH)`` and targets ``(windows, SCORED)``, -1 behind the last id, of texts laid end to end."""
    counts = -(-lengths // SCORED)
    first = (np.cumsum(counts) - counts).astype(np.int32)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(ids), dtype=np.int32) + np.repeat((first * SCORED - starts).astype(np.int32), lengths)
    targets = np.full((counts.sum(), SCORED), -1, np.int32)
    targets.ravel()[place] = ids
    # What a window scores follows the start mark or the id before; its context is what the window before it scored.
    before = np.empty(len(ids), np.int32)
    before[1:] = ids[:-1]
    before[starts[lengths > 0]] = start
    inputs = np.full((len(targets), 2, SCORED), none, np.int32)
    own = np.full(len(targets) * SCORED, none, np.int32)
    own[place] = before
    inputs[:, 1] = own.reshape(-1, SCORED)
    inputs[1:, 0] = inputs[:-1, 1]
    inputs[first[counts > 0], 0] = none
    return inputs.reshape(-1, LENGTH), targets


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


_BEHIND = CONTEXT + np.arange(SCORED)[:, None] - np.arange(LENGTH)[None, :]  # ids between a query and a key
_HIDDEN = np.where(_BEHIND < 0, np.float32(-1e4), np.float32(0))


@dataclass
class Model:
    """Weights, the class of each id and the logarithm of its share in the class."""

    classes: np.ndarray
    share: np.ndarray
    weights: dict[str, np.ndarray]

    def tables(self) -> dict[str, np.ndarray]:
        """What a forward pass takes: the vectors of ids with a one behind them, and what they are multiplied with."""
        return {**forward_tables(self.weights), "most": self.largest()}

    def largest(self) -> float:
        """No product of a query and a key, with its bias, is larger."""
        w = self.weights
        query, key = w["e"] @ w["q"] * WIDTH ** -0.5, w["e"] @ w["k"]
        return np.linalg.norm(query, axis=1).max() * np.linalg.norm(key, axis=1).max() + np.abs(w["p"]).max()


def forward_tables(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    kind = w["e"].dtype
    vectors, give = np.ones((len(w["e"]), WIDTH + 1), kind), np.zeros((WIDTH + 1, WIDTH + 1), kind)
    vectors[:, :-1], give[:-1, :-1], give[-1, -1] = w["e"], w["v"], 1
    return {"vectors": vectors, "asks": (w["q"] * WIDTH ** -0.5).astype(kind), "keys": w["k"].astype(kind), "give": give,
            "bias": np.ascontiguousarray((w["p"][np.maximum(_BEHIND, 0)] + _HIDDEN).T.astype(kind)),  # by key and query
            "out": np.concatenate([w["a"], w["x"], w["b"][None]]).astype(kind)}


def mild(sums: np.ndarray) -> bool:
    """Whether sums of exponentials are far from what 32 bits can't hold."""
    return bool(1e-15 < sums.min() and sums.max() < 1e15)


class Forward:
    """Exponentials of heeds and of class logits of up to ``room`` windows, in arrays that are used again."""

    def __init__(self, tables: dict[str, np.ndarray], room: int):
        self.tables, self.room, kind = tables, room, tables["vectors"].dtype
        asked, own = (room, LENGTH), (room, SCORED)
        self._arrays = [np.empty(shape, kind) for shape in (
            (*asked, WIDTH + 1), (*own, WIDTH), (*asked, WIDTH), (*asked, WIDTH + 1), (*asked, SCORED), (*own, WIDTH + 1),
            (*own, 2 * WIDTH + 1), (*own, CLASSES))]
        self._ones = np.ones(CLASSES, kind)
        self._first = np.arange(room * SCORED) * CLASSES

    def heeds(self, inputs: np.ndarray, none: int, shift: bool = False) -> None:
        """Set ``heed`` by key and query, its sums ``total`` and the ``state`` of each query that gives the logits."""
        t, many = self.tables, len(inputs)
        self.e, self.q, self.k, self.v, self.heed, self.mixed, self.state, self.z = (x[:many] for x in self._arrays)
        np.take(t["vectors"], inputs, axis=0, out=self.e, mode="clip")
        self.state[..., WIDTH:] = self.e[:, CONTEXT:]
        np.matmul(flat(self.state)[:, WIDTH:-1], t["asks"], out=flat(self.q))
        turned = np.ascontiguousarray(self.q.transpose(0, 2, 1))
        np.matmul(flat(self.e)[:, :WIDTH], t["keys"], out=flat(self.k))
        np.matmul(flat(self.e), t["give"], out=flat(self.v))
        # Empty places are whole contexts, or lie behind a text's end, where only queries that no target has see them.
        some = np.flatnonzero(inputs[:, CONTEXT - 1] == none)
        for shifted in (shift, True):  # mostly no exponent needs a shift, which the sums tell
            np.matmul(self.k, turned, out=self.heed)
            self.heed += t["bias"]
            self.heed[some, :CONTEXT] = -1e4  # the empty place is never heeded
            if shifted:
                self.heed -= self.heed.max(axis=1, keepdims=True)
            with np.errstate(over="ignore"):
                np.exp(self.heed, out=self.heed)
                np.matmul(self.heed.transpose(0, 2, 1), self.v, out=self.mixed)
            if shifted or mild(self.mixed[..., WIDTH]):
                break
        self.total = 1 / self.mixed[..., WIDTH:]
        np.multiply(self.mixed[..., :WIDTH], self.total, out=self.state[..., :WIDTH])

    def logits(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the wanted classes, less what all are shifted by, and sums of all exponentials, which ``z`` holds."""
        z, at = flat(self.z), self._first[:wanted.size] + wanted.ravel()
        for shifted in (False, True):
            np.matmul(flat(self.state), self.tables["out"], out=z)
            if shifted:
                z -= z.max(axis=1, keepdims=True)
            picked = z.ravel()[at]
            with np.errstate(over="ignore"):
                np.exp(z, out=z)
                sums = z @ self._ones
            if shifted or mild(sums):
                break
        self.at = at
        return picked, sums


def flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def log10_scores(model: Model, tables: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """log10 probability of each target; 0 where there is none."""
    out, none = np.empty(targets.shape, tables["vectors"].dtype), len(tables["vectors"]) - 1
    forward = Forward(tables, min(CHUNK, len(inputs)))
    for i in range(0, len(inputs), CHUNK):
        wanted = np.maximum(targets[i:i + CHUNK], 0)
        forward.heeds(inputs[i:i + CHUNK], none, tables["most"] > SAFE)
        picked, sums = forward.logits(model.classes[wanted])
        out[i:i + CHUNK] = (picked - np.log(sums)).reshape(wanted.shape) + model.share[wanted]
    return np.where(targets >= 0, out / np.log(10), 0)


def text_scores(model: Model, tables: dict[str, np.ndarray], ids: np.ndarray, lengths: np.ndarray,
                marks: Ids) -> np.ndarray:
    """log10 probability of each of the texts that lie end to end in ``ids``."""
    inputs, targets = windows(ids, lengths, marks.start, marks.none)
    sums = log10_scores(model, tables, inputs, targets).sum(axis=1)
    counts = -(-lengths // SCORED)
    return np.add.reduceat(sums, np.cumsum(counts) - counts)


def neighbours(counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How often each frequent id stands behind and before each of the most frequent ones, within texts laid end to end."""
    rank = np.full(len(counts) + 3, CLUSTERED)
    rank[np.argsort(-counts, kind="stable")[:CLUSTERED]] = np.arange(min(CLUSTERED, len(counts)))
    rank = rank.astype(np.int32)[ids]
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(lengths)[lengths > 0] - 1] = False
    first, second, inner = rank[:-1], rank[1:], inner[:-1]
    cells = []
    for a, b, shift in ((first, second, 0), (second, first, NEIGHBOURS)):
        use = np.flatnonzero((a < CLUSTERED) & (b < NEIGHBOURS) & inner)
        cells.append(a[use] * (2 * NEIGHBOURS) + b[use] + shift)
    return np.bincount(np.concatenate(cells), minlength=CLUSTERED * 2 * NEIGHBOURS).reshape(CLUSTERED, -1)


def class_of_ids(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A class for each id: frequent ids by their neighbours, others by frequency."""
    rng = np.random.default_rng(2)
    order = np.argsort(-counts, kind="stable")
    classes = np.zeros(len(counts), np.int32)
    rare = order[CLUSTERED:]
    classes[rare] = np.arange(len(rare)) * 4 // max(len(rare), 1)  # the last four classes, set off below
    frequent = order[:CLUSTERED]
    table = table.astype(float)
    mass = table.sum()
    if mass:
        expected = table.sum(axis=1, keepdims=True) * table.sum(axis=0, keepdims=True) / mass
        table = np.log1p(np.maximum(table / np.maximum(expected, 1e-9) - 1, 0))
    _, vectors = np.linalg.eigh(table.T @ table)
    points = table @ vectors[:, -16:]
    points /= np.linalg.norm(points, axis=1, keepdims=True) + 1e-6
    groups = CLASSES - 4
    centres = points[rng.choice(min(400, len(points)), groups, replace=False)]
    for _ in range(12):
        near = np.argmax(points @ centres.T, axis=1)
        for g in range(groups):
            if (near == g).any():
                centres[g] = points[near == g].mean(axis=0)
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-6
    classes[rare] += groups
    classes[frequent] = near[:len(frequent)]
    return classes


def train(texts: list[list[int]], counts: np.ndarray, marks: Ids, steps: int = STEPS) -> Model:
    """The model from whole texts and the id counts of all training rows."""
    flat, lengths = np.array([i for text in texts for i in text], np.int32), np.array([len(text) for text in texts], int)
    drawn = windows(flat, lengths, marks.start, marks.none) if texts else None
    return trained(drawn, neighbours(counts, flat, lengths), counts, marks, steps)


def trained(drawn: tuple[np.ndarray, np.ndarray] | None, table: np.ndarray, counts: np.ndarray, marks: Ids,
            steps: int) -> Model:
    """The model from windows, neighbour counts and id counts."""
    rng = np.random.default_rng(4)
    classes = class_of_ids(counts, table)
    smooth = counts + 0.5
    share = np.log(smooth / np.bincount(classes, smooth, CLASSES)[classes])
    normal = lambda *shape: (rng.standard_normal(shape) * shape[-1] ** -0.5).astype(np.float32)
    w = {"e": normal(marks.size + 2, WIDTH), "q": normal(WIDTH, WIDTH), "k": normal(WIDTH, WIDTH),
         "v": normal(WIDTH, WIDTH), "a": normal(WIDTH, CLASSES), "x": normal(WIDTH, CLASSES),
         "p": np.linspace(0, -2, LENGTH).astype(np.float32),
         "b": np.log(np.bincount(classes, smooth, CLASSES) / smooth.sum() + 1e-9).astype(np.float32)}
    if drawn is not None and len(drawn[0]):
        inputs, targets = drawn
        steered = Steps(w)
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(inputs), BATCH)
            steered.take(gradients(w, classes, inputs[rows], targets[rows], marks.none), 0.03 * (1 - step / (steps + 1)))
    return Model(classes, share, w)


class Steps:
    """Steps down the gradient, by its running mean and size, that change ``weights``."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights, self.taken = weights, 0
        self.mean = {name: np.zeros_like(value) for name, value in weights.items()}
        self.square = {name: np.zeros_like(value) for name, value in weights.items()}

    def take(self, grads: dict[str, np.ndarray], size: float) -> None:
        self.taken += 1
        size, flatter = size / (1 - 0.9 ** self.taken), 1 / (1 - 0.98 ** self.taken)
        for name, grad in grads.items():
            for i in range(0, len(grad), STEPPED):  # a few rows at a time, which a cache holds
                rows = slice(i, i + STEPPED)
                mean, square, g = self.mean[name][rows], self.square[name][rows], grad[rows].astype(self.mean[name].dtype)
                mean += 0.1 * (g - mean)
                g *= g
                g -= square
                g *= 0.02
                square += g
                np.multiply(square, flatter, out=g)
                np.sqrt(g, out=g)
                g += 1e-6
                np.divide(mean, g, out=g)
                g *= size
                self.weights[name][rows] -= g


def gradients(w: dict[str, np.ndarray], classes: np.ndarray, inputs: np.ndarray, targets: np.ndarray,
              none: int) -> dict[str, np.ndarray]:
    """Of the mean negative log probability of the targets' classes; summed over a few windows at a time, which a cache holds."""
    tables, kind = forward_tables(w), w["e"].dtype
    there, wanted = targets >= 0, classes[np.maximum(targets, 0)]
    out_back = np.ascontiguousarray(tables["out"][:-1].T)
    back = np.concatenate([w["k"].T, w["v"].T, tables["asks"].T]).astype(kind)
    d_out, d_bias = np.zeros_like(tables["out"]), np.zeros(tables["bias"].size, kind)
    d_all = np.zeros((WIDTH, 3 * WIDTH), kind)  # of keys, values and queries
    forward = Forward(tables, min(LEARNT_CHUNK, len(inputs)))
    room = np.empty((2 * forward.room, SCORED, 3 * WIDTH), kind)
    pairs, spreads = np.empty((forward.room, LENGTH, 2 * WIDTH), kind), np.empty((forward.room, SCORED, WIDTH + 1), kind)
    # A window mostly begins with what the one before it ends with: those places' gradients are added up first.
    begins = np.ones(len(inputs), bool)
    begins[1:] = (inputs[1:, :CONTEXT] != inputs[:-1, CONTEXT:]).any(axis=1)
    begins[::LEARNT_CHUNK] = True
    d_e, ids = [], []
    for i in range(0, len(inputs), LEARNT_CHUNK):
        part = slice(i, i + LEARNT_CHUNK)
        asked, new = inputs[part], np.flatnonzero(begins[part])
        many = len(asked)
        forward.heeds(asked, none)
        _, sums = forward.logits(wanted[part])
        dz, state = flat(forward.z), flat(forward.state)
        dz.ravel()[forward.at] -= sums
        share = (there[part].ravel() / sums).astype(kind)[:, None]
        d_state = dz @ out_back
        d_state *= share
        d_state = d_state.reshape(many, SCORED, -1)
        spread = spreads[:many]
        d_mixed = spread[..., :WIDTH]
        np.multiply(d_state[..., :WIDTH], forward.total, out=d_mixed)
        np.einsum("ijk,ijk->ij", d_mixed, forward.state[..., :WIDTH], out=spread[..., WIDTH])
        np.negative(spread[..., WIDTH], out=spread[..., WIDTH])
        ds = forward.v @ np.ascontiguousarray(spread.transpose(0, 2, 1))
        ds *= forward.heed
        d_bias += np.ones(many, kind) @ ds.reshape(many, -1)
        d_pairs = pairs[:many]
        np.matmul(ds, forward.q, out=d_pairs[..., :WIDTH])
        np.matmul(forward.heed, d_mixed, out=d_pairs[..., WIDTH:])
        d = room[:many + len(new)]
        d[many:, :, :2 * WIDTH] = d_pairs[new, :CONTEXT]
        d[many:, :, 2 * WIDTH:] = 0
        d_pairs[new, :CONTEXT] = 0
        np.add(d_pairs[:-1, CONTEXT:], d_pairs[1:, :CONTEXT], out=d[:many - 1, :, :2 * WIDTH])
        d[many - 1, :, :2 * WIDTH] = d_pairs[-1, CONTEXT:]
        np.matmul(ds.transpose(0, 2, 1), forward.k, out=d[:many, :, 2 * WIDTH:])
        e = np.concatenate([forward.e[:, CONTEXT:, :WIDTH], forward.e[new, :CONTEXT, :WIDTH]])
        d_all += flat(e).T @ flat(d)
        np.matmul(flat(d), back, out=flat(e))
        e[:many] += d_state[..., WIDTH:]
        d_e.append(flat(e))
        ids += [asked[:, CONTEXT:].ravel(), asked[new, :CONTEXT].ravel()]
        state *= share
        d_out += state.T @ dz
    at = np.concatenate(ids)
    order = np.argsort(at.astype(np.uint16 if none < 1 << 16 else np.int32), kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    g_e = np.zeros_like(w["e"])
    g_e[at[first]] = np.add.reduceat(np.concatenate(d_e).take(order, axis=0), first, axis=0)
    d_bias = d_bias.reshape(LENGTH, SCORED).T
    found = {"a": d_out[:WIDTH], "x": d_out[WIDTH:-1], "b": d_out[-1], "q": d_all[:, 2 * WIDTH:] * kind.type(WIDTH ** -0.5),
             "k": d_all[:, :WIDTH], "v": d_all[:, WIDTH:2 * WIDTH], "e": g_e,
             "p": np.bincount(np.maximum(_BEHIND, 0).ravel(), (d_bias * (_BEHIND >= 0)).ravel(), LENGTH)}
    size = kind.type(1 / max(np.count_nonzero(there), 1))
    return {name: grad * size for name, grad in found.items()}


def packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binaries of ``lengths`` values each, which lie end to end."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * values.itemsize
    if ends[-1] >= 1 << 31:
        raise OverflowError("texts of one batch have over 2 GB of ids")
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)),
                                                             pa.py_buffer(np.ascontiguousarray(values))])


def coded(docs: DataFrame, allowed: Column, text: str, id_column: str, block_bytes: int) -> DataFrame:
    """Texts as places of words in their block's list: rows ``block, id, learnt, codes``, and ``block, word, place, here`` of
    the list, where ``here`` is how often a word stands in the block's training rows.

    A block is what a task reads in a row, about ``block_bytes`` of text; its number holds as what is made here is stored.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"))
    rows = rows.select("id", F.coalesce(allowed, F.lit(True)).alias("learnt"), "text")
    names = {"block": pa.int64(), "word": pa.binary(), "place": pa.int32(), "here": pa.int64()}

    def listed(block: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lengths = [], []
        for batch in held:
            cut = pc.ascii_split_whitespace(pc.ascii_lower(batch["text"]))
            parts = cut.flatten()  # with empty ones where white space begins or ends a text, and at least one of each text
            full = pc.greater(pc.binary_length(parts), 0)
            sizes = pc.list_value_length(cut).to_numpy()
            lengths.append(np.add.reduceat(full.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes) - sizes))
            found.append(parts.filter(full))
        word = pa.concat_arrays(found).dictionary_encode()
        every = pa.concat_arrays([word.dictionary.cast(pa.binary()), pa.array([END_WORD], pa.binary())])
        ends = np.cumsum(np.concatenate(lengths))
        codes = np.insert(word.indices.to_numpy(), ends, len(every) - 1)
        learnt = np.concatenate([batch["learnt"].to_numpy(zero_copy_only=False) for batch in held])
        here = np.bincount(codes[np.repeat(learnt, np.concatenate(lengths) + 1)], minlength=len(every))
        made = [np.full(len(every), block), every, np.arange(len(every)), here]
        words = [pa.array(x, kind) for x, kind in zip(made, names.values())]
        texts = [*zip(("id", "learnt"), (held[0]["id"].type, pa.bool_())), ("codes", pa.binary())]
        yield pa.RecordBatch.from_arrays([*words, *(pa.nulls(len(every), kind) for _, kind in texts)],
                                         names=[*names, *(name for name, _ in texts)])
        begin = 0
        for batch, many in zip(held, lengths):
            end = begin + many.sum() + len(many)
            given = [pa.array(np.full(len(batch), block)), *(pa.nulls(len(batch), kind) for kind in [*names.values()][1:])]
            yield pa.RecordBatch.from_arrays([*given, batch["id"], batch["learnt"], packed(codes[begin:end], many + 1)],
                                             names=[*names, *(name for name, _ in texts)])
            begin = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, room, held = TaskContext.get().partitionId() << 32, 0, []
        for batch in slices(batches, "text", block_bytes):
            held.append(batch)
            room += batch["text"].nbytes
            if room >= block_bytes:
                yield from listed(block, held)
                block, room, held = block + 1, 0, []
        if held:
            yield from listed(block, held)

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"block bigint, word binary, place int, here bigint, id {id_type}, learnt boolean, codes binary")


def dictionary(here: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``block, place, first, count, ids`` of each word of each block: its count in all training rows and its subword
    ids; ``first`` is true in one row of each word."""
    def run(table: pa.Table) -> pa.Table:
        marks = ids_for(rank_file, pattern)
        kind = id_type_for(marks)
        word = table["word"].combine_chunks().dictionary_encode()
        which = word.indices.to_numpy()
        counts = np.zeros(len(word.dictionary), np.int64)
        np.add.at(counts, which, table["here"].to_numpy())
        found = [marks.encode(x) for x in word.dictionary.to_pylist()]
        ids = packed(np.fromiter(chain.from_iterable(found), kind), np.fromiter(map(len, found), np.int64))
        first = np.zeros(len(which), bool)
        first[np.unique(which, return_index=True)[1]] = True
        return pa.table({"block": table["block"], "place": table["place"], "first": pa.array(first),
                         "count": pa.array(counts[which]), "ids": ids.take(word.indices)})

    # A word has one row per block at most, so no word is a hot key.
    groups = here.count() // WORDS_AT_ONCE + 1
    return here.groupBy(F.pmod(F.xxhash64("word"), F.lit(groups))).applyInArrow(
        run, "block bigint, place int, first boolean, count bigint, ids binary")


def id_counts(known: DataFrame, size: int, rank_file: str, pattern: str) -> np.ndarray:
    """How often each subword id occurs in the training rows; the driver gets one row per id."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, total = id_type_for(ids_for(rank_file, pattern)), np.zeros(size, np.int64)
        for batch in batches:
            ids, lengths = texts_end_to_end(batch["ids"], kind)
            np.add.at(total, ids, np.repeat(batch["count"].to_numpy(), lengths))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["i", "n"])

    total = np.zeros(size, np.int64)
    summed = (known.where("first and count > 0").select("count", "ids").mapInArrow(count, "i bigint, n bigint")
              .groupBy("i").agg(F.sum("n").alias("n")).toArrow())
    total[summed["i"].to_numpy()] = summed["n"].to_numpy()
    return total


def id_type_for(marks: Ids) -> type:
    return np.uint16 if marks.none < 1 << 16 else np.int32


def encoded(texts: DataFrame, known: DataFrame, total: int, distinct: int, rank_file: str, pattern: str) -> DataFrame:
    """``id, learnt, n_tokens, n_known, base_score, ids``: each text with the subword ids of the whole of it."""
    id_type = texts.schema["id"].dataType.simpleString()

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        kind = id_type_for(ids_for(rank_file, pattern))
        order = np.argsort(right["place"].to_numpy())
        count = right["count"].to_numpy()[order]
        base = np.log10((count + 1) / (total + distinct + 1))
        held = right["ids"].to_pylist()
        flat = np.frombuffer(b"".join(held), kind)
        sizes = np.array([len(x) for x in held], np.int64) // flat.itemsize
        begins, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        columns: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": []}
        texts_ids: list[pa.Array] = []

        def finish(texts: list[np.ndarray]) -> None:
            lengths = np.array([len(x) for x in texts])
            every = np.concatenate(texts)
            starts = np.cumsum(lengths) - lengths
            columns["n_tokens"].append(lengths)
            columns["n_known"].append(np.add.reduceat((count[every] > 0).astype(np.int64), starts))
            columns["base_score"].append(np.add.reduceat(base[every], starts))
            size = sizes[every]
            ends = np.cumsum(size)
            ids = flat[np.arange(ends[-1]) - np.repeat(ends - size - begins[every], size)]
            texts_ids.append(packed(ids, np.add.reduceat(size, starts)))

        held, room = [], 0
        for codes in left["codes"]:
            held.append(np.frombuffer(codes.as_buffer(), np.int32))
            room += len(held[-1])
            if room > 200_000:
                finish(held)
                held, room = [], 0
        if held:
            finish(held)
        made = {name: np.concatenate(parts) if parts else np.empty(0) for name, parts in columns.items()}
        return pa.table({"id": left["id"], "learnt": left["learnt"],
                         **{name: pa.array(made[name], pa.int64()) for name in ("n_tokens", "n_known")},
                         "base_score": pa.array(made["base_score"], pa.float64()),
                         "ids": pa.chunked_array(texts_ids, pa.binary())})

    asked = known.select("block", "place", "count", "ids")
    return texts.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        run, f"id {id_type}, learnt boolean, n_tokens bigint, n_known bigint, base_score double, ids binary")


def texts_end_to_end(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The ids of stored texts, and how many each text has."""
    held = column.to_pylist()
    return (np.frombuffer(b"".join(held), kind).astype(np.int32),
            np.array([len(x) for x in held], np.int64) // np.dtype(kind).itemsize)


def neighbour_counts(learnt: DataFrame, counts: np.ndarray, rank_file: str, pattern: str) -> np.ndarray:
    """Neighbour counts of all training rows; at most one row per cell of the table reaches the driver."""
    shared = learnt.sparkSession.sparkContext.broadcast(counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, table = id_type_for(ids_for(rank_file, pattern)), np.zeros((CLUSTERED, 2 * NEIGHBOURS), np.int64)
        for batch in slices(batches, "ids", IDS_BYTES):
            table += neighbours(shared.value, *texts_end_to_end(batch["ids"], kind))
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table.ravel()[cells])], names=["cell", "n"])

    table = np.zeros((CLUSTERED, 2 * NEIGHBOURS), np.int64)
    summed = (learnt.select("ids").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
              .toArrow())
    table.ravel()[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return table


def first_windows(learnt: DataFrame, ids_in_all: int, rank_file: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """About ``WINDOWS`` windows, from any place of the training rows, that the weights start from."""
    keep = min(1.0, 1.3 * WINDOWS * SCORED / max(ids_in_all, 1))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = ids_for(rank_file, pattern)
        for batch in slices(batches, "ids", IDS_BYTES):
            ids, lengths = texts_end_to_end(batch["ids"], id_type_for(marks))
            inputs, targets = windows(ids, lengths, marks.start, marks.none)
            # Drawn by what a batch holds, so that a task that runs again draws the same.
            chosen = np.random.default_rng(int(ids.sum()) + len(ids)).random(len(inputs)) < keep
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x[chosen]), pa.list_(pa.int32())) for x in (inputs, targets)], names=["inputs", "targets"])

    found = learnt.select("ids").mapInArrow(draw, "inputs array<int>, targets array<int>").limit(2 * WINDOWS).toArrow()
    stacked = [np.concatenate([c.flatten().to_numpy() for c in found[name].chunks] or [np.empty(0, np.int32)]).reshape(-1, width)
               for name, width in (("inputs", LENGTH), ("targets", SCORED))]
    return stacked[0], stacked[1]


def _as_rows(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights as rows of ``WIDTH``."""
    return np.concatenate([value.reshape(-1, WIDTH) for value in weights.values()])


def _from_rows(rows: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    cuts = np.cumsum([value.size // WIDTH for value in like.values()])[:-1]
    return {name: part.reshape(value.shape).astype(value.dtype)
            for (name, value), part in zip(like.items(), np.split(rows, cuts))}


def learnt_from_all(model: Model, learnt: DataFrame, rank_file: str, pattern: str) -> tuple[Model, int]:
    """The model after training on every window of every training row, and how many windows these were.

    The driver gets the mean weights of a round, not those of each task.
    """
    context = learnt.sparkSession.sparkContext
    names = [f"w{i}" for i in range(WIDTH)]
    seen = 0
    for number in range(ROUNDS):
        shared, size = context.broadcast(model), RATE * (1 - number / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            marks, start = ids_for(rank_file, pattern), shared.value
            weights = {name: value.copy() for name, value in start.weights.items()}
            steered, many = Steps(weights), 0
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def learn(whole: bool) -> None:
                inputs, targets = (np.concatenate(x) for x in zip(*held))
                end = len(inputs) if whole else len(inputs) // LEARNT_AT_ONCE * LEARNT_AT_ONCE
                for i in range(0, end, LEARNT_AT_ONCE):
                    j = min(i + LEARNT_AT_ONCE, end)
                    steered.take(gradients(weights, start.classes, inputs[i:j], targets[i:j], marks.none), size)
                held[:] = [(inputs[end:], targets[end:])]

            for batch in slices(batches, "ids", IDS_BYTES):
                held.append(windows(*texts_end_to_end(batch["ids"], id_type_for(marks)), marks.start, marks.none))
                many += len(held[-1][0])
                learn(False)
            if many:
                learn(True)
                rows = _as_rows(weights).astype(float) * many
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), many)), *map(pa.array, rows.T.copy())],
                    names=["row", "many", *names])

        part = learnt.where(F.pmod(F.xxhash64("id", "n_tokens", F.lit("round")), F.lit(ROUNDS)) == number)
        # One set of weights a core, however large the input, and then as many rows for each; fewer for few partitions.
        part, cores = part.select("ids"), max(context.defaultParallelism, 1)
        sums = ((part.repartition(cores) if part.rdd.getNumPartitions() > cores else part)
                .mapInArrow(run, f"row bigint, many bigint, {', '.join(f'{n} double' for n in names)}")
                .groupBy("row").agg(F.sum("many").alias("many"), *[F.sum(n).alias(n) for n in names]).toArrow().sort_by("row"))
        if len(sums):
            many = sums["many"].to_numpy()
            seen += int(many[0])
            means = np.stack([sums[n].to_numpy() for n in names], axis=1) / many[:, None]
            model = Model(model.classes, model.share, _from_rows(means, model.weights))
    return model, seen


def score(docs: DataFrame, allowed: Column, rank_file: str, pattern: str, text: str = "text",
          id_column: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id, learnt, n_tokens, n_known, train_tokens, base_score, score`` of each text.

    ``allowed`` says of the column ``id`` which rows are learnt from.
    """
    spark = python_ready(docs.sparkSession)
    both = stored(coded(docs, allowed, text, id_column, block_bytes), "coded", compression="zstd")
    here = both.where("word is not null").select("block", "word", "place", "here")
    known = stored(dictionary(here, rank_file, pattern), "dictionary", compression="zstd")
    total, distinct = known.where("first").agg(F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 0)).first()
    marks = ids_for(rank_file, pattern)
    counts = id_counts(known, marks.size, rank_file, pattern)
    coded_texts = both.where("codes is not null").select("block", "id", "learnt", "codes")
    texts = stored(encoded(coded_texts, known, total, distinct, rank_file, pattern), "text-ids", compression="zstd")
    learnt = texts.where("learnt")
    table = neighbour_counts(learnt, counts, rank_file, pattern)
    model = trained(first_windows(learnt, int(counts.sum()), rank_file, pattern), table, counts, marks, STEPS)
    model, _ = learnt_from_all(model, learnt, rank_file, pattern)
    shared = spark.sparkContext.broadcast(model)
    columns = ["id", "learnt", "n_tokens", "n_known", "train_tokens", "base_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, model = ids_for(rank_file, pattern), shared.value
        tables = model.tables()
        for batch in slices(batches, "ids", IDS_BYTES):
            scores = text_scores(model, tables, *texts_end_to_end(batch["ids"], id_type_for(marks)), marks)
            yield pa.RecordBatch.from_arrays([*(batch[name] for name in columns), pa.array(scores.astype(float))],
                                             names=[*columns, "score"])

    id_type = texts.schema["id"].dataType.simpleString()
    return texts.withColumn("train_tokens", F.lit(total).cast("bigint")).select(*columns, "ids").mapInArrow(
        run, f"id {id_type}, learnt boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double")
