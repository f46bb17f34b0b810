"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text is cut into overlapping windows of words. Each word enters as a few numbers from two
tables: one of words, one of character runs inside them (with marks at a word's ends), so
that unseen forms of a known stem are recognised. The tables hold smoothed log odds, counted
on one half of the training texts; the network is trained by back-propagation on the other
half, so it learns how far they can be trusted; then the tables are counted on both halves. The two directions' states are pooled by
attention into one score per window, a text's score is that of its highest window, and a
logistic curve fitted on the training half turns it into a probability.

Training takes a bounded sample of labelled rows (``SAMPLE`` of each label, chosen by hash, one
row per id; of texts above ``SAMPLE_CHARS`` characters, excerpts of that length); scoring takes
every window of every text. Long runs without blanks count as several words.

Defined results: null and empty texts have one empty window and get a score like any other.
Without training rows of both labels every score is the share of label 1 among the training
rows, or 0 if there are none. Repeated rows get equal scores, up to the rounding
of single precision. Null labels are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtide.llm.frames import drawn_rows, python_ready, whole_text

SAMPLE = 2000  # training rows of each label
SAMPLE_CHARS, EXCERPTS = 20_000, 4  # of a training row; longer ones give so many excerpts of that length together
LONG_WORD, LAP = 64, 4  # characters of a token that is one word; longer ones are cut, each piece taking up the last few
WINDOW, STEP = 48, 32  # words of a window, and from one window to the next
STATE, POOL = 8, 8  # units of each direction, of the attention
BATCH = 2048  # windows scored at once
TURNS = 3  # of training; each takes the windows that the last one scored highest
WORDS_REMEMBERED = 300_000
WORD, RUN = -1.0, 0.3  # what a table keeps: all words seen often, so that they are known, and telling runs
EVIDENCE = 15.0  # log likelihood ratio at which a feature's odds count half

_EDGE = re.compile(r"^\W+|\W+$")
FEATURES = 6


def ngrams(word: str) -> set[str]:
    marked = f"^{word}$"
    return {marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)}


def plain(token: str) -> str:
    """A word in lower case without the signs around it."""
    return token.lower() if token.isalnum() else _EDGE.sub("", token).lower()


def tokens(text: str | None) -> list[str]:
    """What stands between white space, cut to bounded words."""
    found = (text or "").split()
    if max(map(len, found), default=0) > LONG_WORD:
        found = [t[i:i + LONG_WORD] for t in found for i in range(0, max(1, len(t) - LAP), LONG_WORD - LAP)]
    return found


def word_sets(texts: Iterable[str]) -> Iterator[set[str]]:
    """The different words of each text, one text at a time."""
    for text in texts:
        yield {plain(token) for token in set(tokens(text))} - {""}


def run_sets(texts: Iterable[str]) -> Iterator[set[str]]:
    """The different character runs of each text's words."""
    for found in word_sets(texts):
        yield set().union(*map(ngrams, found))


def log_odds(texts: Iterable[set[str]], labels: np.ndarray, above: float, least: int = 4) -> dict[str, float]:
    """Of each feature in at least ``least`` texts, how its presence shifts the odds.

    Clipped, and shrunk by the weight of the evidence (the likelihood ratio of two rates against
    one), so that a few chance meetings stay below a stem that is seen often. Only those above
    ``above``, up or down.
    """
    counts = (Counter(), Counter())
    for features, label in zip(texts, labels):
        counts[label].update(features)
    names = [name for name in counts[0].keys() | counts[1].keys() if counts[0][name] + counts[1][name] >= least]
    if not names:
        return {}
    n = np.array([[(labels == y).sum()] for y in (0, 1)], float)
    c = np.array([[counts[y][name] for name in names] for y in (0, 1)], float)
    rate = c.sum(axis=0) / n.sum()
    odds = np.log((c + 3 * rate + 0.1) / (n + 3))
    odds = np.clip(odds[1] - odds[0], -3, 3)
    plog = lambda x, q: x * np.log(np.maximum(q, 1e-12))
    evidence = (plog(c, c / n) + plog(n - c, 1 - c / n) - plog(c, rate) - plog(n - c, 1 - rate)).sum(axis=0)
    value = odds * evidence / (evidence + EVIDENCE)
    return {names[i]: float(value[i]) for i in np.flatnonzero(np.abs(value) > above)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    words: dict[str, float]
    runs: dict[str, float]
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)

    def __post_init__(self):
        if not self.weights:
            rng = np.random.default_rng(7)
            normal = lambda *shape: rng.standard_normal(shape).astype(np.float32) * np.float32(shape[0] ** -0.5)
            for side in "fb":
                self.weights |= {f"x{side}": normal(FEATURES, 3 * STATE), f"h{side}": normal(STATE, 3 * STATE),
                                 f"c{side}": np.zeros(3 * STATE, np.float32)}
            self.weights |= {"a": normal(2 * STATE, POOL), "v": normal(POOL), "o": normal(2 * STATE),
                             "b": np.zeros(1, np.float32)}

    def features(self, token: str) -> list[float]:
        word = plain(token)
        odds = [self.runs.get(run, 0.0) for run in ngrams(word)] if word else [0.0]
        return [self.words.get(word, 0.0), float(word in self.words), max(odds), min(odds), sum(odds) / len(odds),
                min(len(word), 20) / 10]

    def _gates(self, x: np.ndarray, h: np.ndarray, side: str, inner: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step of a direction; x has the input's share of all gates."""
        pre = x[:, :2 * STATE] + inner[:, :2 * STATE]
        gate = sigmoid(pre)
        z, r = gate[:, :STATE], gate[:, STATE:]
        n = np.tanh(x[:, 2 * STATE:] + r * inner[:, 2 * STATE:])
        return n + z * (h - n), z, r, n

    def run(self, x: np.ndarray, there: np.ndarray, keep: bool = False):
        """Scores of windows ``x`` (windows, words, features); ``there`` marks real words."""
        w, (count, steps, _) = self.weights, x.shape
        states = np.zeros((steps, count, 2 * STATE), np.float32)
        trace: dict = {"f": [], "b": []}
        for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            part = slice(0, STATE) if side == "f" else slice(STATE, 2 * STATE)
            h = np.zeros((count, STATE), np.float32)
            for t in order:
                inner = h @ w["h" + side]
                new, z, r, n = self._gates(x[:, t] @ w["x" + side] + w["c" + side], h, side, inner)
                new *= there[:, t, None]
                if keep:
                    trace[side].append((t, h, inner, z, r, n))
                states[t, :, part] = h = new
        tanh = np.tanh(states @ w["a"])
        heed = tanh @ w["v"]
        heed = np.where(there.T > 0, heed, -30)
        heed = np.exp(heed - heed.max(axis=0))
        heed /= heed.sum(axis=0)
        pooled = np.einsum("tc,tch->ch", heed, states, optimize=True)
        score = pooled @ w["o"] + w["b"][0]
        return (score, states, tanh, heed, pooled, trace) if keep else score

    def gradients(self, x: np.ndarray, there: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        score, states, tanh, heed, pooled, trace = self.run(x, there, keep=True)
        d = ((sigmoid(score) - labels) / len(labels)).astype(np.float32)
        g = {name: np.zeros_like(value) for name, value in w.items()}
        g["o"], g["b"][0] = pooled.T @ d, d.sum()
        dpooled = d[:, None] * w["o"]
        dheed = np.einsum("ch,tch->tc", dpooled, states, optimize=True)
        dheed = heed * (dheed - (heed * dheed).sum(axis=0))
        g["v"] = np.einsum("tc,tcp->p", dheed, tanh, optimize=True)
        dtanh = dheed[..., None] * w["v"] * (1 - tanh ** 2)
        g["a"] = np.einsum("tch,tcp->hp", states, dtanh, optimize=True)
        dstates = heed[..., None] * dpooled + dtanh @ w["a"].T
        for side in "fb":
            part = slice(0, STATE) if side == "f" else slice(STATE, 2 * STATE)
            dh = np.zeros((len(x), STATE), np.float32)
            for t, h, inner, z, r, n in reversed(trace[side]):
                dh = (dh + dstates[t, :, part]) * there[:, t, None]
                dn = dh * (1 - z) * (1 - n ** 2)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * inner[:, 2 * STATE:] * r * (1 - r)
                dx = np.concatenate([dz, dr, dn], axis=1)
                dinner = np.concatenate([dz, dr, dn * r], axis=1)
                g["x" + side] += x[:, t].T @ dx
                g["c" + side] += dx.sum(axis=0)
                g["h" + side] += h.T @ dinner
                dh = dh * z + dinner @ w["h" + side].T
        return g

    def fit(self, x: np.ndarray, there: np.ndarray, labels: np.ndarray, steps: int, batch: int = 192,
            rate: float = 0.02, seed: int = 1) -> None:
        """Adam on balanced batches of windows."""
        rng = np.random.default_rng(seed)
        mean = {name: np.zeros_like(value) for name, value in self.weights.items()}
        square = {name: np.zeros_like(value) for name, value in self.weights.items()}
        sides = [np.flatnonzero(labels == y) for y in (0, 1)]
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(side, batch // 2) for side in sides])
            for name, grad in self.gradients(x[rows], there[rows], labels[rows]).items():
                grad = np.clip(grad, -1, 1)
                mean[name] += 0.1 * (grad - mean[name])
                square[name] += 0.01 * (grad ** 2 - square[name])
                size = rate * (1 - step / (steps + 1))
                self.weights[name] -= (size * (mean[name] / (1 - 0.9 ** step))
                                       / (np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)


class Features(dict):
    """The row of each token in a table of features; starts anew when it holds too many."""

    def __init__(self, network: Network):
        super().__init__()
        self._network = network
        self.rows = np.zeros((1 << 12, FEATURES), np.float32)

    def __missing__(self, token: str) -> int:
        place = len(self) + 1  # row 0 is no word
        if place >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[place] = self._network.features(token)
        self[token] = place
        return place

    def places(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


def window_starts(count: int) -> np.ndarray:
    """Overlapping windows that cover ``count`` words; one, if there are few or none."""
    return np.arange(0, max(count - WINDOW, 0) + STEP, STEP)


def windows(places: np.ndarray) -> np.ndarray:
    """The rows of the feature table for each window; 0 behind the last word."""
    starts = window_starts(len(places))
    padded = np.concatenate([places, np.zeros(starts[-1] + WINDOW - len(places), np.int32)])
    return padded[starts[:, None] + np.arange(WINDOW)]


def text_scores(network: Network, texts: list[str | None], memory: Features) -> np.ndarray:
    """The highest window score of each text, before the logistic curve."""
    if len(memory) > WORDS_REMEMBERED:
        memory.clear()
    cut = [windows(memory.places(tokens(text))) for text in texts]
    counts = np.array([len(c) for c in cut])
    every = np.concatenate(cut)
    scores = np.concatenate([network.run(memory.rows[part], (part > 0).astype(np.float32))
                             for part in (every[i:i + BATCH] for i in range(0, len(every), BATCH))])
    return np.maximum.reduceat(scores, np.cumsum(counts) - counts)


def train(rows: list[tuple[str, int]], share: float | None = None, steps: int = 450) -> Network | float:
    """A network from ``(text, label)`` rows, or the share of label 1 where one label is missing.

    ``share`` is the share of label 1 among all training rows, if the rows are drawn otherwise.
    """
    rows = sorted(set(rows))  # copies would weigh a text more than once
    np.random.default_rng(3).shuffle(rows)
    labels = np.array([label for _, label in rows], np.int64)
    half = np.arange(len(rows)) % 2
    if min((labels[half == k] == y).sum() for k in (0, 1) for y in (0, 1)) < 2:
        return float(labels.mean()) if len(rows) else 0.0
    texts = [text for text, _ in rows]
    first, second = np.flatnonzero(half == 0), np.flatnonzero(half == 1)
    counted = [texts[i] for i in first]
    network = Network(log_odds(word_sets(counted), labels[first], WORD), log_odds(run_sets(counted), labels[first], RUN))
    memory = Features(network)
    cut = [windows(memory.places(tokens(texts[i]))) for i in second]
    owner = np.repeat(np.arange(len(second)), [len(c) for c in cut])
    every = np.concatenate(cut)
    # The window that stands for a text: first the one with the highest odds, then the one the network scores highest.
    guess = memory.rows[every][:, :, [0, 2]].max(axis=1).sum(axis=1)
    rng = np.random.default_rng(5)
    for turn in range(TURNS):
        order = np.lexsort((-guess, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner, owner[order])
        clean = labels[second][owner[order]] == 0
        extra = rng.permutation(np.flatnonzero(labels[second][owner] == 0))[:len(second)]
        chosen = np.concatenate([order[(rank == 0) | (clean & (rank < 4))], extra])
        part = every[chosen]
        network.fit(memory.rows[part], (part > 0).astype(np.float32), labels[second][owner[chosen]], steps // TURNS,
                    seed=turn)
        guess = np.concatenate([network.run(memory.rows[p], (p > 0).astype(np.float32))
                                for p in (every[i:i + BATCH] for i in range(0, len(every), BATCH))])
    best = np.maximum.reduceat(guess, np.searchsorted(owner, np.arange(len(second))))
    slope, offset = logistic_curve(best, labels[second])
    if share and share < 1:
        drawn = labels[second].mean()
        offset += float(np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)))
    network.scale = slope, offset
    # The network has learnt how far odds can be trusted; for scoring they are counted on both halves.
    network.words = log_odds(word_sets(texts), labels, WORD)
    network.runs = log_odds(run_sets(texts), labels, RUN)
    return network


def logistic_curve(scores: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a little shrinkage so that separable scores stay finite."""
    a, b = 1.0, 0.0
    x = np.stack([scores, np.ones_like(scores)], axis=1).astype(np.float64)
    for _ in range(rounds):
        p = sigmoid(x @ [a, b])
        grad = x.T @ (p - labels) + [0.5 * a, 0.01 * b]
        curve = x.T @ (x * (p * (1 - p))[:, None]) + np.diag([0.5, 0.01])
        move = np.linalg.solve(curve, grad)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return float(a), float(b)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, text: str = "text",
                  id_column: str = "doc_id", sample: int = SAMPLE,
                  chars: int = SAMPLE_CHARS) -> tuple[list[tuple[str, int]], float | None]:
    """At most ``sample`` labelled rows of each label, those with the smallest hash of their id, one row per id.

    Of a text above ``chars`` characters, excerpts from places that its hash fixes.

    Also the share of label 1 among all labelled rows that may be learnt from.
    """
    marked = (labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").alias("label"))
              .where("label in (0, 1) and id is not null").where(allowed).distinct())
    counts = {row.label: row["count"] for row in marked.groupBy("label").count().collect()}
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"))
    drawn = None
    for value, count in counts.items():
        part = drawn_rows(marked.where(F.col("label") == value), count, sample, "id")
        drawn = part if drawn is None else drawn.union(part)
    if drawn is None:
        return [], None
    # The drawn ids are two samples at most, which bounds the broadcast. Of rows with one id the one with the
    # smallest hash stands for it, which is found before rows leave their tasks.
    size, length = chars // EXCERPTS, F.length("text")
    places = [F.pmod(F.xxhash64("text", F.lit(i)), F.greatest(length - size, F.lit(1))).cast("int") + 1 for i in range(EXCERPTS)]
    parts = F.concat_ws("\n", *[F.substr("text", place, F.lit(size)) for place in places])
    excerpt = F.when(length <= chars, F.col("text")).otherwise(parts)
    rows = (texts.join(F.broadcast(drawn), "id").select("id", "label", F.struct(F.xxhash64("text").alias("h"), excerpt.alias("t")).alias("row"))
            .groupBy("id", "label").agg(F.min("row").alias("row")).select("row.t", "label").collect())
    return [(row.t, int(row.label)) for row in rows], counts.get(1, 0) / sum(counts.values())


def score_column(network: Network | float, text: Column) -> Column:
    """The probability of label 1 for each text."""
    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory = Features(network) if isinstance(network, Network) else None
        for batch in texts:
            found = []
            held: list[str | None] = []
            size = 0
            for value in batch:
                held.append(value.as_py())
                size += len(held[-1] or "")
                if size > 1 << 20:
                    found.append(_probabilities(network, held, memory))
                    held, size = [], 0
            if held:
                found.append(_probabilities(network, held, memory))
            yield pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())

    return run(text)


def _probabilities(network: Network | float, texts: list[str | None], memory: Features | None) -> np.ndarray:
    if memory is None:
        return np.full(len(texts), network, np.float64)
    slope, offset = network.scale
    return sigmoid(slope * text_scores(network, texts, memory).astype(np.float64) + offset)


def score(docs: DataFrame, network: Network | float, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score of each whole text."""
    python_ready(docs.sparkSession)
    return docs.withColumn(out, score_column(network, F.col(f"`{text}`")))
