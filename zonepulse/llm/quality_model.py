"""A quality classifier on random-indexing word vectors.

Random indexing: a word has a sparse index vector of a few +1 and -1, fixed by its number, and its word vector is
the sum of the index vectors of the words around it, over the whole corpus. Words share ``WORDS`` numbers by
hash, so the table of vectors has one size however large the vocabulary; every occurrence counts. Beside
the word itself its shape counts as a word (letters, digits and which marks it carries). Texts are read once:
their numbers are kept as a table, from which vectors, network and scores are made. A document is the
weighted mean of its word vectors; a two-layer network, fitted with numpy on a bounded number of labelled
documents, scores it, and a temperature fitted on labelled documents left out of the fit makes the scores
probabilities.

Tasks add up the word vectors of what they read and Spark sums them; only that table and the pooled vectors of the
labelled sample reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import held_out_id, is_held_out, per_batch
from zonepulse.llm.tokens import Memory
from zonepulse.sources.scratch import materialize

WORDS, SIZE, MARKS, REACH = 8192, 64, 2, 2
_SHAPES = ((regex.compile(r"\p{Ll}+"), "a"), (regex.compile(r"\p{Lu}+"), "A"), (regex.compile(r"\p{N}+"), "0"), (regex.compile(r"(\W)\1+"), r"\1\1"))
_NUMBERS_AT_ONCE = 1_000_000
#: Counters of a number: one for each place and sign, and one for the gap between two texts.
_STRIDE = 2 * SIZE + 1


def _number(word: str, kind: bytes) -> bytes:
    return (zlib.crc32(word.encode("utf-8", "replace"), zlib.crc32(kind)) % WORDS).to_bytes(2, "little")


class Numbers:
    """Texts to word numbers: two for each word, its own and its shape's; lately met words are remembered."""

    def __init__(self) -> None:
        self.known = Memory(250_000)
        self.plain = _number("a", b"shape")

    def _learn(self, word: str) -> bytes:
        if (pair := self.known.older(word)) is None:
            if word.isascii() and word.isalpha() and word.islower():
                pair = _number(word, b"word") + self.plain
            else:
                shape = word
                for pattern, mark in _SHAPES:
                    shape = pattern.sub(mark, shape)
                core = "".join(c for c in word.lower() if c.isalnum())
                pair = _number(core, b"word") + _number(shape, b"shape")
        return self.known.keep(word, pair)

    def of(self, text: str | None) -> bytes:
        """Little-endian unsigned 16-bit numbers; a null or empty text has none."""
        get, learn = self.known.get, self._learn
        return b"".join([get(w) or learn(w) for w in (text or "").split()])


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id and the word numbers of every whole text, one row per input row; only doc_id and text are read."""
    def make():
        numbers = Numbers()

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch({"doc_id": b["doc_id"], "numbers": pa.array([numbers.of(t) for t in b["text"].to_pylist()], pa.binary())})

        return step

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(per_batch(make), "doc_id bigint, numbers binary")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero parts of every number's index vector; the same everywhere."""
    rng = np.random.default_rng(20)
    return rng.integers(0, SIZE, (WORDS, MARKS)), rng.choice(np.array([-1.0, 1.0]), (WORDS, MARKS))


class Contexts:
    """Adds to each number the index vectors of its neighbours, up to ``REACH`` words away in its own text.

    A part of +1 or -1 is a count in its own cell, so a neighbour is one addition of whole numbers. Texts are
    laid end to end with a gap as wide as the reach, whose counts are thrown away.
    """

    def __init__(self) -> None:
        places, signs = index_vectors()
        self.cells = np.vstack([places + SIZE * (signs < 0), np.full((1, MARKS), 2 * SIZE)]).T.copy()
        self.table, self.counts = np.zeros((WORDS + 1) * _STRIDE, np.int64), np.zeros(WORDS + 1, np.int64)
        self.gap = np.full(2 * REACH, WORDS, "<u2").tobytes()  # two numbers stand for a word
        self.waiting: list[bytes] = []
        self.size = 0

    def add(self, numbers: bytes) -> None:
        self.waiting += numbers, self.gap
        self.size += len(numbers) // 2 + 2 * REACH
        if self.size >= _NUMBERS_AT_ONCE:
            self._flush()

    def _flush(self) -> None:
        flat = np.frombuffer(b"".join(self.waiting), "<u2").astype(np.int64)
        self.waiting, self.size = [], 0
        self.counts += np.bincount(flat, minlength=WORDS + 1)
        rows = flat * _STRIDE
        for cell in self.cells:
            near = cell[flat]
            for away in range(1, 2 * REACH + 1):
                self.table += np.bincount(rows[:-away] + near[away:], minlength=len(self.table))
                self.table += np.bincount(rows[away:] + near[:-away], minlength=len(self.table))

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each number occurs, and its vector."""
        if self.waiting:
            self._flush()
        table = self.table.reshape(-1, _STRIDE)[:WORDS]
        return self.counts[:WORDS], table[:, :SIZE] - table[:, SIZE : 2 * SIZE]


def context_sums(rows: DataFrame) -> DataFrame:
    """Word vectors before scaling: (word, n, v0, v1, ...), whole numbers summed over all ``numbered`` documents."""
    columns = [f"v{i}" for i in range(SIZE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts()
        for batch in batches:
            for numbers in batch["numbers"].to_pylist():
                contexts.add(numbers)
        counts, table = contexts.sums()
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64()), *[pa.array(table[at, i], pa.int64()) for i in range(SIZE)]], names=["word", "n", *columns])

    schema = "word int, n bigint, " + ", ".join(f"{c} bigint" for c in columns)
    return rows.select("numbers").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns])


def word_vectors(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Unit word vectors without their common direction, and pooling weights that count frequent words less."""
    vectors, counts = np.zeros((WORDS, SIZE)), np.zeros(WORDS)
    for r in context_sums(rows).collect():  # at most WORDS rows
        counts[r[0]], vectors[r[0]] = r[1], r[2:]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = counts / max(counts.sum(), 1.0)
    vectors -= share @ vectors
    return vectors.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32)


def pooled(numbers: bytes, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A document as a vector: weighted means of its words' and its shapes' vectors, length and variety."""
    out, flat = np.zeros(2 * SIZE + 3, np.float32), np.frombuffer(numbers, "<u2")
    if len(flat):
        for k in (0, 1):
            times = np.bincount(flat[k::2])
            own = np.flatnonzero(times)
            w = weights[own] * times[own].astype(np.float32)
            out[k * SIZE : (k + 1) * SIZE] = (w @ vectors[own]) / max(float(w.sum()), 1e-6)
            out[2 * SIZE + k] = 2 * len(own) / len(flat)
        out[-1] = np.log1p(len(flat) / 2) / 10
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(0.0, (x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 60, seed: int = 3) -> Network:
    """Two layers by Adam on four fifths of the rows; the temperature on the rest, of at least one row."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    rest, used = np.split(order, [max(len(x) // 5, 1)])
    mean, scale = x[used].mean(0), x[used].std(0) + 1e-3
    p = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(rounds):
        turn = rng.permutation(used)
        for at in range(0, len(turn), 128):
            i = turn[at : at + 128]
            z = (x[i] - mean) / scale
            h = np.maximum(0.0, z @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - y[i]) / len(i)
            back = np.outer(error, p[2]) * (h > 0)
            grads = [z.T @ back + 1e-4 * p[0], back.sum(0), h.T @ error + 1e-4 * p[2], np.array([error.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 2e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    logits, truth = net.logits(x[rest]), y[rest]

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(truth > 0, -1, 1) * logits / t)))

    net.temperature = min(np.geomspace(0.25, 8.0, 61), key=loss)
    return net


def _labelled(rows: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Numbers and labels of at most ``most`` documents that are not held out: those with the smallest hashes."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.select("doc_id", "quality", F.xxhash64("doc_id").alias("h")).distinct()
    chosen = known.orderBy("h", "doc_id", "quality").limit(most)
    return rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "numbers", "quality")  # at most ``most`` rows


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    network: Network | None


def train(rows: DataFrame, labels: DataFrame, most: int = 20_000) -> Model:
    """Word vectors from all ``numbered`` documents, the network from at most ``most`` labelled ones; no network without both labels."""
    vectors, weights = word_vectors(rows)
    shared = rows.sparkSession.sparkContext.broadcast((vectors, weights))

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            xs = [pooled(n, *shared.value).tobytes() for n in b["numbers"].to_pylist()]
            return pa.record_batch({"doc_id": b["doc_id"], "quality": b["quality"].cast(pa.int32()), "x": pa.array(xs, pa.binary())})

        return step

    sample = _labelled(rows, labels, most).mapInArrow(per_batch(make), "doc_id bigint, quality int, x binary")
    one = sample.groupBy("doc_id", "quality").agg(F.min("x").alias("x"))  # repeated rows learn once
    found = sorted(one.collect(), key=lambda r: (r[0], r[1]))
    y = np.array([r[1] for r in found], float)
    if len(set(y)) < 2:
        return Model(vectors, weights, None)
    return Model(vectors, weights, fit(np.array([np.frombuffer(r[2], np.float32) for r in found], float), y))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every ``numbered`` document; 0.5 if there was nothing to learn from."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([pooled(n, known.vectors, known.weights) for n in b["numbers"].to_pylist()], float).reshape(b.num_rows, 2 * SIZE + 3)
            p = known.network.probabilities(x) if known.network else np.full(b.num_rows, 0.5)
            return pa.record_batch({
                "doc_id": b["doc_id"], "held_out": pa.array([held_out_id(d) for d in b["doc_id"].to_pylist()], pa.bool_()),
                "score": pa.array(p, pa.float64()), "predicted": pa.array((p >= 0.5).astype(np.int32), pa.int32()),
            })

        return step

    return rows.mapInArrow(per_batch(make), "doc_id bigint, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """One row per input row: doc_id, held_out, score and predicted.

    Null and empty texts are scored as documents without words, very long ones by all their words. Repeated rows are
    scored alike; rows of one id with different texts are scored apart and all learned from. A null id has no label and
    is scored. An empty table gives no rows; without labels of both kinds every score is 0.5. Columns other than
    doc_id and text are not read.
    """
    rows = materialize(numbered(docs), "word-numbers")
    return score(rows, train(rows, labels, most))
