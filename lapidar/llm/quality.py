"""Quality of whole texts: random-indexing word vectors, pooled, judged by a small calibrated network.

Every word has an index vector, a few +1 and -1 in places that its hash picks. A pass over all
documents adds up, for each word slot, the index vectors of the words within ``REACH`` of its
occurrences; Spark sums the slots of all tasks. A word's vector is its own index vector beside its
context's direction. A text is the mean and the spread of the vectors of all its words, its length,
and the shares of different words and of words equal to the one before. A two-layer network, fitted in numpy on a bounded sample of labelled rows, gives log-odds;
one temperature, fitted on a fold of the sample that the network has not seen, turns them into
probabilities.

Words are runs of letters and digits or runs of other signs, as written. The number of slots is a
parameter, so the vectors have a fixed size whatever the corpus (they travel with the tasks); words
that share a slot share a context, but not all of their index vector. The corpus pass covers every
text, scoring as well; only the network's rows are a sample: of either label at most ``SAMPLE``
documents, those with the smallest hash. Held-out rows' labels take no part, no other column does.

Defined results: a null or empty text has no words and is scored like any other; a null label is
none; where a document has several labels the highest counts, where its id has several texts the one
with the smallest hash; without labels of both kinds every score is the share of label 1 among them
(0 without any); repeated rows score alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm.common import text_of

SLOTS, WIDTH, ONES = 1 << 16, 48, 6
OWN_SEEDS = 1 << 20  # index vectors that words can have as their own
REACH = 2
SAMPLE = 12_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 0.004, 2e-4
PATIENCE = 8
CALIBRATION = 5  # a fold of so many holds out rows for early stopping and the temperature
FOLDS, HELD_OUT = 3, 1
TOKENS, CACHED_WORDS = 200_000, 300_000
FROM = 0.5
WORD = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


# -- random indexing -------------------------------------------------------------------


def index_vectors(rows: int, width: int = WIDTH, ones: int = ONES, seed: int = 13) -> np.ndarray:
    """Sparse ternary vectors, one for each row, the same in every task."""
    random = np.random.default_rng(seed)
    out = np.zeros((rows, width), np.int8)
    for i in range(ones):
        out[np.arange(rows), random.integers(0, width, rows)] = 1 if i % 2 else -1
    return out


class Words:
    """Word hashes of texts; hashes of words already seen are kept while they are few enough."""

    def __init__(self, cached: int = CACHED_WORDS) -> None:
        self.known: dict[str, int] = {}
        self.cached = cached

    def __call__(self, text: str) -> np.ndarray:
        words = WORD.findall(text)
        if len(self.known) > self.cached:
            self.known = {}
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "replace"))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def add_contexts(sums: np.ndarray, texts: list[np.ndarray], index: np.ndarray) -> None:
    """Adds to each slot's row the index vectors around its occurrences, and to the last column their number."""
    none = np.full(REACH, -1)
    slots = np.concatenate([none, *(part for t in texts for part in (t % SLOTS, none))])
    vectors = index[slots]
    vectors[slots < 0] = 0
    around = np.zeros_like(vectors)
    for ahead in range(1, REACH + 1):
        around[ahead:] += vectors[:-ahead]
        around[:-ahead] += vectors[ahead:]
    order = np.argsort(slots, kind="stable")[(slots < 0).sum() :]
    ranked = slots[order]
    if not len(ranked):
        return
    starts = np.flatnonzero(np.diff(ranked, prepend=-1))
    at = ranked[starts]
    sums[at, :-1] += np.add.reduceat(around[order], starts, axis=0, dtype=np.int64)
    sums[at, -1] += np.diff(np.append(starts, len(ranked)))


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, index = Words(), index_vectors(SLOTS)
    sums = np.zeros((SLOTS, WIDTH + 1), np.int64)
    texts, tokens = [], 0
    for batch in batches:
        for text in batch.column("text"):
            texts.append(words(text.as_py()))
            tokens += len(texts[-1])
            if tokens >= TOKENS:
                add_contexts(sums, texts, index)
                texts, tokens = [], 0
    if texts:
        add_contexts(sums, texts, index)
    seen = np.flatnonzero(sums[:, -1])
    names = ["slot", *(f"s{i}" for i in range(WIDTH + 1))]
    for part in range(0, len(seen), 8192):
        at = seen[part : part + 8192]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c) for c in sums[at].T.copy())], names=names)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """A unit vector (or zeros) for each slot, from the contexts in all documents."""
    columns = [f"s{i}" for i in range(WIDTH)]
    schema = ", ".join(["slot int", *(f"s{i} long" for i in range(WIDTH + 1))])
    sums = docs.select(text_of().alias("text")).mapInArrow(_context_sums, schema).groupBy("slot")
    table = sums.agg(*[F.sum(c).cast("double").cast("float").alias(c) for c in columns]).toArrow()
    out = np.zeros((SLOTS, WIDTH), np.float32)
    out[table.column("slot").to_numpy()] = np.stack([table.column(c).to_numpy() for c in columns], axis=1).reshape(-1, WIDTH)
    out -= out.sum(axis=0) / max(np.abs(out).sum(), 1) * np.abs(out).sum(axis=1, keepdims=True)  # what all contexts share
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class Pooling:
    """Texts to inputs: mean and spread of the words' vectors, length, and how much the words repeat."""

    contexts: np.ndarray

    @property
    def size(self) -> int:
        return 4 * WIDTH + 4

    def __call__(self, hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size, np.float32)
        n = len(hashes)
        if n:
            total, square = np.zeros(2 * WIDTH), np.zeros(2 * WIDTH)
            for part in range(0, n, TOKENS):
                h = hashes[part : part + TOKENS]
                kinds, count = np.unique(h, return_counts=True)
                x = np.concatenate([own[kinds % OWN_SEEDS], self.contexts[kinds % SLOTS]], axis=1).astype(np.float32)
                total += count.astype(np.float32) @ x
                square += count.astype(np.float32) @ np.square(x)
            out[: 2 * WIDTH] = total / n
            out[2 * WIDTH : 4 * WIDTH] = np.sqrt(np.maximum(square / n - (total / n) ** 2, 0))
            out[-2:] = len(np.unique(hashes)) / n, np.count_nonzero(hashes[1:] == hashes[:-1]) / n
        out[4 * WIDTH : -2] = np.log1p(n), 1 / np.sqrt(n + 1)
        return out

    def texts(self, texts: list[str], words: Words, own: np.ndarray) -> np.ndarray:
        return np.array([self(words(t), own) for t in texts], np.float32).reshape(-1, self.size)


# -- the network -----------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    """Standardised inputs, a hidden layer, a linear unit, a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float = 0.0
    temperature: float = 1.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.mean) / self.scale) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.log_odds(x).astype(np.float64) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def cross_entropy(odds: np.ndarray, label: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, odds) - label * odds))


def gradients(weights: dict[str, np.ndarray], x: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross entropy; x is standardised."""
    hidden = np.tanh(x @ weights["first"] + weights["first_bias"])
    error = (sigmoid(hidden @ weights["second"] + weights["second_bias"]) - label) / len(label)
    back = np.outer(error, weights["second"]) * (1 - hidden**2)
    return {"first": x.T @ back, "first_bias": back.sum(axis=0), "second": hidden.T @ error, "second_bias": error.sum(keepdims=True)}


def temperature(odds: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least cross entropy, by golden section on its logarithm.

    The labels are drawn in by one row of either, so a fold without an error gives no certainty.
    """
    ones, zeros = label.sum(), len(label) - label.sum()
    goal = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    loss = lambda t: cross_entropy(odds / np.exp(t), goal)
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(x: np.ndarray, label: np.ndarray, fold: np.ndarray, seed: int = 13) -> Network:
    """Fitted where ``fold`` is false, stopped and calibrated where it is true (on all rows if either side lacks a label)."""
    if any(len(np.unique(label[side])) < 2 for side in (fold, ~fold)):
        fit = check = np.ones(len(label), bool)
    else:
        fit, check = ~fold, fold
    mean = x[fit].mean(axis=0)
    scale = np.maximum(x[fit].std(axis=0), 1e-4)
    z, random = ((x - mean) / scale).astype(np.float32), np.random.default_rng(seed)
    weights = {
        "first": (random.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1])).astype(np.float32),
        "first_bias": np.zeros(HIDDEN, np.float32),
        "second": (random.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32),
        "second_bias": np.zeros(1, np.float32),
    }
    moment, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    network = lambda w: Network(mean, scale, w["first"], w["first_bias"], w["second"], float(w["second_bias"][0]))
    rows, step, best, waited = np.flatnonzero(fit), 0, (np.inf, network(weights)), 0
    for _ in range(EPOCHS):
        random.shuffle(rows)
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            step += 1
            for k, g in gradients(weights, z[part], label[part].astype(np.float32)).items():
                moment[k] += 0.1 * (g - moment[k])
                square[k] += 0.01 * (g * g - square[k])
                weights[k] *= 1 - RATE * DECAY * (weights[k].ndim > 0)
                weights[k] -= RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        now = network({k: v.copy() for k, v in weights.items()})
        loss = cross_entropy(now.log_odds(x[check]).astype(np.float64), label[check])
        if loss < best[0] - 1e-5:
            best, waited = (loss, now), 0
        elif (waited := waited + 1) >= PATIENCE:
            break
    odds = best[1].log_odds(x[check]).astype(np.float64)
    return replace(best[1], temperature=temperature(odds, label[check]))


# -- fitting and scoring ---------------------------------------------------------------


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """quality, text, fold of a bounded number of labelled documents."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    first = lambda k: known.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    ids = F.broadcast(first(0).unionByName(first(1)))  # a bounded number of rows
    rows = docs.select("doc_id", text_of().alias("text")).join(ids, "doc_id").groupBy("doc_id", "quality")
    rows = rows.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one"))
    fold = F.pmod(F.xxhash64(F.lit(CALIBRATION), "doc_id"), F.lit(CALIBRATION)) == 0
    return rows.select("doc_id", "quality", fold.alias("fold"), F.col("one.text").alias("text"))


def fitted(docs: DataFrame, labels: DataFrame, pooling: Pooling, most: int = SAMPLE) -> Network | float:
    """A network, or the share of label 1 where only one label is there."""

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = Words(), index_vectors(OWN_SEEDS, seed=14)
        for batch in batches:
            x = pooling.texts(batch.column("text").to_pylist(), words, own)
            columns = [batch.column("doc_id"), batch.column("quality"), batch.column("fold"), pa.array([r.tobytes() for r in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "fold", "x"])

    found = sample(docs, labels, most).mapInArrow(inputs, "doc_id long, quality int, fold boolean, x binary").toArrow().sort_by("doc_id")
    label = found.column("quality").to_numpy()
    if not label.any() or label.all():
        return float(label.any())
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(len(label), -1)
    return train(x, label, np.asarray(found.column("fold")))


def scorer(pooling: Pooling, network: Network | float):
    """An Arrow function from texts to scores."""

    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, own = Words(), index_vectors(OWN_SEEDS, seed=14)
        for part in parts:
            if isinstance(network, float):
                yield pa.array(np.full(len(part), network))
            else:
                yield pa.array(network.scores(pooling.texts(part.to_pylist(), words, own)), pa.float64())

    score.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    pooling = Pooling(context_vectors(docs))
    score = scorer(pooling, fitted(docs, labels, pooling))(text_of())
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= FROM).cast("int"))
