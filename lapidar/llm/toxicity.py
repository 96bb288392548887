"""Toxicity of whole texts by a bidirectional gated recurrent network, trained and run in numpy.

A word enters as the vector of its hash and the mean vector of its character 3- to 5-grams. A
forward and a backward gated recurrent layer read windows of words, attention pools their states,
and a linear unit gives the window's log-odds. All windows of a text are scored, each overlapping
the next; the text's score is that of its highest window.

Labels are of documents, so training alternates: windows of the sample are scored, the highest one
of each toxic document is an example of label 1, and highest and random ones of clean documents are
examples of label 0. The network is fitted on the driver on at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled documents
and ``SAMPLE_WINDOWS`` windows of each; every text is scored whole. The network's size is fixed, so
it travels with the tasks.

Defined results: a null or empty text is scored as one empty window; a label that is null is none;
where a document has several labels the highest counts; without labels of both kinds every score is
the share of label 1 among them (0 without any); repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm.common import table, text_of

WINDOW, STRIDE = 32, 24
WIDTH, STATE, ATTENTION = 8, 8, 8
WORD_ROWS, GRAM_ROWS = 1 << 13, 1 << 16
# a word or a run of characters in fewer documents of the sample has no vector: it can only be learned by heart
LEAST_DOCUMENTS = 3
GRAMS = (3, 4, 5)
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_WINDOWS = 1000, 3000, 64
EPOCHS, STEPS, RESCORE, BATCH, RATE = 8, 600, 50, 64, 0.01  # at least so many epochs and steps
FOLDS, HELD_OUT = 5, 0
CACHED_WORDS, TOKENS, LANES = 150_000, 400_000, 4096
FROM = 0.5
_PRIMES = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def window_starts(n: int) -> range:
    """Starts of windows that cover n words, each overlapping the next."""
    return range(0, max(n - WINDOW + STRIDE - 1, 0) // STRIDE * STRIDE + 1, STRIDE)


@dataclass
class Grams:
    """Rows of the vectors of words: one of each word, several of its characters."""

    word: np.ndarray
    gram: np.ndarray
    of: np.ndarray  # the word of each gram

    def means(self, vectors: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(self.word), vectors.shape[1]), dtype=np.float32)
        starts = np.flatnonzero(np.diff(self.of, prepend=-1))
        if len(starts):
            sums[self.of[starts]] = np.add.reduceat(vectors[self.gram], starts, axis=0)
        return sums / self.counts()

    def counts(self) -> np.ndarray:
        return np.maximum(np.bincount(self.of, minlength=len(self.word)), 1).astype(np.float32)[:, None]


def grams_of(words: list[bytes]) -> Grams:
    text = np.frombuffer(b"".join(b"<" + w + b">" for w in words), dtype=np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    rows, of = [], []
    for n in GRAMS:
        if len(text) < n:
            continue
        runs = len(text) - n + 1
        value = np.full(runs, n, dtype=np.uint32)
        for i in range(n):
            value = (value ^ text[i : i + runs]) * _PRIMES[i % len(_PRIMES)]
            value ^= value >> np.uint32(15)
        inside = owner[:runs] == owner[n - 1 :]
        rows.append(value[inside] % np.uint32(GRAM_ROWS))
        of.append(owner[:runs][inside])
    gram, of = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, of))
    order = np.argsort(of, kind="stable")
    word = np.array([xxhash.xxh32_intdigest(w) % WORD_ROWS for w in words], dtype=np.int64)
    return Grams(word, gram[order].astype(np.int64), of[order])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def new_network(seed: int = 7) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    draw = lambda *shape: (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    net = {
        "words": 0.1 * draw(WORD_ROWS, WIDTH) * np.sqrt(WORD_ROWS, dtype=np.float32),
        "grams": 0.3 * draw(GRAM_ROWS, WIDTH) * np.sqrt(GRAM_ROWS, dtype=np.float32),
        "attend": draw(2 * STATE, ATTENTION),
        "attend_bias": np.zeros(ATTENTION, np.float32),
        "query": draw(ATTENTION),
        "out": draw(2 * STATE),
        "out_bias": np.zeros(1, np.float32),
    }
    for way in ("forth", "back"):
        net[f"in_{way}"], net[f"bias_{way}"] = draw(2 * WIDTH, 3 * STATE), np.zeros(3 * STATE, np.float32)
        net[f"state_{way}"] = draw(STATE, 3 * STATE)
    return net


def inputs(net: dict[str, np.ndarray], grams: Grams) -> np.ndarray:
    return np.concatenate([net["words"][grams.word], grams.means(net["grams"])], axis=1)


def _read(net: dict, way: str, gates: np.ndarray, rows: np.ndarray, kept: np.ndarray | None, trace: list | None) -> np.ndarray:
    """States (steps, windows, STATE) of one direction. ``rows``: (steps, windows) rows of ``gates``."""
    steps, n = rows.shape
    state, weights = np.zeros((n, STATE), np.float32), net[f"state_{way}"]
    out = np.empty((steps, n, STATE), np.float32)
    for t in range(steps) if way == "forth" else range(steps - 1, -1, -1):
        x, s = gates[rows[t]], state @ weights
        zr = _sigmoid(x[:, : 2 * STATE] + s[:, : 2 * STATE])
        z, r = zr[:, :STATE], zr[:, STATE:]
        new = np.tanh(x[:, 2 * STATE :] + r * s[:, 2 * STATE :])
        after = new + z * (state - new)
        if kept is not None:
            after = np.where(kept[t][:, None], after, state)
        if trace is not None:
            trace.append((t, state, z, r, new, s[:, 2 * STATE :]))
        state = out[t] = after
    return out


def log_odds(net: dict, x: np.ndarray, rows: np.ndarray, kept: np.ndarray | None, tape: dict | None = None) -> np.ndarray:
    """Log-odds of windows. ``x``: input vectors of words; ``rows``, ``kept``: (steps, windows)."""
    ways = {}
    for way in ("forth", "back"):
        trace: list | None = None if tape is None else []
        ways[way] = _read(net, way, x @ net[f"in_{way}"] + net[f"bias_{way}"], rows, kept, trace)
        if tape is not None:
            tape[way] = trace
    states = np.concatenate([ways["forth"], ways["back"]], axis=2)
    hidden = np.tanh(states @ net["attend"] + net["attend_bias"])
    score = hidden @ net["query"]
    if kept is not None:
        score = np.where(kept, score, -30.0).astype(np.float32)
    weight = np.exp(score - score.max(axis=0))
    if kept is not None:
        weight *= kept
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnd->nd", weight, states)
    if tape is not None:
        tape.update(states=states, hidden=hidden, weight=weight, pooled=pooled)
    return pooled @ net["out"] + net["out_bias"][0]


def gradients(net: dict, grams: Grams, rows: np.ndarray, kept: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean cross entropy of windows, through time."""
    tape: dict = {}
    x = inputs(net, grams)
    odds = log_odds(net, x, rows, kept, tape)
    states, hidden, weight, pooled = (tape[k] for k in ("states", "hidden", "weight", "pooled"))
    error = ((_sigmoid(odds) - label) / len(label)).astype(np.float32)
    grad = {"out": pooled.T @ error, "out_bias": error.sum(keepdims=True)}
    d_pooled = error[:, None] * net["out"]
    d_states = weight[:, :, None] * d_pooled
    d_weight = np.einsum("tnd,nd->tn", states, d_pooled)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["query"] = np.einsum("tna,tn->a", hidden, d_score)
    d_hidden = d_score[:, :, None] * net["query"] * (1 - hidden**2)
    grad["attend"] = np.einsum("tnd,tna->da", states, d_hidden)
    grad["attend_bias"] = d_hidden.sum(axis=(0, 1))
    d_states += d_hidden @ net["attend"].T
    d_x = np.zeros_like(x)
    for i, way in enumerate(("forth", "back")):
        weights = net[f"state_{way}"]
        grad[f"state_{way}"] = np.zeros_like(weights)
        d_gates = np.zeros((len(x), 3 * STATE), np.float32)
        d_state = np.zeros((rows.shape[1], STATE), np.float32)
        for t, before, z, r, new, s_new in reversed(tape[way]):
            d_after = d_state + d_states[t, :, i * STATE : (i + 1) * STATE]
            live = kept[t][:, None]
            d_state = np.where(live, d_after * z, d_after)
            d_after = d_after * live
            d_new = d_after * (1 - z) * (1 - new**2)
            d_z = d_after * (before - new) * z * (1 - z)
            d_r = d_new * s_new * r * (1 - r)
            d_s = np.concatenate([d_z, d_r, d_new * r], axis=1)
            grad[f"state_{way}"] += before.T @ d_s
            d_state = d_state + d_s @ weights.T
            np.add.at(d_gates, rows[t], np.concatenate([d_z, d_r, d_new], axis=1))
        grad[f"in_{way}"], grad[f"bias_{way}"] = x.T @ d_gates, d_gates.sum(axis=0)
        d_x += d_gates @ net[f"in_{way}"].T
    grad["words"], grad["grams"] = np.zeros_like(net["words"]), np.zeros_like(net["grams"])
    np.add.at(grad["words"], grams.word, d_x[:, :WIDTH])
    np.add.at(grad["grams"], grams.gram, (d_x[:, WIDTH:] / grams.counts())[grams.of])
    return grad


def _lay_out(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
    """Rows and presence, (steps, windows); presence is None where all windows are full."""
    steps = max(max(map(len, windows)), 1)
    lengths = np.array([len(w) for w in windows])
    if (lengths == steps).all():
        return np.ascontiguousarray(np.stack(windows).T), None
    rows = np.zeros((len(windows), steps), np.int64)
    kept = np.arange(steps) < lengths[:, None]
    rows[kept] = np.concatenate(windows)
    return np.ascontiguousarray(rows.T), np.ascontiguousarray(kept.T)


@dataclass
class Scorer:
    """Scores texts; input vectors of words are kept while they are few enough."""

    net: dict[str, np.ndarray]
    cached: int = CACHED_WORDS

    def __post_init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.x = np.zeros((1, 2 * WIDTH), np.float32)

    def _rows(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.known) > self.cached:
            self.__post_init__()
        new: list[bytes] = []
        known, rows = self.known, []
        for words in texts:
            for w in set(words):
                if w not in known:
                    known[w] = len(known) + 1
                    new.append(w)
            rows.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        added = [inputs(self.net, grams_of(new[i : i + 20_000])) for i in range(0, len(new), 20_000)]
        self.x = np.concatenate([self.x, *added])
        return rows

    def window_odds(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of all windows and the text of each."""
        rows, windows, of = self._rows(texts), [], []
        for i, r in enumerate(rows):
            for start in window_starts(len(r)):
                windows.append(r[start : start + WINDOW])
                of.append(i)
        order = np.argsort([-len(w) for w in windows], kind="stable")
        odds = np.empty(len(windows), np.float32)
        full = sum(len(w) == WINDOW for w in windows)
        for part in (order[:full], order[full:]):
            for i in range(0, len(part), LANES):
                at = part[i : i + LANES]
                odds[at] = log_odds(self.net, self.x, *_lay_out([windows[j] for j in at]))
        return odds, np.array(of, dtype=np.int64)

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        odds, of = self.window_odds(texts)
        best = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(best, of, odds)
        return _sigmoid(best.astype(np.float64))


def train(toxic: list[list[list[bytes]]], clean: list[list[list[bytes]]], epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """A network fitted on documents, each a list of windows of words."""
    random, net = np.random.default_rng(seed), new_network(seed)
    documents = toxic + clean
    windows = [w for d in documents for w in d]
    of = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    starts = np.searchsorted(of, np.arange(len(documents)))
    sizes = np.bincount(of, minlength=len(documents))
    label = np.arange(len(documents)) < len(toxic)
    mean, square = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    step = 0
    known = {"words": np.zeros((WORD_ROWS, 1), np.int32), "grams": np.zeros((GRAM_ROWS, 1), np.int32)}
    for d in documents:
        grams = grams_of(list({w for text in d for w in text}))
        known["words"][np.unique(grams.word)] += 1
        known["grams"][np.unique(grams.gram)] += 1
    known = {k: (v >= LEAST_DOCUMENTS).astype(np.float32) for k, v in known.items()}
    for k, seen in known.items():
        net[k] *= seen
    epoch, scored_at, best = 0, 0, None
    while epoch < epochs or step < STEPS:
        any_ = starts + random.integers(0, sizes)
        chosen = [np.stack([any_, np.arange(len(documents))])]
        if epoch:
            if best is None or step - scored_at >= RESCORE:
                odds, scored_at = Scorer(net).window_odds(windows)[0], step
                best = starts + np.array([odds[s : s + n].argmax() for s, n in zip(starts, sizes, strict=True)])
            chosen = [np.stack([best, np.arange(len(documents))]), chosen[0][:, ~label]]
        window, document = random.permutation(np.concatenate(chosen, axis=1).T).T
        for i in range(0, len(window), BATCH):
            texts = [windows[j] for j in window[i : i + BATCH]]
            ids: dict[bytes, int] = {}
            rows, kept = _lay_out([np.array([ids.setdefault(w, len(ids)) for w in t], np.int64) for t in texts])
            step += 1
            if not ids:
                continue
            kept = np.ones(rows.shape, bool) if kept is None else kept
            grad = gradients(net, grams_of(list(ids)), rows, kept, label[document[i : i + BATCH]].astype(np.float32))
            for k, seen in known.items():
                grad[k] *= seen
            for k, g in grad.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                net[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
        epoch += 1
    best = np.full(len(documents), -np.inf, np.float32)
    np.maximum.at(best, of, Scorer(net).window_odds(windows)[0])
    net["out_bias"] -= np.float32(_cut(best, label))
    return net


def _cut(odds: np.ndarray, label: np.ndarray) -> float:
    """The log-odds that part the labels with the best balanced accuracy; the middle of the gap."""
    order = np.argsort(odds)
    odds, label = odds[order], label[order]
    right = np.cumsum(~label) / max((~label).sum(), 1) + 1 - np.cumsum(label) / max(label.sum(), 1)
    i = int(right.argmax())
    return float((odds[i] + odds[min(i + 1, len(odds) - 1)]) / 2)


def _windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Up to ``most`` windows of each text, a random choice by doc_id where there are more."""
    for batch in batches:
        out = []
        for doc, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "text")), strict=True):
            words = words_of(text)
            starts = np.array(window_starts(len(words)))
            if len(starts) > most:
                starts = np.random.default_rng(zlib.crc32(str(doc).encode())).choice(starts, most, replace=False)
            out.append((toxic, [b" ".join(words[s : s + WINDOW]) for s in starts]))
        columns = [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["toxic", "windows"])


def fitted(
    docs: DataFrame, labels: DataFrame, most_toxic: int = SAMPLE_TOXIC, most_clean: int = SAMPLE_CLEAN
) -> dict[str, np.ndarray] | float:
    """A network, or the share of label 1 where only one label is there.

    The sample: of either label the documents with the smallest hash, held-out ones left out.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    first = lambda k, n: known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = F.broadcast(first(1, most_toxic).unionByName(first(0, most_clean)))  # a bounded number of rows
    rows = docs.select("doc_id", text_of().alias("text")).join(ids, "doc_id").dropDuplicates(["doc_id"])
    found = rows.select("doc_id", "toxic", "text").mapInArrow(
        lambda it: _windows(it, SAMPLE_WINDOWS), "toxic int, windows array<binary>"
    ).toArrow()
    documents = [[bytes(w).split() for w in d] for d in found.column("windows").to_pylist()]
    toxic = [d for d, k in zip(documents, found.column("toxic").to_pylist(), strict=True) if k]
    clean = [d for d, k in zip(documents, found.column("toxic").to_pylist(), strict=True) if not k]
    if not toxic or not clean:
        return 1.0 if toxic else 0.0
    return train(toxic, clean)


def scorer(net: dict[str, np.ndarray] | float):
    """An Arrow function from texts to scores."""

    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if isinstance(net, float):
            for part in parts:
                yield pa.array(np.full(len(part), net))
            return
        model = Scorer(net)
        for part in parts:
            out, texts, tokens = [], [], 0
            for text in part:
                texts.append(words_of(text.as_py()))
                tokens += len(texts[-1])
                if tokens >= TOKENS:
                    out.append(model.scores(texts))
                    texts, tokens = [], 0
            if texts:
                out.append(model.scores(texts))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    score.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    score = scorer(fitted(docs, labels))(text_of())
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= FROM).cast("int"))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the network doesn't reject, in their own columns."""
    score = scorer(fitted(docs, table(spark, sf_dir, "labels")))(text_of())
    return docs.where(score < FROM)
