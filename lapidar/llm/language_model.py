"""Language-model scores by a weighted backoff automaton over a bigram model of the whole corpus.

States are the words that training texts hold (and the root); a state's arcs are the bigrams seen
after its word, with their smoothed probability, and its failure arc leads to the root with the
weight that smoothing leaves for the rest; the root has an arc for every known word and one for all
unknown ones. One left-to-right traversal carries the state through a text and adds log10
probabilities. Smoothing is a Dirichlet prior on the unigrams, and the unigrams give the unknown
word the share of words seen once.

The model grows with the corpus, so no task and no driver holds it. Texts are read once into blocks
of bounded size; a block notes its tokens and asks for the counts of the n-grams it holds. The
questions are sorted hashes, cut by hash range into shards; a shard adds up the training counts of
its range over all blocks and answers each block in the order it asked. The block then builds the
part of the automaton that its texts can reach and walks it. Rows move as packed arrays, a few for
each block and shard, and hashes spread every hot n-gram's work evenly.

Words have 64-bit hashes; bigrams 40 bits within a shard, of which there is one for each few million
tokens, so the share of bigrams that meet another (about one in 100,000) does not grow.

Defined results: a null text counts as empty (one token, the end); A-Z are folded; repeated rows are
scored and counted each; without training texts every score is 0; if no word is seen once, half a
count is left for unknown ones; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm.common import text_of, written

FOLDS, HELD_OUT = 5, 1
PRIOR = 50.0
# where every word occurs at least twice, so much of a count is left for unknown ones
LEAST_ONCE = 0.5
MOST_DISCOUNT = 0.9
BLOCK_TOKENS = 2_000_000
SHARD_TOKENS = 6_000_000
BYTES_PER_TOKEN = 6
LANES = 2048
BIGRAM_BITS = 40
END = b""  # no word is empty
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
ASK = "block long, shard int, grade int, kind int, payload binary"
STREAM, QUESTION, COUNTS = 0, 1, 2
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, the bytes of each place together, compressed."""
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize))], dtype="<i8").tobytes()
    planes = [a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unpack(payload: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2), 8 + 16 * n, []
    for count, width in sizes.tolist():
        planes = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}"))
        at += count * width
    return out


def small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold the largest."""
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _FACTORS[0]
    return x ^ (x >> np.uint64(29))


def bigram_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(before) * _FACTORS[1] + after)


def _cuts(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range of the hash space starts in the sorted hashes, and the end."""
    borders = np.array([(i << 64) // shards for i in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, borders), [len(sorted_hashes)]])


def _narrow(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The place in its shard's range, to BIGRAM_BITS bits; keeps the order."""
    width = (1 << 64) // shards
    shift = max(width.bit_length() - BIGRAM_BITS, 0)
    return (hashes % np.uint64(width) if shards > 1 else hashes) >> np.uint64(shift)


class Block:
    """Tokens of some texts: the documents, numbers of their words, and the n-grams they hold."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.held: list[bool] = []
        self.sizes: list[int] = []
        self.numbers: dict[bytes, int] = {END: 0}
        self.tokens: list[np.ndarray] = []
        self.n = 0

    def add(self, doc: int | None, held: bool, text: bytes) -> None:
        words = text.lower().split()
        numbers = self.numbers
        for w in set(words).difference(numbers):
            numbers[w] = len(numbers)
        row = np.empty(len(words) + 1, dtype=np.int32)
        row[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        row[-1] = 0
        self.docs.append(doc)
        self.held.append(held)
        self.sizes.append(len(row))
        self.tokens.append(row)
        self.n += len(row)

    def rows(self, block: int, shards: int) -> Iterator[tuple[int, int, int, int, bytes]]:
        """ASK rows: the stream of tokens, and for each shard the sorted hashes asked for with own counts."""
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.numbers], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        number = np.empty(len(order), dtype=np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        hashes, tokens = hashes[order], number[np.concatenate(self.tokens)]
        sizes, held = np.array(self.sizes), np.array(self.held)
        train = np.repeat(~held, sizes)
        docs = np.array([d or 0 for d in self.docs], dtype="<i8").view("<u8")
        none = np.array([d is None for d in self.docs], dtype="<u1")
        yield block, -1, 0, STREAM, pack(docs, none, held.astype("<u1"), small(sizes), hashes, small(tokens))
        counts = np.bincount(tokens[train], minlength=len(hashes))
        before = _before(tokens, sizes, int(number[0]))
        pairs, inverse = np.unique(before.astype(np.int64) * len(hashes) + tokens, return_inverse=True)
        seen = np.bincount(inverse[train], minlength=len(pairs))
        asked = bigram_hashes(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)])
        order = np.argsort(asked, kind="stable")
        asked, seen = asked[order], seen[order]
        for grade, (keys, own) in enumerate(((hashes, counts), (asked, seen)), 1):
            cuts = _cuts(keys, shards)
            for shard in range(shards):
                part = slice(cuts[shard], cuts[shard + 1])
                places = keys[part] if grade == 1 else _narrow(keys[part], shards)
                steps = np.diff(places, prepend=np.uint64(0))
                yield block, shard, grade, QUESTION, pack(steps, small(own[part]))


def _before(tokens: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The token before each; texts start after an end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = end
    return before


def read_blocks(batches: Iterator[pa.RecordBatch], shards: int, most: int = BLOCK_TOKENS) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts of a partition; a block is closed when it holds ``most`` tokens."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    names = [c.split()[0] for c in ASK.split(", ")]
    number, block = TaskContext.get().partitionId() << 32, Block()

    def out() -> Iterator[pa.RecordBatch]:
        for row in block.rows(number, shards):
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    for batch in batches:
        for doc, held, text in zip(*(batch.column(c) for c in ("doc_id", "held_out", "text")), strict=True):
            block.add(doc.as_py(), held.as_py(), text.as_py())
            if block.n >= most:
                yield from out()
                number, block = number + 1, Block()
    if block.n:
        yield from out()


def answer(questions: pd.DataFrame) -> pd.DataFrame:
    """Total training counts of a shard's n-grams, for each block in its order; and the shard's own figures."""
    asked = [unpack(p) for p in questions["payload"]]
    keys = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in asked])
    own = np.concatenate([counts.astype(np.float64) for _, counts in asked])
    unique, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, weights=own, minlength=len(unique)).astype(np.int64)
    found, at, payloads = total[inverse], 0, []
    for steps, _ in asked:
        payloads.append(pack(small(found[at : at + len(steps)])))
        at += len(steps)
    shard, grade = int(questions["shard"].iloc[0]), int(questions["grade"].iloc[0])
    figures = np.array([total.sum(), (total > 0).sum(), (total == 1).sum()], dtype="<u8")
    rows = [*zip(questions["block"], [QUESTION] * len(payloads), payloads, strict=True), (-1, COUNTS, pack(figures))]
    out = pd.DataFrame(rows, columns=["block", "kind", "payload"])
    return out.assign(shard=shard, grade=grade)[["block", "shard", "grade", "kind", "payload"]]


class Automaton:
    """States, arcs and failure arcs that the tokens of a block can reach.

    A state is the number of a word, or ``root``. Arcs are kept sorted by state and token.
    """

    def __init__(self, counts: np.ndarray, pairs: np.ndarray, seen: np.ndarray, total: int, words: int, once: int) -> None:
        n = len(counts)
        self.n, self.root = n, n
        discount = min(max(once, LEAST_ONCE) / words, MOST_DISCOUNT) if words else 0.0
        unknown = discount * words / total if total else 1.0
        single = np.where(counts > 0, (counts - discount) / max(total, 1), unknown)
        held = np.append(counts, 0).astype(np.float64)
        self.root_weight = np.log10(single)
        # the part of a state's weight that goes to its failure arc, to the root
        self.failure = np.log10(PRIOR / (held + PRIOR))
        arcs = seen > 0
        self.arcs = pairs[arcs]
        state, token = self.arcs // n, self.arcs % n
        self.weight = np.log10((seen[arcs] + PRIOR * single[token]) / (held[state] + PRIOR))
        self.is_state = np.append(counts > 0, True)

    def walk(self, tokens: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
        """log10 probability of every token, left to right; ``starts``: first tokens of texts.

        The stream is walked in lanes side by side. A state depends on the token before, so a lane
        starts in the state that the token before it leads to.
        """
        n = len(tokens)
        steps = -(-n // min(LANES, n))
        lanes = np.arange(0, n, steps)
        first = np.zeros(n + steps, bool)
        first[starts] = True
        padded = np.append(tokens, np.zeros(steps, tokens.dtype)).astype(np.int64)
        begin = end if self.is_state[end] else self.root
        state = np.where(lanes > 0, padded[lanes - 1], end)
        state = np.where(self.is_state[state], state, self.root)
        out = np.zeros(n + steps)
        for step in range(steps):
            at = lanes + step
            state = np.where(first[at], begin, state)
            token = padded[at]
            key = state * self.n + token
            arc = np.minimum(np.searchsorted(self.arcs, key), max(len(self.arcs) - 1, 0))
            taken = self.arcs[arc] == key if len(self.arcs) else np.zeros(len(key), bool)
            backed = self.failure[state] + self.root_weight[token]
            out[at] = np.where(taken, self.weight[arc], backed) if len(self.arcs) else backed
            state = np.where(self.is_state[token], token, self.root)
        return out[:n]


def score_block(rows: pd.DataFrame, total: int, words: int, once: int) -> pd.DataFrame:
    """SCORES of a block's texts from its stream and the answers of all shards."""
    stream = unpack(rows.loc[rows["kind"] == STREAM, "payload"].iloc[0])
    docs, none, held, sizes, hashes, tokens = stream
    sizes, tokens = sizes.astype(np.int64), tokens.astype(np.int64)
    answers = rows[rows["kind"] == QUESTION].sort_values(["grade", "shard"])
    counts, seen = (
        np.concatenate([unpack(p)[0].astype(np.int64) for p in answers.loc[answers["grade"] == g, "payload"]]) for g in (1, 2)
    )
    end = int(np.searchsorted(hashes, np.uint64(xxhash.xxh64_intdigest(END))))
    pairs = np.unique(_before(tokens, sizes, end) * len(hashes) + tokens)
    order = np.argsort(bigram_hashes(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)]), kind="stable")
    by_pair = np.empty(len(pairs), np.int64)
    by_pair[order] = seen
    starts = np.cumsum(sizes) - sizes
    if total:
        base = np.log10((counts + 0.5) / (total + 0.5 * (words + 1)))[tokens]
        walked = Automaton(counts, pairs, by_pair, total, words, once).walk(tokens, starts, end)
    else:
        base = walked = np.zeros(len(tokens))
    doc = pd.array(docs.view("<i8"), dtype="Int64")
    doc[none.astype(bool)] = pd.NA
    return pd.DataFrame(
        {
            "doc_id": doc,
            "held_out": held.astype(bool),
            "n_tokens": sizes,
            "n_known": np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts),
            "score": np.add.reduceat(walked, starts),
        }
    )


def scored(spark: SparkSession, docs: DataFrame, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), text_of().cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + BYTES_PER_TOKEN)).first()[0] or 0
    shards = size // BYTES_PER_TOKEN // shard_tokens + 1
    noted = written(rows.mapInArrow(lambda it: read_blocks(it, shards, block_tokens), ASK), "lm-blocks")
    answers = written(
        noted.where(F.col("kind") == QUESTION).groupBy("shard", "grade").applyInPandas(answer, ASK),
        "lm-answers",
    )
    figures = [unpack(r["payload"])[0] for r in answers.where((F.col("kind") == COUNTS) & (F.col("grade") == 1)).collect()]
    total, words, once = (int(sum(int(f[i]) for f in figures)) for i in range(3))
    both = noted.where(F.col("kind") == STREAM).unionByName(answers.where(F.col("kind") == QUESTION))
    scores = both.groupBy("block").applyInPandas(lambda df: score_block(df, total, words, once), SCORES)
    return scores.withColumn("train_tokens", F.lit(total).cast("long"))
