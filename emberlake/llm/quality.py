"""Quality from weak labels: overlapping heuristics, expectation-maximisation, a hashed linear scorer.

Heuristics vote good, bad or nothing on every document. How far each is to be trusted is estimated from how
they agree over the whole corpus: only the counts of vote patterns leave the tasks. The posteriors then label
a bounded sample, from which a linear model over hashed word shapes learns to score any text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import bounded_sample, mixed, others, quoted, slices, table, written
from emberlake.llm.train import averaged, logistic
from emberlake.llm.words import Words, split_words

BAD, GOOD, NONE = 0, 1, 2
SAMPLE = 20_000  # documents the scorer learns from, at most
DIMENSIONS = 1 << 14
THRESHOLD = 0.5
BALANCE = 0.5  # share of good documents before any vote

# Fixed values. What is measured, and from where on it makes a heuristic vote bad.
BAD_FROM = {
    "symbols": 0.15,  # share of ASCII marks among bytes that are not white space
    "capitals": 0.5,  # share of A-Z among A-Z and a-z
    "repeats": 0.1,  # share of words equal to the one before
    "nearby": 0.3,  # share of words equal to one of the five before
    "runs": 0.1,  # share of words equal to both the two before
    "favourite": 0.35,  # share of the most frequent word
    "markless": 0.2,  # share of words without a letter
    "exclaiming": 0.3,  # share of words that end in an exclamation mark
    "decorated": 0.3,  # share of words that end in two marks or more
    "long_words": 25.0,  # average bytes of a word
}
# Heuristics that vote good: all of these measures at most so large.
GOOD_TO = {
    "form": {"symbols": 0.08, "capitals": 0.2, "decorated": 0.05},
    "flow": {"nearby": 0.2, "favourite": 0.2, "markless": 0.08, "long_words": 14.0},
}
HEURISTICS = (*BAD_FROM, *GOOD_TO)
MOST_ACCURATE = 0.95  # an estimated accuracy is held below, so that two heuristics outvote any one
LEAST_WORDS = 5  # shares of fewer words say nothing

CLASS = np.full(256, 3, np.uint8)  # 0 a-z, 1 A-Z, 2 digit, 3 beyond ASCII; marks stand for themselves
CLASS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = [
    *range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)
]
CLASS[0x61:0x7B], CLASS[0x41:0x5B], CLASS[0x30:0x3A] = 0, 1, 2
MARK = (CLASS > 3) & (np.arange(256) < 0x80)


def _inside(flags: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each span."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[ends] - sums[begins]


def measures(words: Words) -> np.ndarray:
    """(texts, measures) in the order of ``BAD_FROM``."""
    n, data, starts, counts = len(words), words.data, words.starts, np.maximum(words.counts, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return _inside(flags, words.offsets[:-1], words.offsets[1:])

    def share(of_words: np.ndarray) -> np.ndarray:
        return _inside(of_words, starts[:-1], starts[1:]) / counts

    upper = (data >= 0x41) & (data <= 0x5A)
    letters = upper | ((data >= 0x61) & (data <= 0x7A))
    ink = np.zeros(n)
    sizes = words.ends - words.begins
    np.add.at(ink, words.owners, sizes)
    marks = MARK[data]
    owners = words.owners

    def same(k: int) -> np.ndarray:
        found = np.zeros(len(owners), bool)
        found[k:] = (words.hashes[k:] == words.hashes[:-k]) & (owners[k:] == owners[:-k])
        return found

    near = [same(k) for k in range(1, 6)]
    most = np.zeros(n)
    for i in range(n):
        own = words.hashes[starts[i] : starts[i + 1]]
        if len(own):
            most[i] = np.unique(own, return_counts=True)[1].max()
    lettered = letters | (data >= 0x80)
    last = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    before = data[np.maximum(words.ends - 2, words.begins)] if len(words.ends) else np.zeros(0, np.uint8)
    return np.stack(
        [
            per_text(marks) / np.maximum(ink, 1),
            per_text(upper) / np.maximum(per_text(letters), 1),
            share(near[0]),
            share(np.logical_or.reduce(near)),
            share(near[0] & near[1]),
            most / counts,
            share(_inside(lettered, words.begins, words.ends) == 0),
            share(last == 0x21),
            share(MARK[last] & MARK[before] & (sizes > 1)),
            ink / counts,
        ],
        axis=1,
    )


def votes(words: Words) -> np.ndarray:
    """(texts, heuristics) of BAD, GOOD or NONE. A text without words gets BAD from all."""
    found = dict(zip(BAD_FROM, measures(words).T, strict=True))
    bad = [np.where(found[name] >= bound, BAD, NONE) for name, bound in BAD_FROM.items()]
    good = [
        np.where(np.logical_and.reduce([found[m] <= bound for m, bound in all_of.items()]), GOOD, NONE)
        for all_of in GOOD_TO.values()
    ]
    out = np.stack(bad + good, axis=1)
    out[words.counts < LEAST_WORDS] = NONE
    out[words.counts == 0] = BAD
    return out


class LabelModel:
    """Each heuristic's accuracy, fitted to the counts of vote patterns.

    A heuristic that votes is right with its accuracy, whichever the class; one that doesn't vote says nothing.
    Expectation: the probability that a pattern's documents are good. Maximisation: accuracies are the
    expected shares of right votes. The class balance is given, not fitted: with a fitted one a rare class
    can vanish.
    """

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, balance: float = BALANCE, rounds: int = 100) -> None:
        self.balance = balance
        self.accuracy = np.full(patterns.shape[1], 0.8)
        for _ in range(rounds):
            good = self.posterior(patterns)[:, None]
            cast = ((patterns != NONE) * counts[:, None]).sum(axis=0)
            right = (np.where(patterns == GOOD, good, np.where(patterns == BAD, 1 - good, 0)) * counts[:, None]).sum(axis=0)
            self.accuracy = np.clip((right + 8) / (cast + 10), 0.5, MOST_ACCURATE)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good."""
        weight = np.log(self.accuracy / (1 - self.accuracy))
        side = np.where(patterns == GOOD, 1, np.where(patterns == BAD, -1, 0))
        return logistic(np.log(self.balance / (1 - self.balance)) + side @ weight)

    @property
    def accuracies(self) -> dict[str, float]:
        return dict(zip(HEURISTICS, self.accuracy.tolist(), strict=True))


def _shapes(words: Words) -> np.ndarray:
    """Word shapes: kinds of the first, last and last but one byte, inner marks, capitals, length, repetition."""
    if not len(words.hashes):
        return np.zeros(0, np.uint64)
    b, e, data = words.begins, words.ends, words.data
    upper = (data >= 0x41) & (data <= 0x5A)
    parts = [
        CLASS[data[b]],
        CLASS[data[e - 1]],
        CLASS[data[np.maximum(e - 2, b)]],
        np.minimum(_inside(MARK[data], b, e), 3),
        np.minimum(_inside(upper, b, e), 2),
        np.minimum((e - b) // 4, 6),
        np.concatenate([[0], words.hashes[1:] == words.hashes[:-1]]),
    ]
    total = np.zeros(len(b), np.uint64)
    for part in parts:
        total = total * np.uint64(128) + part.astype(np.uint64)
    return mixed(total + np.uint64(1))


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, share) of hashed shapes and of hashed pairs of shapes."""
    shapes, owners = _shapes(words), words.owners
    pairs = mixed(shapes[:-1] * np.uint64(3) + shapes[1:])[owners[1:] == owners[:-1]]
    bucket = np.concatenate([shapes, pairs]) % np.uint64(DIMENSIONS)
    owner = np.concatenate([owners, owners[1:][owners[1:] == owners[:-1]]])
    cell, count = np.unique(owner.astype(np.int64) * DIMENSIONS + bucket.astype(np.int64), return_counts=True)
    text, index = cell // DIMENSIONS, cell % DIMENSIONS
    return text, index, count / (2 * words.counts[text] - 1 + LEAST_WORDS * 2)


def _fit(sample: pa.Table, epochs: int = 300, rate: float = 4.0, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels: full gradients with per-coordinate (Adagrad) steps."""
    weights, squares = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-8)
    if not sample.num_rows:
        return weights
    parts, before = [], 0
    for batch in slices(sample.select(["text"]).to_batches(), "text", 1 << 20):
        text, index, share = features(split_words(batch.column("text")))
        parts.append((text + before, index, share))
        before += batch.num_rows
    text, index, share = (np.concatenate(column) for column in zip(*parts, strict=True))
    goal = sample["label"].to_numpy()
    n = len(goal)
    for _ in range(epochs):
        score = np.bincount(text, weights[index] * share, n) + weights[-1]
        miss = (logistic(score) - goal) / n
        slope = np.append(np.bincount(index, miss[text] * share, DIMENSIONS), miss.sum()) + ridge * weights
        squares += slope * slope
        weights -= rate * slope / np.sqrt(squares) / 4
    return weights


def _cast_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        cast = votes(split_words(batch.column("text")))
        code = cast @ (3 ** np.arange(len(HEURISTICS)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(code, pa.int64())],
            names=["doc_id", "text_key", "votes"],
        )


def _scored(weights) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"))
            text, index, share = features(words)
            score = logistic(np.bincount(text, weights.value[index] * share, len(words)) + weights.value[-1])
            score[words.counts == 0] = 0.0
            yield batch.append_column("quality_score", pa.array(score))

    return run


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, np.ndarray]:
    """The label model of the whole corpus, and scorer weights learned from at most ``sample`` documents."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    cast = written(keyed.mapInArrow(_cast_votes, "doc_id long, text_key long, votes long"), "votes")
    counted = cast.groupBy("votes").count().toPandas()  # at most 3^12 patterns
    patterns = counted["votes"].to_numpy(np.int64)[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3
    model = LabelModel(patterns, counted["count"].to_numpy(float))
    spark = docs.sparkSession
    labels = spark.createDataFrame(
        [(int(v), float(p)) for v, p in zip(counted["votes"], model.posterior(patterns), strict=True)],
        "votes long, label double",
    )
    chosen = bounded_sample(cast.groupBy("text_key", "votes").agg(F.min("doc_id").alias("doc_id")), "text_key", sample)
    chosen = F.broadcast(chosen.join(F.broadcast(labels), "votes").select("text_key", "label"))
    rows = keyed.join(chosen, "text_key").dropDuplicates(["text_key"]).select("doc_id", "text", "label")
    return model, averaged(rows, _fit)


def scored(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with a column quality_score, the scorer's probability that a text is good.

    ``docs`` has doc_id and text; all its columns are passed on. The scorer is trained on ``docs`` itself:
    heuristics vote on every document, votes of all are counted, at most ``sample`` texts are learned from.

    Null, empty or blank text: score 0. Texts of fewer than five words: no heuristic votes, the scorer
    judges their shapes. Repeated rows and ties get equal scores. Null doc_id is allowed. An empty table
    gives an empty result.
    """
    _, weights = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), sample)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    docs = docs.select(*map(quoted, others(docs, "quality_score")))
    schema = docs.select("*", F.lit(0.0).alias("quality_score")).schema
    return docs.mapInArrow(_scored(shared), schema)


def without_poor(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents scored below ``threshold``; a null text goes with the empty ones."""
    if "quality_score" not in map(str.lower, docs.columns):
        return scored(docs).where(F.col("quality_score") >= threshold).drop("quality_score")
    row = F.struct(*map(quoted, docs.columns)).alias("row")
    good = scored(docs.select("doc_id", "text", row)).where(F.col("quality_score") >= threshold)
    return good.select(*[F.col(f"row.{quoted(c)}") for c in docs.columns])


def op2_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("quality")
    )
