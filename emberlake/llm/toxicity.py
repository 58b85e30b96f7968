"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and the L1 term keeps a weight at exactly 0 until enough gradient
speaks for it, so the model is a short sorted list of hashes that every task can hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import bits_of, bounded_sample, has_bit, mixed, others, quoted, remainder, slices, table
from emberlake.llm.train import averaged_sparse, logistic
from emberlake.llm.words import Words, split_words

SAMPLE = 20_000  # labelled documents the model learns from, at most
ALPHA, BETA, L2 = 4.0, 1.0, 0.1
L1 = 0.4  # times the root of the number of documents, as gradients of noise add up
EPOCHS = 15
LEAST_DOCUMENTS = 2  # a feature of one document alone says nothing of others
RARE = 8.0  # most that a document of the rarer class weighs against one of the other
BIAS = np.uint64(0)  # the feature every document has
FOLDS = 5  # documents with remainder 0 are held out


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of single words, pairs of neighbours, and pairs with one word between."""
    h, owners = words.hashes, words.owners
    parts = [(owners, mixed(h + np.uint64(1)))]
    for gap, seed in ((1, 2), (2, 3)):
        same = owners[gap:] == owners[:-gap]
        pair = mixed(mixed(h[:-gap] + np.uint64(seed)) + h[gap:] * np.uint64(3))
        parts.append((owners[gap:][same], pair[same]))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _distinct_features(texts: pa.ChunkedArray) -> list[np.ndarray]:
    """Sorted feature hashes of each text, made a few megabytes of text at a time."""
    out = []
    for batch in slices(pa.table({"text": texts}).to_batches(), "text", 1 << 20):
        owner, found = features(split_words(batch.column("text"), bare=True))
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(1, batch.num_rows))
        out += [np.unique(own) for own in np.split(found[order], bounds)]
    return out


def _fit(sample: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over the documents in order; each feature counts once per document.

    Features of one document only are left out; of the others L1 chooses.
    """
    labels = sample["label"].to_numpy().astype(float)
    hashes_of = _distinct_features(sample["text"])
    seen = np.concatenate([*hashes_of, np.zeros(0, np.uint64)])
    seen.sort()
    new = np.flatnonzero(np.append(True, seen[1:] != seen[:-1])[: len(seen)])
    common = seen[new[np.diff(np.append(new, len(seen))) >= LEAST_DOCUMENTS]]
    del seen
    # place 0 is the bias
    features_of = [1 + np.searchsorted(common, own[np.isin(own, common, assume_unique=True)]) for own in hashes_of]
    share = min(max(labels.mean(), 1e-6), 1 - 1e-6) if len(labels) else 0.5
    weight = np.where(labels > 0, min(RARE, max(1, 1 / share - 1)), min(RARE, max(1, 1 / (1 / share - 1))))
    z, n = np.zeros(len(common) + 1), np.zeros(len(common) + 1)
    l1 = np.full(len(z), L1 * np.sqrt(len(labels)))
    l1[0] = 0

    def weights_at(i: np.ndarray) -> np.ndarray:
        pull = np.sign(z[i]) * l1[i] - z[i]
        return np.where(np.abs(z[i]) <= l1[i], 0.0, pull / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for own, label, counts in zip(features_of, labels, weight, strict=False):
            i = np.append(own, 0)
            w = weights_at(i)
            slope = counts * (float(logistic(w.sum())) - label)
            sigma = (np.sqrt(n[i] + slope * slope) - np.sqrt(n[i])) / ALPHA
            z[i] += slope - sigma * w
            n[i] += slope * slope
    final = weights_at(np.arange(len(z)))
    names = np.concatenate([np.array([BIAS]), common])
    some = final != 0
    return names[some], final[some]


def _scores(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights, bits = model.value
        bias = weights[hashes == BIAS].sum()
        for batch in slices(batches, "text", 2 << 20):
            owner, found = features(split_words(batch.column("text"), bare=True))
            maybe = has_bit(bits, found)
            owner, found = owner[maybe], found[maybe]
            at = np.searchsorted(hashes, found)
            at[at == len(hashes)] = 0
            known = hashes[at] == found if len(hashes) else np.zeros(len(found), bool)
            pairs = np.unique(np.stack([owner[known], at[known]]), axis=1)  # once per document
            total = np.bincount(pairs[0], weights[pairs[1]], batch.num_rows) + bias
            yield batch.append_column("toxicity", pa.array(logistic(np.round(total, 9))))

    return run


def train(docs: DataFrame, labels: DataFrame, column: str, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature hashes and weights, learned from documents (doc_id, text) and labels (doc_id, ``column``).

    At most ``sample`` labelled documents are read, chosen by a hash of their id; only ids move before they
    are chosen. Of several labels of an id the largest holds, of several texts the least.
    """
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(column).alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = F.broadcast(bounded_sample(known, "doc_id", sample))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    return averaged_sparse(rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")), _fit)


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` with a column toxicity: the probability that a text is toxic.

    ``docs`` has text; all its columns are passed on. The score depends on the text alone. Words are compared
    without case (A-Z) and marks at their ends; a feature counts once per text.

    Null, empty or blank text: the score of the bias, the rate among the learned documents. Repeated rows
    and ties get equal scores. An empty table gives an empty result; a model without weights gives 0.5.
    """
    hashes, weights = model
    bits = bits_of(hashes)
    shared = docs.sparkSession.sparkContext.broadcast((hashes, weights, bits))
    docs = docs.select(*map(quoted, others(docs, "toxicity")))
    schema = docs.select("*", F.lit(0.0).alias("toxicity")).schema
    return docs.mapInArrow(_scores(shared), schema)


def op8_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    left = F.coalesce(remainder(F.col("doc_id"), FOLDS) == 0, F.lit(True))
    model = train(docs, labels.where(~left), "toxic")
    found = scored(docs, model)
    score = F.col("toxicity")
    return found.select("doc_id", left.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
