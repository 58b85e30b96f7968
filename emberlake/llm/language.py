"""Language identification by error-correcting output codes.

Each language has a codeword. For every bit a linear classifier over hashed byte n-grams says on which side a
text lies. The language whose codeword loses least against all bits, each weighted by how well its classifier
separates, is the answer; where the runner-up loses hardly more, the answer is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import bounded_sample, others, quoted, remainder, slices, table
from emberlake.llm.train import averaged
from emberlake.llm.words import LOWER, text_bytes

PER_LANGUAGE = 2_000  # documents learned from per language, about
DIMENSIONS = 1 << 12
GRAMS = (2, 3)
UNKNOWN = "und"
AMBIGUOUS = 0.8  # answers with a lower score are flagged
FOLDS = 5

PLAIN = LOWER.copy()  # letters in lower case, bytes beyond ASCII, and a space for all else
PLAIN[[*range(0, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20
LETTER = (PLAIN != 0x20) & (np.arange(256) < 0x80)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # (languages, bits) of -1 or 1
    weights: np.ndarray  # (DIMENSIONS + 1, bits)
    trust: np.ndarray  # (bits,)


def codewords(n: int) -> np.ndarray:
    """(n, bits) of -1 or 1: all ways to cut few languages in two, else the best of random codes (fixed seed)."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:
        cuts = [c for c in itertools.product((-1, 1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(cuts, float).T.reshape(n, len(cuts))
    bits = 10 * int(np.ceil(np.log2(n)))
    random = np.random.default_rng(11)
    draws = [random.choice((-1.0, 1.0), (n, bits)) for _ in range(200)]
    apart = [(bits - (d @ d.T - bits * 3 * np.eye(n)).max()) / 2 for d in draws]
    best = draws[int(np.argmax(apart))]
    return best[:, np.abs(best.sum(axis=0)) < n]


def features(texts: pa.Array) -> np.ndarray:
    """(texts, DIMENSIONS): square roots of hashed byte n-gram counts, each row of length 1."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    plain = PLAIN[data].astype(np.uint32)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.zeros(n * DIMENSIONS)
    for size in GRAMS:
        if len(plain) < size:
            continue
        gram = np.zeros(len(plain) - size + 1, np.uint32)
        for k in range(size):
            gram = gram * np.uint32(256) + plain[k : len(plain) - size + 1 + k]
        blank = gram == np.uint32(sum(0x20 << 8 * k for k in range(size)))
        inside = (owner[: len(gram)] == owner[size - 1 :]) & ~blank
        bucket = ((gram[inside] * np.uint32(0x9E3779B1)) ^ np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(20)
        counts += np.bincount(owner[: len(gram)][inside] * DIMENSIONS + bucket, minlength=n * DIMENSIONS)
    x = np.sqrt(counts.reshape(n, DIMENSIONS))
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script."""
    data, offsets = text_bytes(texts)
    sums = np.concatenate([[0], np.cumsum(LETTER[data])])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return found


def _fit(codes: np.ndarray) -> Callable[[pa.Table], np.ndarray]:
    """Logistic regression of all bits at once: full gradients with momentum."""

    def run(sample: pa.Table, steps: int = 200, rate: float = 30.0, ridge: float = 1e-4) -> np.ndarray:
        weights = np.zeros((DIMENSIONS + 1, codes.shape[1]))
        if not sample.num_rows:
            return weights.ravel()
        batches = slices(sample.select(["text"]).to_batches(), "text", 1 << 20)
        x = np.concatenate([features(b.column("text")).astype(np.float32) for b in batches])
        y = codes[sample["label"].to_numpy()]
        speed = np.zeros_like(weights)
        for _ in range(steps):
            margin = x @ weights[:-1].astype(np.float32) + weights[-1]
            pull = -y / (1 + np.exp(np.clip(y * margin, -30, 30))) / len(y)
            slope = np.vstack([x.T @ pull.astype(np.float32), pull.sum(axis=0)]) + ridge * weights
            speed = 0.9 * speed - rate * slope / 10
            weights += speed
        return weights.ravel()

    return run


def decode(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language with the least weighted loss, and its share of exp(-loss) over all languages."""
    margin = x @ model.weights[:-1] + model.weights[-1]
    loss = np.log1p(np.exp(-np.clip(margin[:, None, :] * model.codes[None], -30, 30))) @ model.trust
    likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
    return likely.argmax(axis=1), likely.max(axis=1) / likely.sum(axis=1)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from (doc_id, text, lang) rows with a language: about ``per_language`` of each, by hash.

    The driver learns the list of languages and one weight vector per shard.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.withColumn("text_key", F.xxhash64("text"))
    texts = known.groupBy("text_key").agg(F.min("lang").alias("lang"))
    counted = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    languages = sorted(counted)
    codes = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, codes, np.zeros((DIMENSIONS + 1, codes.shape[1])), np.ones(codes.shape[1]))
    rows = [(name, i, min(1.0, per_language / counted[name])) for i, name in enumerate(languages)]
    shares = F.broadcast(docs.sparkSession.createDataFrame(rows, "lang string, label int, share double"))
    draw = F.pmod(F.xxhash64("text_key", F.lit("draw")), F.lit(1_000_000)) < F.col("share") * 1_000_000
    chosen = texts.join(shares, "lang").where(draw).select("text_key", "label")
    chosen = F.broadcast(bounded_sample(chosen, "text_key", 2 * per_language * len(languages)))
    sample = known.select("doc_id", "text", "text_key").join(chosen, "text_key").dropDuplicates(["text_key"])
    weights = averaged(sample.select("doc_id", "text", "label"), _fit(codes)).reshape(DIMENSIONS + 1, -1)
    return Model(languages, codes, weights, np.ones(codes.shape[1]) * 2.0 / codes.shape[1] * len(languages))


def _identify(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in slices(batches, "text", 2 << 20):
            texts = batch.column("text")
            known = has_letter(texts) & (len(m.languages) > 0)
            best, score = np.zeros(batch.num_rows, int), known.astype(float)
            if len(m.languages) > 1:
                best, score = decode(m, features(texts))
            names = [m.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
            score = np.where(known, np.round(score, 9), 0.0)
            out = batch.append_column("lang_pred", pa.array(names, pa.string()))
            out = out.append_column("lang_score", pa.array(score))
            yield out.append_column("ambiguous", pa.array(score < AMBIGUOUS))

    return run


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, lang_score (0 to 1) and ambiguous; depends on the text alone.

    ``docs`` has text; all its columns are passed on. Null text or text without a letter: ``und``, score 0.
    Repeated rows and ties get equal answers; equal losses go to the first language by name. Without a
    learned language all is ``und``; with one, every text with a letter is that. An empty table gives an
    empty result.
    """
    docs = docs.select(*map(quoted, others(docs, "lang_pred", "lang_score", "ambiguous")))
    schema = docs.select(
        "*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("lang_score"), F.lit(False).alias("ambiguous")
    ).schema
    return docs.mapInArrow(_identify(docs.sparkSession.sparkContext.broadcast(model)), schema)


def op9_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    left = F.coalesce(remainder(F.col("doc_id"), FOLDS) == 0, F.lit(True))
    found = identified(docs.select("doc_id", "text"), train(docs.where(~left)))
    return found.select("doc_id", left.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "ambiguous")
