"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask laid over a text: the hash of the words at its places, whatever stands between them.
Texts that share a passage with some words replaced still share seeds. The masks below together miss no
13-word window in which at most three words differ (every such pattern leaves one of them whole; tests go
through all patterns). Hits are only candidates: the words around them are compared with the item.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import has_bit, membership_bits, slices, table, written
from emberlake.llm.words import split_words, weighted_sums

# Places of each mask, found by search.
MASKS = (
    (0, 1, 3, 5, 6, 7),
    (0, 1, 2, 5, 7, 8),
    (0, 1, 3, 7, 8, 9),
    (0, 1, 3, 4, 5, 6),
    (0, 1, 2, 3, 8, 10),
)
WINDOW, MATCHES = 13, 10  # so many words of a window must be equal, each at its place
SHORTEST = 5  # items with fewer words say too little to be searched for
SPAN = max(m[-1] for m in MASKS) + 1
SOLID = range(SHORTEST, max(m[-1] for m in MASKS[:1]) + 1)  # item lengths that the first mask doesn't fit


def _seeds(hashes: np.ndarray, solid: tuple[int, ...]) -> list[np.ndarray]:
    """Seed hashes by mask: entry ``p`` of each is the mask laid at word ``p``."""
    masks = [weighted_sums(hashes, m, 100 + k) for k, m in enumerate(MASKS)]
    return masks + [weighted_sums(hashes, range(n), 200 + n) for n in solid]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Searchable items: words, and the seeds of which a copy has at least one."""
    for batch in slices(batches, "text"):
        words = split_words(batch.column("text"), bare=True)
        rows = []
        for i, item_id in enumerate(batch.column("item_id").to_pylist()):
            own = words.hashes[words.starts[i] : words.starts[i + 1]]
            if len(own) < SHORTEST:
                continue
            solid = (len(own),) if len(own) in SOLID else ()
            seeds = np.unique(np.concatenate(_seeds(own, solid)))
            key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            rows.append((item_id, key, own.view(np.int64), seeds.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                pa.array([r[3] for r in rows], pa.list_(pa.int64())),
            ],
            names=["item_id", "item", "item_words", "seeds"],
        )


def _regions(bits, solid: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stretches of a document around possible hits, with the hits' seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 40
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"), bare=True)
            found_at, found = [], []
            for seeds in _seeds(words.hashes, solid):
                hit = np.flatnonzero(has_bit(bits.value, seeds))
                found_at.append(hit)
                found.append(seeds[hit])
            at, seed = np.concatenate(found_at), np.concatenate(found)
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order]
            owner = np.searchsorted(words.starts, at, side="right") - 1
            # a new stretch begins where the reach of the hits before ends, or another document begins
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > SPAN + 2 * WINDOW) | (np.diff(owner) > 0)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1 if len(at) else first
            low = np.maximum(at[first] - WINDOW, words.starts[owner[first]])
            high = np.minimum(at[last] + SPAN + WINDOW, words.starts[owner[first] + 1])
            signed = words.hashes.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + np.arange(len(first))),
                    batch.column("doc_id").take(pa.array(owner[first])),
                    batch.column("text_key").take(pa.array(owner[first])),
                    pa.array([signed[a:b] for a, b in zip(low, high, strict=True)], pa.list_(pa.int64())),
                    pa.array(
                        [np.unique(seed[a : b + 1]).view(np.int64) for a, b in zip(first, last, strict=True)],
                        pa.list_(pa.int64()),
                    ),
                ],
                names=["region", "doc_id", "text_key", "region_words", "hits"],
            )
            number += len(first)

    return run


def overlap(region: np.ndarray, item: np.ndarray) -> int:
    """Most words of ``item`` that one alignment has equal inside matching windows; 0 if no window matches."""
    n = len(item)
    window = min(WINDOW, n)
    least = MATCHES if n >= WINDOW else n
    padded = np.concatenate([np.zeros(n, np.int64), region, np.zeros(n, np.int64)])
    shifts = sliding_window_view(padded, n)
    best, step = 0, max(1, (1 << 22) // n)
    for start in range(0, len(shifts), step):
        equal = shifts[start : start + step] == item
        some = equal.sum(axis=1) >= least
        if not some.any():
            continue
        equal = equal[some]
        sums = np.concatenate([np.zeros((len(equal), 1), np.int32), equal.cumsum(axis=1, dtype=np.int32)], axis=1)
        good = sums[:, window:] - sums[:, :-window] >= least
        covered = np.zeros((len(equal), n + 1), np.int32)
        covered[:, : n - window + 1] += good
        covered[:, window : n + 1] -= good
        inside = (covered.cumsum(axis=1)[:, :n] > 0) & equal
        best = max(best, int(inside.sum(axis=1).max()))
    return best


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regions, items = batch.column("region_words"), batch.column("item_words")
        size = [overlap(r.values.to_numpy(), i.values.to_numpy()) for r, i in zip(regions, items, strict=True)]
        out = batch.select(["doc_id", "text_key", "item_id"]).add_column(3, "overlap", pa.array(size, pa.int64()))
        yield out.filter(pa.array(np.array(size) > 0))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, overlap): benchmark items of which a document holds a passage.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; further columns are ignored. Words are
    compared without case (A-Z) and without marks at their ends. A passage counts where at least 10 of 13
    words in a row are equal at their places; an item of 5 to 12 words must be there whole; shorter items
    are not searched for. ``overlap`` is the number of equal words in such windows. Items with the same words
    are reported under their least id. ``text_key`` tells rows with one doc_id apart.

    Null or empty texts match nothing. Null ids are passed on. Repeated rows give one result. Empty tables
    give an empty result.
    """
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = benchmark.mapInArrow(
        _items, "item_id long, item binary, item_words array<long>, seeds array<long>"
    )
    items = written(items.groupBy("item", "item_words", "seeds").agg(F.min("item_id").alias("item_id")), "items")
    seeds = written(items.select("item", F.explode("seeds").alias("seed")), "seeds")
    spark = docs.sparkSession
    lengths = items.select(F.size("item_words").alias("n")).where(F.col("n").isin(*SOLID)).distinct()
    solid = tuple(sorted(r[0] for r in lengths.collect()))  # at most len(SOLID) numbers
    bits = spark.sparkContext.broadcast(membership_bits(seeds, "seed"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    regions = keyed.mapInArrow(
        _regions(bits, solid),
        "region long, doc_id long, text_key long, region_words array<long>, hits array<long>",
    )
    regions = written(regions, "regions")
    hits = regions.select("region", F.explode("hits").alias("seed")).join(seeds, "seed")
    candidates = written(hits.select("region", "item").distinct(), "candidates")
    full = candidates.join(regions.drop("hits"), "region").join(items.drop("seeds"), "item")
    found = full.select("doc_id", "text_key", "item_id", "region_words", "item_words").mapInArrow(
        _verify, "doc_id long, text_key long, item_id long, overlap long"
    )
    return found.groupBy("doc_id", "text_key", "item_id").agg(F.max("overlap").alias("overlap"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a passage of the benchmark."""
    found = written(overlaps(docs, benchmark).select("doc_id", "text_key").distinct(), "contaminated")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64("d.text") == F.col("f.text_key"))
    return docs.alias("d").join(found.alias("f"), same, "left_anti")


def op10_spaced_seed_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = overlaps(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "item_id", F.col("overlap").alias("overlap_words"))
