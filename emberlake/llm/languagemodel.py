"""Language-model scores of all documents from a bigram trie over the training documents.

Nothing of the model is whole anywhere. Map tasks cut their documents into blocks and sort each block's word
pairs by shard; a shard gets its pairs from all blocks, counts those of training documents, lays them down as a
trie of Elias-Fano levels and answers the pairs of every block from it. Sums by document come back by block.

A pair goes to the shard of its later word, and pairs of a frequent word are dealt out by the word before as
well. The most frequent words with their counts are the one thing that all tasks share: a list of fixed length.

The probability of word w after u mixes the pair with the single word, p1(w) = (c(w) + 1) / (N + V + 1):
after a word on that list it is TRUST * c(u, w) / c(u) + (1 - TRUST) * p1(w), after any other
(c(u, w) + m * p1(w)) / (c(u) + m), m being the least count on the list. Both add up to 1 over all words and one unknown.
In the second form log(c(u) + m) stands alone, so u's count isn't needed where w's are: the shard that knows u adds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import mixed, remainder, slices, table, written
from emberlake.llm.eliasfano import Trie
from emberlake.llm.words import split_words

FREQUENT = 1 << 16  # words whose counts every task holds: 1 MB
TRUST = 0.3  # share of the pair's own frequency after a frequent word
SHARD_BYTES = 12 << 20  # text per shard, about
BLOCK_BYTES = 3 << 20
BLOCK_DOCUMENTS = 32_000  # a block has 3 MB of text, or so many documents: their numbers have 15 bits
HELD = 1 << 15  # set on the number of a held-out document
END, BEGIN = np.uint64(1 << 60), np.uint64(2 << 60)  # stand for the end and the beginning of a text
CHILD_SHIFT = np.uint64(64 - Trie.CHILD_BITS)


@dataclass
class Frequent:
    """What all tasks share: frequent words in ascending order with their counts, and the corpus's sums."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    documents: int
    shards: int

    @property
    def least(self) -> float:
        return float(self.counts.min()) if len(self.counts) else 1.0

    def look_up(self, words: np.ndarray) -> np.ndarray:
        """Count of each word, 0 if it isn't on the list."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], 0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BLOCK_BYTES):
        for start in range(0, batch.num_rows, BLOCK_DOCUMENTS):
            yield batch.slice(start, BLOCK_DOCUMENTS)


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, document) of every word and of the end of every text."""
    words = split_words(batch.column("text"))
    n = len(words)
    total = len(words.hashes) + n
    ends = words.starts[1:] + np.arange(n)
    now = np.full(total, END, np.uint64)
    is_word = np.ones(total, bool)
    is_word[ends] = False
    now[is_word] = words.hashes
    before = np.concatenate([np.array([BEGIN]), now[:-1]])[:total]
    before[(words.starts[:-1] + np.arange(n)).astype(np.int64)] = BEGIN
    return now, before, np.repeat(np.arange(n), words.counts + 1)


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, with the places of its entries in their order."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), order[bounds[s] : bounds[s + 1]]


def _single_counts(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            words, counts = np.unique(_tokens(batch)[0], return_counts=True)
            rows = [
                (s, words[at].tobytes(), counts[at].astype(np.uint32).tobytes())
                for s, at in _by_shard((mixed(words) % np.uint64(shards)).astype(np.int64), shards)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows, strict=True)], names=["shard", "words", "counts"]
                )

    return run


def _single_sums(part: pa.Table) -> pa.Table:
    """Sums of one shard, and its most frequent words."""
    words = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in part["words"]])
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in part["counts"]]).astype(np.int64)
    distinct, place = np.unique(words, return_inverse=True)
    total = np.bincount(place, counts, len(distinct)).astype(np.int64)
    top = np.sort(np.argsort(-total, kind="stable")[:FREQUENT])
    return pa.table(
        {
            "word": pa.array(np.concatenate([np.zeros(1, np.uint64), distinct[top]]).view(np.int64)),
            "count": pa.array(np.concatenate([[total.sum()], total[top]])),
            "distinct": pa.array(np.concatenate([[len(distinct)], np.zeros(len(top), np.int64)])),
        }
    )


def frequent_words(training: DataFrame, shards: int) -> Frequent:
    """Counts every word of the training texts in shards; the driver gets sums and the ``FREQUENT`` heaviest."""
    documents = training.count()
    blocks = training.mapInArrow(_single_counts(shards), "shard long, words binary, counts binary")
    counted = blocks.groupBy("shard").applyInArrow(_single_sums, "word long, count long, distinct long")
    counted = written(counted, "words")
    tokens, distinct = counted.where("distinct > 0").agg(F.sum("count"), F.sum("distinct")).first()
    top = counted.where("distinct = 0").orderBy(F.desc("count"), "word").limit(FREQUENT).toPandas()
    words = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    words, counts = words[order], top["count"].to_numpy(np.int64)[order]
    return Frequent(words, counts, int(tokens or 0), int(distinct or 0), documents, shards)


def _child(words: np.ndarray) -> np.ndarray:
    """The part of a word's hash that is kept under another word."""
    return words >> CHILD_SHIFT


def _pairs(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each block and shard: distinct pairs, sorted, and in which documents each is, how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for batch in _blocks(batches):
            now, before, owner = _tokens(batch)
            vocabulary, ids = np.unique(np.concatenate([now, before]), return_inverse=True)
            pair = ids[: len(now)] * len(vocabulary) + ids[len(now) :]
            order = np.argsort(pair, kind="stable")
            pair, owner = pair[order], owner[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
            post = np.flatnonzero(new)
            often = np.diff(np.append(post, len(pair)))
            pair, owner = pair[post], owner[post]
            new = np.ones(len(pair), bool)
            new[1:] = pair[1:] != pair[:-1]
            first = np.flatnonzero(new)
            posts = np.diff(np.append(first, len(pair)))
            w, u = vocabulary[pair[first] // len(vocabulary)], vocabulary[pair[first] % len(vocabulary)]
            spread = np.where(frequent.look_up(w) > 0, mixed(w + mixed(_child(u))), mixed(w))
            shard = (spread % np.uint64(frequent.shards)).astype(np.int64)
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint16) * np.uint16(HELD)
            lengths = np.bincount(owner, often, batch.num_rows).astype(np.int64).tolist()
            marked = owner.astype(np.uint16) | held[owner]
            cuts = list(_by_shard(shard, frequent.shards))
            rows = []
            for k, (s, at) in enumerate(cuts):
                cut = np.flatnonzero(np.diff(w[at], prepend=~w[at[:1]]))
                places = np.repeat(first[at] - np.cumsum(posts[at]) + posts[at], posts[at]) + np.arange(posts[at].sum())
                rows.append(
                    (
                        s,
                        number,
                        w[at[cut]].tobytes(),
                        np.diff(np.append(cut, len(at))).astype(np.uint32).tobytes(),
                        np.ascontiguousarray(_child(u[at]).view(np.uint8).reshape(-1, 8)[:, : Trie.CHILD_BITS // 8]).tobytes(),
                        posts[at].astype(np.uint16).tobytes(),
                        marked[places].tobytes(),
                        often[places].astype(np.uint32).tobytes(),
                        batch.column("doc_id").to_pylist() if k == number % len(cuts) else None,
                        batch.column("held_out").to_pylist() if k == number % len(cuts) else None,
                        lengths if k == number % len(cuts) else None,
                    )
                )
            names = ["shard", "block", "words", "sizes", "children", "posts", "owners", "often", "documents", "held_out", "n_tokens"]
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            for k, kind in ((-3, pa.int64()), (-2, pa.bool_()), (-1, pa.int64())):
                columns[k] = columns[k].cast(pa.list_(kind))
            yield pa.RecordBatch.from_arrays(columns, names=names)
            number += 1

    return run


@dataclass
class _Block:
    """What one block sends to one shard: its pairs, and the documents (and how often) each is in."""

    number: int
    words: np.ndarray
    children: np.ndarray
    posts: np.ndarray
    owners: np.ndarray
    train: np.ndarray  # whether each is a training document
    often: np.ndarray

    @classmethod
    def read(cls, row: dict) -> _Block:
        sizes = np.frombuffer(row["sizes"].as_buffer(), np.uint32)
        wide = np.zeros((int(sizes.sum()), 8), np.uint8)
        width = Trie.CHILD_BITS // 8
        owners = np.frombuffer(row["owners"].as_buffer(), np.uint16)
        wide[:, :width] = np.frombuffer(row["children"].as_buffer(), np.uint8).reshape(-1, width)
        return cls(
            row["block"].as_py(),
            np.repeat(np.frombuffer(row["words"].as_buffer(), np.uint64), sizes),
            wide.view(np.uint64).ravel(),
            np.frombuffer(row["posts"].as_buffer(), np.uint16).astype(np.int64),
            owners & np.uint16(HELD - 1),
            owners < HELD,
            np.frombuffer(row["often"].as_buffer(), np.uint32),
        )


def _pair_values(frequent: Frequent, pair_counts: np.ndarray, word_counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log10 of the part of p(w | u) that needs w. ``before``: u's count if u is frequent, else 0."""
    single = (word_counts + 1) / (frequent.tokens + frequent.distinct + 1)
    after_frequent = TRUST * pair_counts / np.maximum(before, 1) + (1 - TRUST) * single
    return np.log10(np.where(before > 0, after_frequent, pair_counts + frequent.least * single))


def _frequent_children(frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    children = _child(frequent.words)
    order = np.argsort(children)
    return children[order], frequent.counts[order]


def build_trie(blocks: Iterator[_Block], frequent: Frequent) -> bytes:
    """Trie of the pairs of training documents: counts of words, quantised log probabilities of pairs.

    Blocks come one at a time; only the distinct pairs of their training documents stay.
    """
    words, children, counts = [], [], []
    for b in blocks:
        sums = np.add.reduceat(b.often * b.train, np.cumsum(b.posts) - b.posts, dtype=np.uint32)
        words.append(b.words[sums > 0])
        children.append(b.children[sums > 0])
        counts.append(sums[sums > 0])
    word, child, count = np.concatenate(words), np.concatenate(children), np.concatenate(counts).astype(np.int64)
    del words, children, counts
    order = np.lexsort((child, word))
    word, child, count = word[order], child[order], count[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (child[1:] != child[:-1])
    first = np.flatnonzero(new)
    count = np.add.reduceat(count, first) if len(first) else count
    word, child = word[first], child[first]
    distinct, place, sizes = np.unique(word, return_inverse=True, return_counts=True)
    known = frequent.look_up(distinct)  # pairs of a frequent word lie in many shards
    totals = np.where(known > 0, known, np.bincount(place, count, len(distinct)).astype(np.int64))
    heads, head_counts = _frequent_children(frequent)
    values = _pair_values(frequent, count, totals[place], _count_of(heads, head_counts, child))
    return Trie.build(distinct, totals, sizes, child, values)


def _count_of(sorted_keys: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, counts[at], 0)


def _answers(shared) -> Callable[[pa.Table], pa.Table]:
    """Builds the shard's trie and gives, for each block, the sums of each of its documents."""

    def run(part: pa.Table) -> pa.Table:
        frequent = shared.value
        read = ("block", "words", "sizes", "children", "posts", "owners", "often")

        def blocks() -> Iterator[_Block]:
            """Each block taken from its bytes when its turn comes, once to count and once to answer."""
            for i in range(part.num_rows):
                yield _Block.read({name: part[name][i] for name in read})

        trie = Trie(build_trie(blocks(), frequent))
        heads, head_counts = _frequent_children(frequent)
        begin = _child(np.array([BEGIN]))[0]
        out = []
        for b in blocks():
            starts = np.flatnonzero(np.append(True, b.words[1:] != b.words[:-1]))
            own = trie.find(b.words[starts])
            # a frequent word's pairs in this shard may all be of held-out documents
            counts = frequent.look_up(b.words[starts])
            here = own >= 0
            counts[here] = trie.counts[own[here]].astype(np.int64)
            sizes = np.diff(np.append(starts, len(b.words)))
            ordinal, count = np.repeat(own, sizes), np.repeat(counts, sizes)
            before = _count_of(heads, head_counts, b.children)
            before[b.children == begin] = 0
            value = trie.value(ordinal, b.children)
            unseen = np.isnan(value)
            value[unseen] = _pair_values(frequent, np.zeros(unseen.sum()), count[unseen], before[unseen])
            # as the word before of the next one: its own part of the second form, unless it is frequent
            rare = (frequent.look_up(b.words) == 0) & (b.words != END)
            value = value - np.where(rare, np.log10(count + frequent.least), 0.0)
            each = np.repeat(np.arange(len(b.words)), b.posts)
            some = np.flatnonzero(np.bincount(b.owners))
            sums = [
                np.bincount(b.owners, b.often * x[each])[some]
                for x in (value, np.log10(count + 1.0), (count > 0).astype(float))
            ]
            kinds = (np.uint16, np.float32, np.float64, np.uint32)
            out.append((b.number, *(x.astype(kind).tobytes() for x, kind in zip((some, *sums), kinds, strict=True))))
        names = ["block", "owners", "value", "base", "known"]
        answers = pa.table(dict(zip(names, map(pa.array, zip(*out, strict=True)), strict=True)))
        for name in ("documents", "held_out", "n_tokens"):
            answers = answers.append_column(name, part[name])
        return answers

    return run


def _totals(frequent: Frequent) -> Callable[[pa.Table], pa.Table]:
    """Adds up what the shards say of a block's documents."""

    def run(part: pa.Table) -> pa.Table:
        home = next(i for i in range(part.num_rows) if part["documents"][i].is_valid)
        ids, held_out = part["documents"][home].values, part["held_out"][home].values
        tokens = part["n_tokens"][home].values.to_numpy()

        def joined(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in part[name]])

        owners = joined("owners", np.uint16)
        value, base, known = (
            np.bincount(owners, joined(name, kind), len(ids))
            for name, kind in (("value", np.float32), ("base", np.float64), ("known", np.uint32))
        )
        base -= tokens * np.log10(frequent.tokens + frequent.distinct + 1)
        value -= np.log10(frequent.documents + frequent.least)  # the beginning of each text
        return pa.table(
            {
                "doc_id": ids,
                "held_out": held_out,
                "n_tokens": tokens,
                "n_known": known.astype(np.int64),
                "train_tokens": np.full(len(ids), frequent.tokens),
                "base_score": np.round(base, 6),
                "score": np.round(value, 6),
            }
        )

    return run


def scores(docs: DataFrame, held_out: Column, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``docs`` has doc_id and text; further columns are ignored. The model learns from documents that
    ``held_out`` is false for; the end of a text counts as a token of its own.

    Null, empty or blank text: one token, the end. Null doc_id: ``held_out`` decides by the expression
    given. Repeated rows: each gives a row and counts in training. Without training documents N and V are 0
    and all tokens are unknown. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(size) // shard_bytes))
    frequent = frequent_words(keyed.where(~F.col("held_out")).select("text"), shards)
    shared = spark.sparkContext.broadcast(frequent)
    pairs = keyed.mapInArrow(
        _pairs(shared),
        "shard long, block long, words binary, sizes binary, children binary, posts binary, owners binary, "
        "often binary, documents array<long>, held_out array<boolean>, n_tokens array<long>",
    )
    answers = pairs.groupBy("shard").applyInArrow(
        _answers(shared),
        "block long, owners binary, value binary, base binary, known binary, documents array<long>, "
        "held_out array<boolean>, n_tokens array<long>",
    )
    return answers.groupBy("block").applyInArrow(
        _totals(frequent),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def op6_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return scores(docs, F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(True)))
