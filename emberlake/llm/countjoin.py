"""Set similarity join of documents by count vectors: candidates from R-trees, decided on the full sets.

A document is the set of its 3-word shingles; documents with equal sets are one class. A set's point says how many of
its shingles fall into each of ``GROUPS`` groups. R-trees over the points are joined by the bound that the lesser counts
give, and what passes is compared shingle by shingle.

Which points meet in one tree is decided by slots. Two sets of at least the wanted similarity differ in at most ``r``
shingles, ``r`` following from their sizes. Shingles are dealt to more than ``r`` slots by hash, so that one slot at
least holds the same shingles of both. Sets meet under the content of each of their slots. No pair that is similar
enough is lost: slots, bound and comparison are exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import has_bit, membership_bits, mixed, slices, table, written
from emberlake.llm.groups import connected
from emberlake.llm.rtree import CountTree, joined
from emberlake.llm.words import shingles, split_words
from emberlake.operators.skew import salted_join

WIDTH = 3  # words of a shingle
SIMILARITY = 90  # per cent
GROUPS = 64  # coordinates of a point
SPARE = 2  # slots beyond those that are needed: a set with no more empty slots than these does not meet others under them
PART_ROWS = 2_000  # rows of one block of a hot slot, about; a task holds two blocks
BUNDLE_ROWS = 8_000  # rows of slots that share one task, about
HOT_PAIRS = 2_000  # pairs of one set in one task of the comparison


def size_bounds() -> np.ndarray:
    """Least sizes of the bins of sizes, each half as large again as the one before."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return np.array(bounds, np.int64)


BOUNDS = size_bounds()


def slot_count(bin_: np.ndarray, per_cent: int) -> np.ndarray:
    """Slots in which sets of a bin are compared; 0 where only equal sets are similar enough."""
    differ = 2 * (BOUNDS[bin_ + 1] - 1) * (100 - per_cent) // (100 + per_cent)
    return np.where(differ > 0, differ + 1 + SPARE, 0)


def slot_keys(elements: np.ndarray, owners: np.ndarray, sizes: np.ndarray, per_cent: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of the slots under which sets meet.

    ``elements`` are the sets one after another, ``owners`` the set of each. A set takes part in the bin of its own size
    and in each higher bin that holds sizes it may be similar to.
    """
    home = np.searchsorted(BOUNDS, sizes, side="right") - 1
    found_owners, found_keys = [], []
    higher = 0
    while True:
        bin_ = np.maximum(home, 0) + higher
        takes = (sizes > 0) & ((higher == 0) | (100 * sizes >= per_cent * BOUNDS[bin_]))
        if not takes.any():
            break
        slots = np.where(takes, slot_count(bin_, per_cent), 0)
        base = np.concatenate([[0], np.cumsum(slots)])
        inside = slots[owners] > 0
        own, content = owners[inside], mixed(elements[inside])
        # multiply and shift instead of a remainder: the upper half of the hash picks the slot
        at = base[own] + ((content >> np.uint64(32)) * slots[own].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        sums, filled = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
        np.add.at(sums, at, mixed(content + np.uint64(1)))
        filled[at] = True
        owner = np.repeat(np.arange(len(sizes)), slots)
        number = np.arange(base[-1]) - base[owner]
        empties = np.bincount(owner[~filled], minlength=len(sizes))
        meets = filled | (empties[owner] > SPARE)
        label = mixed((bin_[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + np.uint64(1))
        found_owners.append(owner[meets])
        found_keys.append(mixed(sums + label)[meets])
        higher += 1
    return np.concatenate(found_owners or [home[:0]]), np.concatenate(found_keys or [elements[:0]])


def _sets(texts: pa.Array) -> list[np.ndarray]:
    found, starts = shingles(split_words(texts), WIDTH)
    return [np.unique(found[starts[i] : starts[i + 1]]) for i in range(len(starts) - 1)]


def _class(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def _listed(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _marked(per_cent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with their set's size, class, slots and point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = _sets(batch.column("text"))
            n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
            owners, elements = np.repeat(np.arange(n), sizes), np.concatenate(sets)
            owner, keys = slot_keys(elements, owners, sizes, per_cent)
            order = np.argsort(owner, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
            group = (mixed(elements + np.uint64(2)) >> np.uint64(32)) * np.uint64(GROUPS) >> np.uint64(32)
            points = np.bincount(owners * GROUPS + group.astype(np.int64), minlength=n * GROUPS)
            points = points.astype(np.int32).reshape(n, GROUPS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes),
                    pa.array(list(map(_class, sets)), pa.binary()),
                    _listed(ends, keys[order]),
                    pa.array([p.tobytes() for p in points], pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "class", "slots", "point"],
            )

    return run


def _id_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("first_id").fill_null(-1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(mixed(ids.view(np.uint64)).view(np.int64))], names=["bit"])


def _wanted_sets(wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sets of the documents that may stand for a class in a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(has_bit(wanted.value, mixed(ids.view(np.uint64)))))
            sets = [s for s in _sets(batch.column("text")) if len(s)]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            values = np.concatenate([*sets, np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(_class, sets)), pa.binary()), _listed(ends, values)], names=["class", "elements"]
            )

    return run


def similar(docs: DataFrame, classes: DataFrame, pairs: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (u, v) of class numbers whose full sets are similar enough.

    Sets are made again from the texts, for classes in pairs only. The set of ``v`` travels with its pair to that of
    ``u``; where ``u`` has many pairs they are cut into parts and its set is brought to each part once.
    """
    spark = docs.sparkSession
    needed = pairs.select(F.explode(F.array("u", "v")).alias("cid")).distinct()
    needed = written(classes.select("cid", "class", "first_id").join(needed, "cid", "left_semi"), "needed")
    wanted = spark.sparkContext.broadcast(membership_bits(needed.mapInArrow(_id_bits, "bit long"), "bit"))
    sets = docs.mapInArrow(_wanted_sets(wanted), "class binary, elements array<long>")
    sets = sets.join(needed.select("class", "cid"), "class").dropDuplicates(["cid"])
    sets = written(sets.select("cid", "elements"), "sets")
    with_one = salted_join(pairs, sets.select(F.col("cid").alias("v"), F.col("elements").alias("b")), ["v"], hot_rows=HOT_PAIRS)
    both = salted_join(with_one, sets.select(F.col("cid").alias("u"), F.col("elements").alias("a")), ["u"], hot_rows=HOT_PAIRS)
    shared = F.size(F.array_intersect("a", "b"))
    return both.where((100 + per_cent) * shared >= per_cent * (F.size("a") + F.size("b"))).select("u", "v")


def _tree_pairs(per_cent: int) -> Callable[[pa.Table], pa.Table]:
    """Candidates among the rows of one task: those asked for (role 1 and 2) against those indexed (role 0 and 2)."""

    def run(part: pa.Table) -> pa.Table:
        cid, key, label = (part[c].to_numpy() for c in ("cid", "key", "label"))
        size, role = part["n_shingles"].to_numpy(), part["role"].to_numpy()
        points = np.frombuffer(b"".join(part["point"].to_pylist()), np.int32).reshape(-1, GROUPS)
        asked, indexed = np.flatnonzero(role > 0), np.flatnonzero(role != 1)
        trees = [CountTree(key[x], label[x], size[x], points[x]) for x in (asked, indexed) if len(x)]
        if len(trees) < 2:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        i, j = joined(*trees, per_cent)
        one, two = cid[asked[i]], cid[indexed[j]]
        pairs = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)]), axis=1)
        return pa.table({"u": pairs[0], "v": pairs[1]})

    return run


def candidates(rows: DataFrame, labels: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (u, v) of classes of different groups that meet in a slot and that the bound lets pass.

    ``rows`` has key, cid and n, the rows of the key; ``labels`` (node, root) names the groups found so far. Rows outside
    the largest group of their slot are looked up among all rows of the slot. Slots of few rows share a task; a slot of
    more is cut into blocks, and a block of rows looked up meets a block of all rows, two blocks a task whatever the slot
    holds.
    """
    root = F.coalesce("root", "cid").alias("label")
    named = rows.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select("key", "cid", root)
    named = written(named, "named")
    counts = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main"))
    parts = lambda n: F.ceil(n / F.lit(PART_ROWS)).cast("int")
    slots = totals.where("n > main.n").select(
        "key", F.col("main.label").alias("main"), "n",
        parts(F.col("n")).alias("parts"), parts(F.col("n") - F.col("main.n")).alias("own_parts"),
    )
    slots = written(slots, "slots")
    total = slots.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dealt = named.join(slots, "key").join(classes.select("cid", "n_shingles", "point"), "cid")
    outside = F.col("label") != F.col("main")
    # a bundle of small slots, or a hot slot by itself
    bundle = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("key"), F.lit(max(1, total // BUNDLE_ROWS)))).otherwise(F.col("key"))
    number = lambda parts: F.pmod(F.xxhash64("cid"), F.col(parts)).cast("int")
    every = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    place = lambda role, own, part: F.struct(F.lit(role).alias("role"), own.alias("own_part"), part.alias("part"))
    indexed = F.transform(every("own_parts"), lambda p: place(0, p, number("parts")))
    asked = F.transform(every("parts"), lambda p: place(1, number("own_parts"), p))
    zero = F.lit(0)
    places = (
        F.when((F.col("parts") == 1) & outside, F.array(place(2, zero, zero)))
        .when(F.col("parts") == 1, F.array(place(0, zero, zero)))
        .when(outside, F.concat(indexed, asked))
        .otherwise(indexed)
    )
    rows = dealt.select("cid", "key", "label", "n_shingles", "point", "parts", bundle.alias("bundle"), F.inline(places))
    tasks = rows.groupBy(F.col("parts") == 1, "bundle", "own_part", "part")
    return tasks.applyInArrow(_tree_pairs(per_cent), "u long, v long").distinct()


def class_links(docs: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """(node, root): groups of class numbers linked by similarity.

    The members of a slot are first compared with its hub, the one that meets most others: the original of a group of
    copies. R-trees then give the pairs between different groups; pairs inside a group cannot change it.
    """
    exploded = classes.select(F.explode("slots").alias("key"), "cid")
    sizes = exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = written(exploded.join(sizes, "key"), "slots")
    meets = rows.groupBy("cid").agg(F.sum("n").alias("meets"))
    hubs = rows.join(meets, "cid").groupBy("key").agg(F.max(F.struct("meets", "cid"))["cid"].alias("hub"))
    pairs = rows.join(written(hubs, "hubs"), "key").where(F.col("cid") != F.col("hub"))
    pairs = pairs.select(F.least("cid", "hub").alias("u"), F.greatest("cid", "hub").alias("v")).distinct()
    pairs = written(pairs, "pairs")
    links = written(similar(docs, classes, pairs, per_cent), "links")
    labels = connected(links)
    rest = candidates(rows.where("n > 2"), labels, classes, per_cent).join(pairs, ["u", "v"], "left_anti")
    more = written(similar(docs, classes, written(rest, "rest"), per_cent), "links")
    return connected(links.unionByName(more)) if more.head() else labels


def similar_groups(docs: DataFrame, per_cent: int = SIMILARITY) -> DataFrame:
    """Groups of documents linked by Jaccard similarity of at least ``per_cent`` of their 3-word shingle sets.

    ``docs`` has doc_id (whole number) and text; further columns are ignored. Returns doc_id, n_shingles and
    component_id (the least doc_id reachable over links, its own included), one row per row.

    Null, empty or blank text: an empty set, linked with nothing, its own component. Fewer than three words: the whole
    sequence is the one shingle. Very long texts: whole. Repeated rows and rows that share a doc_id: each is a document.
    Null doc_id: after all others, so it names a group only where no row has an id. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    marks = docs.mapInArrow(
        _marked(per_cent),
        "doc_id long, text_key long, n_shingles long, class binary, slots array<long>, point binary",
    )
    marks = written(marks, "marks")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))
    some = marks.where(F.col("class").isNotNull())
    classes = some.groupBy("class", "n_shingles", "slots", "point").agg(F.min(row)["doc_id"].alias("first_id"))
    # a number of eight bytes stands for the class in everything that is shuffled
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    labels = class_links(docs.select("doc_id", "text"), classes, per_cent)
    named = classes.select("class", "cid", "first_id").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.select("class", "first_id", F.coalesce("root", "cid").alias("root"))
    first = F.struct(F.col("first_id").isNull().alias("no_id"), F.col("first_id"))
    least = named.groupBy("root").agg(F.min(first)["first_id"].alias("component"))
    of_class = written(named.join(least, "root").select("class", "component"), "groups")
    found = marks.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))


def op11_count_rtree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


SQL = r"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS own FROM docs),
sizes AS (SELECT doc_id, len(own) AS n FROM sets),
elements AS MATERIALIZED (SELECT doc_id, unnest(own) AS shingle FROM sets),
links AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v
    FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))),
reached AS (SELECT doc_id, doc_id AS other FROM docs
    UNION SELECT r.doc_id, l.v FROM reached r JOIN links l ON l.u = r.other)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(other) AS component_id
FROM sizes s JOIN reached USING (doc_id) GROUP BY ALL
"""
