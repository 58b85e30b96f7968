"""Near-duplicate documents: SuperMinHash bands, exact verification on full shingle sets, connected groups.

Documents with equal shingle sets are one class, found by a fingerprint of the whole set; only classes take
part further on, so a thousand copies cost as much as one. Bands propose, full sets decide.
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
from emberlake.llm.superminhash import band_keys, signatures
from emberlake.llm.words import shingles, split_words

WIDTH = 5  # words of a shingle
SIMILARITY = 85  # per cent
BANDS, ROWS = 32, 6  # a pair at 85 % is missed with probability (1 - 0.85^6)^32 = 3e-7
SKETCH_SHARE = 0.75  # equal places of two signatures from which on a pair is looked at exactly; 4 deviations below 0.85
PART_ROWS = 2_000  # rows of a bucket in one block, about; a group of a comparison holds two blocks


def _sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
    """The sorted shingle set of each text and its 128-bit fingerprint."""
    found, starts = shingles(split_words(texts), WIDTH)
    for i in range(len(starts) - 1):
        one = np.unique(found[starts[i] : starts[i + 1]])
        yield one, hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        n = batch.num_rows
        sets = list(_sets(batch.column("text")))
        sizes = np.array([len(s) for s, _ in sets], np.int64)
        owners = np.repeat(np.arange(n), sizes)
        elements = np.concatenate([s for s, _ in sets]) if n else np.zeros(0, np.uint64)
        signed = signatures(elements, owners, n, BANDS * ROWS)
        bands = band_keys(signed, ROWS)
        sketch = signed.astype(np.uint8)  # the last byte of each place
        some = sizes > 0
        offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(sizes),
                pa.array([k if s else None for (_, k), s in zip(sets, some, strict=True)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[some].ravel())),
                pa.array([x.tobytes() if s else None for x, s in zip(sketch, some, strict=True)], pa.binary()),
            ],
            names=["doc_id", "text_key", "n_shingles", "class", "bands", "sketch"],
        )


def _wanted_sets(wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(has_bit(wanted.value, mixed(ids.view(np.uint64)))))
            sets = [x for x in _sets(batch.column("text")) if len(x[0])]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s, _ in sets])]).astype(np.int32)
            values = np.concatenate([s for s, _ in sets] or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for _, k in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["class", "elements"],
            )

    return run


def _id_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("first_id").fill_null(-1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(mixed(ids.view(np.uint64)).view(np.int64))], names=["bit"])


class _Verifier:
    """Confirms candidate pairs on the full sets of the classes in them."""

    def __init__(self, docs: DataFrame, classes: DataFrame, per_cent: int) -> None:
        self.docs, self.classes, self.per_cent = docs, classes, per_cent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are similar enough. Sets are made again from the texts, for classes in pairs only."""
        spark = pairs.sparkSession
        needed = pairs.select(F.explode(F.array("u", "v")).alias("class")).distinct()
        needed = written(self.classes.select("class", "first_id").join(needed, "class", "left_semi"), "needed")
        bits = membership_bits(needed.mapInArrow(_id_bits, "bit long"), "bit")
        wanted = spark.sparkContext.broadcast(bits)
        sets = self.docs.mapInArrow(_wanted_sets(wanted), "class binary, elements array<long>")
        sets = sets.join(needed, "class", "left_semi").dropDuplicates(["class"])
        sets = written(sets, "sets")
        left = sets.select(F.col("class").alias("u"), F.col("elements").alias("a"))
        right = sets.select(F.col("class").alias("v"), F.col("elements").alias("b"))
        both = pairs.join(right, "v").join(left, "u")
        shared = F.size(F.array_intersect("a", "b"))
        close = 100 * shared >= self.per_cent * (F.size("a") + F.size("b") - shared)
        return both.where(close).select("u", "v")


def _alike(part: pa.Table) -> pa.Table:
    """Pairs of two blocks of a bucket whose signatures agree enough: own rows against all rows of other groups.

    A pair that meets in several buckets is given by that of its first common band only. Whole band keys decide
    which that is: the sketch holds a byte of each place, and six equal bytes are no common bucket.
    """
    n = part.num_rows
    sketch = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint8).reshape(n, BANDS * ROWS)
    group = part["group"].combine_chunks().dictionary_encode().indices.to_numpy()
    is_own = part["own"].to_numpy()
    own, other = np.flatnonzero(is_own), np.flatnonzero(~is_own)
    bands = part["bands"].combine_chunks().flatten().to_numpy().reshape(n, BANDS)
    band, classes = part["band"][0].as_py(), part["class"].to_pylist()
    left, right = [], []
    for i in own:
        near = other[((sketch[other] == sketch[i]).mean(axis=1) >= SKETCH_SHARE) & (group[other] != group[i])]
        first = (bands[near] == bands[i]).argmax(axis=1)
        for j in near[first == band]:
            left.append(min(classes[i], classes[j]))
            right.append(max(classes[i], classes[j]))
    return pa.table({"u": pa.array(left, pa.binary()), "v": pa.array(right, pa.binary())})


def blocks(rows: DataFrame) -> DataFrame:
    """Rows of buckets dealt to (bucket, own_part, part): one block of own rows meets one block of all rows.

    ``rows`` has bucket, band, class, group, bands, sketch, main (the bucket's largest group) and the numbers of
    blocks own_parts and parts. Own are the rows outside the main group; each of them meets every row of its bucket
    once, and no group has more than about two blocks of ``PART_ROWS``, whatever the bucket holds.
    """
    number = lambda parts: F.pmod(F.xxhash64("class"), F.col(parts)).cast("int")
    every = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    place = lambda own, own_part, part: F.struct(own.alias("own"), own_part.alias("own_part"), part.alias("part"))
    as_other = F.transform(every("own_parts"), lambda p: place(F.lit(False), p, number("parts")))
    as_own = F.transform(every("parts"), lambda p: place(F.lit(True), number("own_parts"), p))
    places = F.when(F.col("group") == F.col("main"), as_other).otherwise(F.concat(as_other, as_own))
    return rows.select("bucket", "band", "class", "group", "bands", "sketch", F.inline(places))


def class_links(docs: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """(node, root): groups of classes linked by similarity, found without naming all pairs of a bucket.

    First each bucket's members are compared with its hub, the member that shares buckets with most others:
    the original of a group of copies is close to all of them. What a bucket then still holds of other groups
    than its largest is compared with all the bucket by signature, a block of the ones with a block of the others
    at a time, and pairs whose signatures agree on three quarters of the places are decided on the full sets.
    Pairs inside a group need no look: they cannot change it.
    """
    exploded = classes.select(F.posexplode("bands").alias("band", "bucket"), "class")
    sizes = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = written(exploded.join(sizes, "bucket"), "buckets")
    meets = rows.groupBy("class").agg(F.sum("n").alias("meets"))
    hub = F.max(F.struct("meets", "class"))["class"]
    hubs = written(rows.join(meets, "class").groupBy("bucket").agg(hub.alias("hub")), "hubs")
    pairs = rows.join(hubs, "bucket").where(F.col("class") != F.col("hub"))
    pairs = pairs.select(F.least("class", "hub").alias("u"), F.greatest("class", "hub").alias("v")).distinct()
    pairs = written(pairs, "pairs")
    verifier = _Verifier(docs, classes, per_cent)
    links = written(verifier.links(pairs), "links")
    labels = connected(links)

    named = rows.where("n > 2").join(labels.withColumnRenamed("node", "class"), "class", "left")
    grouped = written(named.select("bucket", "band", "class", F.coalesce("root", "class").alias("group")), "grouped")
    counts = grouped.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "group")).alias("main"))
    block_count = lambda n: F.ceil(n / F.lit(PART_ROWS)).cast("int")
    open_buckets = totals.where("n > main.n").select(
        "bucket",
        F.col("main.group").alias("main"),
        block_count(F.col("n") - F.col("main.n")).alias("own_parts"),
        block_count(F.col("n")).alias("parts"),
    )
    dealt = blocks(grouped.join(open_buckets, "bucket").join(classes.select("class", "bands", "sketch"), "class"))
    rest = dealt.groupBy("bucket", "own_part", "part").applyInArrow(_alike, "u binary, v binary").distinct()
    rest = rest.join(pairs, ["u", "v"], "left_anti")
    more = written(verifier.links(written(rest, "rest")), "links")
    return connected(links.unionByName(more)) if more.head() else labels


def near_duplicates(docs: DataFrame, per_cent: int = SIMILARITY) -> DataFrame:
    """Groups of documents linked by Jaccard similarity of at least ``per_cent`` of their 5-word shingle sets.

    ``docs`` has doc_id (whole number) and text; further columns are ignored. Returns doc_id, n_shingles,
    component_id (the least doc_id reachable over links), kept (doc_id = component_id), text_key (a hash of
    the text, null for null) and stays (whether it is the row that stands for its group), one row per row.

    Null, empty or blank text: an empty set, linked with nothing. Fewer than five words: the whole sequence
    is the one shingle. Repeated rows: each is a document; of equal ids in a group the least text_key stays.
    Null doc_id: ordered last, so it names and stands for a group only where no row has an id. An empty
    table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    marks = docs.mapInArrow(
        _mark, "doc_id long, text_key long, n_shingles long, class binary, bands array<long>, sketch binary"
    )
    marks = written(marks, "marks")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    some = marks.where(F.col("class").isNotNull())
    classes = some.groupBy("class", "bands", "sketch").agg(F.min(row).alias("first"))
    classes = written(classes.withColumn("first_id", F.col("first.doc_id")), "classes")
    labels = class_links(docs.select("doc_id", "text"), classes, per_cent)
    grouped = classes.select("class", "first").join(labels.withColumnRenamed("node", "class"), "class", "left")
    grouped = grouped.select("class", "first", F.coalesce("root", "class").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first").alias("stands"))
    named = written(grouped.join(least, "root").select("class", "stands"), "groups")
    joined = marks.drop("bands", "sketch").join(named, "class", "left")
    alone = F.col("class").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("stands.doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_key",
        (alone | row.eqNullSafe(F.col("stands"))).alias("stays"),
    )


def without_near_duplicates(docs: DataFrame, per_cent: int = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group; of rows alike in doc_id and text one stays."""
    found = near_duplicates(docs, per_cent)
    keys = found.groupBy("doc_id", "text_key").agg(F.min("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    keys = written(keys.where(~F.col("stays") | (F.col("n") > 1)), "doubles")
    d = docs.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64("d.text") == F.col("k.text_key"))
    single = d.join(keys.alias("k"), same, "left_anti")
    repeated = d.join(keys.where("stays").alias("k"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)


def op1_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
