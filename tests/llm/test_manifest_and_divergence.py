"""Merkle manifest and source divergence: odd input against plain versions, and their parts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emberlake.llm import divergence, merkle
from emberlake.llm.quadtree import row_distances

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, GRP string, leaf int, n long"
LONG = "Word and " * 30_000
ROWS = [
    (1, "a", "en", 3, "One"), (1, "a", "en", 3, "One"), (1, "a", "en", 3, "one"), (None, "a", "en", None, None),
    (None, "a", None, 0, ""), (2, None, "en", 5, "Żółw Żółw"), (3, "", "de", 5, "\x00 A"), (4, "b", "de", 9, LONG),
    *[(i, "c", "fr", i, f"Text {i} de la") for i in range(300)],
    *[(1000 + i, f"s{i}", "en", 1, "A the the") for i in range(40)],
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "clash", 7, 9) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """Levels as lists, proofs by walking up from each place."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(leaves):
        found = [leaves]
        while len(found[-1]) > 1:
            found.append([sha("".join(found[-1][k : k + 16])) for k in range(0, len(found[-1]), 16)])
        return found

    def walk(found, place):
        for level in found[:-1]:
            run = place // 16 * 16
            yield "".join(level[run:place]), "".join(level[place + 1 : run + 16])
            place //= 16

    groups = defaultdict(list)
    for i, s, lang, n, text in rows:
        bad = i is not None and zlib.crc32(str(i).encode()) % 5 == 0 and text is not None
        lowered = text and "".join(c.lower() if c.isascii() else c for c in text)
        leaf, now = (sha("".join(map(field, (i, s, lang, n, t)))) for t in (text, lowered if bad else text))
        groups[s].append((i is not None, i or 0, leaf, now))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s])]) for s in order}
    above = levels([trees[s][-1][0] for s in order])
    for at, s in enumerate(order):
        for place, (known, i, leaf, now) in enumerate(sorted(groups[s])):
            proof, folded = "", now
            for left, right in [*walk(trees[s], place), *walk(above, at)]:
                proof, folded = proof + left + right, sha(left + folded + right)
            root = above[-1][0]
            yield (i if known else None, leaf, trees[s][-1][0], root, sha(proof), folded, folded == root)


def query_manifest(docs):
    return merkle.manifest(docs, merkle.remainder(F.col("doc_id"), 5) == 0, F.translate("text", merkle.UPPER, merkle.LOWER))


def test_manifest_of_odd_rows(spark, odd):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = query_manifest(odd)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_manifest(ROWS), key=repr)
    assert query_manifest(odd.limit(0)).count() == 0
    one = query_manifest(odd.where("source = 'b'")).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == sha("")


def test_places_do_not_depend_on_ranges(spark):
    rows = spark.createDataFrame([(g, i // 3) for g in "ab" for i in range(500)], "g string, v long").repartition(7)
    rows = rows.withColumn("nr", F.monotonically_increasing_id())
    got = merkle.placed(rows, "g", ["v", "nr"], range_rows=40).toPandas()
    for _, part in got.groupby("g"):
        assert (part.n == 500).all() and list(part.sort_values("place").v) == [i // 3 for i in range(500)]
        assert sorted(part.place) == list(range(500))


@pytest.mark.parametrize("split", [0, 8])
@pytest.mark.parametrize("density", [0.0, 0.05, 0.6])
def test_quadtree_distances_equal_the_full_matrix(split, density, monkeypatch):
    monkeypatch.setattr("emberlake.llm.quadtree.TOGETHER", 50)
    random = np.random.default_rng(5)
    for n, columns in ((13, 37), (16, 3), (9, 1)):
        held = random.random((n, columns)) < density
        held[:, 0] = held[:, 0] | (density > 0)
        absent = random.integers(1, 100, n)
        full = np.where(held, random.integers(0, 10**12, (n, columns)), absent[:, None])
        rows, places = np.nonzero(held)
        want = np.abs(full[:, None, :] - full[None, :, :]).sum(axis=2)
        got = row_distances(rows, places, full[rows, places], absent, columns, split)
        a, b = np.triu_indices(n, 1)
        if split:
            a, b = a[(a < split) & (b >= split) | (density == 0)], b[(a < split) & (b >= split) | (density == 0)]
        assert (got[a, b] == want[a, b]).all()


def test_terms():
    texts = ["Ab1cd  EF", "", None, "É-éx\x00y", "z", "z"]
    owners, words = divergence.terms(pa.array(texts, pa.string()))
    assert list(zip(owners.tolist(), words.to_pylist(), strict=True)) == [
        (0, "ab"), (0, "cd"), (0, "ef"), (3, "É"), (3, "éx"), (3, "y"), (4, "z"), (5, "z"),
    ]


def plain_divergence(rows, least):
    import re

    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, s, lang, _, text in rows:
        found = [
            "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        ]
        groups.add((lang or "", s or ""))
        counts[lang or "", s or ""].update(found)
        holders[lang or ""].update(set(found))
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= least]
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())

        def prices(c, kept=kept):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // below for t in kept}

        own = {s: prices(counts[lang, s]) for l, s in groups if l == lang}
        q = prices(whole)
        for s, p in own.items():
            pairs = [(-sum(abs(p[t] - o[t]) for t in kept), i) for i, o in own.items() if i != s]
            terms = [(q[t] - p[t], t) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))[:most], 1):
                    yield lang, s, part, item, -value, rank


@pytest.mark.parametrize("least", [2, 10_000])
def test_divergence_of_odd_rows(odd, least, monkeypatch):
    got = divergence.divergence(odd, least, columns=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_divergence(ROWS, least))
    assert divergence.divergence(odd.limit(0)).count() == 0


def test_divergence_of_more_sources_than_a_tile_holds(spark):
    random = np.random.default_rng(1)
    rows = [
        (i, f"s{s:03}", "en", 0, " ".join(random.choice(["aa", "b", "c", "dd", "e", "f"], random.integers(0, 9))))
        for i, s in enumerate(np.repeat(np.arange(290), 2))
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = divergence.divergence(docs, 2, columns=2).collect()
    assert sorted(map(tuple, got)) == sorted(plain_divergence(rows, 2))


def test_price_is_exact(spark):
    counts = [0, 1, 7, 10**13, 10**14]
    rows = spark.createDataFrame([(c, 3 * 10**14 + 1, 10**7) for c in counts], "c long, total long, terms long")
    got = [r[0] for r in rows.select(divergence.price(F.col("c"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (c + 5) // (3 * 10**14 + 1 + 5 * 10**7) for c in counts]
