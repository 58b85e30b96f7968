"""Count-vector join: its pieces against plain loops, and groups of made documents against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlake.llm import countjoin, rtree


def pairs_of_sets(sets, per_cent):
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= per_cent * (len(a | sets[j])):
                yield j, i


@pytest.mark.parametrize("per_cent", [50, 80, 90])
def test_similar_sets_share_a_slot(per_cent):
    random = np.random.default_rng(per_cent)
    sets = []
    for size in (1, 2, 5, 8, 9, 10, 11, 19, 40, 133, 600):
        for _ in range(6):
            own = set(random.integers(0, 1 << 62, size).tolist())
            sets.append(own)
            for gone, new in ((0, 1), (1, 0), (1, 1), (size // 20, size // 20), (size // 8, 0), (0, size // 7), (size // 3, 0)):
                sets.append(set(sorted(own)[gone:]) | set(random.integers(0, 1 << 62, new).tolist()))
    sets = [s for s in sets if s]
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate([np.array(sorted(s), np.uint64) for s in sets])
    owner, keys = countjoin.slot_keys(elements, np.repeat(np.arange(len(sets)), sizes), sizes, per_cent)
    slots = [set(keys[owner == i].tolist()) for i in range(len(sets))]
    found = [(i, j) for i, j in pairs_of_sets(sets, per_cent) if sets[i] != sets[j]]
    assert len(found) > 100 and all(slots[i] & slots[j] for i, j in found)


def test_no_set_and_no_element():
    owner, keys = countjoin.slot_keys(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(2, np.int64), 90)
    assert not len(owner) and not len(keys)


@pytest.mark.parametrize("n,keys", [(1, 1), (40, 3), (700, 2), (700, 200)])
def test_tree_join_equals_all_comparisons(n, keys, monkeypatch):
    monkeypatch.setattr(rtree, "TOGETHER", 20)
    random = np.random.default_rng(n + keys)
    base = random.integers(0, 12, (max(1, n // 10), 16))
    noise = random.integers(0, 2, (n, 16)) * (random.random((n, 16)) < 0.3)
    counts = (base[random.integers(0, len(base), n)] + noise).astype(np.int32)
    sizes = counts.sum(axis=1).astype(np.int64) + 1
    key, label = random.integers(0, keys, n), random.integers(0, max(1, n // 5), n)
    label[: n // 3] = 0
    asked = np.flatnonzero(label != 0) if n > 1 else np.arange(1)
    trees = [rtree.CountTree(key[x], label[x], sizes[x], counts[x]) for x in (asked, np.arange(n))]
    i, j = rtree.joined(*trees, 90)
    want = set()
    for a in asked:
        shared = np.minimum(counts[a], counts).sum(axis=1)
        near = (key == key[a]) & (label != label[a]) & (190 * shared >= 90 * (sizes + sizes[a]))
        want |= {(a, b) for b in np.flatnonzero(near)}
    assert set(zip(asked[i].tolist(), j.tolist(), strict=True)) == want and len(i) == len(want)
    assert n < 700 or len(want) > (500 if keys < 10 else 5)


def made_documents():
    """Copies, chains whose ends are unlike, a hot passage, short and odd texts."""
    random = np.random.default_rng(9)
    word = lambda: f"w{random.integers(0, 5000)}"
    rows = [(1, None), (None, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c"), (7, "A b\nc")]
    for start in range(100, 2100, 100):
        text = [word() for _ in range(int(random.integers(9, 400)))]
        for k in range(8):
            rows.append((start + k, " ".join(text)))
            for _ in range(int(random.integers(0, 1 + len(text) // 60)) + (k % 2)):
                text[random.integers(0, len(text))] = word()
    passage = [f"p{i}" for i in range(12)]
    for i in range(60):
        rows.append((5000 + i, " ".join([*passage, f"x{i % 40}"])))
    rows.append((None, rows[20][1]))
    rows.append((9000, " ".join(f"long{i % 30000}" for i in range(60_000))))
    return [(*r, "clash", 1) for r in rows]


def plain_components(rows, per_cent=90):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in pairs_of_sets(sets, per_cent):
        parent[root(j)] = root(i)
    members = {}
    for k in range(len(rows)):
        members.setdefault(root(k), []).append(rows[k][0])
    names = {r: min((i for i in own if i is not None), default=None) for r, own in members.items()}
    return [(r[0], len(sets[k]), names[root(k)]) for k, r in enumerate(rows)]


@pytest.mark.parametrize("part_rows,bundle", [(2_000, 8_000), (10, 50)])
def test_groups_equal_all_pairs(spark, part_rows, bundle, monkeypatch):
    for name, value in (("PART_ROWS", part_rows), ("BUNDLE_ROWS", bundle), ("HOT_PAIRS", bundle)):
        monkeypatch.setattr(countjoin, name, value)
    rows = made_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string, n int").repartition(4)
    got = countjoin.similar_groups(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = plain_components(rows)
    assert len({w[2] for w in want}) < len(want) - 50
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_no_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert countjoin.similar_groups(docs.limit(0)).count() == 0
    assert [tuple(r) for r in countjoin.similar_groups(docs).collect()] == [(1, 1, 1)]


def test_candidates_of_a_chain_in_one_slot(spark):
    """All rows of one slot, none of them linked yet: each pair that passes the bound, once."""
    counts = np.eye(30, countjoin.GROUPS, dtype=np.int32) + 9
    rows = [(i, 7, 30, int(counts[i].sum()), counts[i].tobytes()) for i in range(30)]
    rows = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], "cid long, key long, n long").join(
        spark.createDataFrame([(r[0], r[3], bytearray(r[4])) for r in rows], "cid long, n_shingles long, point binary"), "cid"
    )
    none = spark.createDataFrame([], "node long, root long")
    classes = rows.select("cid", "n_shingles", "point")
    got = countjoin.candidates(rows.select("key", "cid", "n"), none, classes, 90).select("u", "v")
    assert {tuple(r) for r in got.collect()} == {(i, j) for i in range(30) for j in range(i + 1, 30)} and got.count() == 435
    same = spark.createDataFrame([(i, 0) for i in range(1, 30)], "node long, root long")
    assert countjoin.candidates(rows.select("key", "cid", "n"), same, classes, 90).where(F.lit(True)).count() == 0
