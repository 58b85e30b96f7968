"""Operators on small made tables: odd rows, copies, ties, clashing columns, and the pieces they are made of."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emberlake.llm import (
    decontaminate,
    fingerprint,
    groups,
    language,
    languagemodel,
    lines,
    maintext,
    mixing,
    neardup,
    quality,
    toxicity,
)
from emberlake.llm.common import has_bit, membership_bits
from emberlake.llm.eliasfano import EliasFano, Trie
from emberlake.llm.superminhash import signatures
from emberlake.llm.words import shingles, split_words

CLASHES = "_key row host lines kept class bands text_key region seed stays root node bucket group n_lines quality_score toxicity lang_pred size taken doc word"
LONG = " ".join(f"word{i % 997}, and{i % 89}" for i in range(40_000))
ROWS = [
    (1, "one two three four five six seven eight", "en", "a"),
    (2, "one two three four five six seven eight", "en", "a"),
    (2, "one two three four five six seven eight", "en", "a"),
    (2, "another text under the same number, quite unlike the first", "en", None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n\x0b\x0c\r ", "en", "b"),
    (None, "one two three four five six seven eight", "de", "b"),
    (None, None, None, None),
    (6, "short", "de", None),
    (7, LONG, "de", "b"),
    (8, LONG, "de", "b"),
    (9, "12 34 !! ??", "en", "c"),
]


def table(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.select("*", *[F.lit(f"x{i}").alias(name) for i, name in enumerate(CLASHES.split())])


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def test_near_duplicates(odd, empty):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    by_id = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert by_id[1, 4] == (1, True) and by_id[2, 4] == (1, False) and by_id[None, 4] == (1, False)
    assert by_id[2, 6] == (2, True) and by_id[3, 0] == (3, True) and by_id[4, 0] == (4, True) and by_id[5, 0] == (5, True)
    assert by_id[None, 0] == (None, True) and by_id[6, 1] == (6, True)
    assert [by_id[i, n][0] for i, n in by_id if i in (7, 8)] == [7, 7]
    kept = neardup.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 5, 6, 7, 9)] + [(True, 0)]
    assert neardup.near_duplicates(empty).count() == 0 and neardup.without_near_duplicates(empty).count() == 0


def test_near_duplicates_in_chains_and_large_groups(spark):
    base = [f"w{i}" for i in range(300)]

    def variant(*swaps):
        own = list(base)
        for s in swaps:
            own[s] = f"x{s}"
        return " ".join(own)

    # each step of the chain is close to the next only; the crowd is far from the least member of its buckets
    chain = [variant(*range(0, 5 * k, 5)) for k in range(1, 12)]
    crowd = [variant(250, 255, 260, 265, 270, 275, 5 + k) for k in range(60)]
    rows = [(i, t) for i, t in enumerate(chain + crowd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{tuple(t.split()[k : k + 5]) for k in range(296)} for _, t in rows]
    parent = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((parent[i], parent[j]))
            parent = [a if p == b else p for p in parent]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == dict(enumerate(parent))


def test_parts_of_a_bucket_give_the_same_groups(spark, monkeypatch):
    random = np.random.default_rng(4)
    texts = []
    for _ in range(60):  # copies of copies, so that many pairs lie on either side of the bound
        own = [f"w{i}" for i in range(150)] if not texts else texts[random.integers(len(texts))].split()
        own = [f"x{random.integers(10**9)}" if random.random() < 0.02 else w for w in own]
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(map(tuple, neardup.near_duplicates(docs).select("doc_id", "component_id").collect()))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(146)} for t in texts]
    parent = list(range(60))
    for i, j in itertools.combinations(range(60), 2):
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((parent[i], parent[j]))
            parent = [a if p == b else p for p in parent]
    assert want == list(enumerate(parent))
    monkeypatch.setattr(neardup, "PART_ROWS", 2)
    assert sorted(map(tuple, neardup.near_duplicates(docs).select("doc_id", "component_id").collect())) == want


def test_a_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    base = [f"w{i}" for i in range(150)]
    crowd = [[*base[:k], f"x{k}", *base[k + 1 :]] for k in range(10, 140)]
    outside = [[*base[:110], *[f"y{k}_{i}" for i in range(40)]] for k in range(12)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(crowd + outside)], "doc_id long, text string")
    want = [(i, 0 if i < len(crowd) else i) for i in range(len(crowd + outside))]
    whole = neardup._alike

    def alike(part):
        assert part.num_rows <= 48, part.num_rows
        return whole(part)

    monkeypatch.setattr(neardup, "_alike", alike)
    monkeypatch.setattr(neardup, "PART_ROWS", 8)
    got = neardup.near_duplicates(docs).select("doc_id", "component_id")
    assert sorted(map(tuple, got.collect())) == want


def test_pair_whose_earlier_band_agrees_in_its_last_bytes_only_is_kept():
    keys = np.arange(2 * neardup.BANDS, dtype=np.int64).reshape(2, neardup.BANDS)
    keys[1, 3] = keys[0, 3]  # the one bucket both are in; all sketches are equal, those of bands 0 to 2 too
    part = pa.table(
        {
            "bucket": [keys[0, 3]] * 2,
            "band": [3, 3],
            "class": pa.array([b"a", b"b"], pa.binary()),
            "group": pa.array([b"a", b"b"], pa.binary()),
            "bands": pa.array(keys.tolist(), pa.list_(pa.int64())),
            "sketch": pa.array([bytes(neardup.BANDS * neardup.ROWS)] * 2, pa.binary()),
            "own": [True, False],
        }
    )
    assert neardup._alike(part).to_pylist() == [{"u": b"a", "v": b"b"}]


def test_superminhash_estimates_with_less_spread_than_independent_hashes():
    random = np.random.default_rng(5)
    shares = []
    for _ in range(150):
        pool = random.integers(0, 2**63, 120).astype(np.uint64)
        table_ = signatures(np.concatenate([pool[:100], pool[20:]]), np.repeat([0, 1], 100), 2, 192)
        shares.append((table_[0] == table_[1]).mean())
    assert abs(np.mean(shares) - 80 / 120) < 0.01 and np.var(shares) < 0.8 * (2 / 3 * 1 / 3) / 192


def test_superminhash_by_the_definition():
    random = np.random.default_rng(6)
    elements = random.integers(0, 2**63, 7).astype(np.uint64)
    from emberlake.llm.common import mixed
    from emberlake.llm.superminhash import STEP

    best = [2**64 - 1] * 16
    for x in elements:
        order, state = list(range(16)), np.array([x])
        for j in range(16):
            state = state + STEP
            draw = int(mixed(state)[0])
            k = j + ((draw & 0xFFFFFFFF) * (16 - j) >> 32)
            order[j], order[k] = order[k], order[j]
            best[order[j]] = min(best[order[j]], j << 48 | draw >> 16)
    assert signatures(elements, np.zeros(7, int), 1, 16)[0].tolist() == best


def test_connected_groups_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    got = groups.connected(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_quality(odd, empty):
    got = quality.scored(odd)
    assert got.columns.count("quality_score") == 1 and got.count() == len(ROWS)
    rows = got.select("doc_id", "text", "quality_score").collect()
    assert {r.quality_score for r in rows if not (r.text or "").strip()} == {0.0}
    assert len({r.quality_score for r in rows if r.text == ROWS[0][1]}) == 1
    kept = quality.without_poor(odd)
    assert kept.columns == odd.columns and kept.count() <= len(ROWS)
    assert quality.scored(empty).count() == 0 and quality.without_poor(empty).columns == empty.columns


def test_label_model_finds_the_poor_heuristic():
    random = np.random.default_rng(2)
    truth = random.random(4000) < 0.7
    accuracy = [0.9, 0.85, 0.8, 0.55, *[0.75] * (len(quality.HEURISTICS) - 4)]
    votes = np.stack([np.where(random.random(4000) < a, truth, ~truth) for a in accuracy], axis=1).astype(int)
    votes[random.random(votes.shape) < 0.3] = quality.NONE
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel(patterns, counts)
    assert np.abs(model.accuracy - np.minimum(accuracy, quality.MOST_ACCURATE)).max() < 0.05


def test_lines(spark, odd, empty):
    texts = [f"Menu\npage {i} says this\n\n  Menu " for i in range(8)] + ["Menu only here\nx", None, "", "Menu"]
    rows = [(i, t, "en", "s" if i != 8 else "t") for i, t in enumerate(texts)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.drop_boilerplate(table(spark, rows), F.col("source")).collect()}
    assert got[0] == ("page 0 says this\n", 4, 2) and got[8] == ("Menu only here\nx", 2, 0)
    assert got[9] == (None, 0, 0) and got[10] == ("", 1, 0) and got[11] == ("", 1, 1)
    assert lines.drop_boilerplate(odd, F.col("source")).count() == len(ROWS)
    assert lines.drop_boilerplate(empty, F.col("source")).count() == 0
    nothing = [(i, "same\nown " + str(i), "en", None) for i in range(6)]
    assert {r.text for r in lines.drop_boilerplate(table(spark, nothing), F.col("source")).collect()} == {f"own {i}" for i in range(6)}


def test_mixing(spark, odd, empty):
    rows = [(i, "w " * (1 + i % 7), None, "abc"[i % 3] if i % 10 else None) for i in range(400)] + [(1, "w w", None, "a")] * 3
    got = mixing.mix(table(spark, rows), range_rows=20, keep=["text", "size", "host"]).toPandas()
    assert len(got) == 403 and (got.taken <= 3 * got["size"]).all() and got.columns.is_unique
    for source, part in got.groupby("source", dropna=False):
        assert part.source_size.iloc[0] == part["size"].sum() and abs(part.taken.sum() - part.target.iloc[0]) < 1 + 1e-6, source
    total = got["size"].sum()
    assert abs(got.groupby("source", dropna=False).target.first().sum() - total) < 1e-6
    tiny = [(1, "w " * 2, None, "a"), (2, "w " * 1000, None, "b"), (3, "w " * 1000, None, "c")]
    capped = {r.source: r.target for r in mixing.mix(table(spark, tiny)).collect()}
    assert capped["a"] == 6.0 and abs(capped["b"] - 2 * (2002 - 6) / 3) < 1e-6
    assert mixing.mix(empty).count() == 0 and mixing.mix(odd).count() == len(ROWS)
    assert {r.taken for r in mixing.mix(table(spark, [(1, None, None, "a"), (2, "", None, None)])).collect()} == {0}


def test_mix_spreads_rows_without_an_id(spark):
    """A third of the rows have no id; reruns over other partitions give the same words to the same texts."""
    rows = [(None if i % 3 else i // 30, f"{'w ' * (1 + i % 5)}{i}", None, "ab"[i % 2]) for i in range(600)]
    one = mixing.mix(table(spark, rows), range_rows=20, keep=["text"]).select("doc_id", "text", "taken")
    other = mixing.mix(table(spark, rows[::-1]).repartition(7), range_rows=20, keep=["text"]).select("doc_id", "text", "taken")
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    taken = [r.taken > 0 for r in one.collect() if r.doc_id is None]
    assert 0 < sum(taken) < len(taken)


PAGES = {
    "": "",
    "just text &amp; more": "just text & more",
    "<p>a<p>b": "a b",
    "<b>x</b>y<br>z &eacute;&#233;&#xe9; &am": "xy z ééé &am",
    "<p>café   x\n\ty</p><script>if (a<b) document.write('<p>no</p>')</script><style>p{}</style>": "café x y",
    "<!-- <p>no</p> --><p>yes": "yes",
    "<p>cut <a href='x": "cut",
    """<body class="has-sidebar"><div id="header"><a href=1>Home</a></div><div class="sidebar"><li><a>x</a></div>
    <div id="content"><h2>T</h2><p>First, long paragraph with, commas.</p><p>Second.</p><div class="ad-box ad">Buy, now, buy, now, please, buy</div></div>
    <div class="comments"><p>I, as a reader, think, that, this, is, good, and, very, long.</p></div></body>""": "T First, long paragraph with, commas. Second.",
    """<nav><p>Menu, with, many, commas, here</p></nav><main><article><header><h1>T</h1></header><section><p>One, two.</p></section>
    <section><p>Three.</p></section><aside>no</aside><form>no</form></article><section class="comments"><article class="comment"><p>c, c, c, c</p>
    </article></section></main><footer>no</footer>""": "T One, two. Three.",
    "<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article><div class=promo><p>" + "x, " * 400 + "</p></div>": "a b c d",
    "<div hidden><p>" + "no, " * 50 + "</p></div><div><p>shown</p></div>": "shown",
}


def test_main_text(spark):
    assert {h: maintext.main_text(h) for h in PAGES} == PAGES
    assert maintext.main_text("<div>" * 30_000 + "deep" + "</div>" * 30_000) == "deep"
    assert maintext.main_text("<p " * 20_000) == "" and len(maintext.main_text("<p>a</p>" * 20_000)) == 39_999
    rows = [(1, "u", None), (None, None, ""), (2, "v", "<p>x</p>"), (2, "v", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(map(tuple, maintext.extracted(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (None, None, "", 0), (2, "v", "x", 1), (2, "v", "x", 1)], key=repr)
    assert maintext.extracted(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<i>" * 90_000 + "<li>" * 90_000, "<i>" * 90_000 + "</b>" * 90_000, "<div><b>" * 60_000 + "</a>x" * 60_000, "<td><p>" * 90_000])
def test_hostile_markup_is_read_in_linear_time(page):
    """Pages of two thirds of a megabyte on which walking the open elements for each tag would take hours."""
    import time

    assert len(page) > 600_000
    start = time.perf_counter()
    maintext.main_text(page)
    assert time.perf_counter() - start < 20


def test_end_tags_and_implied_ends():
    def shape(node):
        return node.tag, [x if isinstance(x, str) else shape(x) for x in node.items]

    cases = {
        "<ul><li>a<li>b<ul><li>c</ul></ul>d": [("ul", [("li", ["a"]), ("li", ["b", ("ul", [("li", ["c"])])])]), "d"],
        "<p>a<div>b</p>c</div>d": [("p", ["a"]), ("div", ["b", "c"]), "d"],
        "<b><div>x</b>y</div>z": [("b", [("div", ["x", "y"]), "z"])],
        "<table><tr><td>a<td>b<tr><td>c</table>": [("table", [("tr", [("td", ["a"]), ("td", ["b"])]), ("tr", [("td", ["c"])])])],
        "<dl><dt>a<dd>b<dt>c</dl>": [("dl", [("dt", ["a"]), ("dd", ["b"]), ("dt", ["c"])])],
        "<p><button><p>a</button>b": [("p", [("button", [("p", ["a", "b"])])])],
        "</b></div>a<br>b<img/>c": ["a", ("br", []), "b", ("img", []), "c"],
    }
    assert {html: shape(maintext.parse(html))[1] for html in cases} == cases


def test_elias_fano_and_trie():
    random = np.random.default_rng(3)
    for n, top in ((1, 3), (5, 100), (2000, 2**64 - 1), (2000, 2500), (700, 2**33)):
        values = np.sort(random.integers(0, top, n, dtype=np.uint64))
        form = EliasFano.view(EliasFano.encode(values))
        asked = np.concatenate([values, values + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        assert (form.get(np.arange(n)) == values).all() and (form.successor(asked) == np.searchsorted(values, asked)).all()
    words = np.unique(random.integers(0, 2**64 - 1, 300, dtype=np.uint64))
    sizes = random.integers(1, 9, len(words))
    children = np.concatenate([np.sort(random.choice(2**20, s, replace=False)) for s in sizes]).astype(np.uint64)
    values = -random.random(len(children)) * 6
    trie = Trie(Trie.build(words, sizes, sizes, children, values))
    above = np.repeat(np.arange(len(words)), sizes)
    assert (trie.find(words) == np.arange(len(words))).all() and (trie.find(words + np.uint64(1)) == -1).all()
    assert np.abs(trie.value(above, children) - values).max() < 6 / 8000
    pairs = set(zip(above.tolist(), children.tolist(), strict=True))
    other = (children + np.uint64(1)).tolist()
    missing = np.array([(a, c) not in pairs for a, c in zip(above.tolist(), other, strict=True)])
    assert (np.isnan(trie.value(above, np.array(other, np.uint64))) == missing).all()
    assert np.isnan(trie.value(np.full(3, -1), children[:3])).all()


def test_language_model(odd, empty, monkeypatch):
    held = F.coalesce(F.col("doc_id") == 1, F.lit(True))
    one = languagemodel.scores(odd, held).toPandas()
    many = languagemodel.scores(odd, held, shard_bytes=20_000).toPandas()
    order = ["doc_id", "held_out", "n_tokens", "score"]
    assert len(one) == len(ROWS) and np.allclose(*(x.sort_values(order)[["n_tokens", "n_known", "train_tokens", "base_score"]] for x in (one, many)))
    assert np.allclose(one.sort_values(order).score, many.sort_values(order).score, rtol=0.01)
    assert (one[one.doc_id.isin([3, 4, 5])].n_tokens == 1).all() and (one.score <= 0).all()
    assert languagemodel.scores(empty, held).count() == 0
    none = languagemodel.scores(odd, F.lit(True)).toPandas()
    assert (none.train_tokens == 0).all() and (none.n_known == 0).all() and np.isfinite(none.score).all()


def test_language_model_probabilities_add_up_after_rare_and_frequent_words():
    frequent = languagemodel.Frequent(np.array([7], np.uint64), np.array([50]), 100, 11, 9, 1)
    counts = np.array([50, *[5] * 10, 0])  # the last is the unknown word
    after_frequent = np.array([20, 30, *[0] * 10])
    after_rare = np.array([2, 0, 3, *[0] * 9])
    p = 10 ** languagemodel._pair_values(frequent, after_frequent, counts, np.full(12, 50))
    q = 10 ** languagemodel._pair_values(frequent, after_rare, counts, np.zeros(12)) / (5 + frequent.least)
    assert abs(p.sum() - 1) < 1e-9 and abs(q.sum() - 1) < 1e-9


def test_fingerprints(odd, empty):
    rows = fingerprint.edited_fingerprints(odd).collect()
    assert len(rows) == len(ROWS) - 1  # of the two rows alike in all, one
    prints = {(r.doc_id, r.n_chars): r.fingerprint for r in rows}
    assert prints[1, 39] == prints[2, 39] == prints[None, 39] and prints[7, len(LONG)] == prints[8, len(LONG)]
    assert prints[3, 0] == prints[4, 0] == prints[5, 7] == "0" * 8 * fingerprint.SAMPLES
    assert {r.near_edited for r in rows if r.n_chars == 0} == {1.0}
    assert fingerprint.edited_fingerprints(empty).count() == 0
    alone = fingerprint.edited_fingerprints(odd.where("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_fingerprints_of_repeated_rows(odd):
    rows = fingerprint.fingerprints_of_rows(odd).collect()
    assert len(rows) == len(ROWS) and len({tuple(r) for r in rows}) == len(ROWS) - 1


def test_likeness_of_pairs_at_seven_tenths(spark):
    pairs = 60
    words = [(2 * p + side, p * 1000 + w) for p in range(pairs) for side in (0, 1) for w in range(30 * side, 30 * side + 170)]
    words = spark.createDataFrame(words, "key long, word long").withColumn("word", F.xxhash64("word"))
    prints = fingerprint.samples(words, ["key"])
    even = prints.where("key % 2 = 0").select((F.col("key") + 1).alias("key"), F.col("fingerprint").alias("other"))
    near = prints.join(even, "key").select(fingerprint.likeness(F.col("fingerprint"), F.col("other")).alias("near"))
    errors = [r.near - 0.7 for r in near.collect()]
    assert len(errors) == pairs and sum(e * e for e in errors) / pairs < 0.004


def test_next_rows_across_ranges(spark):
    ids = spark.range(0, 500, 3).select(F.col("id").cast("string").alias("key"), "id")
    got = {int(r.key): int(r.next) for r in fingerprint.following(ids, ["id"], range_rows=20).collect()}
    want = list(range(0, 500, 3))
    assert got == dict(zip(want, [*want[1:], 0], strict=True))


def test_first_row_of_a_range_ends_the_one_before(spark):
    ids = spark.range(100).select(F.col("id").alias("key"), "id")
    got = fingerprint.following(ids, ["id"], range_rows=20).collect()
    parts = {r.key: r.part for r in got}
    firsts = {r.key: r.before for r in got if r.before is not None}
    assert len(firsts) == len(set(parts.values())) > 2
    assert all(before == parts[(key - 1) % 100] for key, before in firsts.items())


def test_fingerprints_across_ranges(spark, monkeypatch):
    """Rows of many ranges: the likeness to the next row is that of its own fingerprint, and texts are cut once."""
    docs = spark.range(60).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 20 + int(id % 3)), i -> concat('w', i * (id % 5)))) AS text")
    monkeypatch.setattr(fingerprint.following, "__defaults__", (7,))
    found = fingerprint.edited_fingerprints(docs).orderBy("doc_id").collect()
    cut = lambda text: [text[i : i + 8] for i in range(0, len(text), 8)]
    for row, after in zip(found, [*found[1:], found[0]], strict=True):
        same = [a == b for a, b in zip(cut(row.fingerprint), cut(after.fingerprint), strict=True)]
        assert row.near_next == sum(same) / len(same)


def test_toxicity(spark, odd, empty):
    rows = [(i, f"{'vile ' * (i % 2)}plain words number n{i} end", None, None) for i in range(200)]
    docs = table(spark, rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    model = toxicity.train(docs, labels, "toxic")
    got = {r.text: r.toxicity for r in toxicity.scored(docs, model).collect()}
    assert all((score >= 0.5) == text.startswith("vile") for text, score in got.items())
    scored = toxicity.scored(odd, model)
    assert scored.columns.count("toxicity") == 1 and scored.count() == len(ROWS) and toxicity.scored(empty, model).count() == 0
    blank = {r.toxicity for r in scored.collect() if not (r.text or "").strip()}
    assert len(blank) == 1
    untrained = toxicity.train(docs, labels.limit(0), "toxic")
    assert {r.toxicity for r in toxicity.scored(odd, untrained).collect()} == {0.5}
    twice = spark.createDataFrame([(i, t) for i in range(200) for t in (0, i % 2, None)] + [(None, 1), (999, 1)], "doc_id long, toxic int")
    again = toxicity.train(docs.unionByName(docs), twice, "toxic")
    assert (again[0] == model[0]).all() and np.allclose(again[1], model[1])


def test_toxic_word_of_few_documents_is_learned():
    texts = [f"plain words here n{i % 50}" + (" vilest" if i % 600 == 0 else "") for i in range(3000)]
    sample = pa.table({"label": [int(t.endswith("vilest")) for t in texts], "text": texts})
    names, weights = toxicity._fit(sample)
    word = toxicity.features(split_words(pa.array(["vilest"]), bare=True))[1][0]
    assert weights[names == word].tolist() > [0.0]


def test_language(spark, odd, empty):
    rows = [(i, t * 3, lang, None) for i in range(30) for lang, t in (("en", f"the house is here {i} "), ("de", f"das haus ist hier {i} "))]
    model = language.train(table(spark, rows))
    got = language.identified(odd, model).collect()
    assert len(got) == len(ROWS)
    assert {r.lang_pred for r in got if r.text is None or not any(c.isalpha() for c in r.text)} == {"und"}
    asked = spark.createDataFrame([("The house",), ("das Haus",), ("Ж",), ("…",)], "text string")
    assert [r.lang_pred for r in language.identified(asked, model).collect()][:2] == ["en", "de"]
    assert [r.lang_pred == "und" for r in language.identified(asked, model).collect()] == [False, False, False, True]
    assert language.identified(empty, model).count() == 0
    one = language.train(table(spark, rows).where("lang = 'en'"))
    assert {r.lang_pred for r in language.identified(odd, one).collect()} == {"en", "und"}
    assert {r.lang_pred for r in language.identified(odd, language.train(empty)).collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 40])
def test_codewords_differ(n):
    codes = language.codewords(n)
    apart = [int((a != b).sum()) for a, b in itertools.combinations(codes, 2)]
    assert min(apart) >= max(1, 2 ** (n - 2) if n <= 6 else codes.shape[1] // 4)


def test_masks_miss_no_window_with_three_differences():
    for wrong in itertools.combinations(range(13), 3):
        assert any(
            not set(wrong) & {start + o for o in mask} for mask in decontaminate.MASKS for start in range(13 - mask[-1])
        ), wrong


def test_decontamination(spark, odd, empty):
    item = [f"item{i}" for i in range(40)]
    benchmark = [
        (1, " ".join(item)), (2, " ".join(item).upper()), (3, None), (4, ""), (5, "just four words here"),
        (6, "exactly seven words are in this item"), (7, "an item of nine words that is here whole"), (None, "no number but enough words to search for it"),
    ]
    swapped = [w if i % 5 else "other" for i, w in enumerate(item)]
    heavy = [w if i % 3 else "other" for i, w in enumerate(item)]
    texts = {
        1: "before " + " ".join(item) + " after",
        2: "x " * 50 + " ".join(swapped[3:30]),
        3: " ".join(heavy),
        4: "we say (Exactly seven words, are in this ITEM!) so",
        5: "exactly seven words are in that item",
        6: " ".join(item[5:18]),
        7: " ".join(item[5:14]),
        8: "just four words here",
        9: None,
        10: "",
        11: (" ".join(item) + " ") * 200,
        12: "oh an item of nine words that is here whole",
        13: "an item of nine words that was here whole",
        14: "no number but enough words to search for it",
    }
    docs = table(spark, [(i, t, None, None) for i, t in texts.items()])
    bench = spark.createDataFrame(benchmark, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = {(r.doc_id, r.item_id): r.overlap for r in decontaminate.overlaps(docs, bench).collect()}
    assert found == {(1, 1): 40, (2, 1): 22, (4, 6): 7, (6, 1): 13, (11, 1): 40, (12, 7): 9, (14, None): 9}
    left = decontaminate.without_benchmark(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {3, 5, 7, 8, 9, 10, 13}
    assert decontaminate.overlaps(odd, bench).count() == 0 and decontaminate.overlaps(empty, bench).count() == 0
    assert decontaminate.without_benchmark(odd, bench.limit(0)).count() == len(ROWS)


def test_words_and_shingles():
    got = split_words(pa.array(["  A b C d e F  g", "x", None, "", "a b\tc d e\x0bf g", "É é"]))
    assert got.counts.tolist() == [7, 1, 0, 0, 7, 2] and (got.hashes[:7] == got.hashes[8:15]).all() and got.hashes[15] != got.hashes[16]
    found, starts = shingles(got)
    assert np.diff(starts).tolist() == [3, 1, 0, 0, 3, 1] and (found[:3] == found[4:7]).all()
    many = [f"w{i}" for i in range(200_000)]
    assert len(np.unique(split_words(pa.array([" ".join(many)])).hashes)) == len(many)
    bare = split_words(pa.array(["(Hello), *** wörld!"]), bare=True)
    assert bare.counts.tolist() == [2] and bare.hashes[0] == split_words(pa.array(["hello"])).hashes[0]
    sliced = pa.array(["q", "a b", "c"]).slice(1)
    assert split_words(sliced).counts.tolist() == [2, 1]


def test_membership_bits(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, -1, 2**62, None)], "h long")
    bits = membership_bits(df, "h")
    asked = np.array([0, 1, 2, -1, 2**62], np.int64).view(np.uint64)
    assert has_bit(bits, asked).tolist() == [True, True, False, True, True]
