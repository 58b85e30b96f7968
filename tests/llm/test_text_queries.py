"""Every query of the text operators: against SQL, or against a slow and simple version of the same thing."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from emberlake.llm import catalog, languagemodel

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").sort_index()


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(catalog.SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    want = [dict(zip([c[0] for c in cursor.description], row, strict=True)) for row in cursor.fetchall()]
    got = [r.asDict() for r in catalog.QUERIES[name](spark, SF).collect()]
    assert sorted(got[0]) == columns
    flat = lambda rows: sorted(repr([r[c] for c in columns]) for r in rows)
    assert flat(got) == flat(want)


def test_op1_equals_all_pairs(spark, documents):
    sets = {}
    for i, text in documents.text.items():
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in sets.items():
        shared = Counter(j for x in own for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= 85 * (len(own) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in own:
            holders[x].append(i)
    got = {r.doc_id: tuple(r) for r in catalog.QUERIES["op1_superminhash_dedup"](spark, SF).collect()}
    assert got == {i: (i, len(sets[i]), root(i), root(i) == i) for i in sets}


def test_op2_agrees_with_the_labels_it_never_saw(spark):
    got = catalog.QUERIES["op2_weak_label_quality"](spark, "/root/testdata/sf0.01").toPandas()
    both = got.merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id", suffixes=("_found", ""))
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (both.quality_found[both.quality == 1] == 1).all()
    assert (both.quality_found[both.quality == 0] == 0).mean() > 0.9


def test_op5_equals_the_article_of_the_made_pages(spark):
    from html import unescape

    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")
    for r in catalog.QUERIES["op5_main_text"](spark, SF).collect():
        html = pages.html[r.page_id]
        body = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
        body = re.sub(r"(?i)<(/?(p|h1|br)\b)[^>]*>", " ", body)
        text = " ".join(unescape(re.sub(r"<[^>]*>?", "", body)).split())
        assert (r.url, r.text, r.n_chars) == (pages.url[r.page_id], text, len(text))


def test_op6_equals_counting(spark, documents):
    single, pairs = Counter(), Counter()
    tokens = {i: [*words(t), None] for i, t in documents.text.items()}
    training = [i for i in tokens if remainder(i, 7) != 2]
    for i in training:
        single.update(tokens[i])
        pairs.update(zip([0, *tokens[i]], tokens[i], strict=False))
    n, v = sum(single.values()), len(single)
    assert v < languagemodel.FREQUENT  # so that every known word is a frequent one
    least = min(single.values())
    trust = languagemodel.TRUST
    rows = catalog.QUERIES["op6_trie_lm"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(tokens)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (r.doc_id not in training, len(own), n)
        assert r.n_known == sum(single[w] > 0 for w in own)
        p = [(single[w] + 1) / (n + v + 1) for w in own]
        assert math.isclose(r.base_score, sum(map(math.log10, p)), abs_tol=1e-4)
        score = 0.0
        for before, w, p1 in zip([0, *own], own, p, strict=False):
            if single[before]:
                score += math.log10(trust * pairs[before, w] / single[before] + (1 - trust) * p1)
            else:
                score += math.log10((pairs[before, w] + least * p1) / ((len(training) if before == 0 else 0) + least))
        assert abs(r.score - score) < 0.002 * len(own)


def test_op6_is_better_than_single_words(spark):
    got = catalog.QUERIES["op6_trie_lm"](spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_op7_equals_edited_texts_and_their_word_counts(spark, documents):
    rows = {r.doc_id: r for r in catalog.QUERIES["op7_cws_fingerprint"](spark, SF).collect()}
    ids = list(documents.index)
    weights = lambda text: Counter(words(text))
    errors = []
    for place, i in enumerate(ids):
        text, following = documents.text[i] or "", documents.text[ids[(place + 1) % len(ids)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, r.near_edited), (following, r.near_next)):
            a, b = weights(text), weights(other)
            union = sum((a | b).values())
            errors.append(near - (sum((a & b).values()) / union if union else 1.0))
    assert abs(sum(errors) / len(errors)) < 0.02
    assert sum(e * e for e in errors) / len(errors) < 0.25 / 24
    same = defaultdict(set)
    for i, text in documents.text.items():
        same[text].add(rows[i].fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_op8_finds_held_out_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.QUERIES["op8_ftrl_toxicity"](spark, sf).toPandas()
    assert got.held_out.equals(got.doc_id.map(lambda i: remainder(i, 5) == 0)) and got.score.between(0, 1).all()
    held = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (held.predicted[held.toxic == 1] == 1).mean() > 0.75
    assert (held.predicted[held.toxic == 0] == 0).mean() > 0.99


def test_op9_knows_held_out_languages(spark, documents):
    got = catalog.QUERIES["op9_ecoc_language"](spark, SF).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == documents.lang[held.index]).mean() > 0.95


def test_op10_equals_every_alignment(spark, documents):
    bare = re.compile(rb"^[^0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+$")
    strip = lambda text: [x for x in (bare.sub(b"", w) for w in words(text)) if x]
    items = pd.read_parquet(f"{SF}/benchmark.parquet").set_index("item_id").text.map(strip)
    want = set()
    for i, text in documents.text.items():
        own = strip(text)
        places = defaultdict(list)
        for k, w in enumerate(own):
            places[w].append(k)
        for item, theirs in items.items():
            n = min(13, len(theirs))
            least = 10 if len(theirs) >= 13 else n
            equal = defaultdict(set)
            for k, w in enumerate(theirs):
                for at in places[w]:
                    equal[at - k].add(k)
            if any(sum(k in s for k in range(a, a + n)) >= least for s in equal.values() if len(s) >= least for a in range(len(theirs) - n + 1)):
                want.add((i, item))
    got = {(r.doc_id, r.item_id) for r in catalog.QUERIES["op10_spaced_seed_decontaminate"](spark, SF).collect()}
    assert got == want and got


def test_line_dedup_keeps_columns_of_any_name(spark):
    import corpus_pipeline as pipeline

    rows = [(i, "Menu\nown " + str(i), "s", 9, "mine", "yours", "dot") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, n_lines string, N_Dropped string, `a.b` string")
    got = pipeline.line_dedup(spark, docs, SF)
    assert got.schema == docs.schema
    assert {tuple(r) for r in got.collect()} == {(i, f"own {i}", "s", 5, "mine", "yours", "dot") for i in range(8)}
    few = pipeline.line_dedup(spark, docs.limit(2), SF)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in docs.limit(2).collect()}


def test_pipeline(spark, documents):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.written(stage(spark, docs, SF), name)
        assert docs.columns == columns, name
    left = docs.toPandas()
    final = pipeline.run(spark, SF).toPandas()
    assert set(final.doc_id) <= set(left.doc_id)
    sizes = left.assign(size=left.text.map(lambda t: len(words(t)))).groupby("source")["size"].sum()
    for source, part in final.groupby("source"):
        assert (part["size"] * 3 >= part.taken).all()
        assert part.source_size.iloc[0] == sizes[source] and abs(part.taken.sum() - part.target.iloc[0]) <= 1
