"""How far the sources of a language lie apart in their words.

Words are counted per language, source and word. A language's sources and words are a sparse matrix, cut into blocks
of columns (a hash of the word) and, where a language has many sources, into tiles of rows. One task holds the cells of
one block in one pair of tiles as a K-squared tree and gives the distance of each pair of rows over the block; distances
add up over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlake.llm.common import slices, table, written
from emberlake.llm.quadtree import row_distances
from emberlake.llm.words import LOWER, text_bytes

LEAST_DOCUMENTS = 30  # of its language that must hold a word
SCALE = 1_000_000_000  # a probability of 1
SMOOTHING = 5  # added to each count
MOST_TERMS = 50  # ranks reported per group
COLUMNS = 4096  # words of a block, about
TILE = 128  # sources of a tile; a power of two
LETTER = np.zeros(256, bool)  # what words are made of: ASCII letters and all bytes of other characters
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The words of some texts in order, A-Z read as a-z: the text of each, and the words as a dictionary array."""
    data, offsets = text_bytes(texts)
    letter = LETTER[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = letter[offsets[:-1][offsets[:-1] < len(data)]]
    starts = np.flatnonzero(begins)
    places = np.concatenate([np.cumsum(letter)[starts] - 1, [letter.sum()]]).astype(np.int32)
    content = LOWER[data[letter]]
    found = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(content)])
    return np.searchsorted(offsets, starts, side="right") - 1, found.dictionary_encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        owners, words = terms(batch.column("text"))
        n_words = max(1, len(words.dictionary))
        groups = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
        lang, source = (g.indices.to_numpy(zero_copy_only=False).astype(np.int64) for g in groups)
        n_sources = len(groups[1].dictionary)
        held, counts = np.unique(owners * n_words + words.indices.to_numpy(), return_counts=True)
        cells, cell = np.unique((lang * n_sources + source)[held // n_words] * n_words + held % n_words, return_inverse=True)
        occurrences = np.zeros(len(cells), np.int64)
        np.add.at(occurrences, cell, counts)
        group = cells // n_words
        yield pa.RecordBatch.from_arrays(
            [
                groups[0].dictionary.take(pa.array(group // n_sources)),
                groups[1].dictionary.take(pa.array(group % n_sources)),
                words.dictionary.take(pa.array(cells % n_words)),
                pa.array(np.bincount(cell, minlength=len(cells)).astype(np.int64)),
                pa.array(occurrences),
            ],
            names=["lang", "source", "term", "docs", "n"],
        )


def price(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed probability of a word as a whole number; null for a language without words. Exact for any counts."""
    exact = lambda c: c.cast("decimal(18,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * (exact(count) + F.lit(SMOOTHING))
    below = exact(total) + F.lit(SMOOTHING) * exact(terms)
    # % before / keeps the quotient whole, so that nothing is rounded
    whole = ((above - above % F.nullif(below, F.lit(0).cast("decimal(18,0)"))) / below).cast("long")
    return 1 + whole


def _block_distances(part: pa.Table) -> pa.Table:
    """Distances of the rows of one block in one pair of tiles. Rows without a word tell a source's number and absent value."""
    number, lang = part["number"].to_numpy(), part["lang"][0].as_py()
    low, high = part["low"][0].as_py(), part["high"][0].as_py()
    # the lower tile's rows come first, the higher one's from TILE on
    local = number - np.where(number // TILE == low, low * TILE, high * TILE - TILE)
    listed = part["term"].is_null().to_numpy()
    # in a pair of tiles a gap may stand between the two
    n = int(local.max()) + 1
    absent, numbers = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    value = part["value"].to_numpy()
    absent[local[listed]], numbers[local[listed]] = value[listed], number[listed]
    words = part["term"].combine_chunks().filter(pa.array(~listed)).dictionary_encode()
    column, n_columns = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(words.dictionary)
    # frequent words first, so that zero cells lie together
    spread = np.bincount(column, minlength=n_columns)
    place = np.empty(n_columns, np.int64)
    place[np.argsort(-spread, kind="stable")] = np.arange(n_columns)
    apart = row_distances(local[~listed], place[column], value[~listed], absent, n_columns, 0 if low == high else TILE)
    a, b = np.triu_indices(n, 1)
    real = (numbers[a] >= 0) & (numbers[b] >= 0)
    if low != high:
        real &= (a < TILE) & (b >= TILE)
    a, b = a[real], b[real]
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": numbers[a],
            "b": numbers[b],
            "apart": apart[a, b],
            "columns": np.full(len(a), n_columns, np.int64),
        }
    )


def pair_distances(groups: DataFrame, cells: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """(lang, a, b, apart) for each pair a < b of a language's sources.

    ``groups`` has lang, number (of the source in its language, from 0), sources, terms and absent (the value of a word
    that the source doesn't have); ``cells`` has lang, number, sources, terms, term and value. A task holds at most about
    ``columns`` words of two tiles, however many words, sources or documents a language has. A block is hashed by word, so
    a frequent word, which is one row per source here, weighs no more than a rare one.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / F.lit(columns))).cast("int")
    heads = groups.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    heads = heads.select("lang", "number", "sources", "block", F.lit(None).cast("string").alias("term"), F.col("absent").alias("value"))
    block = F.pmod(F.xxhash64("term"), blocks).cast("int")
    rows = heads.unionByName(cells.select("lang", "number", "sources", block.alias("block"), "term", "value"))
    tile, last = F.expr(f"cast(number div {TILE} as int)"), F.expr(f"cast((sources - 1) div {TILE} as int)")
    other = F.explode(F.sequence(F.lit(0), last))
    rows = rows.select("*", tile.alias("tile"), other.alias("other"))
    rows = rows.select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "number", "term", "value"
    )
    parts = rows.groupBy("lang", "block", "low", "high").applyInArrow(
        _block_distances, "lang string, a long, b long, apart long, columns long"
    )
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("apart").alias("apart"), F.sum("columns").alias("columns"))
    side = lambda name: groups.select("lang", F.col("number").alias(name), F.col("absent").alias(f"{name}_absent"), "terms")
    both = sums.join(side("a"), ["lang", "a"]).join(side("b").drop("terms"), ["lang", "b"])
    # words that neither of two tiles has in a block are in no tree: a zero quadrant like the others
    unseen = (F.col("terms") - F.col("columns")) * F.abs(F.col("a_absent") - F.col("b_absent"))
    return both.select("lang", "a", "b", (F.col("apart") + unseen).cast("long").alias("apart"))


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, columns: int = COLUMNS) -> DataFrame:
    """Distances of the sources of each language, and the words that a source has more often than its language.

    ``docs`` has text, lang and source; further columns are ignored. Returns lang, source, part, item, value and rank:
    part ``pair`` has one row per other source of the language, part ``term`` a source's ``MOST_TERMS`` words with the
    largest excess. A word takes part if ``least_documents`` documents of its language hold it.

    Null text, lang or source: as empty. Empty texts and texts without words count for no word, but their source is
    there, with all counts 0. Very long texts are counted whole. Repeated rows: each is a document. Ties: by the item's
    bytes. A language without words that take part: its pairs are 0 apart, no terms. An empty table gives an empty result.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    docs = docs.select(blank("lang"), blank("source"), blank("text"))
    found = docs.mapInArrow(_counted, "lang string, source string, term string, docs long, n long")
    sums = found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    counts = written(sums, "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = written(kept.where(F.col("docs") >= least_documents).drop("docs"), "kept")
    cells = written(counts.drop("docs").join(kept, ["lang", "term"]), "cells")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["terms", "total", "lang_total"])
    by_lang = Window.partitionBy("lang")
    groups = groups.withColumns(
        {
            "number": F.row_number().over(by_lang.orderBy("source")).cast("long") - 1,
            "sources": F.count(F.lit(1)).over(by_lang),
            "absent": F.coalesce(price(F.lit(0), F.col("total"), F.col("terms")), F.lit(0)).cast("long"),
        }
    )
    groups = written(groups, "groups")
    priced = cells.join(groups, ["lang", "source"])
    priced = priced.withColumn("value", price(F.col("n"), F.col("total"), F.col("terms")))
    apart = written(pair_distances(groups, priced, columns), "apart")
    names = groups.select("lang", "number", "source")
    both = apart.unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    pairs = both.join(names.withColumnRenamed("number", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    )
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.col("apart").alias("value"))
    excess = F.col("value") - price(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    more = priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked(pairs).unionByName(ranked(more.where("value > 0")).where(F.col("rank") <= MOST_TERMS))


def op13_quadtree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents", "text", "lang", "source"))


_PRICE = "1 + {scale} * ({n} + 5) // nullif({total} + 5 * v, 0)"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
found AS (SELECT nr, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS m FROM found GROUP BY lang, term HAVING count(DISTINCT nr) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(m) AS m FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (SELECT d.lang, d.source, coalesce(total, 0) AS total, v, langs.m AS lang_total
    FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN totals USING (lang, source) LEFT JOIN langs USING (lang)),
matrix AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    {_PRICE.format(scale=f"{SCALE}::HUGEINT", n="coalesce(c.n, 0)", total="g.total")} AS p,
    {_PRICE.format(scale=f"{SCALE}::HUGEINT", n="k.m", total="lang_total")} AS q
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM matrix a JOIN matrix b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
more AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM matrix WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {MOST_TERMS}
"""
