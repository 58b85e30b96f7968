"""Line dedup by site: lines that too large a share of a host's pages carry are boilerplate.

DataFrame operations only. Lines travel as hashes; the texts stay where they were read as long as the list
of boilerplate per host is small enough for Spark to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import others, quoted, table, written

RATIO = 0.05  # a line on at least this share of a host's pages is boilerplate
LEAST_PAGES = 5  # and on so many pages


def _line_key(line: Column) -> Column:
    """Line without white space at its ends, as 128 bits; null for an empty one, which is never boilerplate."""
    trimmed = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed != "", F.unhex(F.md5(trimmed)))


def boilerplate(docs: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, lines) from (host, text): the keys of each host's boilerplate lines.

    Pages of a host and pages with a line both combine in the map tasks. A host's list has at most the
    average number of lines of its pages over ``ratio`` entries.
    """
    pages = docs.groupBy("host").agg(F.count(F.lit(1)).alias("_pages"))
    keys = F.array_distinct(F.transform(F.split("text", "\n"), _line_key))
    counted = (
        docs.select("host", F.explode(keys).alias("_line"))
        .where(F.col("_line").isNotNull())
        .groupBy("host", "_line")
        .agg(F.count(F.lit(1)).alias("_with"))
        .where(F.col("_with") >= least_pages)
    )
    pages = pages.withColumnRenamed("host", "_host")
    common = counted.join(pages, F.expr("host <=> _host")).where(F.col("_with") >= ratio * F.col("_pages"))
    return common.groupBy("host").agg(F.collect_list("_line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, host: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of text, and columns n_lines and n_dropped.

    Lines end at line feeds and are compared without white space at their ends. A line counts once per row.
    Lines that stay keep their white space and order. Rows are neither dropped nor merged: a row of
    boilerplate only keeps an empty text.

    Null text: stays null, 0 lines, and counts as a page of its host. Null host: one host of its own.
    Repeated rows: each is a page. Empty lines are never dropped. An empty table gives an empty result.
    Columns beside text are passed on as they are, but for the two that are added.
    """
    passed = others(docs, "n_lines", "n_dropped")
    packed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in passed]).alias("row"), F.col("text").alias("text"), host.alias("host")
    )
    found = written(boilerplate(packed, ratio, least_pages), "boilerplate").withColumnRenamed("host", "site")
    joined = packed.join(found, F.expr("host <=> site"), "left")
    lines = F.split("text", "\n")
    stays = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("lines"), _line_key(x)), F.lit(False)))
    cut = joined.withColumn("kept", F.when(F.col("lines").isNull(), lines).otherwise(stays))
    every, left = (F.when(F.col("text").isNull(), 0).otherwise(F.size(x)).cast("long") for x in (lines, F.col("kept")))
    cut = cut.withColumn("every", every).withColumn("left", left)
    text = F.when(F.col("left") < F.col("every"), F.array_join("kept", "\n")).otherwise(F.col("text"))
    columns = [text.alias("text") if c == "text" else F.col(f"row.{quoted(c)}") for c in passed]
    return cut.select(*columns, F.col("every").alias("n_lines"), (F.col("every") - F.col("left")).alias("n_dropped"))


def op3_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return drop_boilerplate(docs, F.col("source")).withColumnRenamed("text", "clean_text")


LINES_SQL = """
pieces AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS place
           FROM {docs}),
trimmed AS (SELECT *, regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS bare
            FROM pieces),
pages AS (SELECT source, count(*) AS n FROM {docs} GROUP BY source),
shared AS (SELECT t.source, bare, count(DISTINCT r) AS k FROM trimmed t WHERE bare <> '' GROUP BY t.source, bare),
dropped AS (SELECT s.source, bare FROM shared s JOIN pages p ON s.source IS NOT DISTINCT FROM p.source
            WHERE k >= 5 AND k >= 0.05::DOUBLE * n),
judged AS (SELECT t.*, d.bare IS NOT NULL AS gone FROM trimmed t
           LEFT JOIN dropped d ON t.source IS NOT DISTINCT FROM d.source AND t.bare = d.bare),
rebuilt AS (SELECT r, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS clean_text,
                   count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped
            FROM judged GROUP BY r)
"""

SQL = (
    "WITH numbered AS (SELECT *, row_number() OVER () AS r FROM documents), "
    + LINES_SQL.format(docs="numbered")
    + """SELECT n.doc_id, n.source, CASE WHEN n.text IS NULL THEN NULL ELSE b.clean_text END AS clean_text,
       coalesce(b.n_lines, 0) AS n_lines, coalesce(b.n_dropped, 0) AS n_dropped
FROM numbered n LEFT JOIN rebuilt b USING (r)"""
)
