"""Mixing sources to target weights: hash order, prefix sums by key range, exact cut.

Everything is DataFrame operations. Sums per source and key range combine before the shuffle; the prefix
over ranges is a window over a few rows per source; only the rows of one range, never of a source, meet in
one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlake.llm.common import WORD, quoted, table, written

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in code-point order, null last, repeating
MOST_EPOCHS = 3.0  # a source gives at most so many times its own size
RANGE_ROWS = 4_000  # documents of one key range, about: what one window holds


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Target of each source from (source, source_size).

    All sizes are shared by weight; a target stops at ``most`` times its source's size and the excess is
    shared again. That is one level ``t`` with target = least(most * size, t * weight): sources are taken in
    the order of the level at which they stop, and the level is what remains over the weights that remain.
    One row per source; the two windows hold the list of sources and nothing else.
    """
    places = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.pmod(F.row_number().over(places) - 1, F.lit(len(weights)))
    ranked = totals.withColumn("weight", F.get(cycle, place)).withColumn("cap", most * F.col("source_size"))
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level)
    reached = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(reached, F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    chosen = levels.withColumn("chosen", first["level"])
    share = F.col("chosen") * F.col("weight")
    target = F.when(share < F.col("cap"), share).otherwise(F.col("cap")).cast("double")
    return chosen.select(F.col("source"), F.col("source_size"), target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST_EPOCHS,
    range_rows: int = RANGE_ROWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """How many words of each document a mix by source weights takes.

    ``docs`` has doc_id, text and source; further columns are ignored unless named in ``keep``. Returns
    doc_id, source, size, source_size, target, taken and the kept columns of other names, one row per input row.

    Documents of a source stand in the order of md5(doc_id), then size, then md5(text). Whole epochs are taken from all of
    them; the rest of the target goes to the first ones, and the document at the cut gives the part that is
    missing. Word counts taken from a source add up to its target, rounded down.

    Null text: size 0, taken 0. Null source: a source of its own, after all others. Null doc_id: the
    text's digest takes its place, so that rows without an id are spread like others. Repeated rows: each counts; rows
    alike in id and size are told apart by their text, and rows alike in all of them are interchangeable. An empty table gives an empty result.
    """
    tie = F.md5(F.coalesce(F.col("text"), F.lit("")))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("x"), tie)))
    sized = docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), key.alias("_key"), tie.alias("_tie"),
        F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)) for c in keep]).alias("_kept"),
    )
    if not keep:  # three narrow columns are cheaper to write than to compute again
        sized = written(sized, "sizes")
    prefix = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    n_rows = F.ceil(F.col("_rows") / F.lit(range_rows))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    targets = source_targets(per_source.select("source", "source_size"), weights, most)
    plan = (
        targets.alias("t")
        .join(per_source.alias("s"), F.expr("t.source <=> s.source"))
        .select("t.source", "t.source_size", "t.target", n_rows.cast("long").alias("_ranges"))
    )
    plan = plan.select(F.col("source").alias("_source"), "source_size", "target", "_ranges")
    placed = sized.join(plan, F.expr("source <=> _source")).drop("_source")
    placed = placed.withColumn("_range", F.floor(prefix * F.col("_ranges") / F.lit(float(1 << 32))).cast("long"))
    sums = placed.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"),
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy("source", "_range").orderBy("_key", "size", "_tie")
    running = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    joined = placed.withColumn("_running", running).join(
        starts, F.expr("source <=> _source and _range = _r")
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target")).cast("long") - epochs * F.col("source_size")
    extra = F.least(F.greatest(rest - F.col("_start") - F.col("_running"), F.lit(0)), F.col("size"))
    own = ["doc_id", "source", "size", "source_size", "target"]
    taken = (epochs * F.col("size") + extra).cast("long").alias("taken")
    return joined.select(*own, taken, *[F.col(f"_kept.{quoted(c)}") for c in keep if c not in (*own, "taken")])


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


MIX_SQL = """
sized AS (SELECT {columns}, len(regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                 md5(coalesce({text}, '')) AS tie,
                 md5(coalesce(CAST(doc_id AS VARCHAR), 'x' || md5(coalesce({text}, '')))) AS key
          FROM {docs}),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                  (ARRAY[5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
           FROM sized GROUP BY source),
levels AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER w, 0))
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
           FROM totals
           WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * (
                SELECT arg_min(level, 3.0::DOUBLE * source_size / weight) FROM levels
                WHERE level * weight <= 3.0::DOUBLE * source_size)) AS target
            FROM levels),
placed AS (SELECT s.*, t.source_size, t.target,
                  sum(size) OVER (PARTITION BY s.source ORDER BY key, size, tie ROWS UNBOUNDED PRECEDING) - size AS ahead,
                  CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
           FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (SELECT *, CAST(epochs * size + least(greatest(
                 floor(target)::BIGINT - epochs * source_size - ahead, 0), size) AS BIGINT) AS taken
          FROM placed)
"""

SQL = (
    "WITH "
    + MIX_SQL.format(columns="doc_id, source", text="text", docs="documents")
    + "SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, taken FROM mixed"
)
