"""Training corpus from documents: five stages, each written and read again by the next.

Quality classifier, line dedup, near dedup, benchmark decontamination, source mix. All but the last return the
columns of documents; the last adds what the mix takes of each document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm import decontaminate, lines, mixing, neardup, quality
from emberlake.llm.common import quoted, ship, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer trained on weak labels does not reject."""
    ship(spark)
    return quality.without_poor(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars follows the text.

    Columns of any name come back as they were, also such as the operator calls its own counts.
    """
    row = F.struct(*map(F.col, map(quoted, docs.columns))).alias("row")
    cut = lines.drop_boilerplate(docs.select("text", F.col("source").alias("host"), row), F.col("host"))
    changed = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}

    def kept(name: str) -> Column:
        old = F.col(f"row.{quoted(name)}")
        return (F.when(F.col("n_dropped") > 0, changed[name]).otherwise(old) if name in changed else old).alias(name)

    return cut.select(*map(kept, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return neardup.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with their size, their source's size and target, and the words taken."""
    return mixing.mix(docs, keep=docs.columns).where(F.col("taken") > 0)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: The classifier's weights have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
