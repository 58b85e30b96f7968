"""Reading tables, written intermediate tables, fixed-size membership bits, bounded samples."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.session import shared_folder

#: What separates words in the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20  # text handled at a time inside a task
BATCH_BYTES = 4 << 20  # rows that go to a Python worker at a time
_SHIPPED: list = []
BITS = 26  # log2 of the size of a membership bitmap: 8 MB whatever goes in


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or ("*",))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where only the driver's path has it, and bound what they get at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = Path(__file__).resolve().parents[2]
    on_path = [Path(p).resolve() for p in [".", *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    if root in on_path or spark.sparkContext in _SHIPPED:
        return
    file = Path(tempfile.mkdtemp(prefix="emberlake-code-")) / "emberlake.zip"
    with zipfile.ZipFile(file, "w") as out:
        for source in sorted((root / "emberlake").rglob("*.py")):
            out.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(file))
    _SHIPPED.append(spark.sparkContext)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def others(df: DataFrame, *replaced: str) -> list[str]:
    """Columns of ``df`` that a result passes on beside its own ones, which take the place of equal names."""
    taken = {name.lower() for name in replaced}
    return [name for name in df.columns if name.lower() not in taken]


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Later steps read it instead of computing it again, a lost executor costs nothing, and Spark knows its
    size, so that it broadcasts it only below the session's threshold.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text; one longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a bijection with full avalanche)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def membership_bits(df: DataFrame, column: str) -> np.ndarray:
    """Bitmap with two of ``2 ** BITS`` bits, the lowest and the highest, for each of a column of 64-bit hashes.

    Its size is fixed, so it can be broadcast whatever the size of ``df``. A set bit only says "perhaps":
    rows that pass must meet ``df`` in a join.
    """
    mask = F.lit((1 << BITS) - 1).cast("long")
    both = F.array(F.col(column).bitwiseAND(mask), F.shiftrightunsigned(column, 64 - BITS).bitwiseAND(mask))
    words = (
        df.where(F.col(column).isNotNull())
        .select(F.explode(both).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for bit in (hashes & np.uint64((1 << BITS) - 1), hashes >> np.uint64(64 - BITS)):
        found &= (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
    return found


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """The bitmap of a few hashes that the driver holds."""
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    for bit in (hashes & np.uint64((1 << BITS) - 1), hashes >> np.uint64(64 - BITS)):
        np.bitwise_or.at(bits, bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63)))
    return bits


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of a narrow table, chosen by a hash of the key: the same in every run."""
    return rows.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), key).limit(limit)
