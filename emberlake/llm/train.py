"""Training on a bounded sample: shards fit in tasks of their own, their weights are averaged."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import written

SHARDS = 4
SHARD_ROWS = 4_000  # a shard should have about so many, if the sample does


def averaged(sample: DataFrame, fit: Callable[[pa.Table], np.ndarray], shards: int = SHARDS) -> np.ndarray:
    """Mean of the weight vectors that ``fit`` makes of each shard of a bounded sample.

    A row's shard is a hash of its doc_id and text and its order a second hash, so reruns give the same
    weights. The driver gets one vector of fixed length per shard.
    """
    order = [("_order", "ascending")]

    def run(part: pa.Table) -> pa.Table:
        weights = fit(part.sort_by(order))
        return pa.table({"weights": pa.array([weights], pa.list_(pa.float64())), "rows": [part.num_rows]})

    keyed = sample.withColumn("_order", F.xxhash64("doc_id", "text", F.lit("order")))
    keyed = keyed.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "text", F.lit("shard")), F.lit(shards)))
    got = keyed.groupBy("_shard").applyInArrow(run, "weights array<double>, rows long").collect()
    got.sort(key=lambda r: (r["rows"], r["weights"]))  # so that they add up alike in every run
    if not got:
        return fit(sample.withColumn("_order", F.lit(0)).limit(0).toArrow())
    share = np.array([r["rows"] for r in got], float)
    return np.average([r["weights"] for r in got], axis=0, weights=share)


def averaged_sparse(
    sample: DataFrame, fit: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], shards: int = SHARDS
) -> tuple[np.ndarray, np.ndarray]:
    """As ``averaged`` for sparse weights: sorted 64-bit feature hashes and the mean weight of each.

    A feature that a shard lacks counts as 0 there. What reaches the driver is bounded by the features of the
    bounded sample.
    """
    order = [("_order", "ascending")]

    def run(part: pa.Table) -> pa.Table:
        hashes, weights = fit(part.sort_by(order))
        return pa.table({"feature": pa.array(hashes.view(np.int64)), "weight": pa.array(weights * part.num_rows)})

    keyed = written(sample.withColumn("_order", F.xxhash64("doc_id", "text", F.lit("order"))), "sample")
    rows = max(1, keyed.count())
    parts = min(shards, -(-rows // SHARD_ROWS))
    keyed = keyed.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "text", F.lit("shard")), F.lit(parts)))
    fitted = keyed.groupBy("_shard").applyInArrow(run, "feature long, weight double")
    summed = fitted.groupBy("feature").agg(F.sum("weight").alias("weight")).toPandas()
    hashes = summed["feature"].to_numpy(np.int64).view(np.uint64)
    order_of = np.argsort(hashes)
    return hashes[order_of], np.round(summed["weight"].to_numpy(float)[order_of] / rows, 9)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
