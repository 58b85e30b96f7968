"""Lining rows up with a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fill(df: DataFrame, keys: Sequence[str], slot: str, spine: Column, values: Sequence[str]) -> DataFrame:
    """For each key one row per slot of the spine, values null where the key has none.

    The left join of a calendar to rows that are already aggregated to one per key and slot. A key's slots
    number no more than the calendar has, so they travel as one map and the calendar is unfolded next to
    it: no second scan, no join.
    """
    known = F.map_from_entries(F.collect_list(F.struct(F.col(slot), F.struct(*values))))
    filled = df.groupBy(*keys).agg(known.alias("_slots")).select(*keys, "_slots", F.explode(spine).alias(slot))
    found = F.try_element_at("_slots", F.col(slot))
    return filled.select(*keys, slot, *[found[name].alias(name) for name in values])


BLOCK = 12  # days of a block of fractions: a window of 150 days is a dozen blocks and a tail


def rolling_sums(
    daily: DataFrame, keys: Sequence[str], date: str, value: str, lengths: Sequence[int]
) -> DataFrame:
    """Sums of ``value`` over the last n days and the current one, as ``sum_w{n}``; null without any value.

    Needs one row per key and calendar day without gaps. A range frame would add up its whole span again for every
    row. Whole and decimal numbers: each sum is the difference of two running totals, the same cost for any n.
    Fractions (float and double) would lose digits in that difference, so they are added up in two levels: sums of
    ``BLOCK`` days, then the sums of the whole blocks of a window and of its remaining days. All sums share one
    partitioning and one sort.
    """
    ordered = Window.partitionBy(*keys).orderBy(date)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.count(value).over(so_far)
    amount = F.coalesce(value, F.lit(0))
    if isinstance(daily.schema[value].dataType, (T.FloatType, T.DoubleType)):
        block = F.sum(amount).over(ordered.rowsBetween(1 - BLOCK, Window.currentRow))
        totals = daily.withColumns({"_known": known, "_block": block})

        def summed(days: int) -> Column:
            blocks, rest = divmod(days, BLOCK)
            parts = [F.lag("_block", i * BLOCK, 0.0).over(ordered) if i else F.col("_block") for i in range(blocks)]
            if rest:
                tail = ordered.rowsBetween(1 - days, -blocks * BLOCK)
                parts.append(F.coalesce(F.sum(amount).over(tail), F.lit(0.0)))
            return sum(parts[1:], parts[0])
    else:
        totals = daily.withColumns({"_known": known, "_total": F.sum(amount).over(so_far)})

        def summed(days: int) -> Column:
            return F.col("_total") - F.lag("_total", days, 0).over(ordered)

    def over_last(n: int) -> Column:
        seen = F.col("_known") - F.lag("_known", n + 1, 0).over(ordered)
        return F.when(seen > 0, summed(n + 1))

    rolled = totals.withColumns({f"sum_w{n}": over_last(n) for n in lengths})
    return rolled.drop("_known", "_total", "_block")
