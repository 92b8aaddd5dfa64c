"""Revenue per click from the narrowest level with enough clicks, newest days first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach_level_sums(df: DataFrame, time: Sequence[str], levels: Sequence[tuple[str, Sequence[str]]],
                      measures: Sequence[str]) -> DataFrame:
    """Add each wider level's totals for the row's day.

    ``levels`` go from narrow to wide. Every total is rolled up from the next narrower one and joined
    back, so a level that holds most rows is combined map-side instead of sitting in one window task.
    """
    out, narrower = df, df
    for suffix, keys in levels:
        totals = narrower.groupBy(*time, *keys).agg(*[F.sum(m).alias(m) for m in measures])
        renamed = totals.select(*time, *keys, *[F.col(m).alias(f"{m}_{suffix}") for m in measures])
        out = out.join(renamed, [*time, *keys])
        narrower = totals
    return out


def stack_levels(df: DataFrame, keys: Sequence[str], order: Sequence[str], suffixes: Sequence[str],
                 decay: Column, clicks: str = "clicks", revenue: str = "rev") -> DataFrame:
    """One row per level: decayed clicks and revenue of that level without the narrower one."""
    def exclusive(measure: str, i: int) -> Column:
        names = [measure, *[f"{measure}_{s}" for s in suffixes]]
        own = F.col(names[i])
        return (own - F.col(names[i - 1]) if i else own) * decay

    levels = [F.struct(F.lit(i).alias("level"), exclusive(clicks, i).alias("clicks"),
                       exclusive(revenue, i).alias("rev")) for i in range(len(suffixes) + 1)]
    return df.select(*keys, *order, F.inline(F.array(*levels)))


def threshold_rate(stacked: DataFrame, keys: Sequence[str], order: Sequence[Column], threshold: float,
                   name: str = "rpc_est") -> DataFrame:
    """Revenue over clicks of the first ``threshold`` clicks in order; the last row counts in part.

    A key has one row per day, match type and level, so its window is bounded by the date range.
    """
    window = Window.partitionBy(*keys).orderBy("level", *order).rowsBetween(Window.unboundedPreceding, 0)
    cumulative = stacked.withColumn("reached", F.sum("clicks").over(window))
    before = F.col("reached") - F.col("clicks")
    share = F.when(F.col("reached") < threshold, F.lit(1.0)).when(
        before < threshold, F.least(F.lit(1.0), F.try_divide(F.lit(float(threshold)) - before, F.col("clicks")))
    ).otherwise(F.lit(0.0))
    return cumulative.withColumn("share", share).groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("rev") * F.col("share")), F.sum(F.col("clicks") * F.col("share"))).alias(name))
