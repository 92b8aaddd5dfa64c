"""Resampling by hashed draws, mutual information and weighted densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.distributions import t_upper_quantile
from adyield.operators.sessions import uniform_draw

#: Parts that rows are numbered in; their sizes go through one task.
PARTS = 1_024


def numbered(df: DataFrame, order: Sequence[str], parts: int = PARTS) -> DataFrame:
    """Rows with a gap-free 0-based number: parts follow one another, within one rows go by ``order``.

    A row's part is a hash of its order columns, so nothing is sorted across parts; the parts' sizes, of which there are
    ``parts`` at most, tell where each begins.
    """
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in order])
    part = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(parts)).cast("int")
    rows = df.withColumn("part", part)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)).cast("long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begins"))
    return rows.withColumn("inside", inside).join(F.broadcast(begins), "part") \
        .withColumn("row_number", F.col("begins") + F.col("inside") - 1).drop("part", "inside", "begins")


def draw_rows(sample: DataFrame, draws: DataFrame, rows: int) -> DataFrame:
    """Join every draw to the row its hash picks (uniform, so no key is hot)."""
    picked = draws.withColumn("row_number", F.floor(uniform_draw(F.col("draw"), 7) * F.lit(rows)).cast("long"))
    return picked.join(sample, "row_number")


def bootstrap_error(df: DataFrame, value: str, order: Sequence[str], sample_sizes: int = 100, simulations: int = 1000,
                    confidence: float = 0.95) -> DataFrame:
    """Mean relative error of the sample mean, with its t interval, for samples of 1 .. n rows."""
    sample = numbered(df.select(*order, F.col(value).alias("v")), order)
    total = sample.agg(F.count("*").alias("n"), F.avg("v").alias("mean")).first()
    spark = df.sparkSession
    draws = spark.range(simulations).select(
        F.col("id").alias("simulation"), F.explode(F.sequence(F.lit(1), F.lit(sample_sizes))).alias("sample_size")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("sample_size"))).alias("k")).withColumn(
        "draw", F.xxhash64("simulation", "sample_size", "k"))
    means = draw_rows(sample, draws, total["n"]).groupBy("sample_size", "simulation").agg(F.avg("v").alias("mean"))
    errors = means.withColumn("error", F.abs(F.col("mean") - F.lit(total["mean"])) / F.lit(total["mean"]))
    stats = errors.groupBy("sample_size").agg(
        F.avg("error").alias("mean_percent_error"), F.stddev("error").alias("std"), F.count("*").alias("n"))
    half = t_upper_quantile(F.lit(0.5 + confidence / 2), (F.col("n") - 1).cast("double")) * F.col("std") / F.sqrt("n")
    return stats.select("sample_size", "mean_percent_error", (F.col("mean_percent_error") - half).alias("lower_ci"),
                        (F.col("mean_percent_error") + half).alias("upper_ci"))


def resampled_counts(df: DataFrame, column: str, order: Sequence[str], draws: int = 100000) -> DataFrame:
    """Histogram of a column over rows drawn with replacement."""
    sample = numbered(df.select(*order, column), order)
    rows = sample.count()
    picks = df.sparkSession.range(draws).withColumnRenamed("id", "draw")
    return draw_rows(sample, picks, rows).groupBy(column).agg(F.count("*").alias("n"))


def mutual_information(rps: DataFrame, bucket: Sequence[str]) -> DataFrame:
    """Mutual information (nats) of the bucket and "revenue per session above the mean", by sessions."""
    mean = rps.agg(F.sum(F.col("rps_avg") * F.col("sessions")) / F.sum("sessions")).scalar()
    cells = rps.withColumn("high", F.col("rps_avg") > mean).groupBy(*bucket, "high").agg(F.sum("sessions").alias("n"))
    by_bucket = cells.groupBy(*bucket).agg(F.sum("n").alias("n_bucket"))
    by_side = cells.groupBy("high").agg(F.sum("n").alias("n_side"))
    total = cells.agg(F.sum("n")).scalar()
    joint = cells.join(by_bucket, list(bucket)).join(by_side, "high").withColumn("total", total)
    term = F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("n_bucket") * F.col("n_side")))
    return joint.agg(F.sum(term).alias("mutual_information"),
                     (F.sum(F.when(F.col("high"), F.col("n"))) / F.first("total")).alias("high_share"))


def weighted_density(df: DataFrame, value: str, weight: str, low: float = 0.0, high: float = 2.0, points: int = 100,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Gaussian kernel density of a weighted column on a fixed grid, bandwidth by Scott's rule.

    With ``keys`` each of their combinations has a density and a bandwidth of its own; rows with a null key take no part.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("x"), F.col(weight).cast("double").alias("w")).na.drop() \
        .groupBy(*keys, "x").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("w2"))
    sums = F.struct(
        F.sum("w").alias("w"), F.sum("w2").alias("w2"), F.sum(F.col("w") * F.col("x")).alias("wx"),
        F.sum(F.col("w") * F.col("x") * F.col("x")).alias("wxx")).alias("s")
    if keys:
        summed = rows.join(rows.groupBy(*keys).agg(sums), list(keys))
    else:
        summed = rows.withColumn("s", rows.agg(sums).scalar())
    s = F.col("s")
    mean = s["wx"] / s["w"]
    effective = s["w"] * s["w"] / s["w2"]
    variance = (s["wxx"] / s["w"] - mean * mean) / (F.lit(1.0) - F.lit(1.0) / effective)
    bandwidth = F.pow(effective, F.lit(-0.2)) * F.sqrt(variance)
    grid = F.array(*[F.lit(low + (high - low) * i / (points - 1)) for i in range(points)])
    placed = summed.select(
        *keys, "x", (F.col("w") / s["w"]).alias("p"), bandwidth.alias("h"), F.posexplode(grid).alias("point", "at"))
    z = (F.col("at") - F.col("x")) / F.col("h")
    kernel = F.exp(F.lit(-0.5) * z * z) / (F.col("h") * F.lit(2.5066282746310002))
    return placed.groupBy(*keys, "point", "at").agg(F.sum(F.col("p") * kernel).alias("density"))
