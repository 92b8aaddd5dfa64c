"""Place statistics, significance tests, buckets and test groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.distributions import beta_ppf, t_two_sided_p
from adyield.session import checkpointed

METRICS = ("sessions_log", "revenue_log", "rps", "conversion_rate", "rpl_beta")


def location_stats(facts: DataFrame, keys: Sequence[str], min_conversions: int = 0) -> DataFrame:
    """Sessions, conversions, revenue and revenue per session by place."""
    totals = facts.groupBy(*keys).agg(
        F.count("*").alias("sessions"), F.sum(F.col("has_conversion").cast("int")).alias("conversions"), F.sum("revenue").alias("revenue"))
    return totals.filter(F.col("conversions") >= min_conversions).withColumn("rps", F.col("revenue") / F.col("sessions"))


def location_stats_bayes(facts: DataFrame, keys: Sequence[str], min_conversions: int = 0) -> DataFrame:
    """Place statistics with logs and cautious (5 % tail) estimates from beta posteriors.

    ``rpl`` here is revenue per session times conversion rate; ``revenue_per_lead`` is the plain ratio.
    """
    stats = location_stats(facts, keys, min_conversions)
    sessions, conversions, revenue = (F.col(c).cast("double") for c in ("sessions", "conversions", "revenue"))
    rps_tail = F.lit(1.0) / beta_ppf(F.lit(0.95), sessions + 1, revenue - sessions + 1)
    out = stats.withColumns({
        "sessions_log": F.log10("sessions"), "revenue_log": F.log10("revenue"),
        "rps_beta": F.coalesce(rps_tail, F.col("rps")), "conversion_rate": conversions / sessions,
        "conversion_rate_beta": beta_ppf(F.lit(0.05), conversions + 1, sessions - conversions + 1),
        "revenue_per_lead": F.try_divide(revenue, conversions)})
    return out.withColumns({
        "rpl": F.col("rps") * F.col("conversion_rate"), "rpl_beta": F.col("rps_beta") * F.col("conversion_rate_beta")})


def carve_out_region(facts: DataFrame, listed: Sequence[str], detail: str = "dma_state", default: str = "state_code") -> DataFrame:
    """Listed metros become regions of their own, everything else goes by state."""
    return facts.withColumn("region", F.when(F.col(detail).isin(list(listed)), F.col(detail)).otherwise(F.col(default)))


# --- Welch tests -------------------------------------------------------------------------

def _moments(prefix: str, value: Column, flag: Column) -> list[Column]:
    """Count, sum, mean and squared distance from the mean: moments that merge without cancellation."""
    value = value.cast("double")
    return [F.count(value).alias(f"{prefix}_n"), F.sum(value).alias(f"{prefix}_s1"), F.avg(value).alias(f"{prefix}_mean"),
            (F.var_pop(value) * F.count(value)).alias(f"{prefix}_m2"), F.sum(F.when(value.isNotNull(), flag)).alias(f"{prefix}_conversions")]


def welch_columns(df: DataFrame, a: str, b: str) -> DataFrame:
    """t statistic, degrees of freedom and two-sided p value from two sides' n, mean and squared distance from it (m2)."""
    def error(side: str) -> Column:
        n = F.col(f"{side}_n")
        return F.when(n > 1, F.greatest(F.col(f"{side}_m2"), F.lit(0.0)) / (n - 1) / n)

    ea, eb = F.col(f"{a}_error"), F.col(f"{b}_error")
    out = df.withColumns({f"{s}_error": error(s) for s in (a, b)}).withColumns({
        "t": F.try_divide(F.col(f"{a}_mean") - F.col(f"{b}_mean"), F.sqrt(ea + eb)),
        "df": F.try_divide((ea + eb) * (ea + eb), ea * ea / (F.col(f"{a}_n") - 1) + eb * eb / (F.col(f"{b}_n") - 1))})
    return out.withColumn("pval", t_two_sided_p(F.col("t"), F.col("df"))).drop(f"{a}_error", f"{b}_error")


def welch_test(sample: DataFrame, is_child: Column, value: str = "revenue", flag: str = "has_conversion",
               keys: Sequence[str] = ()) -> DataFrame:
    """Both sides' counts and rates and the test of equal means, one row per ``keys``, from one pass."""
    sides = {"parent": F.when(~is_child, F.col(value)), "child": F.when(is_child, F.col(value))}
    sums = [m for name, v in sides.items() for m in _moments(name, v, F.col(flag))]
    out = welch_columns(sample.groupBy(*keys).agg(*sums), "parent", "child")
    rates = {}
    for name in ("parent", "child"):
        rates |= {f"{name}_avg_value": F.try_divide(f"{name}_s1", f"{name}_conversions"),
                  f"{name}_conv_rate": F.col(f"{name}_conversions") / F.col(f"{name}_n")}
    return out.withColumns(rates).withColumnsRenamed({
        f"{side}_{old}": f"{side}_{new}" for side in ("parent", "child")
        for old, new in (("n", "sessions"), ("s1", "revenue"), ("mean", "rps"))}).drop("parent_m2", "child_m2")


def location_exemptions(facts: DataFrame, parent: Sequence[str], child: Sequence[str], min_conversions: int = 200,
                        max_p: float | None = 0.05) -> DataFrame:
    """Every eligible child place against the rest of its parent.

    One aggregate per child place; a parent's moments are merged from its children's and the rest is total minus child, on
    distances from the mean, so no pair of places re-reads the sessions and a mean far from zero costs no digits.
    """
    children = facts.groupBy(*parent, *child).agg(*_moments("child", F.col("revenue"), F.col("has_conversion")))
    whole = Window.partitionBy(*parent)
    n, mean, m2 = (F.col(f"child_{c}") for c in ("n", "mean", "m2"))
    merged = children.withColumns({"all_n": F.sum(n).over(whole), "near": F.min(mean).over(whole)}) \
        .withColumn("all_mean", F.col("near") + F.sum(n * (mean - F.col("near"))).over(whole) / F.col("all_n")) \
        .withColumn("all_m2", F.sum(m2 + n * F.pow(mean - F.col("all_mean"), F.lit(2.0))).over(whole))
    gap = F.col("all_mean") - mean
    pairs = merged.filter(F.col("child_conversions") >= min_conversions).withColumn("parent_n", F.col("all_n") - n) \
        .filter(F.col("parent_n") >= min_conversions).withColumns({
            "parent_mean": F.col("all_mean") + F.try_divide(gap * n, F.col("parent_n")),
            # the two means lie gap * all / rest apart
            "parent_m2": F.col("all_m2") - m2 - F.try_divide(gap * gap * n * F.col("all_n"), F.col("parent_n"))})
    tested = welch_columns(pairs, "parent", "child")
    if max_p is not None:
        tested = tested.filter(F.col("pval") <= max_p)
    return tested.select(*parent, *child, F.col("parent_mean").alias("parent_rps"), F.col("child_mean").alias("child_rps"), "t", "df", "pval")


# --- ranks and buckets -------------------------------------------------------------------

def rank_places(stats: DataFrame, metric: str, place: str = "state_code", keys: Sequence[str] = ("product",)) -> DataFrame:
    """0-based rank of each place by a metric within its product."""
    order = Window.partitionBy(*keys).orderBy(metric, place)
    return stats.select(*keys, place, metric, (F.row_number().over(order) - 1).alias("rank"))


def rank_by_product(stats: DataFrame, sort_product: str, metric: str, values: Sequence[str]) -> DataFrame:
    """A metric per product side by side, places in the order of one product."""
    ranks = rank_places(stats.filter(F.col("product") == sort_product), metric).select("state_code", "rank")
    return stats.join(ranks, "state_code").groupBy("rank", "state_code").pivot("product", list(values)).agg(F.first(metric))


def greedy_buckets(stats: DataFrame, buckets: int, place: str = "state_code", keys: Sequence[str] = ("product",)) -> DataFrame:
    """Places in order of revenue per session, a bucket closing once its conversions exceed an even share.

    The count restarts with every bucket, so the assignment is a fold over one product's places (one
    row per state, at most a few dozen).
    """
    entry = F.struct(F.col("rps"), F.col(place).alias("place"), F.col("conversions"))
    gathered = stats.groupBy(*keys).agg(
        F.array_sort(F.collect_list(entry)).alias("places"), F.ceil(F.sum("conversions") / buckets).alias("share"))
    start = F.struct(F.lit(0).cast("long").alias("filled"), F.lit(1).alias("bucket"),
                     F.array().cast("array<int>").alias("assigned"))

    def step(state: Column, item: Column) -> Column:
        filled = state["filled"] + item["conversions"]
        closes = filled > F.col("share")
        return F.struct(
            F.when(closes, F.lit(0).cast("long")).otherwise(filled).alias("filled"),
            (state["bucket"] + closes.cast("int")).alias("bucket"),
            F.concat(state["assigned"], F.array(state["bucket"])).alias("assigned"))

    folded = gathered.withColumn("assigned", F.aggregate("places", start, step)["assigned"])
    return folded.select(*keys, F.inline(F.arrays_zip("places", "assigned"))).select(
        *keys, F.col("places.place").alias(place), "places.rps", "places.conversions", F.col("assigned").alias("bucket"))


def bucket_ranges(buckets: DataFrame, keys: Sequence[str] = ("product",)) -> DataFrame:
    """Gap-free revenue-per-session range per bucket: from its own minimum (0 for the first) to the
    next bucket's minimum (three times its maximum for the last)."""
    spans = buckets.groupBy(*keys, "bucket").agg(F.min("rps").alias("low"), F.max("rps").alias("high"))
    order = Window.partitionBy(*keys).orderBy("bucket")
    first = F.row_number().over(order) == 1
    return spans.select(
        *keys, "bucket", F.when(first, F.lit(0.0)).otherwise(F.col("low")).alias("rps_min"),
        F.coalesce(F.lead("low").over(order), F.col("high") * 3.0).alias("rps_max"))


def revenue_spread(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, sum, deviation, variance and mean of revenue per group, and deviation over mean."""
    stats = facts.groupBy(*keys).agg(
        F.count("revenue").alias("count"), F.sum("revenue").alias("sum"), F.stddev("revenue").alias("std"),
        F.variance("revenue").alias("var"), F.avg("revenue").alias("mean"))
    return stats.withColumn("std_proportion", F.try_divide("std", "mean"))


# --- test groups -------------------------------------------------------------------------

def scaled(df: DataFrame, columns: Sequence[str], method: str = "max") -> DataFrame:
    """Columns divided by their largest magnitude, or centred and divided by their deviation.

    The rows are written out first: they are read for the scale and again for the values, and more often by a fit.
    """
    df = checkpointed(df)
    if method == "max":
        tops = df.agg(F.struct(*[F.max(F.abs(c)).alias(c) for c in columns])).scalar()
        with_top = df.withColumn("scale_top", tops)
        return with_top.withColumns({
            c: F.col(c) / F.when(F.col("scale_top")[c] == 0, F.lit(1.0)).otherwise(F.col("scale_top")[c])
            for c in columns}).drop("scale_top")
    stats = df.agg(F.struct(*[f(c).alias(f"{c}_{n}") for c in columns
                              for n, f in (("mean", F.avg), ("std", F.stddev_pop))])).scalar()
    with_stats = df.withColumn("scale_stats", stats)
    return with_stats.withColumns({
        c: (F.col(c) - F.col("scale_stats")[f"{c}_mean"]) / F.when(
            F.col("scale_stats")[f"{c}_std"] == 0, F.lit(1.0)).otherwise(F.col("scale_stats")[f"{c}_std"])
        for c in columns}).drop("scale_stats")


def scored_regions(stats: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    out = scaled(stats, metrics)
    return out.withColumn("final_score", sum((F.coalesce(c, F.lit(0.0)) for c in metrics), F.lit(0.0)))


def round_robin(scored: DataFrame, groups: int, score: str = "final_score", tie: str = "region") -> DataFrame:
    """Groups 1..n dealt in turn by falling score (one row per region)."""
    order = Window.orderBy(F.col(score).desc(), tie)
    return scored.withColumn("group", ((F.row_number().over(order) - 1) % groups + 1).cast("int"))


def balanced_split(facts: DataFrame, listed: Sequence[str], groups: int = 2, min_conversions: int = 30) -> DataFrame:
    """Regions with scaled metrics, score and test group."""
    stats = location_stats_bayes(carve_out_region(facts, listed), ["region"], min_conversions)
    return round_robin(scored_regions(stats), groups)


def split_check(split: DataFrame, facts: DataFrame, listed: Sequence[str], min_conversions: int = 1) -> DataFrame:
    """Welch test of the two groups' scores in another period; regions keep their group."""
    stats = location_stats_bayes(carve_out_region(facts, listed), ["region"], min_conversions)
    later = scored_regions(stats).select("region", "final_score", "conversions")
    grouped = later.join(split.select("region", "group"), "region", "right").filter(F.col("final_score").isNotNull())
    return welch_test(grouped, F.col("group") == 2, "final_score", "conversions").select(
        F.col("parent_sessions").alias("first_regions"), F.col("child_sessions").alias("second_regions"),
        F.col("parent_rps").alias("first_mean"), F.col("child_rps").alias("second_mean"), "t", "df", "pval")


def region_clusters(stats: DataFrame, columns: Sequence[str], k: int, method: str = "standard", seed: int = 1) -> DataFrame:
    """Regions with the K-means cluster of their scaled metrics."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(
        scaled(stats, columns, method).na.drop(subset=list(columns)))
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)
    return model.transform(vectors).drop("features")


def elbow(stats: DataFrame, columns: Sequence[str], k_max: int, method: str = "standard", seed: int = 1) -> DataFrame:
    """Within-cluster squared error for 2 .. k_max-1 clusters."""
    vectors = checkpointed(VectorAssembler(inputCols=list(columns), outputCol="features").transform(
        scaled(stats, columns, method).na.drop(subset=list(columns))).select("features"))
    rows = [(k, float(KMeans(k=k, seed=seed).fit(vectors).summary.trainingCost)) for k in range(2, k_max)]
    return stats.sparkSession.createDataFrame(rows, "clusters int, squared_error double")


def histogram(df: DataFrame, column: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value; the last bin is closed."""
    edges = df.groupBy(*keys).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    if keys:
        ranged = df.join(edges, list(keys))
    else:
        edge = edges.select(F.struct("low", "high")).scalar()
        ranged = df.withColumn("edge", edge).select("*", "edge.*")
    place = F.floor((F.col(column) - F.col("low")) / (F.col("high") - F.col("low")) * bins).cast("int")
    binned = ranged.filter(F.col(column).isNotNull()).withColumn(
        "bin", F.when(F.col("high") == F.col("low"), F.lit(0)).otherwise(F.least(place, F.lit(bins - 1))))
    counts = binned.groupBy(*keys, "bin", "low", "high").agg(F.count("*").alias("n"))
    width = (F.col("high") - F.col("low")) / bins
    return counts.select(*keys, "bin", (F.col("low") + F.col("bin") * width).alias("left"), "n")


def rates_by(stats: Mapping[str, DataFrame]) -> DataFrame:
    """Several levels' statistics stacked under a level name."""
    out = None
    for level, frame in stats.items():
        rows = frame.select(F.lit(level).alias("level"), "product", "sessions", "conversions", "revenue", "rps")
        out = rows if out is None else out.unionByName(rows)
    return out
