"""Mixing of sources to target weights by Poisson replication.

A document of a source with mean target rate r appears k times, where k comes from inverting the Poisson distribution with
mean r at a number that a hash of seed and id gives. So a draw repeats on every run and no count depends on another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adyield.operators.joins import join_spreading_hot_keys

#: Numbers in the rates' distributions that may be broadcast; beyond it rates are joined by key, hot sources spread.
BROADCAST_NUMBERS = 100_000
HOT_ROWS = 100_000

_KEY, _ROWS, _CDF, _COPY, _PLACE = "mix_key", "mix_rows", "mix_cdf", "mix_copy", "mix_place"


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) of 52 bits from the md5 of the parts, joined with colons; null parts read as blank."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, epochs: float = 1.0,
                 source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Mean replication rate of each source, so that the mix holds ``epochs`` times the corpus's bytes in the target weights.

    ``weights`` gives a source's share (they are scaled to sum to one; a source not named has none); without them a source's
    share goes with its size to the power ``alpha``. Null is a source of its own. Sources without text have rate 0.
    """
    size = F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0).cast("long"))
    sources = docs.groupBy(_source_key(F.col(source_col)).alias(_KEY)).agg(
        F.min(source_col).alias("source"), F.count("*").alias(_ROWS), size.alias("size"))
    if weights is None:
        weighted = sources.withColumn("weight", F.when(F.col("size") > 0, F.pow(F.col("size").cast("double"), F.lit(alpha)))
                                      .otherwise(0.0))
    else:
        total = sum(weights.values())
        given = docs.sparkSession.createDataFrame(
            [("-" if s is None else f"+{s}", w / total) for s, w in weights.items()], f"{_KEY} string, weight double")
        weighted = sources.join(given, _KEY, "left").fillna(0.0, ["weight"])
    totals = weighted.agg(F.sum("weight").alias("weights"), F.sum("size").alias("sizes")).first()
    scale = epochs * (totals["sizes"] or 0) / (totals["weights"] or 1.0)
    rate = F.when(F.col("size") > 0, F.col("weight") * F.lit(float(scale)) / F.col("size")).otherwise(0.0)
    return weighted.select(_KEY, "source", _ROWS, "size", rate.alias("rate"))


def poisson_cdf(rate: Column) -> Column:
    """Array of P(X <= 0), P(X <= 1), ... to far beyond the mean."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct((-rate).alias("log"), F.array(F.exp(-rate)).alias("sums"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        sums = F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + F.exp(log)))
        return F.struct(log.alias("log"), sums.alias("sums"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["sums"])) \
        .otherwise(F.array(F.lit(1.0).cast("double")))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.5, epochs: float = 1.0, seed: int = 0,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", copy_col: str = "copy",
        place_col: str = "place") -> DataFrame:
    """Repeat each document by its Poisson draw and shuffle the corpus: all columns of ``docs``, ``copy_col`` (from 1) and
    ``place_col``, the pseudo-random digest by which rows are dealt to partitions and ordered within them.

    Rows with the same id in one source are drawn alike, so repeated rows repeat together; a null id reads as a blank one. A
    null text has size 0 and is drawn as any other row of its source. An empty table gives an empty result. Columns of
    ``docs`` that bear the names of the two added ones are replaced.
    """
    docs = docs.drop(copy_col, place_col)
    rates = source_rates(docs, weights, alpha, epochs, source_col, text_col)
    rates = rates.select(_KEY, _ROWS, poisson_cdf(F.col("rate")).alias(_CDF))
    keyed = docs.withColumn(_KEY, _source_key(F.col(source_col)))
    numbers = rates.agg(F.coalesce(F.sum(F.size(_CDF)), F.lit(0))).first()[0]
    if numbers <= BROADCAST_NUMBERS:
        rated = keyed.join(F.broadcast(rates.drop(_ROWS)), _KEY)
    else:
        rated = join_spreading_hot_keys(keyed, rates, _KEY, _ROWS, HOT_ROWS).drop(_ROWS)
    draw = uniform(F.lit(str(seed)), id_col)
    count = F.size(F.filter(F.col(_CDF), lambda c: c <= draw))
    copies = rated.withColumn(_COPY, count).filter(F.col(_COPY) > 0).drop(_KEY, _CDF) \
        .withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col(_COPY)))).drop(_COPY)
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(copy_col).cast("string"))
    return copies.withColumn(place_col, F.md5(name)).repartition(place_col).sortWithinPartitions(place_col)
