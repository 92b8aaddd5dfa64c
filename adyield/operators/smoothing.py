"""Smoothers for weekly curves.

A series is the slots of one week (at most 672 rows) under its key columns, numbered 0..n-1 by an
index column. Every smoother spreads each row over the neighbours it contributes to and sums per
neighbour; the first window shuffles by the series key and all later steps keep that partitioning,
so a whole chain of passes over thousands of series costs one shuffle and no join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adyield.functions.numeric import floor_to_twentieth
from adyield.session import checkpointed

# out column -> (value column, weight column or None)
Targets = Mapping[str, tuple[str, str | None]]
Transform = Callable[[DataFrame, Sequence[str], str, Targets], DataFrame]
TINY = 1e-12
NO_RESIDUAL = 1e-9


def _fold(spread: DataFrame, keys: Sequence[str], target: str, at_home: Column, carried: Sequence[str],
          sums: Mapping[str, Column]) -> DataFrame:
    """Sum per target row; the target's own columns ride along on the copy that stayed at home.

    They ride as single values, so that the aggregate stays a hash aggregate.
    """
    own = [F.first(F.when(at_home, F.col(c)), ignorenulls=True).alias(c) for c in carried]
    return spread.groupBy(*keys, target).agg(*own, *[c.alias(n) for n, c in sums.items()])


def spread_outliers(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                    percentile: float = 97.5) -> DataFrame:
    """Cap at a percentile of the series and rescale so that its total stays the same."""
    series = Window.partitionBy(*keys)
    caps = df.withColumns({
        f"{out}_cap": F.percentile(F.col(c), F.lit(percentile / 100)).over(series) for out, c in columns.items()})
    capped = caps.withColumns({f"{out}_cut": F.least(F.col(c), F.col(f"{out}_cap")).cast("double")
                               for out, c in columns.items()})
    scaled = capped.withColumns({
        out: F.try_divide(F.sum(F.col(c)).over(series), F.sum(f"{out}_cut").over(series)) * F.col(f"{out}_cut")
        for out, c in columns.items()})
    return scaled.drop(*[f"{out}_{s}" for out in columns for s in ("cap", "cut")])


def clip_quantiles(df: DataFrame, keys: Sequence[str], column: str, low: float, high: float) -> DataFrame:
    series = Window.partitionBy(*keys)
    bounds = df.withColumns({
        "clip_low": F.percentile(F.col(column), F.lit(low)).over(series),
        "clip_high": F.percentile(F.col(column), F.lit(high)).over(series)})
    return bounds.withColumn(column, F.greatest(F.least(column, "clip_high"), "clip_low")).drop("clip_low", "clip_high")


def circular_sums(df: DataFrame, keys: Sequence[str], index: str, sums: Mapping[str, Column], window: int,
                  geometric: bool = False) -> DataFrame:
    """Kernel-weighted sums around each slot of a wrapped week.

    Slot i reads slots i + (window-1)//2 - k with kernel weight k: 1/window each, or proportional to
    ((window-1)/window)**k for the exponential kernel (which therefore leans to later slots).
    """
    carried = [c for c in df.columns if c not in keys]
    lead = (window - 1) // 2
    ratio = (window - 1) / window
    sized = df.withColumns({"slots": F.count("*").over(Window.partitionBy(*keys)),
                            **{f"{n}_in": c for n, c in sums.items()}})
    spread = sized.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(window - 1)))).withColumn(
        "target", F.pmod(F.col(index) - F.lit(lead) + F.col("step"), F.col("slots")))
    if geometric:
        kernel = F.pow(F.lit(ratio), F.col("step")) * F.lit((1 - ratio) / (1 - ratio**window))
    else:
        kernel = F.lit(1.0 / window)
    folded = _fold(spread, keys, "target", F.col("step") == lead, carried,
                   {n: F.sum(F.col(f"{n}_in") * kernel) for n in sums})
    return folded.select(*keys, *carried, *sums)


def circular_mean(df: DataFrame, keys: Sequence[str], index: str, column: str, out: str, window: int,
                  geometric: bool = False) -> DataFrame:
    return circular_sums(df, keys, index, {out: F.col(column)}, window, geometric)


def cema_transform(window: int = 16) -> Transform:
    """Spread outliers, then a weighted exponential and a weighted plain circular mean."""
    def run(df: DataFrame, keys: Sequence[str], index: str, targets: Targets) -> DataFrame:
        weights = {o: F.col(w).cast("double") if w else F.lit(1.0) for o, (_, w) in targets.items()}
        kept = df.columns
        out = spread_outliers(df, keys, {f"{o}_x": v for o, (v, _) in targets.items()})
        out = out.withColumns({f"{o}_w": weights[o] for o in targets})
        for geometric in (True, False):
            sums = {f"{o}_{part}": F.col(f"{o}_w") * (F.col(f"{o}_x") if part == "num" else F.lit(1.0))
                    for o in targets for part in ("num", "den")}
            out = circular_sums(out, keys, index, sums, window, geometric).withColumns(
                {f"{o}_x": F.try_divide(f"{o}_num", f"{o}_den") for o in targets}).drop(*sums)
        return out.select(*kept, *[F.col(f"{o}_x").alias(o) for o in targets])

    return run


def _reach(anchor: Column, n: Column, k: Column) -> Column:
    """Distance of the k-th nearest slot (the anchor itself is the 0-th) on the grid 0..n-1."""
    side = F.least(anchor, n - F.lit(1) - anchor)
    return F.greatest(F.ceil(k / F.lit(2)), k - side)


def _tricube(anchor: Column, point: Column, n: Column, k: Column) -> Column:
    share = F.least(F.abs(anchor - point) / _reach(anchor, n, k), F.lit(1.0))
    left = F.lit(1.0) - share * share * share
    return left * left * left


def lowess(df: DataFrame, keys: Sequence[str], index: str, columns: Mapping[str, str], frac: float,
           first_limit: Mapping[str, float] | float = 6.0, limit: float = 6.0, passes: int = 3) -> DataFrame:
    """Locally weighted regression with outlier removal, blended over all lines that reach a slot.

    Each anchor's line uses its floor(n*frac) nearest slots with tricube weights normalised per slot.
    The normalisation cancels graded robustness weights, so a pass either keeps a slot or drops it:
    its residual must stay under a multiple of the series' 68.2 % residual quantile (``first_limit``
    after the first fit, ``limit`` later). A residual that is only rounding noise keeps its slot.
    """
    outs = list(columns)
    first = first_limit if isinstance(first_limit, Mapping) else {o: first_limit for o in outs}
    kept = [c for c in df.columns if c not in keys]
    series = Window.partitionBy(*keys)
    n, k, x, anchor = F.col("n_slots"), F.col("near"), F.col("at"), F.col("other")
    rows = df.withColumns({
        "at": F.col(index).cast("int"), "n_slots": F.count("*").over(series).cast("int"),
        **{f"{o}_y": F.col(c).cast("double") for o, c in columns.items()},
        **{f"{o}_keep": F.lit(1.0) for o in outs}})
    rows = rows.withColumn("near", F.greatest(F.lit(1), F.floor(n * F.lit(frac)).cast("int")))
    carried = [*kept, "n_slots", "near", *[f"{o}_{s}" for o in outs for s in ("y", "keep")]]

    def spread(frame: DataFrame) -> DataFrame:
        # only anchors near the ends of the series reach further than half the neighbours
        inner = (x >= k * 2) & (x < n - k * 2)
        width = F.when(inner, F.ceil(k / F.lit(2)).cast("int")).otherwise(k)
        others = F.sequence(F.greatest(x - width, F.lit(0)), F.least(x + width, n - 1))
        return frame.withColumn("other", F.explode(others))

    # how much weight all anchors together give to a slot
    reach_sum = spread(rows.select(*keys, "at", *carried)).withColumn("w", _tricube(anchor, x, n, k))
    rows = _fold(reach_sum, keys, "at", anchor == x, carried, {"total": F.sum("w")})
    carried = [*carried, "total"]

    for i in range(passes):
        points = spread(rows.select(*keys, "at", *carried)).withColumns({
            "w": _tricube(anchor, x, n, k) / F.col("total"), "d": (x - anchor).cast("double")}).filter("w > 0")
        sums = {}
        for o in outs:
            w = F.col("w") * F.col(f"{o}_keep")
            sums |= {f"{o}_s0": F.sum(w), f"{o}_s1": F.sum(w * F.col("d")), f"{o}_s2": F.sum(w * F.col("d") * F.col("d")),
                     f"{o}_t0": F.sum(w * F.col(f"{o}_y")), f"{o}_t1": F.sum(w * F.col("d") * F.col(f"{o}_y"))}
        lines = _fold(points, keys, "other", x == anchor, carried, sums).withColumnRenamed("other", "at")
        values = spread(lines).withColumns({"w": _tricube(x, anchor, n, k), "d": (anchor - x).cast("double")})
        preds = {}
        for o in outs:
            s0, s1, s2, t0, t1 = (F.col(f"{o}_{s}") for s in ("s0", "s1", "s2", "t0", "t1"))
            det = s0 * s2 - s1 * s1
            slope = (s0 * t1 - s1 * t0) / det
            line = (t0 - slope * s1) / s0 + slope * F.col("d")
            # one remaining slot: the smallest-norm line through it
            x0, y0 = x + s1 / s0, t0 / s0
            single = y0 * (F.lit(1.0) + x0 * anchor) / (F.lit(1.0) + x0 * x0)
            value = F.when(s0 <= 0, F.lit(0.0)).when(det > F.lit(TINY) * s0 * F.greatest(s2, F.lit(TINY)), line).otherwise(single)
            preds[f"{o}_fit"] = F.sum(F.col("w") * value) / F.sum("w")
        rows = _fold(values, keys, "other", x == anchor, carried, preds).withColumnRenamed("other", "at")
        if i < passes - 1:
            rows = rows.withColumns({f"{o}_res": F.abs(F.col(f"{o}_y") - F.col(f"{o}_fit")) for o in outs})
            rows = rows.withColumns({
                f"{o}_sd": F.percentile(F.col(f"{o}_res"), F.lit(0.682)).over(series) for o in outs})
            rows = rows.withColumns({
                f"{o}_keep": F.when((F.col(f"{o}_res") < NO_RESIDUAL) | (
                    F.col(f"{o}_res") < F.col(f"{o}_sd") * F.lit(float(first[o] if i == 0 else limit))), F.lit(1.0)
                ).otherwise(F.lit(0.0)) for o in outs})
    return rows.select(*keys, *kept, *[F.col(f"{o}_fit").alias(o) for o in outs])


def lowess_transform(frac: float = 0.03, first_limit: float = 5.0) -> Transform:
    """Spread outliers, then robust local regression."""
    def run(df: DataFrame, keys: Sequence[str], index: str, targets: Targets) -> DataFrame:
        kept = df.columns
        spread = spread_outliers(df, keys, {f"{o}_x": v for o, (v, _) in targets.items()})
        fitted = lowess(spread, keys, index, {o: f"{o}_x" for o in targets}, frac, first_limit)
        return fitted.select(*kept, *targets)

    return run


def add_modifiers(df: DataFrame, keys: Sequence[str], index: str, target: str, weight: str, transform: Transform,
                  suffix: str) -> DataFrame:
    """Smoothed weight and target, the plain mean of the raw target, and their ratio cut down to 0.05 steps."""
    smooth = transform(df, keys, index, {
        f"{weight}_{suffix}": (weight, None), f"{target}_{suffix}": (target, weight)})
    mean = F.avg(target).over(Window.partitionBy(*keys))
    return smooth.withColumns({
        "baseline": F.lit(1), f"{target}_{suffix}_mean": mean,
    }).withColumn(f"{target}_{suffix}_modifier",
                  floor_to_twentieth(F.try_divide(f"{target}_{suffix}", f"{target}_{suffix}_mean")))


def smoothing_spline(df: DataFrame, keys: Sequence[str], index: str, column: str, out: str,
                     squared_error: float) -> DataFrame:
    """The smoothest curve whose squared error against the series stays within ``squared_error``.

    Penalised least squares on second differences, solved in the cosine basis that diagonalises the
    penalty on a regular grid: one pass for the coefficients, one over a quarter-octave ladder of
    penalties (the largest admissible one wins), one to rebuild the curve.
    """
    series = Window.partitionBy(*keys)
    kept = [c for c in df.columns if c not in keys]
    sized = df.withColumns({"n_slots": F.count("*").over(series).cast("int"), "at": F.col(index).cast("int")})
    carried = [*kept, "n_slots"]
    n = F.col("n_slots")
    scale = F.when(F.col("freq") == 0, F.sqrt(F.lit(1.0) / n)).otherwise(F.sqrt(F.lit(2.0) / n))
    basis = scale * F.cos(F.lit(3.141592653589793) * F.col("freq") * (F.col("at") + F.lit(0.5)) / n)
    grid = F.explode(F.sequence(F.lit(0), n - 1))
    coefficients = _fold(sized.withColumn("freq", grid), keys, "freq", F.col("freq") == F.col("at"), carried,
                         {"c": F.sum(F.col(column) * basis)})
    stiffness = F.pow(F.lit(2.0) - F.lit(2.0) * F.cos(F.lit(3.141592653589793) * F.col("freq") / n), F.lit(2.0))
    coefficients = coefficients.withColumn("stiff", stiffness)
    penalty = F.pow(F.lit(2.0), F.col("rung") / F.lit(4.0))
    ladder = coefficients.select(*keys, "c", "stiff", F.explode(F.sequence(F.lit(-80), F.lit(160))).alias("rung"))
    lost = F.col("c") * penalty * F.col("stiff") / (F.lit(1.0) + penalty * F.col("stiff"))
    errors = ladder.withColumn("lost", lost).groupBy(*keys, "rung").agg(F.sum(F.col("lost") * F.col("lost")).alias("rss"))
    chosen = errors.filter(F.col("rss") <= squared_error).groupBy(*keys).agg(F.max("rung").alias("rung"))
    if keys:
        joined = coefficients.join(chosen, list(keys), "left")
    else:
        joined = coefficients.withColumn("rung", chosen.agg(F.max("rung")).scalar())
    shrunk = joined.withColumn("c", F.when(
        F.col("rung").isNull(), F.col("c")).otherwise(F.col("c") / (F.lit(1.0) + penalty * F.col("stiff"))))
    rebuilt = _fold(shrunk.withColumn("at", grid), keys, "at", F.col("freq") == F.col("at"), kept,
                    {out: F.sum(F.col("c") * basis)})
    return rebuilt.select(*keys, *kept, out)


def _spline_basis(u: Column, degree: int) -> list[Column]:
    """The ``degree`` + 1 B-splines that are not zero at place ``u`` (0 to 1) of a segment between even knots."""
    basis = [F.lit(1.0)]
    for d in range(1, degree + 1):
        basis = [((u + F.lit(float(d - j))) * basis[j - 1] / d if j else F.lit(0.0))
                 + ((F.lit(float(j + 1)) - u) * basis[j] / d if j < d else F.lit(0.0)) for j in range(d + 1)]
    return basis


def _segment(at: Column, low: Column, high: Column, segments: Column) -> tuple[Column, Column]:
    """Segment that a place lies in, and how far through; the last place ends the last segment."""
    scaled = F.coalesce(F.try_divide((at - low) * segments, high - low), F.lit(0.0))
    number = F.least(F.floor(scaled), segments - 1).cast("int")
    return number, scaled - number


def regression_spline(df: DataFrame, keys: Sequence[str], index: str, column: str, out: str, degree: int = 3,
                      squared_error: float = 0.0, rungs: int = 10) -> DataFrame:
    """The spline of ``degree`` with the fewest even segments whose squared error against the series stays within ``squared_error``.

    Segments are doubled up to 2 ** ``rungs`` and to as many coefficients as there are places; where none is close enough the closest
    counts. Normal equations are banded and summed per segment, so a series may have any number of rows, also several at a place;
    only its coefficients, never its rows, come together in one task. Rows without a place or value do not count; a row without a
    place gets no value. The rows are written out first, as they are read for the range, for the sums and for the curve.
    """
    if not 0 <= degree <= 5:
        raise ValueError("degree must be 0 to 5")
    keys, width, df = list(keys), degree + 1, checkpointed(df)
    names = [f"k{i}" for i in range(len(keys))]
    plain = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(index).cast("double").alias("x"), F.col(column).cast("double").alias("y")) \
        .filter("x is not null and y is not null")
    span = plain.groupBy(*names, "x").agg(F.count("y").alias("n")).groupBy(*names).agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("places"))
    span = checkpointed(span)

    def attach(rows: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
        facts = facts.withColumnsRenamed({n: f"f_{n}" for n in names})
        on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"f_{n}")) for n in names], F.lit(True))
        return rows.join(facts, on, how).drop(*[f"f_{n}" for n in names])

    number, part = _segment(F.col("x"), F.col("low"), F.col("high"), F.pow(F.lit(2.0), F.col("rung")))
    ladder = F.filter(F.sequence(F.lit(0), F.lit(rungs)), lambda r: (r == 0) | (F.pow(F.lit(2.0), r) + degree <= F.col("places")))
    placed = attach(plain, span).withColumn("rung", F.explode(ladder)).select(*names, "rung", number.alias("segment"), part.alias("u"), "y")
    placed = placed.select(*names, "rung", "segment", "y", *[b.alias(f"b{j}") for j, b in enumerate(_spline_basis(F.col("u"), degree))])
    squares = [(i, j) for i in range(width) for j in range(i, width)]
    sums = placed.groupBy(*names, "rung", "segment").agg(
        F.sum(F.col("y") * F.col("y")).alias("yy"), *[F.sum(F.col(f"b{i}") * F.col("y")).alias(f"y{i}") for i in range(width)],
        *[F.sum(F.col(f"b{i}") * F.col(f"b{j}")).alias(f"s{i}_{j}") for i, j in squares])

    def solve(table: pa.Table) -> pa.Table:
        rung = table.column("rung")[0].as_py()
        size = 2 ** rung + degree
        matrix, right = np.zeros((size, size)), np.zeros(size)
        at = table.column("segment").to_numpy()
        for i in range(width):
            np.add.at(right, at + i, table.column(f"y{i}").to_numpy())
        for i, j in squares:
            value = table.column(f"s{i}_{j}").to_numpy()
            np.add.at(matrix, (at + i, at + j), value)
            if i != j:
                np.add.at(matrix, (at + j, at + i), value)
        # an empty stretch leaves coefficients open: the smallest ones then
        found = np.linalg.lstsq(matrix, right, rcond=1e-12)[0]
        lost = max(0.0, float(table.column("yy").to_numpy().sum() - 2 * found @ right + found @ matrix @ found))
        head = {n: table.column(n).slice(0, 1) for n in names}
        return pa.table({**head, "rung": pa.array([rung], pa.int32()), "lost": pa.array([lost]), "found": pa.array([found.tolist()], pa.list_(pa.float64()))})

    kinds = "".join(f"{n} {plain.schema[n].dataType.simpleString()}, " for n in names)
    fitted = sums.groupBy(*names, "rung").applyInArrow(solve, f"{kinds}rung int, lost double, found array<double>")
    enough = F.col("lost") <= F.lit(float(squared_error) + 1e-9)
    best = fitted.groupBy(*names).agg(F.min_by(F.struct("rung", "found"), F.struct(
        (~enough).cast("int").alias("short"), F.when(enough, F.col("rung")).otherwise(F.lit(0)).alias("first"), F.when(enough, 0.0).otherwise(F.col("lost")).alias("error"),
        F.col("rung").alias("tie"))).alias("best"))
    facts = attach(span, best).select(*names, "low", "high", "best.rung", "best.found")
    rows = df.select(F.struct("*").alias("row"), *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(index).cast("double").alias("x"))
    curve = attach(rows, facts, "left").withColumns({"segment": number, "u": part})
    value = reduce(lambda a, b: a + b, [F.try_element_at("found", F.col("segment") + F.lit(j + 1)) * b for j, b in enumerate(_spline_basis(F.col("u"), degree))])
    value = F.when(F.col("x").isNotNull(), value)
    return curve.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns], value.alias(out))
