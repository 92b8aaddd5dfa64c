"""Weekly curves: smoothers, modifiers, intervals, schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from adyield.operators import intervals, ordered, smoothing as sm, slots
from adyield.plans import schedules
from checks.bids import SPLIT, positions
from checks.registry import register
from checks.slots import GEO, GEO_FACTS, facts, ratio, slot_of
from checks.views import with_views


def series(spark, sf):
    return slots.quarter_hour_user_tz(schedules.with_overall(facts(spark, sf), "product"), ["product"])


SERIES = f"""{GEO_FACTS},
widened AS (SELECT * FROM facts UNION ALL SELECT * REPLACE ('ALL' AS product) FROM facts),
series AS MATERIALIZED (
  SELECT product, CAST(dow AS INT) AS dayofweek, hourofday, days_samplesize, sessions, conversions, {ratio('u', 'n')} AS rps,
    CAST(row_number() OVER (PARTITION BY product ORDER BY dow, hourofday) - 1 AS INT) AS int_ix
  FROM (SELECT product, dayofweek(user_ts) AS dow, {slot_of('user_ts')} AS hourofday,
      count(DISTINCT CAST(user_ts AS DATE)) AS days_samplesize, count(session_id) AS sessions,
      CAST(sum(CASE WHEN units > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS conversions, CAST(sum(units) AS BIGINT) AS u,
      count(DISTINCT session_id) AS n FROM widened GROUP BY 1, 2, 3))"""
HOURS = f"""{SERIES},
hours AS MATERIALIZED (
  SELECT *, CAST(row_number() OVER (ORDER BY dayofweek, hourofday) - 1 AS INT) AS int_ix, 'all' AS one FROM (
    SELECT dayofweek, CAST(floor(hourofday) AS DOUBLE) AS hourofday, CAST(sum(sessions) AS BIGINT) AS sessions,
      sum(rps * sessions) / sum(sessions) AS rps
    FROM series WHERE product = 'ALL' GROUP BY 1, 2))"""


def spread_sql(name: str, source: str, key: str, value: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {key}, int_ix, least({value}, cap) * sum({value}) OVER (PARTITION BY {key})
    / sum(least({value}, cap)) OVER (PARTITION BY {key}) AS y
  FROM (SELECT {key}, int_ix, CAST({value} AS DOUBLE) AS {value},
    quantile_cont(CAST({value} AS DOUBLE), 0.975) OVER (PARTITION BY {key}) AS cap FROM {source}))"""


def circular_sql(name: str, source: str, key: str, value: str, window: int, geometric: bool) -> str:
    """Kernel sums by direct look-up of every slot's neighbours."""
    r = (window - 1) / window
    kernel = f"pow({r!r}, k) * {(1 - r) / (1 - r**window)!r}" if geometric else f"{1 / window!r}"
    return f"""{name} AS MATERIALIZED (
  SELECT t.{key}, t.int_ix, sum(s.{value} * ({kernel})) AS y
  FROM (SELECT {key}, int_ix, k, (int_ix + {(window - 1) // 2} - k + count(*) OVER (PARTITION BY {key}, k))
      % count(*) OVER (PARTITION BY {key}, k) AS source_ix FROM {source} CROSS JOIN (SELECT unnest(range({window})) AS k)) t
  JOIN {source} s ON s.{key} = t.{key} AND s.int_ix = t.source_ix GROUP BY 1, 2)"""


def lowess_sql(name: str, source: str, key: str, frac: float, first: float = 6.0, value: str = "y", ix: str = "int_ix") -> str:
    """Dense form: every anchor against every slot, bandwidth from sorted distances."""
    parts = [f"""{name}_p AS MATERIALIZED (
  SELECT {key}, {ix} AS x, CAST({value} AS DOUBLE) AS y, count(*) OVER (PARTITION BY {key}) AS n, 1.0 AS keep FROM {source})""",
             f"""{name}_d AS MATERIALIZED (
  SELECT a.{key}, a.x AS a, p.x AS p, abs(a.x - p.x) AS d, a.n,
    row_number() OVER (PARTITION BY a.{key}, a.x ORDER BY abs(a.x - p.x)) - 1 AS nth
  FROM {name}_p a JOIN {name}_p p ON a.{key} = p.{key})""",
             f"""{name}_h AS MATERIALIZED (
  SELECT {key}, a, max(d) AS h FROM {name}_d WHERE nth = greatest(1, CAST(floor(n * {frac}) AS BIGINT)) GROUP BY 1, 2)""",
             f"""{name}_w AS MATERIALIZED (
  SELECT {key}, a, p, w / sum(w) OVER (PARTITION BY {key}, p) AS w FROM (
    SELECT d.{key}, d.a, d.p, pow(1 - pow(least(d.d / h.h, 1.0), 3), 3) AS w
    FROM {name}_d d JOIN {name}_h h ON d.{key} = h.{key} AND d.a = h.a WHERE d.d < h.h))"""]
    points = f"{name}_p"
    for i in (1, 2, 3):
        parts.append(f"""{name}_l{i} AS MATERIALIZED (
  SELECT {key}, a, CASE WHEN det > 1e-9 * s0 * s2c THEN (t0 - (s0 * t1 - s1 * t0) / det * s1) / s0
      WHEN s0 > 0 THEN t0 / s0 / (1 + pow(s1 / s0, 2)) ELSE 0 END AS b0,
    CASE WHEN det > 1e-9 * s0 * s2c THEN (s0 * t1 - s1 * t0) / det
      WHEN s0 > 0 THEN t0 / s0 / (1 + pow(s1 / s0, 2)) * s1 / s0 ELSE 0 END AS b1
  FROM (SELECT *, s0 * s2 - s1 * s1 AS det FROM (
    SELECT w.{key}, w.a, sum(w * keep) AS s0, sum(w * keep * x) AS s1, sum(w * keep * x * x) AS s2,
      sum(w * keep * y) AS t0, sum(w * keep * x * y) AS t1, greatest(sum(w * keep * (x - w.a) * (x - w.a)), 1e-12) AS s2c
    FROM {name}_w w JOIN {points} p ON p.{key} = w.{key} AND p.x = w.p GROUP BY 1, 2)))""")
        limit = first if i == 1 else 6.0
        parts.append(f"""{name}_f{i} AS MATERIALIZED (
  SELECT *, CASE WHEN res < 1e-9 OR res < sd * {limit} THEN 1.0 ELSE 0.0 END AS keep
  FROM (SELECT *, quantile_cont(res, 0.682) OVER (PARTITION BY {key}) AS sd
    FROM (SELECT p.{key}, p.x, p.y, f.fit, abs(p.y - f.fit) AS res FROM {points} p JOIN (
        SELECT w.{key}, w.p, sum(w.w * (l.b0 + l.b1 * w.p)) AS fit FROM {name}_w w
        JOIN {name}_l{i} l ON l.{key} = w.{key} AND l.a = w.a GROUP BY 1, 2) f ON f.{key} = p.{key} AND f.p = p.x)))""")
        points = f"{name}_f{i}"
    parts.append(f"{name} AS MATERIALIZED (SELECT {key}, x AS int_ix, fit AS y FROM {points})")
    return ",\n".join(parts)


register("outliers_spread", lambda spark, sf: sm.spread_outliers(
    series(spark, sf), ["product"], {"rps_spread": "rps"}).select("product", "int_ix", "rps_spread"),
    with_views(GEO, "SELECT product, int_ix, y AS rps_spread FROM spread",
               f"{SERIES},\n{spread_sql('spread', 'series', 'product', 'rps')}"), "rps_spread:8")

register("quantiles_clipped", lambda spark, sf: sm.clip_quantiles(
    series(spark, sf), ["product"], "rps", 0.001, 0.999).select("product", "int_ix", "rps"), with_views(GEO, """
SELECT product, int_ix, greatest(least(rps, quantile_cont(rps, 0.999) OVER (PARTITION BY product)),
  quantile_cont(rps, 0.001) OVER (PARTITION BY product)) AS rps FROM series""", SERIES), "rps:8")

for _name, _geometric in (("circular_mean", False), ("circular_exponential_mean", True)):
    register(_name, lambda spark, sf, g=_geometric: sm.circular_mean(
        series(spark, sf), ["product"], "int_ix", "rps", "smooth", 16, g).select("product", "int_ix", "smooth"),
        with_views(GEO, "SELECT product, int_ix, y AS smooth FROM c", SERIES + ",\n" + circular_sql(
            "c", "series", "product", "rps", 16, _geometric)), "smooth:8")


def cema_sql(source: str, key: str, window: int) -> str:
    """Weighted exponential then plain circular means of rps (weight sessions) and sessions (weight 1)."""
    return ",\n".join([
        spread_sql("sp_r", source, key, "rps"), spread_sql("sp_s", source, key, "sessions"),
        f"inp AS MATERIALIZED (SELECT s.{key}, s.int_ix, CAST(s.sessions AS DOUBLE) AS w, r.y * s.sessions AS xw, q.y AS s FROM {source} s "
        f"JOIN sp_r r USING ({key}, int_ix) JOIN sp_s q USING ({key}, int_ix))",
        circular_sql("e_xw", "inp", key, "xw", window, True), circular_sql("e_w", "inp", key, "w", window, True),
        circular_sql("e_s", "inp", key, "s", window, True),
        f"mid AS MATERIALIZED (SELECT i.{key}, i.int_ix, i.w, a.y / b.y * i.w AS xw, c.y AS s FROM inp i "
        f"JOIN e_xw a USING ({key}, int_ix) JOIN e_w b USING ({key}, int_ix) JOIN e_s c USING ({key}, int_ix))",
        circular_sql("m_xw", "mid", key, "xw", window, False), circular_sql("m_w", "mid", key, "w", window, False),
        circular_sql("m_s", "mid", key, "s", window, False),
        f"cema AS MATERIALIZED (SELECT {key}, int_ix, m_xw.y / m_w.y AS rps_cema, m_s.y AS sessions_cema FROM m_xw "
        f"JOIN m_w USING ({key}, int_ix) JOIN m_s USING ({key}, int_ix))"])


def modifier_sql(source: str, smooth: str, key: str, suffix: str) -> str:
    return f"""
SELECT s.*, CAST(1 AS INT) AS baseline, sessions_{suffix}, rps_{suffix}, avg(rps) OVER (PARTITION BY {key}) AS rps_{suffix}_mean,
  floor(rps_{suffix} / avg(rps) OVER (PARTITION BY {key}) * 20) / 20.0 AS rps_{suffix}_modifier
FROM {source} s JOIN {smooth} USING ({key}, int_ix)"""


register("modifiers_cema", lambda spark, sf: sm.add_modifiers(
    series(spark, sf), ["product"], "int_ix", "rps", "sessions", sm.cema_transform(), "cema"),
    with_views(GEO, modifier_sql("series", "cema", "product", "cema"), f"{SERIES},\n{cema_sql('series', 'product', 16)}"),
    "sessions_cema:7 rps_cema:7 rps_cema_mean:9")

LOWESS = ",\n".join([
    spread_sql("sp_rps", "series", "product", "rps"), spread_sql("sp_sessions", "series", "product", "sessions"),
    lowess_sql("low_rps", "sp_rps", "product", 0.03, 5.0), lowess_sql("low_sessions", "sp_sessions", "product", 0.03, 5.0),
    "low AS MATERIALIZED (SELECT product, int_ix, a.y AS rps_lowess, b.y AS sessions_lowess FROM low_rps a "
    "JOIN low_sessions b USING (product, int_ix))"])
register("modifiers_lowess", lambda spark, sf: sm.add_modifiers(
    series(spark, sf), ["product"], "int_ix", "rps", "sessions", sm.lowess_transform(), "lowess"),
    with_views(GEO, modifier_sql("series", "low", "product", "lowess"), f"{SERIES},\n{LOWESS}"),
    "sessions_lowess:6 rps_lowess:6 rps_lowess_mean:9")


def curves(spark, sf):
    return sm.add_modifiers(series(spark, sf), ["product"], "int_ix", "rps", "sessions", sm.cema_transform(), "cema")


# interval value and the slot it may be read from, per estimator
ESTIMATES = {"wavg": ("(b.wx - a.wx) / (b.w - a.w)", "a.i + 1"), "left": ("v.x", "a.i + 1"), "mid": ("v.x", "(a.i + b.i) // 2 + 1")}


def interval_sql(source: str, value: str, weight: str, keys: str, intervals_no: int = 7, estimator: str = "wavg") -> str:
    estimate, slot = ESTIMATES[estimator]
    rounds = [f"""pts AS MATERIALIZED (SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY hourofday) AS INT) AS i,
  hourofday, CAST({value} AS DOUBLE) AS x, CAST({weight} AS DOUBLE) AS w, count(*) OVER (PARTITION BY {keys}) AS n FROM {source})""",
              f"""pre AS MATERIALIZED (SELECT {keys}, n, i, hourofday, sum(w) OVER o AS w, sum(w * x) OVER o AS wx, sum(w * x * x) OVER o AS wxx
  FROM pts WINDOW o AS (PARTITION BY {keys} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT DISTINCT {keys}, n, CAST(0 AS INT), -1.0, 0.0, 0.0, 0.0 FROM pts)""",
              f"""costs AS MATERIALIZED (SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, a.i AS l, b.i AS r, a.n,
    {estimate} AS m, round_even(1e9 * ((b.wxx - a.wxx) - 2.0 * ({estimate}) * (b.wx - a.wx)
      + {estimate} * ({estimate}) * (b.w - a.w)) / t.wxx, 0) AS c
  FROM pre a JOIN pre b USING ({keys}) JOIN pre t ON {' AND '.join(f't.{k.strip()} = a.{k.strip()}' for k in keys.split(','))} AND t.i = a.n JOIN pts v ON {' AND '.join(f'v.{k.strip()} = a.{k.strip()}' for k in keys.split(','))} AND v.i = {slot}
  WHERE a.i < b.i)""",
              f"k0 AS MATERIALIZED (SELECT DISTINCT {keys}, CAST(n AS INT) AS l, "
              f"{{'e': CAST(0 AS DOUBLE), 'b': CAST([] AS INT[])}} AS best FROM pts)"]
    for i in range(1, intervals_no + 1):
        rounds.append(f"""k{i} AS MATERIALIZED (SELECT {keys}, l, min({{'e': c + best.e, 'b': [r] || best.b}}) AS best
  FROM costs JOIN (SELECT {keys}, l AS r, best FROM k{i - 1}) USING ({keys}, r) GROUP BY {keys}, l
  UNION ALL SELECT * FROM k0)""")
    rounds.append(f"fit AS MATERIALIZED (SELECT {keys}, best.b AS bounds, best.e / 1e9 * wxx AS error "
                  f"FROM k{intervals_no} JOIN (SELECT {keys}, wxx FROM pre WHERE i = n) USING ({keys}) WHERE l = 0)")
    return ",\n".join(rounds)


INTERVALS = interval_sql("mods", "rps_cema_modifier", "sessions_cema", "product, dayofweek")
MODS = f"{SERIES},\n{cema_sql('series', 'product', 16)},\nmods AS MATERIALIZED ({modifier_sql('series', 'cema', 'product', 'cema')})"
register("interval_fit", lambda spark, sf: intervals.interval_fit(
    curves(spark, sf), ["product", "dayofweek"], "hourofday", "rps_cema_modifier", "sessions_cema").select(
    "product", "dayofweek", F.concat_ws(",", F.col("bounds").cast("array<string>")).alias("bounds"), "error"),
    with_views(GEO, """
SELECT product, dayofweek, array_to_string(bounds, ',') AS bounds, error FROM fit""", f"{MODS},\n{INTERVALS}"), "error:6")

TABLE = """
SELECT f.product, f.dayofweek AS weekday_index, ['SUN', 'MON', 'TUE', 'WED', 'THR', 'FRI', 'SAT'][f.dayofweek + 1] AS weekday,
  CAST(f.no - 1 AS INT) AS interval_no, s.hourofday AS hr_start_inclusive, coalesce(e.hourofday, 24.0) AS hr_end_exclusive, c.m AS modifier
FROM (SELECT product, dayofweek, unnest(range(1, len(bounds) + 1)) AS no, unnest(bounds) AS r, unnest([0] || bounds[:-2]) AS l FROM fit) f
JOIN costs c ON c.product = f.product AND c.dayofweek = f.dayofweek AND c.l = f.l AND c.r = f.r
JOIN pts s ON s.product = f.product AND s.dayofweek = f.dayofweek AND s.i = f.l + 1
LEFT JOIN pts e ON e.product = f.product AND e.dayofweek = f.dayofweek AND e.i = f.r + 1"""
register("interval_table", lambda spark, sf: intervals.interval_table(
    curves(spark, sf), ["product"], "hourofday", "rps_cema_modifier", "sessions_cema"),
    with_views(GEO, TABLE, f"{MODS},\n{INTERVALS}"), "modifier:7")


def _interval_curve(spark, sf):
    mods = curves(spark, sf)
    table = intervals.interval_table(mods, ["product"], "hourofday", "rps_cema_modifier", "sessions_cema")
    return intervals.interval_curve(mods, table, ["product"], "hourofday", "rps_cema_modifier").select(
        "product", "dayofweek", "hourofday", "rps_cema_modifier", "rps_cema_modifier_interval")


register("interval_curve", _interval_curve, with_views(GEO, f"""
SELECT m.product, m.dayofweek, m.hourofday, m.rps_cema_modifier, t.modifier AS rps_cema_modifier_interval
FROM mods m JOIN ({TABLE}) t ON t.product = m.product AND t.weekday_index = m.dayofweek
  AND m.hourofday >= t.hr_start_inclusive AND m.hourofday < t.hr_end_exclusive""", f"{MODS},\n{INTERVALS}"),
         "rps_cema_modifier_interval:7")

for _estimator in ("left", "mid"):
    register(f"interval_fit_{_estimator}", lambda spark, sf, e=_estimator: intervals.interval_fit(
        curves(spark, sf), ["product", "dayofweek"], "hourofday", "rps_cema_modifier", "sessions_cema", 4, e).select(
        "product", "dayofweek", F.concat_ws(",", F.col("bounds").cast("array<string>")).alias("bounds"), "error"),
        with_views(GEO, """
SELECT product, dayofweek, array_to_string(bounds, ',') AS bounds, error FROM fit""", f"{MODS},\n" + interval_sql(
            "mods", "rps_cema_modifier", "sessions_cema", "product, dayofweek", 4, _estimator)), "error:6")

register("tod_interval_modifiers", lambda spark, sf: schedules.interval_modifiers(
    facts(spark, sf), "BING", "2024-01-31 00:00:00").withColumn(
        "calculation_date", F.date_format("calculation_date", "yyyy-MM-dd HH:mm:ss")).drop("modifier"), with_views(GEO, f"""
SELECT * EXCLUDE (modifier), 'BING' AS traffic_source, '2024-01-31 00:00:00' AS calculation_date FROM ({TABLE})""", ",\n".join([
    SERIES, LOWESS, f"mods AS MATERIALIZED ({modifier_sql('series', 'low', 'product', 'lowess')})",
    interval_sql("mods", "rps_lowess_modifier", "sessions_lowess", "product, dayofweek")])))

HOUR_LOWESS = ",\n".join([
    spread_sql("hp_r", "hours", "one", "rps"), spread_sql("hp_s", "hours", "one", "sessions"),
    lowess_sql("hl_r", "hp_r", "one", 0.03, 5.0), lowess_sql("hl_s", "hp_s", "one", 0.03, 5.0),
    "hlow AS MATERIALIZED (SELECT one, int_ix, a.y AS rps_lowess, b.y AS sessions_lowess FROM hl_r a JOIN hl_s b USING (one, int_ix))"])
register("tod_hourly_curves", lambda spark, sf: schedules.hourly_curves(facts(spark, sf)).select(
    "dayofweek", "hourofday", "sessions", "rps_cema", "sessions_cema", "rps_cema_modifier", "rps_lowess", "sessions_lowess",
    "rps_lowess_modifier"), with_views(GEO, f"""
SELECT dayofweek, hourofday, sessions, rps_cema, sessions_cema, floor(rps_cema / avg(rps) OVER () * 20) / 20.0 AS rps_cema_modifier,
  rps_lowess, sessions_lowess, floor(rps_lowess / avg(rps) OVER () * 20) / 20.0 AS rps_lowess_modifier
FROM hours JOIN cema USING (one, int_ix) JOIN hlow USING (one, int_ix)""", f"{HOURS},\n{cema_sql('hours', 'one', 4)},\n{HOUR_LOWESS}"),
         "rps_cema:7 sessions_cema:7 rps_lowess:6 sessions_lowess:6")


def _schedule_rows(spark, sf):
    """The published JSON read back, one row per entry."""
    schedule = schedules.hourly_schedule(schedules.hourly_curves(facts(spark, sf)), "2024-01-31")
    parsed = F.from_json("schedule", "day array<int>, hour array<double>, bid_modifier array<double>")
    return schedule.select("date", F.inline(F.arrays_zip(parsed["day"], parsed["hour"], parsed["bid_modifier"]))).toDF(
        "date", "day", "hour", "bid_modifier")


register("tod_hourly_schedule", _schedule_rows, with_views(GEO, """
SELECT DATE '2024-01-31' AS date, dayofweek AS day, hourofday AS hour, floor(rps_cema / avg(rps) OVER () * 20) / 20.0 AS bid_modifier
FROM hours JOIN cema USING (one, int_ix)""", f"{HOURS},\n{cema_sql('hours', 'one', 4)}"))


def bag_curves(spark, sf):
    return schedules.bag_curves(facts(spark, sf), ["product"])


BAG = ",\n".join([
    SPLIT, """capped AS MATERIALIZED (
  SELECT * REPLACE (least(bag_rps, quantile_cont(bag_rps, 0.99) OVER (PARTITION BY product)) AS bag_rps)
  FROM (SELECT * REPLACE (coalesce(bag_rps, 0.0) AS bag_rps) FROM split))""",
    lowess_sql("bl_r", "capped", "product", 0.03, 5.0, "bag_rps", "ix"), lowess_sql("bl_s", "capped", "product", 0.03, 6.0, "sessions", "ix"),
    """curve AS MATERIALIZED (SELECT c.product, c.weekday, c.hourofday, c.hourfraction, r.y AS rps_fit, s.y AS sessions_fit,
  r.y / (sum(r.y * s.y) OVER (PARTITION BY c.product) / sum(s.y) OVER (PARTITION BY c.product)) AS modifier
  FROM capped c JOIN bl_r r ON r.product = c.product AND r.int_ix = c.ix JOIN bl_s s ON s.product = c.product AND s.int_ix = c.ix)"""])
register("bag_curves", lambda spark, sf: bag_curves(spark, sf).select(
    "product", "weekday", "hourofday", "hourfraction", "rps_fit", "sessions_fit", "modifier"),
    with_views(GEO, "SELECT * FROM curve", BAG), "hourfraction:2 rps_fit:6 sessions_fit:6 modifier:6")


def _weekly(spark, sf):
    week = schedules.weekly_schedule(bag_curves(spark, sf), ["product"], "weekday", "hourofday", "hourfraction", "modifier")
    days = week.select("product", F.posexplode("schedule").alias("day", "hours"))
    return days.select("product", "day", F.posexplode("hours").alias("hour_no", "quarters")).select(
        "product", "day", "hour_no", F.size("quarters").alias("quarters"),
        F.aggregate("quarters", F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0))).alias("total"))


register("tod_weekly_schedule", _weekly, with_views(GEO, """
SELECT p.product, CAST(d.day AS INT) AS day, CAST(h.hour AS INT) AS hour_no, CAST(4 AS INT) AS quarters, coalesce(sum(modifier), 0.0) AS total
FROM (SELECT DISTINCT product FROM curve) p CROSS JOIN (SELECT unnest(range(7)) AS day) d CROSS JOIN (SELECT unnest(range(24)) AS hour) h
LEFT JOIN curve c ON c.product = p.product AND (c.weekday + 6) % 7 = d.day AND c.hourofday = h.hour GROUP BY 1, 2, 3""", BAG), "total:5")

SPLINE = """spl_n AS MATERIALIZED (SELECT product, int_ix, CAST(rps AS DOUBLE) AS y, count(*) OVER (PARTITION BY product) AS n FROM series),
spl_c AS MATERIALIZED (SELECT product, f, n, sum(y * (CASE WHEN f = 0 THEN sqrt(1.0 / n) ELSE sqrt(2.0 / n) END) * cos(pi() * f * (int_ix + 0.5) / n)) AS c,
    pow(2 - 2 * cos(pi() * f / n), 2) AS g
  FROM (SELECT *, unnest(range(n)) AS f FROM spl_n) GROUP BY product, f, n),
spl_r AS (SELECT product, rung, sum(pow(c * pow(2, rung / 4.0) * g / (1 + pow(2, rung / 4.0) * g), 2)) AS rss
  FROM spl_c CROSS JOIN (SELECT unnest(range(-80, 161)) AS rung) GROUP BY 1, 2),
spl_b AS (SELECT product, max(rung) AS rung FROM spl_r WHERE rss <= 60000 GROUP BY 1)"""
register("smoothing_spline", lambda spark, sf: sm.smoothing_spline(
    series(spark, sf), ["product"], "int_ix", "rps", "rps_spline", 60000.0).select("product", "int_ix", "rps_spline"),
    with_views(GEO, """
SELECT s.product, s.int_ix, sum(c / (1 + pow(2, rung / 4.0) * g) * (CASE WHEN f = 0 THEN sqrt(1.0 / s.n) ELSE sqrt(2.0 / s.n) END)
  * cos(pi() * f * (s.int_ix + 0.5) / s.n)) AS rps_spline
FROM spl_n s JOIN spl_c c ON c.product = s.product JOIN spl_b b ON b.product = s.product GROUP BY 1, 2""",
               f"{SERIES},\n{SPLINE}"), "rps_spline:6")

# of degree 0 a spline is the mean of each segment
register("regression_spline_means", lambda spark, sf: sm.regression_spline(
    series(spark, sf), ["product"], "int_ix", "rps", "rps_means", 0, 60000.0).select("product", "int_ix", "rps_means"),
    with_views(GEO, """
SELECT product, int_ix, avg(y) OVER (PARTITION BY product, rung, segment) AS rps_means
FROM rung_rows JOIN (SELECT product, min(rung) AS rung FROM (
  SELECT product, rung, sum(pow(y - mean, 2)) AS lost FROM (SELECT *, avg(y) OVER (PARTITION BY product, rung, segment) AS mean FROM rung_rows) GROUP BY 1, 2)
  WHERE lost <= 60000 GROUP BY 1) USING (product, rung)""", f"""{SERIES},
rung_rows AS MATERIALIZED (SELECT product, int_ix, y, rung, least(CAST(floor((int_ix - low) * pow(2, rung) / (high - low)) AS INT), CAST(pow(2, rung) AS INT) - 1) AS segment
  FROM (SELECT product, int_ix, CAST(rps AS DOUBLE) AS y, min(int_ix) OVER (PARTITION BY product) AS low, max(int_ix) OVER (PARTITION BY product) AS high,
    count(*) OVER (PARTITION BY product) AS places FROM series) CROSS JOIN (SELECT unnest(range(11)) AS rung) WHERE rung = 0 OR pow(2, rung) <= places)"""), "rps_means:6")
register("tod_spline_of_degree", lambda spark, sf: schedules.spline_schedule(series(spark, sf), ["product"], 60000.0, 3000.0, degree=3).select(
    "product", "dayofweek", "hourofday", "modifier", "modifier_75", "modifier_5", "modifier_25", "baseline"))

register("tod_spline_schedule", lambda spark, sf: schedules.spline_schedule(series(spark, sf), ["product"], 60000.0, 3000.0).select(
    "product", "dayofweek", "hourofday", "modifier", "modifier_75", "modifier_5", "modifier_25", "baseline"))
