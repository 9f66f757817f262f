"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and DuckDB twins ``ORACLE``.

Every query reads whole driver tables through the adapters of ``sources.fixtures``. Floating
results are rounded on both sides (sums are order-dependent; the check hashes values).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoforge.functions import columns as cols
from chronoforge.operators import baseline as bl
from chronoforge.operators import compare as cmp
from chronoforge.operators import diagnostics as dg
from chronoforge.operators import features as feat
from chronoforge.operators import gram as gm
from chronoforge.operators import linear as lin
from chronoforge.operators import linear_keyed as lk
from chronoforge.operators import sequence as seq
from chronoforge.operators import split as spl
from chronoforge.operators import stats as st
from chronoforge.operators import trees as tr
from chronoforge.operators import unitroot as ur
from chronoforge.operators import windows as win
from chronoforge.sources import fixtures as fx
from chronoforge.sources import io as sio
from chronoforge.sources import stored
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (the oracle rounds the same columns)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


# ------------------------------------------------------------------------------------------
# SQL building blocks for the oracle (DuckDB dialect)
# ------------------------------------------------------------------------------------------

EVENTS_HOURLY_SQL = """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time,
       round(avg(value), 4) AS temperature_2m,
       round(avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 4) AS relative_humidity_2m,
       CAST(count(*) AS DOUBLE) AS wind_speed_10m
FROM events GROUP BY 1
"""

ORDERS_DAILY_SQL = """
SELECT o_orderpriority AS series, o_orderdate AS time, round(sum(o_totalprice), 2) AS y,
       CAST(count(*) AS DOUBLE) AS x1,
       ((sum(CAST(round(o_totalprice * 100) AS BIGINT)) * 200 + count(*)) // (2 * count(*))) / 10000.0 AS x2
FROM orders GROUP BY 1, 2
"""


def _feature_select_sql(src: str, window: str = "ORDER BY time") -> str:
    cols = [f"lead({feat.TARGET}, {feat.HORIZON}) OVER w AS {feat.TARGET}_target"]
    names = [f"{feat.TARGET}_target"]
    for col, ks in feat.LAGS.items():
        for k in ks:
            cols.append(f"lag({col}, {k}) OVER w AS {col}_lag_{k}")
            names.append(f"{col}_lag_{k}")
    return (f"SELECT * FROM (SELECT *, {', '.join(cols)} FROM ({src}) s WINDOW w AS ({window})) f "
            f"WHERE {' AND '.join(n + ' IS NOT NULL' for n in names)}")


def _r(expr: str, name: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits}) AS {name}"


# ------------------------------------------------------------------------------------------
# 1. Feature table
# ------------------------------------------------------------------------------------------


@register("features", f"""
SELECT time, {', '.join(f'round({c}, {DIGITS}) AS {c}' for c in
    ['temperature_2m', 'relative_humidity_2m', 'wind_speed_10m', 'temperature_2m_target'] +
    [f'{col}_lag_{k}' for col, ks in feat.LAGS.items() for k in ks])}
FROM ({_feature_select_sql(EVENTS_HOURLY_SQL)}) q
""")
def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feat.build_features(fx.events_hourly(spark, sf_dir)))


# ------------------------------------------------------------------------------------------
# 2. Sequence operators on raw / keyed series
# ------------------------------------------------------------------------------------------


@register("dedupe_first", """
SELECT time, o_orderkey, round(y, 6) AS y, o_custkey, o_orderpriority FROM (
  SELECT o_orderdate AS time, o_orderkey, o_totalprice AS y, o_custkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS rn
  FROM orders) WHERE rn = 1
""")
def q_dedupe_first(spark, sf_dir):
    return rounded(seq.dedupe_first(fx.orders_raw(spark, sf_dir), [], "time", tiebreak="o_orderkey"))


@register("target_lead", """
SELECT series, time, idx, round(y, 6) AS y, round(y_target, 6) AS y_target FROM (
  SELECT event_type AS series, ts AS time, value AS y,
         row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS idx,
         lead(value, 3) OVER (PARTITION BY event_type ORDER BY ts) AS y_target
  FROM events)
""")
def q_target_lead(spark, sf_dir):
    ev = fx.events_raw(spark, sf_dir).select("series", "time", "y")
    return rounded(seq.add_target(ev, "y", 3, keys=["series"]))


LAG_SPEC = [1, 2, 36]


@register("lag_features", f"""
SELECT time, idx, round(y, 6) AS y, round(x, 6) AS x,
  {', '.join(f'round(y_lag_{k}, 6) AS y_lag_{k}, round(x_lag_{k}, 6) AS x_lag_{k}' for k in LAG_SPEC)}
FROM (
  SELECT ts AS time, value AS y, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x,
         row_number() OVER w - 1 AS idx,
         {', '.join(f"lag(value, {k}) OVER w AS y_lag_{k}, lag(CAST(json_extract_string(props, '$.k') AS DOUBLE), {k}) OVER w AS x_lag_{k}" for k in LAG_SPEC)}
  FROM events WINDOW w AS (ORDER BY ts))
""")
def q_lag_features(spark, sf_dir):
    ev = fx.events_raw(spark, sf_dir, keyed=False).select("time", "y", "x")
    specs = [(f"{c}_lag_{k}", c, k) for k in LAG_SPEC for c in ("y", "x")]
    # a small block makes the single 10k-row series span many chunks (halo path exercised)
    return rounded(seq.shift_columns(ev, specs, [], "time", block_size=512))


@register("calendar_features", f"""
SELECT time, CAST(isodow(time) - 1 AS INTEGER) AS dayofweek, CAST(month(time) AS INTEGER) AS month,
       CAST(hour(time) AS INTEGER) AS hour,
       round(sin(2 * pi() * hour(time) / 24), {DIGITS}) + 0.0 AS sin_comp,
       round(cos(2 * pi() * hour(time) / 24), {DIGITS}) + 0.0 AS cos_comp
FROM ({EVENTS_HOURLY_SQL}) h
""")
def q_calendar_features(spark, sf_dir):
    h = fx.events_hourly(spark, sf_dir).select("time")
    return rounded(cols.calendar_features(h))


# ------------------------------------------------------------------------------------------
# 3. Holdouts and splits on the keyed daily series
# ------------------------------------------------------------------------------------------

@register("month_holdout", f"""
SELECT series, time, CASE WHEN month(time) = 6 THEN 'predict' ELSE 'train' END AS part
FROM ({ORDERS_DAILY_SQL}) d
""")
def q_month_holdout(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return cols.month_holdout(d, 6)


@register("holdout_leadin", f"""
WITH d AS ({ORDERS_DAILY_SQL}),
f AS (SELECT series, min(time) AS first FROM d WHERE month(time) = 6 GROUP BY series)
SELECT d.series, d.time,
  CASE WHEN month(d.time) = 6 THEN 'predict'
       WHEN d.time >= f.first - INTERVAL 48 HOUR AND d.time < f.first THEN 'predict'
       ELSE 'train' END AS part
FROM d LEFT JOIN f ON d.series = f.series
""")
def q_holdout_leadin(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return cols.holdout_with_leadin(d, 6, 48, keys=["series"])


def _indexed_daily_sql(label: str) -> str:
    return f"""
WITH d AS ({ORDERS_DAILY_SQL}),
i AS (SELECT series, time, row_number() OVER (PARTITION BY series ORDER BY time) - 1 AS idx,
             count(*) OVER (PARTITION BY series) AS n FROM d)
SELECT series, time, idx, n, {label} FROM i
"""


@register("split_80_20", _indexed_daily_sql(
    "CASE WHEN idx < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split"))
def q_split_80_20(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return spl.split_train_test(d, keys=["series"])


@register("split_three_way", _indexed_daily_sql("""
CASE WHEN idx < floor(CAST(0.85 AS DOUBLE) * floor(CAST(0.8 AS DOUBLE) * n)) THEN 'train'
     WHEN idx < floor(CAST(0.8 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split"""))
def q_split_three_way(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return spl.split_three_way(d, keys=["series"])


@register("last_block", _indexed_daily_sql(
    "CASE WHEN idx < floor(CAST(0.85 AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split"))
def q_last_block(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return spl.split_last_block(d, keys=["series"])


@register("expanding_folds", _indexed_daily_sql("""
CASE WHEN n // 6 > 0 THEN greatest(-1, CAST(floor((idx - (n - 5 * (n // 6))) / (n // 6)) AS BIGINT)) END AS block"""))
def q_expanding_folds(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return spl.expanding_folds(d, keys=["series"])


def _prefix_sql() -> str:
    fr = spl.learning_fractions()
    m = "(n - 5 * (n // 6))"
    sizes = [f"least(greatest(CAST(floor(CAST({f!r} AS DOUBLE) * {m}) AS BIGINT), 1), {m})" for f in fr]
    whens = " ".join(f"WHEN idx < {s} THEN {j}" for j, s in enumerate(sizes))
    return f"CASE {whens} END AS prefix"


@register("learning_prefixes", _indexed_daily_sql(_prefix_sql()))
def q_learning_prefixes(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time")
    return spl.learning_prefixes(d, keys=["series"])


# ------------------------------------------------------------------------------------------
# 4. Profiles and descriptive statistics
# ------------------------------------------------------------------------------------------

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, "
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'value' else ''}) AS missing, "
    f"count(*) - count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'value' else ''}) AS present "
    f"FROM events" for c in EVENT_COLS))
def q_null_profile(spark, sf_dir):
    return st.null_profile(fx.table(spark, sf_dir, "events"))


GRAM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("numeric_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, round(avg({c}), {DIGITS}) AS mean, "
    f"round(median({c}), {DIGITS}) AS median, round(stddev_samp({c}), {DIGITS}) AS std, "
    f"round(skewness({c}), {DIGITS}) AS skewness, round(kurtosis({c}), {DIGITS}) AS kurtosis, "
    f"count(*) - count({c}) AS missing FROM lineitem" for c in GRAM_COLS))
def q_numeric_profile(spark, sf_dir):
    return rounded(st.numeric_profile(fx.lineitem_gram(spark, sf_dir), GRAM_COLS))


HOURLY_COLS = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m"]


def _long_hourly_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM h WHERE {c} IS NOT NULL"
                              for c in HOURLY_COLS)


@register("histogram", f"""
WITH h AS ({EVENTS_HOURLY_SQL}), l AS ({_long_hourly_sql()}),
r AS (SELECT "column", CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo0,
             CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi0
      FROM l GROUP BY 1),
b0 AS (SELECT l."column", value, lo0, hi0, (hi0 - lo0) / CAST(30 AS DOUBLE) AS step,
              least(CAST(floor((value - lo0) * (CAST(30 AS DOUBLE) / (hi0 - lo0))) AS INTEGER), 29) AS b0
       FROM l JOIN r ON l."column" = r."column"),
b1 AS (SELECT *, CASE WHEN value < b0 * step + lo0 THEN b0 - 1 ELSE b0 END AS b1 FROM b0),
b2 AS (SELECT *, CASE WHEN b1 <> 29 AND value >= CASE WHEN b1 + 1 >= 30 THEN hi0 ELSE (b1 + 1) * step + lo0 END
                      THEN b1 + 1 ELSE b1 END AS bin FROM b1),
c AS (SELECT "column", CAST(bin AS INTEGER) AS bin, count(*) AS cnt FROM b2 GROUP BY 1, 2),
g AS (SELECT "column", lo0, hi0, CAST(b AS INTEGER) AS bin FROM r, range(0, 30) t(b))
SELECT g."column", g.bin, round(bin * ((hi0 - lo0) / CAST(30 AS DOUBLE)) + lo0, {DIGITS}) AS lo,
       round(CASE WHEN bin + 1 >= 30 THEN hi0 ELSE (bin + 1) * ((hi0 - lo0) / CAST(30 AS DOUBLE)) + lo0 END, {DIGITS}) AS hi,
       coalesce(cnt, 0) AS count
FROM g LEFT JOIN c USING ("column", bin)
""")
def q_histogram(spark, sf_dir):
    return rounded(st.histogram(fx.events_hourly(spark, sf_dir), HOURLY_COLS, bins=30))


@register("boxplot_stats", f"""
WITH h AS ({EVENTS_HOURLY_SQL}), l AS ({_long_hourly_sql()}),
s AS (SELECT "column", count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.25) AS q1,
             quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY 1),
w AS (SELECT l."column", coalesce(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), any_value(q1)) AS whislo,
             coalesce(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), any_value(q3)) AS whishi
      FROM l JOIN s ON l."column" = s."column" GROUP BY 1),
o AS (SELECT l."column", count(*) FILTER (WHERE value < whislo OR value > whishi) AS n_outliers
      FROM l JOIN w ON l."column" = w."column" GROUP BY 1)
SELECT s."column", n, round(mean, {DIGITS}) AS mean, round(q1, {DIGITS}) AS q1, round(median, {DIGITS}) AS median,
       round(q3, {DIGITS}) AS q3, round(q3 - q1, {DIGITS}) AS iqr, round(whislo, {DIGITS}) AS whislo,
       round(whishi, {DIGITS}) AS whishi,
       round(median - 1.57 * (q3 - q1) / sqrt(n), {DIGITS}) AS notch_lo,
       round(median + 1.57 * (q3 - q1) / sqrt(n), {DIGITS}) AS notch_hi, n_outliers
FROM s JOIN w USING ("column") JOIN o USING ("column")
""")
def q_boxplot_stats(spark, sf_dir):
    return rounded(st.boxplot_stats(fx.events_hourly(spark, sf_dir), HOURLY_COLS))


# ------------------------------------------------------------------------------------------
# 5. Diagnostics: ACF, PACF, cross-correlation
# ------------------------------------------------------------------------------------------


def R(expr: str, digits: int = DIGITS) -> str:
    """Rounded value without negative zero (Spark's round never yields -0.0)."""
    return f"(round({expr}, {digits}) + 0.0)"


ACF_CTE = f"""
WITH RECURSIVE h AS ({EVENTS_HOURLY_SQL}),
i AS (SELECT row_number() OVER (ORDER BY time) - 1 AS idx, temperature_2m - avg(temperature_2m) OVER () AS xc
      FROM h WHERE temperature_2m IS NOT NULL),
p AS (SELECT l.lag, sum(a.xc * b.xc) AS s, count(*) AS c
      FROM range(0, 41) l(lag) JOIN i a ON true JOIN i b ON b.idx = a.idx - l.lag GROUP BY l.lag),
r AS (SELECT lag, s / max(CASE WHEN lag = 0 THEN s END) OVER () AS acf,
             max(CASE WHEN lag = 0 THEN c END) OVER () AS n FROM p)"""


@register("acf", ACF_CTE + f""",
b AS (SELECT *, coalesce(sum(CASE WHEN lag >= 1 THEN acf * acf ELSE 0 END)
                 OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum FROM r)
SELECT CAST(lag AS INTEGER) AS lag, {R('acf')} AS acf,
       {R(f'CASE WHEN lag = 0 THEN 0 ELSE {dg.Z975} * sqrt((1 + 2 * cum) / n) END')} AS band, n
FROM b
""")
def q_acf(spark, sf_dir):
    return rounded(dg.acf(fx.events_hourly(spark, sf_dir), "temperature_2m", 40))


# Durbin-Levinson recursion over the autocorrelation list (1-based lists: rl.r[k+1] = r_k)
PACF_SQL = ACF_CTE + f""",
rl AS (SELECT list(acf ORDER BY lag) AS r, max(n) AS n, count(*) - 1 AS kmax FROM r),
dl(k, phi, pk) AS (
  SELECT 1, [r[2]], r[2] FROM rl
  UNION ALL
  SELECT d.k + 1,
         list_concat(list_transform(range(1, d.k + 1), lambda j: d.phi[j] - nx.pk * d.phi[d.k + 1 - j]), [nx.pk]),
         nx.pk
  FROM dl d, rl,
       LATERAL (SELECT (rl.r[d.k + 2] - list_sum(list_transform(range(1, d.k + 1), lambda j: d.phi[j] * rl.r[d.k + 2 - j])))
                       / (1 - list_sum(list_transform(range(1, d.k + 1), lambda j: d.phi[j] * rl.r[j + 1]))) AS pk) nx
  WHERE d.k < rl.kmax)
SELECT CAST(0 AS INTEGER) AS lag, 1.0 AS pacf, 0.0 AS band, n FROM rl
UNION ALL
SELECT CAST(dl.k AS INTEGER) AS lag, {R("pk")} AS pacf, {R(f'{dg.Z975} / sqrt(n)')} AS band, n FROM dl, rl
"""


@register("pacf", PACF_SQL)
def q_pacf(spark, sf_dir):
    a = dg.acf(fx.events_hourly(spark, sf_dir), "temperature_2m", 40)
    return rounded(dg.pacf(a))


def _ccf_sql(src: str, y: str, x: str, keys: list[str], lags: int = 100, h: int = 3) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    kc = "".join(f"{k}, " for k in keys)
    on = "".join(f" AND b.{k} = a.{k}" for k in keys)
    gk = "".join(f"g.{k}, " for k in keys)
    gon = " AND ".join([f"g.{k} = p.{k}" for k in keys] + ["g.lag = p.lag"])
    grid_src = f"(SELECT DISTINCT {', '.join(keys)} FROM i)" if keys else "(SELECT 1 AS one)"
    return f"""
WITH s AS (SELECT {kc}time, {y} AS y, {x} AS x FROM ({src}) q WHERE {y} IS NOT NULL AND {x} IS NOT NULL),
i AS (SELECT {kc}row_number() OVER ({part}ORDER BY time) - 1 AS idx, y, x FROM s),
p AS (SELECT {''.join(f'a.{k}, ' for k in keys)}l.lag, corr(a.x, b.y) AS r, count(*) AS n
      FROM range(0, {lags + 1}) l(lag) JOIN i a ON true JOIN i b ON b.idx = a.idx + l.lag + {h}{on}
      GROUP BY {''.join(f'a.{k}, ' for k in keys)}l.lag),
g AS (SELECT {kc}CAST(l.lag AS BIGINT) AS lag FROM {grid_src} k, range(0, {lags + 1}) l(lag)),
o AS (SELECT {gk}g.lag, CASE WHEN coalesce(p.n, 0) >= 10 THEN p.r END AS r, coalesce(p.n, 0) AS n
      FROM g LEFT JOIN p ON {gon})
SELECT {kc}CAST(lag AS INTEGER) AS lag, {R('r')} AS correlation, n,
       {R(f'1.96 / sqrt(min(n) OVER ({part.strip()}))')} AS conf FROM o
"""


@register("cross_correlation", " UNION ALL ".join(
    f"SELECT '{x}' AS variable, * FROM ({_ccf_sql(EVENTS_HOURLY_SQL, 'temperature_2m', x, [])})"
    for x in ["relative_humidity_2m", "wind_speed_10m"]))
def q_cross_correlation(spark, sf_dir):
    h = fx.events_hourly(spark, sf_dir)
    xs = ["relative_humidity_2m", "wind_speed_10m"]
    return rounded(dg.cross_correlation_many(h, "temperature_2m", xs, 100, 3))


@register("cross_correlation_keyed", _ccf_sql(
    "SELECT event_type AS series, ts AS time, value AS y, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x FROM events",
    "y", "x", ["series"]))
def q_cross_correlation_keyed(spark, sf_dir):
    ev = fx.events_raw(spark, sf_dir).select("series", "time", "y", "x")
    return rounded(dg.cross_correlation(ev, "y", "x", 100, 3, keys=["series"]))


# ------------------------------------------------------------------------------------------
# 6. Forecast metrics on the naive forecasts of the feature table (SQL-checkable)
# ------------------------------------------------------------------------------------------

TGT = f"{feat.TARGET}_target"
FEATURES_SQL = _feature_select_sql(EVENTS_HOURLY_SQL)


@register("residuals", f"""
SELECT time, {R(TGT)} AS actual, {R(feat.TARGET)} AS prediction, {R(f'{TGT} - {feat.TARGET}')} AS error,
       {R(f'abs({TGT} - {feat.TARGET})')} AS abs_error
FROM ({FEATURES_SQL}) f
""")
def q_residuals(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    s = f.select("time", F.col(TGT).alias("actual"), F.col(feat.TARGET).alias("prediction"))
    return rounded(cols.residuals(cols.actual_present(s, "actual"), "actual"))


@register("regression_metrics", f"""
SELECT {R(f'sqrt(avg(({TGT} - {feat.TARGET}) ^ 2))')} AS rmse, {R(f'avg(abs({TGT} - {feat.TARGET}))')} AS mae,
       {R(f'avg(abs({TGT} - {feat.TARGET}) / (abs({TGT}) + 1e-8)) * 100')} AS mape, count(*) AS n
FROM ({FEATURES_SQL}) f
""")
def q_regression_metrics(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    return rounded(st.regression_metrics(f, TGT, feat.TARGET))


@register("error_summary", f"""
SELECT {R(f'avg({TGT} - {feat.TARGET})')} AS error_mean, {R(f'stddev_samp({TGT} - {feat.TARGET})')} AS error_std,
       {R(f'least(min({TGT}), min({feat.TARGET}))')} AS range_min,
       {R(f'greatest(max({TGT}), max({feat.TARGET}))')} AS range_max, count(*) AS n
FROM ({FEATURES_SQL}) f
""")
def q_error_summary(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    return rounded(st.error_summary(f, TGT, feat.TARGET))


DAILY = f"{feat.TARGET}_lag_24"


@register("skill", f"""
WITH m AS (SELECT sqrt(avg(({TGT} - {feat.TARGET}) ^ 2)) AS ra, avg(abs({TGT} - {feat.TARGET})) AS ma,
                  sqrt(avg(({TGT} - {DAILY}) ^ 2)) AS rb, avg(abs({TGT} - {DAILY})) AS mb
           FROM ({FEATURES_SQL}) f)
SELECT {R('ra')} AS rmse_persistence, {R('ma')} AS mae_persistence, {R('rb')} AS rmse_daily,
       {R('mb')} AS mae_daily, {R('1 - ra / rb')} AS skill_rmse_vs_daily, {R('1 - ma / mb')} AS skill_mae_vs_daily
FROM m
""")
def q_skill(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    return rounded(st.skill_scores(f, TGT, feat.TARGET, DAILY, names=("persistence", "daily")))


@register("comparison_table", f"""
SELECT time, {R(TGT)} AS actual, {R(feat.TARGET)} AS pred_persistence, {R(DAILY)} AS pred_daily,
       {R(f'{TGT} - {feat.TARGET}')} AS error_persistence, {R(f'{TGT} - {DAILY}')} AS error_daily
FROM ({FEATURES_SQL}) f
""")
def q_comparison_table(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    a = f.select("time", F.col(TGT).alias("actual"), F.col(feat.TARGET).alias("prediction"))
    b = f.select("time", F.col(TGT).alias("actual"), F.col(DAILY).alias("prediction"))
    return rounded(cmp.comparison_table(a, b, "actual", ("persistence", "daily"), on=["time"]))


NAIVE = [feat.TARGET, f"{feat.TARGET}_lag_1", f"{feat.TARGET}_lag_2", f"{feat.TARGET}_lag_3", DAILY]


@register("leaderboard", f"""
WITH m AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS model, sqrt(avg(({TGT} - {c}) ^ 2)) AS rmse, avg(abs({TGT} - {c})) AS mae FROM ({FEATURES_SQL}) f"
    for c in NAIVE)})
SELECT CAST(row_number() OVER (ORDER BY rmse, model) AS INTEGER) AS rank, model, {R('rmse')} AS rmse, {R('mae')} AS mae FROM m
""")
def q_leaderboard(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    long = f.select(TGT, *NAIVE).unpivot([TGT], NAIVE, "model", "prediction")
    m = st.regression_metrics(long, TGT, "prediction", group=["model"]).select("model", "rmse", "mae")
    return rounded(cmp.leaderboard(m, "rmse"))


@register("topk", """
SELECT series, time, y, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY y DESC, time) AS rk
  FROM (SELECT o_orderpriority AS series, o_orderdate AS time, round(sum(o_totalprice), 2) AS y
        FROM orders GROUP BY 1, 2)) WHERE rk <= 3
""")
def q_topk(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir).select("series", "time", "y")
    return cmp.top_k(d, "y", 3, keys=["series"], tiebreak="time")


@register("history_summary", f"""
SELECT series, max(time) AS last_step, {R('arg_max(y, time)')} AS last_value, {R('min(y)')} AS best_value,
       first(time ORDER BY y, time) AS best_step, count(*) AS steps
FROM ({ORDERS_DAILY_SQL}) d GROUP BY series
""")
def q_history_summary(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir)
    return rounded(st.history_summary(d, ["series"], step="time", value="y"))


# ------------------------------------------------------------------------------------------
# 7. Gram matrix, scaling and linear models
# ------------------------------------------------------------------------------------------


def _gram_sql() -> str:
    sel = []
    for i, a in enumerate(GRAM_COLS):
        for j, b in enumerate(GRAM_COLS):
            sel.append(f"""SELECT {i} AS i, {j} AS j, '{a}' AS feature_i, '{b}' AS feature_j, count(*) AS n,
  {R(f'avg({a})')} AS mean_i, {R(f'avg({b})')} AS mean_j,
  {R(f'covar_pop({a}, {b})', 2)} AS cov, {R(f'corr({a}, {b})')} AS corr FROM lineitem""")
    return " UNION ALL ".join(sel)


@register("gram", _gram_sql())
def q_gram(spark, sf_dir):
    g = gm.gram_long(fx.lineitem_gram(spark, sf_dir), GRAM_COLS)
    return rounded(g.withColumn("cov", F.round("cov", 2)))


@register("standardize", f"""
SELECT l_shipdate, l_returnflag, {', '.join(
    f"{R(f'({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END')} AS {c}_z"
    for c in GRAM_COLS)}
FROM lineitem
""")
def q_standardize(spark, sf_dir):
    li = fx.lineitem_gram(spark, sf_dir)
    out, _ = lin.standardize(li, GRAM_COLS, suffix="_z")
    return rounded(out.select("l_shipdate", "l_returnflag", *[f"{c}_z" for c in GRAM_COLS]))


def hourly_grid(spark: SparkSession, sf_dir: str) -> lin.GridResult:
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    design, feats = lin.prepare_design(f, TGT)
    return lin.linear_grid_search(design, feats, TGT)


@register("linear_grid")
def q_linear_grid(spark, sf_dir):
    return lin.results_frame(spark, hourly_grid(spark, sf_dir).results)


@register("ridge_path")
def q_ridge_path(spark, sf_dir):
    rows = lin.ridge_path(hourly_grid(spark, sf_dir))
    return spark.createDataFrame(rows, "alpha double, feature string, coef double")


@register("ridge_error_curve")
def q_ridge_error_curve(spark, sf_dir):
    rows = lin.ridge_error_curve(hourly_grid(spark, sf_dir))
    return spark.createDataFrame(rows, "alpha double, bias2 double, variance double, test_error double")


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    g = hourly_grid(spark, sf_dir)
    best = min(g.results, key=lambda r: r["test_rmse"])["model"]
    rows = lin.learning_curve(g, g.models[best])
    return spark.createDataFrame(rows, "train_size long, train_rmse_mean double, train_rmse_std double, "
                                       "cv_rmse_mean double, cv_rmse_std double")


@register("linear_scoring")
def q_linear_scoring(spark, sf_dir):
    g = hourly_grid(spark, sf_dir)
    model = g.models["Ridge"]
    test = g.clean.filter(F.col("split") == "test")
    feats_only, _ = cols.select_features(test, ["time", TGT, *model.features], strict=True)
    scored = lin.score(feats_only, model)
    return cols.residuals(scored, TGT).select("time", TGT, "prediction", "error", "abs_error")


@register("linear_attribution")
def q_linear_attribution(spark, sf_dir):
    g = hourly_grid(spark, sf_dir)
    model = g.models["Ridge"]
    train = g.clean.filter(F.col("split") == "train")
    background = dict(zip(g.features, gm.column_means(train, g.features)))
    test = g.clean.filter(F.col("split") == "test")
    attr = lin.linear_attribution(test, model, background)
    return lin.attribution_ranking(attr, g.features)


# ------------------------------------------------------------------------------------------
# 8. Unit-root and stationarity tests (driver finishes small matrices; rows-only check)
# ------------------------------------------------------------------------------------------


@register("adf")
def q_adf(spark, sf_dir):
    return ur.stationarity(fx.events_hourly(spark, sf_dir), HOURLY_COLS, tests=("ADF",))


def _unitroot_base_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", time, {c} AS v FROM h WHERE {c} IS NOT NULL" for c in HOURLY_COLS)
    return f"WITH h AS ({EVENTS_HOURLY_SQL}), l AS ({long})"


KPSS_SQL = _unitroot_base_sql() + f""",
r AS (SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY time) - 1 AS idx,
             v - avg(v) OVER (PARTITION BY "column") AS r, count(*) OVER (PARTITION BY "column") AS n FROM l),
g AS (SELECT a."column", a.idx - b.idx AS lag, sum(a.r * b.r) AS s
      FROM r a JOIN r b ON a."column" = b."column" AND b.idx <= a.idx GROUP BY 1, 2),
c AS (SELECT "column", max(n) AS n, CAST(floor(pow(max(n), 2.0 / 9.0)) AS BIGINT) AS cl FROM r GROUP BY 1),
s AS (SELECT c."column", c.n,
             sum(CASE WHEN g.lag = 0 THEN g.s / c.n WHEN g.lag <= c.cl THEN g.s / (c.n / 2.0) ELSE 0 END) AS s0,
             sum(CASE WHEN g.lag >= 1 AND g.lag <= c.cl THEN g.lag * (g.s / (c.n / 2.0)) ELSE 0 END) AS s1
      FROM c JOIN g ON g."column" = c."column" GROUP BY 1, 2),
k AS (SELECT "column", n, least(CAST(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3.0) * pow(n, 1.0 / 3.0)) AS BIGINT),
                                n - 1) AS lags FROM s),
sh AS (SELECT k."column", k.n, k.lags,
              sum(CASE WHEN g.lag = 0 THEN g.s WHEN g.lag <= k.lags THEN 2 * g.s * (1 - g.lag / (k.lags + 1.0))
                  ELSE 0 END) / k.n AS s_hat
       FROM k JOIN g ON g."column" = k."column" GROUP BY 1, 2, 3),
e AS (SELECT "column", sum(cs * cs) AS eta_num FROM (
        SELECT "column", sum(r) OVER (PARTITION BY "column" ORDER BY idx ROWS UNBOUNDED PRECEDING) AS cs FROM r)
      GROUP BY 1),
st AS (SELECT sh."column", sh.n, sh.lags, e.eta_num / (sh.n * sh.n) / sh.s_hat AS stat FROM sh JOIN e USING ("column")),
pv AS (SELECT *, CASE WHEN stat <= 0.347 THEN 0.10
                      WHEN stat <= 0.463 THEN 0.10 + (stat - 0.347) * (0.05 - 0.10) / (0.463 - 0.347)
                      WHEN stat <= 0.574 THEN 0.05 + (stat - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
                      WHEN stat <= 0.739 THEN 0.025 + (stat - 0.574) * (0.01 - 0.025) / (0.739 - 0.574)
                      ELSE 0.01 END AS p FROM st)
SELECT "column", 'KPSS' AS test, {R('stat')} AS statistic, {R('p')} AS p_value,
       CASE WHEN p < 0.05 THEN 'non-stationary' ELSE 'stationary' END AS conclusion,
       CAST(lags AS INTEGER) AS lags, n AS nobs FROM pv
"""


@register("kpss", KPSS_SQL)
def q_kpss(spark, sf_dir):
    return rounded(ur.stationarity(fx.events_hourly(spark, sf_dir), HOURLY_COLS, tests=("KPSS",)))


PP_SQL = _unitroot_base_sql() + f""",
r AS (SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY time) - 1 AS idx, v,
             lag(v) OVER (PARTITION BY "column" ORDER BY time) AS x, count(*) OVER (PARTITION BY "column") AS n0 FROM l),
p AS (SELECT * FROM r WHERE x IS NOT NULL),
f AS (SELECT "column", count(*) AS n, max(n0) AS n0, regr_slope(v, x) AS rho, regr_intercept(v, x) AS c,
             regr_sxx(v, x) AS sxx, CAST(ceil(12 * pow(max(n0) / 100.0, 0.25)) AS BIGINT) AS lags FROM p GROUP BY 1),
u AS (SELECT p."column", p.idx, p.v - f.rho * p.x - f.c AS u FROM p JOIN f USING ("column")),
g AS (SELECT a."column", a.idx - b.idx AS lag, sum(a.u * b.u) AS gs
      FROM u a JOIN u b ON a."column" = b."column" AND b.idx <= a.idx AND a.idx - b.idx <= (SELECT max(lags) FROM f)
      GROUP BY 1, 2),
lam AS (SELECT f."column", sum(CASE WHEN g.lag = 0 THEN g.gs WHEN g.lag <= f.lags
                                    THEN 2 * (1 - g.lag / (f.lags + 1.0)) * g.gs ELSE 0 END) / f.n AS lam2,
               max(CASE WHEN g.lag = 0 THEN g.gs END) AS ssr
        FROM f JOIN g USING ("column") GROUP BY f."column", f.n),
st AS (SELECT f."column", f.n0, f.lags, f.n, f.rho, lam.lam2, lam.ssr / (f.n - 2) AS s2,
              sqrt(lam.ssr / (f.n - 2) / f.sxx) AS sigma FROM f JOIN lam USING ("column"))
SELECT "column", 'PP' AS test,
       {R('sqrt((s2 * (n - 2) / n) / lam2) * ((rho - 1) / sigma) - 0.5 * ((lam2 - s2 * (n - 2) / n) / sqrt(lam2)) * (n * sigma / sqrt(s2))')} AS statistic,
       CAST(lags AS INTEGER) AS lags, n0 AS nobs FROM st
"""


@register("pp_statistic", PP_SQL)
def q_pp_statistic(spark, sf_dir):
    pp = ur.stationarity(fx.events_hourly(spark, sf_dir), HOURLY_COLS, tests=("PP",))
    return rounded(pp.select("column", "test", "statistic", "lags", "nobs"))


DF_SQL = _unitroot_base_sql() + f""",
r AS (SELECT "column", v - lag(v) OVER w AS dy, lag(v) OVER w AS x FROM l WINDOW w AS (PARTITION BY "column" ORDER BY time)),
f AS (SELECT "column", count(*) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy,
             regr_sxy(dy, x) AS sxy FROM r WHERE x IS NOT NULL GROUP BY 1)
SELECT "column", 'ADF' AS test, {R('b / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx)')} AS statistic,
       CAST(0 AS INTEGER) AS lags, n AS nobs FROM f
"""


@register("df_statistic", DF_SQL)
def q_df_statistic(spark, sf_dir):
    """ADF with the lag order fixed at 0 (Dickey-Fuller regression), statistic only."""
    a = ur.stationarity(fx.events_hourly(spark, sf_dir), HOURLY_COLS, tests=("ADF",), adf_maxlag=0)
    return rounded(a.select("column", "test", "statistic", "lags", "nobs"))


@register("phillips_perron")
def q_phillips_perron(spark, sf_dir):
    return ur.stationarity(fx.events_hourly(spark, sf_dir), HOURLY_COLS, tests=("PP",))


@register("stationarity_keyed")
def q_stationarity_keyed(spark, sf_dir):
    ev = fx.events_raw(spark, sf_dir).select("series", "time", "y")
    return ur.stationarity(ev, ["y"], keys=["series"])


# ------------------------------------------------------------------------------------------
# 9. Sliding windows and their scaler
# ------------------------------------------------------------------------------------------


MODEL_FEATURES = ([feat.TARGET, "relative_humidity_2m", "wind_speed_10m"]
                  + [f"{c}_lag_{k}" for c, ks in feat.LAGS.items() for k in ks]
                  + cols.CALENDAR)


def _hourly_parts(spark, sf_dir) -> DataFrame:
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    train = cols.month_holdout(f, 6).filter(F.col("part") == "train").drop("part")
    train = cols.calendar_features(train)
    return spl.split_three_way(train).drop("idx", "n")


def _parts_sql() -> str:
    cal = ("isodow(time) - 1 AS dayofweek, month(time) AS month, hour(time) AS hour, "
           "sin(2 * pi() * hour(time) / 24) AS sin_comp, cos(2 * pi() * hour(time) / 24) AS cos_comp")
    return f"""
WITH f AS (SELECT *, {cal} FROM ({FEATURES_SQL}) q WHERE month(time) IS DISTINCT FROM 6),
i AS (SELECT *, row_number() OVER (ORDER BY time) - 1 AS idx0, count(*) OVER () AS n0 FROM f),
s AS (SELECT *, CASE WHEN idx0 < floor(CAST(0.85 AS DOUBLE) * floor(CAST(0.8 AS DOUBLE) * n0)) THEN 'train'
                     WHEN idx0 < floor(CAST(0.8 AS DOUBLE) * n0) THEN 'val' ELSE 'test' END AS split FROM i)"""


@register("sliding_windows", _parts_sql() + f""",
w AS (SELECT split, time, row_number() OVER (PARTITION BY split ORDER BY time) - 1 AS idx,
             count(*) OVER (PARTITION BY split ORDER BY time ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS steps,
             first_value(temperature_2m) OVER (PARTITION BY split ORDER BY time ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS x_first,
             temperature_2m AS x_last, cos_comp AS x_last_cos,
             lead({TGT}, 3) OVER (PARTITION BY split ORDER BY time) AS y FROM s)
SELECT split, time, idx, CAST(steps AS INTEGER) AS steps, CAST(CAST(x_first AS FLOAT) AS DOUBLE) AS x_first,
       CAST(CAST(x_last AS FLOAT) AS DOUBLE) AS x_last, CAST(CAST(x_last_cos AS FLOAT) AS DOUBLE) AS x_last_cos,
       CAST(CAST(y AS FLOAT) AS DOUBLE) AS y
FROM w WHERE steps = 48 AND y IS NOT NULL
""")
def q_sliding_windows(spark, sf_dir):
    parts = _hourly_parts(spark, sf_dir)
    w = win.sliding_windows(parts, MODEL_FEATURES, TGT, 48, 3, keys=["split"])
    last = len(MODEL_FEATURES) - 1
    return w.select("split", "time", "idx", F.size("x").alias("steps"),
                    F.col("x")[0][0].cast("double").alias("x_first"),
                    F.col("x")[47][0].cast("double").alias("x_last"),
                    F.col("x")[47][last].cast("double").alias("x_last_cos"),
                    F.col("y").cast("double").alias("y"))


def _scaler_sql() -> str:
    parts = []
    for c in MODEL_FEATURES:
        v = f"CAST(CAST({c} AS FLOAT) AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", sum(wt * {v}) / sum(wt) AS mean,
  sqrt(sum(wt * ({v} - m.mu) ^ 2) / sum(wt)) AS sd, sum(wt) AS weight
FROM t, (SELECT sum(wt * {v}) / sum(wt) AS mu FROM t) m""")
    return _parts_sql() + f""",
r AS (SELECT *, row_number() OVER (ORDER BY time) - 1 AS idx, count(*) OVER () AS n FROM s WHERE split = 'train'),
t AS (SELECT *, greatest(least(idx + 47, n - 4) - greatest(idx, 47) + 1, 0) AS wt FROM r),
u AS ({' UNION ALL '.join(parts)})
SELECT "column", {R('mean')} AS mean, {R('CASE WHEN sd > 0 THEN sd ELSE 1 END')} AS scale, CAST(weight AS BIGINT) AS weight FROM u
"""


@register("window_scaler", _scaler_sql())
def q_window_scaler(spark, sf_dir):
    parts = _hourly_parts(spark, sf_dir)
    return rounded(win.window_scaler(parts.filter(F.col("split") == "train"), MODEL_FEATURES, TGT, 48, 3))


# ------------------------------------------------------------------------------------------
# 10. Sources and sinks: round trips through Spark data sources
# ------------------------------------------------------------------------------------------


@register("csv_roundtrip", f"""
SELECT time, {', '.join(f'round({c}, {DIGITS}) AS {c}' for c in HOURLY_COLS)} FROM ({EVENTS_HOURLY_SQL}) h
""")
def q_csv_roundtrip(spark, sf_dir):
    h = fx.events_hourly(spark, sf_dir)
    path = sio.write_csv(h, sio.scratch_path(spark, "csv"))
    schema = "time timestamp_ntz, temperature_2m double, relative_humidity_2m double, wind_speed_10m double"
    return rounded(sio.read_csv(spark, path, schema))


@register("payload_ingest", f"""
SELECT time, {', '.join(f'round({c}, {DIGITS}) AS {c}' for c in HOURLY_COLS)} FROM ({EVENTS_HOURLY_SQL}) h
""")
def q_payload_ingest(spark, sf_dir):
    h = fx.events_hourly(spark, sf_dir)
    path = sio.scratch_path(spark, "payload")
    sio.hourly_payloads(h, HOURLY_COLS).write.mode("overwrite").json(path)
    return rounded(sio.read_hourly_payload(spark, path, HOURLY_COLS))


@register("holdout_tables", f"""
SELECT series, time, round(y, {DIGITS}) AS y, CASE WHEN month(time) = 6 THEN 'predict' ELSE 'train' END AS part
FROM ({ORDERS_DAILY_SQL}) d
""")
def q_holdout_tables(spark, sf_dir):
    d = cols.month_holdout(fx.orders_daily(spark, sf_dir).select("series", "time", "y"), 6)
    path = sio.write_table(d, sio.scratch_path(spark, "holdout"), partition_by=["part"])
    return rounded(sio.read_table(spark, path).select("series", "time", "y", "part"))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    import datetime

    g = hourly_grid(spark, sf_dir)
    best = min(g.results, key=lambda r: r["test_rmse"])
    model = g.models[best["model"]]
    mpath = sio.save_linear_model(spark, model, sio.scratch_path(spark, "model"))
    loaded = sio.load_linear_model(spark, mpath)
    meta = sio.ModelMetadata(
        model_name=model.name, trained_at=datetime.datetime.now().isoformat(), version="1.0.0",
        target=TGT, metrics={k: best[k] for k in ("test_rmse", "test_mae", "cv_rmse", "cv_mae")},
        hyperparameters=best["best_params"], features=g.features, n_features=len(g.features),
        n_train=int(g.train_moments.n), n_test=int(g.test_moments.n), model_path=mpath)
    meta_path = sio.write_metadata(spark, meta, sio.scratch_path(spark, "meta"))
    test = g.clean.filter(F.col("split") == "test")
    scored = lin.score(test, loaded)
    m = st.regression_metrics(scored, TGT, "prediction")
    return _attach(m, sio.read_metadata(spark, meta_path).select("model_name", "n_features", "n_train", "n_test"))


def _attach(a: DataFrame, one_row: DataFrame) -> DataFrame:
    return join_small(a, one_row, on=[])


# ------------------------------------------------------------------------------------------
# 11. Seasonal baseline and the holdout comparison (candidate model vs baseline)
# ------------------------------------------------------------------------------------------


DAILY_LAGS = {"y": [1, 2, 7], "x1": [1, 7], "x2": [1]}


def _daily_features(spark, sf_dir) -> DataFrame:
    d = fx.orders_total_daily(spark, sf_dir)
    return feat.build_features(d, target="y", horizon=1, lags=DAILY_LAGS)


@register("seasonal_baseline")
def q_seasonal_baseline(spark, sf_dir):
    f = _daily_features(spark, sf_dir)
    part = cols.month_holdout(f, 6)
    model = bl.fit_seasonal_baseline(part.filter(F.col("part") == "train"), "y_target")
    pred = model.forecast(part.filter(F.col("part") == "predict").select("time", "y_target"))
    return cols.residuals(pred, "y_target")


def holdout_comparison_frames(spark, sf_dir):
    """Best linear model (trained without the holdout month) and the seasonal baseline,
    both scored on the holdout month; returns (side-by-side table, skill table)."""
    f = _daily_features(spark, sf_dir)
    design, feats = lin.prepare_design(f, "y_target")
    g = lin.linear_grid_search(design, feats, "y_target")
    best = min(g.results, key=lambda r: r["test_rmse"])["model"]
    part = cols.calendar_features(cols.month_holdout(f, 6))
    hold = part.filter(F.col("part") == "predict")
    cand = lin.score(hold, g.models[best]).select("time", "y_target", "prediction")
    base = bl.fit_seasonal_baseline(part.filter(F.col("part") == "train"), "y_target")
    bpred = base.forecast(hold.select("time", "y_target"))
    table = cmp.comparison_table(cand, bpred, "y_target", ("candidate", "baseline"), on=["time"])
    table = cols.actual_present(table, "y_target")
    skill = st.skill_scores(table, "y_target", "pred_candidate", "pred_baseline")
    return table, skill


@register("holdout_comparison")
def q_holdout_comparison(spark, sf_dir):
    return holdout_comparison_frames(spark, sf_dir)[1]


# ------------------------------------------------------------------------------------------
# 12. Boosted trees: search, per-round curve, importance, attributions
# ------------------------------------------------------------------------------------------


def _hourly_design(spark, sf_dir):
    f = feat.build_features(fx.events_hourly(spark, sf_dir))
    return lin.prepare_design(f, TGT)


_SEARCHES: dict[tuple[str, str], tuple] = {}


def _tree_search(spark, sf_dir):
    """Search, curve and refit at the reference's budget (the defaults of ``random_search``); one search per
    application and directory serves all tree queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SEARCHES:
        design, feats = _hourly_design(spark, sf_dir)
        design = reliable_checkpoint(cols.drop_missing(design, [*feats, TGT]))
        _SEARCHES[key] = design, feats, tr.random_search(design, feats, TGT)
    return _SEARCHES[key]


@register("boosted_trees")
def q_boosted_trees(spark, sf_dir):
    return tr.search_frame(spark, _tree_search(spark, sf_dir)[2].results)


@register("boosting_candidates")
def q_boosting_candidates(spark, sf_dir):
    """Every candidate of the search as a leaderboard."""
    found = tr.candidates_frame(spark, _tree_search(spark, sf_dir)[2])
    return found.withColumn("place", F.row_number().over(Window.orderBy("cv_rmse", "draw")))


@register("boosting_curve")
def q_boosting_curve(spark, sf_dir):
    return spark.createDataFrame(_tree_search(spark, sf_dir)[2].curve, "round int, split string, rmse double")


@register("boosting_summary")
def q_boosting_summary(spark, sf_dir):
    curve = q_boosting_curve(spark, sf_dir)
    return st.history_summary(curve, ["split"], step="round", value="rmse")


@register("tree_importance")
def q_tree_importance(spark, sf_dir):
    _, feats, res = _tree_search(spark, sf_dir)
    return tr.feature_importance(res.model.nodes, feats)


@register("tree_attribution")
def q_tree_attribution(spark, sf_dir):
    """Ranking of the features by mean absolute attribution over the test part."""
    design, feats, res = _tree_search(spark, sf_dir)
    attr, _ = tr.tree_attributions(design.filter(F.col("split") == "test"), res.model)
    return lin.attribution_ranking(attr, feats)


@register("tree_attribution_rows")
def q_tree_attribution_rows(spark, sf_dir):
    """Attributions of every row of both parts, with the prediction that they add up to."""
    design, _, res = _tree_search(spark, sf_dir)
    return tr.tree_attributions(tr.predict(design, res.model), res.model, keep=["time", "split", "prediction"])[0]


@register("tree_attribution_top")
def q_tree_attribution_top(spark, sf_dir):
    """Feature value and attribution of every row for the four features that matter most in the test part."""
    design, feats, res = _tree_search(spark, sf_dir)
    top = [r["feature"] for r in cmp.top_k(q_tree_attribution(spark, sf_dir), "shap_importance", 4, tiebreak="feature").collect()]
    attr, _ = tr.tree_attributions(design, res.model, keep=["time", "split", *top])
    return attr.select("time", "split", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), F.col(f"shap_{f}").alias("attribution")) for f in top])))


@register("tree_scoring")
def q_tree_scoring(spark, sf_dir):
    """G11 with the boosted model: the test part scored, with residuals."""
    design, _, res = _tree_search(spark, sf_dir)
    scored = tr.predict(design.filter(F.col("split") == "test"), res.model)
    return cols.residuals(scored.select("time", TGT, "prediction"), TGT)


# ------------------------------------------------------------------------------------------
# 13. Remaining relational glue: outlier rows, union of parts, positional column alignment
# ------------------------------------------------------------------------------------------


@register("boxplot_outliers", f"""
WITH h AS ({EVENTS_HOURLY_SQL}), l AS ({_long_hourly_sql()}),
s AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY 1),
w AS (SELECT l."column", coalesce(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), any_value(q1)) AS lo,
             coalesce(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), any_value(q3)) AS hi
      FROM l JOIN s ON l."column" = s."column" GROUP BY 1)
SELECT l."column", round(value, {DIGITS}) AS value FROM l JOIN w ON l."column" = w."column"
WHERE value < lo OR value > hi
""")
def q_boxplot_outliers(spark, sf_dir):
    return rounded(st.boxplot_outliers(fx.events_hourly(spark, sf_dir), HOURLY_COLS))


@register("holdout_union", f"""
WITH d AS ({ORDERS_DAILY_SQL}),
f AS (SELECT series, min(time) AS first FROM d WHERE month(time) = 6 GROUP BY series)
SELECT d.series, d.time, round(d.y, {DIGITS}) AS y FROM d JOIN f ON d.series = f.series
WHERE d.time >= f.first - INTERVAL 48 HOUR AND d.time < f.first AND month(d.time) <> 6
UNION ALL
SELECT series, time, round(y, {DIGITS}) AS y FROM d WHERE month(time) = 6
""")
def q_holdout_union(spark, sf_dir):
    """the holdout part as the union of the lead-in rows and the holdout-month rows."""
    d = fx.orders_daily(spark, sf_dir).select("series", "time", "y")
    lab = cols.holdout_with_leadin(d, 6, 48, keys=["series"])
    month_rows = lab.filter(F.month("time") == 6)
    lead_in = lab.filter((F.col("part") == "predict") & (F.month("time") != 6))
    return rounded(cmp.union_parts(lead_in, month_rows).drop("part"))


@register("aligned_parts", f"""
WITH d AS ({ORDERS_DAILY_SQL})
SELECT series, row_number() OVER (PARTITION BY series ORDER BY time) - 1 AS idx, time,
       round(x1, {DIGITS}) AS x1, round(y, {DIGITS}) AS y FROM d
""")
def q_aligned_parts(spark, sf_dir):
    """features and label of one indexed table, re-aligned by an equi-join on (keys, idx)."""
    d = seq.ensure_index(fx.orders_daily(spark, sf_dir), ["series"])
    x = d.select("series", "idx", "time", "x1")
    y = d.select("series", "idx", "y")
    return rounded(cmp.align_columns(x, y, ["series", "idx"]))


# ------------------------------------------------------------------------------------------
# 14. Keyed feature table (many series at once)
# ------------------------------------------------------------------------------------------

KEYED_LAGS = {"y": [1, 2, 7, 28], "x1": [1, 7], "x2": [1, 14]}


def _keyed_features_sql() -> str:
    exprs = ["lead(y, 1) OVER w AS y_target"]
    names = ["y_target"]
    for c, ks in KEYED_LAGS.items():
        for k in ks:
            exprs.append(f"lag({c}, {k}) OVER w AS {c}_lag_{k}")
            names.append(f"{c}_lag_{k}")
    out = ", ".join(f"{R(n)} AS {n}" for n in ["y", "x1", "x2", *names])
    return f"""
SELECT series, time, {out} FROM (
  SELECT *, {', '.join(exprs)} FROM ({ORDERS_DAILY_SQL}) d WINDOW w AS (PARTITION BY series ORDER BY time)) f
WHERE {' AND '.join(n + ' IS NOT NULL' for n in names)}
"""


@register("features_keyed", _keyed_features_sql())
def q_features_keyed(spark, sf_dir):
    d = fx.orders_daily(spark, sf_dir)
    return rounded(feat.build_features(d, target="y", horizon=1, lags=KEYED_LAGS, keys=["series"]))


# ------------------------------------------------------------------------------------------
# 14b. Linear models of many series at once
# ------------------------------------------------------------------------------------------


def _keyed_design(spark, sf_dir, lags=KEYED_LAGS, drop=()) -> lk.KeyedDesign:
    f = feat.build_features(fx.orders_daily(spark, sf_dir), target="y", horizon=1, lags=lags, keys=["series"])
    design, feats = lk.prepare_design(f, "y_target", ["series"])
    return lk.keyed_grams(design, [c for c in feats if c not in drop], "y_target", ["series"])


@register("linear_grid_keyed")
def q_linear_grid_keyed(spark, sf_dir):
    """G3 for every series: parameters, errors and size of the best model of each family."""
    return lk.grid_search(_keyed_design(spark, sf_dir)).models.drop("intercept", "coef")


@register("ridge_path_keyed")
def q_ridge_path_keyed(spark, sf_dir):
    return lk.ridge_path(_keyed_design(spark, sf_dir))


@register("ridge_error_curve_keyed")
def q_ridge_error_curve_keyed(spark, sf_dir):
    return lk.ridge_error_curve(_keyed_design(spark, sf_dir))


@register("learning_curve_keyed")
def q_learning_curve_keyed(spark, sf_dir):
    return lk.learning_curve(_keyed_design(spark, sf_dir), "Ridge")


@register("linear_scoring_keyed")
def q_linear_scoring_keyed(spark, sf_dir):
    """G11 for every series: its best ridge model on its test part, with residuals."""
    d = _keyed_design(spark, sf_dir)
    scored = lk.score(d.rows.filter(F.col("split") == "test"), lk.grid_search(d), "Ridge")
    return cols.residuals(scored.select("series", "time", "y_target", "prediction"), "y_target")


@register("linear_attribution_keyed")
def q_linear_attribution_keyed(spark, sf_dir):
    d = _keyed_design(spark, sf_dir)
    attr = lk.attributions(d.rows.filter(F.col("split") == "test"), lk.grid_search(d), "Ridge")
    return lk.attribution_ranking(attr, ["series"], d.features)


@register("standardize_keyed", f"""
SELECT series, time, {', '.join(
    f"{R(f'({c} - avg({c}) OVER w) / CASE WHEN stddev_pop({c}) OVER w > 0 THEN stddev_pop({c}) OVER w ELSE 1 END')} AS {c}_z"
    for c in ('y', 'x1', 'x2'))}
FROM ({ORDERS_DAILY_SQL}) d WINDOW w AS (PARTITION BY series)
""")
def q_standardize_keyed(spark, sf_dir):
    out, _ = lk.standardize(fx.orders_daily(spark, sf_dir), ["y", "x1", "x2"], ["series"], suffix="_z")
    return rounded(out.select("series", "time", "y_z", "x1_z", "x2_z"))


# Two features per series have normal equations that SQL can state: the twins of G4, G5 and G11
PAIR = ["y", "x1"]
PAIR_DROP = ("x2", *cols.CALENDAR)
PAIR_ALPHAS = [10.0 ** k for k in range(-2, 13)]
PAIR_ALPHA = 1000.0


def _pair_sql(select: str, tail: str = "") -> str:
    """Ridge on y and x1 (raw values, unpenalised intercept) per series by Cramer's rule; ``f`` has the design, ``w`` the solution
    for every alpha."""
    alphas = ", ".join(f"({a!r}::DOUBLE)" for a in PAIR_ALPHAS)
    return f"""
WITH l AS (SELECT series, time, y, x1, lead(y) OVER (PARTITION BY series ORDER BY time) AS t FROM ({ORDERS_DAILY_SQL}) d),
i AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY time) - 1 AS idx, count(*) OVER (PARTITION BY series) AS n
      FROM l WHERE t IS NOT NULL AND month(time) <> 6),
f AS (SELECT *, CASE WHEN idx < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM i),
s AS (SELECT series, avg(y) AS m1, avg(x1) AS m2, avg(t) AS mt, count(*) * covar_pop(y, y) AS a, count(*) * covar_pop(y, x1) AS b,
             count(*) * covar_pop(x1, x1) AS d, count(*) * covar_pop(y, t) AS p, count(*) * covar_pop(x1, t) AS q
      FROM f WHERE split = 'train' GROUP BY series),
w AS (SELECT series, alpha, (p * (d + alpha) - b * q) / ((a + alpha) * (d + alpha) - b * b) AS w1,
             ((a + alpha) * q - b * p) / ((a + alpha) * (d + alpha) - b * b) AS w2, m1, m2, mt FROM s, (VALUES {alphas}) v(alpha)),
e AS (SELECT f.*, w.alpha, mt + w1 * (f.y - m1) + w2 * (f.x1 - m2) AS prediction FROM f JOIN w ON f.series IS NOT DISTINCT FROM w.series)
{select}"""


def _pair_design(spark, sf_dir) -> lk.KeyedDesign:
    return _keyed_design(spark, sf_dir, lags={}, drop=PAIR_DROP)


@register("ridge_path_pair", _pair_sql("""
SELECT series, alpha, 'y' AS feature, round(w1, 6) + 0.0 AS coef FROM w UNION ALL SELECT series, alpha, 'x1', round(w2 * 1e-3, 6) + 0.0 FROM w
"""))
def q_ridge_path_pair(spark, sf_dir):
    """G4 with two features for every series (x1's coefficient in thousands; adding zero drops the sign of zero)."""
    path = lk.ridge_path(_pair_design(spark, sf_dir), PAIR_ALPHAS)
    shown = rounded(path.withColumn("coef", F.when(F.col("feature") == "x1", F.col("coef") * 1e-3).otherwise(F.col("coef"))))
    return shown.withColumn("coef", F.col("coef") + F.lit(0.0))


_GRID_SQL = ", ".join(f"({k}, {float(a)!r}::DOUBLE)" for k, a in enumerate(lin.LINEAR_ALPHAS))


@register("ridge_grid_pair", _pair_sql(f""",
b AS (SELECT *, floor(CAST(0.8 AS DOUBLE) * n) AS cut, floor(floor(CAST(0.8 AS DOUBLE) * n) / 6) AS ts FROM f),
k AS (SELECT *, CASE WHEN split = 'train' THEN greatest(-1, floor((idx - (cut - 5 * ts)) / ts)) ELSE 5 END AS block FROM b),
r AS (SELECT k.*, fold, CASE WHEN block < fold THEN 'fit' WHEN block = fold THEN 'check' END AS use FROM k, (SELECT unnest(range(0, 6)) AS fold)),
z AS (SELECT series, fold, count(*) AS n, avg(y) AS m1, avg(x1) AS m2, avg(t) AS mt, stddev_pop(y) AS s1, stddev_pop(x1) AS s2,
             count(*) * corr(y, x1) AS b, count(*) * covar_pop(y, t) / stddev_pop(y) AS p, count(*) * covar_pop(x1, t) / stddev_pop(x1) AS q
      FROM r WHERE use = 'fit' GROUP BY series, fold),
v AS (SELECT z.*, nth, alpha, (p * (n + alpha) - b * q) / ((n + alpha) ^ 2 - b * b) AS v1, ((n + alpha) * q - b * p) / ((n + alpha) ^ 2 - b * b) AS v2
      FROM z, (VALUES {_GRID_SQL}) g(nth, alpha)),
h AS (SELECT r.series, r.fold, nth, sqrt(avg((t - mt - v1 * (r.y - m1) / s1 - v2 * (r.x1 - m2) / s2) ^ 2)) AS rmse,
             avg(abs(t - mt - v1 * (r.y - m1) / s1 - v2 * (r.x1 - m2) / s2)) AS mae
      FROM r JOIN v ON r.series IS NOT DISTINCT FROM v.series AND r.fold = v.fold WHERE use = 'check' GROUP BY ALL),
c AS (SELECT series, nth, avg(rmse) AS cv_rmse, avg(mae) AS cv_mae FROM h WHERE fold < 5 GROUP BY ALL),
best AS (SELECT series, arg_min(nth, (cv_rmse, nth)) AS nth FROM c GROUP BY series)
SELECT series, nth AS alpha_place, round(cv_rmse / 1e3, 6) AS cv_rmse, round(cv_mae / 1e3, 6) AS cv_mae, round(rmse / 1e3, 6) AS test_rmse,
       round(mae / 1e3, 6) AS test_mae
FROM best JOIN c USING (series, nth) JOIN (SELECT * FROM h WHERE fold = 5) USING (series, nth)
"""))
def q_ridge_grid_pair(spark, sf_dir):
    """G3 with two features for every series: the winner of the ridge grid over five expanding folds, errors in thousands."""
    m = lk.grid_search(_pair_design(spark, sf_dir)).models.filter(F.col("model") == "Ridge")
    place = F.array_position(F.array(*[F.lit(float(a)) for a in lin.LINEAR_ALPHAS]), F.col("params")["ridge__alpha"]) - 1
    return rounded(m.select("series", place.cast("int").alias("alpha_place"), *[(F.col(c) / 1e3).alias(c) for c in ("cv_rmse", "cv_mae", "test_rmse", "test_mae")]))


@register("ridge_error_pair", _pair_sql("""
SELECT series, alpha, round(sqrt(avg((t - prediction) * (t - prediction))) / 1e3, 6) AS rmse_thousands
FROM e WHERE split = 'test' GROUP BY series, alpha
"""))
def q_ridge_error_pair(spark, sf_dir):
    """G5 with two features for every series: the square root of the test error, in thousands."""
    curve = lk.ridge_error_curve(_pair_design(spark, sf_dir), PAIR_ALPHAS)
    return rounded(curve.select("series", "alpha", (F.sqrt("test_error") / 1e3).alias("rmse_thousands")))


@register("ridge_scoring_pair", _pair_sql(f"""
SELECT series, time, round(t / 1e3, 6) AS actual, round(prediction / 1e3, 6) AS prediction, round((t - prediction) / 1e3, 6) AS error
FROM e WHERE split = 'test' AND alpha = {PAIR_ALPHA!r}
"""))
def q_ridge_scoring_pair(spark, sf_dir):
    """G11 with two features for every series: the ridge model of one penalty on the test part, in thousands."""
    d = _pair_design(spark, sf_dir)
    scored = lk.score(d.rows.filter(F.col("split") == "test"), lk.KeyedGrid(d, lk.ridge_models(d, PAIR_ALPHA)), "Ridge")
    k = F.lit(1e3)
    return rounded(scored.select("series", "time", (F.col("y_target") / k).alias("actual"), (F.col("prediction") / k).alias("prediction"),
                                 ((F.col("y_target") - F.col("prediction")) / k).alias("error")))


# ------------------------------------------------------------------------------------------
# 15. Scaled sequence windows and the boosted-tree model round trip
# ------------------------------------------------------------------------------------------


@register("scaled_windows")
def q_scaled_windows(spark, sf_dir):
    """C5 + G2: windows of the three parts, scaled with the scaler fitted on the training part's
    windows (closed form), as sequence-model inputs."""
    parts = _hourly_parts(spark, sf_dir)
    w = win.sliding_windows(parts, MODEL_FEATURES, TGT, 48, 3, keys=["split"])
    sc = win.window_scaler(parts.filter(F.col("split") == "train"), MODEL_FEATURES, TGT, 48, 3)
    scaled = win.apply_window_scaler(w, sc, MODEL_FEATURES)
    return scaled.select("split", "time", "idx", "y", "x")


@register("tree_model_roundtrip")
def q_tree_model_roundtrip(spark, sf_dir):
    """A6 + A7 for boosted trees: the fitted model written as Parquet, read back, the test part
    scored, and a metadata record with the round count."""
    import datetime

    design, feats, res = _tree_search(spark, sf_dir)
    loaded = tr.load_model(spark, tr.save_model(res.model, sio.scratch_path(spark, "gbt-model")))
    test = design.filter(F.col("split") == "test")
    m = st.regression_metrics(tr.predict(test, loaded), TGT, "prediction")
    row = m.first()
    meta = sio.ModelMetadata(
        model_name="GBT", trained_at=datetime.datetime.now().isoformat(), version="1.0.0", target=TGT,
        metrics={"test_rmse": row["rmse"], "test_mae": row["mae"], "cv_rmse": res.results["cv_rmse"], "cv_mae": res.results["cv_mae"]},
        hyperparameters=res.results["best_params"], features=feats,
        n_features=len(feats), n_train=int(design.filter(F.col("split") == "train").count()),
        n_test=int(row["n"]), model_path="", best_iterations=loaded.arrays().n_trees)
    meta_path = sio.write_metadata(spark, meta, sio.scratch_path(spark, "gbt-meta"))
    return _attach(m, sio.read_metadata(spark, meta_path).select("model_name", "n_features", "n_train",
                                                                  "n_test", "best_iterations"))


# ------------------------------------------------------------------------------------------
# 16. Series and months kept on storage
# ------------------------------------------------------------------------------------------


@register("stored_lag_features", ORACLE["lag_features"])
def q_stored_lag_features(spark, sf_dir):
    """C1-C3 on a stored series: the lags of ``lag_features`` from a bucketed table, without an exchange."""
    ev = fx.events_raw(spark, sf_dir, keyed=False).select("time", "y", "x")
    s = stored.store_series(ev, [], "time", back=max(LAG_SPEC), fwd=1, block=512)
    return rounded(stored.shift_stored(s, [(f"{c}_lag_{k}", c, k) for k in LAG_SPEC for c in ("y", "x")]))


@register("stored_appended", ORACLE["lag_features"])
def q_stored_appended(spark, sf_dir):
    """The same from a series that is stored in two batches: the second goes on from the manifest."""
    ev = reliable_checkpoint(fx.events_raw(spark, sf_dir, keyed=False).select("time", "y", "x"))
    half = ev.agg(F.expr("timestampadd(MICROSECOND, timestampdiff(MICROSECOND, min(time), max(time)) div 2, min(time))").alias("t")).first()["t"]
    cut = F.col("time") < F.lit(half)
    s = stored.store_series(ev.filter(cut), [], "time", back=max(LAG_SPEC), fwd=1, block=512)
    s = stored.append_series(s, ev.filter(~cut))
    return rounded(stored.shift_stored(s, [(f"{c}_lag_{k}", c, k) for k in LAG_SPEC for c in ("y", "x")]))


@register("stored_holdout", f"""
WITH d AS ({ORDERS_DAILY_SQL}),
f AS (SELECT series, min(time) AS first FROM d WHERE month(time) = 6 GROUP BY series)
SELECT d.series, d.time, round(d.y, {DIGITS}) AS y FROM d JOIN f ON d.series = f.series
WHERE month(d.time) = 6 OR (d.time >= f.first - INTERVAL 48 HOUR AND d.time < f.first)
""")
def q_stored_holdout(spark, sf_dir):
    """B7 and B8 from a table in monthly folders: the held-out month and its lead-in, reading two months."""
    path = stored.write_monthly(fx.orders_daily(spark, sf_dir).select("series", "time", "y"), sio.scratch_path(spark, "monthly"))
    return rounded(stored.read_holdout(spark, path, "predict", 6, 48, ["series"]))


# ------------------------------------------------------------------------------------------
# 17. Whole windows, profiles without a column list, bad timestamps, missing actuals
# ------------------------------------------------------------------------------------------


def _cells_sql(scale: bool) -> str:
    """Per window and feature the sum of its 48 values and their sum weighted by the step: every cell counts."""
    names = ", ".join(f"({j}, '{c}')" for j, c in enumerate(MODEL_FEATURES))
    values = ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE)" for c in MODEL_FEATURES)
    v = "CAST(CAST((v - sc.mean) / sc.scale AS FLOAT) AS DOUBLE)" if scale else "v"
    scaler = f", sc AS ({_scaler_body_sql()})" if scale else ""
    join = 'JOIN sc ON sc."column" = c.feature' if scale else ""
    return _parts_sql() + f"""{scaler},
p AS (SELECT split, row_number() OVER (PARTITION BY split ORDER BY time) - 1 AS idx,
             lead({TGT}, 3) OVER (PARTITION BY split ORDER BY time) AS y, [{values}] AS vals FROM s),
c AS (SELECT split, idx, y, feature, vals[nth + 1] AS v FROM p, (VALUES {names}) n(nth, feature)),
z AS (SELECT split, idx, y, feature, {v} AS v FROM c {join}),
w AS (SELECT split, idx, feature, y, count(*) OVER k AS steps, sum(v) OVER k AS total, sum(v * idx) OVER k - (idx - 47) * sum(v) OVER k AS weighted
      FROM z WINDOW k AS (PARTITION BY split, feature ORDER BY idx ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))
SELECT split, idx, feature, round(total, 3) + 0.0 AS total, round(weighted / 48, 3) + 0.0 AS weighted FROM w WHERE steps = 48 AND y IS NOT NULL
"""


def _scaler_body_sql() -> str:
    """The scaler's parameters, unrounded, on the CTEs of ``_parts_sql``."""
    parts = " UNION ALL ".join(f"""SELECT '{c}' AS "column", sum(wt * v) / sum(wt) AS mean,
  CASE WHEN sum(wt * (v - mu) ^ 2) > 0 THEN sqrt(sum(wt * (v - mu) ^ 2) / sum(wt)) ELSE 1 END AS scale
FROM (SELECT wt, CAST(CAST({c} AS FLOAT) AS DOUBLE) AS v, sum(wt * CAST(CAST({c} AS FLOAT) AS DOUBLE)) OVER () / sum(wt) OVER () AS mu FROM tw)""" for c in MODEL_FEATURES)
    weighed = """SELECT *, greatest(least(idx + 47, n - 4) - greatest(idx, 47) + 1, 0) AS wt FROM (
  SELECT *, row_number() OVER (ORDER BY time) - 1 AS idx, count(*) OVER () AS n FROM s WHERE split = 'train')"""
    return f"WITH tw AS ({weighed}) {parts}"


def _cells(windows: DataFrame) -> DataFrame:
    steps = F.posexplode("x").alias("step", "vals")
    cells = windows.select("split", "idx", steps).select("split", "idx", "step", F.posexplode("vals").alias("nth", "v"))
    sums = cells.groupBy("split", "idx", "nth").agg(F.sum(F.col("v").cast("double")).alias("total"), F.sum(F.col("v").cast("double") * F.col("step")).alias("weighted"))
    feature = F.element_at(F.array(*[F.lit(c) for c in MODEL_FEATURES]), F.col("nth") + 1)
    return sums.select("split", "idx", feature.alias("feature"), (F.round("total", 3) + 0.0).alias("total"), (F.round(F.col("weighted") / 48, 3) + 0.0).alias("weighted"))


@register("window_cells", _cells_sql(False))
def q_window_cells(spark, sf_dir):
    """All 48 x 22 cells of every window, as sums and step-weighted sums per feature."""
    return _cells(win.sliding_windows(_hourly_parts(spark, sf_dir), MODEL_FEATURES, TGT, 48, 3, keys=["split"]))


@register("scaled_window_cells", _cells_sql(True))
def q_scaled_window_cells(spark, sf_dir):
    """C5 + G2: the same for the scaled windows."""
    return _cells(q_scaled_windows(spark, sf_dir))


CUSTOMER_NUMBERS = ["c_custkey", "c_nationkey", "c_acctbal"]


@register("profile_all_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, round(avg({c}), {DIGITS}) AS mean, "
    f"round(median({c}), {DIGITS}) AS median, round(stddev_samp({c}), {DIGITS}) AS std, "
    f"round(skewness({c}), {DIGITS}) AS skewness, round(kurtosis({c}), {DIGITS}) AS kurtosis, "
    f"count(*) - count({c}) AS missing FROM customer" for c in CUSTOMER_NUMBERS))
def q_profile_all_numeric(spark, sf_dir):
    """B1 + E1: the profile of a table's numeric columns, found by type."""
    return rounded(st.numeric_profile(fx.table(spark, sf_dir, "customer")))


@register("parsed_times", """
WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'not a time' WHEN 1 THEN NULL WHEN 2 THEN '2024-13-45 99:00:00'
                            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time FROM events)
SELECT event_id, TRY_CAST(time AS TIMESTAMP) AS time FROM t WHERE TRY_CAST(time AS TIMESTAMP) IS NOT NULL
""")
def q_parsed_times(spark, sf_dir):
    """B2 on text: unparsable and missing times are dropped."""
    kind = F.col("event_id") % 5
    text = (F.when(kind == 0, F.lit("not a time")).when(kind == 1, F.lit(None).cast("string")).when(kind == 2, F.lit("2024-13-45 99:00:00"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return cols.parse_time(fx.table(spark, sf_dir, "events").select("event_id", text.alias("time")))


@register("scored_actuals", f"""
SELECT o_orderkey, round(o_totalprice, {DIGITS}) AS actual, round(o_totalprice - 1000 * (o_orderkey % 7), {DIGITS}) AS prediction,
       round(o_totalprice - round(o_totalprice - 1000 * (o_orderkey % 7), {DIGITS}), 3) AS error
FROM orders WHERE o_orderkey % 3 = 0
""")
def q_scored_actuals(spark, sf_dir):
    """B9 on a scored table whose actual is NULL or NaN in two rows of three."""
    kind = F.col("o_orderkey") % 3
    actual = F.when(kind == 1, F.lit(float("nan"))).when(kind == 0, F.col("o_totalprice").cast("double"))
    scored = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", actual.alias("actual"), F.round(F.col("o_totalprice").cast("double") - 1000 * (F.col("o_orderkey") % 7), DIGITS).alias("prediction"))
    kept = cols.residuals(cols.actual_present(scored, "actual"), "actual").drop("abs_error")
    return kept.withColumn("actual", F.round("actual", DIGITS)).withColumn("error", F.round("error", 3))


@register("pp_conclusion", f"""
SELECT "column", statistic, CASE WHEN statistic > 2.74 THEN 'non-stationary' WHEN statistic < -18.83 THEN 'stationary'
  WHEN (CASE WHEN statistic <= -1.61 THEN 2.1659 + 1.4412 * statistic + 0.038269 * statistic ^ 2
        ELSE 1.7339 + 0.93202 * statistic - 0.12745 * statistic ^ 2 - 0.010368 * statistic ^ 3 END) < -1.6448536269514722
  THEN 'stationary' ELSE 'non-stationary' END AS conclusion FROM ({PP_SQL}) pp
""")
def q_pp_conclusion(spark, sf_dir):
    """Statistic and label (a p-value below 0.05 is a response surface below the normal 5 % point)."""
    return rounded(ur.stationarity(fx.events_hourly(spark, sf_dir), HOURLY_COLS, tests=("PP",)).select("column", "statistic", "conclusion"))


# ------------------------------------------------------------------------------------------
# 18. The holdout month scored side by side
# ------------------------------------------------------------------------------------------


@register("holdout_side_by_side")
def q_holdout_side_by_side(spark, sf_dir):
    """Actual, both predictions and both errors of every row of the held-out month (linear candidate, baseline)."""
    return holdout_comparison_frames(spark, sf_dir)[0]


def boosted_holdout_frames(spark, sf_dir):
    """G13 with the boosted candidate: the search's parameters and round count, trained without the held-out month."""
    found = _tree_search(spark, sf_dir)[2]
    f = _daily_features(spark, sf_dir)
    design, feats = lin.prepare_design(f, "y_target")
    model = tr.fit(design.withColumn("split", F.lit("train")), feats, "y_target", found.best_params, found.best_round)
    part = cols.calendar_features(cols.month_holdout(f, 6))
    hold = part.filter(F.col("part") == "predict")
    cand = tr.predict(hold, model).select("time", "y_target", "prediction")
    base = bl.fit_seasonal_baseline(part.filter(F.col("part") == "train"), "y_target")
    table = cmp.comparison_table(cand, base.forecast(hold.select("time", "y_target")), "y_target", ("boosted", "baseline"), on=["time"])
    table = cols.actual_present(table, "y_target")
    return table, st.skill_scores(table, "y_target", "pred_boosted", "pred_baseline")


@register("boosted_side_by_side")
def q_boosted_side_by_side(spark, sf_dir):
    return boosted_holdout_frames(spark, sf_dir)[0]


@register("boosted_comparison")
def q_boosted_comparison(spark, sf_dir):
    return boosted_holdout_frames(spark, sf_dir)[1]
