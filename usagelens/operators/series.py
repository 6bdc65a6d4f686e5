"""AN11 / AN12: DAU anomalies (z-score) and DAU forecast (simple exponential
smoothing), for one global series or one series per segment (``by``)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import attach
from usagelens.operators.activity import daily_active_users, user_day


def segment_daily_active_users(sessions: DataFrame, users: DataFrame, by: Sequence[str]) -> DataFrame:
    """DAU per segment column(s) of ``users``: (by..., date, dau).

    The (user, day) rollup is built first so the join to ``users`` carries
    at most one row per user and day, never raw sessions.
    """
    ud = user_day(sessions)
    seg = users.select("user_id", *by)
    for c in by:  # like a group-by that drops null keys
        seg = seg.where(F.col(c).isNotNull())
    return (ud.join(seg, "user_id")
            .groupBy(*by, "date").agg(F.count("*").alias("dau")))


def zscore_anomalies(daily: DataFrame, value: str = "dau", z_threshold: float = 2.5,
                     by: Sequence[str] = ()) -> DataFrame:
    """Add z_score (population sd; sd 0 -> 1e-6) and is_anomaly = |z| >= threshold.

    For integer series (DAU) the moments are exact: integer sums in
    decimal(38,0), variance (n*Sxx - Sx^2) / n^2 rounded once, so the
    score on a tie such as |z| = 2.5 does not depend on summation order.
    """
    if isinstance(daily.schema[value].dataType, T.IntegralType):
        d = "decimal(38,0)"
        x = F.col(value).cast(d)
        stats = daily.groupBy(*by).agg(F.count(value).cast(d).alias("_n"), F.sum(x).alias("_sx"),
                                       F.sum(x * x).alias("_sxx"))
        stats = stats.select(
            *by, (F.col("_sx").cast("double") / F.col("_n").cast("double")).alias("_mean"),
            F.sqrt((F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx")).cast("double")
                   / (F.col("_n") * F.col("_n")).cast("double")).alias("_sd"))
    else:
        stats = daily.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd"))
    # without segments the statistics are one row (a scalar subquery); with
    # segments it is a join Spark sizes (broadcast only under its threshold)
    j = attach(daily, stats) if not by else daily.join(stats, list(by))
    sd = F.when(F.col("_sd").isNull() | (F.col("_sd") == 0), F.lit(1e-6)).otherwise(F.col("_sd"))
    z = (F.col(value) - F.col("_mean")) / sd
    return (j.withColumn("z_score", z)
            .withColumn("is_anomaly", F.abs(F.col("z_score")) >= z_threshold)
            .drop("_mean", "_sd"))


def detect_dau_anomalies(sessions: DataFrame, z_threshold: float = 2.5) -> DataFrame:
    """(date, dau, z_score, is_anomaly) over the global DAU series."""
    return zscore_anomalies(daily_active_users(sessions), "dau", z_threshold) \
        .select("date", "dau", "z_score", "is_anomaly")


def detect_dau_anomalies_by(sessions: DataFrame, users: DataFrame, by: Sequence[str],
                            z_threshold: float = 2.5) -> DataFrame:
    """One DAU series per segment, each with its own mean and sd."""
    daily = segment_daily_active_users(sessions, users, by)
    return zscore_anomalies(daily, "dau", z_threshold, by) \
        .select(*by, "date", "dau", "z_score", "is_anomaly")


def _ses_fold(points: Column, alpha: Column) -> Column:
    """Fold a date-sorted array of (date, dau) for a fixed alpha.

    With the initial level l0 unknown, the one-step forecast is linear in
    it: f_t = g_t + c_t * l0, where g is the smoothing started at 0 and
    c_t = (1 - alpha)^(t-1). One pass accumulates S_cy = sum c (y - g),
    S_cc = sum c^2 and S_yy = sum (y - g)^2; the SSE-optimal l0 is
    S_cy / S_cc and the minimal SSE is S_yy - l0 * S_cy.
    """
    init = F.struct(F.lit(0.0).alias("g"), F.lit(1.0).alias("c"), F.lit(0.0).alias("scy"),
                    F.lit(0.0).alias("scc"), F.lit(0.0).alias("syy"))

    def step(acc, p):
        y = p["dau"].cast("double")
        e = y - acc["g"]
        return F.struct(
            (alpha * y + (F.lit(1.0) - alpha) * acc["g"]).alias("g"),
            (acc["c"] * (F.lit(1.0) - alpha)).alias("c"),
            (acc["scy"] + acc["c"] * e).alias("scy"),
            (acc["scc"] + acc["c"] * acc["c"]).alias("scc"),
            (acc["syy"] + e * e).alias("syy"),
        )

    return F.aggregate(points, init, step)


def _fit(points: Column, alpha: Column) -> Column:
    """struct(sse, alpha, level): the SSE-optimal fit for one alpha."""
    s = _ses_fold(points, alpha)
    l0 = s["scy"] / s["scc"]
    return F.struct((s["syy"] - l0 * s["scy"]).alias("sse"), alpha.alias("alpha"),
                    (s["g"] + s["c"] * l0).alias("level"))


def _best(points: Column, alphas: Column) -> Column:
    """Least-SSE fit over an array of alphas (ties: smaller alpha), in the row."""
    return F.array_min(F.transform(alphas, lambda a: _fit(points, a)))


def ses_forecast(daily: DataFrame, periods: int = 14, by: Sequence[str] = (),
                 min_points: int = 7, grid: int = 100, value: str = "dau",
                 time_col: str = "date", refine: int = 10) -> DataFrame:
    """(by..., date, dau, forecast): history rows with null forecast, then
    ``periods`` future days with a flat forecast and null dau.

    Fit: simple exponential smoothing on the observed days (gaps are not
    filled), alpha chosen on the grid k/grid (k = 1..grid), then refined on
    steps of 1/(grid*refine) within one grid step of the best, clipped to
    (0, 1]; the initial level is solved in closed form. Both minimise the
    one-step SSE. Each series is one array of (day, value) pairs, bounded
    by the days it spans, not by users; every candidate alpha is evaluated
    inside that row (nested higher-order functions), so fitting needs no
    shuffle. Series with fewer than ``min_points`` days give no rows.
    """
    pts = (daily.groupBy(*by)
           .agg(F.array_sort(F.collect_list(F.struct(F.col(time_col).alias("date"),
                                                       F.col(value).alias("dau")))).alias("pts"))
           .where(F.size("pts") >= min_points))
    coarse = F.transform(F.sequence(F.lit(1), F.lit(grid)), lambda k: k / grid)
    best = _best(F.col("pts"), coarse)
    if refine > 0:
        # the coarse alpha enters as an argument (array_repeat), evaluated once
        # per series, not inside the lambda where it would be recomputed
        steps = 2 * refine + 1
        near = F.filter(
            F.zip_with(F.array_repeat(best["alpha"], steps), F.sequence(F.lit(0), F.lit(steps - 1)),
                       lambda a, j: a + (j - refine) / (grid * refine)),
            lambda a: (a > 0) & (a <= 1))
        best = _best(F.col("pts"), near)
    fit = pts.withColumn("best", best)
    last = F.element_at("pts", -1)["date"]
    future = fit.select(
        *by, F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, periods))).alias("date"),
        F.lit(None).cast("long").alias("dau"), F.col("best.level").alias("forecast"))
    hist = pts.select(*by, F.inline("pts")).select(
        *by, "date", F.col("dau").cast("long").alias("dau"), F.lit(None).cast("double").alias("forecast"))
    return hist.unionByName(future)


def forecast_dau(sessions: DataFrame, periods: int = 14, grid: int = 100) -> DataFrame:
    """Global DAU history plus a ``periods``-day flat SES forecast."""
    return ses_forecast(daily_active_users(sessions), periods, grid=grid)


def forecast_dau_by(sessions: DataFrame, users: DataFrame, by: Sequence[str],
                    periods: int = 14, grid: int = 100) -> DataFrame:
    """One SES forecast per segment, fitted in parallel."""
    return ses_forecast(segment_daily_active_users(sessions, users, by), periods, by=by, grid=grid)
