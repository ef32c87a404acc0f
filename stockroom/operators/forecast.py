"""Per-product demand forecasts, fit quality, backtest and the model version log
(F1-F8, A10, A11, A13, J10, L4, P13).

The reference fits one Prophet model per product in a serial driver loop. Here the default
estimator is re-aimed to closed-form statistics that Catalyst computes for all series in one
grouped aggregation: an OLS trend (``regr_slope`` / ``regr_intercept``) plus a mean
residual per weekday (weekly seasonality), with a 95 % band of +/- 1.96 residual standard
deviations. A Fourier-term variant runs per series in ``applyInPandas`` (``fit_fourier``).
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom import schemas as S
from stockroom.operators.features import daily_features
from stockroom.operators.projection import active_scope
from stockroom.session import materialize
from stockroom.sources.store import Store

SERIES = ["organization_id", "product_id"]
Z95 = 1.96
X_ORIGIN = "2000-01-01"


def _series(features: DataFrame) -> DataFrame:
    """(org, product, ds date, y) with x = days since the series' first day."""
    d = features.select(*SERIES, F.to_date("date").alias("ds"), F.col("units_sold").cast("double").alias("y"))
    first = F.min("ds").over(Window.partitionBy(*SERIES))
    return d.withColumn("x", F.datediff("ds", first).cast("double")).withColumn("wd", F.weekday("ds"))


def fit(features: DataFrame, weekly: bool = True, min_rows: int = S.MIN_TRAINING_DAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """fit every series at once from sufficient statistics.

    One aggregation per (series, weekday) collects n, sums of x, y, x*y, x^2, y^2; the OLS
    trend, the weekday effects (mean residual per weekday) and the residual standard
    deviation all follow algebraically from that small table, which is written once: models,
    effects and forecasts read it, the features are scanned and shuffled once. ``x`` is days since a fixed origin (OLS is shift invariant, and a
    constant avoids a separate pass to find the data's first day); the intercept is reported
    at each series' first day.

    Returns ``(models, weekday_effects, skipped)``: one row per trained series with
    ``slope, intercept, sigma, first_ds, last_ds, training_rows``; the mean residual per
    (series, weekday); and the series refused for having fewer than ``min_rows`` rows.
    """
    return fit_statistics(materialize(weekday_statistics(features), "statistics"), weekly, min_rows)


#: Sums that make up the statistics of a (series, weekday); those of two sets of days add up.
SUMS = ("n", "sx", "sy", "sxy", "sxx", "syy")


def weekday_statistics(features: DataFrame) -> DataFrame:
    """Sufficient statistics per (series, weekday) of features (one row per series and day)."""
    base = features.select(*SERIES, F.to_date("date").alias("ds"), F.col("units_sold").cast("double").alias("y"))
    origin = F.to_date(F.lit(X_ORIGIN))
    x, y = F.datediff("ds", origin).cast("double"), F.col("y")
    return base.groupBy(*SERIES, F.weekday("ds").alias("wd")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"),
        F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"),
        F.min("ds").alias("mn"),
        F.max("ds").alias("mx"),
    )


def merged_statistics(rows: DataFrame) -> DataFrame:
    """Statistics of all days from statistics of disjoint sets of days."""
    return rows.groupBy(*SERIES, "wd").agg(*[F.sum(c).alias(c) for c in SUMS], F.min("mn").alias("mn"), F.max("mx").alias("mx"))


def fit_statistics(per_wd: DataFrame, weekly: bool = True, min_rows: int = S.MIN_TRAINING_DAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``fit`` from the statistics: no features are needed."""
    origin = F.to_date(F.lit(X_ORIGIN))
    tot = per_wd.groupBy(*SERIES).agg(
        F.sum("n").alias("training_rows"),
        *[F.sum(c).alias(c.upper()) for c in ("sx", "sy", "sxy", "sxx", "syy")],
        F.min("mn").alias("first_ds"),
        F.max("mx").alias("last_ds"),
    )
    n = F.col("training_rows").cast("double")
    den = n * F.col("SXX") - F.col("SX") * F.col("SX")
    slope = F.when(den != 0, (n * F.col("SXY") - F.col("SX") * F.col("SY")) / den).otherwise(F.lit(0.0))
    tot = tot.withColumn("b", slope).withColumn("a", (F.col("SY") - F.col("b") * F.col("SX")) / n)
    skipped = tot.filter(F.col("training_rows") < min_rows).select(
        *SERIES, "training_rows", F.lit("fewer than 14 days of data").alias("reason")
    )
    ok = tot.filter(F.col("training_rows") >= min_rows)
    a, b = F.col("a"), F.col("b")
    wd = per_wd.join(ok.select(*SERIES, "a", "b"), SERIES)
    sum_r = F.col("sy") - a * F.col("n") - b * F.col("sx")
    sum_r2 = (
        F.col("syy") + a * a * F.col("n") + b * b * F.col("sxx")
        - 2 * a * F.col("sy") - 2 * b * F.col("sxy") + 2 * a * b * F.col("sx")
    )
    effect = sum_r / F.col("n") if weekly else F.lit(0.0)
    wd = wd.withColumn("effect", effect).withColumn("ss", sum_r2 - 2 * F.col("effect") * sum_r + F.col("n") * F.col("effect") * F.col("effect"))
    effects = wd.select(*SERIES, "wd", "effect")
    ss = wd.groupBy(*SERIES).agg(F.sum("ss").alias("ss"))
    models = ok.join(ss, SERIES).select(
        *SERIES,
        "training_rows",
        b.alias("slope"),
        (a + b * F.datediff("first_ds", origin).cast("double")).alias("intercept"),
        F.when(F.col("training_rows") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("ss")) / (n - 1))).otherwise(F.lit(0.0)).alias("sigma"),
        "first_ds",
        "last_ds",
        F.lit(weekly).alias("weekly"),
    )
    return models, effects, skipped


def predict_at(models: DataFrame, effects: DataFrame, dates: DataFrame) -> DataFrame:
    """yhat and band for (series, ds) rows."""
    m = dates.join(models, SERIES).withColumn("x", F.datediff("ds", "first_ds").cast("double")).withColumn(
        "wd", F.weekday("ds")
    )
    m = m.join(effects, [*SERIES, "wd"], "left")
    yhat = F.col("intercept") + F.col("slope") * F.col("x") + F.coalesce("effect", F.lit(0.0))
    return m.withColumn("yhat", yhat).withColumn("yhat_lower", F.col("yhat") - Z95 * F.col("sigma")).withColumn(
        "yhat_upper", F.col("yhat") + Z95 * F.col("sigma")
    )


def forecast(models: DataFrame, effects: DataFrame, days: int = S.HORIZON_DAYS) -> DataFrame:
    """The ``days`` dates after each series' last history date (not after today)."""
    if not 1 <= days <= 90:
        raise ValueError("days must be within 1..90")
    horizon = models.select(*SERIES, F.explode(F.sequence(F.lit(1), F.lit(days))).alias("h"), "last_ds").select(
        *SERIES, F.date_add("last_ds", F.col("h")).alias("ds")
    )
    return predict_at(models, effects, horizon).select(*SERIES, "ds", "yhat", "yhat_lower", "yhat_upper")


def presented(fc: DataFrame) -> DataFrame:
    """Forecast as served: clipped at 0 and rounded to 2 places."""
    return fc.select(
        *SERIES,
        "ds",
        *[F.greatest(F.lit(0.0), F.bround(c, 2)).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")],
    )


def fit_metrics(features: DataFrame, models: DataFrame, effects: DataFrame) -> DataFrame:
    """In-sample MAE and MAPE (over non-zero actuals; NULL when there are none)."""
    s = _series(features).select(*SERIES, "ds", "y")
    p = predict_at(models, effects, s)
    err = F.abs(F.col("y") - F.col("yhat"))
    return p.groupBy(*SERIES).agg(
        F.avg(err).alias("mae"),
        (F.avg(F.when(F.col("y") != 0, err / F.col("y"))) * 100).alias("mape_pct"),
        F.count(F.lit(1)).alias("training_rows"),
    )


def horizon_demand(fc: DataFrame) -> DataFrame:
    """Projected demand = sum of yhat clipped at 0 over the horizon (never negative)."""
    return fc.groupBy(*SERIES).agg(F.sum(F.greatest(F.col("yhat"), F.lit(0.0))).alias("projected_demand"))


def backtest(features: DataFrame, test_days: int = 7) -> DataFrame:
    """hold out each series' last ``test_days`` rows; fit with and without the weekday
    term on the rest; MAE of both arms on the hold-out and the quality gate. Both arms follow from
    one table of statistics; ``features`` is read twice, for it and for the hold-out."""
    rk = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("date").desc()))
    ranked = features.withColumn("_rk", rk)
    train = ranked.filter(F.col("_rk") > test_days).drop("_rk")
    test = ranked.filter(F.col("_rk") <= test_days).select(*SERIES, F.to_date("date").alias("ds"), F.col("units_sold").cast("double").alias("y"))
    per_wd = materialize(weekday_statistics(train), "statistics")
    test = materialize(test, "hold-out")
    out = None
    for weekly in (True, False):
        models, effects, _ = fit_statistics(per_wd, weekly=weekly, min_rows=S.MIN_TRAINING_DAYS)
        p = predict_at(models, effects, test)
        mae = p.groupBy(*SERIES).agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("w" if weekly else "t"))
        out = mae if out is None else out.join(mae, SERIES)
    return out.select(
        *SERIES,
        F.col("w").alias("mae_weekly"),
        F.col("t").alias("mae_trend"),
        (F.col("w") < 0.7 * F.col("t")).alias("weekly_passes"),
    )


# ---- F1b: Fourier-term estimator per series (applyInPandas) -------------------------------------------------
FOURIER_OUT = (
    "organization_id int, product_id long, ds date, yhat double, yhat_lower double, yhat_upper double"
)


def _fourier_fit_predict(pdf: pd.DataFrame, days: int, order: int = 3, ridge: float = 1.0) -> pd.DataFrame:
    """Ridge least squares: intercept + linear trend with changepoints in the first 80 % of
    the history + Fourier terms of period 7 (a small per-series solve)."""
    pdf = pdf.sort_values("ds")
    t0 = pd.Timestamp(pdf["ds"].iloc[0])
    x = (pd.to_datetime(pdf["ds"]) - t0).dt.days.to_numpy(dtype=float)
    y = pdf["y"].to_numpy(dtype=float)
    span = max(x[-1], 1.0)
    cps = np.linspace(0, 0.8 * span, num=min(5, max(len(x) // 7, 1)) + 2)[1:-1]

    def design(xx: np.ndarray) -> np.ndarray:
        cols = [np.ones_like(xx), xx / span]
        cols += [np.maximum(0.0, xx - c) / span for c in cps]
        for k in range(1, order + 1):
            cols += [np.sin(2 * np.pi * k * xx / 7.0), np.cos(2 * np.pi * k * xx / 7.0)]
        return np.column_stack(cols)

    a = design(x)
    pen = ridge * np.eye(a.shape[1])
    pen[0, 0] = 0.0
    beta = np.linalg.solve(a.T @ a + pen, a.T @ y)
    sigma = float(np.std(y - a @ beta, ddof=1)) if len(y) > 1 else 0.0
    xf = x[-1] + np.arange(1, days + 1, dtype=float)
    yhat = design(xf) @ beta
    return pd.DataFrame(
        {
            "organization_id": pdf["organization_id"].iloc[0],
            "product_id": pdf["product_id"].iloc[0],
            "ds": [(t0 + pd.Timedelta(days=float(v))).date() for v in xf],
            "yhat": yhat,
            "yhat_lower": yhat - Z95 * sigma,
            "yhat_upper": yhat + Z95 * sigma,
        }
    )


def fit_fourier(features: DataFrame, days: int = S.HORIZON_DAYS, min_rows: int = S.MIN_TRAINING_DAYS) -> DataFrame:
    """One small solve per series; a series is at most one row per day, so the group
    handed to pandas is bounded by the history length in days, not by event volume."""
    s = features.select(*SERIES, F.to_date("date").alias("ds"), F.col("units_sold").cast("double").alias("y"))
    n = F.count(F.lit(1)).over(Window.partitionBy(*SERIES))
    s = s.withColumn("_n", n).filter(F.col("_n") >= min_rows).drop("_n")
    return s.groupBy(*SERIES).applyInPandas(lambda pdf: _fourier_fit_predict(pdf, days), FOURIER_OUT)


# ---- F6 / F7 / J10: version log and champion pointer ---------------------------------------------------------
def log_versions(versions: DataFrame | None, run: DataFrame, run_label: str) -> DataFrame:
    """append one version per trained series: ``max(version) + 1`` per series."""
    prev = (
        versions.groupBy(*SERIES).agg(F.max("version").alias("_v"))
        if versions is not None
        else run.select(*SERIES).limit(0).withColumn("_v", F.lit(0))
    )
    new = run.join(prev, SERIES, "left").select(
        *SERIES,
        (F.coalesce("_v", F.lit(0)) + 1).cast("int").alias("version"),
        F.lit(run_label).alias("run"),
        *[c for c in run.columns if c not in SERIES],
    )
    return new if versions is None else versions.unionByName(new, allowMissingColumns=True)


def champions(versions: DataFrame) -> DataFrame:
    """Champion = newest version of each series."""
    return versions.groupBy(*SERIES).agg(F.max("version").alias("version"))


def rollback(pointers: DataFrame, versions: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """move the champion pointer of requested series to an existing version; requests for
    unknown versions are returned as rejects. ``requests``: series, version and request_id; of
    several accepted requests for a series the last one (largest request_id) holds (without that
    column: one request per series)."""
    if "request_id" not in requests.columns:
        requests = requests.withColumn("request_id", F.lit(0))
    known = versions.select(*SERIES, "version").distinct().withColumn("_known", F.lit(True))
    judged = requests.join(known, [*SERIES, "version"], "left")
    ok = judged.filter(F.col("_known")).groupBy(*SERIES).agg(F.max_by("version", "request_id").alias("version"))
    rejects = judged.filter(F.col("_known").isNull()).select(
        *SERIES,
        "version",
        F.format_string("No version %d found for 'forecast_%d'", F.col("version"), F.col("product_id")).alias("error"),
    )
    kept = pointers.join(ok.select(*SERIES), SERIES, "left_anti")
    return kept.unionByName(ok), rejects


def champion_lookup(pointers: DataFrame, versions: DataFrame) -> DataFrame:
    """The parameters of each series' champion (pointer x version log)."""
    return pointers.join(versions, [*SERIES, "version"], "inner")


# ---- F2 + F6 + F8: one retrain job over stored statistics --------------------------------------------------
def _shape(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


INT, LONG, DOUBLE, DATE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.StringType()
TRAINING = {
    "statistics": _shape(organization_id=INT, product_id=LONG, wd=INT, n=LONG, sx=DOUBLE, sy=DOUBLE, sxy=DOUBLE, sxx=DOUBLE, syy=DOUBLE, mn=DATE, mx=DATE),
    "versions": _shape(
        organization_id=INT, product_id=LONG, version=INT, run=TEXT, training_rows=LONG, slope=DOUBLE, intercept=DOUBLE, sigma=DOUBLE, first_ds=DATE, last_ds=DATE
    ),
    "champions": _shape(organization_id=INT, product_id=LONG, version=INT),
}
TRAINED_DAY = "trained_day"


def training_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, TRAINING, {"champions": SERIES})


def retrain(store: Store, fact: DataFrame, organizations: DataFrame, until: str, run: str) -> DataFrame:
    """F8, one scheduled run: features of the days after the last trained one up to ``until``
    (``yyyy-MM-dd``, whole days), their statistics added to the stored ones, a fit of every series of
    active organizations from the sums, a new version per series and its champion pointer, published
    together. Only the new days' fact rows are scanned; a run that was published before is not
    repeated. Returns the versions of this run."""
    if not store.published(run):
        head = store.head()
        mark = (head.marks or {}).get(TRAINED_DAY)
        new_days = fact.where(F.col("date_id") <= until)
        if mark is not None:
            new_days = new_days.where(F.col("date_id") > str(dt.date.fromisoformat(X_ORIGIN) + dt.timedelta(days=mark)))
        sold = daily_features(active_scope(new_days, organizations))
        fresh = materialize(weekday_statistics(sold), "weekday-statistics")
        every = merged_statistics(store.read("statistics", head).unionByName(fresh.withColumn("wd", F.col("wd").cast("int"))))
        models, _, _ = fit_statistics(every)
        old = store.read("versions", head)
        newest = old.groupBy(*SERIES).agg(F.max("version").alias("_v"))
        versions = models.join(newest, SERIES, "left").withColumn("version", (F.coalesce("_v", F.lit(0)) + 1).cast("int"))
        versions = materialize(versions.withColumn("run", F.lit(run)), "retrained")
        last = (dt.date.fromisoformat(until) - dt.date.fromisoformat(X_ORIGIN)).days
        store.publish(run, {"statistics": fresh, "versions": versions, "champions": versions}, {TRAINED_DAY: last})
    return store.read("versions").where(F.col("run") == run)
