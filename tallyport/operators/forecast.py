"""Trend forecasts for many monthly series at once.

A series is (series, ym, y). All series are fitted in one aggregation with Spark's
regr_* functions (ordinary least squares over calendar days) and projected over a
future calendar with a prediction interval. Nothing is fitted on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.functions.dates import month_start
from tallyport.functions.numbers import fixed_text, round_half_up

# Weeks and days per month used to rescale monthly totals.
WEEKS_PER_MONTH = 4.345
DAYS_PER_MONTH = 30.437
DEFAULT_LEVEL = 0.80
MIN_POINTS = 4

UNITS = {"daily": "daily_gmv", "weekly": "weekly_gmv", "monthly": "period_gmv", "annual": "monthly_gmv_mean"}


@dataclass(frozen=True)
class Horizon:
    """A forecast length in weeks and the reporting step that follows from it."""

    weeks: float

    @property
    def granularity(self) -> str:
        if self.weeks <= 1:
            return "daily"
        if self.weeks <= 12:
            return "weekly"
        return "monthly" if self.weeks <= 48 else "annual"

    @property
    def periods(self) -> int:
        if self.granularity == "daily":
            return int(self.weeks * 7)
        if self.granularity == "weekly":
            return int(self.weeks)
        return max(1, round(self.weeks / (4.33 if self.granularity == "monthly" else 52)))

    @property
    def divisor(self) -> float:
        return {"weekly": WEEKS_PER_MONTH, "daily": DAYS_PER_MONTH}.get(self.granularity, 1.0)


def granularity(weeks: Column) -> Column:
    """Reporting step of a horizon column."""
    return (
        F.when(weeks <= 1, "daily").when(weeks <= 12, "weekly").when(weeks <= 48, "monthly").otherwise("annual")
    )


def periods(weeks: Column) -> Column:
    """Number of reported periods of a horizon column (ties to even, as for Horizon)."""
    whole = lambda x: F.bround(x.cast("decimal(20,6)"), 0).cast("int")
    return (
        F.when(weeks <= 1, F.floor(weeks * 7).cast("int"))
        .when(weeks <= 12, F.floor(weeks).cast("int"))
        .when(weeks <= 48, F.greatest(F.lit(1), whole(weeks / 4.33)))
        .otherwise(F.greatest(F.lit(1), whole(weeks / 52)))
    )


def series_of(rollup: DataFrame, kind: str, key: Column, value: str = "total_gmv") -> DataFrame:
    """Monthly history (series, ym, ds, y) out of a rollup, one series per key."""
    return rollup.filter(key.isNotNull()).select(
        F.concat(F.lit(kind + ":"), key).alias("series"),
        "ym",
        month_start("ym").alias("ds"),
        F.col(value).cast("double").alias("y"),
    )


def fit_trend(history: DataFrame, divisor: float = 1.0, min_points: int = MIN_POINTS) -> DataFrame:
    """Straight-line trend per series; series with too few points drop out."""
    day = F.unix_date("ds").cast("double")
    y = F.col("y") / F.lit(divisor)
    return (
        history.select("series", "ds", day.alias("x"), y.alias("y"))
        .groupBy("series")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.regr_slope("y", "x").alias("slope"),
            F.avg("x").alias("mean_x"),
            F.avg("y").alias("mean_y"),
            F.regr_sxx("y", "x").alias("sxx"),
            F.regr_syy("y", "x").alias("syy"),
            F.regr_sxy("y", "x").alias("sxy"),
            F.max("ds").alias("last_ds"),
            F.max_by("y", "ds").alias("last_y"),
        )
        .filter(F.col("points") >= min_points)
        .withColumn(
            "sigma",
            F.sqrt(F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / (F.col("points") - 2)),
        )
    )


def future_days(fits: DataFrame, horizon: Horizon) -> DataFrame:
    """Dates to predict for each series, all after its last month start.

    A horizon bounds the number of dates, so the sequence per series is short.
    """
    last, step = F.col("last_ds"), horizon.granularity
    if step == "monthly":
        dates = F.transform(
            F.sequence(F.lit(1), F.lit(horizon.periods)), lambda i: F.add_months(last, i)
        )
    else:
        days = int(horizon.weeks * 7) + 30 if step == "annual" else max(horizon.periods, 1) * 7
        dates = F.sequence(F.date_add(last, 1), F.date_add(last, days))
    return fits.withColumn("d", F.explode(dates))


def _bucket(step: str) -> Column:
    unit = {"weekly": "week", "monthly": "month", "annual": "year"}.get(step)
    return F.col("d") if unit is None else F.trunc("d", unit)


def _projected(history: DataFrame, horizon: Horizon, level: float) -> DataFrame:
    """Reporting periods of every series with unrounded values and the series' history end."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    fits = fit_trend(history, horizon.divisor)
    off = F.unix_date("d").cast("double") - F.col("mean_x")
    yhat = F.col("mean_y") + F.col("slope") * off
    spread = F.lit(z) * F.col("sigma") * F.sqrt(1 + 1 / F.col("points") + off * off / F.col("sxx"))
    by_time = Window.partitionBy("series").orderBy("bucket")
    zero = F.lit(0.0)
    shown = {"monthly": "yyyy-MM", "annual": "yyyy"}.get(horizon.granularity, "yyyy-MM-dd")
    return (
        future_days(fits, horizon)
        .select(
            "series", "points", "last_y", "d", _bucket(horizon.granularity).alias("bucket"),
            yhat.alias("yhat"), spread.alias("spread"),
        )
        .groupBy("series", "points", "last_y", "bucket")
        .agg(
            F.min("d").alias("ds"),
            F.avg("yhat").alias("yhat"),
            F.avg(F.col("yhat") - F.col("spread")).alias("lower"),
            F.avg(F.col("yhat") + F.col("spread")).alias("upper"),
        )
        .withColumn("period", F.row_number().over(by_time))
        .filter(F.col("period") <= horizon.periods)
        .select(
            "series", "points", "last_y", "period",
            F.date_format("ds", shown).alias("ds"),
            F.greatest("yhat", zero).alias("yhat"),
            F.greatest("lower", zero).alias("lower"),
            F.greatest(F.col("upper"), F.col("yhat"), zero).alias("upper"),
        )
    )


def _interval_text() -> Column:
    return F.concat(F.lit("+/- "), fixed_text((F.col("upper") - F.col("lower")) / 2, 2))


def forecast(history: DataFrame, weeks: float, level: float = DEFAULT_LEVEL) -> DataFrame:
    """(series, granularity, unit, period, ds, yhat, yhat_lower, yhat_upper, ci_range).

    Daily values are averaged per reporting period; the first period may be a
    partial week because histories end at a month start. Values never fall below
    zero and the upper bound never below the estimate.
    """
    horizon = Horizon(weeks)
    return _projected(history, horizon, level).select(
        "series",
        F.lit(horizon.granularity).alias("granularity"),
        F.lit(UNITS[horizon.granularity]).alias("unit"),
        "period",
        "ds",
        round_half_up(F.col("yhat"), 2).alias("yhat"),
        round_half_up(F.col("lower"), 2).alias("yhat_lower"),
        round_half_up(F.col("upper"), 2).alias("yhat_upper"),
        _interval_text().alias("ci_range"),
    )


def calendar(history: DataFrame, weeks: float) -> DataFrame:
    """Reported periods of each series: first day and number of averaged days."""
    horizon = Horizon(weeks)
    by_time = Window.partitionBy("series").orderBy("bucket")
    return (
        future_days(fit_trend(history, horizon.divisor), horizon)
        .select("series", "d", _bucket(horizon.granularity).alias("bucket"))
        .groupBy("series", "bucket")
        .agg(F.min("d").alias("ds"), F.count(F.lit(1)).alias("days"))
        .withColumn("period", F.row_number().over(by_time))
        .filter(F.col("period") <= horizon.periods)
        .select("series", "period", F.date_format("ds", "yyyy-MM-dd").alias("ds"), "days")
    )


def _ends(history: DataFrame, horizon: Horizon, level: float, band_pct: float, *extra: Column) -> DataFrame:
    """Per series: change from the last history value to the last forecast value."""
    change = F.when(
        (F.col("forecast_periods") >= 3) & (F.col("points") >= 3),
        (F.col("last_yhat") - F.col("last_y")) / F.nullif(F.col("last_y"), F.lit(0.0)) * 100,
    )
    return (
        _projected(history, horizon, level)
        .groupBy("series", "points", "last_y")
        .agg(
            F.count(F.lit(1)).alias("forecast_periods"),
            F.max_by("yhat", "period").alias("last_yhat"),
            *extra,
        )
        .withColumn("change", F.coalesce(change, F.lit(0.0)))
        .withColumn(
            "trend_direction",
            F.when(F.col("change") > band_pct, "up").when(F.col("change") < -band_pct, "down").otherwise("flat"),
        )
    )


def direction(history: DataFrame, weeks: float, level: float = DEFAULT_LEVEL, band_pct: float = 5.0) -> DataFrame:
    """up / down / flat per series: last forecast against last history value."""
    return _ends(history, Horizon(weeks), level, band_pct).select(
        "series", "points", "forecast_periods", round_half_up(F.col("change"), 1).alias("change_pct"),
        "trend_direction",
    )


def summary(history: DataFrame, weeks: float, level: float = DEFAULT_LEVEL, shown: int = 3) -> DataFrame:
    """One sentence per series with its direction and the first intervals."""
    horizon = Horizon(weeks)
    first = F.when(F.col("period") <= shown, F.struct("period", "ds", _interval_text().alias("ci_range")))
    intervals = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(first)), lambda x: F.concat(x["ds"], F.lit(": "), x["ci_range"])
        ),
        "; ",
    )
    return _ends(history, horizon, level, 5.0, intervals.alias("ci")).select(
        "series",
        F.concat(
            F.lit("Based on "), F.col("points").cast("string"), F.lit(" months of historical data, "),
            F.lit("total GMV is forecasted to be "), "trend_direction", F.lit(". Next "),
            F.col("forecast_periods").cast("string"), F.lit(f" {horizon.granularity} periods forecasted. "),
            F.lit("Confidence intervals: "), "ci",
        ).alias("model_summary"),
    )


# --- trend with changes of slope ---------------------------------------------------
# Candidate bends: CHANGEPOINTS month starts spread evenly over the first CHANGE_RANGE
# of a series' span; a hinge (t - c)+ per candidate. Slope changes are shrunk by a ridge
# penalty RIDGE (on the series scaled by its mean absolute value, t in years), intercept
# and first slope are not. The normal equations are summed per series in one
# aggregation and solved by Gauss-Jordan elimination in higher-order functions.
CHANGEPOINTS = 5
CHANGE_RANGE = 0.8
RIDGE = 1.0


def _hinge_basis(t: Column, span: Column) -> list[Column]:
    """1, t, and (t - c_k)+ for the candidate months c_k; t and the hinges in years."""
    bends = [F.floor(span * CHANGE_RANGE * k / (CHANGEPOINTS + 1)) for k in range(1, CHANGEPOINTS + 1)]
    return [F.lit(1.0), t / 12.0] + [F.greatest((t - c) / 12.0, F.lit(0.0)) for c in bends]


def solve(a: Column, b: Column, size: int) -> Column:
    """x with a x = b for a symmetric positive definite `a` (array of rows): Gauss-Jordan, no pivoting."""

    def step(acc: Column, k: Column) -> Column:
        rows, rhs = acc["a"], acc["b"]
        pivot = rows[k][k]
        new_rows = F.transform(rows, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / pivot)).otherwise(
            F.transform(row, lambda v, j: v - row[k] / pivot * rows[k][j])))
        new_rhs = F.transform(rhs, lambda v, i: F.when(i == k, v / pivot).otherwise(v - rows[i][k] / pivot * rhs[k]))
        return F.struct(new_rows.alias("a"), new_rhs.alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.struct(a.alias("a"), b.alias("b")), step)["b"]


def fit_changepoints(history: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """Per series: points, slopes at start and end (per month), the fitted last and next month.

    Defined cases: series with fewer than `min_points` months drop out; null values are
    skipped; a series of zeros is fitted as zeros; candidates past the last month have
    all-zero hinges and, with the ridge, a zero change.
    """
    size = 2 + CHANGEPOINTS
    rows = history.where(F.col("y").isNotNull() & F.col("ds").isNotNull())
    ends = rows.groupBy("series").agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
                                      F.count(F.lit(1)).alias("points"), F.avg(F.abs("y")).alias("scale"))
    ends = ends.where(F.col("points") >= min_points)
    t = F.months_between("ds", "first_ds").cast("double")
    span = F.months_between("last_ds", "first_ds").cast("double")
    basis = _hinge_basis(t, span)
    scaled = F.col("y") / F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0))
    sums = rows.join(ends, "series").groupBy("series", "points", "first_ds", "last_ds", "scale").agg(
        *[F.sum(basis[i] * basis[j]).alias(f"a{i}_{j}") for i in range(size) for j in range(i, size)],
        *[F.sum(basis[i] * scaled).alias(f"b{i}") for i in range(size)])
    a = F.array(*[F.array(*[F.col(f"a{min(i, j)}_{max(i, j)}") + (RIDGE if i == j and i >= 2 else 0.0) for j in range(size)])
                  for i in range(size)])
    b = F.array(*[F.col(f"b{i}") for i in range(size)])
    solved = sums.select("series", "points", "scale", span.alias("span"), solve(a, b, size).alias("beta"))
    unit = F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0))
    beta = [F.col("beta")[i] * unit for i in range(size)]

    def value_at(months: Column) -> Column:
        return sum((p * c for p, c in zip(_hinge_basis(months, F.col("span")), beta)), F.lit(0.0))

    return solved.select(
        "series", "points",
        (beta[1] / 12).alias("slope_start"),
        (sum(beta[1:], F.lit(0.0)) / 12).alias("slope_end"),
        value_at(F.col("span")).alias("yhat_last"),
        value_at(F.col("span") + 1).alias("yhat_next"),
    )
