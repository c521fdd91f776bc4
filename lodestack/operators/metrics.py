"""Time series and statistics over (entity, period, value) and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(entity: list[str], period: str):
    return (Window.partitionBy(*entity) if entity else Window.partitionBy(F.lit(0))).orderBy(period)


def change(df: DataFrame, value: str, entity: list[str], period: str, lag: int, to: str) -> DataFrame:
    """Relative change to ``lag`` rows before (WIN-1, WIN-2, WIN-4, WIN-11); periods without gaps are expected."""
    before = F.lag(value, lag).over(_by(entity, period))
    return df.withColumn(to, F.try_divide(F.col(value) - before, before))


def trailing_sum(df: DataFrame, value: str, entity: list[str], period: str, n: int = 4, to: str = "ttm") -> DataFrame:
    """The sum over n rows, null until there are n (WIN-3)."""
    w = _by(entity, period).rowsBetween(1 - n, 0)
    return df.withColumn(to, F.when(F.count(value).over(w) == n, F.sum(value).over(w)))


def moving_average(df: DataFrame, value: str, entity: list[str], period: str, n: int, to: str = "average") -> DataFrame:
    """WIN-5."""
    return df.withColumn(to, F.avg(value).over(_by(entity, period).rowsBetween(1 - n, 0)))


def percentile_position(df: DataFrame, value: str, entity: list[str], to: str = "position") -> DataFrame:
    """percent_rank of each value in its entity's history (WIN-6)."""
    return df.withColumn(to, F.percent_rank().over((Window.partitionBy(*entity) if entity else Window.partitionBy(F.lit(0))).orderBy(value)))


def seasonal_deviation(df: DataFrame, value: str, season: list[str], to: str = "deviation") -> DataFrame:
    """Value less the season's mean (WIN-7)."""
    return df.withColumn(to, F.col(value) - F.avg(value).over(Window.partitionBy(*season)))


def running_path(df: DataFrame, net: str, entity: list[str], period: str, opening: Column | float = 0.0, to: str = "stock") -> DataFrame:
    """Opening stock and the running sum of net flows (WIN-8)."""
    start = opening if isinstance(opening, Column) else F.lit(opening)
    return df.withColumn(to, start + F.sum(net).over(_by(entity, period).rowsBetween(Window.unboundedPreceding, 0)))


def lag_correlations(df: DataFrame, x: str, y: str, entity: list[str], period: str, lags: list[int]) -> DataFrame:
    """corr(x, y k rows before) for each k: lag and correlation (WIN-10)."""
    w = _by(entity, period)
    wide = df.select(x, *(F.lag(y, k).over(w).alias(f"_{k}") for k in lags)).agg(*(F.corr(x, f"_{k}").alias(f"_{k}") for k in lags))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(k).alias("lag"), F.col(f"_{k}").alias("correlation")) for k in lags))).alias("r")).select("r.*")


def beta(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, correlation and R² of y on x (AGG-15, AGG-16)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.corr(y, x).alias("correlation"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def function_shape(df: DataFrame, x: str, y: str) -> DataFrame:
    """The shape whose transformed regression explains most (CLS-17): linear, exponential, log, power, inverted U, logistic or periodic.

    R² of each fit in one pass; the logistic scale is 1.001 times the largest y, the period 12 (both ours).
    """
    top, mean = df.agg(F.max(y), F.avg(x)).first()  # one row
    yy, xx, d = F.col(y), F.col(x), df
    logit = F.when((yy > 0) & F.lit(bool(top and top > 0)), F.ln(yy / (F.lit(1.001 * float(top or 1)) - yy)))
    fits = {
        "linear": (yy, xx), "exponential": (F.when(yy > 0, F.ln(yy)), xx), "log": (yy, F.when(xx > 0, F.ln(xx))), "power": (F.when(yy > 0, F.ln(yy)), F.when(xx > 0, F.ln(xx))),
        "inverted_u": (yy, F.pow(xx - F.lit(float(mean or 0)), F.lit(2))), "logistic": (logit, xx), "periodic": (yy, F.sin(2 * 3.141592653589793 * xx / 12)),
    }
    wide = d.agg(*(F.regr_r2(a, b).alias(k) for k, (a, b) in fits.items()))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(k).alias("shape"), F.coalesce(F.col(k), F.lit(0.0)).alias("r2")) for k in fits))).alias("r")).select("r.*")


def concentration(df: DataFrame, market: list[str], member: str, value: str) -> DataFrame:
    """Sum of squared shares (AGG-19; our choice among the concentration measures)."""
    per = df.groupBy(*market, member).agg(F.sum(value).alias("v"))
    total = per.groupBy(*market).agg(F.sum("v").alias("t"), F.sum(F.col("v") * F.col("v")).alias("s"))
    return total.select(*market, F.try_divide(F.col("s"), F.col("t") * F.col("t")).alias("hhi"))


def bank_screen(df: DataFrame, dividend: str, shrinking: str, quality: str, least: float) -> DataFrame:
    """Drops low dividends and shrinking regions, then orders by dividend and cash quality (FIL-23, SORT-7)."""
    return df.where((F.col(dividend) >= least) & ~F.col(shrinking)).orderBy(F.desc(dividend), F.desc(quality))


def comparable(df: DataFrame, grade: str, value: str, to: str = "place") -> DataFrame:
    """Rank within the same grade only; grade 0 is left out (JOIN-20, FIL-22)."""
    return df.where(F.col(grade) > 0).withColumn(to, F.rank().over(Window.partitionBy(grade).orderBy(F.desc(value))))


def indicator_validity(df: DataFrame, regime: str, price: str, indicators: list[str]) -> DataFrame:
    """Per regime the correlation of each indicator with the price (FN-M14)."""
    return df.groupBy(regime).agg(*(F.corr(price, i).alias(i) for i in indicators))


def backtest(df: DataFrame, signal: str, outcome: str, entity: list[str], period: str) -> DataFrame:
    """How often the sign of the signal's change foretold that of the outcome's next change (AGG-15): n, hits and rate."""
    w = _by(entity, period)
    steps = df.select(F.signum(F.col(signal) - F.lag(signal).over(w)).alias("s"), F.signum(F.lead(outcome).over(w) - F.col(outcome)).alias("o")).where("s IS NOT NULL AND o IS NOT NULL AND s != 0")
    return steps.agg(F.count("*").alias("n"), F.count_if(F.col("s") == F.col("o")).alias("hits")).withColumn("rate", F.try_divide("hits", "n"))
