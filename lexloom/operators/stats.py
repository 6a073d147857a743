"""Outcome differences between judges of a court."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + top * d, 1 + top / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return out


def t_cdf(t: float, df: float) -> float:
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    tail = 0.5 * (front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b) if t else 0.5
    return 1 - tail if t > 0 else tail


def t_quantile(p: float, df: float | None) -> float | None:
    """By bisection; null for degrees of freedom that aren't positive numbers."""
    if df is None or not df > 0 or math.isinf(df):
        return None
    lo, hi = -1.0, 1.0
    while t_cdf(hi, df) < p:
        hi *= 2
    while t_cdf(lo, df) > p:
        lo *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_cdf(mid, df) < p else (lo, mid)
    return (lo + hi) / 2


def welch(outcomes: DataFrame, court: str = "court", judge: str = "judge", value: str = "resolution") -> DataFrame:
    """Per court and judge: mean minus the mean of the court's other judges, the Welch standard error (population variances)
    and degrees of freedom. The others' sums are the court's less the judge's, so no pair of judges is formed."""
    j = outcomes.groupBy(court, judge).agg(F.count("*").cast("double").alias("n"), F.sum(F.col(value).cast("double")).alias("s"), F.sum(F.col(value).cast("double") * F.col(value)).alias("q"))
    c = j.groupBy(court).agg(F.sum("n").alias("cn"), F.sum("s").alias("cs"), F.sum("q").alias("cq"))
    per = F.try_divide  # filters may be moved below these divisions, so none of them may fail
    x = j.join(c, court).where("cn > n").select(court, judge, "n", (F.col("cn") - F.col("n")).alias("m"), per(F.col("s"), F.col("n")).alias("a"), per(F.col("cs") - F.col("s"), F.col("cn") - F.col("n")).alias("b"), "q", "cq")
    x = x.withColumn("va", per(F.greatest(per(F.col("q"), F.col("n")) - F.col("a") * F.col("a"), F.lit(0.0)), F.col("n"))).withColumn("vb", per(F.greatest(per(F.col("cq") - F.col("q"), F.col("m")) - F.col("b") * F.col("b"), F.lit(0.0)), F.col("m")))
    v = F.col("va") + F.col("vb")
    df = per(v * v, per(F.col("va") * F.col("va"), F.col("n") - 1) + per(F.col("vb") * F.col("vb"), F.col("m") - 1))
    return x.where(v > 0).where("n > 1 and m > 1").select(court, judge, (F.col("a") - F.col("b")).alias("diff"), F.sqrt(v).alias("se"), df.alias("df"))


def court_variation(outcomes: DataFrame, level: float = 0.975, **names: str) -> DataFrame:
    """welch with bounds and whether they have the same sign. The quantile is computed once for each value of a batch."""
    @F.pandas_udf("double")
    def quantile(df: pd.Series) -> pd.Series:  # each value of a batch is computed once
        return df.map({v: t_quantile(level, v) for v in df.dropna().unique()})

    x = welch(outcomes, **names).withColumn("_t", quantile("df"))
    x = x.withColumn("lower", F.col("diff") - F.col("_t") * F.col("se")).withColumn("upper", F.col("diff") + F.col("_t") * F.col("se")).drop("_t")
    return x.withColumn("significant", F.signum("lower") == F.signum("upper"))
