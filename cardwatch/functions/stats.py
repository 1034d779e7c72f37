"""Welch's test and effect size as column expressions over summary statistics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_STEPS = 2000  # even, for Simpson's rule


def _cosine_power_area(low: Column, high: Column, power: Column) -> Column:
    """Simpson's rule for the integral of cos(x)**power from low to high."""
    step = (high - low) / _STEPS

    def height(index: Column) -> Column:
        weight = (
            F.when((index == 0) | (index == _STEPS), 1.0).when(index % 2 == 1, 4.0).otherwise(2.0)
        )
        base = F.greatest(F.cos(low + step * index), F.lit(0.0))
        return weight * F.pow(base, power)

    points = F.sequence(F.lit(0), F.lit(_STEPS))
    return F.aggregate(points, F.lit(0.0), lambda total, i: total + height(i)) * step / 3


def student_two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom.

    With x = sqrt(df) * tan(a) the density is proportional to cos(a)**(df - 1), so
    the tail is a ratio of two areas and needs no gamma function.  For large df the
    mass sits near a = 0; the range is cut where it has fallen below exp(-72).
    """
    limit = F.least(F.lit(3.141592653589793 / 2), 12.0 / F.sqrt(df))
    start = F.least(F.atan(F.abs(t) / F.sqrt(df)), limit)
    tail = _cosine_power_area(start, limit, df - 1)
    return F.least(F.lit(1.0), tail / _cosine_power_area(F.lit(0.0), limit, df - 1))


def welch(mean_a: Column, var_a: Column, n_a: Column,
          mean_b: Column, var_b: Column, n_b: Column) -> dict[str, Column]:
    """t, degrees of freedom and p of b against a, from sample variances.

    Without any spread the test has no t; equal means then give p = 1 and
    different means p = 0.
    """
    se_a, se_b = var_a / n_a, var_b / n_b
    se = se_a + se_b
    spread = se > 0
    t = F.when(spread, (mean_b - mean_a) / F.sqrt(se))
    df = F.when(spread, se * se / (se_a * se_a / (n_a - 1) + se_b * se_b / (n_b - 1)))
    no_spread = F.when(mean_a == mean_b, 1.0).when(mean_a != mean_b, 0.0)
    p = F.when(spread, student_two_sided_p(t, df)).otherwise(no_spread)
    return {"t_statistic": t, "degrees_of_freedom": df, "p_value": p}


def cohens_d(mean_a: Column, std_a: Column, mean_b: Column, std_b: Column) -> Column:
    """Gain of b over a in pooled standard deviations; null without spread."""
    pooled = F.sqrt((std_a * std_a + std_b * std_b) / 2)
    return F.when(pooled > 0, (mean_b - mean_a) / pooled)
