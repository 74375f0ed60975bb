"""Forecast error measures as aggregate Column expressions, usable under any grouping."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _total(truth: Column) -> Column:
    """Demand total used as denominator, at least one trip."""
    return F.greatest(F.coalesce(F.sum(truth), F.lit(0.0)), F.lit(1.0))


def clip(prediction: Column) -> Column:
    return F.when(prediction.isNotNull(), F.greatest(prediction, F.lit(0.0)))


def wape(truth: Column, prediction: Column) -> Column:
    return F.sum(F.abs(truth - prediction)) / _total(truth)


def bias(truth: Column, prediction: Column) -> Column:
    return F.sum(prediction - truth) / _total(truth)


def measures(truth: Column, prediction: Column, threshold: Column) -> dict[str, Column]:
    """MAE, RMSE, WAPE and high-demand precision/recall of a prediction floored at zero."""
    guess = clip(prediction)
    hit = F.count_if((truth >= threshold) & (guess >= threshold))
    return {
        "mae": F.avg(F.abs(truth - guess)),
        "rmse": F.sqrt(F.avg((truth - guess) * (truth - guess))),
        "wape": wape(truth, guess),
        "high_demand_precision": hit / F.greatest(F.count_if(guess >= threshold), F.lit(1)),
        "high_demand_recall": hit / F.greatest(F.count_if(truth >= threshold), F.lit(1)),
    }


def relative_improvement(base: Column, candidate: Column) -> Column:
    """(base - candidate) / base; NULL when the base is zero."""
    return F.try_divide(base - candidate, base)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of the rows where both are known; NULL when either does not vary."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
