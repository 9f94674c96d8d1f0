"""Risk formulas as column expressions over already aggregated inputs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketframe import constants as C

_ROOT_YEAR = math.sqrt(C.MONTHS_PER_YEAR)


def annualised_return(mean: Column, observations: Column, min_obs: int = C.MIN_RETURNS) -> Column:
    """``(1 + mean)^12 - 1``, NULL below the minimum number of returns."""
    grown = F.pow(F.lit(1.0) + mean, F.lit(float(C.MONTHS_PER_YEAR))) - F.lit(1.0)
    return F.when(observations >= min_obs, grown)


def annualised_volatility(deviation: Column) -> Column:
    return deviation * F.lit(_ROOT_YEAR)


def headline_sharpe(annual_return: Column, volatility: Column, rate: Column) -> Column:
    """Excess annualised return per unit of volatility, 0 when volatility is not positive."""
    return F.when(volatility > 0, (annual_return - rate) / volatility).otherwise(F.lit(0.0))


def excess_sharpe(mean: Column, deviation: Column, annual_rate: Column) -> Column:
    """Sharpe of a monthly window: the rate is constant inside it, so it only shifts the mean."""
    ratio = (mean - annual_rate / C.MONTHS_PER_YEAR) / deviation * F.lit(_ROOT_YEAR)
    return F.when(deviation > 0, ratio).otherwise(F.lit(0.0))


def relative_premium(left: Column, right: Column) -> Column:
    """``(left - right) / |right| * 100``, 0 when the right side is 0."""
    return F.when(right != 0, (left - right) / F.abs(right) * 100).when(right == 0, F.lit(0.0))
