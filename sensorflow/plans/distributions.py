"""Distributions and distinct counts from stored sketches.

A quantile sketch of the values and a set sketch of the sensors are kept per group;
sketches of days merge into those of any span, so a dashboard reads
sketches and never measurements.  The rank of a quantile is within
``RANK_ERROR`` of the one asked for; distinct counts are exact up to ``2 ** SET_BITS``
and within some 1.6 % beyond (both by the sketches' own bounds, at 99 %).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 400
RANK_ERROR = 0.0075
SET_BITS = 12


def sketched(rows: DataFrame, by: list[str], value: str = "value", member: str = "sensor_id") -> DataFrame:
    """``by, quantiles, members``.  Values that are NULL or NaN are in no sketch; a
    group without any has an empty one."""
    number = F.when(~F.isnan(value), F.col(value))
    return rows.groupBy(*by).agg(F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias("quantiles"),
                                 F.theta_sketch_agg(F.col(member), F.lit(SET_BITS)).alias("members"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of the groups ``by``, from sketches of finer ones."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
                                     F.theta_union_agg("members", F.lit(SET_BITS)).alias("members"))


def described(sketches: DataFrame, at: dict[str, float]) -> DataFrame:
    """The columns other than the sketches, with ``n``, ``sensors`` and a value for
    each name and rank of ``at`` (0 and 1: least and greatest)."""
    n = F.kll_sketch_get_n_double("quantiles")
    values = {name: F.when(n > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(rank)))) for name, rank in at.items()}
    return sketches.withColumns({"n": n, "sensors": F.theta_sketch_estimate("members"), **values}).drop("quantiles", "members")
