"""Serving reads over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.casts import instant_to_utc_ntz
from sensorflow.functions.cells import cell, coarser
from sensorflow.operators.dedupe import dedupe_by_key
from sensorflow.operators.joins import bounded_broadcast

# countries are a small, closed set; broadcast only below this proven bound
COUNTRY_BROADCAST_ROWS = 100_000
# measured quantities (pm25, o3, ...) are a small, closed set as well
PARAMETER_BROADCAST_ROWS = 100_000


def measurement_star(fact: DataFrame, location: DataFrame, country: DataFrame,
                     sensor: DataFrame | None = None, parameter: DataFrame | None = None) -> DataFrame:
    """Fact ⋈ location ⋈ country (⋈ sensor ⋈ parameter when given), inner
    joins along the declared foreign keys.  Location attributes other than
    its key, name and country are carried along."""
    extra = [c for c in location.columns if c not in ("location_id", "name", "country_id")
             and c not in fact.columns]
    star = fact.join(location.select("location_id", F.col("name").alias("location_name"),
                                     "country_id", *extra), "location_id")
    ctry = bounded_broadcast(country.select(F.col("id").alias("country_id"),
                                            F.col("name").alias("country_name")),
                             COUNTRY_BROADCAST_ROWS)
    star = star.join(ctry, "country_id")
    if sensor is not None:
        star = star.join(sensor.select("sensor_id", F.col("name").alias("sensor_name"),
                                       "parameter_id"), "sensor_id")
        if parameter is not None:
            par = bounded_broadcast(parameter.select("parameter_id", F.col("name").alias("parameter_name"),
                                                     "unit"), PARAMETER_BROADCAST_ROWS)
            star = star.join(par, "parameter_id")
    return star


def dimension_stats(star: DataFrame, by: list[str]) -> DataFrame:
    """Count / min / avg / max / sum of value per dimension combination.

    Plain SQL aggregates of the values as they are: NULL values are skipped,
    a NaN makes avg, sum and max NaN (Spark orders NaN last), an infinity makes
    avg and sum infinite.  Nothing is rounded here.
    """
    v = F.col("value")
    return star.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("min_value"), F.avg(v).alias("avg_value"),
        F.max(v).alias("max_value"), F.sum(v).alias("sum_value"))


def dimension_stats_of(fact: DataFrame, location: DataFrame, country: DataFrame, sensor: DataFrame,
                       parameter: DataFrame, by: list[str]) -> DataFrame:
    """J1 + J2 for facts too large to shuffle: partial aggregates per
    (location, sensor) are joined with the dimensions instead of the rows, then
    merged.  Same result as ``dimension_stats(measurement_star(...), by)``; a
    sum's last bits may differ, as with any other order of addition."""
    v = F.col("value")
    part = fact.groupBy("location_id", "sensor_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.sum(v).alias("total"))
    star = measurement_star(part, location, country, sensor, parameter)
    return star.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("lo").alias("min_value"),
        F.try_divide(F.sum("total"), F.sum("n_values")).alias("avg_value"),
        F.max("hi").alias("max_value"), F.sum("total").alias("sum_value"))


# fixed-width buckets in microseconds; calendar units fall back to date_trunc
_UNIT_MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}


def time_bucket(ts_instant, unit: str = "hour"):
    """UTC wall-clock bucket (TIMESTAMP_NTZ) of an instant, independent of the
    session time zone for fixed-width units."""
    if unit in _UNIT_MICROS:
        width = F.lit(_UNIT_MICROS[unit])
        micros = F.unix_micros(ts_instant)
        start = micros - F.pmod(micros, width)  # whole numbers; a quotient of doubles is not exact above 2^53
        return F.timestamp_add("MICROSECOND", start, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.date_trunc(unit, instant_to_utc_ntz(ts_instant)).cast("timestamp_ntz")


def time_series(fact: DataFrame, by: list[str], unit: str = "hour") -> DataFrame:
    """Per ``by`` and time bucket (UTC wall clock), count and average value."""
    bucket = time_bucket(F.col("timestamp_utc"), unit)
    return fact.groupBy(*by, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value"))


def heat_map(fact: DataFrame, levels: list[int], value: str = "value", by_day: bool = True) -> DataFrame:
    """J3 as a map: ``level, cell[, day], n, avg_value`` per grid cell at every
    level of ``levels`` (and UTC day).

    Rows are aggregated once, at the finest level; the coarser ones are rolled
    up from those partial sums by grouping sets, so only cells are expanded and
    never rows.  Rows without a usable place are left out; NULL values count in
    ``n`` only, NaN makes the averages around it NaN."""
    finest, cols = max(levels), [f"__l{lv}" for lv in levels]
    day = [F.to_date(instant_to_utc_ntz(F.col("timestamp_utc"))).alias("day")] if by_day else []
    cells = (fact.select(cell("latitude", "longitude", finest).alias("__cell"), *day, F.col(value).alias("__v"))
             .filter("__cell IS NOT NULL").groupBy("__cell", *(["day"] if by_day else []))
             .agg(F.count(F.lit(1)).alias("__n"), F.count("__v").alias("__k"), F.sum("__v").alias("__s")))
    keyed = cells.select("*", *[coarser("__cell", finest - lv).alias(c) for lv, c in zip(levels, cols)]).drop("__cell")
    more = [F.col("day")] if by_day else []
    sets = keyed.groupingSets([[F.col(c), *more] for c in cols], *[F.col(c) for c in cols], *more)
    rolled = sets.agg(F.sum("__n").alias("n"), F.try_divide(F.sum("__s"), F.sum("__k")).alias("avg_value"),
                      *[F.grouping(c).alias(f"{c}_out") for c in cols])
    level = F.coalesce(*[F.when(F.col(f"{c}_out") == 0, lv) for lv, c in zip(levels, cols)])
    return rolled.select(level.alias("level"), F.coalesce(*cols).alias("cell"), *(["day"] if by_day else []), "n", "avg_value")


def current_reading(fact: DataFrame, sensor_col: str = "sensor_id") -> DataFrame:
    """Newest measurement per sensor (ties broken by the key)."""
    return dedupe_by_key(fact, sensor_col, ["timestamp_utc", "latest_id"], keep_null_keys=False)
