"""Validity rules, per-year quality report and the clean filter.

Each rule is wrapped in ``coalesce(rule, false)``: a comparison with a missing
value must make the row *invalid*, while SQL would propagate null and
``NOT null`` is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.numeric import clean_double
from kerbflow.functions.timefn import hours_between
from kerbflow.schema import FIELD_ALIASES, MONEY_COLUMNS, resolve

# The distance rule's speed bound and the valid pickup years.
MAX_SPEED_MPH = 75.0
VALID_YEARS = (2011, 2025)

# Every column that a rule can read: the money columns, the distance, and their service aliases.
RULE_COLUMNS = (*MONEY_COLUMNS, "trip_distance", *(a for names in FIELD_ALIASES.values() for a in names))


def coerce_numeric(df: DataFrame, cols=MONEY_COLUMNS) -> DataFrame:
    """Money columns to DOUBLE; unparsable text and NaN become null."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    lower = {c.lower(): c for c in df.columns}
    repl = {}
    for c in cols:
        if c.lower() in lower:
            name = lower[c.lower()]
            repl[name] = clean_double(F.col(name), types[name])
    return df.withColumns(repl) if repl else df


def time_rule(valid_years=VALID_YEARS) -> Column:
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    gap = F.year(d) - F.year(p)
    crosses = (gap == 1) & (F.month(p) == 12) & (F.dayofmonth(p) == 31) & \
        (F.month(d) == 1) & (F.dayofmonth(d) == 1)
    rule = (p < d) & ((gap == 0) | crosses) & F.year(p).between(*valid_years)
    return F.coalesce(rule, F.lit(False))


def distance_rule(df: DataFrame, max_speed: float = MAX_SPEED_MPH) -> Column:
    dist = resolve(df, "trip_distance")
    if dist is None:
        return F.lit(True)          # rule skipped when the service has no distance
    limit = hours_between("pickup_datetime", "dropoff_datetime") * F.lit(max_speed)
    return F.coalesce((dist > 0) & (dist < limit), F.lit(False))


def price_rule(df: DataFrame) -> Column:
    def c(name):
        return resolve(df, name)
    total = c("total_amount")
    if total is None:
        return F.lit(True)
    nonneg = [c(n) for n in ("extra", "mta_tax", "tip_amount", "tolls_amount",
                             "improvement_surcharge", "congestion_surcharge", "airport_fee")]
    rule = total > 0
    for x in nonneg:
        if x is not None:
            rule = rule & (x >= 0)
    parts = [c(n) for n in ("fare_amount", "mta_tax", "improvement_surcharge", "tolls_amount",
                            "congestion_surcharge", "airport_fee")]
    parts = [x for x in parts if x is not None]
    if parts:
        charges = parts[0]
        for x in parts[1:]:
            charges = charges + x
        rule = rule & (charges > 0) & (charges <= total)
    return F.coalesce(rule, F.lit(False))


def quality_flags(df: DataFrame, valid_years=VALID_YEARS, max_speed: float = MAX_SPEED_MPH) -> DataFrame:
    """Adds time_valid, distance_valid, price_valid, clean (all non-null booleans)."""
    df = coerce_numeric(df, RULE_COLUMNS)
    return df.withColumns({
        "time_valid": time_rule(valid_years),
        "distance_valid": distance_rule(df, max_speed),
        "price_valid": price_rule(df),
    }).withColumn("clean", F.col("time_valid") & F.col("distance_valid") & F.col("price_valid"))


def quality_stats(flagged: DataFrame, by=("year",)) -> DataFrame:
    """Per-year report: total and the three (overlapping) invalid counts.

    One hash aggregate with map-side partial aggregation; the result has one
    row per year, so the final sort is on a tiny table.
    """
    by = list(by)
    return (flagged.where(F.col(by[0]).isNotNull())
            .groupBy(*by)
            .agg(F.count(F.lit(1)).alias("total_trips"),
                 F.count_if(~F.col("time_valid")).alias("invalid_timestamps"),
                 F.count_if(~F.col("distance_valid")).alias("invalid_distances"),
                 F.count_if(~F.col("price_valid")).alias("invalid_prices"),
                 F.count_if(F.col("clean")).alias("valid_trip_count"))
            .orderBy(*by))


def clean_trips(df: DataFrame, valid_years=VALID_YEARS, max_speed: float = MAX_SPEED_MPH) -> DataFrame:
    """Rows passing all three rules (flag columns dropped)."""
    flagged = quality_flags(df, valid_years, max_speed)
    return flagged.where("clean").drop("time_valid", "distance_valid", "price_valid", "clean")
