"""Service catalogue, required-column guards and the conform step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Service:
    name: str
    first_year: int
    last_year: int          # inclusive
    pickup_col: str
    dropoff_col: str

    @property
    def years(self) -> list[int]:
        return list(range(self.first_year, self.last_year + 1))


# The four trip services, their valid file years and time columns.
SERVICES = (
    Service("yellow", 2012, 2025, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    Service("green", 2016, 2025, "lpep_pickup_datetime", "lpep_dropoff_datetime"),
    Service("fhv", 2016, 2025, "pickup_datetime", "dropoff_datetime"),
    Service("fhvhv", 2019, 2025, "pickup_datetime", "dropoff_datetime"),
)

# Money columns coerced to numbers before the price rule.
MONEY_COLUMNS = ("fare_amount", "mta_tax", "improvement_surcharge", "tolls_amount",
                 "congestion_surcharge", "airport_fee", "extra", "tip_amount", "total_amount")

# stream/service aliases tried when a canonical field is missing.
FIELD_ALIASES = {
    "trip_distance": ("trip_miles",),
    "tip_amount": ("tips",),
    "total_amount": ("driver_pay",),
}


def service(name: str, catalogue=SERVICES) -> Service:
    for s in catalogue:
        if s.name == name:
            return s
    raise KeyError(name)


def require_columns(df: DataFrame, cols, what: str = "input") -> DataFrame:
    have = {c.lower() for c in df.columns}
    missing = [c for c in cols if c.lower() not in have]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def has_columns(df: DataFrame, cols) -> bool:
    have = {c.lower() for c in df.columns}
    return all(c.lower() in have for c in cols)


def standardize_columns(df: DataFrame, pickup_col: str, dropoff_col: str) -> DataFrame:
    """All names in lower case, the service's two time columns under their common names."""
    common = {pickup_col.lower(): "pickup_datetime", dropoff_col.lower(): "dropoff_datetime"}
    return df.withColumnsRenamed({c: common.get(c.lower(), c.lower()) for c in df.columns})


def annotate_year(df: DataFrame, time_col: str = "pickup_datetime") -> DataFrame:
    return df.withColumn("year", F.year(time_col))


def conform(df: DataFrame, svc: Service) -> DataFrame:
    """Raw service frame -> common names + ``year`` (ingest shape)."""
    require_columns(df, [svc.pickup_col, svc.dropoff_col], f"{svc.name} trips")
    return annotate_year(standardize_columns(df, svc.pickup_col, svc.dropoff_col))


def resolve(df: DataFrame, name: str):
    """Column for a canonical field, falling back to its service alias; None if absent."""
    cols = {c.lower(): c for c in df.columns}
    for cand in (name,) + FIELD_ALIASES.get(name, ()):
        if cand.lower() in cols:
            return F.col(cols[cand.lower()])
    return None
