"""Join helpers.

No join here carries a broadcast hint: the planner broadcasts a side whose size
in bytes is below ``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution
does so once the true size is known, or splits skewed partitions of a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_unique(df: DataFrame, keys, what: str) -> DataFrame:
    """Fail when a lookup table repeats a key (a dict lookup needs unique keys)."""
    dup = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"{what} has duplicate keys, e.g. {dup[0].asDict()}")
    return df
