"""Time helpers that stay on TIMESTAMP_NTZ (trip times carry no zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_hour(c) -> Column:
    """Truncate to the hour, keeping TIMESTAMP_NTZ.

    ``date_trunc`` returns a zoned TIMESTAMP; building the value from its
    fields avoids any dependence on the session time zone.
    """
    t = _col(c)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0).cast("decimal(8,6)"))


def hours_between(start, end) -> Column:
    """(end - start) in hours as DOUBLE, microsecond exact."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(3.6e9)


def parse_time(c) -> Column:
    """Text or timestamp to TIMESTAMP_NTZ; unparsable text becomes null."""
    return _col(c).cast("string").try_cast("timestamp_ntz")


def weekday_mon0(c) -> Column:
    """Day of week with Monday = 0 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(_col(c))


def iso_text(c) -> Column:
    """ISO-8601 text of a timestamp (``T`` separator, microseconds if any)."""
    t = _col(c)
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), None).when(micros == "000000", base) \
        .otherwise(F.concat(base, F.lit("."), micros))
