"""Column-expression builders (pure Catalyst expressions, no Python UDFs)."""

from kerbflow.functions.numeric import (  # noqa: F401
    clean_double, colour_triple, finite_or_null, pick_float, to_int,
)
from kerbflow.functions.timefn import (  # noqa: F401
    floor_hour, hours_between, iso_text, parse_time, weekday_mon0,
)
