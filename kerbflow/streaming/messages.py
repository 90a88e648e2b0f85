"""Trip messages: JSON encoding (producer side) and tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.numeric import finite_or_null, first_within, text_to_double
from kerbflow.functions.timefn import parse_time

# The message fields each source publishes.
YELLOW_FIELDS = ("total_amount", "trip_distance", "pulocationid", "dolocationid", "tip_amount")
FHVHV_FIELDS = ("driver_pay", "trip_miles", "pulocationid", "dolocationid", "tips")

KAFKA_SCHEMA = "key string, value string, topic string, partition int, offset bigint"

# Every field arrives as text: a declared DOUBLE would turn "1.5" into null.
MESSAGE_FIELDS = ("pickup_datetime", "total_amount", "trip_distance", "pulocationid", "dolocationid",
                  "tip_amount", "driver_pay", "trip_miles", "tips", "source", "passenger_count")
MESSAGE_SCHEMA = ", ".join(f"{f} string" for f in MESSAGE_FIELDS) + ", _corrupt string"


def strip_json_quotes(c: Column) -> Column:
    """from_json into STRING keeps the quotes of a non-numeric token ("NaN")."""
    return F.regexp_replace(c, r'^"(.*)"$', "$1")


# Fields that hold numbers; the ids after them don't take true and false for 1 and 0.
_MEASURES = ("trip_distance", "trip_miles", "tip_amount", "tips", "total_amount", "driver_pay", "passenger_count")
_NUMBERS = (*_MEASURES, "pulocationid", "dolocationid")


def _number(text: Column, at: Column) -> Column:
    """A finite double from a field's text, or null; JSON true and false count as 1 and 0 in a measure."""
    t = strip_json_quotes(text)
    flag = F.when(t == "true", F.lit("1")).when(t == "false", F.lit("0")).otherwise(t)
    return finite_or_null(text_to_double(F.when(at < len(_MEASURES), flag).otherwise(t)))


def parse_messages(raw: DataFrame, value_col: str = "value", keep=("key", "topic", "partition", "offset")) -> DataFrame:
    """Kafka-shaped rows -> typed trip fields; adds ``_corrupt`` (non-null for
    text that is not a JSON object). Cross-service fallbacks follow the stream
    rules: distance = trip_distance | trip_miles (>= 0), tip = tip_amount | tips
    (>= 0), total = total_amount | driver_pay; 0.0 when none is usable.

    Each row is read as JSON once and each number is cleaned once: both steps stand
    behind a generator, which the optimiser neither merges nor pushes filters through.
    """
    keep = [k for k in keep if k in raw.columns]
    j = F.from_json(F.col(value_col).cast("string"), MESSAGE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "true"})
    read = raw.select(*keep, F.col(value_col).cast("string").alias("_value"), F.explode(F.array(j)).alias("m"))
    numbers = F.transform(F.array(*[F.col(f"m.{f}") for f in _NUMBERS]), _number)
    p = read.select(*keep, "_value", "m", F.explode(F.array(numbers)).alias("v"))
    v = {f: F.get(F.col("v"), F.lit(i)) for i, f in enumerate(_NUMBERS)}
    bad = F.col("m").isNull() | F.col("m._corrupt").isNotNull()
    return p.select(
        *keep,
        F.when(bad, F.col("_value")).alias("_corrupt"),
        parse_time(strip_json_quotes(F.col("m.pickup_datetime"))).alias("pickup_datetime"),
        strip_json_quotes(F.col("m.source")).alias("source"),
        v["pulocationid"].try_cast("int").alias("pulocationid"),
        v["dolocationid"].try_cast("int").alias("dolocationid"),
        first_within(v["trip_distance"], v["trip_miles"], default=0.0, min_value=0.0).alias("trip_distance"),
        first_within(v["tip_amount"], v["tips"], default=0.0, min_value=0.0).alias("tip_amount"),
        first_within(v["total_amount"], v["driver_pay"], default=0.0).alias("total_amount"),
        first_within(v["passenger_count"], default=0.0).alias("passenger_count"),
    )


def encode_message(fields: dict) -> Column:
    """A JSON object of named columns: numbers as numbers, times in ISO form, nulls written out."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in fields.items()]),
                     {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})


def good_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt").isNull()).drop("_corrupt")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt").isNotNull()).select(
        *[c for c in ("key", "topic", "partition", "offset") if c in parsed.columns], "_corrupt")
