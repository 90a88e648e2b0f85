"""Property test: the stream coercion rule against a plain statement of it.

Rule: a candidate counts when it parses as a number, is finite and passes the
bounds; the first such candidate wins; otherwise the default (0.0).
Zone ids: finite numbers truncated toward zero, else null.
"""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbflow.functions.numeric import pick_float, to_int

GARBAGE = ["", "abc", "1,5", "--1", "1.2.3", "NaN", "Infinity", "-Infinity", "nan", "inf", " ", "null"]


def text_values():
    numbers = st.one_of(
        st.floats(allow_nan=True, allow_infinity=True, width=64).map(repr),
        st.integers(min_value=-10**6, max_value=10**6).map(str),
        st.decimals(min_value=-1000, max_value=1000, places=2, allow_nan=False).map(str))
    padded = st.tuples(st.sampled_from(["", " ", "  "]), numbers, st.sampled_from(["", " "])).map("".join)
    return st.one_of(padded, st.sampled_from(GARBAGE), st.none())


def py_float(x):
    if x is None:
        return None
    try:
        v = float(x)
    except ValueError:
        return None
    return v if math.isfinite(v) else None


def py_pick(cands, default=0.0, lo=None, hi=None):
    for c in cands:
        v = py_float(c)
        if v is None or (lo is not None and v < lo) or (hi is not None and v > hi):
            continue
        return v
    return default


def py_int(x):
    v = py_float(x)
    return None if v is None or abs(v) >= 2**31 else int(v)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(text_values(), text_values()), min_size=1, max_size=60))
def test_pick_float_and_to_int(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select("a", "b", pick_float("a", "b", default=0.0, min_value=0.0).alias("p"),
                    pick_float("a", default=0.0).alias("q"), to_int(F.col("a")).alias("i")).collect()
    for r in out:
        assert r["p"] == py_pick([r["a"], r["b"]], lo=0.0), (r["a"], r["b"])
        assert r["q"] == py_pick([r["a"]]), r["a"]
        assert r["i"] == py_int(r["a"]), r["a"]
