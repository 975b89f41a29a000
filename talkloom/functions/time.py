"""Times as seconds and as text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parts(x: Column) -> Column:
    return F.split(F.trim(x), ":")


def clock(x: Column) -> Column:
    """"MM:SS", "HH:MM:SS" or a number as seconds; what is neither is 0."""
    text = F.coalesce(x.cast("string"), F.lit(""))
    p = _parts(text)
    at = lambda i: F.get(p, F.lit(i)).try_cast("int")
    two, three = at(0) * 60 + at(1), at(0) * 3600 + at(1) * 60 + at(2)
    out = F.when(F.size(p) == 2, two).when(F.size(p) == 3, three).when(F.size(p) == 1, text.try_cast("double"))
    return F.coalesce(out.cast("double"), F.lit(0.0))


def stamp(x: Column) -> Column:
    """"HH:MM:SS.mmm", with a point or a comma, as seconds."""
    p = _parts(F.replace(x, F.lit(","), F.lit(".")))
    at = lambda i, kind: F.get(p, F.lit(i)).try_cast(kind)
    return at(0, "int") * 3600 + at(1, "int") * 60 + at(2, "double")


def _whole(seconds: Column) -> Column:
    return F.floor(seconds).cast("long")


def minutes(seconds: Column) -> Column:
    """Seconds as m:ss."""
    s = _whole(seconds)
    return F.concat(F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))


def minutes_m(seconds: Column) -> Column:
    """Seconds as XmYYs."""
    s = _whole(seconds)
    return F.concat(F.floor(s / 60).cast("string"), F.lit("m"), F.lpad((s % 60).cast("string"), 2, "0"), F.lit("s"))


def percent(x: Column) -> Column:
    """A share as whole percent, ties to even."""
    return F.concat(F.bround(x * 100, 0).cast("long").cast("string"), F.lit("%"))


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 on the clock that the timestamp shows, whatever the session's time zone."""
    days = F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _rounded(xs: pd.Series, digits: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [None if v is None or v != v else round(float(v), int(n)) for v in x] for x, n in zip(xs, digits)], dtype=object)


def rounded_each(xs: Column, digits: int) -> Column:
    """Each number of an array to so many digits, ties by the binary value and then to even. Spark rounds the decimal
    notation instead, which puts 2.675 at 2.68."""
    return _rounded(xs, F.lit(digits))


def rounded(x: Column, digits: int) -> Column:
    return F.get(rounded_each(F.array(x.cast("double")), digits), F.lit(0))
