"""Scalar helpers: every one returns a native Column, so plans stay in codegen."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_ts(value) -> Column:
    """A ``timestamp_ntz`` literal (or column pass-through) for an as-of time."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def whole_days(start: Column, end: Column) -> Column:
    """Whole elapsed days from ``start`` to ``end`` (not calendar midnights)."""
    return F.timestamp_diff("DAY", start, end)


def week_start(ts: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(F.to_date(ts), "week")


def month_start(ts: Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(F.to_date(ts), "month")


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` with zero or null denominator -> ``default`` (ANSI-safe)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def nz(col: Column, default=0) -> Column:
    return F.coalesce(col, F.lit(default))


def attach(df: DataFrame, record: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (a global aggregate) to every row.

    The record travels as ONE scalar subquery holding a struct: Spark runs
    it once and inlines the value, so no join (and no cross product) is
    planned. A record with no rows gives nulls; more than one row is an
    error, so the size bound is enforced, not assumed.
    """
    rec = record.select(F.struct(*record.columns).alias("_rec")).scalar()
    keep = [c for c in df.columns if c not in record.columns]
    return df.withColumn("_rec", rec).select(*keep, *[F.col("_rec")[c].alias(c) for c in record.columns])


def round_half_even(col: Column | str, digits: int) -> Column:
    """Round like pandas/numpy: scale, round half to even, unscale.

    This is what ``Series.round(d)`` does (``rint(x * 10**d) / 10**d``); it
    differs from ``F.round`` (HALF_UP on the decimal text) on ties such as
    44.225 -> 44.22.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def round_exact(col: Column | str, digits: int) -> Column:
    """Round a double on its exact binary value, half to even: what Python's ``round`` and ``%.df`` do.

    ``c * 10**d`` rounds, so it can land on a tie that ``c`` only comes near.
    Cut into two short halves the product has no error, and its distance to
    the nearest whole number tells on which side of the tie ``c`` lies
    (magnitudes up to about 1e8; digits up to 6).
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    scale = float(10 ** digits)
    near = F.rint(c * scale)
    spread = c * 134217729.0  # 2**27 + 1
    high = spread - (spread - c)
    rest, low = high * scale - near, (c - high) * scale
    step = F.when((rest - 0.5) + low > 0, 1.0).when((rest + 0.5) + low < 0, -1.0).otherwise(0.0)
    return (near + step) / scale


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; used for reports compared across engines."""
    return df.select([
        round_half_even(df[f.name], digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else df[f.name] for f in df.schema.fields
    ])


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str],
               nulls_last: bool = True) -> DataFrame:
    """Keep one row per ``key``: the first by ``order`` (then by the other columns).

    Implemented as ``groupBy(key).agg(min(struct(order..., payload...)))`` rather
    than a ``row_number`` window: the aggregate combines map-side, so a key
    holding a large share of the rows is reduced per partition before the
    shuffle instead of landing whole in one task. Ascending order; with
    ``nulls_last`` a null order value sorts after every non-null one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    payload = [c for c in df.columns if c not in keys]
    fields = []
    for i, c in enumerate(order_cols):
        if nulls_last:
            fields.append(c.isNull().alias(f"_n{i}"))
        fields.append(c.alias(f"_o{i}"))
    # remaining columns break ties so the pick never depends on arrival order
    for i, c in enumerate(payload):
        fields.append(F.col(c).isNull().alias(f"_pn{i}"))
        fields.append(F.col(c).alias(f"_p{i}"))
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first._p{i}").alias(c) for i, c in enumerate(payload)]) \
        .select(df.columns)
