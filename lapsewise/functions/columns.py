"""Small Column and join helpers shared by every operator."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts(value: datetime | str) -> Column:
    """A timestamp_ntz literal, independent of the session time zone."""
    text = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def days(n: int | Column) -> Column:
    return F.make_dt_interval(days=n if isinstance(n, Column) else F.lit(n))


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def by_key(df: DataFrame) -> DataFrame:
    """The side of a join that has a row per member or membership: it stays on the
    executors, also where its files are small enough to be sent through the driver."""
    return df.hint("merge")


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def flag(cond: Column) -> Column:
    """Boolean flag that is never NULL (NULL comparison -> false)."""
    return F.coalesce(cond, F.lit(False))


def count_where(cond: Column) -> Column:
    return F.count_if(flag(cond))


def latest(value: Column | str, *order: Column | str) -> Column:
    """Value of the row with the greatest ``order`` tuple (deterministic top-1).

    ``max_by`` combines map-side, so only one row per key and map task crosses
    the shuffle (unlike ``row_number`` over a window).
    """
    value = F.col(value) if isinstance(value, str) else value
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    key = order_cols[0] if len(order_cols) == 1 else F.struct(*order_cols)
    return F.max_by(value, key)
