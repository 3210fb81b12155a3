"""Running values over one long order, without a window that holds it all.

The order is cut into ranges of WIDTH positions. Each range is worked on by itself; what a range hands on to later ones is
one row, and only those rows meet in a window. A key that holds most of the log is many ranges, so it never is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 65_536
#: Frames of a window: rows up to and with the own one, and rows before it.
UP_TO, EARLIER = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)


def _ranged(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_range", F.floor(F.col(order) / width))


def last_known(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = WIDTH, ties: tuple[str, ...] = (), own: bool = True) -> DataFrame:
    """df with `name`: the last value that isn't null at or before each row, by keys; the as-of join of a log to itself.

    ties: columns that order rows of one position. Without own, a row's own value isn't meant, only those before it.
    """
    df = _ranged(df.withColumn("_value", value), order, width)
    within = Window.partitionBy(*keys, "_range").orderBy(order, *ties).rowsBetween(*(UP_TO if own else EARLIER))
    handed = df.groupBy(*keys, "_range").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(order, *ties))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*EARLIER)
    ranges = handed.withColumn("_start", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    out = df.withColumn("_own", F.last("_value", ignorenulls=True).over(within)).join(ranges, [*keys, "_range"], "left")
    return out.withColumn(name, F.coalesce("_own", "_start")).drop("_value", "_own", "_start", "_range")


def running_sum(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with `name`: the sum of value up to and with each row, by keys."""
    df = _ranged(df.withColumn("_value", value), order, width)
    within = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(*UP_TO)
    sums = df.groupBy(*keys, "_range").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*EARLIER)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    out = df.withColumn("_own", F.sum("_value").over(within)).join(sums, [*keys, "_range"])
    return out.withColumn(name, F.col("_own") + F.col("_start")).drop("_value", "_own", "_start", "_range")


def running_max(df: DataFrame, keys: list[str], order: str, value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with `name`: the largest value before each row, by keys; null at the first."""
    df = _ranged(df.withColumn("_value", value), order, width)
    earlier = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(*EARLIER)
    tops = df.groupBy(*keys, "_range").agg(F.max("_value").alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*EARLIER)
    tops = tops.withColumn("_start", F.max("_top").over(before)).drop("_top")
    out = df.withColumn("_own", F.max("_value").over(earlier)).join(tops, [*keys, "_range"])
    return out.withColumn(name, F.greatest("_own", "_start")).drop("_value", "_own", "_start", "_range")
