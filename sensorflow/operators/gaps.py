"""Missing ranges of whole numbers (A13, E4): what lies between, before and
after the values that are there.

Values are cut into blocks of ``width`` numbers.  Gaps within a block come from
its own values, gaps between blocks from the first and last value of each; a gap
over many blocks is one gap.  A group however large is spread over its blocks,
and only one row a block meets in the window of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 100_000


def missing_ranges(df: DataFrame, group: list[str], column: str, bounds: DataFrame | None = None,
                   width: int = WIDTH) -> DataFrame:
    """``group, first_missing, last_missing`` of every gap.

    ``bounds`` (``group, low, high``, both inclusive, unique on the group) adds
    what is missing at the ends, and groups that have no value at all; values
    outside are left out.  Without it only gaps between values count.  NULL
    values are ignored, repeated ones count once; NULL group values are a
    group like any other."""
    values = df.select(*group, F.col(column).cast("bigint").alias("__v")).filter("__v IS NOT NULL")
    if bounds is not None:
        limits = bounds.select(*[F.col(g).alias(f"__b_{g}") for g in group], F.col("low").cast("bigint").alias("__low"),
                               F.col("high").cast("bigint").alias("__high"))
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__b_{g}")) for g in group])
        values = values.join(limits, same & F.col("__v").between(F.col("__low"), F.col("__high")), "left_semi")
    values = values.distinct().withColumn("__block", F.floor(F.col("__v") / width))
    before = F.lag("__v").over(Window.partitionBy(*group, "__block").orderBy("__v"))
    inside = values.withColumn("__from", before + 1).select(*group, "__from", (F.col("__v") - 1).alias("__to"))

    ends = values.groupBy(*group, "__block").agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    before = F.lag("__hi").over(Window.partitionBy(*group).orderBy("__block"))
    between = ends.withColumn("__from", before + 1).select(*group, "__from", (F.col("__lo") - 1).alias("__to"))
    gaps = inside.unionByName(between)

    if bounds is not None:
        whole = ends.groupBy(*group).agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
        edges = limits.join(whole, same, "left").select(
            *[F.col(f"__b_{g}").alias(g) for g in group], F.explode(F.array(
                F.struct(F.col("__low").alias("f"), F.coalesce(F.col("__lo") - 1, F.col("__high")).alias("t")),
                F.struct((F.col("__hi") + 1).alias("f"), F.col("__high").alias("t")))).alias("e"))
        gaps = gaps.unionByName(edges.select(*group, F.col("e.f").alias("__from"), F.col("e.t").alias("__to")))
    return gaps.filter("__from <= __to").select(*group, F.col("__from").alias("first_missing"), F.col("__to").alias("last_missing"))
