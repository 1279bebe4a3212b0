"""Running sums over an order without a task that holds all rows.

Rows are written range-partitioned by the order. What the ranges sum up to (the driver sees one row a
range) tells which of them lie before a bound, and only in the range that a bound cuts are rows summed one
by one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

RANGE = "_range"


def ranged(rows: DataFrame, order: Sequence[str], measures: Sequence[str], path: str) -> tuple[DataFrame, list[Row]]:
    """``rows`` written to ``path`` with the number of their range, and the sums of each range in order."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    sums = [F.sum(m).alias(m) for m in measures]
    return stored, stored.groupBy(RANGE).agg(*sums).orderBy(RANGE).collect()


def running(measure: str, order: Sequence[str]) -> Column:
    """The sum of ``measure`` from the first row of a range up to each."""
    window = Window.partitionBy(RANGE).orderBy(*order)
    return F.sum(measure).over(window.rowsBetween(Window.unboundedPreceding, 0))


def up_to(rows: DataFrame, order: Sequence[str], bounds: Mapping[str, int], path: str) -> DataFrame:
    """The first rows of the order whose sums stay within every bound, at least one row.

    ``bounds`` names columns that are not negative. ``order`` tells all rows apart. What is returned reads
    ``path``.
    """
    stored, sums = ranged(rows, order, list(bounds), path)
    before, cut = dict.fromkeys(bounds, 0), None
    for own in sums:
        if any(before[m] + own[m] > bound for m, bound in bounds.items()):
            cut = own[RANGE]
            break
        before = {m: before[m] + own[m] for m in bounds}
    if cut is None:
        return stored.drop(RANGE)
    part = stored.where(F.col(RANGE) == cut)
    for m in bounds:
        part = part.withColumn(f"_sum_{m}", running(m, order) + before[m])
    within = F.lit(True)
    for m, bound in bounds.items():
        within = within & (F.col(f"_sum_{m}") <= bound)
    if cut == sums[0][RANGE]:
        first = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
        part = part.withColumn("_place", first)
        within = within | (F.col("_place") == 1)
    part = part.where(within).select(*stored.columns)
    return stored.where(F.col(RANGE) < cut).unionByName(part).drop(RANGE)


def reaches(rows: DataFrame, order: Sequence[str], measure: str, bound: int, path: str) -> Row | None:
    """The first row of the order up to which ``measure`` sums up to ``bound`` or more; None if all do not."""
    stored, sums = ranged(rows, order, [measure], path)
    before = 0
    for own in sums:
        if before + own[measure] >= bound:
            part = stored.where(F.col(RANGE) == own[RANGE]).withColumn("_sum", running(measure, order) + before)
            reached = part.where(F.col("_sum") >= bound).select(F.struct(*order).alias("place"))
            return reached.agg(F.min("place").alias("place")).first()["place"]
        before += own[measure]
    return None
