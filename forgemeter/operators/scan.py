"""Running sums and maxima over an order, also of one long group, without one task for all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FOLDS = {"sum": F.sum, "max": F.max}


def with_earlier(
    rows: DataFrame,
    order: Sequence[Column],
    measure: str,
    how: str,
    staging: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Each row with ``earlier``: the sum or maximum (``how``) of a measure over the rows before it in its
    group, null for the first. The order must be total within a group, and names begin with no ``_``.

    Two passes: the rows are split into ranges of (group, order) and stored in ``staging``, a fresh folder;
    each range is folded to one row a group, and those before a range, carried over, are joined to the
    running fold within it. A group of any length is spread over ranges. What one task holds of it at a time is
    a range, or one row for each of its ranges.
    """
    fold, spark = _FOLDS[how], rows.sparkSession
    ranges = rows.repartitionByRange(*[F.col(c) for c in by], *order)
    ranges.withColumn("_range", F.spark_partition_id()).write.parquet(staging)
    stored = spark.read.parquet(staging)

    def before(*group: str) -> Window:
        return Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, -1)

    folded = stored.groupBy("_range", *by).agg(fold(measure).alias("_folded"))
    carried = folded.select(
        F.col("_range").alias("_of"),
        *[F.col(c).alias(f"_{c}") for c in by],
        fold("_folded").over(before(*by).orderBy("_range")).alias("_carried"),
    )
    inside = stored.withColumn("_inside", fold(measure).over(before("_range", *by).orderBy(*order)))
    meets = F.col("_range") == F.col("_of")
    for c in by:
        meets = meets & F.col(c).eqNullSafe(F.col(f"_{c}"))
    none = F.lit(0).cast("long")
    both = {
        "sum": F.when(
            F.coalesce("_carried", "_inside").isNotNull(),
            F.coalesce("_carried", none) + F.coalesce("_inside", none),
        ),
        "max": F.greatest("_carried", "_inside"),
    }[how]
    return inside.join(carried, meets).select(*rows.columns, both.alias("earlier"))
