"""As-of join: the last row of another table before each row, by key and order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.workspace import materialise


def as_of(left: DataFrame, right: DataFrame, by: list[str], order: list[str], values: list[str], inclusive: bool = False) -> DataFrame:
    """``left`` with ``values`` of the last ``right`` row of the same key (``by``) before it in ``order``; NULL where none is.

    A segmented prefix scan: both tables are dealt to range partitions of the order, whatever the key, so a
    key with most of the rows is spread like any other. Inside a partition a window finds the last row
    before; the last row of each key and partition is carried on to the later partitions through a
    table of one row per key and partition. ``order`` compares as a whole and should end in a unique
    column; where both tables have the same place, ``inclusive`` decides whether it counts.
    """
    mine, theirs = (1, 0) if inclusive else (0, 1)
    kept = [c for c in left.columns if c not in values]
    held = F.struct(*values)
    rows = left.select(*by, *order, F.struct(*kept).alias("own"), F.lit(None).cast(right.select(held).schema[0].dataType).alias("held"), F.lit(mine).alias("turn"))
    rows = rows.unionByName(right.select(*by, *order, F.lit(None).cast(rows.schema["own"].dataType).alias("own"), held.alias("held"), F.lit(theirs).alias("turn")))
    parts = materialise(rows.repartitionByRange(*order, "turn").withColumn("part", F.spark_partition_id()), "as-of")
    before = Window.partitionBy("part", *by).orderBy(*order, "turn").rowsBetween(Window.unboundedPreceding, -1)
    ends = parts.groupBy("part", *by).agg(F.max_by("held", F.when(F.col("held").isNotNull(), F.struct(*order, "turn"))).alias("last"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", *by, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    found = parts.withColumn("inside", F.last("held", ignorenulls=True).over(before)).where("own IS NOT NULL").alias("x")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("part", *by)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return (found.join(carried.alias("y"), on, "left").withColumn("was", F.coalesce("inside", "carried"))
            .select("own.*", *[F.col("was")[v].alias(v) for v in values]))
