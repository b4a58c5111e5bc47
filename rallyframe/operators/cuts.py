"""Several groupings of one small aggregate in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_cuts(cells: DataFrame, cuts: dict[str, list[str]], sums: list[Column]) -> DataFrame:
    """Grouping sets over already aggregated cells, labelled with the name of their cut.

    The cells are computed once; only they are expanded, never the rows behind them.
    """
    dims = list(dict.fromkeys(d for columns in cuts.values() for d in columns))
    out = cells.groupingSets([[F.col(d) for d in columns] for columns in cuts.values()], *[F.col(d) for d in dims]).agg(
        *sums, F.grouping_id().alias("_set"))
    cut = F.lit(None).cast("string")
    for name, columns in cuts.items():
        mask = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in columns)
        cut = F.when(F.col("_set") == mask, name).otherwise(cut)
    return out.withColumn("cut", cut).drop("_set")
