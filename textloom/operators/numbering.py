"""Row numbers over groups of any size, without a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, within: tuple[str, ...], order: tuple[str, ...], bucket: Column, name: str = "n") -> DataFrame:
    """``rows`` with their place from 1 in their group, in ``order``.

    ``bucket`` must not fall in that order; its values cut a group into parts of a bounded size. Parts are counted (before the
    shuffle), counts are summed up over the parts, and rows are numbered within each.
    """
    rows = rows.withColumn("__part", bucket)
    counts = rows.groupBy(*within, "__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"__of_{c}") for c in within], F.col("__part").alias("__at"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    same = F.col("__part").eqNullSafe(F.col("__at"))
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    place = F.row_number().over(Window.partitionBy(*within, "__part").orderBy(*order))
    return rows.join(counts, same).withColumn(name, F.col("__before") + place).drop("__part", "__at", "__before", *[f"__of_{c}" for c in within])


def in_blocks(rows: DataFrame, size: int, reach: int, name: str = "n", after: bool = False) -> DataFrame:
    """Numbered ``rows`` in blocks of ``size``, each with the ``reach`` rows before it (or after it) as well; ``__own`` tells which are the
    block's."""
    block, place = F.floor((F.col(name) - 1) / size), F.pmod(F.col(name) - 1, F.lit(size))
    shared = ((block > 0) & (place < reach)) if after else place >= size - reach
    own = F.struct(block.alias("__block"), F.lit(True).alias("__own"))
    other = F.struct((block - 1 if after else block + 1).alias("__block"), F.lit(False).alias("__own"))
    return rows.select("*", F.inline(F.when(shared, F.array(own, other)).otherwise(F.array(own))))
