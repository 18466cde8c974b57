"""Row numbers over a whole table without one big sort task.

The rows are range-partitioned by the order and sorted within the partitions;
a row's number is the rows of the partitions before plus its place in its own.
Only one count per partition reaches the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import materialize


def number_rows(df: DataFrame, order: list[str], name: str = "_number") -> tuple[DataFrame, int]:
    """`df` with `name` (long, 0, 1, 2.. in ascending `order`, NULLs first), written
    once, and the number of rows.

    Rows equal in `order` are numbered as the table holds them, and are cut
    between partitions like others. `df` should be a written table.
    """
    if not order:
        raise ValueError("number_rows needs at least one column")
    keys = [*(F.col(c).asc_nulls_first() for c in order), F.col("_tie")]
    placed, rows = materialize(
        df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    # The id holds the partition in its upper bits and the place within it in the lower 33.
    part = F.shiftright("_at", 33)
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
                   .toLocalIterator())  # one row per partition
    before = list(accumulate((n for _, n in sizes), initial=0))
    base = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "_part long, _before long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(base), "_part")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(name, F.col("_before") + place).drop("_part", "_before", "_at"), rows
