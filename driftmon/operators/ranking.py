"""Row numbers over a whole table or a hot group, without one task holding it."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftmon.session import written

CHUNK_BITS = 20  # rows numbered together: about a million


def row_numbers(df: DataFrame, order, by=(), name: str = "row_num") -> DataFrame:
    """`row_number()` in `order`, restarting per `by` group.

    The rows are range-sorted on (by, order), which gives even partitions whatever
    the groups look like, and written once with their place, so that the numbers
    cannot move. They are numbered inside chunks of neighbours. A group that goes on
    from earlier chunks gets an offset; only the first group of a chunk can need one,
    so there is at most one offset per chunk.
    """
    by = list(by)
    placed = written(
        df.orderBy(*by, *order).withColumn("_at", F.monotonically_increasing_id()), "ranked"
    ).withColumns(
        {
            "_chunk": F.shiftright("_at", CHUNK_BITS),
            "_pos": F.col("_at").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)),
        }
    )
    pieces = placed.groupBy("_chunk", *by).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_start")
    )
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        pieces.withColumn("_carried", F.sum("_rows").over(earlier))
        .where("_start = 0 and _carried > 0")
        .select("_chunk", "_rows", "_carried")
    )
    if by:
        piece = Window.partitionBy("_chunk", *by).orderBy("_at")
        local = F.row_number().over(piece).cast("long")
    else:
        local = F.col("_pos") + 1
    carried = F.when(F.col("_pos") < F.col("_rows"), F.col("_carried"))
    return (
        placed.withColumn("_local", local)
        .join(heads, "_chunk", "left")
        .withColumn(name, F.col("_local") + F.coalesce(carried, F.lit(0)))
        .drop("_at", "_chunk", "_pos", "_rows", "_carried", "_local")
    )
