"""Last write wins per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, TimestampNTZType, TimestampType

FIXED_WIDTH = (NumericType, BooleanType, TimestampType, TimestampNTZType)


def latest_per_key(df: DataFrame, key, order, drop_order: bool = False) -> DataFrame:
    """Keep, per key, the row with the highest `order` columns.

    An aggregation, not a window: copies of a key collapse before the shuffle, so
    a key with very many versions does not land in one task. When the order is one
    column and all values are fixed-width, one `max_by` per value column keeps the
    buffers mutable in place and Spark hash-aggregates; all of them pick the same
    row, since they compare the same column. Otherwise whole rows are compared; they are kept
    and sent once, not beside a copy of themselves, when the order is all values.
    """
    order = [order] if isinstance(order, str) else list(order)
    values = [c for c in df.columns if c not in key and not (drop_order and c in order)]
    types = {f.name: f.dataType for f in df.schema}
    if len(order) == 1 and all(isinstance(types[c], FIXED_WIDTH) for c in [*order, *values]):
        picked = [F.max_by(c, order[0]).alias(c) for c in values]
        # Value columns alone do not say whether the key exists when there are none.
        out = df.groupBy(*key).agg(*picked) if picked else df.select(*key).distinct()
    else:
        row = F.struct(*values)
        picked = F.max(row) if order == values else F.max_by(row, F.struct(*order))
        out = df.groupBy(*key).agg(picked.alias("_row")).select(*key, "_row.*")
    return out.select(*[c for c in df.columns if c in out.columns])
