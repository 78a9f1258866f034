"""Chronological splits on top of exact rank selection."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.operators.selection import Cut, cut_at_ranks, extent
from driftmon.schemas import TRAIN_FRACTION


def split_rank(rows: int, fraction: float = TRAIN_FRACTION) -> int:
    """Size of the earlier part: a double product, cut down (62 of 90 at 0.7)."""
    return int(rows * fraction)


def train_cut(
    df: DataFrame, fraction: float = TRAIN_FRACTION, time: str = "timestamp", key: str = "id"
) -> Cut | None:
    """The last of the earliest `int(n * fraction)` rows, if there are any."""
    size = extent(df, time, key)
    rank = split_rank(size.rows, fraction)
    return cut_at_ranks(df, [rank], time, key, size)[0] if rank >= 1 else None


def train_part(
    df: DataFrame, fraction: float = TRAIN_FRACTION, time: str = "timestamp", key: str = "id"
) -> Column:
    """True for the earliest `int(n * fraction)` rows in (time, key) order."""
    cut = train_cut(df, fraction, time, key)
    return cut.covers(time, key) if cut else F.lit(False)


def chrono_split(
    df: DataFrame, fraction: float = TRAIN_FRACTION, time: str = "timestamp", key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Earlier and later part; rows without a full key are in neither."""
    cut = train_cut(df, fraction, time, key)
    whole = df.where(F.col(time).isNotNull() & F.col(key).isNotNull())
    if cut is None:
        return whole.where(F.lit(False)), whole
    return whole.where(cut.covers(time, key)), whole.where(cut.after(time, key))


def block_cuts(df: DataFrame, blocks: int, time: str = "timestamp", key: str = "id") -> list[Cut]:
    """Inner cuts of `blocks` equal parts; leading parts take the remainder rows."""
    size = extent(df, time, key)
    base, extra = divmod(size.rows, blocks)
    ends, at = [], 0
    for i in range(blocks - 1):
        at += base + (1 if i < extra else 0)
        ends.append(at)
    return cut_at_ranks(df, ends, time, key, size)


def block_number(cuts, time: str = "timestamp", key: str = "id") -> Column:
    """1-based number of the block a row falls in."""
    number = F.lit(len(cuts) + 1)
    for i in reversed(range(len(cuts))):
        number = F.when(cuts[i].covers(time, key), F.lit(i + 1)).otherwise(number)
    return number.cast("long")
