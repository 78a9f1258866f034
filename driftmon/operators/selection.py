"""Exact rank selection over (time, key) order without sorting the table."""

from dataclasses import dataclass
from functools import reduce
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096  # histogram rows the driver sees per open range and pass
EDGE_ROWS = 20_000  # a range this small is sorted directly
KEY_BYTES = 2  # per pass; at most 65 536 counts per range
NOT_UNIQUE = "the key is not unique; keep the latest row per key first"


@dataclass(frozen=True)
class Cut:
    """The row at a rank. Rows up to and including it come before the cut."""

    micros: int
    key: str

    def covers(self, time: str = "timestamp", key: str = "id") -> Column:
        at = F.timestamp_micros(F.lit(self.micros))
        t = F.col(time)
        # The first conjunct is implied; it is there because it reaches the scan
        # even where the key is a computed column.
        return (t <= at) & ((t < at) | ((t == at) & (F.col(key) <= F.lit(self.key))))

    def after(self, time: str = "timestamp", key: str = "id") -> Column:
        """The other rows; said so that it reaches the scan as well."""
        at = F.timestamp_micros(F.lit(self.micros))
        t = F.col(time)
        return (t >= at) & ((t > at) | ((t == at) & (F.col(key) > F.lit(self.key))))


@dataclass
class _Search:
    """One rank being narrowed down: `rank` counts from the start of the range."""

    rank: int
    lo: int
    hi: int
    rows: int
    prefix: bytes = b""
    may_share: bool = True
    single_key: bool = False

    @property
    def where(self):
        return (self.lo, self.hi, self.prefix)


@dataclass(frozen=True)
class Extent:
    rows: int
    lo: int | None
    hi: int | None


def extent(df: DataFrame, time: str = "timestamp", key: str = "id") -> Extent:
    """Row count and time range of the rows with a full key: one pass, one row."""
    row = (
        df.where(F.col(time).isNotNull() & F.col(key).isNotNull())
        .agg(F.count(F.lit(1)), F.unix_micros(F.min(time)), F.unix_micros(F.max(time)))
        .first()
    )
    return Extent(*row)


def cut_at_ranks(
    df: DataFrame, ranks, time: str = "timestamp", key: str = "id", size: Extent | None = None
) -> list[Cut]:
    """Cuts at 1-based ranks in (time, key) order; keys must be unique text.

    Each pass counts rows in at most `BINS` equal time bins per open range and
    keeps the bin that holds the rank, so a pass shuffles bin counts, not rows,
    and later passes filter on the time column. A range that is one instant with
    very many rows is narrowed on leading bytes of the key in the same way.
    Only a range of at most `EDGE_ROWS` rows is ever sorted.
    """
    size = size or extent(df, time, key)
    for r in ranks:
        if not 1 <= r <= size.rows:
            raise ValueError(f"rank {r} outside 1..{size.rows}")
    keyed = df.select(F.col(time).alias("_t"), F.col(key).alias("_k")).where("_k is not null")
    searches = [_Search(r, size.lo, size.hi, size.rows) for r in ranks]
    while True:
        large = [s for s in searches if s.rows > EDGE_ROWS]
        in_time = [s for s in large if s.lo < s.hi]
        in_key = [s for s in large if s.lo == s.hi and not s.single_key]
        if in_time:
            _narrow_time(keyed, in_time)
        elif in_key:
            _narrow_key(keyed, in_key)
        else:
            break
    return _edge_rows(keyed, searches)


def _inside(s: _Search) -> Column:
    lo, hi = (F.timestamp_micros(F.lit(x)) for x in (s.lo, s.hi))
    cond = F.col("_t").between(lo, hi)
    return cond & F.startswith(_key_bytes(), F.lit(s.prefix)) if s.prefix else cond


def _key_bytes() -> Column:
    """Text sorts by its bytes."""
    return F.col("_k").cast("binary")


def _ranges(searches):
    """The distinct open ranges; they are equal or disjoint."""
    return list({s.where: s for s in searches}.values())


def _in_any(ranges) -> Column:
    return reduce(lambda a, b: a | b, map(_inside, ranges))


def _by_range(ranges, value=None) -> Column:
    """For rows known to be in one of the ranges: its number, or `value(range)`."""
    values = [value(r) if value else F.lit(i) for i, r in enumerate(ranges)]
    out = values[-1]
    for r, v in zip(ranges[:-1], values[:-1]):
        out = F.when(_inside(r), v).otherwise(out)
    return out


def _narrow_time(keyed: DataFrame, searches) -> None:
    """Keep the equal-width time bin that holds the rank."""

    def bin_number(r):
        step = (r.hi - r.lo) // BINS + 1
        return F.call_function("div", F.unix_micros("_t") - F.lit(r.lo), F.lit(step))

    bounds = [F.unix_micros(F.min("_t")).alias("first"), F.unix_micros(F.max("_t")).alias("last")]
    for s, parts in _count_parts(keyed, searches, bin_number, bounds):
        found = _take(s, parts)
        s.lo, s.hi = found["first"], found["last"]


def _narrow_key(keyed: DataFrame, searches) -> None:
    """Keep the next key bytes that hold the rank."""
    _skip_shared_prefix(keyed, [s for s in searches if s.may_share])
    searches = [s for s in searches if not s.single_key]

    def next_bytes(r):
        return F.substring(_key_bytes(), len(r.prefix) + 1, KEY_BYTES)

    for s, parts in _count_parts(keyed, searches, next_bytes):
        found = bytes(_take(s, parts).part)
        s.prefix += found
        s.single_key = len(found) < KEY_BYTES  # the key ends here
        s.may_share = len(parts) == 1


def _skip_shared_prefix(keyed: DataFrame, searches) -> None:
    """Extend the prefix by what all keys of the range have in common."""
    if not searches:
        return
    ranges = _ranges(searches)
    ends = [
        end(F.when(_inside(r), F.col("_k"))).alias(f"{name}_{i}")
        for i, r in enumerate(ranges)
        for name, end in (("first", F.min), ("last", F.max))
    ]
    row = keyed.where(_in_any(ranges)).agg(*ends).first()
    shared = {r.where: (row[f"first_{i}"], row[f"last_{i}"]) for i, r in enumerate(ranges)}
    for s in searches:
        first, last = shared[s.where]
        s.prefix = commonprefix([first.encode(), last.encode()])
        s.single_key = first == last
        s.may_share = False


def _count_parts(keyed: DataFrame, searches, part, bounds=()):
    """One pass over the open ranges: each search with the parts of its range in order."""
    if not searches:
        return []
    ranges = _ranges(searches)
    counted = (
        keyed.where(_in_any(ranges))
        .groupBy(_by_range(ranges).alias("range"), _by_range(ranges, part).alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), *bounds)
        .collect()
    )
    parts = {r.where: [] for r in ranges}
    for c in sorted(counted, key=lambda c: c.part):  # numbers, or bytes
        parts[ranges[c["range"]].where].append(c)
    return [(s, parts[s.where]) for s in searches]


def _take(s: _Search, parts):
    """The part holding the rank; the rank becomes relative to that part."""
    for p in parts:
        if s.rank <= p.rows:
            s.rows = p.rows
            return p
        s.rank -= p.rows
    raise RuntimeError("the table changed between passes; read it as of a batch")


def _edge_rows(keyed: DataFrame, searches) -> list[Cut]:
    """Number the rows of the small ranges; read the row at each rank and the next one."""
    if any(s.single_key and s.rows > 1 for s in searches):
        raise ValueError(NOT_UNIQUE)
    ranges = _ranges(searches)
    wanted = F.lit(False)
    for i, r in enumerate(ranges):
        ranks = [s.rank + n for s in searches if s.where == r.where for n in (0, 1)]
        wanted = wanted | ((F.col("range") == i) & F.col("rank").isin(ranks))
    order = Window.partitionBy("range").orderBy("_t", "_k")
    rows = (
        keyed.where(_in_any(ranges))
        .select(_by_range(ranges).alias("range"), "_t", "_k")
        .select("range", "_k", "_t", F.row_number().over(order).alias("rank"))
        .where(wanted)
        .select("range", "rank", F.unix_micros("_t").alias("micros"), "_k")
        .collect()
    )
    found = {(r["range"], r["rank"]): Cut(r["micros"], r["_k"]) for r in rows}
    home = {r.where: i for i, r in enumerate(ranges)}
    cuts = []
    for s in searches:
        here = (home[s.where], s.rank)
        if found[here] == found.get((here[0], s.rank + 1)):
            raise ValueError(NOT_UNIQUE)
        cuts.append(found[here])
    return cuts
