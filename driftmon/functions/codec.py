"""Record codec: JSON to columns and back, key checks, store coercions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, StructType, TimestampType

from driftmon.schemas import FEATURES, KEY, RECORD

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UUID_TEXT = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def iso_text(ts) -> Column:
    return F.date_format(ts, ISO_MICROS)


def round_number(value, places: int = 3) -> Column:
    """Text or number to double at a fixed number of decimals; dirty text gives null."""
    return F.round(number(value), places)


def uuid_from(*cols) -> Column:
    """UUID-shaped id that a replay of the same record reproduces."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in cuts])


def random_id() -> Column:
    return F.expr("uuid()")


def encode(df: DataFrame) -> DataFrame:
    """One JSON text per record, times as ISO text with microseconds."""
    fields = [
        iso_text(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema
    ]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def decode(df: DataFrame, value: str = "value", schema: StructType = RECORD, keep=()) -> DataFrame:
    """Parse text or binary JSON with a fixed schema; what does not parse becomes null.

    `keep` names input columns carried along next to the decoded ones. The struct is
    unpacked by a generator, not a projection: a filter on its fields then stays
    above it, where it would otherwise be pushed down with a parse of its own.
    """
    data = F.from_json(F.col(value).cast("string"), schema)
    return df.select(*keep, F.inline(F.array(data)))


def has_key(key=KEY) -> Column:
    """True for rows a keyed table can take."""
    cond = F.lit(True)
    for c in key:
        cond = cond & F.col(c).isNotNull()
    return cond


def split_rejects(
    decoded: DataFrame, key=KEY, uuid_ids: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed table takes, and the rest. With `uuid_ids` the first key column must be
    a UUID, as a store that types its ids so would demand."""
    good = has_key(key)
    if uuid_ids:
        good = good & F.coalesce(is_uuid(key[0]), F.lit(False))
    return decoded.where(good), decoded.where(~good)


def is_uuid(col) -> Column:
    return F.col(col).rlike(UUID_TEXT)


def at_store_precision(ts) -> Column:
    """The store keeps milliseconds."""
    return F.date_trunc("MILLISECOND", ts)


def to_store(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of `schema` in its order, narrowed to the store types."""
    cols = []
    for f in schema:
        col = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            col = at_store_precision(col.cast("timestamp"))
        elif isinstance(f.dataType, (FloatType, DoubleType, BooleanType)):
            col = col.cast(f.dataType)
        cols.append(col.alias(f.name))
    return df.select(*cols)


def number(value) -> Column:
    """Text or number to double; dirty text gives null."""
    col = F.col(value) if isinstance(value, str) else value
    return col.try_cast("double")


def features_from_text(parts: Column) -> list[Column]:
    """Three features and the label from an array of text fields."""
    names = [*FEATURES, "label"]
    return [number(F.trim(F.get(parts, F.lit(i)))).alias(n) for i, n in enumerate(names)]
