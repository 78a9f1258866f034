"""The settled part of a keyed table: one row per key, dealt into buckets by the key.

A manifest beside the table names the newest base, the batch up to which it holds the table
(`folded`), the batch at or below which rows have left it (`low`) and the batch up to which
batch folders are gone (`reclaimed`). Each change is a new manifest file, created only if no
other writer has made that version; readers take the newest one that is complete, and a base
is never written again, so a reader's base stays as it was.
"""

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftmon import storage

BUCKET_BYTES = 32 << 20  # stored bytes for each bucket; a task sorts and merges one, many times as large in memory


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest complete manifest of a table; None if it was never compacted."""
    folder = f"{path}.manifest"
    for name in sorted(storage.names(spark, folder), reverse=True):
        try:
            return json.loads(storage.read_line(spark, f"{folder}/{name}"))
        except ValueError:  # not written to its end
            continue
    return None


def publish(spark: SparkSession, path: str, entry: dict) -> dict:
    """Make `entry` the table's manifest; refuses a version that another writer has taken."""
    storage.create_line(spark, f"{path}.manifest/{entry['version']:012d}", json.dumps(entry))
    return entry


def _name(path: str, version: int) -> str:
    return f"settled_{hashlib.md5(path.encode()).hexdigest()}_{version}"


def settled_name(spark: SparkSession, path: str, entry: dict) -> str:
    """The base's name in the catalog, in full."""
    return f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}.{_name(path, entry['base_version'])}"


def base(spark: SparkSession, path: str, entry: dict, schema: StructType, key) -> DataFrame:
    """The rows of a base. Its buckets are known to the planner, so a join on the key reads them
    in place. The catalog entry that carries them is made again in each new session."""
    name = _name(path, entry["base_version"])
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{c}`" for c in key)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
            f"SORTED BY ({keys}) INTO {entry['buckets']} BUCKETS LOCATION '{entry['base']}'"
        )
    return spark.table(name)


def write_base(rows: DataFrame, path: str, version: int, key, buckets: int) -> str:
    """Write a base of one file per bucket; returns its folder. Null keys are refused: they would
    not meet their newer versions."""
    spark, folder = rows.sparkSession, f"{path}.base/{version:012d}"
    storage.delete(spark, folder)  # what a failed compaction left there, which no manifest names
    spark.sql(f"DROP TABLE IF EXISTS {_name(path, version)}")
    dealt = rows.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key)
    dealt.option("path", folder).saveAsTable(_name(path, version))
    unknown = F.lit(False)
    for c in key:
        unknown = unknown | F.col(c).isNull()
    if not spark.table(_name(path, version)).where(unknown).isEmpty():
        raise ValueError(f"{path} has rows without a key")
    return folder


def buckets_for(spark: SparkSession, stored: int) -> int:
    """Buckets for so many stored bytes, as far as Spark allows them."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(max(1, -(-stored // BUCKET_BYTES)), most)


def drop_older(spark: SparkSession, path: str, version: int) -> None:
    """Remove the bases before a version, with their catalog entries."""
    for name in storage.names(spark, f"{path}.base"):
        if int(name) < version:
            spark.sql(f"DROP TABLE IF EXISTS {_name(path, int(name))}")
            storage.delete(spark, f"{path}.base/{name}")
