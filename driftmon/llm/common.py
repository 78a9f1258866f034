"""What the operators share: batch sizes, free names, and rows told apart by id and text."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmon.session import pin

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20  # a batch ends at either; one longer text makes a batch of its own


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, as `--py-files` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the code, and bound what a Python task holds; a batch never grows with the table."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return pin(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def as_bytes(text: str) -> Column:
    return whole(text).cast("binary")


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % m


def raw_hash(text: str) -> Column:
    """Tells rows with one id but different texts apart; cheap and JVM-side."""
    return F.xxhash64(whole(text))


def keep_rows(docs: DataFrame, keepers: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of `docs` named by `keepers` (k_id, k_raw, k_same), with all their columns.

    `keepers` must be a written table. k_same is the number of rows with that id and text;
    where there are any with more than one, one of them stays, and these rows are reduced
    map-side, so that a row repeated very often is no hot spot.
    """
    raw = free(docs, "__raw")
    rows = docs.withColumn(raw, raw_hash(text))
    on = F.col("k.k_id").eqNullSafe(F.col(f"d.`{doc_id}`")) & (F.col("k.k_raw") == F.col(f"d.`{raw}`"))

    def among(k: DataFrame) -> DataFrame:
        return rows.alias("d").join(k.select("k_id", "k_raw").hint("merge").alias("k"), on, "left_semi")

    repeated = keepers.where("k_same > 1")
    if repeated.isEmpty():
        return among(keepers).drop(raw)
    once = among(keepers.where("k_same = 1"))
    return once.unionByName(among(repeated).dropDuplicates([doc_id, raw])).drop(raw)
